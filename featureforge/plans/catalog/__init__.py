"""Catalogued queries (one module per operator family); importing this
package fills ``featureforge.plans.registry.REGISTRY``."""

from featureforge.plans.catalog import insight  # noqa: F401
from featureforge.plans.catalog import features  # noqa: F401
from featureforge.plans.catalog import flagship  # noqa: F401
from featureforge.plans.catalog import profile  # noqa: F401
from featureforge.plans.catalog import prep  # noqa: F401
from featureforge.plans.catalog import select  # noqa: F401
from featureforge.plans.catalog import evaluate  # noqa: F401
from featureforge.plans.catalog import models  # noqa: F401
from featureforge.plans.catalog import workflows  # noqa: F401
from featureforge.plans.catalog import advanced  # noqa: F401
from featureforge.plans.catalog import documents  # noqa: F401
from featureforge.plans.catalog import operations  # noqa: F401
from featureforge.plans.catalog import neighbours  # noqa: F401
