"""featureforge: churn-style profiling, feature engineering, modelling and
evaluation as lazy Spark DataFrame operators.

Every operator has the shape ``op(df, roles, **params) -> DataFrame``.  Column
roles (id, target, tenure, charges, ...) are parameters (``Roles``) so the same
operator runs on any table.  Operators whose output depends on data statistics
(imputers, cappers, scalers, encoders, selectors) run one bounded statistics
job in ``fit`` and return a model whose ``transform`` stays a lazy projection.
"""

from featureforge.roles import Roles, CUSTOMER_360_ROLES
from featureforge.session import get_spark, checkpoint_dir

__all__ = ["Roles", "CUSTOMER_360_ROLES", "get_spark", "checkpoint_dir"]
