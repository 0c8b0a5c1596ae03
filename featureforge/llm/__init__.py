"""Training-data operators for large text corpora (ten operators, their
queries in ``catalog`` and the DuckDB SQL of those SQL can express).

Nothing else in the library imports this package.  Its functions are shipped
to the executors by value, so a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
