"""geospan: vector geodata extraction on Spark.

Functions defined in this package are shipped to Python workers by value
(cloudpickle), so Arrow UDFs and ``mapInPandas`` kernels work on executors
where the package is not installed.
"""

import sys as _sys

try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the hook
    pass
