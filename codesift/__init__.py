"""codesift: corpus triage on Spark.

Every public operator is a DataFrame -> DataFrame (or Column -> Column)
function with a fixed output schema.  See README.md for the operator map.
"""

import sys as _sys

__version__ = "0.1.0"

# Python tasks (Arrow UDFs, mapInPandas) must not depend on this package being
# installed on the workers: ship its functions by value.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass
