"""folio: catalogue cleaning, enrichment, browse and semantic search on Spark."""

import sys as _sys

__version__ = "0.1.0"

# Functions of this package that run inside Python workers (pandas UDFs,
# mapInPandas, applyInPandas) are shipped by value, so executors need no copy
# of the package on their path.
try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
