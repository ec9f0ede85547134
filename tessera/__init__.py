"""tessera: text-task data preparation and evaluation on Spark.

Functions of this package that run inside Python workers (Arrow kernels,
per-partition passes) are pickled by value, so executors need neither an
installed copy of the package nor a shared path to it.
"""

from __future__ import annotations

import sys as _sys

try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: fall back to import by name
    pass
