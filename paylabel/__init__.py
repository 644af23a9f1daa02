"""paylabel: payment labelling analytics on Spark."""

import sys as _sys

try:  # ship the package's Python functions (Arrow UDFs, grouped maps) by value
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: executors need the package installed
    pass
