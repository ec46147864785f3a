"""rooftally: building-footprint analytics as PySpark DataFrame operators.

Sub-packages
------------
``functions``  Column helpers (grid, geometry, names) and a few Arrow kernels
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and writers
``plans``      whole jobs composed from the operators
``streaming``  Structured Streaming versions of the event reports
``queries``    the registered queries with their SQL oracles
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship the code of the Arrow kernels with the job: executors need not have this package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
