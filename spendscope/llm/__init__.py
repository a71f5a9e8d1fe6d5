"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``labels``.

Nothing else in the library imports this subpackage.  Functions that run
inside Python workers are pickled by value, so executors need numpy,
pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
