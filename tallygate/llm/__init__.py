"""Operators for preparing language-model training data.

Nothing outside this folder imports it, apart from the guarded import in
``__spark_entry__.py``. Functions that run inside Spark's Python workers are sent to them
by value, so that workers need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
