"""Operators for building training corpora: deduplication, filtering, mixing, packing and archives.

Nothing else in the library imports this subpackage. Its functions travel to the executors by value,
so a cluster needs no copy of the repository on the executors' Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
