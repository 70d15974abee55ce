"""Training-data operators: sharding, near-duplicates, fingerprints, formatting, token files, archives, mixing, packing.

Nothing else in the library imports this package. Functions that run inside Spark tasks are
pickled by value, so executors need numpy, pyarrow and ``tokenizers`` but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
