"""Operators of a training-data pipeline, one module each. Nothing outside this
subpackage imports it.

Functions of this package are sent to workers by value, so that the machines of a cluster
need Python with numpy, pyarrow, xxhash and tokenizers, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
