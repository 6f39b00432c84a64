"""Operators of a training-data pipeline (quality, dedup, decontamination,
scans, mixing) as Spark jobs. Nothing else in the library imports this package.

Task functions are shipped by value, so executors need numpy, pyarrow and
xxhash but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
