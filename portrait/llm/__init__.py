"""Operators of a training-data pipeline: documents, pages and benchmark
items in; encodings, groups, scores, spans and kept texts out.

Nothing else in the library imports this subpackage.  Its functions run in
Python workers that need not have the package on their path, so they are
pickled by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
