"""Operators for large-scale text corpora (deduplication, mixing, filters, tokens).

Nothing outside this package and ``corpus_pipeline.py`` imports it. Functions of
the package that run inside tasks are shipped by value, so executors need no
copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
