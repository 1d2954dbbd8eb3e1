"""Operators for training corpora.

Executors need not have this package installed: what a task needs travels with it.  Values
that are broadcast are therefore plain tuples, dictionaries and arrays.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
