"""Operators for preparing large training corpora. Nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Python workers get the functions themselves, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
