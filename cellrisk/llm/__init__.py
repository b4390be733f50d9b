"""Training-data operators: decontamination, near and exact duplicates, repeated
passages and lines, language, toxicity, packing, chat formatting, URL filters.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# tasks get the functions themselves, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
