"""Operators for training-data preparation over tables of documents and pages.

Nothing else in the library imports this subpackage. Functions that run inside tasks travel
with the job, so executors need no copy of these modules.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
