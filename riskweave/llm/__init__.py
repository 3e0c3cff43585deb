"""Operators that prepare text corpora for language-model training.

Nothing else in the library imports this package. Functions that run inside tasks travel with the
job, but some operators broadcast objects of their classes, so executors need the package on their
Python path (``--py-files``) beside numpy, pandas and pyarrow.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
