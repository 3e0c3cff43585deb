"""Model training, scoring and evaluation.

Functions of this package that run inside tasks travel with the job, so executors need pandas and
numpy but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
