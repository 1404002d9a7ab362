"""mailsift: text categorisation of message corpora as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers travel with their code, so that executors need not
# have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
