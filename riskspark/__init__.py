"""riskspark: transaction-risk analytics as plain DataFrame operators and Spark ML stages.

Functions that run inside tasks are sent with their code, so executors need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

cloudpickle.register_pickle_by_value(sys.modules[__name__])
