"""Operators for training-data pipelines: search, decontamination, deduplication, tokens, extraction, sharding, scans.

Functions that run inside tasks are sent with their code, so executors need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
