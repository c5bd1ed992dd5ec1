"""Operators for preparing training text: filters, deduplication, archives, tokens and chats."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with their tasks; executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
