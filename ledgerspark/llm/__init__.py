"""Operators for preparing training text at scale: language, tokens, quality, near copies, secrets,
licences and source mixing. Each module holds one operator; ``queries`` registers them.

Code that runs in Python workers travels by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
