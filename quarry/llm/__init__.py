"""Operators of a training-data pipeline: page extraction, quality and
duplicate filters, mixing, packing, token counts, fingerprints, chat format.

Each module holds one operator with a general interface; ``queries`` wraps
them into the registered queries.  Functions that run inside tasks are pickled
by value, so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
