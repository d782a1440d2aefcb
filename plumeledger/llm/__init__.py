"""Operators of a training-data pipeline: near copies, benchmark leaks, packing, token
counts, page text, personal data, language, quality and tool calls.

Nothing else in the library imports this package. Functions that run inside tasks are
shipped by value, so executors need no copy of the package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
