"""Operators for preparing training data: tokens, chats, filters, duplicates, classifiers, vectors.

Nothing else in the library imports this package. Functions that run in Python tasks are shipped with the job,
so workers need numpy, pyarrow, tokenizers and xxhash, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
