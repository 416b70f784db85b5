"""Operators for training-data pipelines: text, tokens, vectors, conversations.

Task functions of this package travel to the executors by value, so workers need
numpy, pyarrow and tokenizers but no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

from yearloom import session

cloudpickle.register_pickle_by_value(session)
cloudpickle.register_pickle_by_value(sys.modules[__name__])
