"""Training-data operators: text corpora, chats and URLs as Spark plans.

One module per operator; ``catalog`` registers one query for each. Nothing outside this folder imports it
except the optional registration in the entry module.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
