"""Operators for preparing training data: deduplication, mixing, search,
classification, scanning and language-model scoring over text tables.

Each module holds one operator with its own interface; ``queries.py`` holds
the thin registered queries over the driver tables.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors whole, so that they need
# no installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
