"""Operations of a training-data pipeline: de-duplication, filters, tokens, packing, search, sharding.

Functions that run in tasks are sent along with them, so executors do not need
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
