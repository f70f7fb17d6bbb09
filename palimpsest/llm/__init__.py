"""Training-data operators: deduplication, mixing, tokens, quality, extraction and safety.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries when it is there.
Functions that run in tasks travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
