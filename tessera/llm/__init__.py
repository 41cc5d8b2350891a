"""Training-data operators: text quality, near duplicates, decontamination,
packing, archives, pseudonyms, token counts and chat formatting.

Nothing else in the library imports this subpackage. Its functions travel to
the executors by value, so those need the third-party libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
