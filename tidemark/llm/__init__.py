"""Training-data operators over document tables.

Each module holds one operator with a general DataFrame interface; ``queries``
registers the thin ``opN_<name>`` queries. Nothing else in the library imports
this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a task
# needs no copy of the package on its Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
