"""Training-data pipeline operators (documents, pages, labels).

Nothing else in the library imports this subpackage.  The Python functions that run
inside Spark tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
