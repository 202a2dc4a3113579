"""Operators for preparing training data at scale, and their registered queries.

Nothing else in the library imports this subpackage. The Python helpers that
run inside tasks are shipped with the job by value, so the executors need the
third-party libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
