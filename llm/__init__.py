"""Operators for preparing training data at scale.

Nothing outside this folder imports it.  Functions that run inside tasks are
shipped to the executors with the job, so these need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
