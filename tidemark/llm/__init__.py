"""Operators on training text: quality, licences, mixing, vectors, archives, repeats, scoring, copies, personal data."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors whole, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
