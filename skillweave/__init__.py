"""Text-profile analytics on Spark: cleaning, skills, vectors, clusters, rules, classifiers, matching."""

import sys

from pyspark import cloudpickle

# Functions for tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
