"""Operators for preparing language-model training data, each a Spark job over whole tables.

Nothing outside this subpackage imports it. ``queries.py`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
