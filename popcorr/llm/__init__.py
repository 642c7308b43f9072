"""Training-data operators: token counts, sharding, fingerprints, LM scores,
licence scans, mixing, suffix-array dedup, n-gram joins, language ID and
benchmark decontamination.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
