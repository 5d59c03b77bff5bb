"""Concordat: checking and curating business-entity master data on Spark.

Client uploads are matched by identifier against an authoritative registry, checked field by
field, scored, resolved to their nearest registry names where they do not match, merged into a
curated table and summarised in quality reports.  Every public function takes and returns
DataFrames; nothing holds a session of its own.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
