"""Operations of a training-data pipeline: mixing, filters, classifiers, dedup.

Each module holds one operator with its own general interface and the thin
`opN_<name>` query of its contract; `catalog` lists the queries. Nothing else
in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
