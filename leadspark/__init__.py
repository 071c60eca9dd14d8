"""leadspark: organisation lead data on Spark.

Every public operator is a lazy ``DataFrame -> DataFrame`` function (or a
``Column -> Column`` expression); the packages are

* ``functions``  column expressions (text, URLs, HTML, PII, scores, replies)
* ``operators``  relational steps (de-duplication, similarity join, enrichment)
* ``sources``    CSV / JSONL / lot readers and writers, ledger tables
* ``plans``      whole jobs built from the above
* ``streaming``  Structured Streaming twins of the incremental jobs
* ``catalog``    the named queries over the benchmark tables
"""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the executors by value, so a job
# needs no copy of the package on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
