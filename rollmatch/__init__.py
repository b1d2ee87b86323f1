"""rollmatch: reconcile two large person rosters per district on Spark.

The library is a set of ``DataFrame -> DataFrame`` functions:

* ``sources``    read roster CSV folders, district dimensions, snapshots; write exports
* ``functions``  column expressions (key cleaning, id formats, address rules, Jaro)
* ``operators``  keys, de-duplication, matching, district measures, summary
* ``plans``      the end-to-end pipelines built from the operators
* ``streaming``  the intake pipeline run incrementally over arriving batch files
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package that run on executors (the Jaro UDF, per-partition
# running sums) are shipped with each task by value: executors need no installed copy.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from rollmatch.schema import (  # noqa: F401,E402
    CONSOLIDATED_NAMES,
    INTAKE_NAMES,
    KEY_FIELDS,
    MEAL,
    STUDENT,
    Side,
    roster_schema,
)
