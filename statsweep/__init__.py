"""statsweep: analytics over histories of database-server monitoring snapshots, on Spark.

Counter deltas with reset detection, activity and wait summaries, blocking chains,
rankings, window-aligned wait attribution, sustained-threshold rules, per-phase
summaries, before/after comparison and their Structured Streaming forms.
Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; see ``README.md`` for the operator index.
"""

import sys as _sys

__all__ = ["session"]

# The few Python functions that run on executors (grouped pandas folds, stream state)
# are shipped by value with the task, so executors need no installed copy of this
# package and a driver started from any directory works.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001  (older cloudpickle: fall back to the installed package)
    pass
