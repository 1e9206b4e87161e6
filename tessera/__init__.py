"""tessera — Spark-native data jobs: incremental sales rollups, wide metric
panels, latest-per-channel reports and data-quality operators.

Every job is a composition of DataFrame operations so Catalyst plans it;
nothing here is a second engine.
"""

import sys as _sys

# Functions of this package that run inside tasks (the pandas UDF of the bracket
# check, RDD lambdas) are pickled by value, so executors need no installed copy.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # older cloudpickle: ship the package with --py-files instead
    pass

from tessera.session import build_session, scratch_dir  # noqa: E402

__all__ = ["build_session", "scratch_dir"]
