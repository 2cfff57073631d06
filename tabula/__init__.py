"""tabula — exploratory statistics and modelling of large tables on Spark.

Every operator takes a ``DataFrame`` (plus plain arguments) and returns a
``DataFrame``.  Operators stay lazy wherever Spark allows it; the few that
need an eager job (a model fit, a lineage cut, a schema learned from a first
pass) say so in their docstring.

Sub-packages
------------
``sources``    reading and writing files (JSON, CSV, Parquet, Avro, LIBSVM)
``functions``  column expressions: arithmetic, case chains, range buckets, dates
``operators``  table operators: columns, missing data, groups, joins, set
               operations, statistics, chart statistics, user functions, models
``plans``      physical-strategy helpers (scalar joins, salting, lineage cuts) and
               the registry of named queries used by the correctness oracle
"""

from tabula.session import checkpoint_dir, cluster_conf, local_session, scratch_path

__all__ = ["checkpoint_dir", "cluster_conf", "local_session", "scratch_path"]
__version__ = "0.1.0"
