"""tablesync: multi-tenant table synchronisation and change analytics on Spark.

Subpackages: ``sources`` (scans, catalog, state files), ``functions``
(type map, conversions, row hash), ``operators`` (transforms, merges,
metrics), ``sinks`` (Parquet writers), ``plans`` (control table, pipelines),
``streaming`` (stream upsert).
"""

from .session import configure, local_session  # noqa: F401
