"""tidelog — commerce log analytics as PySpark DataFrame operators.

Subpackages:

* ``functions``  — column expressions (geohash, blank tests, labels, map edits)
* ``sources``    — readers and writers (CSV, lines, SQL dumps, parquet, JDBC, text)
* ``operators``  — DataFrame -> DataFrame building blocks
* ``plans``      — composed pipelines and the bindings to the driver's tables
* ``streaming``  — the stateless log pipeline run on a streaming source
"""

from tidelog.session import checkpoint_dir, get_session

__all__ = ["checkpoint_dir", "get_session"]
