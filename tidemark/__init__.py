"""tidemark — marketing-attribution and ledger marts on Spark.

Each operator is a function from DataFrames to a DataFrame; composites chain
them lazily, so the only actions happen at the sink. Sub-packages:

* ``functions``  scalar column helpers (time-zone shift, safe casts, regex)
* ``operators``  staging, dedup, joins, aggregates, reshaping, attribution, checks
* ``sources``    parquet / catalog / JDBC reads, materialisation, incremental load
* ``plans``      composite marts and the driver queries with their SQL oracles
* ``streaming``  nothing: the pipelines this library rebuilds are batch only
"""

from tidemark.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
