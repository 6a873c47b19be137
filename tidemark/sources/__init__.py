"""Sources and sinks: parquet/catalog reads, JDBC windowed reads,
incremental append by high-water mark, materialisation and views."""

from tidemark.sources.files import (  # noqa: F401
    Tables,
    create_view,
    materialize,
    read_source,
    split_extract,
    stage_table,
)
from tidemark.sources.jdbc import (  # noqa: F401
    plan_windows,
    probe_schema,
    read_jdbc_query,
    read_jdbc_windows,
    spark_type_for,
    window_predicates,
)
from tidemark.sources.incremental import incremental_load, max_updated_at  # noqa: F401
