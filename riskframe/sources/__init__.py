"""Sources and sinks."""

from riskframe.sources.tables import (
    DatasetLoader,
    append_history,
    load_dataset,
    read_history,
    read_table,
    sampled_read,
    scoring_table,
    to_pandas,
    to_spark,
    upsert,
    write_batch,
    write_merge,
    write_table,
)

__all__ = [
    "DatasetLoader",
    "append_history",
    "load_dataset",
    "read_history",
    "read_table",
    "sampled_read",
    "scoring_table",
    "to_pandas",
    "to_spark",
    "upsert",
    "write_batch",
    "write_merge",
    "write_table",
]
