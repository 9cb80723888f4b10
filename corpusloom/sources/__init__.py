from corpusloom.sources.corpus import (
    alias_split,
    read_named_split,
    read_splits,
    read_text_parquet,
    write_corpus,
)
from corpusloom.sources.sinks import (
    RUN_LOG_SCHEMA,
    append_run_log,
    read_run_log,
    reuse_or_write,
    write_metric_json,
    write_subset,
)

__all__ = [
    "RUN_LOG_SCHEMA",
    "alias_split",
    "append_run_log",
    "read_named_split",
    "read_run_log",
    "read_splits",
    "read_text_parquet",
    "reuse_or_write",
    "write_corpus",
    "write_metric_json",
    "write_subset",
]
