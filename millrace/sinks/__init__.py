from millrace.sinks.files import append_parquet, write_chunks, write_jsonl, write_shards
from millrace.sinks.known_keys import append_better, append_new, read_best, read_new
from millrace.sinks.runs import (
    append_run,
    prepare_run,
    publish,
    read_merged,
    read_runs,
    remove_unpublished,
    replace_run,
)
from millrace.sinks.tables import Target, append_once, jdbc_target, parquet_target, staged_load

__all__ = [
    "Target",
    "append_better",
    "append_new",
    "append_once",
    "append_parquet",
    "append_run",
    "jdbc_target",
    "parquet_target",
    "prepare_run",
    "publish",
    "read_best",
    "read_merged",
    "read_new",
    "read_runs",
    "remove_unpublished",
    "replace_run",
    "staged_load",
    "write_chunks",
    "write_jsonl",
    "write_shards",
]
