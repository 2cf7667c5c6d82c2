from millrace.operators.chunks import chunk_by_bytes, chunk_by_rows, number_rows, shard_mb_for
from millrace.operators.dedup import first_per_key
from millrace.operators.nested import Level, flatten_levels, read_nested
from millrace.operators.paging import KeyPages, key_pages, page, sample_rows
from millrace.operators.profile import json_profile
from millrace.operators.quality import count_rows, is_empty, quality_report
from millrace.operators.records import parse_lines, records_with_problems, rejected_lines

__all__ = [
    "KeyPages",
    "Level",
    "chunk_by_bytes",
    "chunk_by_rows",
    "count_rows",
    "first_per_key",
    "flatten_levels",
    "is_empty",
    "key_pages",
    "json_profile",
    "number_rows",
    "page",
    "parse_lines",
    "quality_report",
    "read_nested",
    "records_with_problems",
    "rejected_lines",
    "sample_rows",
    "shard_mb_for",
]
