from millrace.sources.files import file_inventory, total_bytes
from millrace.sources.new_files import read_file_runs, run_new_files, unread_files
from millrace.sources.ranges import document_entries
from millrace.sources.readable import probe_files, split_readable
from millrace.sources.tables import jdbc_options, key_ranges, read_jdbc, read_table
from millrace.sources.text import (
    array_elements,
    infer_json_schema,
    read_documents,
    read_json,
    read_lines,
    require_rows,
)

__all__ = [
    "array_elements",
    "document_entries",
    "file_inventory",
    "infer_json_schema",
    "jdbc_options",
    "key_ranges",
    "probe_files",
    "read_documents",
    "read_file_runs",
    "read_jdbc",
    "read_json",
    "read_lines",
    "read_table",
    "require_rows",
    "run_new_files",
    "split_readable",
    "total_bytes",
    "unread_files",
]
