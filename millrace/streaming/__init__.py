from millrace.streaming.clean import batch_loader, clean_stream, start_clean_stream
from millrace.streaming.files import (
    StreamReport,
    start_parquet_sink,
    start_stamped_copy,
    stream_parquet,
    stream_report,
    trigger_for,
    wait,
)
from millrace.streaming.progress import ProgressLog, whole_report
from millrace.streaming.published import batch_cleaner, read_rejects, start_first_per_key, start_published_clean

__all__ = [
    "ProgressLog",
    "StreamReport",
    "batch_cleaner",
    "batch_loader",
    "clean_stream",
    "read_rejects",
    "start_clean_stream",
    "start_first_per_key",
    "start_parquet_sink",
    "start_published_clean",
    "start_stamped_copy",
    "stream_parquet",
    "stream_report",
    "trigger_for",
    "wait",
    "whole_report",
]
