"""Batch runs over the files that no earlier run has read.

A table of runs (see :mod:`millrace.sinks.runs`) keeps the files each run has read, as path, length and modification
time, beside the rows it made of them, and both are published in one entry. The list of an input is compared with
what is stored before anything is opened; a run that fails publishes neither, so its files are read by the next one.
A file that has changed since counts as new.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.errors import LoadError
from millrace.sinks.runs import last_version, prepare_run, publish, read_runs
from millrace.sources.files import file_inventory

ROWS, FILES = "rows", "files"
_FILE = "path string, length bigint, modificationTime timestamp"


def unread_files(spark: SparkSession, paths, table: str, without: str | None = None) -> DataFrame:
    """path, length and modificationTime of the files that no run (other than ``without``) has read."""
    found = file_inventory(spark, paths)
    if not last_version(spark, table):
        return found
    known = read_runs(spark, table, _FILE, output=FILES, without=without).drop("run_id")
    return found.join(known, ["path", "length", "modificationTime"], "left_anti")


@dataclass(frozen=True)
class FileRun:
    files: int
    bytes: int


def run_new_files(
    spark: SparkSession,
    paths,
    table: str,
    run_id: str,
    job: Callable[[list[str]], DataFrame],
) -> FileRun:
    """Hand the unread files to ``job`` and store the rows it returns; without new files nothing is stored.

    ``job`` gets the paths, as any reader of Spark takes them. Read the rows with :func:`read_file_runs`. A run
    under an id that was used replaces its rows and files, so it reads its former files again too.
    """
    version = last_version(spark, table)
    # One line a file, as the listing of any scan.
    files = unread_files(spark, paths, table, run_id).orderBy("path").collect()
    if not files:
        return FileRun(0, 0)
    rows = prepare_run(job([f.path for f in files]), table, run_id, ROWS)
    listed = prepare_run(spark.createDataFrame(files, _FILE), table, run_id, FILES)
    publish(spark, rows, listed, after=version)
    return FileRun(len(files), sum(f.length for f in files))


def read_file_runs(spark: SparkSession, table: str, schema) -> DataFrame:
    """The rows of all runs, with ``run_id``."""
    if not last_version(spark, table):
        raise LoadError(f"{table} holds no published run")
    return read_runs(spark, table, schema, output=ROWS)


def read_files_read(spark: SparkSession, table: str) -> DataFrame:
    """The files each run has read."""
    return read_runs(spark, table, _FILE, output=FILES).select("run_id", "path", F.col("length"))
