"""The jobs from a shell: ``spark-submit`` (or ``python -m``) ``millrace <job> …``.

The session comes from the launcher; nothing about the cluster is set here.
"""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession

from millrace.defaults import CHUNK_ROWS, ENTITY_DDL, JDBC_BATCH_ROWS, SHARD_MB, TRIGGER
from millrace.operators import json_profile
from millrace.plans import land_in_chunks, run_clean, run_flatten, run_load, split_to_shards
from millrace.sinks import jdbc_target
from millrace.sources import jdbc_options, read_jdbc
from millrace.streaming import start_stamped_copy, wait


def _constants(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    flatten = jobs.add_parser("flatten", help="nested documents to entity and item JSON lines")
    flatten.add_argument("documents")
    flatten.add_argument("--entities", required=True)
    flatten.add_argument("--items", required=True)
    flatten.add_argument("--rejects", required=True)

    profile = jobs.add_parser("profile", help="what each JSON file holds")
    profile.add_argument("files")
    profile.add_argument("--output", required=True, help="Parquet folder for the profile")

    split = jobs.add_parser("split", help="JSON to size-bounded files of valid lines")
    split.add_argument("files")
    split.add_argument("--output", required=True)
    split.add_argument("--shard-mb", type=int, default=SHARD_MB)
    split.add_argument("--layout", choices=["lines", "array"], default="lines")

    clean = jobs.add_parser("clean", help="JSON lines to one clean Parquet table")
    clean.add_argument("files")
    clean.add_argument("--output", required=True)
    clean.add_argument("--rejects", required=True)
    clean.add_argument("--schema", default=ENTITY_DDL)
    clean.add_argument("--key", nargs="+", default=["id"])
    clean.add_argument("--order-by", nargs="+", help="which row of a key stays; first of this order")
    clean.add_argument("--ignore-corrupt-files", action="store_true")
    clean.add_argument("--required", nargs="*", default=["id", "name", "city"])
    clean.add_argument("--set", nargs="*", default=[], metavar="COLUMN=VALUE")
    clean.add_argument("--run-id")

    for name, text in (
        ("land", "a database table to ordered chunk files"),
        ("load", "a Parquet folder to a database table"),
    ):
        job = jobs.add_parser(name, help=text)
        job.add_argument("folder")
        job.add_argument("--url", required=True)
        job.add_argument("--table", required=True)
        job.add_argument("--driver")
        if name == "land":
            job.add_argument("--order-by", nargs="+", required=True)
            job.add_argument("--rows", type=int, default=CHUNK_ROWS)
            job.add_argument("--bounds", nargs=2, type=int, metavar=("LOWER", "UPPER"))
            job.add_argument("--partitions", type=int, default=1)
        else:
            job.add_argument("--batch-rows", type=int, default=JDBC_BATCH_ROWS)
            job.add_argument("--load-id")
            job.add_argument("--keys", nargs="*")
            job.add_argument("--new-table", action="store_true")

    stream = jobs.add_parser("stream", help="a landing folder, stamped, to an output folder")
    stream.add_argument("source")
    stream.add_argument("--output", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--schema")
    stream.add_argument("--every", default=TRIGGER, help="interval, or 'once'")
    stream.add_argument("--max-files", type=int)
    return parser


def run(spark: SparkSession, given: argparse.Namespace):
    """Run one job; returns its report, if it has one."""
    if given.job == "flatten":
        return run_flatten(spark, given.documents, given.entities, given.items, given.rejects)
    if given.job == "profile":
        return json_profile(spark, given.files).write.parquet(given.output)
    if given.job == "split":
        return split_to_shards(spark, given.files, given.output, given.shard_mb, given.layout)
    if given.job == "clean":
        return run_clean(
            spark,
            given.files,
            given.output,
            given.rejects,
            given.schema,
            run_id=given.run_id,
            required=given.required,
            ignore_corrupt_files=given.ignore_corrupt_files,
            key=given.key[0] if len(given.key) == 1 else given.key,
            order_by=given.order_by,
            constants=_constants(given.set),
        )
    if given.job == "land":
        source = read_jdbc(
            spark,
            jdbc_options(given.url, given.table, given.driver),
            partition_column=given.order_by[0] if given.bounds else None,
            bounds=tuple(given.bounds) if given.bounds else None,
            partitions=given.partitions,
        )
        return land_in_chunks(source, given.folder, given.order_by, given.rows)
    if given.job == "load":
        target = jdbc_target(given.url, given.table, given.driver, given.batch_rows)
        return run_load(
            spark,
            given.folder,
            target,
            load_id=given.load_id,
            keys=given.keys,
            new_table=given.new_table,
        )
    query = start_stamped_copy(
        spark,
        given.source,
        given.output,
        given.checkpoint,
        given.schema,
        given.every,
        given.max_files,
    )
    return wait(query)


def main(argv: list[str] | None = None) -> None:
    given = _arguments().parse_args(argv)
    report = run(SparkSession.builder.appName(f"millrace {given.job}").getOrCreate(), given)
    if dataclasses.is_dataclass(report):
        print(dataclasses.asdict(report))


if __name__ == "__main__":
    main()
