"""Written intermediate tables in the shared folder the cluster names.

A staged table cuts lineage without pinning blocks to executors: every reader
sees the same rows even when executors are lost and tasks run again, and its
size on disk gives the optimizer a measured size for its broadcast decisions.
"""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.errors import MillraceError


def scratch_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, else a folder in the warehouse.

    Both are shared by the driver and all executors, and both are read from the
    session, so local and cluster runs take the same path. A warehouse on a local disk serves a local master only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise MillraceError("set spark.checkpoint.dir to a shared folder: the warehouse is local to one machine")
    return warehouse.rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that nothing else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return a reader over the written table.

    ``compression`` is the session's unless stated; text shrinks most by ``zstd``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(*staged: DataFrame | None) -> None:
    """Delete tables made by :func:`stage`, once nothing will read them again."""
    for df in staged:
        if df is None:
            continue
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of writes that have ended deleted now.

    Spark deletes them once the driver has collected the objects that stand for them, which else happens when the
    driver runs short of memory. The first collection clears what holds those objects, the second one finds them.
    """
    gc.collect()
    for _ in range(2):
        spark._jvm.System.gc()
        time.sleep(0.2)
