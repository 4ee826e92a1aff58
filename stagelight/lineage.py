"""Tables that are kept between steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. One of our own is set only in one process without one, as in tests."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and context._jsc.sc().getCheckpointDir().isEmpty():
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stagelight-"))
    return folder or context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, path: str) -> DataFrame:
    """df as compressed Parquet at a path in the shared folder, which whoever reads it reads in splits of their own, and by the
    columns that they need: a cut is read in the tasks that made it, however much wider its rows are than what they read."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a task, of a few columns
ROWS = 1_000_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to as many tasks as its rows need, where the session's number of them is smaller: what a task holds to
    group or join by these keys does not grow with the table."""
    n = -(-df.count() // ROWS)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is made there yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def kept(spark: SparkSession, name: str, work: Callable[[str], DataFrame]) -> DataFrame:
    """What work(folder) gives, after which the folder goes."""
    folder = scratch(spark, name)
    try:
        return cut(work(folder))
    finally:
        remove(spark, folder)
