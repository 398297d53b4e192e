"""What every module needs from the session: tables, the shared folder, cuts of lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Nothing larger than this is ever sent to executors as a whole table.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir, or one of our own where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not folder:
        own = sc._jsc.sc().getCheckpointDir()
        folder = own.get() if own.isDefined() else None
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pairlake-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows with the lineage cut by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


_OWN: dict[str, str] = {}


def own_folder(spark: SparkSession) -> str:
    """This session's part of the shared folder; it is deleted when the driver ends, whatever tables were written to it."""
    folder = shared_folder(spark)
    key = f"{spark.sparkContext.applicationId} {folder}"
    if key not in _OWN:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/pairlake-{uuid.uuid4().hex}")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWN[key] = path.toString()
    return _OWN[key]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder, kept until the driver ends."""
    return f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a table in the shared folder: columnar and compressed, for results read more than once."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``most`` rows; reads no more than that."""
    return df.limit(most + 1).count() <= most
