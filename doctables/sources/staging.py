"""Tables written once and read several times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
#: Spark removes what a query shuffled as soon as the query has ended; else it stays on disk until the driver happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from spark.checkpoint.dir; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="doctables-")
    return _LOCAL[app]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Used for parts of packages: opening files is the dear step, and the readers
    that follow need few columns and few parts each, which Parquet can skip.
    What the writing shuffled goes with its end; nothing else reads it. zstd takes
    about half the disk that Parquet's usual packing takes.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
    return spark.read.parquet(folder)


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
