"""Conversion of files as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from doctables.plans.convert import word_to_markdown, workbook_grid
from doctables.sources.packages import classify_input, read_packages, scan_packages, stream_packages, unpack
from doctables.sources.staging import drop_staged, staged

#: Files that one batch takes, and how often a file that cannot be read is tried.
MAX_FILES = 1000
TRIES = 3
#: The reason that is tried again: the file may have been half written.
DAMAGED = "decode error"


def convert_batch(package: DataFrame, wanted: str, out: str, batch_id: int, before: DataFrame | None = None) -> None:
    """Convert one batch of files and record why the others were rejected.

    Results go to folders named by the batch, written over on a retry, so a
    batch that is run again leaves nothing twice. Outcomes are written last: a
    batch counts once they are there. before has the earlier tries of some paths.
    """
    files = package.select("path", "kind", "length", "modified")
    parts = staged(unpack(package.where(F.col("kind").eqNullSafe(F.lit(wanted)))), "parts")
    convert = word_to_markdown if wanted == "docx" else workbook_grid
    convert(parts).write.mode("overwrite").parquet(f"{out}/converted/batch={batch_id}")
    failed = parts.groupBy("path").agg(F.max("error").alias("error"))
    outcome = files.join(failed, "path", "left")
    tries = F.lit(1)
    if before is not None:
        outcome = outcome.join(before, "path", "left")
        tries = F.coalesce("tries", F.lit(0)) + 1
    outcome.select(
        "path", "length", "modified", classify_input("length", "error", "kind", wanted).alias("reason"), tries.alias("tries")
    ).write.mode("overwrite").parquet(f"{out}/outcome/batch={batch_id}")
    drop_staged(parts)


# --- state over file versions ---------------------------------------------------------------


def _outcomes(spark: SparkSession, out: str) -> DataFrame:
    """All recorded outcomes; none if no batch has ended."""
    schema = "path string, length long, modified timestamp, reason string, tries int, batch long"
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/outcome")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out}/outcome")


def file_states(spark: SparkSession, out: str) -> DataFrame:
    """The last outcome of each path: (path, length, modified, reason, tries, batch)."""
    last = F.max_by(F.struct("length", "modified", "reason", "tries", "batch"), "batch")
    return _outcomes(spark, out).groupBy("path").agg(last.alias("v")).select("path", "v.*")


def converted_texts(spark: SparkSession, out: str) -> DataFrame:
    """What stands for each path now: the rows of its last version that could be converted."""
    good = _outcomes(spark, out).where("reason IS NULL").groupBy("path").agg(F.max("batch").alias("batch"))
    return spark.read.parquet(f"{out}/converted").join(good, ["path", "batch"]).drop("batch")


def convert_changed(
    spark: SparkSession, landing: str, out: str, wanted: str = "docx", max_files: int = MAX_FILES, tries: int = TRIES
) -> int:
    """Convert the files of a folder that are new, replaced by a later version, or damaged at the last try; gives their number.

    The state is the table of outcomes that each batch leaves in ``out``, so a call that broke off is done again by the next one.
    Files of any age count when they are met first; one with the time of the version known is left alone. A call takes
    at most max_files, oldest first; call again for the rest. A damaged version is tried ``tries`` times in all, and the text of
    the version before stays. Listing reads no content.
    """
    found = scan_packages(spark, landing, recursive=True).select("path", "modified")
    known = file_states(spark, out).select("path", F.col("modified").alias("seen"), "reason", F.col("tries").alias("tried"))
    again = (F.col("modified") == F.col("seen")) & (F.col("reason") == DAMAGED) & (F.col("tried") < tries)
    due = found.join(known, "path", "left").where(F.col("seen").isNull() | (F.col("modified") > F.col("seen")) | again)
    earlier = F.when(F.col("modified") == F.col("seen"), F.col("tried")).otherwise(0)
    taken = due.select("path", "modified", earlier.alias("tries")).orderBy("modified", "path").limit(max_files).collect()
    if taken:
        last = _outcomes(spark, out).agg(F.max("batch")).first()[0]
        before = spark.createDataFrame([(r.path, r.tries) for r in taken], "path string, tries int")
        convert_batch(read_packages(spark, [r.path for r in taken]), wanted, out, 0 if last is None else last + 1, before)
    return len(taken)


def stream_convert(
    spark: SparkSession, landing: str, out: str, checkpoint: str, wanted: str = "docx", once: bool = True,
    max_files: int = MAX_FILES,
) -> StreamingQuery:
    """Convert the files that arrive in ``landing``; each path is taken exactly once, see convert_changed for later versions.

    With ``once`` the query takes what is there and stops.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        convert_batch(batch, wanted, out, batch_id)

    writer = stream_packages(spark, landing, max_files=max_files).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
