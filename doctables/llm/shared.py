"""What the operators share: the cluster's shared folder, written tables, words, held-out marks."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_HELD: dict[str, object] = {}
#: Separators of words: space and the ASCII control blanks. `bytes.split()` cuts at the same ones.
BLANKS = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Where it is unset, a local session gets a temporary folder; a cluster must set it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="doctables-")
        _LOCAL[spark.sparkContext.applicationId] = root
    return root if "://" in root else "file://" + os.path.abspath(root)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_files(df: DataFrame) -> None:
    """Remove the files of a table made by written() that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def file_system(uri: str):
    """(pyarrow file system, path) of a URI; used by tasks that write or read files of their own formats."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def trim() -> None:
    """Give memory that a worker no longer uses back to the system; workers wait for their next task with what they keep."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def let_go() -> None:
    """Drop what the worker holds for an operator that ran before."""
    if _HELD:
        _HELD.clear()
        trim()


def held(key: str, make: Callable[[], object]):
    """What a worker keeps between the tasks of an operator; one thing at a time, as workers serve one operator after the other."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; no words for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def batches_of(it: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one hold about `limit` bytes (one longer text stands alone)."""
    for batch in it:
        if not batch.num_rows:
            continue
        sizes = [0 if x is None else x for x in pc.binary_length(batch.column(column)).to_pylist()]
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        yield batch.slice(begin)
