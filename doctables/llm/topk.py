"""Exact top-k by inner product: tiles of queries times shards of vectors.

Vectors are floor(scale * x) as whole numbers, so products are exact in doubles. Rows are dealt into parts of some shards, queries into
tiles of a set size, which are written to the shared folder. A task holds one part and reads one tile after the other: each shard is
multiplied with the tile, and of each query's best of every shard the k best of the part go on. The parts' lists are merged at the end.
Nothing that grows with the product of rows and queries is broadcast, and vectors are dealt out once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doctables.llm import shared

SHARD_ROWS = 8192
TILE_ROWS = 512
#: Shards of a part at most, and bytes of its numbers.
FAN_IN = 16
PART_BYTES = 32 << 20


def _whole(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of vectors without nulls and non-finite numbers."""
    v = F.col(vec_col).cast("array<double>")
    ok = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(ok & F.col("id").isNotNull())


def _matrix(batches: list[pa.RecordBatch], scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, dims and numbers of rows (id, v), padded to the longest."""
    table = pa.Table.from_batches(batches)
    ids, lists = table.column("id").to_numpy(), table.column("v").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    dims = lists.value_lengths().to_numpy().astype(np.int64)
    flat = np.floor(scale * lists.flatten().to_numpy().astype(np.float64))
    m = np.zeros((len(ids), max(1, int(dims.max()))))
    m[np.repeat(np.arange(len(ids)), dims), np.arange(len(flat)) - np.repeat(np.cumsum(dims) - dims, dims)] = flat
    return ids, dims, m


def _cut(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches regrouped to lists of so many rows."""
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held.append(batch.slice(at, rows - n))
            at, n = at + held[-1].num_rows, n + held[-1].num_rows
            if n == rows:
                yield held
                held, n = [], 0
    if held:
        yield held


def _tiles(rows: DataFrame, scale: int) -> list[str]:
    """Files with a row per tile: ids, dims and the rows' numbers. A tile's rows are gathered by its key."""

    def pack(table: pa.Table) -> pa.Table:
        return pa.table({c: [x.tobytes()] for c, x in zip(("ids", "dims", "m"), _matrix(table.to_batches(), scale))})

    return shared.written(rows.groupBy("tile").applyInArrow(pack, "ids binary, dims binary, m binary"), "tiles").inputFiles()


def _read_tiles(files: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, dims and numbers of each tile, one at a time."""
    for file in files:
        where, path = shared.file_system(file)
        with where.open_input_file(path) as f:
            for batch in pq.ParquetFile(f, buffer_size=1 << 20).iter_batches(batch_size=1):
                ids, dims, m = (np.frombuffer(batch.column(c)[0].as_buffer(), t) for c, t in (("ids", np.int64), ("dims", np.int64), ("m", np.float64)))
                yield ids, dims, m.reshape(len(ids), -1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row, the columns of the k largest finite scores, ties to the smaller id."""
    out = []
    for s in scores:
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            at = np.flatnonzero(s >= least)  # with all ties
        else:
            at = np.arange(len(s))
        at = at[np.isfinite(s[at])]
        out.append(at[np.lexsort((ids[at], -s[at]))][:k])
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k largest inner products with all rows of another id.

    Vectors that are null or hold a null or non-finite number, and rows without id, take no part. Only vectors of equal length are compared.
    Rows that repeat an id are candidates each; of queries that repeat an id and vector one counts. Fewer than k candidates give fewer
    rows, an empty table none. Scores must fit a long; beyond 2^53 they are computed in 64-bit integers.
    """
    spark = vectors.sparkSession
    rows = _whole(vectors, id_col, vec_col)
    asked = _whole(queries, id_col, vec_col).dropDuplicates(["id", "v"])
    n, longest = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    part_rows = max(1, min(FAN_IN * SHARD_ROWS, PART_BYTES // (8 * max(1, longest))))
    shard_rows = min(SHARD_ROWS, part_rows)
    n_parts = max(-(-n // part_rows), min(-(-n // shard_rows), 2 * shared.partitions(spark))) or 1
    n_tiles = -(-asked.count() // TILE_ROWS) or 1
    files = _tiles(asked.withColumn("tile", F.pmod(F.xxhash64("id", "v"), F.lit(n_tiles))), scale)

    def products(shard: tuple[np.ndarray, ...], tile: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """Row of the tile, id and score of each query's best of a shard."""
        (ids, dims, m), (qids, qdims, qm) = shard, tile
        d = min(m.shape[1], qm.shape[1])
        m, qm = m[:, :d], qm[:, :d]
        top = np.abs(m).max(initial=0) * np.abs(qm).max(initial=0) * d
        exact = qm @ m.T if top < 2.0**53 else qm.astype(np.int64) @ m.astype(np.int64).T
        out = (qdims[:, None] != dims) | (qids[:, None] == ids)
        found = best(np.where(out, -np.inf, exact), ids, k)
        row, col = np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate(found).astype(np.int64)
        return row, ids[col], exact[row, col].astype(np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = [_matrix(x, scale) for x in _cut(batches, shard_rows)]
        for tile in _read_tiles(files):
            row, ids, scores = (np.concatenate(x) for x in zip(*(products(shard, tile) for shard in shards)))
            order = np.lexsort((ids, -scores, row))
            row = row[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k  # places among a query's rows
            yield pa.RecordBatch.from_pydict({"query_id": tile[0][row[keep]], "vec_id": ids[order][keep], "score": scores[order][keep]})

    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_parts))  # rows of one vector or id too
    found = rows.select("id", "v", spread.alias("part")).groupBy("part").applyInArrow(multiply, "query_id long, vec_id long, score long")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_exact_top_k(spark, sf_dir):
    """The 5 best of all rows for every row whose id 50 divides."""
    rows = shared.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, rows.filter("vec_id % 50 = 0"))


ORACLE = {
    "op7_exact_top_k": """
with v as (select vec_id, [floor(256 * x::double)::bigint for x in embedding] as q from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id, list_sum([x[1] * x[2] for x in list_zip(a.q, b.q)])::bigint as score
      from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
}
