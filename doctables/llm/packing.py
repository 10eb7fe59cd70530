"""Packing documents into sequences of a fixed length by patterns fitted with non-negative least squares.

The number of pieces of each length is a histogram of at most `size` bins, whatever the corpus. Patterns of
two or three lengths that fill a sequence to the last token are enumerated from the lengths that occur, their repeat counts are fitted
to the histogram by non-negative least squares and rounded down, and what they leave is packed best-fit, longest first, on
counts. The plan is a list of patterns with repeat counts; pieces take its slots by their rank among the pieces of
their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doctables.llm import shared, tokens

SIZE = 1024
BATCH_BYTES = 4 << 20
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, size: int, tokenizer: str, end_id: int) -> DataFrame:
    """Pieces of every document's ids: only longer ones are cut, into `size`, the first taking what is left over.

    Null text is empty and gives one piece, the end id. `task` and `rank` number the pieces of a length in a task.
    """

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        task = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in shared.batches_of(it, "text", BATCH_BYTES):
            ids, n = enc.encode(batch.column("text").to_pylist())
            ids = np.insert(ids, np.cumsum(n), end_id).astype("<u4")
            n = n + 1
            doc_at = np.cumsum(n) - n
            pieces = (n + size - 1) // size
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = n - (pieces - 1) * size  # length of the first piece
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * size)
            length = np.where(piece == 0, head[doc], size)
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * (a + b)]) for a, b in zip((doc_at[doc] + start).tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            run = np.concatenate([[0], np.flatnonzero(np.diff(length[order])) + 1])
            own = np.arange(len(order)) - np.repeat(run, np.diff(np.append(run, len(order))))
            rank = np.empty(len(order), np.int64)
            rank[order] = own
            rank += seen[length]
            seen += np.bincount(length, minlength=size + 1)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").take(pa.array(doc)).cast(pa.int64()), "piece": piece.astype(np.int32), "start": start, "length": length, "ids_crc32": np.array(crc, np.int64), "task": np.full(len(doc), task), "rank": rank})
        shared.trim()

    return docs.select("doc_id", "text").mapInArrow(cut, PIECE + ", task long, rank long")


def patterns_of(lengths: np.ndarray, size: int) -> np.ndarray:
    """All pairs and triples of the given lengths with sum `size`, padded with 0; rows (a, b, c), a >= b >= c."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    there[0] = True  # no third piece
    out = []
    for a in lengths:
        b = np.arange(max(1, (size - a + 1) // 2), min(a, size - a) + 1)
        b = b[there[b]]
        c = size - a - b
        keep = (c >= 0) & (c <= b) & there[np.clip(c, 0, size)]
        out.append(np.stack([np.full(keep.sum(), a), b[keep], c[keep]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def fit(patterns: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|, by accelerated projected gradient descent.

    A's columns are the patterns' counts of each length, so A x is three weighted bincounts.
    """
    if not len(patterns):
        return np.zeros(0)
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0

    def used(x):
        y = sum(np.bincount(patterns[:, k], x, size) for k in range(3))
        y[0] = 0
        return y

    v = np.ones(len(patterns))
    for _ in range(15):  # the largest eigenvalue of A'A, for the step
        v = used(v)[patterns].sum(1) * (1 / np.linalg.norm(v))
    step = 1 / np.linalg.norm(v)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        gradient = (used(y) - target)
        gradient[0] = 0
        new = np.maximum(0, y - step * gradient[patterns].sum(1))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeat count) whose slots are exactly the histogram (bin k: pieces of length k).

    Full pieces stand alone. The number of entries is bounded by the bins, not by the pieces.
    """
    size = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        out.append(((size,), int(left[size])))
        left[size] = 0
    patterns = patterns_of(np.flatnonzero(left), size)
    repeat = fit(patterns, left)
    for k in np.argsort(-repeat, kind="stable"):
        wanted = int(repeat[k] + 1e-9)
        if not wanted:
            break
        lengths, each = np.unique(patterns[k][patterns[k] > 0], return_counts=True)
        n = min(wanted, int((left[lengths] // each).min()))
        if n:
            left[lengths] -= n * each
            out.append((tuple(int(x) for x in patterns[k] if x), n))
    return out + best_fit(left)


def best_fit(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit packing, longest first, of counts: bins that look alike are moved together."""
    size = len(left) - 1
    open_: dict[int, list[list]] = defaultdict(list)  # room -> [lengths, count]
    rooms = np.zeros(size + 1, bool)
    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                lengths, count = open_[room].pop()
                rooms[room] = bool(open_[room])
            else:
                room, lengths, count = size, (), -(-n // (size // length))
            each = min(room // length, n)
            k = min(count, n // each)
            if k < count:
                open_[room].append([lengths, count - k])
                if room < size or lengths:
                    rooms[room] = True
                else:
                    open_[room].pop()
            rest = room - each * length
            open_[rest].append([lengths + (length,) * each, k])
            rooms[rest] = rest > 0
            n -= each * k
    return [(tuple(lengths), count) for groups in open_.values() for lengths, count in groups if lengths]


def slots(entries: list[tuple[tuple[int, ...], int]], size: int) -> tuple[np.ndarray, ...]:
    """(length, first rank, first sequence, offset) arrays, ordered: where the pieces of a length go by rank."""
    taken = np.zeros(size + 1, np.int64)
    rows, sequence = [], 0
    for lengths, count in entries:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def packed(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """One row per piece with its sequence_id and offset there.

    Null text is empty, null doc_ids and repeated rows are documents like others, columns besides doc_id and text
    are ignored, an empty table gives no rows. The driver holds the histogram and the plan (at most a few entries per bin).
    """
    pieces = shared.written(cut_pieces(docs, size, tokenizer or tokens.default_path(), end_id), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(size + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r.length] = r.n
    length, rank, sequence, offset = slots(plan(histogram), size)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = int(rank.max()) + 1 if len(rank) else 1
        keys = length.astype(object) * width + rank if width > 2**52 else length * width + rank
        for batch in it:
            own = batch.column("length").to_numpy()
            at = batch.column("rank").to_numpy() + batch.column("base").to_numpy()
            k = np.searchsorted(keys, own * width + np.minimum(at, width - 1), "right") - 1
            cols = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield pa.RecordBatch.from_pydict(cols | {"sequence_id": sequence[k] + at - rank[k], "offset": offset[k]})

    return pieces.join(bases, ["task", "length"]).mapInArrow(place, PIECE + ", sequence_id long, offset long")


def op9_packed_sequences(spark, sf_dir):
    """All documents in sequences of at most 1024 tokens."""
    return packed(shared.table(spark, sf_dir, "documents"))
