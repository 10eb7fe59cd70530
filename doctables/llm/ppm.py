"""Scoring documents by prediction by partial matching over byte contexts.

Training counts every byte after its context of ORDER bytes, over all training documents: a task counts its n-grams with numpy,
Spark adds them up. Contexts of lower order are sums over the same counts. A byte not seen after a context escapes to the next
shorter one by method C (distinct / (total + distinct)); bytes seen there are excluded below. As the symbols of a context are
among those of its suffix, exclusion only needs, per context, the sum of its suffix's counts over its own symbols. After order 0
the bytes left are equally likely.

No n-gram is dropped. The scores of the most frequent ones, of a bounded number, are read by every task from the shared folder; the
n-grams of a text that are not among them go through a join with the scores of all, and those never seen in training through a join
with the contexts of each order.

The same pass gives the unigram score of words. Counts of words are exact: those of words that stand for more than
a share of all tokens are read by every task, the rest go through a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doctables.llm import shared

ORDER = 5
#: n-grams whose scores are read by every task, at most.
NODES = 1 << 21
#: Words read by every task stand for more than this share of the training tokens each; so at most 1 / share.
WORD_SHARE = 2.0**-18
END = b"\n"  # ends a text and stands before it; words hold no blanks, so it is no byte of theirs
BATCH_BYTES = 2 << 20
_HELD: dict[str, object] = {}


def _flat(texts: list[str | None]) -> tuple[list[list[bytes]], bytes, np.ndarray]:
    """(words, bytes, ends) of texts: lower-cased words with single spaces and an end, each text behind ORDER ends."""
    cut = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    parts = [END * ORDER + b" ".join(w) + END for w in cut]
    return cut, b"".join(parts), np.cumsum([len(p) for p in parts])


def codes_of(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram of ORDER + 1 bytes as a number for each byte of the texts, bytes of each text); the ends in front don't count."""
    b = np.frombuffer(data, np.uint8).astype(np.int64)
    code = np.zeros(len(b) - ORDER, np.int64)
    for k in range(ORDER + 1):
        code = (code << 8) | b[k : len(b) - ORDER + k]
    sizes = np.diff(np.concatenate([[0], ends])) - ORDER
    starts = np.concatenate([[0], ends[:-1]])
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return code[at], sizes


def counts_of(docs: DataFrame) -> DataFrame:
    """(word, code, n): counts of the words (code null) and of the n-grams (word null) of all texts; the end is the word ''."""
    flush = 1_500_000

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        grams: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def merged():
            code, inverse = np.unique(np.concatenate([g for g, _ in grams]), return_inverse=True)
            return code, np.bincount(inverse, np.concatenate([n for _, n in grams])).astype(np.int64)

        def rows():
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(words), pa.binary()), "code": pa.nulls(len(words), pa.int64()), "n": pa.array(list(words.values()), pa.int64())})
            code, n = merged()
            yield pa.RecordBatch.from_pydict({"word": pa.nulls(len(code), pa.binary()), "code": code, "n": n})

        for batch in shared.batches_of(it, "text", BATCH_BYTES):
            cut, data, ends = _flat(batch.column("text").to_pylist())
            for w in cut:
                words.update(w)
            words[b""] += len(cut)
            inverse, code = pd.factorize(codes_of(data, ends)[0])
            grams.append((code, np.bincount(inverse)))
            held += len(code)
            if held > flush:
                grams = [merged()]
                held = len(grams[0][0])
            if held > flush // 2 * 2 or len(words) > flush:
                yield from rows()
                words, grams, held = Counter(), [], 0
        if grams:
            yield from rows()

    return docs.select("text").mapInArrow(count, "word binary, code long, n long").groupBy("word", "code").agg(F.sum("n").alias("n"))


def _mask(order: int) -> int:
    """Bits of an n-gram's last order + 1 bytes."""
    return (1 << 8 * (order + 1)) - 1


def contexts_of(counts: DataFrame) -> DataFrame:
    """(ord, ctx, total, kinds, shadow, symbols) of every context of 0 to ORDER bytes: the sum of its counts, the number of its
    symbols, the sum of its suffix's counts over these, and the count of each."""
    grams = counts.filter("code is not null")
    orders = F.explode(F.array(*[F.struct(F.lit(k).alias("ord"), F.col("code").bitwiseAND(_mask(k)).alias("code")) for k in range(ORDER + 1)]))
    every = shared.written(grams.select("n", orders.alias("x")).groupBy("x.ord", "x.code").agg(F.sum("n").alias("n")), "grams")
    tail = F.lit(0)
    for k in range(1, ORDER + 1):
        tail = F.when(F.col("ord") == k, F.col("code").bitwiseAND(_mask(k - 1))).otherwise(tail)
    suffix = every.select((F.col("ord") + 1).alias("ord"), F.col("code").alias("tail"), F.col("n").alias("below"))
    return every.withColumn("tail", tail).join(suffix, ["ord", "tail"], "left").groupBy("ord", F.shiftright("code", 8).alias("ctx")).agg(
        F.sum("n").alias("total"),
        F.count("*").alias("kinds"),
        F.coalesce(F.sum("below"), F.lit(0)).alias("shadow"),
        F.map_from_entries(F.collect_list(F.struct(F.col("code").bitwiseAND(255).alias("symbol"), "n"))).alias("symbols"),
    )


def seen_in(contexts: DataFrame) -> DataFrame:
    """(code, n, log): log10 probability of the last byte of every n-gram that occurs in training."""
    last = contexts.filter(F.col("ord") == ORDER).select("ctx", (F.col("total") + F.col("kinds")).alias("all"), F.explode("symbols").alias("symbol", "n"))
    return last.select((F.shiftleft("ctx", 8) + F.col("symbol")).alias("code"), "n", F.log10(F.col("n") / F.col("all")).alias("log"))


def escaped(codes: DataFrame, contexts: DataFrame) -> DataFrame:
    """(code, log): log10 probability of the last byte of each n-gram (code) after the others, whether it occurs in training or not."""
    symbol = F.col("code").bitwiseAND(255)
    left = codes.select("code", F.lit(0.0).alias("log"), F.lit(False).alias("done"), F.lit(0).cast("long").alias("out"), F.lit(0).cast("long").alias("gone"))
    for k in range(ORDER, -1, -1):
        own = contexts.filter(F.col("ord") == k).select("ctx", "total", "kinds", "shadow", "symbols")
        if k < 2:  # at most 257 contexts: their number doesn't grow with the texts
            own = F.broadcast(own)
        met = left.withColumn("ctx", F.shiftright(F.col("code").bitwiseAND(_mask(k)), 8)).join(own, "ctx", "left")
        # of the context without the symbols excluded: out and gone are their counts and their number
        met = met.withColumn("kinds_", F.col("kinds") - F.col("gone")).withColumn("all_", F.col("total") - F.col("out") + F.col("kinds_")).withColumn("n", F.col("symbols")[symbol])
        step = F.when(F.col("n").isNotNull(), F.log10(F.col("n") / F.col("all_"))).when(F.col("kinds_") > 0, F.log10(F.col("kinds_") / F.col("all_"))).otherwise(0.0)
        left = met.select(
            "code",
            F.when(F.col("done"), F.col("log")).otherwise(F.col("log") + step).alias("log"),  # without symbols left the escape is certain
            (F.col("done") | F.col("n").isNotNull()).alias("done"),
            F.coalesce("shadow", F.lit(0)).alias("out"),
            F.coalesce("kinds", F.lit(0)).alias("gone"),
        )
    rest = F.log10(F.greatest(F.lit(1), 256 - F.col("gone")).cast("double"))
    return left.select("code", F.when(F.col("done"), F.col("log")).otherwise(F.col("log") - rest).alias("log"))


def least_count(seen: DataFrame, nodes: int) -> int:
    """The least power of two such that at most `nodes` n-grams have that count."""
    kept = 0
    sizes = seen.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()  # a row per power of two
    for r in sorted(sizes, key=lambda r: -r.bits):
        kept += r["count"]
        if kept > nodes:
            return 1 << r.bits
    return 1


class Often:
    """Scores of the most frequent n-grams, as sorted arrays."""

    def __init__(self, folder: str) -> None:
        table = _table(folder)
        code, log = table["code"].to_numpy(), table["log"].to_numpy()
        by = np.argsort(code)
        self.code, self.log = code[by], log[by]

    def scores(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score of each n-gram, 0 for the others, positions of the others)."""
        if not len(self.code):
            return np.zeros(len(code)), np.arange(len(code))
        inverse, own = pd.factorize(code)
        at = np.minimum(np.searchsorted(self.code, own), len(self.code) - 1)
        there = self.code[at] == own
        return np.where(there, self.log[at], 0.0)[inverse], np.flatnonzero(~there[inverse]) if not there.all() else np.zeros(0, np.int64)


def _lists(doc: np.ndarray, code: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Distinct codes of each of n documents, and how often each occurs there."""
    by = np.lexsort((code, doc))
    doc, code = doc[by], code[by]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])])) if len(doc) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(doc)))
    ends = pa.array(np.append(0, np.cumsum(np.bincount(doc[first], minlength=n))), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(code[first], pa.int64())), pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))


def _table(folder: str) -> pa.Table:
    """A written table of bounded size, read in a task."""
    where, path = shared.file_system(folder)
    return pq.read_table(path, filesystem=where)


def _held(key: str, make):
    """One loaded model of each kind per worker."""
    kind = key.split("|")[0]
    for old in [k for k in _HELD if k.startswith(kind + "|") and k != key]:
        del _HELD[old]
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def scored(docs: DataFrame, training: DataFrame, nodes: int = NODES, share: float = WORD_SHARE) -> DataFrame:
    """docs (doc_id, text, ...) with n_tokens, n_known, train_tokens, base_score and score added, one row per row of docs.

    Columns of docs with those names are replaced. Null and empty texts have one token, their end. Without training rows nothing is known
    and every byte is equally likely. Rows may repeat.
    """
    spark = docs.sparkSession
    counts = shared.written(counts_of(training), "counts")
    contexts = shared.written(contexts_of(counts), "contexts")
    seen = seen_in(contexts)
    least = least_count(seen, nodes)
    folder = shared.new_folder(spark, "grams")
    seen.filter(F.col("n") >= least).select("code", "log").repartition(8, "code").write.parquet(folder)
    words = counts.filter("word is not null").select("word", "n")
    n_all, n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    half = 0.5
    low = n_all + half * (n_words + 1)
    often = shared.new_folder(spark, "words")
    bound = max(1.0, n_all * share)
    words.filter(F.col("n") > bound).coalesce(1).write.parquet(often)
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    base = docs.drop(*added)

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _held(f"grams|{folder}", lambda: Often(folder))
        known = _held(f"words|{often}", lambda: dict(zip(*(_table(often)[c].to_pylist() for c in ("word", "n")))))
        row = TaskContext.get().partitionId() << 40
        for batch in shared.batches_of(it, "text", BATCH_BYTES):
            cut, data, ends = _flat(batch.column("text").to_pylist())
            code, sizes = codes_of(data, ends)
            logs, others = model.scores(code)
            total = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
            grams, gram_times = _lists(np.searchsorted(np.cumsum(sizes), others, "right"), code[others], len(cut))
            n_known, sums, rare, times = [], [], [], []
            for w in cut:
                w.append(b"")
                mine, hits, logs = Counter(), 0, []
                for x in w:
                    n = known.get(x)
                    if n is None:
                        mine[x] += 1
                    else:
                        hits += 1
                        logs.append(n)
                n_known.append(hits)
                sums.append(float(np.log10((np.array(logs) + half) / low).sum()) if logs else 0.0)
                rare.append(list(mine))
                times.append(list(mine.values()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.arange(row, row + len(cut))), pa.array([len(w) for w in cut]), pa.array(n_known, pa.int64()), pa.array(sums), pa.array(total), pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64())), grams, gram_times],
                [*batch.schema.names, "row_", "n_tokens", "known_", "sum_", "log_", "rare_", "times_", "grams_", "gram_times_"],
            )
            row += len(cut)

    extra = "row_ long, n_tokens long, known_ long, sum_ double, log_ double, rare_ array<binary>, times_ array<long>, grams_ array<long>, gram_times_ array<long>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema), extra])
    first = shared.written(base.mapInArrow(score, schema).drop("text"), "scored")
    rest = first.select("row_", F.explode(F.arrays_zip("rare_", "times_")).alias("x")).select("row_", F.col("x.rare_").alias("word"), F.col("x.times_").alias("times"))
    n = F.coalesce("n", F.lit(0))
    rest = rest.join(words.filter(F.col("n") <= bound), "word", "left").groupBy("row_").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_"), F.sum(F.col("times") * F.log10((n + half) / F.lit(float(low)))).alias("add_")
    )
    pairs = first.select("row_", F.explode(F.arrays_zip("grams_", "gram_times_")).alias("x")).select("row_", F.col("x.grams_").alias("code"), F.col("x.gram_times_").alias("times"))
    codes = shared.written(pairs.select("code").distinct().join(seen.filter(F.col("n") < least).select("code", "log"), "code", "left"), "codes")
    logs = codes.filter("log is not null").unionByName(escaped(codes.filter("log is null"), contexts))
    grams = pairs.join(logs, "code").groupBy("row_").agg(F.sum(F.col("times") * F.col("log")).alias("gram_add_"))
    out = first.drop("rare_", "times_", "grams_", "gram_times_").join(rest, "row_", "left").join(grams, "row_", "left")
    return out.select(
        *[c for c in base.columns if c != "text"],
        "n_tokens",
        (F.col("known_") + F.coalesce("more_", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("sum_") + F.coalesce("add_", F.lit(0.0))).alias("base_score"),
        (F.col("log_") + F.coalesce("gram_add_", F.lit(0.0))).alias("score"),
    )


def op10_ppm_scores(spark, sf_dir):
    """All documents, scored by what those not held out have taught."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", shared.remainder(F.col("doc_id"), 5) == 1)
    return scored(docs, docs.filter("not held_out"))
