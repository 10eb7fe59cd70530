"""Phrase collocations by marginalising counted lead windows.

1. Words, then pairs of such words, then triples of such pairs are counted over all documents by 64-bit key; those that
   reach the minimum become bitmaps of a fixed size. A bit may stand for several of them (it then only lets more
   windows through), but none that reaches the minimum is without its bit. So a window may end early, before a word
   that no phrase of the minimum count can hold, and nothing that counts is lost.
2. At each remaining position the word and its leads form the columns w1 ... w5 of the longest window, padded with
   empty text past the end. Only these windows are counted.
3. One ROLLUP over (lang, w1, ..., w5) sums the windows by each shorter prefix: a phrase occurs as often as windows
   begin with it. No n-grams of other lengths are ever made.
4. Phrases are few now: cuts, parts and containment are joins on them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from doctables.llm import shared
from doctables.llm.wordarrays import BATCH_BYTES, Words, classes, words_of

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: A phrase falls when a longer candidate around it has at least this per cent of its count.
HELD_BY = 100
#: Longest runs counted before the windows.
RUNS = 3
#: Bits of each bitmap: 8 MB, whatever the corpus.
BITMAP_BITS = 26
#: Keys or distinct windows a task holds before it hands out its sums.
HELD = 1_000_000
#: Bits of a word's number within a task; three numbers share a 64-bit integer.
NUMBER_BITS = 21
PIECES = classes(b" \t", b".,;:!?\n\x0b\x0c\r")
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * ODD[1]
    h = (h ^ (h >> np.uint64(27))) * ODD[2]
    return h ^ (h >> np.uint64(31))


class _Batch:
    """Words of a batch with the key of (lang, word) at each position."""

    def __init__(self, batch: pa.RecordBatch):
        from xxhash import xxh3_64_intdigest

        self.langs = batch.column("lang").dictionary_encode()
        self.words: Words = words_of(batch.column("text"), PIECES)
        self.lang = self.langs.indices.to_numpy()[self.words.row] if len(batch) else np.zeros(0, np.int64)
        known = np.array([xxh3_64_intdigest(w) for w in self.words.known], np.uint64)
        spoken = np.array([xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"), 1) for x in self.langs.dictionary.to_pylist()], np.uint64)
        self.key = _mixed(known[self.words.of] * ODD[0] + spoken[self.lang]) if len(self.words.of) else np.zeros(0, np.uint64)

    def runs(self, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a run of len(held) + 1 words of one piece begins whose shorter runs all have their bits,
        and the keys of these runs; held has the bitmaps of runs of 1, 2, ... words."""
        piece = self.words.piece
        at, key = np.arange(len(self.key)), self.key
        for size, bits in enumerate(held, 1):
            has = np.zeros(len(piece) + 1, bool)
            has[at[_marked(bits, key)]] = True
            at = np.flatnonzero(has[:-1] & has[1:])
            at = at[at + size < len(piece)]
            at = at[piece[at + size] == piece[at]]
            key = self.key[at]
            for i in range(1, size + 1):
                key = _mixed(key * ODD[1] + self.key[at + i] + ODD[0])
        return at, key


def _marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys & np.uint64((1 << BITMAP_BITS) - 1)
    return (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _batches(it: Iterator[pa.RecordBatch]) -> Iterator[_Batch]:
    for batch in shared.batches_of(it, "text", BATCH_BYTES):
        yield _Batch(batch)


def _summed(keys: list[np.ndarray]) -> pa.RecordBatch:
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return pa.RecordBatch.from_pydict({"lang": pa.nulls(len(key), pa.string()), "key": key.view(np.int64), "count": count.astype(np.int64)})


def _counts(docs: DataFrame, keys_of) -> DataFrame:
    """(lang, key, count): sums of the keys that keys_of gives for each batch (lang null), and words by lang (key null)."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, total = [], 0, {}
        for batch in _batches(it):
            spoken = np.bincount(batch.lang, minlength=len(batch.langs.dictionary))
            for lang, c in zip(batch.langs.dictionary.to_pylist(), spoken.tolist()):
                total[lang] = total.get(lang, 0) + c
            held.append(keys_of(batch))
            n += len(held[-1])
            if n > HELD:
                yield _summed(held)
                held, n = [], 0
        if held:
            yield _summed(held)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "key": pa.nulls(len(total), pa.int64()), "count": pa.array(list(total.values()), pa.int64())})

    return docs.mapInArrow(count, "lang string, key long, count long").groupBy("lang", "key").agg(F.sum("count").alias("count"))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the keys, built in Spark; the driver gets at most 2^BITMAP_BITS bits."""
    bit = F.col("key").bitwiseAND((1 << BITMAP_BITS) - 1)
    rows = keys.select((bit + 1).alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("no"))
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for row in rows.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).toLocalIterator():
        out[(row.no - 1) * 4096 : row.no * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def _sent(spark: SparkSession, bits: np.ndarray):
    return spark.sparkContext.broadcast(bits.tobytes())


def windows(docs: DataFrame, sent: list, max_words: int) -> DataFrame:
    """(lang, w1, ..., count): longest windows of words whose runs have their bits, each task's summed."""
    names = [f"w{i + 1}" for i in range(max_words)]
    width = -(-(max_words + 1) // 3)

    def packed(columns: list[np.ndarray]) -> np.ndarray:
        """Numbers of lang and words, three to an integer."""
        out = np.zeros((width, len(columns[0])), np.uint64)
        for i, c in enumerate(columns):
            out[i // 3] |= c.astype(np.uint64) << np.uint64(NUMBER_BITS * (2 - i % 3))
        return out

    def lead(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(x.value, np.uint8) for x in sent]
        ids: dict[bytes, int] = {b"": 0}
        langs: dict[str, int] = {}
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merge():
            """Equal windows become one row; compared number by number, never by a hash."""
            nonlocal size
            table, count = np.concatenate([t for t, _ in rows], axis=1), np.concatenate([c for _, c in rows])
            order = np.lexsort(table)
            table = table[:, order]
            first = np.flatnonzero(np.append(True, (table[:, 1:] != table[:, :-1]).any(axis=0)))
            rows[:] = [(table[:, first], np.add.reduceat(count[order], first))]
            size = len(first)

        def out():
            if not size:
                return
            merge()
            (table, count), = rows
            known, spoken = pa.array(list(ids), pa.binary()).cast(pa.string()), pa.array(list(langs), pa.string())
            for a in range(0, size, 1 << 16):
                part = table[:, a : a + (1 << 16)]
                number = lambda i: pa.array((part[i // 3] >> np.uint64(NUMBER_BITS * (2 - i % 3)) & np.uint64((1 << NUMBER_BITS) - 1)).astype(np.int64))
                cols = {"lang": spoken.take(number(0))} | {c: known.take(number(i)) for i, c in enumerate(names, 1)}
                yield pa.RecordBatch.from_pydict(cols | {"count": count[a : a + (1 << 16)]})

        for batch in _batches(it):
            if len(ids) + len(batch.words.known) >= 1 << NUMBER_BITS or size > HELD:
                if size:
                    merge()
                if len(ids) + len(batch.words.known) >= 1 << NUMBER_BITS or size > HELD // 2:
                    yield from out()
                    rows, ids, size = [], {b"": 0}, 0
            goes = [np.zeros(len(batch.key) + 1, bool) for _ in held]
            for k in range(len(held)):
                at, key = batch.runs(held[:k])
                goes[k][at[_marked(held[k], key)]] = True
            begins = np.flatnonzero(goes[0])
            if not len(begins):
                continue
            used = np.flatnonzero(np.bincount(batch.words.of[begins], minlength=len(batch.words.known)))
            to = np.zeros(len(batch.words.known), np.int64)
            to[used] = [ids.setdefault(batch.words.known[i], len(ids)) for i in used.tolist()]
            tongue = np.array([langs.setdefault(x, len(langs)) for x in batch.langs.dictionary.to_pylist()], np.int64)
            alone = begins[~goes[1][begins]] if max_words > 1 else begins
            single = np.bincount(batch.lang[alone] * len(to) + batch.words.of[alone], minlength=len(to))
            some = np.flatnonzero(single)
            rows.append((packed([tongue[some // len(to)], to[some % len(to)]]), single[some]))
            at = begins[goes[1][begins]] if max_words > 1 else begins[:0]
            columns = [tongue[batch.lang[at]], to[batch.words.of[at]]] + [np.zeros(len(at), np.int64) for _ in range(max_words - 1)]
            on = np.arange(len(at))
            for k in range(1, max_words):
                # word k + 1 joins when the longest counted run that it ends has its bit
                run = min(k + 1, len(held))
                on = on[goes[run - 1][at[on] + k + 1 - run]]
                columns[k + 1][on] = to[batch.words.of[at[on] + k]]
            rows.append((packed(columns), np.ones(len(at), np.int64)))
            size += len(some) + len(at)
        yield from out()

    return docs.mapInArrow(lead, f"lang string, {', '.join(c + ' string' for c in names)}, count long")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, words array, a) of every phrase of 1 to max_words words with a >= min_count, and (lang, n) of all words."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit("und")).cast("string").alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    enough = F.col("key").isNull() | (F.col("count") >= min_count)
    counted = shared.written(_counts(docs, lambda b: b.key).filter(enough), "word-counts")
    sent = [_sent(spark, _bitmap(counted.filter("key is not null")))]
    for _ in range(min(max_words, RUNS) - 1):
        runs = _counts(docs, lambda b, sent=tuple(sent): b.runs([np.frombuffer(x.value, np.uint8) for x in sent])[1])
        sent.append(_sent(spark, _bitmap(shared.written(runs.filter("key is not null").filter(enough), "run-counts"))))
    names = [f"w{i + 1}" for i in range(max_words)]
    top = windows(docs, sent, max_words).groupBy("lang", *names).agg(F.sum("count").alias("count"))
    rolled = top.rollup("lang", *names).agg(F.sum("count").alias("a"), F.grouping_id().alias("over"))
    # prefix of k words: the last max_words - k columns are summed over; its last word is no padding
    real = F.lit(False)
    for k, c in enumerate(names, 1):
        real = real | ((F.col("over") == (1 << (max_words - k)) - 1) & (F.col(c) != ""))
    words = F.filter(F.array(*names), lambda x: x.isNotNull())
    phrases = rolled.filter(real & (F.col("a") >= min_count)).select("lang", words.alias("words"), "a")
    return shared.written(phrases, "phrases"), counted.filter("key is null").select("lang", F.col("count").alias("n"))


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, held_by: int = HELD_BY
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each lang of docs (lang, text).

    Texts are cut at `[.,;:!?\\n-\\r]` into pieces, and those at blanks and tabs into words; A-Z count as a-z. A phrase of
    2 to max_words words is a candidate when it occurs min_count times. Cut after k words, its score is
    floor(1000 * a * n / (l * r)), with a, l, r the counts of phrase, first part and rest, and n all words of the lang;
    the lowest cut counts, the first of equal ones. Candidates inside a longer one of held_by per cent of their count go.
    Null lang counts as `und`, null text as empty; empty tables give no rows; repeated rows count each time, and
    other columns, whatever their names, are ignored. Ranks of equal scores go by count, then by the phrase's bytes.
    """
    known, totals = phrase_counts(docs, min_count, max_words)
    joined = lambda words: F.concat_ws(" ", words)
    part = known.select("lang", joined("words").alias("part"), F.col("a").alias("times"))
    found = known.filter(F.size("words") > 1).withColumn("phrase", joined("words"))
    cuts = found.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.expr("slice(words, 1, k)")).alias("first"), joined(F.expr("slice(words, k + 1, size(words))")).alias("rest"))
    cuts = cuts.join(part.withColumnsRenamed({"part": "first", "times": "l"}), ["lang", "first"])
    cuts = cuts.join(part.withColumnsRenamed({"part": "rest", "times": "r"}), ["lang", "rest"]).join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(38,0)") * big("a") * big("n"), big("l") * big("r"))
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n")
    )
    inner = "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> concat_ws(' ', slice(words, i, m)))))"
    around = found.filter(F.size("words") > 2).select("lang", F.explode(F.expr(inner)).alias("phrase"), F.col("a").alias("by"))
    around = around.groupBy("lang", "phrase").agg(F.max("by").alias("by"))
    kept = best.join(around, ["lang", "phrase"], "left").filter(F.col("by").isNull() | (100 * F.col("by") < held_by * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op12_collocations(spark, sf_dir):
    """The 2000 best phrases of each language of all documents."""
    return collocations(shared.table(spark, sf_dir, "documents"))


ORACLE = {
    "op12_collocations": """WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM cut, (SELECT unnest(range(1, 6)) AS k)),
f AS (SELECT lang, k AS size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (SELECT c.lang, c.phrase, c.a, x.l, x.r, t.n, x.k, CAST((c.a::HUGEINT * 1000 * t.n) // (x.l::HUGEINT * x.r) AS BIGINT) AS score
  FROM c JOIN total t USING (lang) JOIN (
    SELECT b.lang, b.phrase, b.k, p.a AS l, q.a AS r FROM (SELECT lang, phrase, w, unnest(range(1, size)) AS k FROM c) b
    JOIN f p ON p.lang = b.lang AND p.phrase = array_to_string(b.w[1:b.k], ' ')
    JOIN f q ON q.lang = b.lang AND q.phrase = array_to_string(b.w[b.k + 1:], ' ')) x ON x.lang = c.lang AND x.phrase = c.phrase),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT lang, a, w, size, unnest(range(2, size)) AS m FROM c WHERE size > 2),
inside AS (SELECT lang, a, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM spans),
around AS (SELECT lang, phrase, max(a) AS by FROM inside GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.by IS NULL OR 100 * o.by < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""
}
