"""Near duplicates by HyperMinHash: leading-zero counts and mantissa bits of bucket minima, banded and corrected.

1. A document's set holds 64-bit hashes of its word shingles. The first 8 bits of a hash name one of 256 buckets; of the
   rest the bucket keeps its minimum, as count of leading zeros and the 10 bits behind the leading one (16 bits in all).
2. Equal sets form a class, stood for by its smallest doc_id; all further steps work on classes.
3. Bands of 7 registers: classes that agree in a band (not empty in both) are candidates. At similarity 0.85 a pair
   of large sets misses all 36 bands with probability 1e-6, small sets more rarely still.
4. In each band bucket the classes are paired with the class that shares most bands with others. Pairs whose estimated
   similarity, corrected for registers that agree by chance, may reach the threshold are verified on their full sets.
5. Links close to components. In a bucket that still holds several of them, classes outside the largest are paired
   with one of the largest, another one in each bucket, so that a class of a loose group meets many.
6. In buckets that even then hold several components, every class outside the largest is compared by registers with all
   classes of other components, each pair in the first bucket that it shares; plausible pairs are verified. Pairs inside
   a component could add nothing. Comparisons run in tiles of bounded size and give out plausible pairs only.
Before estimates, pairs pass a bitmap of the parity of hashes by bucket: two of them differ in at most as many bits as
the sets in elements, so it rules out pairs for certain.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doctables.llm import shared
from doctables.llm.components import connected, merged
from doctables.llm.wordarrays import BATCH_BYTES, words_of

SHINGLE = 3
THRESHOLD = (85, 100)
BUCKET_BITS = 8
REGISTERS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
#: Bits behind the bucket's that a register sees; a float holds them exactly.
SEEN_BITS = 53
BAND = 7
BANDS = REGISTERS // BAND
#: Most bits of a parity bitmap; sets of up to half of it have two to four bits an element.
PARITY_BITS = 8192
#: Standard errors an estimate may lie below the threshold.
ERRORS = 5.0
#: Classes of a bucket that a task compares others with at a time; larger buckets are dealt in as many stretches as it takes.
STRETCH = 8192
#: Rounds of step 5; more only save comparisons in step 6.
MORE_HUBS = 1
ODD = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(64)], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the sorted distinct shingle hashes of each text, one after the other, and where each text's end.

    A text of fewer than k words gives one hash of all its words, a text without words none.
    """
    from xxhash import xxh3_64_intdigest

    words = words_of(texts)
    if not len(words.of):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    h = np.array([xxh3_64_intdigest(w) for w in words.known], np.uint64)[words.of]
    row = words.row
    n = np.bincount(row, minlength=len(texts))
    full = max(0, len(h) - k + 1)
    rolled = np.zeros(full, np.uint64)
    for i in range(k):
        rolled += h[i : i + full] * ODD[i]
    inside = row[:full] == row[k - 1 :]
    of, hashes = row[:full][inside], _mixed(rolled[inside])
    few = np.flatnonzero((n > 0) & (n < k))
    if len(few):
        begin = (np.cumsum(n) - n)[few]
        total = n[few].astype(np.uint64)
        for i in range(k - 1):
            there = n[few] > i
            total[there] += h[begin[there] + i] * ODD[k + i]
        of, hashes = np.append(of, few), np.append(hashes, _mixed(total))
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.append(True, (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1]))
    return hashes[new], np.cumsum(np.bincount(of[new], minlength=len(texts)))


def registers(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Registers (a row of REGISTERS numbers) of each set: 0 for an empty bucket, else (zeros + 1) and mantissa."""
    out = np.zeros((len(ends), REGISTERS), np.uint16)
    if len(hashes):
        of = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        # sets are sorted, so the first hash of a bucket is its minimum
        first = np.append(True, (of[1:] != of[:-1]) | (bucket[1:] != bucket[:-1]))
        rest = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(64 - SEEN_BITS)
        zeros = SEEN_BITS - np.frexp(rest.astype(np.float64))[1].astype(np.int64)
        shift = (zeros + 1).astype(np.uint64)
        mantissa = ((rest << shift) & np.uint64((1 << SEEN_BITS) - 1)) >> np.uint64(SEEN_BITS - MANTISSA_BITS)
        out[of[first], bucket[first]] = ((zeros + 1) << MANTISSA_BITS) | mantissa.astype(np.int64)
    return out


def bands(regs: np.ndarray) -> np.ndarray:
    """Keys of the BANDS bands of every row, made of the band's number and registers; 0 for a band that is all empty."""
    cut = regs[:, : BANDS * BAND].reshape(len(regs), BANDS, BAND)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * ODD[BAND]
    for i in range(BAND):
        key = key + cut[:, :, i] * ODD[i]
    return np.where(cut.any(axis=2), _mixed(key) | np.uint64(1), np.uint64(0))


def parity(hashes: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set as 64-bit words, a power of two of them."""
    bits = min(PARITY_BITS, max(64, 2 << max(0, len(hashes) - 1).bit_length()))
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64)


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of words) as bitmaps of fewer words."""
    return np.bitwise_xor.reduce(words.reshape(*words.shape[:-1], -1, size), axis=-2)


def may_link(x: np.ndarray, y: np.ndarray, n_x, n_y, threshold: tuple[int, int]) -> np.ndarray:
    """Whether bitmaps x (rows of words) and y (one row) leave room for a link of sets of n_x and n_y elements."""
    num, den = threshold
    size = min(x.shape[-1], y.shape[-1])
    differ = np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum(axis=-1, dtype=np.int64)
    # |A and B| >= num / (num + den) of all, so at most (den - num) / (num + den) of all lie in one set alone
    return (num + den) * differ <= (den - num) * (n_x + n_y)


@functools.lru_cache(4096)
def _chance(quarter: int) -> float:
    """Chance that a bucket that two disjoint sets of about 2^(quarter / 4) elements fill agrees in its register."""
    zeros = np.arange(SEEN_BITS - MANTISSA_BITS)[:, None]
    step = 2.0 ** -(zeros + 1 + MANTISSA_BITS)
    low = 2.0 ** -(zeros + 1) + np.arange(1 << MANTISSA_BITS)[None, :] * step
    n = 2.0 ** (quarter / 4)
    cell = np.exp(n * np.log1p(-low / REGISTERS)) - np.exp(n * np.log1p(-(low + step) / REGISTERS))
    return float((cell**2).sum() / (1 - np.exp(2 * n * np.log1p(-1 / REGISTERS))))


def plausible(x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    """Whether the rows of registers x and y (sets of n_x and n_y) may belong to sets of at least the threshold.

    Registers of different elements agree by chance; that share is taken out of the registers that agree.
    """
    num, den = threshold
    t = num / den
    small, large = np.minimum(n_x, n_y), np.maximum(n_x, n_y)
    filled = np.maximum(np.count_nonzero(x | y, axis=-1), 1)
    seen = np.count_nonzero((x == y) & (x != 0), axis=-1) / filled
    quarter = np.round(4 * np.log2(np.maximum(small, 1))).astype(np.int64)
    table = np.zeros(int(quarter.max(initial=0)) + 1)
    for q in set(quarter.tolist()):
        table[q] = _chance(q)
    similar = (seen - table[quarter]) / (1 - table[quarter])
    return (similar >= t - ERRORS * np.sqrt(t * (1 - t) / filled)) & (den * small >= num * large)


def sketches(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n, key, regs, bits) of each row of docs (doc_id, text); key stands for the whole set."""

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in shared.batches_of(it, "text", BATCH_BYTES):
            hashes, ends = shingle_sets(batch.column("text"), k)
            begins = np.append(0, ends[:-1])
            each = [hashes[a:b] for a, b in zip(begins.tolist(), ends.tolist())]
            regs = registers(hashes, ends)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": (ends - begins).astype(np.int64), "key": pa.array([xxh3_128_digest(x.tobytes()) for x in each], pa.binary()),
                "regs": pa.array([r.tobytes() for r in regs], pa.binary()), "bits": pa.array([parity(x).tobytes() for x in each], pa.binary()),
            })

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(sketch, "doc_id long, n long, key binary, regs binary, bits binary")


def _table(column: pa.Array) -> np.ndarray:
    """Registers of a column as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _words(bits: bytes) -> np.ndarray:
    return np.frombuffer(bits, np.uint64)


def _posted(nodes: DataFrame) -> DataFrame:
    """(key, rep) of every band of every class."""

    def post(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rep = batch.column("rep").to_numpy()
            for a in range(0, len(rep), 2048):
                keys = bands(_table(batch.column("regs").slice(a, 2048)))
                row, band = np.nonzero(keys)
                yield pa.RecordBatch.from_pydict({"key": keys[row, band].view(np.int64), "rep": rep[a + row]})

    return nodes.select("rep", "regs").mapInArrow(post, "key long, rep long")


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of classes whose bitmaps and registers allow a link."""

    def may(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                sides = zip(*(part.column(c).to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b")))
                part = part.filter(pa.array([bool(may_link(_words(x), _words(y), n, m, threshold)) for x, y, n, m in sides], pa.bool_()))
                n_a, n_b = part.column("n_a").to_numpy(), part.column("n_b").to_numpy()
                keep = plausible(_table(part.column("regs_a")), _table(part.column("regs_b")), n_a, n_b, threshold)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    num, den = threshold
    size = lambda x: nodes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"))
    side = lambda x: nodes.select(F.col("rep").alias(x), F.col("regs").alias(f"regs_{x}"), F.col("bits").alias(f"bits_{x}"))
    # sizes first: they are short, and rule out many pairs
    near = pairs.join(size("a"), "a").join(size("b"), "b").filter(den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")).distinct()
    return near.join(side("a"), "a").join(side("b"), "b").mapInArrow(may, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, threshold: tuple[int, int], k: int = SHINGLE) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold; only documents of the pairs bring their texts."""
    num, den = threshold
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(ids, "doc_id", "left_semi")
    texts = shared.written(texts, "pair-texts")

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))
        for batch in it:
            for part in shared.batches_of(iter([batch]), "text_a", BATCH_BYTES):
                hashes, ends = shingle_sets(part.column("text_a"), k)
                keep = []
                for a, e, other in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), part.column("text_b")):
                    other = other.as_py()
                    if other != last[0]:  # rows come sorted by b
                        last = (other, shingle_sets(pa.array([other], pa.binary()), k)[0])
                    both = np.intersect1d(hashes[a:e], last[1], assume_unique=True).size
                    keep.append(den * both >= num * (e - a + len(last[1]) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(check, "a long, b long").distinct()


def _across(mixed: DataFrame, nodes: DataFrame, threshold: tuple[int, int], stretch: int) -> DataFrame:
    """Plausible pairs of classes of one bucket in different components; mixed has key, rep, component, main.

    A bucket is a table of tiles: classes outside its main component are held, `stretch` at a time, and its classes
    stream past them, eight times as many at a time. So a bucket of any size is spread over tasks of bounded memory.
    """
    outside = F.col("component") != F.col("main")
    sizes = mixed.groupBy("key").agg(
        F.ceil(F.count(F.when(outside, 1)) / stretch).alias("held"), F.ceil(F.count("*") / (8 * stretch)).alias("parts")
    )
    dealt = mixed.withColumn("outside", outside).join(sizes, "key").withColumn("own", F.xxhash64("rep"))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    held = dealt.filter("outside").select("key", F.expr("pmod(own, held)").alias("no"), F.explode(upto("parts")).alias("part"), F.lit(0).alias("side"), "outside", "rep", "component")
    probes = dealt.select("key", F.explode(upto("held")).alias("no"), F.expr("pmod(own, parts)").alias("part"), F.lit(1).alias("side"), "outside", "rep", "component")
    rows = held.unionByName(probes).join(nodes.select("rep", "n", "regs", "bits"), "rep")

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hold = None, None

        def pairs(probe):
            """Probes against the held classes; a pair meets in the first of its buckets, and there once."""
            out = []
            words = np.array([len(x) for x in hold["bits"]])
            maps = {w: np.frombuffer(b"".join(hold["bits"][words == w]), np.uint64).reshape(-1, w // 8) for w in set(words.tolist())}
            place = np.empty(len(words), np.int64)
            for w in maps:
                place[words == w] = np.arange(len(maps[w]))
            earlier = int(np.argmax(hold["bands"][0] == np.uint64(now[0] & ((1 << 64) - 1))))
            for i in range(len(probe["rep"])):
                far = hold["component"] != probe["component"][i]
                if probe["outside"][i]:
                    far &= hold["rep"] < probe["rep"][i]
                at = np.flatnonzero(far)
                mine = probe["bands"][i, :earlier]
                at = at[~((hold["bands"][at, :earlier] == mine) & (mine != 0)).any(axis=1)]
                near = np.zeros(len(at), bool)
                for w in set(words[at].tolist()):
                    some = words[at] == w
                    near[some] = may_link(maps[w][place[at[some]]], _words(probe["bits"][i]), hold["n"][at[some]], probe["n"][i], threshold)
                at = at[near]
                if len(at):
                    at = at[plausible(hold["regs"][at], probe["regs"][i][None, :], hold["n"][at], probe["n"][i], threshold)]
                    out += [(x, int(probe["rep"][i])) for x in hold["rep"][at].tolist()]
            return out

        for batch in it:
            key, no, part, side = (batch.column(c).to_numpy() for c in ("key", "no", "part", "side"))
            new = (key[1:] != key[:-1]) | (no[1:] != no[:-1]) | (part[1:] != part[:-1]) | (side[1:] != side[:-1])
            cuts = np.flatnonzero(np.append(True, new))
            for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(key)).tolist()):
                some = batch.slice(a, b - a)
                cols = {c: some.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "component", "n", "outside", "bits")} | {"regs": _table(some.column("regs"))}
                cols["bands"] = bands(cols["regs"])
                if (int(key[a]), no[a], part[a]) != now:
                    now, hold = (int(key[a]), no[a], part[a]), None
                if side[a] == 0:
                    hold = cols if hold is None else {c: np.concatenate([hold[c], cols[c]]) for c in cols}
                elif hold is not None:
                    found = pairs(cols)
                    yield pa.RecordBatch.from_pydict({"a": np.array([x for x, _ in found], np.int64), "b": np.array([y for _, y in found], np.int64)})

    tiles = rows.repartition(shared.partitions(mixed.sparkSession), "key", "no", "part").sortWithinPartitions("key", "no", "part", "side")
    return tiles.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, k: int = SHINGLE, stretch: int = STRETCH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text), for links of at least the threshold.

    component_id is the smallest doc_id reachable by links, kept whether it is the row's own. Null and word-less texts
    have an empty set and stand alone. Rows that repeat a doc_id count as one document with any of its texts. A null
    doc_id links with nothing, has a null component and is kept. Other columns are ignored; an empty table gives no rows.
    """
    made = shared.written(sketches(docs, k), "sketches")
    real = made.filter("n > 0 and doc_id is not null")
    classes = real.groupBy("key").agg(F.min("doc_id").alias("rep"))
    of_class = shared.written(real.select("doc_id", "key").join(classes, "key"), "classes")
    heads = of_class.filter("doc_id = rep").select("doc_id", "key").distinct()
    nodes = real.join(heads, ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    nodes = shared.written(nodes.select(F.col("doc_id").alias("rep"), "n", "regs", "bits"), "nodes")

    posted = _posted(nodes).distinct()
    sizes = posted.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    posted = shared.written(posted.join(sizes, "key"), "bands")
    degree = posted.groupBy("rep").agg(F.sum("size").alias("degree"))
    hubs = posted.join(degree, "rep").groupBy("key").agg(F.max_by("rep", F.struct("degree", -F.col("rep"))).alias("b"))
    star = posted.join(hubs, "key").filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    star = shared.written(_estimated(star, nodes, threshold), "pairs")
    # a doc_id with several texts joins their classes
    of_doc = of_class.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("last"))
    several = of_class.join(of_doc.filter("rep < last").select("doc_id", F.col("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b"))
    comp = shared.written(connected(shared.written(verified(star, docs, threshold, k).union(several), "links")), "components")

    def mixed(comp: DataFrame) -> DataFrame:
        """(key, rep, component, main) of the buckets that hold several components; main is the largest there."""
        placed = posted.select("key", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        placed = shared.written(placed.withColumn("component", F.coalesce("component", "rep")), "placed")
        tally = placed.groupBy("key", "component").agg(F.count("*").alias("size"))
        mains = tally.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
        return shared.written(placed.join(mains.filter("parts > 1").select("key", "main"), "key"), "mixed")

    for step in range(MORE_HUBS):
        parts = mixed(comp)
        hubs = parts.filter("component = main").groupBy("key").agg(F.max_by("rep", F.xxhash64("key", "rep", F.lit(step))).alias("b"))
        star = parts.filter("component <> main").join(hubs, "key").select(F.col("rep").alias("a"), "b").distinct()
        star = shared.written(_estimated(star, nodes, threshold), "pairs")
        comp = merged(comp, shared.written(verified(star, docs, threshold, k), "links"))
    more = shared.written(_across(mixed(comp), nodes, threshold, stretch), "more-pairs")
    comp = merged(comp, shared.written(verified(more, docs, threshold, k), "links"))

    found = of_doc.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    rows = made.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
    rows = rows.withColumn("component_id", F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_hyperminhash(spark, sf_dir):
    """Components of all documents whose 3-word shingles overlap by 85 %."""
    return near_duplicates(shared.table(spark, sf_dir, "documents"))


ORACLE = {
    "op11_hyperminhash": """WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM cut),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * c >= 85 * (n + m - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s"""
}
