"""Jaccard self-join of word shingles by grouped prefixes.

1. Equal sets form one class, stood for by its smallest doc_id.
2. Shingles met often inside tasks come last in the global order of shingles, so boilerplate stays out of prefixes.
   Every order gives the same links; the order only decides how many candidates there are.
3. Two sets that link share a shingle of their prefixes. Classes with identical prefix and size form one group. Postings carry a
   group's size and the shingle's place in its order: if the first shared shingle stands at places i and j, at most
   min(n_a - i, n_b - j) elements are shared, which rules out most groups that meet late.
4. Each shingle's groups, by size, are paired with a hub: the first group in reach of its size; members with the first of their
   group. Pairs pass a parity bitmap (a lower bound of the symmetric difference), are verified on the texts and closed
   to components. One more round takes hubs out of each shingle's largest component. Both only save work in step 5.
5. Where a shingle (or a group) still holds several components, its groups are compared in tiles of bounded size, so that a
   shingle of any length is spread over tasks: group pairs are filtered by size and place, the rest expanded to members of
   different components, and only those that pass the bitmap leave the task. They are verified, so no link between
   components is lost; pairs inside a component, and in its largest one, could add nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctables.llm import shared
from doctables.llm.components import connected, merged

SHINGLE = 5
BATCH_BYTES = 2 << 20
#: Further rounds of hubs before the exhaustive step; they only save comparisons there.
HUB_ROUNDS = 1
#: Members that travel together as a part of their group, parts of a shingle held at a time, pairs looked at in one go.
PART_MEMBERS = 64
STRETCH = 4096
PAIRS = 1 << 17
#: Bits of the bitmaps that travel with members; sketches keep four times the bits, pairs are held against those before texts move.
TILE_BITS = 2048
#: Shingles that stand for more than this share of all go last in the order; so there are at most 1 / share of them.
OFTEN_SHARE = 2.0**-20
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
ODD = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(64)], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def repeats(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values that occur twice or more in the arrays, ascending, and how often; empties the list, so that values are held once or twice."""
    h = np.concatenate(held)
    held.clear()
    h.sort()
    edge = np.diff(np.concatenate([[False], h[1:] == h[:-1], [False]]).view(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return h[first], last - first + 1


def shingle_sets(texts: list[str | None], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's k-word shingles; the whole sequence when it has fewer words."""
    from xxhash import xxh3_64_intdigest

    cut = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    n = np.array([len(w) for w in cut])
    h = np.array([xxh3_64_intdigest(w) for words in cut for w in words], np.uint64)
    ends = np.cumsum(n)
    if len(h) >= k:
        m = len(h) - k + 1
        rolled = np.zeros(m, np.uint64)
        for i in range(k):
            rolled += h[i : i + m] * ODD[i]
        rolled = _mixed(rolled)
    out = []
    for a, b in zip((ends - n).tolist(), ends.tolist()):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            out.append(_mixed((h[a:b] * ODD[k : k + b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parity of the hashes in each of 4 * 2^j >= 4 * size buckets, as 64-bit words: bitmaps of two sets differ in at most as many bits as the sets."""
    bits = max(64, 4 << max(0, len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of words) as bitmaps of fewer words."""
    return np.bitwise_xor.reduce(words.reshape(*words.shape[:-1], -1, size), axis=-2)


def differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which bitmaps differ, row by row, the wider ones folded to the width of the others."""
    size = min(a.shape[-1], b.shape[-1])
    return np.bitwise_count(folded(a, size) ^ folded(b, size)).sum(axis=-1, dtype=np.int64)


def in_reach(n, i, m, j, num: int, den: int):
    """Whether sets of n and m elements whose first shared element stands at places i and j may link."""
    shared_ = np.minimum(n - i, m - j)
    return (den * np.minimum(n, m) >= num * np.maximum(n, m)) & ((num + den) * shared_ >= num * (n + m))


def often(docs: DataFrame, share: float = OFTEN_SHARE) -> np.ndarray:
    """Sorted hashes of shingles that tasks met twice or more, together for more than `share` of all shingles.

    Counted over all documents. Each stands for more than that share, so the driver gets at most 1 / share hashes.
    """
    flush = 4_000_000

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.let_go()
        held, n = [], 0

        def repeated():
            h, c = repeats(held)
            return pa.RecordBatch.from_pydict({"shingle": np.append(h.view(np.int64), 0), "n": np.append(c, n), "all": np.append(np.zeros(len(h), bool), True)})

        for batch in shared.batches_of(it, "text", BATCH_BYTES):
            sets = shingle_sets(batch.column("text").to_pylist())
            held += sets
            n += sum(map(len, sets))
            if n > flush:
                yield repeated()
                n = 0
        if held:
            yield repeated()

    met = shared.written(docs.select("text").mapInArrow(count, "shingle long, n long, all boolean").groupBy("shingle", "all").agg(F.sum("n").alias("n")), "often")
    total = met.filter("all").agg(F.sum("n")).first()[0] or 0
    found = met.filter(~F.col("all") & (F.col("n") > max(3.0, total * share))).select("shingle").toPandas()
    return np.sort(found["shingle"].to_numpy(np.int64).view(np.uint64))


def _held(spark: SparkSession, hashes: np.ndarray):
    return spark.sparkContext.broadcast(hashes.tobytes())


def sketches(docs: DataFrame, frequent: np.ndarray, num: int, den: int) -> DataFrame:
    """(doc_id, n, key, prefix_key, prefix, bits) of each document with words: see the module's steps 1 to 3."""
    last = _held(docs.sparkSession, frequent)

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        shared.let_go()
        late = np.frombuffer(last.value, np.uint64)
        for batch in shared.batches_of(it, "text", BATCH_BYTES):
            rows: dict[str, list] = {c: [] for c in ("doc_id", "n", "key", "prefix_key", "prefix", "bits")}
            for doc_id, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text").to_pylist())):
                n = len(s)
                prefix = b""
                if n:
                    if len(late):
                        at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                        is_late = late[at] == s
                        ordered = np.concatenate([s[~is_late], s[is_late]])
                    else:
                        ordered = s
                    prefix = ordered[: n - -(-num * n // den) + 1].tobytes()
                for c, v in zip(rows, (doc_id, n, xxh3_128_digest(s.tobytes()), xxh3_128_digest(prefix, seed=n), prefix, bitmap(s).tobytes() if n else b"")):
                    rows[c].append(v)
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(rows.items(), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()))})

    return docs.select("doc_id", "text").mapInArrow(sketch, "doc_id long, n long, key binary, prefix_key binary, prefix binary, bits binary")


PLACE_BITS = 31


def _unpacked(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and place out of one number; in order of that number sizes ascend."""
    return z >> PLACE_BITS, z & ((1 << PLACE_BITS) - 1)


def postings(groups: DataFrame) -> DataFrame:
    """(shingle, gid, z) for each shingle of each group's prefix; z is the group's size and the shingle's place."""

    def explode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            prefix = [np.frombuffer(p, np.int64) for p in batch.column("prefix").to_pylist()]
            size = [len(p) for p in prefix]
            if prefix:
                gid, n = (np.repeat(batch.column(c).to_numpy(), size) for c in ("gid", "n"))
                every, z = np.concatenate(prefix), (n << PLACE_BITS) | np.concatenate([np.arange(k) for k in size])
                for a in range(0, len(every), 1 << 17):
                    yield pa.RecordBatch.from_pydict({"shingle": every[a : a + (1 << 17)], "gid": gid[a : a + (1 << 17)], "z": z[a : a + (1 << 17)]})

    return groups.select("gid", "n", "prefix").mapInArrow(explode, "shingle long, gid long, z long")


def with_hubs(posted: DataFrame, num: int, den: int, ways: int) -> DataFrame:
    """Postings of shingles that more than one group has, each with its hub: the smallest group in reach of its size.

    A group that cannot link with its hub by their places gets itself. One shuffle by shingle; tasks stream over sorted
    rows and hold one batch, so a shingle of any length passes.
    """

    def hubs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None  # the last row of earlier batches: shingle, gid, z, hub, hub's z, whether it was given out

        def rows(s, g, z, h, h_z):
            near = in_reach(*_unpacked(z), *_unpacked(h_z), num, den)
            return pa.RecordBatch.from_pydict({"shingle": s, "gid": g, "z": z, "hub": np.where(near, h, g)})

        for batch in it:
            if not batch.num_rows:
                continue
            s, g, z = (batch.column(c).to_numpy() for c in ("shingle", "gid", "z"))
            starts = np.concatenate([[True], s[1:] != s[:-1]])
            inside = carry is not None and carry[0] == s[0]
            first = np.flatnonzero(starts)
            size = np.diff(np.append(first, len(s)))
            hub, hub_z = np.repeat(g[first], size), np.repeat(z[first], size)
            if inside:
                hub[: size[0]], hub_z[: size[0]] = carry[3], carry[4]
            run = np.repeat(np.arange(len(first)), size)
            while True:  # sizes ascend in a run: where one is out of the hub's reach, a new hub begins
                far = den * _unpacked(hub_z)[0] < num * _unpacked(z)[0]
                if not far.any():
                    break
                at = np.flatnonzero(far)
                new = at[np.concatenate([[True], run[at[1:]] != run[at[:-1]]])]
                end = np.append(first, len(s))[run[new] + 1]
                take = np.concatenate([np.arange(a, b) for a, b in zip(new, end)])
                hub[take], hub_z[take] = np.repeat(g[new], end - new), np.repeat(z[new], end - new)
            many = np.repeat(size > 1, size)
            if inside:
                many[: size[0]] = True
                if not carry[5]:
                    yield rows(*(np.array([carry[i]]) for i in range(5)))
            given = bool(many[-1])
            if many.any():
                yield rows(s[many], g[many], z[many], hub[many], hub_z[many])
            carry = (s[-1], g[-1], z[-1], hub[-1], hub_z[-1], given)

    dealt = posted.repartition(ways, "shingle").sortWithinPartitions("shingle", "z", "gid")
    return dealt.mapInArrow(hubs, "shingle long, gid long, z long, hub long")


def _plausible(pairs: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose sizes and bitmaps allow a link."""

    def may(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            # |A and B| >= num / (num + den) of n, so at most (den - num) / (num + den) of n lie in one set alone
            most = (den - num) * n // (num + den)
            sides = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())
            far = [int(differ(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(np.array(far, np.int64) <= most))

    side = lambda x: bits.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    near = (den * F.least("n_a", "n_b")) >= (num * F.greatest("n_a", "n_b"))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(near).mapInArrow(may, "a long, b long")


class _Members:
    """Members of the parts in a batch as flat arrays: part p holds rows begin[p] to begin[p] + size[p]."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        cols = {c: batch.column(c) for c in ("docs", "comps", "sizes", "bits")}
        self.size = np.diff(cols["docs"].offsets.to_numpy()).astype(np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.doc, self.comp, self.n = (cols[c].flatten().to_numpy() for c in ("docs", "comps", "sizes"))
        maps = [np.frombuffer(x, np.uint64) for x in cols["bits"].flatten().to_pylist()]
        self.width = np.array([len(x) for x in maps], np.int64)
        self.at = np.cumsum(self.width) - self.width
        self.words = np.concatenate(maps) if maps else np.zeros(0, np.uint64)

    def rows(self, i: np.ndarray, width: int) -> np.ndarray:
        return self.words[self.at[i][:, None] + np.arange(width)]


def _expanded(m: _Members, a: np.ndarray, b: np.ndarray, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Members (a, b) of the pairs of parts that lie in different components and whose bitmaps allow a link."""
    count = m.size[a] * m.size[b]
    ends = np.cumsum(count)
    for low in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        t = np.arange(low, min(low + PAIRS, int(ends[-1])))
        p = np.searchsorted(ends, t, "right")
        t = t - (ends[p] - count[p])
        i, j = m.begin[a[p]] + t // m.size[b[p]], m.begin[b[p]] + t % m.size[b[p]]
        near = (m.comp[i] != m.comp[j]) & (den * np.minimum(m.n[i], m.n[j]) >= num * np.maximum(m.n[i], m.n[j]))
        near &= (a[p] != b[p]) | (i < j)
        i, j = i[near], j[near]
        kind = m.width[i] * (TILE_BITS + 1) + m.width[j]
        keep = np.zeros(len(i), bool)
        for k in np.unique(kind):
            some = np.flatnonzero(kind == k)
            x, y = i[some], j[some]
            keep[some] = (num + den) * differ(m.rows(x, int(m.width[x[0]])), m.rows(y, int(m.width[y[0]]))) <= (den - num) * (m.n[x] + m.n[y])
        x, y = m.doc[i[keep]], m.doc[j[keep]]
        if len(x):
            found = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
            yield pa.RecordBatch.from_pydict({"a": found[:, 0], "b": found[:, 1]})


def _across(mixed: DataFrame, parts: DataFrame, num: int, den: int, stretch: int) -> DataFrame:
    """Plausible pairs of documents in different components out of groups that share a shingle.

    mixed has shingle, gid, z, outside (whether some member lies outside the shingle's main component); parts has gid, part,
    docs, comps, sizes, bits. A shingle is a table of tiles: its outside parts are held, about `stretch` at a time, and all its
    parts stream past them, eight times as many a tile.
    """
    rows = mixed.join(parts.select("gid", "part"), "gid")
    sizes = rows.groupBy("shingle").agg(F.ceil(F.count_if("outside") / stretch).alias("held"), F.ceil(F.count("*") / (8 * stretch)).alias("wide"))
    dealt = rows.join(sizes, "shingle").withColumn("own", F.xxhash64("gid", "part"))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    held = dealt.filter("outside").select("shingle", F.expr("pmod(own, held)").alias("no"), F.explode(upto("wide")).alias("col"), F.lit(0).alias("side"), "gid", "part", "z", "outside")
    probes = dealt.select("shingle", F.explode(upto("held")).alias("no"), F.expr("pmod(own, wide)").alias("col"), F.lit(1).alias("side"), "gid", "part", "z", "outside")
    tiles = held.unionByName(probes).join(parts, ["gid", "part"])

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.let_go()
        rest = None  # held rows of the tile that the last batch ended in
        for batch in it:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            s, no, col, side, gid, part, z, outside = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shingle", "no", "col", "side", "gid", "part", "z", "outside"))
            new = np.append(True, (s[1:] != s[:-1]) | (no[1:] != no[:-1]) | (col[1:] != col[:-1]))
            first = np.flatnonzero(new)
            tile = np.cumsum(new) - 1
            kept = np.bincount(tile[side == 0], minlength=len(first))  # held rows stand first in their tile
            rest = batch.slice(first[-1], kept[-1])
            probe = np.flatnonzero(side == 1)
            n, place = _unpacked(z)
            members = None
            count = kept[tile[probe]]
            ends = np.cumsum(count)
            for low in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
                t = np.arange(low, min(low + PAIRS, int(ends[-1])))
                p = np.searchsorted(ends, t, "right")
                y = probe[p]
                x = first[tile[y]] + t - (ends[p] - count[p])
                # two outside parts meet twice, as held and as probe: once is enough
                once = ~outside[y] | (gid[x] < gid[y]) | ((gid[x] == gid[y]) & (part[x] <= part[y]))
                x, y = x[once], y[once]
                near = in_reach(n[x], place[x], n[y], place[y], num, den)
                if near.any():
                    members = members or _Members(batch)
                    yield from _expanded(members, x[near], y[near], num, den)

    tiles = tiles.select("shingle", "no", "col", "side", "gid", "part", "z", "outside", "docs", "comps", "sizes", "bits")
    tiles = tiles.repartition(shared.partitions(mixed.sparkSession), "shingle", "no", "col").sortWithinPartitions("shingle", "no", "col", "side")
    return tiles.mapInArrow(compare, "a long, b long").distinct()


def _narrow(bits: DataFrame) -> DataFrame:
    """Bitmaps of a quarter of the bits, of TILE_BITS at most."""

    def fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            maps = [np.frombuffer(x, np.uint64) for x in batch.column("bits").to_pylist()]
            maps = [folded(x, max(1, min(len(x) // 4, TILE_BITS // 64))).tobytes() for x in maps]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(maps, pa.binary())], schema=batch.schema)

    return bits.select("prefix_key", "doc_id", "n", "bits").mapInArrow(fold, "prefix_key binary, doc_id long, n long, bits binary")


def verified(pairs: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose shingle sets reach num / den; the texts come by joins on doc_id.

    Only the documents of the pairs keep their texts past the first join.
    """
    spark = pairs.sparkSession
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = shared.written(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"), "pair-texts")

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.let_go()
        held: dict[int, np.ndarray] = {}
        for batch in it:
            for part in shared.batches_of(iter([batch]), "text_a", BATCH_BYTES):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                sets = shingle_sets(part.column("text_a").to_pylist())
                new = {i: t for i, t in zip(b, part.column("text_b").to_pylist()) if i not in held}
                if len(held) > 64:
                    held = {i: held[i] for i in b if i in held}
                held.update(zip(new, shingle_sets(list(new.values()))))
                keep = []
                for x, i in zip(sets, b):
                    y = held[i]
                    both = np.intersect1d(x, y, assume_unique=True).size
                    keep.append(den * both >= num * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_pydict({"a": np.array(a, np.int64), "b": np.array(b, np.int64)}).filter(pa.array(keep, pa.bool_()))

    first = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, threshold: tuple[int, int] = (3, 4), share: float = OFTEN_SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text), for links of at least num / den.

    component_id is the smallest doc_id reachable by links. Null and word-less texts have an empty set and stand alone.
    Rows that repeat a doc_id count as one document with any of its texts. A null doc_id links with nothing
    and has a null component. Other columns are ignored; an empty table gives no rows. Shingles are
    compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    num, den = threshold
    docs = docs.select("doc_id", "text")
    made = shared.written(sketches(docs, often(docs, share), num, den), "sketches")
    real = made.filter("n > 0 and doc_id is not null")
    classes = real.groupBy("key").agg(F.min("doc_id").alias("rep"))
    of_class = shared.written(real.select("doc_id", "key", "n").join(classes, "key").select("doc_id", "n", "rep"), "classes")
    reps = of_class.filter("doc_id = rep").select("doc_id").distinct()
    nodes = real.join(reps, "doc_id", "left_semi").dropDuplicates(["doc_id", "key"])
    nodes = shared.written(nodes.select("doc_id", "n", "prefix_key", "bits", "prefix"), "nodes")
    bits = nodes.select("doc_id", "n", "bits")
    heads = nodes.groupBy("prefix_key").agg(F.min("doc_id").alias("gid"), F.count("*").alias("members"))
    grouped = nodes.select("doc_id", "prefix_key").join(heads, "prefix_key")
    groups = nodes.join(heads.select("prefix_key", F.col("gid").alias("doc_id")), ["prefix_key", "doc_id"])
    groups = groups.select(F.col("doc_id").alias("gid"), "prefix_key", "n", "prefix").dropDuplicates(["gid", "prefix_key"])
    posted = shared.written(with_hubs(postings(groups), num, den, shared.partitions(spark)), "postings")
    several = grouped.filter("members > 1").select("gid", "doc_id").distinct()

    def linked(pairs: DataFrame) -> DataFrame:
        return shared.written(verified(shared.written(_plausible(pairs, bits, num, den), "pairs"), docs, num, den), "links")

    star = posted.filter("gid <> hub").select(F.col("gid").alias("a"), F.col("hub").alias("b"))
    star = star.union(several.filter("gid <> doc_id").select(F.col("doc_id").alias("a"), F.col("gid").alias("b"))).distinct()
    comp = shared.written(connected(linked(star)), "components")

    def spans(comp: DataFrame) -> DataFrame:
        """Smallest and largest component among the members of each group."""
        of = grouped.select("gid", "doc_id").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        of = of.withColumn("component", F.coalesce("component", "doc_id"))
        return shared.written(of.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high")), "spans")

    def mixed_of(posted: DataFrame, span: DataFrame) -> DataFrame:
        """(shingle, gid, z, outside) of the shingles that several components have; outside tells whether a group has members out of the largest."""
        placed = shared.written(posted.select("shingle", "gid", "z").join(span, "gid"), "placed")
        ends = placed.groupBy("shingle").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("shingle")
        some = shared.written(placed.join(ends, "shingle", "left_semi"), "some")
        tally = some.filter("low = high").groupBy("shingle", "low").agg(F.count("*").alias("k"))
        main = tally.groupBy("shingle").agg(F.max_by("low", F.struct("k", "low")).alias("main"))
        marked = some.join(main, "shingle", "left").withColumn("outside", ~(F.col("low").eqNullSafe(F.col("main")) & (F.col("low") == F.col("high"))))
        marked = shared.written(marked.select("shingle", "gid", "z", "outside"), "mixed")
        for table in (placed, some):
            shared.drop_files(table)
        return marked

    mixed = mixed_of(posted, spans(comp))
    for step in range(HUB_ROUNDS):  # another hub, out of each shingle's largest component
        hub = mixed.filter("not outside").groupBy("shingle").agg(F.max_by("gid", F.xxhash64("shingle", "gid", F.lit(step))).alias("b"))
        star = mixed.filter("outside").join(hub, "shingle").select(F.col("gid").alias("a"), "b").filter("a <> b").distinct()
        comp = merged(comp, linked(star))
        mixed = mixed_of(mixed, spans(comp))
    # a group of several components meets itself, whether or not it shares a shingle
    split = spans(comp).filter("low < high").select(F.xxhash64("gid").alias("shingle"), "gid").join(groups.select("gid", "n"), "gid")
    split = split.select("shingle", "gid", F.shiftleft("n", PLACE_BITS).alias("z"), F.lit(True).alias("outside")).distinct()
    mixed = shared.written(mixed.unionByName(split), "mixed")
    of = _narrow(nodes).join(heads.select("prefix_key", "gid"), "prefix_key").join(mixed.select("gid").distinct(), "gid", "left_semi")
    of = of.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    sizes = of.groupBy("gid").agg(F.ceil(F.count("*") / PART_MEMBERS).alias("parts"))
    of = of.join(sizes, "gid").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    of = of.groupBy("gid", "part").agg(F.collect_list(F.struct("doc_id", "component", "n", "bits")).alias("m"))
    parts = of.select("gid", "part", F.col("m.doc_id").alias("docs"), F.col("m.component").alias("comps"), F.col("m.n").alias("sizes"), F.col("m.bits").alias("bits"))
    rest = shared.written(_across(mixed, shared.written(parts, "parts"), num, den, STRETCH), "more-pairs")
    # Copies take the component of their class; a doc_id with several texts links their classes.
    of_doc = of_class.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("last"))
    several = of_class.join(of_doc.filter("rep < last").select("doc_id", F.col("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b"))
    comp = merged(comp, linked(rest).union(several))
    found = of_doc.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    ids = made.select("doc_id", F.col("n").alias("n_shingles"))
    return ids.join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, threshold: tuple[int, int] = (3, 4)) -> DataFrame:
    """The document with the smallest doc_id of each component, with all its columns; one row of a repeated doc_id stays.

    Rows with a null doc_id all stay.
    """
    first = jaccard_components(docs, threshold).filter("component_id = doc_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id is null"))


def op8_jaccard_join(spark, sf_dir):
    """Components of all documents whose 5-word shingles overlap by 75 %."""
    return jaccard_components(shared.table(spark, sf_dir, "documents"))


ORACLE = {
    "op8_jaccard_join": """WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM cut),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * c >= 75 * (n + m - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s"""
}
