"""Quality rules, language, near duplicates and scores against plain Python."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from doctables.llm import components, jaccard, langid, ppm, quality

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_quality_odd(odd_docs):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.measured(odd_docs).collect()}
    want = set()
    for r in odd_docs.collect():
        t, w = r.text or "", words(r.text)
        tri = Counter(zip(w, w[1:], w[2:]))
        hit = {p for i, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for p in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if words(x)]
        want.add((r.doc_id, len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)))
    assert got == want
    assert quality.measured(odd_docs.limit(0)).count() == 0


def test_quality_order_keeps_the_verdict(spark, odd_docs):
    rules = quality.BASE + quality.RULES
    assert {r.name for r, *_ in quality.ordered(odd_docs, rules)} == {r.name for r in rules}
    one = {r.doc_id for r in odd_docs.filter(quality.cascade(odd_docs.text, rules).isNull()).collect()}
    two = {r.doc_id for r in odd_docs.filter(quality.cascade(odd_docs.text, rules[::-1]).isNull()).collect()}
    assert one == two


def brute_components(rows):
    sets, parent = {}, {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(i, []).append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set()))
        parent[i] = i

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[i] for y in sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}, sets


@pytest.mark.parametrize("share", [2.0**-20, 1.0])
def test_jaccard(make_docs, odd_docs, share):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
    rows = [(r.doc_id, r.text) for r in odd_docs.filter("doc_id is not null").collect()]
    for i in range(100, 160):  # drifting copies, chains of links, a passage in all
        w = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 6))):
            w[k] = f"n{i}x{k}"
        rows.append((i, " ".join(w if i % 3 else w[: int(rng.integers(60, 120))])))
        base = w if i % 7 == 0 else base
    passage = " ".join(f"p{x}" for x in range(60))
    rows += [(200 + i, passage + " " + " ".join(f"u{i}q{x}" for x in range(40 + i))) for i in range(20)]
    docs = make_docs(rows)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, share=share).collect()}
    assert got == brute_components(rows)[0]
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_jaccard_loose_groups_in_small_tiles(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", 0)
    monkeypatch.setattr(jaccard, "STRETCH", 3)
    monkeypatch.setattr(jaccard, "PART_MEMBERS", 2)
    monkeypatch.setattr(jaccard, "PAIRS", 50)
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in range(150)]
    rows = []
    for i in range(150):  # copies with one to four changed words each: some pairs link, most do not
        w = list(base)
        for k in rng.integers(0, 150, int(rng.integers(1, 5))):
            w[k] = f"n{i}x{k}"
        rows.append((i, " ".join(w[: 150 - int(rng.integers(0, 3))])))
    rows += [(300 + i, " ".join(base[:-1] + [f"z{i}"])) for i in range(30)]  # many share prefix and size
    docs = make_docs(rows)
    seen = []
    across = jaccard._across
    monkeypatch.setattr(jaccard, "_across", lambda *a: seen.append(across(*a)) or seen[-1])
    want = brute_components(rows)[0]
    for hub in (jaccard.with_hubs, lambda posted, num, den, ways: with_own(posted, num, den, ways)):
        monkeypatch.setattr(jaccard, "with_hubs", hub)
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
        assert got == want
    assert seen[1].count() > 0


def with_own(posted, num, den, ways):
    """Postings without any hub, so that all links between groups are left to the tiles."""
    from pyspark.sql import functions as F

    return posted.withColumn("hub", F.col("gid"))


def test_jaccard_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(jaccard.ORACLE["op8_jaccard_join"]).fetchall()
    got = jaccard.op8_jaccard_join(spark, SF).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_jaccard_null_ids_and_empty(make_docs, odd_docs):
    got = jaccard.jaccard_components(make_docs([(None, "a b c d e f"), (1, "a b c d e f"), (2, None)])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(None, 2, None), (1, 2, 1), (2, 0, 2)}
    assert jaccard.jaccard_components(odd_docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {(r.node, r.component) for r in components.connected(links).collect()}
    assert got == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_repeats_are_counted_in_place():
    rng = np.random.default_rng(4)
    for sizes in ([0], [1], [0, 3, 0], [900, 50, 1]):
        held = [rng.integers(0, 300, n).astype(np.uint64) << np.uint64(55) for n in sizes]
        h, c = np.unique(np.concatenate(held), return_counts=True)
        found, count = jaccard.repeats(held)
        assert held == [] and np.array_equal(found, h[c > 1]) and np.array_equal(count, c[c > 1])


def test_forward_backward_holds_few_arrays():
    import tracemalloc

    n, k = 200_000, 8
    emit, start = np.zeros((n, k)), np.zeros(n, bool)
    tracemalloc.start()
    langid.posteriors(emit, start, np.zeros((k, k)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * emit.nbytes


def test_forward_backward_is_plain():
    rng = np.random.default_rng(0)
    k, n = 3, 500
    emit, start, trans = rng.normal(size=(n, k)) * 3, rng.random(n) < 0.02, rng.normal(size=(k, k))
    start[0] = True
    got = langid.posteriors(emit, start, trans)[0]
    a, cuts = np.exp(trans), [*np.flatnonzero(start), n]
    for s, e in zip(cuts, cuts[1:]):
        x = np.exp(emit[s:e])
        fore, back = [x[0]], [np.ones(k)]
        for t in range(1, e - s):
            fore.append(fore[-1] @ a * x[t])
            fore[-1] /= fore[-1].sum()
        for t in range(e - s - 1, 0, -1):
            back.insert(0, a @ (x[t] * back[0]) / 100)
        want = np.array(fore) * np.array(back)
        assert np.allclose(got[s:e], want / want.sum(1, keepdims=True))


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from doctables.llm.langid import op4_language

    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = op4_language(spark, SF).collect()
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.95 * len(held)


def test_language_odd(odd_docs):
    model = langid.learned(odd_docs)
    rows = langid.identified(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("en", "fr")) == letters and (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert langid.identified(odd_docs.limit(0), langid.learned(odd_docs.limit(0))).count() == 0
    assert {r.lang_pred for r in langid.identified(odd_docs, langid.learned(odd_docs.limit(0))).collect()} == {"und"}


def plain_ppm(train, texts):
    k = ppm.ORDER
    pad = b"\n" * k
    counts = [{} for _ in range(k + 1)]
    for s in train:
        s = pad + s
        for i in range(k, len(s)):
            for o in range(k + 1):
                counts[o].setdefault(s[i - o : i], Counter())[s[i]] += 1
    out = []
    for s in texts:
        s, total = pad + s, 0.0
        for i in range(k, len(s)):
            gone = set()
            for o in range(k, -1, -1):
                seen = {x: n for x, n in counts[o].get(s[i - o : i], {}).items() if x not in gone}
                if not seen:
                    continue
                n, d = sum(seen.values()), len(seen)
                if s[i] in seen:
                    total += np.log10(seen[s[i]] / (n + d))
                    break
                total += np.log10(d / (n + d))
                gone |= set(counts[o][s[i - o : i]])
            else:
                total -= np.log10(256 - len(gone))
        out.append(total)
    return out


@pytest.mark.parametrize("share", [2.0**-18, 1.0])
def test_scores(odd_docs, share):
    docs = odd_docs.filter("text is null or length(text) < 1000").coalesce(1)
    training = docs.filter("doc_id % 2 = 0")
    got = ppm.scored(docs, training, share=share).collect()
    rows = docs.collect()
    tokens = [(r.text or "").encode().lower().split() + [b""] for r in rows]
    teach = [t for t, r in zip(tokens, rows) if r.doc_id is not None and r.doc_id % 2 == 0]
    c = Counter(x for t in teach for x in t)
    n, v = sum(c.values()), len(c)
    text = lambda t: b" ".join(t[:-1]) + b"\n"
    want = plain_ppm([text(t) for t in teach], [text(t) for t in tokens])
    key = lambda x: (x[0] or -1, *x[1:3])
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got), key=key)
    plain = sorted(((r.doc_id, len(t), sum(x in c for x in t), n, round(float(sum(np.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)), 6), round(float(s), 6)) for r, t, s in zip(rows, tokens, want)), key=key)
    assert have == plain
    assert ppm.scored(docs.limit(0), training.limit(0)).count() == 0
    assert ppm.scored(docs, training.limit(0)).count() == len(rows)


@pytest.mark.parametrize("nodes", [0, 40, 1 << 21])
def test_scores_keep_every_gram(odd_docs, nodes):
    docs = odd_docs.filter("length(text) between 1 and 1000 and doc_id is not null").dropDuplicates(["doc_id"])
    training = docs.filter("doc_id % 2 = 0")
    got = {r.doc_id: r.score for r in ppm.scored(docs, training, nodes=nodes).collect()}
    text = lambda t: b" ".join(t.encode().lower().split()) + b"\n"
    rows = docs.collect()
    want = plain_ppm([text(r.text) for r in rows if r.doc_id % 2 == 0], [text(r.text) for r in rows])
    assert got == pytest.approx({r.doc_id: s for r, s in zip(rows, want)}, abs=1e-9)


def test_quality_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(quality.ORACLE["op1_quality_rules"]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(tuple(r[c] for c in names) for r in quality.op1_quality_rules(spark, SF).collect()) == sorted(want)
