"""Archives, exact search, mixing, tool calls and the pipeline against plain Python."""

import hashlib
import random

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from doctables.llm import components, langid, mixing, toolcalls, topk, warc

SF = "/root/testdata/sf0.001"


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=8), max_size=9))
def test_loser_tree(runs):
    got = list(warc.LoserTree([iter(sorted((x,) for x in r)) for r in runs]))
    assert got == sorted((x,) for r in runs for x in r)


def test_archives(spark):
    big, other = "é" * 600, "x" * 5000
    rows = [(1, "http://www.B.example/x?q#f", big), (2, None, big), (3, "http://a.example/", None), (4, "http://a.example/", ""), (5, "http://a.example/\r\nX: y", "small"), (6, "http://a.example/", "small"), (7, "http://b.example:80/x", big), (None, "nonsense", other), (8, "http://[", other)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, file string")
    got = {r.page_id: r for r in warc.archived(pages).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        payload = (html or "").encode()
        assert got[i].payload_bytes == len(payload) and got[i].payload_digest == hashlib.sha1(payload).hexdigest()
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {1: ("revisit", 7), 2: ("revisit", 7), None: ("revisit", 8)}
    order = [r.page_id for r in sorted(got.values(), key=lambda r: (r.range_no, r.place))]
    keys = {i: (warc.url_key(u), i or 0) for i, u, _ in rows}
    assert order == sorted(order, key=lambda i: (keys[i][0], warc.EPOCH + keys[i][1]))
    assert warc.archived(pages.limit(0)).count() == 0


def test_merge_of_many_runs(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "GROUP_ROWS", 7)
    rng = random.Random(6)
    rows = [(rng.choice(["", "a)/", "b)/" + "x" * 300, "b)/" + "x" * 299 + "y", f"c{rng.randint(0, 40)})/", "é)/"]), rng.randint(0, 5), rng.choice([None, *range(9)]), f"f{rng.randint(0, 3)}", i, 1) for i in range(1500)]
    entries = spark.createDataFrame(rows, warc.ENTRY).repartition(9).sortWithinPartitions("url_key", "captured", "page_id", "file", "offset")
    folder = f"file://{tmp_path}/index"
    runs = warc.sorted_runs(entries, folder)
    assert runs.count() == 9 and all(len(r.samples) <= 2 * warc.SAMPLES for r in runs.collect())
    key = lambda r: (r[0], r[1], (0, 0) if r[2] is None else (1, r[2]), *r[3:])
    for ways, range_rows in ((2, 100), (3, 10**6), (32, 50)):
        index = warc.with_places(warc.merge_runs(runs, folder, ways, range_rows)).collect()
        assert [r.place for r in sorted(index, key=lambda r: r.place)] == list(range(len(rows)))
        got = [tuple(r[c] for c in warc.ENTRIES.names) for r in sorted(index, key=lambda r: r.place)]
        assert got == sorted(rows, key=key)
        ranges = [r.range_no for r in sorted(index, key=lambda r: r.place)]
        assert ranges == sorted(ranges) and (len(set(ranges)) > 5) == (range_rows < 10**6)


def test_archives_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = con.execute(warc.ORACLE["op3_warc"])
    names = [d[0] for d in want.description]
    got = warc.op3_warc(spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, want.fetchall()))


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "TILE_ROWS", 2)
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-2, 2)) / 256 for _ in range(4 if i % 5 else 3)], "s") for i in range(120)]
    rows += [(120, None, "s"), (121, [1.0, None, 2.0, 3.0], "s"), (122, [float("nan")] * 4, "s"), (123, [float("inf")] * 4, "s"), (None, [1.0] * 4, "s"), (50, rows[50][1], "s"), (124, [1e9] * 4, "s")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = [tuple(r) for r in topk.top_k(vectors, vectors.filter("vec_id % 50 = 0 or vec_id = 124")).collect()]
    real = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q in sorted({i for i, _ in real if i % 50 == 0 or i == 124}):
        v = dict(real)[q]
        s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in real if i != q and len(w) == len(v))
        want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s[:5])]
    assert sorted(got) == want
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_top_k_sends_no_tile_to_every_shard(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 8)
    monkeypatch.setattr(topk, "TILE_ROWS", 4)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    rng = random.Random(7)
    rows = [(i, [float(rng.randint(-3, 3)) / 256 for _ in range(3)]) for i in range(500)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = topk.top_k(vectors, vectors.filter("vec_id % 25 = 0"))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "BroadcastExchange" not in plan
    whole = {i: [int(256 * x) for x in v] for i, v in rows}
    want = []
    for q in range(0, 500, 25):
        s = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)
        want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:5])]
    assert sorted(map(tuple, top.collect())) == want


def test_top_k_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(topk.ORACLE["op7_exact_top_k"]).fetchall()
    assert sorted(tuple(r) for r in topk.op7_exact_top_k(spark, SF).collect()) == sorted(want)


def test_rake():
    rng = np.random.default_rng(1)
    table = rng.random((4, 3, 5)) * (rng.random((4, 3, 5)) > 0.2)
    targets = [x / x.sum() for x in (rng.random(4), rng.random(3), rng.random(5))]
    fitted = mixing.rake(table, targets)
    for a, t in enumerate(targets):
        assert np.allclose(fitted.sum(tuple(x for x in range(3) if x != a)) / table.sum(), t, atol=1e-4)
    odds = np.log(fitted[table > 0] / table[table > 0])  # a sum of one term per column
    design = np.concatenate([np.eye(n)[i] for n, i in zip(table.shape, np.nonzero(table))], 1)
    assert np.abs(design @ np.linalg.lstsq(design, odds, rcond=None)[0] - odds).max() < 1e-6


def test_mixed(make_docs, odd_docs):
    rng = random.Random(2)
    docs = make_docs([(i, " ".join(rng.choices(["alpha", "be", "gammas", "d"], k=rng.randint(1, 30))), rng.choice(["en", "fr", None]), rng.choice("aaab")) for i in range(3000)])
    rows = mixing.mixed(docs, {"source": {"a": 0.5, "b": 0.5}}).collect()
    assert len(rows) == 3000
    tokens = lambda s: sum(r.n_tokens * r.probability for r in rows if r.source == s)
    assert abs(tokens("a") / (tokens("a") + tokens("b")) - 0.5) < 1e-3
    kept = lambda s: sum(r.n_tokens for r in rows if r.kept and r.source == s)
    assert abs(kept("a") / (kept("a") + kept("b")) - 0.5) < 0.05
    assert max(r.probability for r in rows) == 1
    assert mixing.mixed(odd_docs).count() == odd_docs.count() and mixing.mixed(odd_docs.limit(0)).count() == 0


def test_tool_calls(spark):
    chain = [(1, f"c{i}", i, "note", '{"text":"t"}', f"c{i - 1}" if i else None, "x") for i in range(40)]
    calls = chain + [
        (2, "a", 1, "reply", '{"words":3,"text":"é\\n"}', "b", "x"), (2, "b", 2, "reply", '{"text":"","words":true}', "a", "x"), (2, "a", 5, "reply", "{}", None, "x"),
        (3, "q", 1, "none", None, "lost", "x"), (3, "r", 2, "reply", "not json", None, "x"), (3, "s", 3, "note", '{"text":1,"z":2}', "q", "x"), (None, "n", 1, "note", "[]", None, "x"), (3, None, 4, None, None, None, "x"),
    ]
    results = [(1, "c3", 9, "second", 0), (1, "c3", 4, "first", 0), (9, "zz", 1, "alone", 0), (2, "a", 7, None, 0), (None, "n", 2, "r", 0)]
    c = spark.createDataFrame(calls, "conv_id long, call_id string, pos long, name string, arguments string, after string, json string")
    r = spark.createDataFrame(results, "conv_id long, call_id string, pos long, content string, level int")
    rows = toolcalls.linked_calls(c, r, toolcalls.SCHEMAS).collect()
    assert len(rows) == len(calls) + 2
    by = {(x.conv_id, x.call_id, x.status): x for x in rows}
    assert [by[1, f"c{i}", "linked" if i == 3 else "unanswered"].level for i in range(40)] == list(range(40))
    assert by[1, "c3", "linked"].json == '{"arguments":{"text":"t"},"id":"c3","name":"note","result":"first"}' and by[1, "c3", "linked"].n_results == 2
    assert by[2, "a", "linked"].json == '{"arguments":{"text":"é\\n","words":3},"id":"a","name":"reply","result":null}'
    assert by[2, "a", "linked"].errors == "cycle" and by[2, "b", "unanswered"].errors == "text: too short; words: not integer; cycle"
    assert by[2, "a", "duplicate"].errors == "text: missing; words: missing"
    assert by[3, "q", "unanswered"].errors == "unknown tool" and by[3, "q", "unanswered"].level == 0 and by[3, "s", "unanswered"].level == 1
    assert by[3, "r", "unanswered"].errors == "not JSON" and by[3, "s", "unanswered"].errors == "text: not string; z: not allowed"
    assert by[9, "zz", "orphan"].json == '{"id":"zz","result":"alone"}' and (None, "n", "orphan") in by and by[None, "n", "unanswered"].errors == "not an object"
    assert toolcalls.linked_calls(c.limit(0), r.limit(0), {}).count() == 0


def test_pipeline(spark, monkeypatch):
    import corpus_pipeline
    from doctables.llm import quality, shared
    from tests.llm.test_texts import brute_components

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "ngram_jaccard_join", "mixing_sources", "best_fit_packing"]
    made = [shared.table(spark, SF, "documents")]

    def stage(fn):
        def run(spark, docs, sf_dir):
            made.append(shared.written(fn(spark, docs, sf_dir), "stage"))
            return made[-1]

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, stage(f)) for n, f in corpus_pipeline.STAGES])
    out = corpus_pipeline.run(spark, SF).collect()
    docs, one, two, three, four, five = made
    assert all(x.columns == docs.columns for x in (one, two, three, four))
    assert one.count() >= 0.99 * docs.count()
    bad = {r.doc_id for r in quality.measured(one).filter("not kept").collect()}
    assert {r.doc_id for r in two.collect()} == {r.doc_id for r in one.collect()} - bad
    assert sorted(r.doc_id for r in three.collect()) == sorted(set(brute_components([(r.doc_id, r.text) for r in two.collect()])[0].values()))
    assert {r.doc_id for r in four.collect()} == {r.doc_id for r in mixing.mixed(three).collect() if r.kept}
    assert {r.doc_id for r in out} == {r.doc_id for r in four.collect()} and len(out) == five.count()


def test_odd_arguments():
    schema = {"properties": {"n": {"type": "integer", "maximum": 5}, "s": {"minLength": 2}, "z": {"type": "null"}, "m": {"type": ["string", "null"]},
              "o": {"type": "object", "properties": {"k": {"type": "string"}}, "required": ["k"]}, "a": {"type": "array", "items": {"type": "number"}}}}
    wrong = lambda text: toolcalls.faults(text, schema)[1]
    assert wrong('{"n": 1.0, "s": 7, "z": null, "m": null, "o": {"k": "x"}, "a": [1, 2.5]}') == []
    assert wrong('{"n": "9", "s": "x", "z": 0, "m": 1}') == ["m: not string or null", "n: not integer", "s: too short", "z: not null"]
    assert wrong('{"n": 9, "o": {}, "a": [1, true, "x"]}') == ["a[1]: not number", "a[2]: not number", "n: above 5", "o.k: missing"]
    assert wrong("[1]") == ["not an object"] and wrong(None) == []
    for text in ('{"a": NaN}', '{"a": 1, "a": 2}', '{"s": ' + "[" * 100_000 + "]" * 100_000 + "}", "{"):
        assert wrong(text) == ["not JSON"]


def test_rare_targets_and_clashing_names(spark):
    rows = [(i, "w " * 10, "r1" if i == 0 else "r2" if i == 1 else "big", "en", "x", "y") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, w_ string, __source_0 string")
    out = mixing.mixed(docs, {"source": {"big": 0.5, "r1": 0.4, "r2": 0.1}}).groupBy("source").agg({"weight": "sum"}).collect()
    got = {r["source"]: r["sum(weight)"] for r in out}
    assert abs(got["r1"] / got["r2"] - 4) < 1e-6 and abs(got["big"] / got["r1"] - 1.25) < 1e-6
    assert {"w_", "__source_0"} <= set(mixing.mixed(docs).columns)


def test_letters():
    assert not langid.has_letter("½ ² 12 _ —") and langid.has_letter("é") and langid.has_letter("12b") and langid.has_letter("中")
