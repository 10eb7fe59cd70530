"""Paragraphs from runs: joined before the shuffle, whole where positions repeat or overlap."""

import random

import pytest

from doctables.operators import paragraphs as P

ROW = "path string, para_pos int, run_pos int, md string"


def plain(rows):
    """Runs by position, then text; nulls first and without text."""
    out = {}
    for path, para, pos, md in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3] is not None, r[3] or "")):
        out[path, para] = out.get((path, para), "") + (md or "")
    return out


@pytest.mark.parametrize("seed", range(3))
def test_paragraphs_of_any_order(spark, monkeypatch, seed):
    monkeypatch.setattr(P, "STRETCH_RUNS", 5)
    rng = random.Random(seed)
    rows = [(f"d{d}", p, i, f"{rng.choice('aé中')}{i} ") for d in range(3) for p in range(4) for i in range(rng.randrange(1, 40))]
    rows += [rng.choice(rows)[:2] + (i, md) for i, md in [(None, "x"), (None, None), (3, None), (3, ""), (2, "again"), (-1, "first"), (7, "ü")] for _ in range(3)]
    rows += [(None, 1, 0, "n"), (None, 1, 1, "o"), ("d9", None, 0, "p"), ("d9", None, 1, "q"), ("d8", 0, 0, None)]
    rows += rows[: len(rows) // 4]
    if seed == 2:
        rng.shuffle(rows)
    got = P.paragraph_text(spark.createDataFrame(rows, ROW).coalesce(2)).collect()
    assert {(r.path, r.pos): r.md for r in got} == plain(rows) and len(got) == len(plain(rows))


def test_runs_in_order_are_joined_before_the_shuffle(spark):
    rows = spark.range(0, 20_000, 1, 2).selectExpr("div(id, 2000) AS path", "0 AS para_pos", "CAST(id % 2000 AS INT) AS run_pos", "'ab' AS md")
    assert P._stretches(rows, "md").count() < 100
    assert {r.md for r in P.paragraph_text(rows).collect()} == {"ab" * 2000}
