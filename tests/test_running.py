"""Running values against a plain loop, with blocks of many sizes."""

import random
import re

import pytest
from pyspark.sql import functions as F

from doctables.operators.running import Scan, block_of, row_numbers, running, spread_lookup


def loop(values, scan, before, backward):
    order = range(len(values))[::-1] if backward else range(len(values))
    out, state = [None] * len(values), None
    fold = {"sum": lambda a, b: a + b, "min": min, "max": max, "last": lambda a, b: b}[scan]
    for i in order:
        if before:
            out[i] = state
        if values[i] is not None:
            state = values[i] if state is None else fold(state, values[i])
        if not before:
            out[i] = state
    return [0 if v is None and scan == "sum" else v for v in out]


@pytest.mark.parametrize("rows", [1, 3, 1000])
def test_running(spark, rows):
    rng = random.Random(7)
    data = [
        (f"p{g}", pos, rng.choice([None, rng.randint(-5, 5)]))
        for g, size in enumerate([1, 2, 40, 90])
        for pos in range(size)
    ]
    df = spark.createDataFrame(data, "path string, pos int, v int")
    scans = {
        f"{kind}_{int(before)}{int(backward)}": Scan(kind, F.col("v"), before, backward)
        for kind in ("sum", "min", "max", "last") for before in (False, True) for backward in (False, True)
    }
    got = running(df, ["path"], ["pos"], block_of("pos", rows), scans).orderBy("path", "pos").collect()
    for g in range(4):
        mine = [r for r in got if r["path"] == f"p{g}"]
        values = [r["v"] for r in mine]
        for name, scan in scans.items():
            assert [r[name] for r in mine] == loop(values, scan.kind, scan.before, scan.backward), name


def test_row_numbers_with_ties_in_a_block(spark):
    df = spark.createDataFrame([("a", x, y) for x in range(5) for y in range(3)], "path string, x int, y int")
    got = row_numbers(df, ["path"], ["x", "y"], block_of("x", 2)).orderBy("x", "y").collect()
    assert [r["row"] for r in got] == list(range(1, 16))


def test_hot_group_is_split(spark):
    """A window never partitions by the group alone over the rows themselves."""
    df = spark.range(1000).select(F.concat(F.lit("hot"), F.col("id") % 1).alias("path"), F.col("id").alias("pos"))
    out = row_numbers(df, ["path"], ["pos"], block_of("pos", 100))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(path#\d+, __block", plan)
    assert out.agg(F.max("row")).first()[0] == 1000


def test_spread_lookup(spark):
    left = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), (None, 2)], "k string, n int")
    right = spark.createDataFrame([("a", "x"), ("c", "y")], "k string, v string")
    got = spread_lookup(left, right, ["k"], ["n"])
    assert got.count() == 52
    assert got.where("v = 'x'").count() == 50
    assert spread_lookup(left, right, ["k"], ["n"], "inner").count() == 50
