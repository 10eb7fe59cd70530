"""Connected components of a link table: spanning stars inside tasks, then alternating stars over all."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doctables.llm import shared


#: Nodes a task holds at a time.
HELD = 1 << 20


def _forest(links: DataFrame, held: int = HELD) -> DataFrame:
    """Links with the same components: in every stretch of a task, each node with the smallest one it reaches there.

    A combiner without a shuffle: a stretch of any number of links over n nodes leaves fewer than n.
    """

    def stars(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (y := up.setdefault(top, top)) != top:
                top = y
            while up[x] != top:
                up[x], x = top, up[x]
            return top

        def found() -> pa.RecordBatch:
            rows = [(x, root(x)) for x in list(up)]
            rows = [r for r in rows if r[0] != r[1]]
            return pa.RecordBatch.from_pydict({"a": pa.array([r[0] for r in rows], pa.int64()), "b": pa.array([r[1] for r in rows], pa.int64())})

        for batch in it:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = root(a), root(b)
                if a < b:
                    up[b] = a
                elif b < a:
                    up[a] = b
            if len(up) > held:
                yield found()
                up.clear()
        if up:
            yield found()

    return links.select("a", "b").mapInArrow(stars, "a long, b long")


def _large(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them. Links here run from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b); component is the smallest node reachable.

    Links of a node with itself and nulls are dropped. Each round is written to the shared folder, so a lost
    executor costs one round at most. Stars shrink long chains by a constant factor a round; it stops when nothing changes.
    """
    now, before = shared.written(_forest(links.filter("a <> b")), "stars"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before, last = state, now
        large = _large(now).distinct()
        now = shared.written(_forest(_small(large).filter("a <> b").distinct()), "stars")
        shared.drop_files(last)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), "b").distinct())


def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """comp (node, component) after further links (a, b): the components that these join, and nodes new to comp.

    Only links between components are closed anew; the rest of comp takes its new component by one join.
    """
    of = lambda x: comp.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = ends.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")).filter("a <> b")
    root = connected(ends)
    to = root.select(F.col("node").alias("component"), F.col("component").alias("root"))
    moved = comp.join(to, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return shared.written(moved.union(root).distinct(), "components")
