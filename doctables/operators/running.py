"""Running state along an ordered group, without putting a whole group in one task.

Document rules often read "the last ... before this row" or "how many ... so
far". A window over the document alone would sort each document in one task,
and one document may hold a large share of all rows. Here each group is cut
into blocks of consecutive rows: windows run inside a block, one small row per
block carries its total, and the totals of earlier blocks are added back by an
equi-join. Only the block totals of a group meet in one task.

The input is read twice, once for the rows and once, with few columns, for the
totals; write it out first (``staged``) where it is dear to compute.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16384

_BLOCK = "__block"


@dataclass(frozen=True)
class Scan:
    """One running value.

    kind: ``sum``, ``min``, ``max`` or ``last`` (latest non-null value).
    before: leave the row itself out.
    backward: run from the end of the group to its start.
    """

    kind: str
    value: Column
    before: bool = False
    backward: bool = False


def block_of(pos: Column | str, rows: int = BLOCK_ROWS) -> Column:
    """Block number of an integer position; rises with the position."""
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.call_function("div", pos.cast("long"), F.lit(rows).cast("long"))


def _within(scan: Scan, value: Column, keys: list[str], order: list[str]) -> Column:
    by = [F.col(o).desc() if scan.backward else F.col(o).asc() for o in order]
    end = -1 if scan.before else Window.currentRow
    window = (
        Window.partitionBy(*keys, _BLOCK)
        .orderBy(*by)
        .rowsBetween(Window.unboundedPreceding, end)
    )
    fold = {"sum": F.sum, "min": F.min, "max": F.max}.get(scan.kind)
    return fold(value).over(window) if fold else F.last(value, True).over(window)


def _total(scan: Scan, value: Column, order: list[str]) -> Column:
    if scan.kind == "last":
        place = F.when(value.isNotNull(), F.struct(*[F.col(o) for o in order]))
        return (F.min_by if scan.backward else F.max_by)(value, place)
    return {"sum": F.sum, "min": F.min, "max": F.max}[scan.kind](value)


def _carry(scan: Scan, name: str, keys: list[str]) -> Column:
    by = F.col(_BLOCK).desc() if scan.backward else F.col(_BLOCK).asc()
    window = (
        Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    )
    fold = {"sum": F.sum, "min": F.min, "max": F.max}.get(scan.kind)
    return fold(F.col(name)).over(window) if fold else F.last(F.col(name), True).over(window)


def _merge(scan: Scan, name: str) -> Column:
    here, earlier = F.col(name), F.col(f"__carry_{name}")
    if scan.kind == "sum":
        return F.coalesce(here, F.lit(0)) + F.coalesce(earlier, F.lit(0))
    if scan.kind == "min":
        return F.least(here, earlier)
    if scan.kind == "max":
        return F.greatest(here, earlier)
    return F.coalesce(here, earlier)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    block: Column,
    scans: dict[str, Scan],
) -> DataFrame:
    """Add one column per scan, computed along ``order`` inside each ``keys`` group.

    ``block`` must never fall as ``order`` rises; ``order`` must be unique in a
    group and ``keys`` must not be null.
    """
    blocked = df.withColumn(_BLOCK, block)
    names = list(scans)

    totals = blocked.groupBy(*keys, _BLOCK).agg(
        *[_total(scans[n], scans[n].value, order).alias(n) for n in names]
    )
    carried = totals.select(
        *keys,
        _BLOCK,
        *[_carry(scans[n], n, keys).alias(f"__carry_{n}") for n in names],
    ).where(_any_not_null([f"__carry_{n}" for n in names]))

    local = blocked.select(
        "*", *[_within(scans[n], scans[n].value, keys, order).alias(n) for n in names]
    )
    joined = local.join(carried, [*keys, _BLOCK], "left")
    merged = [_merge(scans[n], n).alias(n) for n in names]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *merged)


def _any_not_null(columns: list[str]) -> Column:
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNotNull()
    return test


@dataclass(frozen=True)
class LevelScan:
    """The latest earlier row at a level or above it (a smaller number).

    level: level of a row as one to be found; null for rows that are never found.
    value: what is kept of it, a whole number or null.
    ask: level that a row asks for; null asks for none.
    """

    level: Column
    value: Column
    ask: Column


def running_levels(
    df: DataFrame, keys: list[str], order: list[str], block: Column, scan: LevelScan, above: str, last: str
) -> DataFrame:
    """Add the latest earlier row at the asked level or above (``above``) and the latest one at all (``last``).

    Both are struct(level, value), null where there is none. The state is a stack: a
    row removes deeper levels and its own, and stands on top. A block sums up to its
    stack; of earlier stacks, what lies above its least level stays below it. So
    stacks of any depth merge block by block. Rows are shuffled once, in order.
    """
    key = F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})
    rows = df.withColumns({
        _BLOCK: block, "__key": key, "__level": scan.level.cast("bigint"), "__value": scan.value.cast("bigint"), "__ask": scan.ask.cast("bigint"),
    })
    dealt = rows.repartition("__key", _BLOCK).sortWithinPartitions("__key", _BLOCK, *order)
    found = pa.struct([("level", pa.int64()), ("value", pa.int64())])

    def sweep(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        """Finds within blocks for every row (whole), or the stack of each block."""
        now, levels, values, latest = None, [], [], None

        def stack() -> dict:
            return {"__key": [now[0]], _BLOCK: [now[1]], "__own": [[{"level": x, "value": y} for x, y in zip(levels, values)]], "__latest": [latest]}

        for batch in batches:
            aboves, lasts, ends = [], [], []
            for k, b, level, value, ask in zip(*(batch.column(c).to_pylist() for c in ("__key", _BLOCK, "__level", "__value", "__ask"))):
                if now != (k, b):
                    if levels:
                        ends.append(stack())
                    now, levels, values, latest = (k, b), [], [], None
                if whole:
                    at = bisect_right(levels, ask) - 1 if ask is not None else -1
                    aboves.append({"level": levels[at], "value": values[at]} if at >= 0 else None)
                    lasts.append(latest)
                if level is not None:
                    keep = bisect_left(levels, level)
                    levels[keep:], values[keep:] = [level], [value]
                    latest = {"level": level, "value": value}
            if whole:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(aboves, found), pa.array(lasts, found)], [*batch.schema.names, "__above", "__last"])
            else:
                for end in ends:
                    yield pa.RecordBatch.from_pydict(end, schema=stacks)
        if not whole and levels:
            yield pa.RecordBatch.from_pydict(stack(), schema=stacks)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The merged stack of all blocks before each one."""
        now, held, latest = None, [], None
        for batch in batches:
            for k, b, own, last_own in zip(*(batch.column(c).to_pylist() for c in ("__key", _BLOCK, "__own", "__latest"))):
                if k != now:
                    now, held, latest = k, [], None
                yield pa.RecordBatch.from_pydict({"__key": [k], _BLOCK: [b], "__own": [held], "__latest": [latest]}, schema=stacks)
                if own:
                    held = [x for x in held if x["level"] < own[0]["level"]] + own
                    latest = last_own

    stacks = pa.schema([("__key", pa.string()), (_BLOCK, pa.int64()), ("__own", pa.list_(found)), ("__latest", found)])
    pair = "struct<level bigint, value bigint>"
    ddl = f"__key string, {_BLOCK} bigint, __own array<{pair}>, __latest {pair}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    local = dealt.mapInArrow(lambda it: sweep(it, True), f"{fields}, __above {pair}, __last {pair}")
    # blocks without a stack of their own ask too, so every block is listed
    listed = dealt.select("__key", _BLOCK).distinct()
    small = dealt.select("__key", _BLOCK, "__level", "__value", "__ask").mapInArrow(lambda it: sweep(it, False), ddl)
    small = listed.join(small, ["__key", _BLOCK], "left")
    carry = small.repartition("__key").sortWithinPartitions("__key", _BLOCK).mapInArrow(merge, ddl)
    joined = local.join(carry, ["__key", _BLOCK])
    below = F.filter("__own", lambda x: x["level"] <= F.col("__ask"))
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.coalesce("__above", F.try_element_at(below, F.lit(-1))).alias(above), F.coalesce("__last", "__latest").alias(last),
    )


def row_numbers(
    df: DataFrame, keys: list[str], order: list[str], block: Column, name: str = "row"
) -> DataFrame:
    """Number the rows of each group from 1 in ``order``."""
    return running(df, keys, order, block, {name: Scan("sum", F.lit(1).cast("long"))})


def spread_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    ways: int = 8,
) -> DataFrame:
    """Equi-join to a lookup table whose keys may be very unevenly used.

    Rows on the left that share a key are spread over ``ways`` tasks by a hash
    of ``spread_by``; each lookup row is repeated ``ways`` times. The lookup
    side must be the small one.
    """
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(ways)).cast("int")
    copies = F.explode(F.array(*[F.lit(i) for i in range(ways)]))
    return (
        left.withColumn("__way", spread)
        .join(right.withColumn("__way", copies), [*keys, "__way"], how)
        .drop("__way")
    )
