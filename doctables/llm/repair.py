"""Repair of conversations to the order `(system? (user assistant)+)?` by Hirschberg's divide and conquer.

A conversation's rows, in order of turns, are edited so that the initials of the roles are `(s?(ua)+)?`: rows are kept,
given the other role or deleted, and empty rows inserted. An automaton of four states (nothing yet, after system, after
user, after assistant) reads the result, so a stretch of rows is a 4 x 4 table of cheapest costs from state to state.

1. Rows are dealt by range of (conv_id, turn, ...), so one conversation may spread over many tasks, and cut into
   stretches of bounded size. Each stretch yields its table, and for each start the order of the end states' audits.
2. Tables of one conversation (not its rows) meet in one task. Forward cost vectors from the start and backward ones from
   the end meet in the middle; among the cheapest crossings the one with the least audit is taken; both halves follow
   in the same way. This fixes the states between stretches.
3. Each stretch does the same between its rows, in memory linear in the stretch, and so finds every row's edits.

Audits of equal cost are compared by order, not by text: a half ends with the edit of its last row, so no audit of one is
a beginning of another, and between states the order of the halves decides. A state dearer than another by
more than SLACK is dropped: from any state the rest costs at most 7 more than from any other.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctables.llm import shared

#: Rows of a stretch.
STRETCH = 16384
SLACK = 10
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after an inserted or re-roled row, and its role.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: State after a kept row, by state and initial.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Inserts that end a conversation.
END = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
INITIALS = ("s", "u", "a", "")
CLEAN, CUT, GONE = range(3)
TRIM = " \t\n\x0b\x0c\r"

Vector = tuple  # per state None or (cost, order of its audit)


class Step(NamedTuple):
    """What a row or stretch does to states: cost and order of the audit by (from, to); None where there is no way."""

    cost: tuple
    order: tuple


@functools.cache
def edits(initial: int, fault: int) -> tuple[tuple[str | None, ...], ...]:
    """Cheapest, then least edits of a row by (state before, state after): inserts ahead of it, then its own."""
    out = []
    for before in range(4):
        best: dict[int, tuple[int, str]] = {}
        state, ahead = before, ""
        for _ in range(3):
            ways = [(DELETE, "D", state)]
            if fault != GONE:
                more = TRUNCATED if fault == CUT else 0
                ways.append((REROLE + more, "R", NEXT[state]))
                if (state, INITIALS[initial]) in KEPT:
                    ways.append((KEEP + more, "K", KEPT[state, INITIALS[initial]]))
            for cost, mark, after in ways:
                found = (cost + INSERT * len(ahead), ahead + mark)
                best[after] = min(best.get(after, found), found)
            state, ahead = NEXT[state], ahead + "I"
        out.append(tuple(best[q][1] if q in best else None for q in range(4)))
    return tuple(out)


def cost_of(audit: str, fault: int) -> int:
    """Cost of the edits of one row."""
    one = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
    return sum(one[x] for x in audit) + (TRUNCATED if fault == CUT and "D" not in audit else 0)


@functools.cache
def row_step(initial: int, fault: int) -> Step:
    audits = edits(initial, fault)
    order = [sorted(a for a in row if a is not None) for row in audits]
    return Step(
        tuple(tuple(None if a is None else cost_of(a, fault) for a in row) for row in audits),
        tuple(tuple(None if a is None else order[p].index(a) for a in row) for p, row in enumerate(audits)),
    )


def _advanced(before: Vector, step: Step) -> tuple[int, Vector]:
    """The vector after a step, its least cost taken out and returned ahead."""
    best = []
    for q in range(4):
        ways = [(before[p][0] + step.cost[p][q], before[p][1], step.order[p][q]) for p in range(4) if before[p] and step.cost[p][q] is not None]
        best.append(min(ways, default=None))
    least = min(x[0] for x in best if x)
    best = [x if x and x[0] <= least + SLACK else None for x in best]
    order = sorted(x[1:] for x in best if x)
    return least, tuple((x[0] - least, order.index(x[1:])) if x else None for x in best)


def _retreated(after: tuple, step: Step) -> tuple:
    """Cheapest costs to the end by state before a step, given those after it; the least is taken out."""
    costs = []
    for p in range(4):
        costs.append(min((step.cost[p][q] + after[q] for q in range(4) if step.cost[p][q] is not None and after[q] is not None), default=None))
    least = min(x for x in costs if x is not None)
    return tuple(None if x is None else x - least for x in costs)


# rows have few kinds and, with the least cost taken out, vectors few values
_row_advanced = functools.cache(_advanced)
_row_retreated = functools.cache(_retreated)


def _from(state: int) -> Vector:
    return tuple((0, 0) if q == state else None for q in range(4))


def forward(steps: Sequence[Step], start: int, advanced=_advanced) -> tuple[int, Vector]:
    total, vector = 0, _from(start)
    for step in steps:
        cost, vector = advanced(vector, step)
        total += cost
    return total, vector


def summary(steps: Sequence[Step]) -> Step:
    """A stretch of rows as one step."""
    cost, order = [], []
    for p in range(4):
        total, vector = forward(steps, p, _row_advanced)
        cost.append(tuple(None if x is None else total + x[0] for x in vector))
        order.append(tuple(None if x is None else x[1] for x in vector))
    return Step(tuple(cost), tuple(order))


def crossings(steps: Sequence[Step], start: int, end: int, rows: bool) -> list[int]:
    """States after each step on the cheapest, then audit-least way from start to end, by halves."""
    advanced, retreated = (_row_advanced, _row_retreated) if rows else (_advanced, _retreated)
    states = [end] * len(steps)
    todo = [(0, len(steps), start, end)]
    while todo:
        low, high, first, last = todo.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        _, ahead = forward(steps[low:middle], first, advanced)
        behind = tuple(0 if q == last else None for q in range(4))
        for i in range(high - 1, middle - 1, -1):
            behind = retreated(behind, steps[i])
        _, _, state = min((ahead[q][0] + behind[q], ahead[q][1], q) for q in range(4) if ahead[q] and behind[q] is not None)
        states[middle - 1] = state
        todo += [(low, middle, first, state), (middle, high, state, last)]
    return states


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage of crc32(`conv_id:turn`) % 20; nulls count as one space there."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"), hit.alias("hit"))
    rows = rows.filter("hit <> 0").withColumn("text", F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("copy", F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select("conv_id", "turn", "role", "text")


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of sorted batches, run by run of equal keys; holds one run."""
    run: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if run and any(run[0][k] != row[k] for k in keys):
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def placed(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) with their place (part, pos) in order of conv_id, turn, role, text, nulls first,
    and initial, blank, cut (truncated) and a hash of conversation, role and text."""
    bare = F.rtrim(F.col("text"), F.lit(TRIM))
    part = F.concat_ws("\x00", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.coalesce("role", F.lit("")), "text")
    ways = shared.partitions(rows.sparkSession)
    dealt = rows.repartitionByRange(ways, "conv_id", "turn", "role", F.substring("text", 1, 16)).sortWithinPartitions("conv_id", "turn", "role", "text")
    marked = dealt.select(
        "*", _initial(F.col("role")).alias("initial"), (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"), F.unhex(F.sha2(part.cast("binary"), 256)).alias("same"),
    )

    def number(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        part, pos = TaskContext.get().partitionId(), 0
        for batch in it:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(pos, pos + n))], [*batch.schema.names, "part", "pos"]
            )
            pos += n

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in marked.schema)
    return shared.written(marked.mapInArrow(number, f"{fields}, part long, pos long"), "placed")


def faults(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Places (conv_id, turn, part, stretch, pos) with initial and first fault: none, blank, duplicate or truncated.

    rows comes from placed(). Only hashes that occur twice or more are joined; a duplicate is any but the first of them.
    """
    heard = rows.filter("not blank").select("same", "part", "pos")
    twice = heard.groupBy("same").agg(F.min(F.struct("part", "pos")).alias("first"), F.count("*").alias("times")).filter("times > 1")
    again = heard.join(twice, "same").filter("struct(part, pos) <> first").select("part", "pos", F.lit(True).alias("again"))
    light = rows.select("conv_id", "turn", "part", F.floor(F.col("pos") / stretch).alias("stretch"), "pos", "initial", "blank", "cut")
    fault = F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    return shared.written(light.join(again, ["part", "pos"], "left").select("conv_id", "turn", "part", "stretch", "pos", "initial", fault.alias("fault")), "faults")


def _step(row: dict) -> tuple[int, int]:
    return row["initial"], {"": CLEAN, "truncated": CUT}.get(row["fault"], GONE)


def states(marked: DataFrame) -> DataFrame:
    """(conv_id, part, stretch, start, end) of every stretch; the last one of a conversation has cost, tail and illegal too."""
    spark = marked.sparkSession
    matrix = "array<long>"

    def sum_up(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(it, ["part", "stretch", "conv_id"]):
            step = summary([row_step(*_step(r)) for r in run])
            said = [INITIALS[r["initial"]] for r in run]
            wrong = sum(x + y not in ("su", "ua", "au") for x, y in zip(said, said[1:]))
            flat = lambda m: [x for row in m for x in row]
            yield pa.RecordBatch.from_pylist([{
                "conv_id": run[0]["conv_id"], "part": run[0]["part"], "stretch": run[0]["stretch"], "cost": flat(step.cost), "order": flat(step.order),
                "first": said[0], "last": said[-1], "illegal": wrong,
            }], schema=pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("stretch", pa.int64()), ("cost", pa.list_(pa.int64())), ("order", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64())]))

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(it, ["conv_id"]):
            square = lambda m: tuple(tuple(m[4 * p : 4 * p + 4]) for p in range(4))
            steps = [Step(square(r["cost"]), square(r["order"])) for r in run]
            total, vector = forward(steps, START)
            cost, _, last = min((total + x[0] + INSERT * len(END[q]), x[1], q) for q, x in enumerate(vector) if x)
            after = crossings(steps, START, last, rows=False)
            wrong = sum(r["illegal"] for r in run) + sum(x["last"] + y["first"] not in ("su", "ua", "au") for x, y in zip(run, run[1:]))
            out = [{"conv_id": r["conv_id"], "part": r["part"], "stretch": r["stretch"], "start": s, "end": e, "cost": None, "tail": None, "illegal": None}
                   for r, s, e in zip(run, [START, *after], after)]
            out[-1] |= {"cost": cost, "tail": END[last], "illegal": wrong}
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("stretch", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.int64()), ("tail", pa.string()), ("illegal", pa.int64())]))

    ways = shared.partitions(spark)
    tables = marked.repartition(ways, "part", "stretch").sortWithinPartitions("part", "stretch", "pos").mapInArrow(
        sum_up, f"conv_id long, part long, stretch long, cost {matrix}, order {matrix}, first string, last string, illegal long")
    tables = shared.written(tables, "stretches")
    found = tables.repartition(ways, "conv_id").sortWithinPartitions("conv_id", "part", "stretch")
    return shared.written(found.mapInArrow(meet, "conv_id long, part long, stretch long, start long, end long, cost long, tail string, illegal long"), "states")


def repaired(rows: DataFrame, marked: DataFrame, ends: DataFrame) -> DataFrame:
    """(conv_id, part, pos, sub, edit, role, text): all edits in order, with the row that each leaves (null role: none)."""
    known = ends.select(F.col("conv_id").alias("conv"), F.col("part").alias("p"), F.col("stretch").alias("s"), "start", "end")
    same = F.expr("conv_id <=> conv and part = p and stretch = s")
    full = marked.join(known, same).drop("conv", "p", "s", "turn")

    def edit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(it, ["part", "stretch", "conv_id"]):
            kinds = [_step(r) for r in run]
            after = crossings([row_step(*k) for k in kinds], run[0]["start"], run[0]["end"], rows=True)
            out = {"part": [], "pos": [], "sub": [], "edit": [], "new": []}
            state = run[0]["start"]
            for row, kind, goes in zip(run, kinds, after):
                for sub, mark in enumerate(edits(*kind)[state][goes]):
                    if mark in "IR":
                        state = NEXT[state]
                    for c, v in zip(out, (row["part"], row["pos"], sub, mark, ROLE[state] if mark in "IR" else None)):
                        out[c].append(v)
                state = goes
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c in ("edit", "new") else pa.int64()) for c, v in out.items()})

    ways = shared.partitions(rows.sparkSession)
    found = full.repartition(ways, "part", "stretch").sortWithinPartitions("part", "stretch", "pos").mapInArrow(edit, "part long, pos long, sub long, edit string, new string")
    own = rows.select("conv_id", "part", "pos", "role", "text").join(found, ["part", "pos"])
    role = F.when(F.col("edit") == "K", F.col("role")).otherwise(F.col("new"))
    text = F.when(F.col("edit").isin("K", "R"), F.col("text")).when(F.col("edit") == "I", "")
    own = own.select("conv_id", "part", "pos", "sub", "edit", role.alias("role"), text.alias("text"))
    tail = ends.filter(F.length("tail") > 0).select("conv_id", "part", F.lit((1 << 62)).cast("long").alias("pos"), F.length("tail").alias("n"))
    # a tail of one ends with the assistant, a tail of two with user and assistant
    tail = tail.select("conv_id", "part", "pos", F.explode(F.expr("sequence(2L - n, 1L)")).alias("sub"))
    tail = tail.select("*", F.lit("I").alias("edit"), F.when(F.col("sub") == 0, "user").otherwise("assistant").alias("role"), F.lit("").alias("text"))
    return own.unionByName(tail)


def digests(edited: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): one task streams a conversation, as the hash of its text in order demands."""

    def digest(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, sha, any_row = None, [], None, False

        def out():
            return pa.RecordBatch.from_pydict({"conv_id": pa.array([now[0]], pa.int64()), "audit": ["".join(audit)], "repaired_sha256": [sha.hexdigest()]})

        for batch in it:
            for conv, mark, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text"))):
                if now != (conv,):
                    if now:
                        yield out()
                    now, audit, sha, any_row = (conv,), [], hashlib.sha256(), False
                audit.append(mark)
                if role is not None:
                    sha.update(f"{chr(10) if any_row else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    any_row = True
        if now:
            yield out()

    dealt = edited.repartition(shared.partitions(edited.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "pos", "sub")
    return dealt.select("conv_id", "edit", "role", "text").mapInArrow(digest, "conv_id long, audit string, repaired_sha256 string")


def report(conversations: DataFrame, rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """One row per conv_id of conversations, on its rows (conv_id, turn, role, text), which may lack conversations.

    gaps counts missing turns, blank, duplicate and truncated the rows by first fault, illegal the adjacent roles that may
    not follow each other, cost, audit and repaired_sha256 tell of the cheapest repair (ties: the least audit). A null
    conv_id is a conversation of its own, null turns come first and count for no gap; rows of one turn go by role,
    then text; repeated rows are duplicates. Null role or text here counts as empty. A conversation without rows
    has zeros, an empty audit and the hash of the empty text. Other columns are ignored; an empty table gives no rows.
    """
    rows = placed(rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    marked = faults(rows, stretch)
    ends = states(marked)
    per_row = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        *(F.count(F.when(F.col("fault") == x, 1)).alias(x) for x in ("blank", "duplicate", "truncated")),
    )
    none = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", *(F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.lit("").alias("audit"), F.lit(hashlib.sha256().hexdigest()).alias("base"))
    told = digests(repaired(rows, marked, ends))
    every = none.unionByName(per_row, True).unionByName(ends.filter("cost is not null").select("conv_id", "cost", "illegal"), True).unionByName(told, True)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    whole = every.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in numbers), F.max("audit").alias("audit"), F.coalesce(F.max("repaired_sha256"), F.max("base")).alias("repaired_sha256"))
    return whole


def op13_conversation_repair(spark, sf_dir):
    """Faults and cheapest repair of every conversation after damage."""
    conversations = shared.table(spark, sf_dir, "conversations")
    return report(conversations, damaged(conversations))


#: The automaton's four states as (cost, audit, result) carried row by row; structs compare in that order.
_I = lambda x, to: f"{{'c': {x}.c + 3, 'a': {x}.a || 'I', 'o': list_append({x}.o, '{to}:')}}"
_D = lambda x: f"{{'c': {x}.c + 4, 'a': {x}.a || 'D', 'o': {x}.o}}"
_K = lambda x, i: f"CASE WHEN NOT gone AND r0 = '{i}' THEN {{'c': {x}.c + cut, 'a': {x}.a || 'K', 'o': list_append({x}.o, role || ':' || text)}} END"
_R = lambda x, to: f"CASE WHEN NOT gone THEN {{'c': {x}.c + 3 + cut, 'a': {x}.a || 'R', 'o': list_append({x}.o, '{to}:' || text)}} END"
_U = ", ".join(f"{_K(x, 'u')}, {_R(x, 'user')}" for x in ("s0", "i1", "i3"))
ORACLE = {
    "op13_conversation_repair": f"""WITH RECURSIVE crc AS (SELECT i, list_reduce(list_prepend(i, range(0, 8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(0, 256) t(i)),
tab AS (SELECT list(v ORDER BY i) AS t FROM crc),
base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
hit AS (SELECT b.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % 20 AS h FROM base b, tab),
dam AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE h WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit WHERE h <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
  rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, role[1] AS r0 FROM dam),
f AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN bare[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lead(r0) OVER (PARTITION BY conv_id ORDER BY pos) AS r1 FROM num),
e AS (SELECT conv_id, pos, role, text, r0, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS cut FROM f),
walk AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, {{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, o VARCHAR[])) AS s1, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, o VARCHAR[])) AS s2, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, o VARCHAR[])) AS s3 FROM conversations
  UNION ALL SELECT conv_id, pos, {_D('s0')}, list_min([x for x in [{_D('i1')}, {_K('s0', 's')}] if x.c IS NOT NULL]),
    list_min([x for x in [{_D('i2')}, {_U}] if x.c IS NOT NULL]), list_min([x for x in [{_D('i3')}, {_K('i2', 'a')}, {_R('i2', 'assistant')}] if x.c IS NOT NULL])
  FROM (SELECT *, list_min([x for x in [j3, {_I('j2', 'assistant')}] if x.c IS NOT NULL]) AS i3 FROM (
    SELECT w.conv_id, e.pos, e.role, e.text, e.r0, e.gone, e.cut, w.s0, w.s1 AS i1, w.s3 AS j3, w.s2 AS j2,
      list_min([x for x in [w.s2, {_I('w.s0', 'user')}, {_I('w.s1', 'user')}, {_I('w.s3', 'user')}] if x.c IS NOT NULL]) AS i2
    FROM walk w JOIN e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.pos = w.pos + 1))),
last AS (SELECT conv_id, list_min([x for x in [s0, s3, {_I('s2', 'assistant')}] if x.c IS NOT NULL]) AS x FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (r1 IS NOT NULL AND r0 || r1 NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT l.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(x.c AS BIGINT) AS cost, x.a AS audit, sha256(array_to_string(x.o, chr(10))) AS repaired_sha256 FROM last l LEFT JOIN facts g ON g.conv_id IS NOT DISTINCT FROM l.conv_id"""
}
