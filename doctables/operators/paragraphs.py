"""Paragraphs and runs: text, sections, lists, bookmarks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doctables.functions import text as M
from doctables.operators.running import BLOCK_ROWS, LevelScan, Scan, block_of, running, running_levels, spread_lookup

#: Runs that are joined before they are shuffled, at most.
STRETCH_RUNS = 1024


def render_runs(run: DataFrame, text: str = "text") -> DataFrame:
    """Add ``md``, the text of each run inside its format marks.

    The escaped text is a column of its own: it is looked at for every mark and
    must not be computed again each time.
    """
    flags = {c: F.col(c) for c in M.RUN_FLAGS}
    escaped = run.withColumn("__content", M.run_content(text, "del"))
    content = F.col("__content")
    return escaped.withColumn("md", M.wrap_run(content, F.length(content) > 0, flags)).drop("__content")


def render_links(run: DataFrame, link: DataFrame, md: str = "md") -> DataFrame:
    """Runs with a link id become ``[text](target)``; an unknown id gives an empty target."""
    targets = link.select("path", F.col("rel_id").alias("link_id"), "target")
    joined = spread_lookup(run, targets, ["path", "link_id"], ["para_pos", "run_pos"])
    linked = F.concat(F.lit("["), F.col(md), F.lit("]("), F.coalesce("target", F.lit("")), F.lit(")"))
    return joined.withColumn(
        md, F.when(F.col("link_id").isNotNull(), linked).otherwise(F.col(md))
    ).drop("target")


def _stretches(run: DataFrame, md: str) -> DataFrame:
    """Runs that follow each other, joined: (path, para_pos, first, last, md, ends of the runs' bytes in md).

    Runs come in order where a text was just cut into them, so most of a paragraph becomes a row or a few before any shuffle.
    A stretch lies within an Arrow batch and has at most STRETCH_RUNS runs; a run without a next one stays alone, without ends.
    """
    rows = run.select("path", "para_pos", "run_pos", F.col(md).alias("md"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            path, para, pos, text = batch.columns
            text = pc.fill_null(text, "")
            number = pos.cast(pa.int64())
            before, after = number.slice(0, n - 1), number.slice(1)
            goes_on = pc.and_(pc.equal(after, pc.add(before, 1)), pc.greater(after, before))
            for key in (path, para):
                goes_on = pc.and_(goes_on, pc.equal(key.slice(0, n - 1), key.slice(1)))
            new = np.arange(n) % STRETCH_RUNS == 0
            new[1:] |= ~pc.fill_null(goes_on, False).to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(new)
            runs = np.diff(np.append(begin, n))
            bounds, data = text.buffers()[1:]
            bounds = np.frombuffer(bounds, np.int32)[text.offset : text.offset + n + 1]
            joined = pa.StringArray.from_buffers(len(begin), pa.py_buffer(np.append(bounds[begin], bounds[n])), data)
            ends = pa.array(bounds[1:] - np.repeat(bounds[begin], runs))
            ends = pa.ListArray.from_arrays(pa.array(np.append(begin, n).astype(np.int32)), ends, mask=pa.array(runs == 1))
            first, last = (number.take(pa.array(i)) for i in (begin, begin + runs - 1))
            at = pa.array(begin)
            yield pa.RecordBatch.from_arrays([path.take(at), para.take(at), first, last, joined, ends], ["path", "para_pos", "first", "last", "md", "ends"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(join, f"path {types['path']}, para_pos {types['para_pos']}, first bigint, last bigint, md string, ends array<int>")


def paragraph_text(run: DataFrame, md: str = "md") -> DataFrame:
    """Text of each paragraph: its runs in order. A paragraph's text is one value.

    Stretches of runs that lie apart stand one after the other; where they overlap, they are cut into their runs again.
    """
    stretch = F.struct("first", "last", "md", "ends")
    whole = _stretches(run, md).groupBy("path", F.col("para_pos").alias("pos")).agg(F.sort_array(F.collect_list(stretch)).alias("p"))

    def meets(x: Column, i: Column) -> Column:
        after = F.get("p", i + 1)
        return F.coalesce((after["first"] <= x["last"]) & (x["ends"].isNotNull() | after["ends"].isNotNull()), F.lit(False))

    def cut(x: Column) -> Column:
        begin = lambda i: F.coalesce(F.get(x["ends"], i - 1), F.lit(0))
        piece = lambda end, i: F.struct(
            (x["first"] + i).alias("first"), F.substring(x["md"].cast("binary"), begin(i) + 1, end - begin(i)).cast("string").alias("md")
        )
        return F.when(x["ends"].isNull(), F.array(F.struct(x["first"].alias("first"), x["md"].alias("md")))).otherwise(F.transform(x["ends"], piece))

    text = lambda c: F.array_join(F.transform(c, lambda x: x["md"]), "")
    overlap = F.size(F.filter("p", meets)) > 0
    md = F.when(overlap, text(F.sort_array(F.flatten(F.transform("p", cut))))).otherwise(text(F.col("p")))
    return whole.select("path", "pos", md.alias("md"))


def sections(paragraph: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add section_no, the columns of the section (null after the last break) and its opening line.

    A paragraph with ``break_cols`` ends a section; the opening line stands on the
    section's first paragraph.
    """
    ends = F.col("break_cols").isNotNull()
    out = running(
        paragraph, ["path"], ["pos"], block_of("pos", block_rows),
        {
            "section_no": Scan("sum", ends.cast("int"), before=True),
            "__after_break": Scan("last", ends, before=True),
            "section_cols": Scan("last", F.col("break_cols"), backward=True),
        },
    )
    first = F.coalesce("__after_break", F.lit(True)) & F.col("section_cols").isNotNull()
    return out.withColumn(
        "opening", F.when(first, F.concat(M.section_line("section_cols"), F.lit("\n\n")))
    ).drop("__after_break")


def drop_field_bookmarks(run: DataFrame, keys: list[str] = ["path"], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Drop runs inside a bookmark whose end comes after a form field of the paragraph.

    Runs have kind start, end, field or text. Marks without a partner in the
    paragraph have no effect. The marks themselves are dropped too.

    The balance of marks falls with each end and rises with each start. A run lies
    in as many bookmarks as the balance stands above its lowest value so far, and
    as many of them are closed as it falls below the run's from there on; the
    outermost of these is closed after the first field if it does not fall as far
    before that field. A block of runs sums up to its change, its lowest balance,
    whether it has a field and its lowest balance up to the first one; these add up
    along the paragraph. Rows are shuffled once, and one row per block twice.
    """
    rows = run.withColumn("__block", block_of("pos", block_rows))
    step = F.when(F.col("kind") == "start", 1).when(F.col("kind") == "end", -1).otherwise(0).cast("long")
    ahead = Window.partitionBy(*keys, "__block").orderBy("pos")
    upto = ahead.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("__sum", F.sum(step).over(upto)).withColumn("__field", F.max(F.col("kind") == "field").over(upto))

    blocks = local.groupBy(*keys, "__block").agg(
        F.sum(step).alias("__step"), F.min("__sum").alias("__low"), F.max("__field").alias("__has"),
        F.min(F.when(~F.col("__field"), F.col("__sum"))).alias("__low_to_field"),
    )
    along = Window.partitionBy(*keys).orderBy("__block")
    back = Window.partitionBy(*keys).orderBy(F.desc("__block"))
    earlier, later = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (along, back))
    blocks = blocks.withColumn("__base", F.coalesce(F.sum("__step").over(earlier), F.lit(0)))
    blocks = blocks.withColumn("__seen", F.coalesce(F.max("__has").over(earlier), F.lit(False)))
    blocks = blocks.withColumn("__past", F.min(F.col("__base") + F.col("__low")).over(earlier))
    to_field = F.when(~F.col("__seen"), F.col("__base") + F.when(F.col("__has"), F.col("__low_to_field")).otherwise(F.col("__low")))
    carry = blocks.select(
        *keys, "__block", "__base", "__seen", "__past",
        F.min(F.col("__base") + F.col("__low")).over(later).alias("__next"),
        F.when(~F.col("__has"), F.min(to_field).over(later)).alias("__next_to_field"),
        (F.col("__seen") | F.col("__has") | F.coalesce(F.max("__has").over(later), F.lit(False))).alias("__any"),
    )
    out = local.join(carry, [*keys, "__block"]).withColumn("__at", F.col("__base") + F.col("__sum"))
    after = Window.partitionBy(*keys, "__block").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.col("__seen") | F.col("__field")
    out = out.withColumn("__low", F.least(F.lit(0), "__past", F.min("__at").over(upto)))
    out = out.withColumn("__then", F.least("__next", F.min("__at").over(after)))
    out = out.withColumn("__to_field", F.least("__next_to_field", F.min(F.when(~seen, F.col("__at"))).over(after)))
    falls = lambda c: F.greatest(F.lit(0), F.coalesce(F.col("__at") - F.col(c), F.lit(0)))
    closed = F.least(F.col("__at") - F.col("__low"), falls("__then"))
    gone = F.col("__any") & (closed > F.when(seen, 0).otherwise(falls("__to_field")))
    return out.where(~gone & ~F.col("kind").isin("start", "end")).select(*run.columns)


def resolve_numbering(paragraph: DataFrame, numbering: DataFrame, level: DataFrame) -> DataFrame:
    """Add the format and start of each paragraph's list level (null when not in a list)."""
    known = numbering.join(level, ["path", "abstract_id"]).select(
        "path", "num_id", "ilvl", "fmt", "start"
    )
    return spread_lookup(paragraph, known, ["path", "num_id", "ilvl"], ["pos"])


def list_marks(paragraph: DataFrame, keys: list[str] = ["path"], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ptype, the list mark and, for continuations, the depth of the open list.

    Needs num_id, ilvl, fmt, start and the normalised ``style``. An item counts on
    (``#.``) if the nearest earlier paragraph at its level or above is an item of
    the same list at the same level; plain paragraphs end all lists,
    continuations end none. Lists may have any number of levels.
    """
    kind = F.when(F.col("num_id").isNotNull() & F.col("ilvl").isNotNull(), M.list_kind("fmt"))
    ptype = F.coalesce(kind, F.when(F.col("style") == "LIST", "Continuation"), F.lit("Normal"))
    typed = paragraph.withColumn("ptype", ptype)
    is_item = F.col("ptype").isin("OrderedList", "BulletList")
    held = F.col("ptype") == "Continuation"
    level = F.when(~held, F.when(is_item, F.col("ilvl")).otherwise(0))
    # one below the level of an item; plain paragraphs leave no list open
    state = LevelScan(level, F.when(is_item, F.col("num_id")), F.col("ilvl"))
    out = running_levels(typed, keys, ["pos"], block_of("pos", block_rows), state, "__above", "__last")
    same = (F.col("__above.level") == F.col("ilvl")) & (F.col("__above.value") == F.col("num_id"))
    number = F.when(F.coalesce(same, F.lit(False)) | F.col("start").isNull(), "#.\t").otherwise(
        F.concat(F.col("start").cast("string"), F.lit(".\t"))
    )
    tabs = F.repeat(F.lit("\t"), F.coalesce("ilvl", F.lit(0)))
    mark = (
        F.when(F.col("ptype") == "OrderedList", F.concat(tabs, number))
        .when(F.col("ptype") == "BulletList", M.bullet_mark("ilvl"))
        .when(kind == "Continuation", F.concat(tabs, F.lit("\t")))
        .otherwise("")
    )
    open_list = F.when(F.col("__last.value").isNotNull(), F.col("__last.level") + 1).otherwise(0)
    depth = F.when(F.col("ptype") == "Continuation", open_list.cast("int"))
    return out.select(*paragraph.columns, "ptype", mark.alias("mark"), depth.alias("depth"))


def finish_paragraph(md: Column, code: Column, depth: Column, align: Column) -> Column:
    """Fence, list indent and alignment marks of a paragraph, in that order."""
    body = F.when(code, M.fence(md)).otherwise(md)
    body = F.when(depth.isNotNull(), M.indent_lines(body, depth)).otherwise(body)
    return M.mark_align(body, align)
