"""Tables of a document as Markdown rows.

Cells have (path, tbl, row, cell_no, span, header_flag, first_row, jc, n_cols, md);
``n_cols`` is the number of grid columns of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doctables.functions import text as M
from doctables.operators.running import Scan, block_of, running, spread_lookup

TABLE = ["path", "tbl"]
ROW = [*TABLE, "row"]
ROW_BLOCK = 2048


def header_rows(cell: DataFrame) -> DataFrame:
    """One row per table row: is_header, and the table's first body row.

    A row is a header if flagged, or styled as first row when no header came before.
    """
    rows = cell.groupBy(*ROW).agg(
        F.max(F.coalesce("header_flag", F.lit(False))).alias("flagged"),
        F.max(F.coalesce("first_row", F.lit(False))).alias("styled"),
        F.max("n_cols").alias("n_cols"),
    )
    first = F.min(F.when(F.col("flagged") | F.col("styled"), F.col("row"))).alias("first_header")
    rows = spread_lookup(rows, rows.groupBy(*TABLE).agg(first), TABLE, ["row"])
    is_header = F.col("flagged") | (F.col("styled") & (F.col("row") == F.col("first_header")))
    return rows.select(*ROW, "n_cols", is_header.alias("is_header"))


def first_body(rows: DataFrame) -> DataFrame:
    """First body row of each table (null if none) and whether headers come before it."""
    body = F.min(F.when(~F.col("is_header"), F.col("row")))
    header = F.min(F.when(F.col("is_header"), F.col("row")))
    return rows.groupBy(*TABLE).agg(
        F.max("n_cols").alias("n_cols"),
        body.alias("first_body"),
        F.coalesce(header < body, header.isNotNull()).alias("has_header"),
    )


def _starts(cell: DataFrame) -> DataFrame:
    # cells of one table row
    before = Window.partitionBy(*ROW).orderBy("cell_no").rowsBetween(Window.unboundedPreceding, -1)
    return cell.withColumn("start", F.coalesce(F.sum("span").over(before), F.lit(0)).cast("int"))


def expand_spans(cell: DataFrame) -> DataFrame:
    """One row per grid position: a cell that spans s columns is followed by s - 1 empty ones."""
    shift = F.explode(F.sequence(F.lit(0), F.greatest(F.col("span"), F.lit(1)) - 1)).alias("k")
    return _starts(cell).select(*ROW, "n_cols", "start", "md", shift).select(
        *ROW, "n_cols", (F.col("start") + F.col("k")).alias("col"), F.when(F.col("k") == 0, F.col("md")).alias("md")
    )


def table_aligns(cell: DataFrame, first: DataFrame) -> DataFrame:
    """Alignment of each column: the last one set in header rows and the first body row.

    A spanning cell sets its last column; justified counts as left.
    """
    align = F.when(M.norm_align("jc") == "justified", "left").otherwise(M.norm_align("jc"))
    placed = _starts(cell).select(
        *ROW, (F.col("start") + F.col("span") - 1).alias("col"), align.alias("align")
    )
    upto = spread_lookup(placed, first.select(*TABLE, "first_body", "n_cols"), TABLE, ["row", "col"], "inner").where(
        (F.col("row") <= F.col("first_body")) & (F.col("col") < F.col("n_cols"))
    )
    known = upto.groupBy(*TABLE, "col").agg(F.max_by("align", "row").alias("align"))
    every = first.where(F.col("first_body").isNotNull()).select(
        *TABLE, F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1)).alias("col")
    )
    return every.join(known, [*TABLE, "col"], "left").withColumn("align", F.coalesce("align", F.lit("left")))


def separators(aligns: DataFrame) -> DataFrame:
    """The line between headers and body."""
    mark = F.when(F.col("align") == "center", ":--:|").when(F.col("align") == "right", "---:|").otherwise(":---|")
    marks = F.transform(F.sort_array(F.collect_list(F.struct("col", mark.alias("m")))), lambda x: x["m"])
    return aligns.groupBy(*TABLE).agg(F.concat(F.lit("|"), F.array_join(marks, "")).alias("text"))


def blank_header(first: DataFrame) -> DataFrame:
    """The empty header row of tables whose first row is a body row."""
    return first.where(F.col("first_body").isNotNull() & ~F.col("has_header")).select(
        *TABLE, F.concat(F.lit("| &nbsp; "), F.repeat(F.lit("|"), F.col("n_cols"))).alias("text")
    )


def cell_notes(grid: DataFrame) -> DataFrame:
    """Text of each grid cell; text with a line end or ``|`` moves to a note numbered in document order.

    Adds ``shown`` and, for moved text, ``note_no``. Positions past the table's columns are not shown.
    """
    text = M.trim_end("md")
    trimmed = grid.where(F.col("col") < F.col("n_cols")).withColumn("md", text)
    moved = F.coalesce(F.col("md").rlike(r"[\r\n|]"), F.lit(False))
    block = F.struct(F.col("tbl"), block_of("row", ROW_BLOCK).alias("b"))
    out = running(
        trimmed, ["path"], ["tbl", "row", "col"], block, {"__n": Scan("sum", moved.cast("int"))}
    )
    number = F.when(moved, F.col("__n"))
    shown = (
        F.when(F.col("md").isNull(), "|")
        .when(moved, F.concat(F.lit("| [^n"), F.col("__n").cast("string"), F.lit("] ")))
        .otherwise(F.concat(F.lit("| "), F.col("md"), F.lit(" ")))
    )
    return out.select(*ROW, "n_cols", "col", "md", shown.alias("shown"), number.alias("note_no"))


def table_rows(noted: DataFrame) -> DataFrame:
    """Text of each table row, padded to the columns of the table."""
    cells = F.sort_array(F.collect_list(F.struct("col", "shown")))
    rows = noted.groupBy(*ROW).agg(cells.alias("c"), F.max("n_cols").alias("n_cols"))
    pad = F.repeat(F.lit("|"), F.col("n_cols") - F.size("c"))
    text = F.concat(F.array_join(F.transform("c", lambda x: x["shown"]), ""), pad, F.lit("|"))
    return rows.select(*ROW, text.alias("text"))


def table_lines(cell: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of all tables (path, tbl, row, rank, text) and the notes their cells moved to.

    Sorted by (row, rank), rank 0 is the blank header, 1 the separator, 2 the row itself.
    """
    first = first_body(header_rows(cell))
    noted = cell_notes(expand_spans(cell))

    def above(df: DataFrame, rank: int) -> DataFrame:
        at = first.where(F.col("first_body").isNotNull()).select(*TABLE, F.col("first_body").alias("row"))
        return df.join(at, TABLE).select(*ROW, F.lit(rank).alias("rank"), "text")

    lines = (
        table_rows(noted).select(*ROW, F.lit(2).alias("rank"), "text")
        .unionByName(above(separators(table_aligns(cell, first)), 1))
        .unionByName(above(blank_header(first), 0))
    )
    moved = noted.where(F.col("note_no").isNotNull()).select("path", "note_no", "md")
    return lines, moved
