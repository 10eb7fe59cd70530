"""Reading grid literals back: the text of a workbook as sheets and cells, whatever its layout.

A literal is scanned by one regular expression without nested repeats, so long texts need no deep stack. Where a token stands
follows from sums along the tokens: sheets and rows opened so far, and commas since the row was opened. Tokens are gathered once, in
blocks; sums are taken in each block, a row per block carries them on, and a block's cells stay one row until they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doctables.operators.cells import same_grid
from doctables.operators.running import block_of
from doctables.sources.staging import staged

#: Parts a sheet may have, in the numbers that order them.
SHEET_PARTS = 1 << 40
#: Tokens of a part that are placed at a time.
TOKEN_BLOCK = 4096
BLOCK = ["path", "part", "__b"]

_NUMBERS = r",\s*'Left':\s*(\d+),\s*'Top':\s*(\d+),\s*'Right':\s*(\d+),\s*'Bottom':\s*(\d+),\s*'Data':\s*(null|\[)"
SHEET_TOKEN = r"(?s)'.*?':\s*\{\s*'Name':\s*'(.*?)'" + _NUMBERS
#: The opening of a sheet, a text, a date, a run of commas, a row's opening, or the characters of another value.
TOKEN = SHEET_TOKEN + r"""|"[^"]*"|DateTime\([^)]*\)|,+|\[|[^\s\[\],{}"']+"""
# two characters that end no escape stand for the escaped backslash and quote while a text is scanned
_HIDDEN = [("\\\\", "\\B"), ('\\"', "\\Q")]


def _hide(text: Column) -> Column:
    for escape, hidden in _HIDDEN:
        text = F.replace(text, F.lit(escape), F.lit(hidden))
    return text


def _show(text: Column) -> Column:
    for escape, hidden in reversed(_HIDDEN):
        text = F.replace(text, F.lit(hidden), F.lit(escape))
    return text


def _plain(hidden: Column) -> Column:
    """Text that a scanned literal without its quotes stands for."""
    for escape, plain in [("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\Q", '"'), ("\\B", "\\")]:
        hidden = F.replace(hidden, F.lit(escape), F.lit(plain))
    return hidden


def in_order(part: DataFrame) -> DataFrame:
    """Parts as workbook_literal gives them, numbered through the workbook: (path, part, text)."""
    return part.select("path", (F.col("sheet_no").cast("long") * SHEET_PARTS + F.col("part")).alias("part"), "text")


def literal_tokens(part: DataFrame) -> DataFrame:
    """Tokens of the parts of literals: (path, part, i, token).

    Parts (path, part, text) in the order of ``part`` make a whole text; none begins or ends inside a value or inside the
    opening of a sheet. Null texts have no tokens. Write the result out before read_literal, which reads it several times.
    """
    tokens = F.regexp_extract_all(_hide(F.col("text")), F.lit(TOKEN), F.lit(0))
    return part.select("path", F.col("part").cast("long").alias("part"), F.posexplode(tokens).alias("i", "token"))


_HEAD = "struct<sheet_name: string, left: int, top: int, right: int, bottom: int, has_data: boolean>"
_CELL = "struct<sheet: int, below: bigint, at: bigint, here: boolean, token: string>"


def _head(token: Column) -> Column:
    """Name and bounds of the sheet that a token opens."""
    def group(i: int) -> Column:
        return F.regexp_extract(token, SHEET_TOKEN, i)

    bounds = [group(i).cast("int").alias(name) for i, name in enumerate(["left", "top", "right", "bottom"], 2)]
    return F.struct(_plain(group(1)).alias("sheet_name"), *bounds, (group(6) == "[").alias("has_data"))


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of each block: sheets opened in the block, rows since the last of them and commas since the last row, else since
    the block begins; ``here`` says whether that row was opened in the block. And what goes on to the next block."""
    kinds = [("sheet", pa.int32()), ("below", pa.int64()), ("at", pa.int64()), ("here", pa.bool_()), ("token", pa.string())]
    for batch in batches:
        lists = batch.column("tokens")
        n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        token, ends = lists.flatten(), np.cumsum(n)
        first = np.repeat(ends - n, n)

        def test(found: pa.Array) -> np.ndarray:
            return pc.fill_null(found, False).to_numpy(zero_copy_only=False)

        def sums(x: np.ndarray) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(x, dtype=np.int64)])

        def after(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Where what follows the last marked token of the block begins, and whether there is one."""
            last = np.maximum.accumulate(np.where(mark, np.arange(len(mark)), -1)) if len(mark) else first
            return np.where(last >= first, last + 1, first), last >= first

        sheet, opened, comma = test(pc.starts_with(token, "'")), test(pc.equal(token, "[")), test(pc.starts_with(token, ","))
        sheets, rows = sums(sheet), sums(opened)
        commas = sums(np.where(comma, pc.fill_null(pc.utf8_length(token), 0).to_numpy(zero_copy_only=False), 0))
        (row_at, in_row), (sheet_at, in_sheet) = after(opened), after(sheet)
        value = np.flatnonzero(test(pc.is_valid(token)) & ~(sheet | opened | comma))
        columns = [
            sheets[value] - sheets[first[value]], rows[value] - rows[sheet_at[value]], commas[value] - commas[row_at[value]], in_row[value], token.take(pa.array(value)),
        ]
        cells = pa.StructArray.from_arrays([pa.array(x, kind) for x, (_, kind) in zip(columns, kinds)], [name for name, _ in kinds])
        end = ends - 1
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in (*BLOCK, "heads")), pa.array(rows[ends] - rows[ends - n]), pa.array(commas[ends] - commas[ends - n]),
                pa.array(rows[ends] - rows[sheet_at[end]], mask=~in_sheet[end]), pa.array(commas[ends] - commas[row_at[end]], mask=~in_row[end]),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(value, np.concatenate([[0], ends])), pa.int32()), cells),
            ],
            [*BLOCK, "heads", "rows", "commas", "below", "since", "cells"],
        )


def _placed(token: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of tokens with their sheets and cells, and a row per block with the sums up to its end.

    Both are written out: cells and sheets read them, and what came before a block is known when all blocks are.
    """
    one = F.struct("i", "token")
    lists = token.groupBy("path", "part", block_of("i", TOKEN_BLOCK).alias("__b")).agg(F.sort_array(F.collect_list(one)).alias("e"))
    lists = lists.select(*BLOCK, F.transform("e", lambda x: x["token"]).alias("tokens"))
    heads = F.transform(F.filter("tokens", lambda x: F.startswith(x, F.lit("'"))), _head)
    schema = f"path string, part bigint, __b bigint, heads array<{_HEAD}>, rows bigint, commas bigint, below bigint, since bigint, cells array<{_CELL}>"
    block = staged(lists.withColumn("heads", heads).mapInArrow(_place, schema), "placed")
    so_far = Window.partitionBy("path").orderBy("part", "__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"sheets": F.size("heads"), "rows": F.col("rows"), "commas": F.col("commas")}
    ends = block.select(*BLOCK, "below", "since", F.get("heads", F.size("heads") - 1).alias("head"), *[F.sum(x).over(so_far).alias(c) for c, x in sums.items()])
    begun, opened = (F.col("rows") - F.col("below")).alias("begun"), (F.col("commas") - F.col("since")).alias("opened")
    return block, staged(ends.select(*BLOCK, "head", *sums, begun, opened), "ends")


def _carried(ends: DataFrame) -> DataFrame:
    """What each block finds: sheets opened before it, the last of them, rows since then and commas since the last row."""
    before = Window.partitionBy("path").orderBy("part", "__b").rowsBetween(Window.unboundedPreceding, -1)

    def most(c: str) -> Column:
        return F.max(c).over(before)

    return ends.select(
        *BLOCK, most("sheets").alias("__sheets"), F.last("head", True).over(before).alias("__head"),
        (most("rows") - most("begun")).alias("__below"), (most("commas") - most("opened")).alias("__since"),
    )


def literal_sheets(token: DataFrame) -> DataFrame:
    """Sheets of literals as sheet_summary gives them: (path, sheet_no, sheet_name, left, top, right, bottom, has_data)."""
    return _sheets(*_placed(token))


def _sheets(block: DataFrame, ends: DataFrame) -> DataFrame:
    """A block's sheets count on from those up to its end."""
    opening = block.where(F.size("heads") > 0).select(*BLOCK, "heads").join(ends.select(*BLOCK, "sheets"), BLOCK)
    first = F.col("sheets") - F.size("heads")
    return opening.select("path", first.alias("__first"), F.posexplode("heads").alias("i", "h")).select(
        "path", (F.col("__first") + F.col("i")).cast("int").alias("sheet_no"), "h.*"
    )


def read_literal(token: DataFrame) -> DataFrame:
    """Cells of literals: (path, sheet_no, row, col, kind, raw, literal).

    ``literal`` is the value as written, ``raw`` the text it stands for (dates in ISO form), ``kind`` text, number, boolean or
    date. Blanks give no cell. Layout between values does not matter. Values before the first sheet or row belong to none and
    are left out. Dates that no calendar has keep their text.
    """
    return _cells(*_placed(token))


def _cells(block: DataFrame, ends: DataFrame) -> DataFrame:
    found = block.where(F.size("cells") > 0).select(*BLOCK, "heads", "cells").join(_carried(ends), BLOCK, "left")

    def at_place(x: Column) -> Column:
        own = x["sheet"] > 0
        head = F.when(own, F.get("heads", x["sheet"] - 1)).otherwise(F.col("__head"))
        below = x["below"] + F.when(own, 0).otherwise(F.coalesce("__below", F.lit(0)))
        at = x["at"] + F.when(x["here"], 0).otherwise(F.coalesce("__since", F.lit(0)))
        return F.struct(
            (F.coalesce("__sheets", F.lit(0)) + x["sheet"] - 1).cast("int").alias("sheet_no"), (head["top"] + below - 1).cast("int").alias("row"),
            (head["left"] + at).cast("int").alias("col"), x["token"].alias("token"), (head["has_data"] & (below > 0)).alias("inside"),
        )

    cells = found.where(F.col("path").isNotNull()).select("path", F.explode(F.transform("cells", at_place)).alias("x")).select("path", "x.*")
    token_ = F.col("token")
    kind = (
        F.when(F.startswith(token_, F.lit('"')), "text").when(F.startswith(token_, F.lit("DateTime(")), "date")
        .when(token_.isin("true", "false"), "boolean").otherwise("number")
    )
    return cells.where("inside").select(
        "path", "sheet_no", "row", "col", kind.alias("kind"),
        F.when(kind == "text", _plain(F.substr(token_, F.lit(2), F.length(token_) - 2)))
        .when(kind == "date", F.coalesce(_date(token_), token_)).otherwise(token_).alias("raw"),
        _show(token_).alias("literal"),
    )


def _date(token: Column) -> Column:
    """ISO text of ``DateTime(y,m,d,h,m,s)`` with milliseconds if they are given; null if it is no date."""
    n = F.transform(F.regexp_extract_all(token, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("int"))

    def at(i: int) -> Column:
        return F.coalesce(F.get(n, F.lit(i)), F.lit(0))

    text = F.format_string("%04d-%02d-%02d %02d:%02d:%02d.%03d", *[at(i) for i in range(7)])
    return F.date_format(text.try_cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS")


def same_literal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Where two workbooks of tokens differ: (path, sheet_no, row, col, a, b); no rows means they mean the same.

    Names and bounds of sheets count as row and column 0. Layout does not matter.
    """
    def content(token: DataFrame) -> DataFrame:
        block, ends = _placed(token)
        facts = F.to_json(F.struct("sheet_name", "left", "top", "right", "bottom", "has_data"))
        head = _sheets(block, ends).select("path", "sheet_no", F.lit(0).alias("row"), F.lit(0).alias("col"), facts.alias("literal"))
        return head.unionByName(_cells(block, ends).select("path", "sheet_no", "row", "col", "literal"))

    return same_grid(content(a), content(b), "literal")
