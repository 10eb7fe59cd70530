"""Notes, images, captions and the assembly of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctables.functions import text as M
from doctables.operators.running import BLOCK_ROWS, Scan, block_of, running, spread_lookup

# order of the pieces of a document; a header has values, then lengths and options, then its end
HEADER, HEADER_OPTIONS, HEADER_END, BODY, TABLE_NOTE, FOOTNOTE, ENDNOTE = range(7)


def note_refs(ref: DataFrame, note: DataFrame) -> DataFrame:
    """Text of each note reference; references to missing notes are dropped."""
    known = note.select("path", "kind", "id")
    found = spread_lookup(ref, known, ["path", "kind", "id"], ["pos"], "inner")
    return found.withColumn(
        "md", F.concat(F.lit("[^"), "kind", F.col("id").cast("string"), F.lit("]"))
    )


def note_blocks(note: DataFrame, ref: DataFrame) -> DataFrame:
    """Blocks of the referenced notes: (path, rank, pos, text), footnotes before endnotes."""
    used = ref.select("path", "kind", "id").distinct()
    label = F.concat("kind", F.col("id").cast("string"))
    return note.join(used, ["path", "kind", "id"], "left_semi").select(
        "path",
        F.when(F.col("kind") == "fn", FOOTNOTE).otherwise(ENDNOTE).alias("rank"),
        F.col("id").alias("pos"),
        M.note_block(label, "md").alias("text"),
    )


def table_note_blocks(moved: DataFrame) -> DataFrame:
    """Blocks of the table cells that were moved to notes."""
    label = F.concat(F.lit("n"), F.col("note_no").cast("string"))
    return moved.select(
        "path", F.lit(TABLE_NOTE).alias("rank"), F.col("note_no").alias("pos"),
        M.note_block(label, "md").alias("text"),
    )


def attach_captions(block: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Give each image (kind image) the next caption as ``alt``, and drop the captions used.

    A caption belongs to the mark before it if that is an image; otherwise it stays text.
    """
    mark = F.when(F.col("kind").isin("image", "caption"), F.struct("kind", "text"))
    out = running(
        block, ["path"], ["pos"], block_of("pos", block_rows),
        {
            "__prev": Scan("last", mark, before=True),
            "__next": Scan("last", mark, before=True, backward=True),
        },
    )
    taken = (F.col("kind") == "caption") & F.coalesce(F.col("__prev")["kind"] == "image", F.lit(False))
    alt = F.when(
        F.col("kind") == "image",
        F.coalesce(F.when(F.col("__next")["kind"] == "caption", F.col("__next")["text"]), F.lit("")),
    )
    return out.where(~taken).withColumn("alt", alt).drop("__prev", "__next")


def toc_blocks(block: DataFrame, gallery: Column, group: list[str]) -> DataFrame:
    """Each contents-list block becomes one placeholder image at its first row."""
    is_toc = F.coalesce(gallery == "Table of Contents", F.lit(False))
    places = block.where(is_toc).groupBy(*group).agg(F.min("pos").alias("pos")).select(
        "path", "pos", F.lit("![](toc)\n\n").alias("text")
    )
    return block.where(~is_toc).select("path", "pos", "text").unionByName(places)


def part_of(rank: Column | str, pos: Column | str, block_rows: int = BLOCK_ROWS) -> Column:
    """Number of the stretch of positions that a line lies in; rises with (rank, pos)."""
    rank = F.col(rank) if isinstance(rank, str) else rank
    return rank.cast("long") * (1 << 50) + block_of(pos, block_rows) + 1


def pack_text(lines: DataFrame, keys: list[str], text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Join lines (keys, rank, pos, text, and line if given) into texts: (keys, part, text).

    Each stretch of ``block_rows`` positions of a rank gives one row, in documents of every
    size alike. In the order of ``part`` the rows make the whole text.
    """
    order = ["rank", "pos", *(["line"] if "line" in lines.columns else [])]
    pieces = F.sort_array(F.collect_list(F.struct(*order, F.col(text).alias("x"))))
    parted = lines.withColumn("part", part_of("rank", "pos", block_rows))
    return parted.groupBy(*keys, "part").agg(pieces.alias("p")).select(
        *keys, "part", F.array_join(F.transform("p", lambda x: x["x"]), "").alias("text")
    )


def assemble(blocks: list[DataFrame], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Documents from their blocks (path, rank, pos, text, line if given): header, body, then notes."""
    def ordered(b: DataFrame) -> DataFrame:
        line = F.col("line") if "line" in b.columns else F.lit(0)
        return b.select("path", "rank", F.col("pos").cast("long").alias("pos"), line.cast("int").alias("line"), "text")

    lines = ordered(blocks[0])
    for b in blocks[1:]:
        lines = lines.unionByName(ordered(b))
    return pack_text(lines, ["path"], block_rows=block_rows)
