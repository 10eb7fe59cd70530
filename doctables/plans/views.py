"""Document tables derived from the driver tables (Spark side).

The matching DuckDB text is in ``oracle_views``. Keys grow with the data: a
workbook holds 1000 orders, a form 40 parts, a text document one row. ``cells_hot``,
``fields``, ``marks`` and ``notes`` keep a few very large groups on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doctables.functions.cells import col_name
from doctables.operators.running import block_of, row_numbers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(n: Column, values: list) -> Column:
    """The item at ``n % size``; None gives null."""
    out = F.lit(None).cast("string")
    slot = n % len(values)
    for i, v in enumerate(values):
        if v is not None:
            out = F.when(slot == i, F.lit(v)).otherwise(out)
    return out


def _div(c: Column, by: int) -> Column:
    return F.call_function("div", c.cast("long"), F.lit(by).cast("long"))


# --- spreadsheets -----------------------------------------------------------------


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: seven cells per order, with every declared type and its odd values."""
    key = F.col("o_orderkey")
    row = (1 + key % 200).cast("int")
    day = F.col("o_orderdate")
    date_text = (
        F.when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 5 == 2, (20000 + key % 20000).cast("string"))
        .when(key % 5 == 3, F.lit("soon"))
        .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:20:30")))
    )
    priority = (F.substring("o_orderpriority", 1, 1).cast("int") - 1).cast("string")
    index = F.when(key % 10 == 0, "99").when(key % 10 == 1, "x").otherwise(priority)
    flag = F.when(key % 3 == 0, "1").when(key % 3 == 1, "FALSE").otherwise("maybe")
    loose = pick(key, ["1e3", " 12 ", "TRUE", "yes", "NaN", "", "-7.25", "text"])
    values = [
        ("n", key.cast("string")),
        ("str", F.col("o_orderstatus")),
        ("n", F.col("o_totalprice").cast("string")),
        ("d", date_text),
        ("s", index),
        ("b", flag),
        (None, loose),
    ]
    each = F.posexplode(
        F.array(*[F.struct(F.lit(t).cast("string").alias("t"), v.alias("raw")) for t, v in values])
    ).alias("i", "v")
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("wb"), _div(key, 1000).cast("string")).alias("path"),
        (_div(key, 200) % 5).cast("int").alias("sheet_no"),
        row.alias("row"),
        (key % 50).alias("shape"),
        each,
    )
    col = (F.col("i") + 1).cast("int")
    letters, number = F.char(F.col("i") + 65), F.col("row").cast("string")
    ref = (
        F.when(F.col("shape") == 0, F.concat(number, letters))
        .when(F.col("shape") == 1, F.concat(F.lit("$"), letters, number))
        .when(F.col("shape") == 2, F.concat(F.lower(letters), number))
        .otherwise(F.concat(letters, number))
    )
    return orders.select(
        "path", "sheet_no", "row", col.alias("col"), ref.alias("ref"),
        F.col("v.t").alias("t"), F.col("v.raw").alias("raw"),
    )


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sheet of V1, with a declared range that may be missing or unusable."""
    key = F.col("o_orderkey")
    book, sheet_no = _div(key, 1000), (_div(key, 200) % 5).cast("int")
    n = F.col("book") + F.col("sheet_no")
    return (
        table(spark, sf_dir, "orders")
        .select(book.alias("book"), sheet_no.alias("sheet_no"))
        .distinct()
        .select(
            F.concat(F.lit("wb"), F.col("book").cast("string")).alias("path"),
            "sheet_no",
            F.concat(F.lit("Sheet "), (F.col("sheet_no") + 1).cast("string")).alias("sheet_name"),
            pick(n, [None, "A1", "A1:G200", "B3:F150"]).alias("dim_ref"),
        )
    )


def shared_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V14: the priorities of a workbook, indexed in alphabetical order."""
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.concat(F.lit("wb"), _div(F.col("o_orderkey"), 1000).cast("string")).alias("path"),
            (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("idx"),
            F.col("o_orderpriority").alias("text"),
        )
        .distinct()
    )


LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def cells_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: eleven columns of every line item in 16 sparse sheets, with empty rows."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "path", F.concat(F.lit("wb"), (F.col("l_suppkey") % 16).cast("string"))
    )
    numbered = row_numbers(
        lines,
        ["path"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
        block_of("l_orderkey", 4096),
    )
    texts = [
        F.date_format(c, "yyyy-MM-dd") if c == "l_shipdate" else F.col(c).cast("string")
        for c in LINE_COLUMNS
    ]
    places = F.array(*[F.lit(i) for i in range(len(texts))])
    # places are made apart from the texts, so that who asks for places only makes no text
    return (
        numbered.select("path", "row", F.array(*texts).alias("texts"))
        .select("path", "row", "texts", F.explode(places).alias("i"))
        .select(
            "path",
            F.lit(0).alias("sheet_no"),
            F.col("row").cast("int").alias("row"),
            (F.col("i") + 1).cast("int").alias("col"),
            F.get("texts", F.col("i")).alias("raw"),
        )
        .where(((F.col("row") + F.col("col")) % 3 != 0) & (F.col("row") % 7 != 3))
        .select(
            "path", "sheet_no", "row", "col",
            F.concat(col_name("col"), F.col("row").cast("string")).alias("ref"),
            F.when(F.col("col") <= 8, "n").otherwise("str").alias("t"),
            "raw",
        )
    )


# --- text documents ----------------------------------------------------------------

STYLES = [
    "Heading1", "heading 2", "Rubrik 3", "Titre4", "Title", "Quote", "ListParagraph", "Caption",
    "Normal", "Unknown1", None, None,
]
ALIGNS = ["left", "start", "center", "right", "both", None]
UNDERLINES = [None, None, None, None, None, None, None, None, "single", "double", "wave", "thick", "none"]


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: one paragraph per line of a document."""
    n = F.col("n")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
        .withColumn("n", F.col("doc_id") * 7 + F.col("pos") * 3)
        .select(
            F.col("doc_id").alias("path"),
            F.col("pos").cast("int").alias("pos"),
            "text",
            "n",
            pick(n, STYLES).alias("style_id"),
            pick(n, ALIGNS).alias("jc"),
            F.when(n % 4 != 3, 1 + n % 2).cast("int").alias("num_id"),
            (n % 3).cast("int").alias("ilvl"),
            (n % 11 == 0).alias("border"),
            F.when(n % 13 == 0, 1 + n % 3).cast("int").alias("break_cols"),
            (n % 9 == 0).alias("mono"),
        )
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: one run per word."""
    k = F.col("k")
    return (
        paragraphs(spark, sf_dir)
        .select("path", F.col("pos").alias("para_pos"), "n",
                F.posexplode(F.split("text", " ", -1)).alias("run_pos", "word"))
        .withColumn("k", F.col("n") + F.col("run_pos"))
        .select(
            "path", "para_pos", F.col("run_pos").cast("int").alias("run_pos"),
            F.when(F.col("run_pos") > 0, F.concat(F.lit(" "), "word")).otherwise(F.col("word")).alias("text"),
            (k % 5 == 0).alias("bold"),
            (k % 7 == 0).alias("italic"),
            pick(k, UNDERLINES).alias("underline"),
            (k % 37 == 0).alias("strike"),
            (k % 41 == 0).alias("dstrike"),
            F.when(k % 17 == 0, "superscript").when(k % 17 == 1, "subscript").alias("vert"),
            (k % 19 == 0).alias("mono"),
            (k % 23 == 0).alias("ins"),
            (k % 29 == 0).alias("del"),
            F.when(k % 31 == 0, F.concat(F.lit("r"), (k % 10).cast("string"))).alias("link_id"),
        )
    )


# tags that count without a text behind them
BARE_TAGS = ("h1", "p", "li", "a", "br", "b", "nav")
TAG_NAME = "^/?[A-Za-z][A-Za-z0-9]*"
HREF = r'<a href="([^"]*)"'


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: a page cut at each ``<``, tag (with ``/`` where it closes) and the whole text behind it.

    Text ahead of all tags, or behind a ``<`` that no ``>`` follows, has the tag ``text``; comments and declarations have ``!``.
    Closing and other tags without a text are left out.
    """
    piece, close = F.col("piece"), F.instr("piece", ">")
    name = F.regexp_extract(piece, TAG_NAME, 0)
    tag = F.when((F.col("pos") == 0) | (close == 0), "text").when(name == "", "!").otherwise(name)
    text = F.when(F.col("pos") == 0, piece).when(close == 0, F.concat(F.lit("<"), piece)).otherwise(F.substr(piece, close + 1))
    return (
        table(spark, sf_dir, "pages")
        .select(F.col("page_id").alias("path"), F.posexplode(F.split("html", "<", -1)).alias("pos", "piece"))
        .select("path", F.col("pos").cast("int").alias("pos"), tag.alias("tag"), text.alias("text"))
        .where((F.col("text") != "") | F.col("tag").isin(*BARE_TAGS))
    )


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a page: id by order of appearance, and target."""
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("i", "target"))
        .select(F.col("page_id").alias("path"), F.concat(F.lit("r"), F.col("i").cast("string")).alias("rel_id"),
                "target")
    )


def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V13: paragraphs laid out as a table of four cells a row."""
    n = F.col("n")
    row = _div(F.col("pos"), 4).cast("int")
    return paragraphs(spark, sf_dir).select(
        "path",
        F.lit(0).alias("tbl"),
        row.alias("row"),
        (F.col("pos") % 4).cast("int").alias("cell_no"),
        F.when(n % 10 == 0, 2).otherwise(1).alias("span"),
        ((row == 0) & (F.col("path") % 2 == 0)).alias("header_flag"),
        ((row == 0) & (F.col("path") % 3 == 0)).alias("first_row"),
        "jc",
        F.lit(4).alias("n_cols"),
        F.when(n % 15 == 0, F.concat("text", F.lit("\nmore"))).otherwise(F.col("text")).alias("md"),
    )


def numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V11 instances: each document numbers its lists 1 and 2."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("path"),
        F.explode(F.array(
            F.struct(F.lit(1).alias("num_id"), F.lit(10).alias("abstract_id")),
            F.struct(F.lit(2).alias("num_id"), F.lit(20).alias("abstract_id")),
        )).alias("v"),
    ).select("path", "v.num_id", "v.abstract_id")


LEVELS = [
    (10, 0, "decimal", 1), (10, 1, "lowerLetter", 1), (10, 2, "decimal", 1),
    (20, 0, "bullet", 5), (20, 1, "none", 5), (20, 2, "decimal", 5),
]


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V11 definitions: format and start of each level, per document."""
    items = F.array(*[
        F.struct(F.lit(a).alias("abstract_id"), F.lit(i).alias("ilvl"), F.lit(f).alias("fmt"), F.lit(s).alias("start"))
        for a, i, f, s in LEVELS
    ])
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("path"), F.explode(items).alias("v")
    ).select("path", "v.*")


# --- fields, forms, properties -------------------------------------------------------


def controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: one form control per part, 40 to a form."""
    key = F.col("p_partkey")
    tags = ["text", "checkBox", "comboBox", "dropDownList", "date", "time", "number", "calculated"]
    tag = F.col("tag")

    def item(value, display):
        return F.struct(value.alias("value"), display.alias("display"))

    items = F.array(
        item(F.col("p_brand"), F.concat(F.lit("Brand "), "p_brand")),
        item(F.col("p_type"), F.lit("")),
        item(F.col("p_size").cast("string"), F.col("p_name")),
    )
    return (
        table(spark, sf_dir, "part")
        .withColumn("tag", pick(F.col("p_size") % 8, tags))
        .select(
            F.concat(F.lit("form"), _div(key, 40).cast("string")).alias("path"),
            key.alias("pos"),
            F.when(key % 9 == 4, F.concat(F.lit("Part "), (key - 1).cast("string"), F.lit(" Extra")))
            .otherwise(F.concat(F.lit("Part "), key.cast("string"))).alias("alias"),
            "tag",
            F.when(tag == "checkBox", key % 3 == 0).alias("checked"),
            F.when(key % 3 == 0, F.col("p_name")).alias("default_value"),
            F.when(key % 10 == 7, F.concat("p_type", F.lit("\n"), "p_brand"))
            .otherwise(F.col("p_type")).alias("shown"),
            F.when(key % 4 == 0, F.col("p_size")).alias("max_len"),
            F.when(tag.isin("comboBox", "dropDownList"), items).alias("items"),
        )
    )


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: one field instruction per event."""
    key = F.col("event_id")
    instr = (
        F.when(key % 6 == 0, F.concat(F.lit("SEQ "), "event_type", F.lit(r" \* ARABIC")))
        .when(key % 6 == 1, F.lit(" AUTHOR "))
        .when(key % 6 == 2, F.lit(r"CREATEDATE \@ yyyy-MM-dd HH:mm"))
        .when(key % 6 == 3, F.lit("title"))
        .when(key % 6 == 4, F.lit("PAGE"))
        .otherwise(F.lit(r"SAVEDATE a b \@ yyyy"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("path"), key.alias("pos"), instr.alias("instr"),
        F.col("ts").alias("ts"),
    )


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V12: four package properties per customer, in long form."""
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    wide = table(spark, sf_dir, "customer").join(
        names, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    values = F.array(*[
        F.struct(F.lit(name).alias("name"), value.alias("value"))
        for name, value in [
            ("Title", F.col("c_name")),
            ("Subject", F.col("c_mktsegment")),
            ("Category", F.concat("n_name", F.lit("\r\n"), "c_mktsegment")),
            ("Language", F.when(F.col("c_custkey") % 3 != 0, F.lit("en-GB"))),
            ("Creator", F.concat(F.lit("Clerk "), (F.col("c_custkey") % 7).cast("string"))),
        ]
    ])
    return (
        wide.select(F.col("c_custkey").alias("path"), F.explode(values).alias("v"))
        .select("path", "v.name", "v.value")
        .where(F.col("value").isNotNull())
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: every document is a note of its source."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("path"),
        F.when(F.col("doc_id") % 2 == 0, "fn").otherwise("en").alias("kind"),
        F.col("doc_id").alias("id"),
        F.col("text").alias("md"),
    )


def note_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: labelled documents are referenced; every tenth reference names no note."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return (
        table(spark, sf_dir, "labels").select("doc_id").join(docs, "doc_id")
        .select(
            F.col("source").alias("path"),
            F.when(F.col("doc_id") % 2 == 0, "fn").otherwise("en").alias("kind"),
            F.when(F.col("doc_id") % 10 == 9, -F.col("doc_id")).otherwise(F.col("doc_id")).alias("id"),
            F.col("doc_id").alias("pos"),
        )
    )


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V10: images, captions and other paragraphs of a user."""
    kind = (
        F.when(F.col("event_type").isin("view", "purchase"), "image")
        .when(F.col("event_type") == "click", "caption")
        .otherwise("other")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("path"), F.col("event_id").alias("pos"), kind.alias("kind"),
        F.concat(F.lit("evt "), F.col("event_id").cast("string")).alias("text"),
    )


def bookmark_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V16: turns of a conversation as marks and texts of one paragraph."""
    n = F.col("conv_id") + F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("path"), F.col("turn").alias("pos"),
        pick(n, ["start", "text", "field", "text", "end", "start", "text", "end", "text"]).alias("kind"),
        "text",
    )


def lang_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language tags of the texts of a source, in order."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("path"), F.col("doc_id").alias("pos"),
        F.when(F.col("doc_id") % 2 == 0, F.concat("lang", F.lit("-X1"))).otherwise(F.col("lang")).alias("tag"),
    )
