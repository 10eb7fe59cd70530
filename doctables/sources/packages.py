"""Reading and writing document packages.

Opening a zip and walking XML in document order are the two places where
Python runs; both stream part by part. Everything after that is DataFrames.
"""

from __future__ import annotations

import codecs
import io
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from itertools import accumulate
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doctables.functions import cells as C
from doctables.functions import fixed
from doctables.operators.corpus import output_path
from doctables.sources import split

PART_SCHEMA = (
    "path string, kind string, part string, xml string, bin binary, error string, "
    "role string, content_type string, via array<struct<owner string, rel_id string>>"
)
ELEMENT_SCHEMA = (
    "path string, part string, pos bigint, depth int, parent bigint, ns string, tag string, "
    "attrs map<string,string>, within map<string,bigint>, text string"
)
XML_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}
BATCH_ROWS = 8192
BATCH_BYTES = 4 << 20


# --- kinds ------------------------------------------------------------------------------


def kind_of(name: Column | str) -> Column:
    """Kind of a file from its path or content type, any case; null if it is neither."""
    name = F.lower(F.col(name) if isinstance(name, str) else name)
    extension = F.regexp_extract(name, r"\.([^./]*)\z", 1)
    out = F.lit(None).cast("string")
    for kind, content_type in fixed.CONTENT_TYPES.items():
        out = F.when((extension == kind) | (name == content_type), kind).otherwise(out)
    return out


def classify_input(length: Column | str, error: Column | str, kind: Column | str, wanted: str) -> Column:
    """Why a file cannot be converted; null if it can."""
    length, error, kind = (F.col(c) if isinstance(c, str) else c for c in (length, error, kind))
    return (
        F.when(F.coalesce(length, F.lit(0)) == 0, "no content")
        .when(error.endswith(split.NO_MAIN_PART), "not the expected kind")
        .when(error.isNotNull(), "decode error")
        .when(~kind.eqNullSafe(F.lit(wanted)), "not the expected kind")
    )


# --- scan and unpack ----------------------------------------------------------------------


def _package(files: DataFrame) -> DataFrame:
    return files.select(
        "path", kind_of("path").alias("kind"), "length",
        F.col("modificationTime").alias("modified"), "content",
    )


def scan_packages(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """Files of a folder by name pattern: (path, kind, length, modified, content)."""
    if "*" in folder:
        raise ValueError("folder cannot contain wildcards")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return _package(reader.option("recursiveFileLookup", str(recursive).lower()).load(folder))


def read_packages(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files at these paths; no character of a path is a wildcard."""
    return _package(spark.read.format("binaryFile").load([re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]))


def stream_packages(spark: SparkSession, folder: str, glob: str = "*", max_files: int = 1000) -> DataFrame:
    """Files of a folder as they arrive, at most max_files in a batch."""
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files)
    schema = "path string, modificationTime timestamp, length long, content binary"
    return _package(reader.schema(schema).load(folder))


def _batches(rows: Iterator[tuple], schema: pa.Schema, max_rows: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size; the texts and bytes that count are the last of their kind in a row."""
    heavy = [i for i, f in enumerate(schema) if f.name in ("xml", "bin", "text")]
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_column(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        for i in heavy:
            if row[i]:
                size += len(row[i])
        if len(held) >= max_rows or size > max_bytes:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _column(values: tuple, kind: pa.DataType) -> pa.Array:
    """An Arrow column; lists of pairs are flattened first, which is much faster than conversion pair by pair."""
    if not (pa.types.is_map(kind) or pa.types.is_list(kind)):
        return pa.array(values, kind)
    ends = [0, *accumulate(len(v) if v else 0 for v in values)]
    pairs = [x for v in values if v for x in v]
    first, second = zip(*pairs) if pairs else ((), ())
    offsets = pa.array(ends, pa.int32())
    if pa.types.is_map(kind):
        return pa.MapArray.from_arrays(offsets, pa.array(first, kind.key_type), pa.array(second, kind.item_type))
    fields = kind.value_type
    found = pa.StructArray.from_arrays([pa.array(first, fields[0].type), pa.array(second, fields[1].type)], fields=list(fields))
    nulls = pa.array([v is None for v in values]) if None in values else None
    return pa.ListArray.from_arrays(offsets, found, mask=nulls)


_PART_ARROW = pa.schema([
    ("path", pa.string()), ("kind", pa.string()), ("part", pa.string()),
    ("xml", pa.string()), ("bin", pa.binary()), ("error", pa.string()), ("role", pa.string()), ("content_type", pa.string()),
    ("via", pa.list_(pa.struct([("owner", pa.string()), ("rel_id", pa.string())]))),
])


def _parts_of(path: str, kind: str | None, content) -> Iterator[tuple]:
    try:
        with split.Parts(content) as package:
            found = split.closure(package)
            split.main_part(found)
            by_part, by_extension = split.content_types(package)
            for part in package.namelist():
                how = found.get(part)
                content_type = by_part.get(part.lower(), by_extension.get(part.rpartition(".")[2].lower()))
                role, via = how or (None, None)
                data = package.read(part)
                if part.endswith((".xml", ".rels")):
                    expat.ParserCreate().Parse(data, True)  # malformed XML counts as a damaged file
                    yield path, kind, part, data.removeprefix(codecs.BOM_UTF8).decode(), None, None, role, content_type, via
                else:
                    yield path, kind, part, None, data, None, role, content_type, via
    except Exception as e:  # a file that cannot be read must not stop the others
        yield path, kind, None, None, None, f"{type(e).__name__}: {e}", None, None, None


def _open_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, kind = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                yield from _parts_of(path, kind, batch.column(2)[i].as_buffer() or b"")

    yield from _batches(rows(), _PART_ARROW, BATCH_ROWS, BATCH_BYTES)


def unpack(package: DataFrame) -> DataFrame:
    """Parts of each package with the way relationships lead to them; a file that cannot be opened, or in which no
    relationship leads to a main part, gives one row with ``error``.

    A damaged file may give some parts before its error row; use ``readable`` to
    leave such files out.
    """
    return package.select("path", "kind", "content").mapInArrow(_open_parts, PART_SCHEMA)


def readable(part: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Parts of the files that opened without error; of other rows, given their parts, those of such files."""
    failed = part.where(F.col("error").isNotNull()).select("path").distinct()
    return (part if rows is None else rows).join(failed, "path", "left_anti")


# --- XML parts ------------------------------------------------------------------------------


def _xml(df: DataFrame, schema: str) -> DataFrame:
    return df.withColumn("x", F.from_xml("xml", schema, XML_OPTIONS)).drop("xml", "bin", "error")


def read_rels(part: DataFrame) -> DataFrame:
    """Relationships: (path, source, rel_id, type, target, mode); source is the folder they start from."""
    schema = "Relationship array<struct<_Id string, _Type string, _Target string, _TargetMode string>>"
    rels = _xml(part.where(F.col("part").endswith(".rels")), schema)
    return rels.select(
        "path", F.regexp_replace("part", r"_rels/[^/]*\z", "").alias("source"),
        F.regexp_extract("part", r"_rels/([^/]*)\.rels\z", 1).alias("owner"), F.explode("x.Relationship").alias("r"),
    ).select(
        "path", "source", "owner", F.col("r._Id").alias("rel_id"),
        F.substring_index("r._Type", "/", -1).alias("type"), F.col("r._Target").alias("target"),
        F.col("r._TargetMode").alias("mode"),
    )


# fixed values: core properties and their names in the file
CORE_PROPERTIES = {
    "Title": "title",
    "Subject": "subject",
    "Creator": "creator",
    "Keywords": "keywords",
    "Description": "description",
    "Category": "category",
    "Language": "language",
    "Version": "version",
    "Revision": "revision",
    "LastModifiedBy": "lastModifiedBy",
    "Created": "created",
    "Modified": "modified",
    "LastPrinted": "lastPrinted",
}


def read_props(part: DataFrame) -> DataFrame:
    """Core properties in long form: (path, name, value). Dates are written without zone mark."""
    schema = ", ".join(f"{tag} string" for tag in CORE_PROPERTIES.values())
    core = _xml(part.where(F.col("role") == "core-properties"), schema)
    each = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            (F.regexp_replace(F.col(f"x.{tag}"), r"Z\z", "") if name in ("Created", "Modified", "LastPrinted") else F.col(f"x.{tag}")).alias("value"),
        )
        for name, tag in CORE_PROPERTIES.items()
    ])
    return core.select("path", F.explode(each).alias("v")).select("path", "v.*").where(F.length("value") > 0)


def read_sheets(part: DataFrame) -> DataFrame:
    """Sheets in workbook order: (path, sheet_no, sheet_name, part, dim_ref).

    One pass over the parts: what is gathered per workbook is its short list of sheets.
    """
    books = "sheets struct<sheet array<struct<_name string, _id string>>>"
    is_book = F.col("role") == "officeDocument"
    wanted = part.select("path", "part", "xml", "role", "via").where(is_book | F.col("role").endswith("sheet"))
    sheets = F.from_xml(F.when(is_book, F.col("xml")), books, XML_OPTIONS)["sheets"]["sheet"]
    own = F.struct(F.col("part").alias("part"), _dimension("xml").alias("ref"), F.transform("via", lambda v: v["rel_id"]).alias("ids"))
    per_book = wanted.groupBy("path").agg(
        F.any_value(sheets, True).alias("sheets"), F.collect_list(F.when(F.col("role").startswith("officeDocument/"), own)).alias("found")
    )
    listed = per_book.select("path", "found", F.posexplode("sheets").alias("sheet_no", "s"))
    hit = F.get(F.filter("found", lambda d: F.array_contains(d["ids"], F.col("s._id"))), F.lit(0))
    placed = listed.withColumn("hit", hit)
    return placed.select("path", "sheet_no", F.col("s._name").alias("sheet_name"), "hit.part", F.col("hit.ref").alias("dim_ref"))


def _dimension(xml: str) -> Column:
    """Declared range of a worksheet; it stands before the cells, so the first match is it."""
    found = F.regexp_extract(xml, r"""<(?:\w+:)?dimension\s[^>]*?ref\s*=\s*["']([^"']*)["']""", 1)
    return F.when(found != "", found)


def read_shared_strings(part: DataFrame) -> DataFrame:
    """Shared strings: (path, idx, text); rich text is joined."""
    schema = "si array<struct<t string, r array<struct<t string>>>>"
    tables = _xml(part.where(F.col("role") == "officeDocument/sharedStrings"), schema)
    rich = F.array_join(F.transform("s.r", lambda r: r["t"]), "")
    return tables.select("path", F.posexplode("x.si").alias("idx", "s")).select(
        "path", "idx", F.coalesce("s.t", rich, F.lit("")).alias("text")
    )


def read_cells(part: DataFrame, sheet: DataFrame) -> DataFrame:
    """Cells of all worksheets: (path, sheet_no, row, col, ref, t, raw).

    Formulas are ignored and their stored values kept; cells without a valid
    reference or a value are left out. Chart sheets have no cells.
    """
    schema = (
        "sheetData struct<row array<struct<c array<struct<_r string, _t string, v string, "
        "is struct<t string, r array<struct<t string>>>>>>>>"
    )
    sheets = _xml(part.where(F.col("role") == "officeDocument/worksheet"), schema).drop("role", "content_type", "via")
    rows = sheets.select("path", "part", F.explode("x.sheetData.row").alias("row"))
    cells = rows.select("path", "part", F.explode("row.c").alias("c"))
    rich = F.array_join(F.transform("c.is.r", lambda r: r["t"]), "")
    raw = F.coalesce("c.v", "c.is.t", rich)
    placed = cells.select(
        "path", "part", C.parse_ref("c._r").alias("at"), F.col("c._r").alias("ref"),
        F.col("c._t").alias("t"), raw.alias("raw"),
    ).where(F.col("at").isNotNull() & F.col("raw").isNotNull())
    return placed.join(sheet.select("path", "part", "sheet_no"), ["path", "part"]).select(
        "path", "sheet_no", "at.row", "at.col", "ref", "t", "raw"
    )


# --- XML in document order --------------------------------------------------------------------

_ARROW = pa.schema([
    ("path", pa.string()), ("part", pa.string()), ("pos", pa.int64()), ("depth", pa.int32()),
    ("parent", pa.int64()), ("ns", pa.string()), ("tag", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())), ("within", pa.map_(pa.string(), pa.int64())),
    ("text", pa.string()),
])


def _split_name(name: str) -> tuple[str, str]:
    ns, brace, tag = name[1:].rpartition("}") if name.startswith("{") else ("", "", name)
    return ns, tag


def _walk(path: str, part: str, xml: str) -> Iterator[tuple]:
    """Elements of one part; ``within`` names, per tag, the closest ancestor."""
    stack: list[tuple[int, str]] = []
    pos = -1
    for event, el in ET.iterparse(io.BytesIO(xml.encode()), ("start", "end")):
        if event == "start":
            pos += 1
            stack.append((pos, _split_name(el.tag)[1]))
            continue
        at, _ = stack.pop()
        ns, tag = _split_name(el.tag)
        attrs = [(_split_name(k)[1], v) for k, v in el.attrib.items()]
        within = {t: p for p, t in stack}
        parent = stack[-1][0] if stack else None
        yield path, part, at, len(stack), parent, ns, tag, list(dict(attrs).items()), list(within.items()), el.text
        el.clear()


def _shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _walk(*(batch.column(c)[i].as_py() for c in range(3)))

    yield from _batches(rows(), _ARROW, BATCH_ROWS, BATCH_BYTES)


# fixed values: roles of the texts of a word-processor package and the names their elements go by
TEXTS = {
    "officeDocument": "word/document.xml",
    "officeDocument/footnotes": "word/footnotes.xml",
    "officeDocument/endnotes": "word/endnotes.xml",
    "officeDocument/numbering": "word/numbering.xml",
}


def text_name(role: Column | str = "role") -> Column:
    """The usual name of a text by its role, whatever its part is called; null for other parts."""
    out = F.lit(None).cast("string")
    for known, name in TEXTS.items():
        out = F.when(F.col(role) == known, name).otherwise(out)
    return out


def read_elements(part: DataFrame) -> DataFrame:
    """Elements of the main text, notes and numbering of Word packages, numbered in document order.

    ``part`` is the usual name of the text; the file may call it otherwise.
    """
    texts = part.where(F.col("role").isin(*TEXTS)).select("path", text_name().alias("part"), "xml")
    return texts.mapInArrow(_shred, ELEMENT_SCHEMA)


# --- tags of every text part --------------------------------------------------------------------

TAG_SCHEMA = "path string, kind string, role string, ns string, tag string, lang string, n bigint, first bigint"
#: Distinct tags that are held before their counts are handed on, and bytes that are parsed at a time.
HELD_TAGS = 4096
PARSE_BYTES = 1 << 20
# fixed values: elements that only hold a text, by role; the texts below them count
_HOLDERS = {"document", "footnotes", "endnotes", "footnote", "endnote"}

_TAG_ARROW = pa.schema([
    ("path", pa.string()), ("kind", pa.string()), ("role", pa.string()), ("ns", pa.string()), ("tag", pa.string()),
    ("lang", pa.string()), ("n", pa.int64()), ("first", pa.int64()),
])


def _count_tags(path: str, kind: str, role: str, xml: str) -> Iterator[tuple]:
    """Tags of one part with how often and where first; a tag may come in several rows, whose counts add up."""
    held: dict[tuple, list[int]] = {}
    pos = 0

    def start(name: str, attrs: dict[str, str]) -> None:
        nonlocal pos
        ns, _, tag = name.rpartition(" ")
        lang = attrs.get(f"{ns} val") if tag == "lang" and ns == fixed.WORD_NS else None
        if kind != "docx" or tag not in _HOLDERS or ns != fixed.WORD_NS:
            held.setdefault((ns, tag, lang), [0, pos])[0] += 1
        pos += 1

    parser = expat.ParserCreate(namespace_separator=" ")
    parser.StartElementHandler = start
    data = xml.encode()
    for at in range(0, len(data) + 1, PARSE_BYTES):
        parser.Parse(data[at : at + PARSE_BYTES], at + PARSE_BYTES > len(data))
        if len(held) >= HELD_TAGS:
            yield from ((path, kind, role, *key, n, first) for key, (n, first) in held.items())
            held.clear()
    yield from ((path, kind, role, *key, n, first) for key, (n, first) in held.items())


def _tag_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _count_tags(*(batch.column(c)[i].as_py() for c in range(4)))

    yield from _batches(rows(), _TAG_ARROW, BATCH_ROWS, BATCH_BYTES)


def read_tags(part: DataFrame) -> DataFrame:
    """Elements of every text and sheet, counted where they are read: (path, kind, role, ns, tag, lang, n, first).

    ``lang`` is the value of a Word ``lang`` element. Tables of numbering, strings and styles are no texts. Counts of a tag
    in a part may come in several rows; ``first`` counts the elements of its part.
    """
    texts = [r for r in TEXTS if r != "officeDocument/numbering"]
    is_text = (F.col("kind") == "docx") & F.col("role").isin(texts)
    is_sheet = (F.col("kind") == "xlsx") & ((F.col("role") == "officeDocument") | F.col("role").endswith("sheet"))
    return part.where((is_text | is_sheet) & F.col("xml").isNotNull()).select("path", "kind", "role", "xml").mapInArrow(_tag_batches, TAG_SCHEMA)


def read_links(part: DataFrame) -> DataFrame:
    """Relationships of the texts of Word packages: (path, part, rel_id, target), part as in read_elements."""
    owners = part.where(F.col("role").isin(*TEXTS)).select("path", "part", text_name().alias("name"))
    rels = read_rels(part).withColumn("part", F.concat("source", "owner"))
    return rels.join(owners, ["path", "part"]).select("path", F.col("name").alias("part"), "rel_id", "target")


def read_images(part: DataFrame) -> DataFrame:
    """Binary parts that texts of Word packages refer to: (path, part, rel_id, content_type, bin), part as in read_elements.

    The content type is the declared one, else goes by the extension.
    """
    owners = part.where(F.col("role").isin(*TEXTS)).select("path", F.col("part").alias("owner"), text_name().alias("part"))
    extension = F.lower(F.regexp_extract("part", r"\.([^./]*)\z", 1))
    usual = F.concat(F.lit("image/"), F.when(extension == "jpg", "jpeg").when(extension == "svg", "svg+xml").otherwise(extension))
    images = part.where(F.col("bin").isNotNull()).select(
        "path", F.explode("via").alias("v"), F.coalesce("content_type", usual).alias("content_type"), "bin"
    )
    return images.select("path", "v.*", "content_type", "bin").join(owners, ["path", "owner"]).drop("owner")


# --- sinks ------------------------------------------------------------------------------------


def write_cells(cells: DataFrame, folder: str, keys: list[str]) -> None:
    """Sheet cells as Parquet, rows of a sheet close together."""
    cells.repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row", "col").write.mode("overwrite").parquet(folder)


def markdown_files(texts: DataFrame, root: str, folder: str | None = None) -> DataFrame:
    """Documents (path, part, text) under their output names: (out_path, part, text)."""
    return texts.select(output_path("path", root, folder).alias("out_path"), "part", "text")


def write_markdown(texts: DataFrame, root: str, target: str, folder: str | None = None) -> None:
    """One row per document (or part of a large one) under its output name, as Parquet."""
    markdown_files(texts, root, folder).write.mode("overwrite").parquet(target)
