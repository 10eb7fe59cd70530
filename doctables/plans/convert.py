"""Whole conversions: workbooks to grids, word-processor files to Markdown.

Both start from the parts of packages and only combine the operators. Every
element carries its position in the document, so each rule is a grouping, an
equi-join or a running value by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctables.functions import fields as P
from doctables.functions import fixed
from doctables.functions import text as M
from doctables.operators import cells as E
from doctables.operators import notes as N
from doctables.operators import params as Q
from doctables.operators import tables as T
from doctables.operators.paragraphs import (
    drop_field_bookmarks,
    finish_paragraph,
    list_marks,
    resolve_numbering,
)
from doctables.operators.running import BLOCK_ROWS, Scan, block_of, running, spread_lookup
from doctables.sources import packages as S
from doctables.sources.staging import drop_staged, staged


def workbook_grid(part: DataFrame) -> DataFrame:
    """Grid rows as text from the parts of workbooks: (path, sheet_no, row, text).

    Files that could not be read whole are left out.
    """
    return _grid_text(*_workbook_cells(part))


def workbook_text(part: DataFrame, indent: bool = True) -> DataFrame:
    """Literal of whole workbooks from their parts, with names and bounds and sheets without data: (path, sheet_no, part, text).

    Parts are as in workbook_literal. Files that could not be read whole are left out.
    """
    sheet, cell = _workbook_cells(part)
    return E.workbook_literal(E.sheet_summary(sheet, cell), _grid_text(sheet, cell), indent)


def _workbook_cells(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sheets and decoded cells, each parsed once; bounds, runs and rows read them again.

    Files that could not be read whole lose their sheets, and so their cells; their parts need no join.
    """
    sheet = staged(S.readable(part, S.read_sheets(part)), "sheets")
    cell = E.decode_cells(E.resolve_strings(S.read_cells(part, sheet), S.read_shared_strings(part)))
    return sheet, staged(cell.drop("value", "ref", "t"), "decoded")


def _grid_text(sheet: DataFrame, cell: DataFrame) -> DataFrame:
    bounds = staged(E.sheet_bounds(sheet, cell).where("has_data"), "bounds")
    return E.literal_rows(E.run_literal(E.grid_runs(cell, bounds, "literal")))


# --- elements -------------------------------------------------------------------------

_DOC = S.TEXTS["officeDocument"]
PARA = ["path", "part", "p"]


def _in(tag: str) -> Column:
    return F.col("within")[tag]


def _is(*tags: str) -> Column:
    return F.col("tag").isin(*tags)


def _val(name: str = "val") -> Column:
    return F.col("attrs")[name]


def _first(test: Column, value: Column) -> Column:
    return F.max(F.when(test, value))


def _switched_on() -> Column:
    return ~F.coalesce(F.lower(_val()).isin("0", "false", "off"), F.lit(False))


def _flag(test: Column) -> Column:
    return F.coalesce(F.max(F.when(test, _switched_on())), F.lit(False))


def _fonts_are_code() -> Column:
    return M.is_code_font(_val("ascii"), _val("hAnsi"), _val("cs"), _val("eastAsia"))


def word_elements(part: DataFrame) -> DataFrame:
    """Elements in use, with the paragraph each stands in; old properties and fallbacks are left out."""
    p = F.when(_is("p") & (F.col("ns") == fixed.WORD_NS), F.col("pos")).otherwise(_in("p"))
    old = _in("rPrChange").isNotNull() | _in("pPrChange").isNotNull() | _in("Fallback").isNotNull()
    return S.read_elements(part).where(~old).withColumn("p", p)


def file_props(files: DataFrame) -> DataFrame:
    """Name and size of files as properties: (path, name, value)."""
    facts = F.array(
        F.struct(F.lit("FileName").alias("name"), F.col("path").alias("value")),
        F.struct(F.lit("FileSize").alias("name"), F.col("length").cast("string").alias("value")),
    )
    return files.select("path", F.explode(facts).alias("v")).select("path", "v.*")


# --- paragraphs ------------------------------------------------------------------------


def paragraph_properties(el: DataFrame) -> DataFrame:
    """One row per paragraph with its properties and the table, note or block it stands in."""
    own = _is("p")
    head = el.where(F.col("p").isNotNull() & (own | _in("pPr").isNotNull()))
    note = F.coalesce(_in("footnote"), _in("endnote"))
    in_section = _in("sectPr").isNotNull()
    return head.groupBy(*PARA).agg(
        _first(_is("pStyle"), _val()).alias("style_id"),
        _first(_is("jc"), _val()).alias("jc"),
        _first(_is("numId"), _val().try_cast("int")).alias("num_id"),
        _first(_is("ilvl"), _val().try_cast("int")).alias("ilvl"),
        F.coalesce(F.max(_is("bottom") & _in("pBdr").isNotNull()), F.lit(False)).alias("border"),
        F.coalesce(F.max(_is("rFonts") & _fonts_are_code()), F.lit(False)).alias("mono"),
        F.when(
            F.max(_is("sectPr")), F.coalesce(_first(_is("cols") & in_section, _val("num").try_cast("int")), F.lit(1))
        ).alias("break_cols"),
        _first(own, _in("tbl")).alias("tbl"),
        _first(own, _in("tr")).alias("tr"),
        _first(own, _in("tc")).alias("tc"),
        _first(own, note).alias("note"),
        _first(own, _in("sdt")).alias("sdt"),
    ).withColumn("style", M.norm_style("style_id"))


def numbering_tables(el: DataFrame) -> tuple[DataFrame, DataFrame]:
    """List instances and level formats."""
    rows = el.where(F.col("part") == S.TEXTS["officeDocument/numbering"])
    nums = rows.where(_is("num")).select("path", "pos", _val("numId").try_cast("int").alias("num_id"))
    used = rows.where(_is("abstractNumId")).select(
        "path", _in("num").alias("pos"), _val().try_cast("int").alias("abstract_id")
    )
    defined = rows.where(_is("abstractNum")).select(
        "path", F.col("pos").alias("a"), _val("abstractNumId").try_cast("int").alias("abstract_id")
    )
    lvl = F.when(_is("lvl"), F.col("pos")).otherwise(_in("lvl"))
    each = rows.where(lvl.isNotNull() & _in("abstractNum").isNotNull()).groupBy(
        "path", _in("abstractNum").alias("a"), lvl.alias("lvl")
    ).agg(
        _first(_is("lvl"), _val("ilvl").try_cast("int")).alias("ilvl"),
        _first(_is("numFmt"), _val()).alias("fmt"),
        _first(_is("start"), _val().try_cast("int")).alias("start"),
    )
    return (
        nums.join(used, ["path", "pos"]).select("path", "num_id", "abstract_id"),
        each.join(defined, ["path", "a"]).select("path", "abstract_id", "ilvl", "fmt", "start"),
    )


# --- form controls ------------------------------------------------------------------------


def _kind_tag(tags: list[str]) -> Column:
    return _first(_is(*tags), F.col("tag"))


def content_controls(el: DataFrame) -> DataFrame:
    """Inline content controls: (path, pos, alias, tag, checked, items). ``pos`` is the control."""
    inline = el.where((F.col("part") == _DOC) & F.col("p").isNotNull())
    sdt = F.when(_is("sdt"), F.col("pos")).otherwise(_in("sdt"))
    item = F.struct(F.col("pos"), F.struct(_val("value").alias("value"), _val("displayText").alias("display")).alias("o"))
    grouped = inline.where(_is("sdt") | _in("sdtPr").isNotNull()).groupBy("path", sdt.alias("pos")).agg(
        _first(_is("alias"), _val()).alias("alias"),
        _kind_tag(["comboBox", "dropDownList", "date", "checkbox", "dataBinding"]).alias("kind"),
        _first(_is("dataBinding"), F.lit("dataBinding")).alias("bound"),
        F.max(F.when(_is("checked"), F.lower(_val()).isin("1", "true"))).alias("checked"),
        F.sort_array(F.collect_list(F.when(_is("listItem"), item))).alias("i"),
    )
    return grouped.select(
        "path", "pos", "alias", F.coalesce("bound", "kind", F.lit("text")).alias("tag"), "checked",
        F.transform("i", lambda x: x["o"]).alias("items"),
    )


def legacy_controls(el: DataFrame) -> DataFrame:
    """Form fields of the older kind: (path, pos, alias, tag, default_value, max_len, items)."""
    form = el.where((F.col("part") == _DOC) & _in("fldChar").isNotNull() & _in("ffData").isNotNull())
    item = F.struct(F.col("pos"), F.struct(_val().alias("value"), _val().alias("display")).alias("o"))
    grouped = form.groupBy("path", _in("fldChar").alias("pos")).agg(
        _first(_is("name"), _val()).alias("alias"),
        _kind_tag(["checkBox", "ddList"]).alias("kind"),
        _first(_is("type"), _val()).alias("text_type"),
        _first(_is("default") & _in("ddList").isNull(), F.coalesce(_val(), F.lit("1"))).alias("given"),
        _first(_is("maxLength"), _val().try_cast("int")).alias("max_len"),
        F.sort_array(F.collect_list(F.when(_is("listEntry"), item))).alias("i"),
    )
    yes = F.lower("given").isin("1", "true", "on")
    return grouped.select(
        "path", "pos", "alias", F.coalesce("kind", "text_type", F.lit("text")).alias("tag"),
        F.when(F.col("kind") == "checkBox", F.when(F.col("given").isNotNull(), yes.cast("string")))
        .otherwise(F.col("given")).alias("default_value"),
        "max_len", F.transform("i", lambda x: x["o"]).alias("items"),
    )


# --- inline items -----------------------------------------------------------------------------


def _images(el: DataFrame, part: DataFrame) -> DataFrame:
    """Embedded images of the main text: (path, pos, uri)."""
    files = S.read_images(part).withColumnRenamed("rel_id", "embed")
    return (
        el.where(_is("blip") & (F.col("part") == _DOC) & _val("embed").isNotNull())
        .select("path", "part", "pos", _val("embed").alias("embed"))
        .join(files, ["path", "part", "embed"])
        .select("path", "pos", M.image_uri(F.col("content_type"), "bin").alias("uri"))
    )


def _run_pieces(el: DataFrame) -> DataFrame:
    """Pieces of runs: (path, part, p, r, pos, md, is_text) with the marks of the run on separate rows."""
    note = F.when(_is("footnoteReference"), "fn").when(_is("endnoteReference"), "en")
    text = F.when(_is("t"), M.md_escape(F.coalesce("text", F.lit(""))))
    breaks = F.when(F.col("depth") > 0, M.render_break(F.col("tag")))
    piece = F.coalesce(text, F.when(_in("rPr").isNull() & _in("pPr").isNull(), breaks))
    return el.where(_in("r").isNotNull()).select(
        "*", _in("r").alias("r"), piece.alias("md"), note.alias("kind"), _val("id").try_cast("bigint").alias("id"),
    )


def _runs(el: DataFrame, notes: DataFrame, extra: DataFrame) -> DataFrame:
    """Rendered runs: (path, part, p, pos, md, link, sdt, simple).

    ``extra`` holds more pieces by the position of an image or a form field: (path, pos, md).
    Only these elements and references are looked up; all others go straight to their run.
    """
    pieces = _run_pieces(el)
    known = notes.select("path", "kind", "id", F.lit(True).alias("known")).distinct()
    asks = F.col("kind").isNotNull() | _is("blip", "fldChar")
    asking = spread_lookup(pieces.where(asks), known, ["path", "kind", "id"], ["pos"])
    more = extra.select("path", F.lit(_DOC).alias("part"), "pos", F.col("md").alias("more"))
    asking = asking.join(more, ["path", "part", "pos"], "left")
    pieces = pieces.where(~asks).unionByName(asking, allowMissingColumns=True)
    ref = F.when(F.col("known"), F.concat(F.lit("[^"), "kind", F.col("id").cast("string"), F.lit("]")))
    md = F.coalesce("md", ref, "more")
    fmt = _in("rPr").isNotNull() & _in("pPr").isNull()
    has_text = (_is("t") & (F.length("text") > 0)) | ref.isNotNull() | F.col("more").isNotNull()
    runs = pieces.groupBy(*PARA, "r").agg(
        F.sort_array(F.collect_list(F.when(md.isNotNull(), F.struct("pos", md.alias("md"))))).alias("c"),
        F.coalesce(F.max(has_text), F.lit(False)).alias("has_text"),
        _flag(fmt & _is("b")).alias("bold"),
        _flag(fmt & _is("i")).alias("italic"),
        _flag(fmt & _is("strike")).alias("strike"),
        _flag(fmt & _is("dstrike")).alias("dstrike"),
        _first(fmt & _is("u"), _val()).alias("underline"),
        _first(fmt & _is("vertAlign"), _val()).alias("vert"),
        F.coalesce(F.max(fmt & _is("rFonts") & _fonts_are_code()), F.lit(False)).alias("mono"),
        F.coalesce(F.max(_in("ins").isNotNull()), F.lit(False)).alias("ins"),
        F.coalesce(F.max(_in("del").isNotNull()), F.lit(False)).alias("del"),
        F.max(_in("hyperlink")).alias("link"),
        F.max(_in("sdt")).alias("sdt"),
        F.max(_in("fldSimple")).alias("simple"),
    )
    content = F.array_join(F.transform("c", lambda x: x["md"]), "")
    flags = {c: F.col(c) for c in ("ins", "del", "bold", "italic", "strike", "dstrike", "underline", "vert")}
    return runs.withColumn("content", content).select(
        *PARA, F.col("r").alias("pos"), "mono", "link", "sdt", "simple", "has_text", "content",
        *flags,
    )


def _joined(df: DataFrame, keys: list[str]) -> DataFrame:
    """Texts of a paragraph, link or control in order."""
    pieces = F.sort_array(F.collect_list(F.struct("pos", "md")))
    return df.groupBy(*keys).agg(pieces.alias("c")).select(
        *keys, F.array_join(F.transform("c", lambda x: x["md"]), "").alias("md")
    )


def word_to_markdown(
    part: DataFrame, now: Column | None = None, block_rows: int = BLOCK_ROWS, files: DataFrame | None = None
) -> DataFrame:
    """Markdown of word-processor packages: (path, part, text).

    Files that could not be opened are left out. Text boxes and tables inside
    table cells stand on their own at their place in the document. ``files`` has the
    (path, length) that fields of file name and size show. A staged step is removed
    as soon as the next one is written.
    """
    now = F.current_timestamp() if now is None else now
    ok = S.readable(part)
    el = staged(word_elements(ok), "elements")
    rels = S.read_links(ok)
    prop = S.read_props(ok)
    if files is not None:
        prop = prop.unionByName(file_props(files))

    paras = paragraph_properties(el)
    noted = el.where(_is("footnote", "endnote")).select(
        "path", "part", F.col("pos").alias("note"),
        F.when(_is("footnote"), "fn").otherwise("en").alias("kind"), _val("id").try_cast("bigint").alias("id"),
    ).where(F.col("id").isNotNull())

    # form controls
    modern, legacy = content_controls(el), legacy_controls(el)
    legacy_params = legacy.where((F.length("alias") > 0) & P.control_type("tag").isNotNull())
    modern_params = modern.where((F.length("alias") > 0) & P.control_type("tag").isNotNull())

    # runs, with images and legacy form fields inside
    images = _images(el, ok)
    extra = legacy_params.select("path", "pos", P.placeholder("alias").alias("md")).unionByName(
        images.select("path", "pos", F.lit(_IMAGE).alias("md"))
    )
    own_font = el.where(F.col("p").isNotNull() & _in("pPr").isNotNull() & _is("rFonts") & _fonts_are_code())
    fenced = staged(own_font.select(*PARA, F.lit(True).alias("fenced")).distinct(), "fenced")
    runs = _runs(el, noted, extra).join(fenced, PARA, "left")
    flags = {c: F.col(c) for c in ("ins", "del", "bold", "italic", "strike", "dstrike", "underline", "vert")}
    flags["mono"] = F.col("mono") & ~F.coalesce("fenced", F.lit(False))
    items = staged(
        runs.select(
            *PARA, "pos", "link", "sdt", "simple",
            M.wrap_run(F.col("content"), F.col("has_text"), flags).alias("md"), F.lit("text").alias("kind"),
        ),
        "runs",
    )

    # text of inline controls is their shown value, a placeholder stands for it
    control_of = modern_params.select("path", F.col("pos").alias("sdt"), "alias")
    tagged = spread_lookup(items.where(F.col("sdt").isNotNull()), control_of, ["path", "sdt"], ["pos"])
    tagged = tagged.unionByName(items.where(F.col("sdt").isNull()), allowMissingColumns=True)
    is_shown = F.col("alias").isNotNull() & (F.col("part") == _DOC)
    shown = staged(_joined(tagged.where(is_shown), ["path", "sdt"]), "shown")
    place = el.where(_is("sdt") & (F.col("part") == _DOC) & F.col("p").isNotNull()).select(
        *PARA, "pos", _in("hyperlink").alias("link")
    ).join(modern_params.select("path", "pos", P.placeholder("alias").alias("md")), ["path", "pos"])

    # simple fields show their own result
    simple = el.where(_is("fldSimple") & F.col("p").isNotNull()).select(*PARA, "pos", _in("hyperlink").alias("link"), _val("instr").alias("instr"))
    main_fields = simple.where(F.col("part") == _DOC).select("path", "pos", "instr")
    seq = Q.seq_numbers(main_fields).select("path", "pos", F.col("number").cast("string").alias("md"))
    results = Q.resolve_fields(main_fields, prop).unionByName(Q.date_fields(main_fields, prop, now)).unionByName(seq)
    field_items = simple.where(F.col("part") == _DOC).join(results, ["path", "pos"]).select(*PARA, "pos", "link", "md")

    stops = el.where(_is("bookmarkStart", "bookmarkEnd", "fldChar") & F.col("p").isNotNull()).select(
        *PARA, "pos", F.lit(None).cast("bigint").alias("link"), F.lit("").alias("md"),
        F.when(_is("bookmarkStart"), "start").when(_is("bookmarkEnd"), "end").otherwise("field").alias("kind"),
    )
    plain = tagged.where(~is_shown & F.col("simple").isNull()).select(*PARA, "pos", "link", "md", "kind")
    inline = (
        plain.unionByName(place.select(*PARA, "pos", "link", "md", F.lit("text").alias("kind")))
        .unionByName(field_items.withColumn("kind", F.lit("text")))
        .unionByName(stops)
    )
    marked_up = staged(inline, "inline")
    drop_staged(items)
    inline = staged(drop_field_bookmarks(marked_up, PARA), "kept")
    drop_staged(marked_up)

    # links hold several runs
    targets = el.where(_is("hyperlink")).select("path", "part", F.col("pos").alias("link"), _val("id").alias("rel_id")).join(
        rels, ["path", "part", "rel_id"], "left"
    ).select("path", "part", "link", F.coalesce("target", F.lit("")).alias("target"))
    linked = _joined(inline.where(F.col("link").isNotNull()), [*PARA, "link"]).join(targets, ["path", "part", "link"], "left")
    linked = linked.select(
        *PARA, F.col("link").alias("pos"),
        F.concat(F.lit("["), "md", F.lit("]("), F.coalesce("target", F.lit("")), F.lit(")")).alias("md"),
    )
    texts = _joined(inline.where(F.col("link").isNull()).select(*PARA, "pos", "md").unionByName(linked), PARA)
    whole = paras.join(texts, PARA, "left").withColumn("md", F.coalesce("md", F.lit("")))

    whole = staged(whole, "texts")
    drop_staged(inline)

    # contents lists
    toc = el.where(_is("docPartGallery") & (_val() == "Table of Contents")).select("path", "part", _in("sdt").alias("sdt")).distinct()
    toc = staged(toc, "toc")
    in_control = F.col("sdt").isNotNull()
    bare = whole.where(~in_control).unionByName(whole.where(in_control).join(toc, ["path", "part", "sdt"], "left_anti").select(*whole.columns))
    marks = staged(_caption_marks(toc, images, bare), "marks")
    pictures = staged(_pictures(images, el, marks), "pictures")

    # list marks and styles, without the texts; every note starts afresh
    places = _without_captions(bare.select(*PARA, "style", "num_id", "ilvl", "note"), marks)
    numbered = resolve_numbering(
        places.withColumn("pos", F.col("p")), *numbering_tables(el)
    ).withColumn("scope", F.coalesce("note", F.lit(-1)))
    lists = staged(list_marks(numbered, ["path", "part", "scope"]).select(*PARA, "mark", "depth"), "lists")
    marked = _with_pictures(bare, pictures).join(lists, PARA).withColumn("pos", F.col("p"))  # captions in use have no list place
    md = F.concat(M.block_prefix("style"), "mark", "md")
    boxed = F.col("tbl").isNotNull()
    align = F.when(boxed, "left").otherwise(M.norm_align("jc"))
    done = marked.withColumn(
        "text",
        F.concat(finish_paragraph(md, F.col("mono"), F.col("depth"), align), F.lit("\n\n"), M.rule_after("border")),
    )
    done = staged(
        done.select(*PARA, "pos", "tbl", "tr", "tc", "note", "jc", "break_cols", "text"), "paragraphs"
    )
    for used in (whole, pictures, lists):
        drop_staged(used)

    main = done.where(F.col("part") == _DOC)
    body = main.where(~boxed).select("path", F.lit(N.BODY).alias("rank"), (F.col("pos") * 4).alias("pos"), "text")
    toc_place = _toc_places(marks, toc)
    lines, moved = T.table_lines(staged(_word_cells(el, main), "cells"))
    rows = _table_blocks(lines)
    openings = _section_openings(main.where(~boxed))

    note_texts = done.where(F.col("note").isNotNull()).select("path", "part", "note", "pos", F.col("text").alias("md"))
    note_table = _joined(note_texts, ["path", "part", "note"]).join(noted, ["path", "part", "note"]).select(
        "path", "kind", "id", "md"
    )
    refs = el.where(_is("footnoteReference", "endnoteReference") & (F.col("part") == _DOC)).select(
        "path", F.when(_is("footnoteReference"), "fn").otherwise("en").alias("kind"), _val("id").try_cast("bigint").alias("id")
    )

    header = _header_blocks(modern_params, legacy_params, shown)
    return N.assemble(
        [header, body, toc_place, rows, openings, N.table_note_blocks(moved), N.note_blocks(note_table, refs)], block_rows
    )


_IMAGE = "\x01image\x01"  # stands for an image until its caption is known


def _caption_marks(toc: DataFrame, images: DataFrame, whole: DataFrame) -> DataFrame:
    """Images, contents lists and captions of the main text, with captions joined to what they name."""
    lists = toc.where(F.col("part") == _DOC).select("path", F.col("sdt").alias("pos"))
    marks = (
        images.select("path", "pos").unionByName(lists)
        .select("path", "pos", F.lit("image").alias("kind"), F.lit("").alias("text"))
        .unionByName(
            whole.where((F.col("style") == "CAPTION") & (F.col("part") == _DOC)).select(
                "path", F.col("p").alias("pos"), F.lit("caption").alias("kind"), F.col("md").alias("text")
            )
        )
    )
    return N.attach_captions(marks)


def _without_captions(whole: DataFrame, marks: DataFrame) -> DataFrame:
    """Captions in use leave the body."""
    kept = marks.where(F.col("kind") == "caption").select("path", F.lit(_DOC).alias("part"), F.col("pos").alias("p"), F.lit(True).alias("kept"))
    used = (F.col("style") == "CAPTION") & (F.col("part") == _DOC) & F.col("kept").isNull()
    return whole.join(kept, PARA, "left").where(~F.coalesce(used, F.lit(False))).drop("kept")


def _pictures(images: DataFrame, el: DataFrame, marks: DataFrame) -> DataFrame:
    """Images with their captions by paragraph: (path, part, p, pictures)."""
    uris = images.join(marks.where(F.col("kind") == "image").select("path", "pos", "alt"), ["path", "pos"])
    place = el.where(_is("blip") & (F.col("part") == _DOC)).select("path", "pos", "p")
    shown = F.concat(F.lit("!["), "alt", F.lit("]("), "uri", F.lit(")"))
    by_para = uris.join(place, ["path", "pos"]).groupBy("path", "p").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", shown.alias("x")))), lambda e: e["x"]).alias("pictures")
    )
    return by_para.select("path", F.lit(_DOC).alias("part"), "p", "pictures")


def _with_pictures(whole: DataFrame, pictures: DataFrame) -> DataFrame:
    """Put images with their captions into the text."""
    out = whole.join(pictures, PARA, "left")
    pieces = F.split("md", _IMAGE, -1)
    filled = F.array_join(
        F.transform(pieces, lambda x, i: F.concat(x, F.coalesce(F.get("pictures", i), F.lit("")))), ""
    )
    return out.withColumn("md", F.when(F.col("pictures").isNotNull(), filled).otherwise(F.col("md"))).drop("pictures")


def _toc_places(marks: DataFrame, toc: DataFrame) -> DataFrame:
    """Placeholders of the contents lists of the main text."""
    alts = marks.where(F.col("kind") == "image").select("path", F.col("pos").alias("sdt"), "alt")
    lists = toc.where(F.col("part") == _DOC).join(alts, ["path", "sdt"], "left")
    text = F.concat(F.lit("!["), F.coalesce("alt", F.lit("")), F.lit("](toc)\n\n"))
    return lists.select("path", F.lit(N.BODY).alias("rank"), (F.col("sdt") * 4).alias("pos"), text.alias("text"))


def _word_cells(el: DataFrame, main: DataFrame) -> DataFrame:
    """Table cells in the form the table operators take; rows and cells are numbered by position."""
    doc = el.where(F.col("part") == _DOC)
    tc = F.when(_is("tc"), F.col("pos")).otherwise(_in("tc"))
    cells = doc.where(tc.isNotNull() & (_is("tc") | _is("gridSpan"))).groupBy("path", tc.alias("tc")).agg(
        _first(_is("tc"), _in("tbl")).alias("tbl"),
        _first(_is("tc"), _in("tr")).alias("row"),
        F.coalesce(_first(_is("gridSpan"), _val().try_cast("int")), F.lit(1)).alias("span"),
    )
    styled = _is("cnfStyle") & (F.coalesce(_val("firstRow"), F.lit("")).isin("1", "true") | F.coalesce(_val(), F.lit("")).startswith("1"))
    rows = doc.where(_in("tr").isNotNull() & (_is("tblHeader") | styled)).groupBy("path", _in("tr").alias("row")).agg(
        _flag(_is("tblHeader")).alias("header_flag"), F.max(styled).alias("first_row")
    )
    widths = doc.where(_is("gridCol")).groupBy("path", _in("tbl").alias("tbl")).agg(F.count("*").cast("int").alias("n_cols"))
    inside = main.where(F.col("tc").isNotNull())
    pieces = F.sort_array(F.collect_list(F.struct("pos", "text")))
    texts = inside.groupBy("path", "tc").agg(
        F.array_join(F.transform(pieces, lambda x: x["text"]), "").alias("md"),
        F.max_by(F.coalesce("jc", F.lit("left")), "pos").alias("jc"),
    )
    return (
        cells.join(rows, ["path", "row"], "left").join(widths, ["path", "tbl"]).join(texts, ["path", "tc"], "left")
        .select(
            "path", "tbl", "row", F.col("tc").alias("cell_no"), "span", F.coalesce("header_flag", F.lit(False)).alias("header_flag"),
            F.coalesce("first_row", F.lit(False)).alias("first_row"), "jc", "n_cols", F.coalesce("md", F.lit("")).alias("md"),
        )
    )


def _table_blocks(lines: DataFrame) -> DataFrame:
    """Table lines as body blocks; an empty line follows each table."""
    last = lines.groupBy("path", "tbl").agg(F.max("row").alias("row")).select("path", "tbl", "row", F.lit(True).alias("is_last"))
    out = lines.join(last, ["path", "tbl", "row"], "left")
    end = F.when(F.col("is_last") & (F.col("rank") == 2), "\n\n").otherwise("\n")
    return out.select(
        "path", F.lit(N.BODY).alias("rank"), (F.col("row") * 4 + F.col("rank")).alias("pos"), F.concat("text", end).alias("text")
    )


def _section_openings(paragraph: DataFrame) -> DataFrame:
    """Opening lines of sections, placed right after the section before."""
    breaks = paragraph.where(F.col("break_cols").isNotNull()).select("path", "pos", "break_cols")
    placed = running(
        breaks, ["path"], ["pos"], block_of("pos", BLOCK_ROWS), {"__prev": Scan("last", F.col("pos"), before=True)}
    )
    return placed.select(
        "path", F.lit(N.BODY).alias("rank"), F.coalesce(F.col("__prev") * 4 + 3, F.lit(-1)).alias("pos"),
        F.concat(M.section_line("break_cols"), F.lit("\n\n")).alias("text"),
    )


def _header_blocks(modern: DataFrame, legacy: DataFrame, shown: DataFrame) -> DataFrame:
    """Header lines of the parameters of each document and the empty line after them."""
    none = F.lit(None)
    first = modern.join(shown.select("path", F.col("sdt").alias("pos"), F.col("md").alias("shown")), ["path", "pos"], "left").select(
        "path", "pos", "alias", "tag", "checked", none.cast("string").alias("default_value"), "shown", none.cast("int").alias("max_len"), "items"
    )
    second = legacy.select(
        "path", "pos", "alias", "tag", none.cast("boolean").alias("checked"), "default_value", F.lit("").alias("shown"), "max_len", "items"
    )
    lines = Q.metadata_lines(first.unionByName(second))
    text = F.concat("text", F.lit("\n"))
    blocks = lines.select("path", (F.col("rank") + N.HEADER).alias("rank"), "pos", "line", text.alias("text"))
    ends = lines.select("path").distinct().select(
        "path", F.lit(N.HEADER_END).alias("rank"), F.lit(0).alias("pos"), F.lit(0).alias("line"), F.lit("\n").alias("text")
    )
    return blocks.unionByName(ends)
