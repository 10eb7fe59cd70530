"""Queries on document-structure operators, with the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from doctables.functions import text as M
from doctables.operators import notes as N
from doctables.operators import paragraphs as P
from doctables.operators import tables as T
from doctables.operators.running import Scan, block_of, running
from doctables.plans import views as V
from doctables.plans.oracle_views import views
from doctables.plans.register import registry

QUERIES, ORACLE, query = registry()


_SPECIALS = r"([][\\*_~`{}()<>&#+.!''\"^%=:|-])"


def _escaped(x: str) -> str:
    return rf"regexp_replace({x}, '{_SPECIALS}', '\\\1', 'g')"


_STYLE = """CASE WHEN style_id = 'Heading1' THEN 'H1' WHEN style_id = 'heading 2' THEN 'H2' WHEN style_id = 'Rubrik 3' THEN 'H3'
  WHEN style_id = 'Titre4' THEN 'H4' WHEN style_id = 'ListParagraph' THEN 'LIST' WHEN style_id = 'Unknown1' THEN NULL ELSE upper(style_id) END"""
_ALIGN = """CASE WHEN jc = 'center' THEN 'center' WHEN jc = 'right' THEN 'right' WHEN jc = 'both' THEN 'justified' ELSE 'left' END"""


@query("norm_style", views("paragraphs") + f"SELECT path, pos, style_id, {_STYLE} AS style FROM paragraphs")
def norm_style(spark, sf):
    return V.paragraphs(spark, sf).select("path", "pos", "style_id", M.norm_style("style_id").alias("style"))


@query("block_prefix", views("paragraphs", "blocks") + f"""SELECT path, pos, CASE WHEN style = 'TITLE' THEN '# ' || text WHEN style LIKE 'H_'
    THEN repeat('#', CAST(style[2] AS INTEGER) + 1) || ' ' || text WHEN style = 'QUOTE' THEN '> ' || text ELSE text END AS md, 'doc' AS src
  FROM (SELECT *, {_STYLE} AS style FROM paragraphs)
UNION ALL SELECT path, pos, CASE tag WHEN 'h1' THEN '## ' || text WHEN 'title' THEN '# ' || text ELSE text END, 'page' FROM blocks""")
def block_prefix(spark, sf):
    docs = V.paragraphs(spark, sf).select("path", "pos", "text", F.col("style_id").alias("s"), F.lit("doc").alias("src"))
    pages = V.blocks(spark, sf).select("path", "pos", "text", F.col("tag").alias("s"), F.lit("page").alias("src"))
    return docs.unionByName(pages).select(
        "path", "pos", F.concat(M.block_prefix(M.norm_style("s")), "text").alias("md"), "src"
    )


@query("code_format", views("paragraphs") + """SELECT path, pos, font, lower(font) IN ('consolas', 'courier new', 'hack') AS is_code,
  CASE WHEN lower(font) IN ('consolas', 'courier new', 'hack') THEN '```' || chr(10) || text || chr(10) || '```' ELSE text END AS md
FROM (SELECT *, CASE n % 5 WHEN 0 THEN 'Consolas' WHEN 1 THEN 'courier new' WHEN 2 THEN 'Hack' WHEN 3 THEN 'Calibri' END AS font FROM paragraphs)""")
def code_format(spark, sf):
    font = V.pick(F.col("n"), ["Consolas", "courier new", "Hack", "Calibri", None])
    none = F.lit(None).cast("string")
    code = F.when(F.col("n") % 2 == 0, M.is_code_font("font", none, none, none)).otherwise(M.is_code_font(none, none, none, "font"))
    return V.paragraphs(spark, sf).withColumn("font", font).withColumn("is_code", code).select(
        "path", "pos", "font", F.when(F.col("font").isNotNull(), F.col("is_code")).alias("is_code"),
        F.when(F.col("is_code"), M.fence("text")).otherwise(F.col("text")).alias("md"),
    )


_MARKED = """CASE {a} WHEN 'right' THEN array_to_string(list_transform(string_split({x}, chr(10)), lambda l: l || '>>'), chr(10))
  WHEN 'center' THEN array_to_string(list_transform(string_split({x}, chr(10)), lambda l: '>>' || l || '<<'), chr(10))
  WHEN 'justified' THEN array_to_string(list_transform(string_split({x}, chr(10)), lambda l: '<<' || l || '>>'), chr(10)) ELSE {x} END"""


@query("mark_align", "SELECT doc_id, align, " + _MARKED.format(a="align", x="text") + """ AS md FROM (SELECT *,
  CASE doc_id % 8 WHEN 2 THEN 'center' WHEN 3 THEN 'right' WHEN 4 THEN 'right' WHEN 5 THEN 'justified' WHEN 6 THEN 'justified' ELSE 'left' END AS align FROM documents)""")
def mark_align(spark, sf):
    jc = V.pick(F.col("doc_id"), ["left", "start", "center", "right", "end", "both", "distribute", None])
    return V.table(spark, sf, "documents").select("doc_id", "text", M.norm_align(jc).alias("align")).select(
        "doc_id", "align", M.mark_align("text", "align").alias("md")
    )


@query("rule_after", views("paragraphs") + """SELECT path, pos, text || chr(10) || chr(10) || CASE WHEN border THEN repeat('-', 80) || chr(10) || chr(10) ELSE '' END AS md FROM paragraphs""")
def rule_after(spark, sf):
    return V.paragraphs(spark, sf).select("path", "pos", F.concat("text", F.lit("\n\n"), M.rule_after("border")).alias("md"))


@query("sections", views("paragraphs") + """SELECT path, pos, section_no, section_cols, CASE WHEN section_cols IS NOT NULL AND pos = min(pos) OVER (PARTITION BY path, section_no)
  THEN array_to_string(list_transform(range(section_cols), lambda i: repeat('=', greatest(5, 80 // section_cols))), ' ') || chr(10) || chr(10) END AS opening
FROM (SELECT *, max(break_cols) OVER (PARTITION BY path, section_no) AS section_cols FROM (SELECT path, pos, break_cols,
  CAST(coalesce(sum(CASE WHEN break_cols IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS section_no FROM paragraphs))""")
def sections(spark, sf):
    out = P.sections(V.paragraphs(spark, sf), block_rows=64)
    return out.select("path", "pos", "section_no", "section_cols", "opening")


_RUN = f"""SELECT path, para_pos, run_pos, CASE WHEN ins THEN '__' ELSE '' END || CASE WHEN del THEN '~~' ELSE '' END || CASE WHEN mono THEN '`' ELSE '' END
  || CASE WHEN bold THEN '**' ELSE '' END || CASE WHEN italic THEN '*' ELSE '' END || CASE WHEN strike THEN '~' ELSE '' END || CASE WHEN dd THEN '~~' ELSE '' END
  || CASE WHEN heavy THEN '__' ELSE '' END || CASE WHEN light THEN '_' ELSE '' END || CASE vert WHEN 'superscript' THEN '^[' WHEN 'subscript' THEN '[' ELSE '' END
  || CASE WHEN starts_with(x, ' ') AND (ins OR del OR bold OR italic OR strike OR dd OR heavy OR light) THEN '&nbsp;' || x[2:] ELSE x END
  || CASE WHEN vert IS NOT NULL THEN pad || ']' ELSE '' END || CASE WHEN light THEN pad || '_' ELSE '' END || CASE WHEN heavy THEN pad || '__' ELSE '' END
  || CASE WHEN dd THEN pad || '~~' ELSE '' END || CASE WHEN strike THEN pad || '~' ELSE '' END || CASE WHEN italic THEN pad || '*' ELSE '' END
  || CASE WHEN bold THEN pad || '**' ELSE '' END || CASE WHEN mono THEN pad || '`' ELSE '' END || CASE WHEN del THEN pad || '~~' ELSE '' END
  || CASE WHEN ins THEN pad || '__' ELSE '' END AS md, link_id
FROM (SELECT *, CASE WHEN x = '' THEN '  ' ELSE '' END AS pad FROM (SELECT *, CASE WHEN del THEN '' ELSE {_escaped('text')} END AS x,
  dstrike AND NOT del AS dd, coalesce(underline IN ('double', 'thick'), false) AND NOT ins AS heavy, coalesce(underline IN ('single', 'wave'), false) AS light FROM runs))"""


@query("render_run", views("runs") + _RUN.replace(", link_id\nFROM", "\nFROM"))
def render_run(spark, sf):
    return P.render_runs(V.runs(spark, sf)).select("path", "para_pos", "run_pos", "md")


@query("render_changes", views("runs") + f"""SELECT path, para_pos, string_agg(CASE WHEN ins AND del THEN '__~~  ~~  __' WHEN del THEN '~~  ~~'
  WHEN ins THEN CASE WHEN text = '' THEN '__  __' ELSE '__' || CASE WHEN starts_with(text, ' ') THEN '&nbsp;' || {_escaped('text')}[2:] ELSE {_escaped('text')} END || '__' END END, '' ORDER BY run_pos) AS md
FROM runs WHERE ins OR del GROUP BY ALL""")
def render_changes(spark, sf):
    off, none = F.lit(False), F.lit(None).cast("string")
    flags = dict.fromkeys(("mono", "bold", "italic", "strike", "dstrike"), off)
    flags |= {"ins": F.col("ins"), "del": F.col("del"), "underline": none, "vert": none}
    changed = V.runs(spark, sf).where(F.col("ins") | F.col("del"))
    md = P.render_runs(changed.select("path", "para_pos", "run_pos", "text", *[v.alias(k) for k, v in flags.items()]))
    return P.paragraph_text(md).withColumnRenamed("pos", "para_pos")


@query("render_breaks", views("blocks") + """SELECT path, CAST(0 AS BIGINT) AS pos, string_agg(CASE tag WHEN 'br' THEN '  ' || chr(10) WHEN 'nav' THEN repeat('*', 16) || chr(10) || chr(10)
  WHEN 'li' THEN chr(9) ELSE '' END || text, '' ORDER BY pos) AS md FROM blocks GROUP BY path""")
def render_breaks(spark, sf):
    kind = F.when(F.col("tag") == "nav", "separator").when(F.col("tag") == "li", "tab").otherwise(F.col("tag"))
    pieces = V.blocks(spark, sf).select(
        "path", F.lit(0).cast("long").alias("para_pos"), F.col("pos").alias("run_pos"),
        F.concat(F.coalesce(M.render_break(kind), F.lit("")), "text").alias("md"),
    )
    return P.paragraph_text(pieces)


@query("md_escape", f"SELECT 'd' AS src, doc_id AS id, {_escaped('text')} AS md FROM documents UNION ALL SELECT 'p', page_id, {_escaped('html')} FROM pages")
def md_escape(spark, sf):
    docs = V.table(spark, sf, "documents").select(F.lit("d").alias("src"), F.col("doc_id").alias("id"), M.md_escape("text").alias("md"))
    pages = V.table(spark, sf, "pages").select(F.lit("p").alias("src"), F.col("page_id").alias("id"), M.md_escape("html").alias("md"))
    return docs.unionByName(pages)


@query("paragraph_text", views("runs") + f"SELECT path, para_pos AS pos, string_agg(md, '' ORDER BY run_pos) AS md FROM ({_RUN}) GROUP BY ALL")
def paragraph_text(spark, sf):
    return P.paragraph_text(P.render_runs(V.runs(spark, sf)))


@query("render_links", views("blocks", "anchors") + """, a AS (SELECT *, 'r' || (row_number() OVER (PARTITION BY path ORDER BY pos) * 2 - 2) AS rel_id FROM blocks WHERE tag = 'a')
SELECT path, pos, '[' || text || '](' || coalesce(target, '') || ')' AS md FROM a LEFT JOIN anchors USING (path, rel_id)
UNION ALL SELECT path, pos, text FROM blocks WHERE tag <> 'a'""")
def render_links(spark, sf):
    counted = running(V.blocks(spark, sf), ["path"], ["pos"], block_of("pos", 64),
                      {"n": Scan("sum", (F.col("tag") == "a").cast("int"))})
    runs = counted.select(
        "path", F.lit(0).alias("para_pos"), F.col("pos").alias("run_pos"), F.col("text").alias("md"),
        F.when(F.col("tag") == "a", F.concat(F.lit("r"), (F.col("n") * 2 - 2).cast("string"))).alias("link_id"),
    )
    return P.render_links(runs, V.anchors(spark, sf)).select("path", F.col("run_pos").alias("pos"), "md")


@query("drop_field_bookmarks", views("bookmark_runs") + """, s AS (SELECT *, sum(CASE kind WHEN 'start' THEN 1 WHEN 'end' THEN -1 ELSE 0 END) OVER w AS c FROM bookmark_runs WINDOW w AS (PARTITION BY path ORDER BY pos)),
d AS (SELECT *, c - least(0, min(c) OVER (PARTITION BY path ORDER BY pos)) AS depth FROM s),
closing AS (SELECT r.path, r.pos, e.pos AS e FROM d r JOIN d e ON e.path = r.path AND e.pos > r.pos AND e.kind = 'end' AND e.depth < r.depth
  AND NOT EXISTS (SELECT 1 FROM d m WHERE m.path = r.path AND m.pos > r.pos AND m.pos < e.pos AND m.depth <= e.depth)),
hit AS (SELECT DISTINCT c.path, c.pos FROM closing c JOIN d f ON f.path = c.path AND f.kind = 'field' AND f.pos < c.e)
SELECT path, pos, kind, text FROM d ANTI JOIN hit USING (path, pos) WHERE kind NOT IN ('start', 'end')""")
def drop_field_bookmarks(spark, sf):
    return P.drop_field_bookmarks(V.bookmark_runs(spark, sf), block_rows=3)


_NUMBERED = views("paragraphs", "numbering", "levels") + """, numbered AS (SELECT p.path, p.pos, p.text, p.n, p.style_id, p.num_id, p.ilvl, l.fmt, l.start FROM paragraphs p
  LEFT JOIN numbering n ON n.path = p.path AND n.num_id = p.num_id LEFT JOIN levels l ON l.path = n.path AND l.abstract_id = n.abstract_id AND l.ilvl = p.ilvl)
"""


def _numbered(spark, sf):
    p = V.paragraphs(spark, sf).withColumn("style", M.norm_style("style_id"))
    return P.resolve_numbering(p, V.numbering(spark, sf), V.levels(spark, sf))


@query("resolve_numbering", _NUMBERED + "SELECT path, pos, num_id, ilvl, fmt, start FROM numbered")
def resolve_numbering(spark, sf):
    return _numbered(spark, sf).select("path", "pos", "num_id", "ilvl", "fmt", "start")


@query("list_kind", _NUMBERED + """SELECT path, CASE fmt WHEN 'decimal' THEN 'OrderedList' WHEN 'none' THEN 'Continuation' WHEN 'bullet' THEN 'BulletList' WHEN 'lowerLetter' THEN 'BulletList' END AS kind,
  count(*) AS n FROM numbered GROUP BY ALL""")
def list_kind(spark, sf):
    return _numbered(spark, sf).groupBy("path", M.list_kind("fmt").alias("kind")).agg(F.count("*").alias("n"))


@query("bullet_mark", views("paragraphs") + """SELECT path, pos, repeat(chr(9), ilvl) || CASE ilvl % 3 WHEN 0 THEN '*' WHEN 1 THEN '-' ELSE '+' END || chr(9) AS mark FROM paragraphs WHERE num_id IS NOT NULL""")
def bullet_mark(spark, sf):
    return V.paragraphs(spark, sf).where(F.col("num_id").isNotNull()).select("path", "pos", M.bullet_mark("ilvl").alias("mark"))


_LISTS = _NUMBERED + """, typed AS (SELECT *, CASE fmt WHEN 'decimal' THEN 'OrderedList' WHEN 'none' THEN 'Continuation' WHEN 'bullet' THEN 'BulletList' WHEN 'lowerLetter' THEN 'BulletList'
    ELSE CASE WHEN style_id = 'ListParagraph' THEN 'Continuation' ELSE 'Normal' END END AS ptype FROM numbered),
moving AS (SELECT *, CASE WHEN ptype IN ('OrderedList', 'BulletList') THEN ilvl ELSE 0 END AS lv, CASE WHEN ptype IN ('OrderedList', 'BulletList') THEN num_id END AS nm FROM typed WHERE ptype <> 'Continuation'),
prev AS (SELECT t.path, t.pos, max(m.pos) FILTER (WHERE m.lv <= t.ilvl) AS p, max(m.pos) AS q FROM typed t LEFT JOIN moving m ON m.path = t.path AND m.pos < t.pos GROUP BY ALL)
"""


def _listed(spark, sf):
    return P.list_marks(_numbered(spark, sf), block_rows=64)


@query("ordered_mark", _LISTS + """SELECT t.path, t.pos, t.ptype, CASE t.ptype WHEN 'OrderedList' THEN repeat(chr(9), t.ilvl) || CASE WHEN m.lv = t.ilvl AND m.nm = t.num_id THEN '#.' ELSE t.start || '.' END || chr(9)
  WHEN 'BulletList' THEN repeat(chr(9), t.ilvl) || CASE t.ilvl % 3 WHEN 0 THEN '*' WHEN 1 THEN '-' ELSE '+' END || chr(9)
  WHEN 'Continuation' THEN CASE WHEN t.fmt = 'none' THEN repeat(chr(9), t.ilvl + 1) ELSE '' END ELSE '' END AS mark
FROM typed t JOIN prev USING (path, pos) LEFT JOIN moving m ON m.path = t.path AND m.pos = prev.p""")
def ordered_mark(spark, sf):
    return _listed(spark, sf).select("path", "pos", "ptype", "mark")


@query("continuation", _LISTS + """SELECT t.path, t.pos, array_to_string(list_transform(string_split(t.text, ' and '), lambda l: repeat(chr(9), CASE WHEN m.pos IS NULL OR m.nm IS NULL THEN 0 ELSE m.lv + 1 END) || l), chr(10)) AS md
FROM typed t JOIN prev USING (path, pos) LEFT JOIN moving m ON m.path = t.path AND m.pos = prev.q WHERE t.ptype = 'Continuation'""")
def continuation(spark, sf):
    text = F.replace(F.col("text"), F.lit(" and "), F.lit("\n"))
    return _listed(spark, sf).where(F.col("ptype") == "Continuation").select(
        "path", "pos", M.indent_lines(text, "depth").alias("md")
    )


# --- tables -----------------------------------------------------------------------------

_HEADERS = views("table_cells") + """, hr AS (SELECT path, tbl, "row", bool_or(header_flag) OR bool_or(first_row) AS is_header FROM table_cells GROUP BY ALL),
fb AS (SELECT path, tbl, min("row") FILTER (WHERE NOT is_header) AS first_body, bool_or(is_header) AS has_header FROM hr GROUP BY ALL),
placed AS (SELECT *, CAST(coalesce(sum(span) OVER (PARTITION BY path, tbl, "row" ORDER BY cell_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start FROM table_cells)
"""


@query("header_rows", _HEADERS + 'SELECT path, tbl, "row", is_header FROM hr')
def header_rows(spark, sf):
    return T.header_rows(V.table_cells(spark, sf)).drop("n_cols")


_ALIGNS = _HEADERS + """, al AS (SELECT f.path, f.tbl, c.c AS col, coalesce((SELECT arg_max(CASE WHEN jc = 'center' THEN 'center' WHEN jc = 'right' THEN 'right' ELSE 'left' END, "row") FROM placed p
  WHERE p.path = f.path AND p.tbl = f.tbl AND p.start + p.span - 1 = c.c AND p."row" <= f.first_body), 'left') AS align
  FROM fb f, (SELECT CAST(unnest(range(4)) AS INTEGER) AS c) c WHERE first_body IS NOT NULL)
"""


@query("table_aligns", _ALIGNS + "SELECT path, tbl, string_agg(CASE align WHEN 'center' THEN ':--:|' WHEN 'right' THEN '---:|' ELSE ':---|' END, '' ORDER BY col) AS marks FROM al GROUP BY ALL")
def table_aligns(spark, sf):
    cells = V.table_cells(spark, sf)
    aligns = T.table_aligns(cells, T.first_body(T.header_rows(cells)))
    return T.separators(aligns).select("path", "tbl", F.expr("substr(text, 2)").alias("marks"))


@query("blank_header", _HEADERS + "SELECT path, tbl, '| &nbsp; ||||' AS text FROM fb WHERE first_body IS NOT NULL AND NOT has_header")
def blank_header(spark, sf):
    return T.blank_header(T.first_body(T.header_rows(V.table_cells(spark, sf))))


@query("expand_spans", _HEADERS + """SELECT path, tbl, "row", CAST(start + k AS INTEGER) AS col, CASE WHEN k = 0 THEN md END AS md FROM (SELECT *, unnest(range(span)) AS k FROM placed)""")
def expand_spans(spark, sf):
    return T.expand_spans(V.table_cells(spark, sf)).drop("n_cols")


_NOTED = _HEADERS + """, grid AS (SELECT path, tbl, "row", start + k AS col, CASE WHEN k = 0 THEN regexp_replace(md, '\\s+$', '') END AS md FROM (SELECT *, unnest(range(span)) AS k FROM placed)),
flagged AS (SELECT *, coalesce(contains(md, chr(10)) OR contains(md, '|'), false) AS moved FROM grid WHERE col < 4),
noted AS (SELECT *, CASE WHEN moved THEN CAST(sum(CASE WHEN moved THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY tbl, "row", col) AS BIGINT) END AS note_no FROM flagged),
shown AS (SELECT *, CASE WHEN md IS NULL THEN '|' WHEN moved THEN '| [^n' || note_no || '] ' ELSE '| ' || md || ' ' END AS s FROM noted)
"""


@query("cell_notes", _NOTED + 'SELECT path, tbl, "row", CAST(col AS INTEGER) AS col, md, s AS shown, note_no FROM shown')
def cell_notes(spark, sf):
    return T.cell_notes(T.expand_spans(V.table_cells(spark, sf))).drop("n_cols")


@query("table_rows", _NOTED + """SELECT path, tbl, "row", string_agg(s, '' ORDER BY col) || repeat('|', 4 - count(*)) || '|' AS text FROM shown GROUP BY ALL""")
def table_rows(spark, sf):
    return T.table_rows(T.cell_notes(T.expand_spans(V.table_cells(spark, sf))))


# --- notes, images, captions ----------------------------------------------------------------


@query("note_refs", views("notes", "note_refs") + "SELECT r.path, r.pos, '[^' || kind || id || ']' AS md FROM note_refs r SEMI JOIN notes USING (path, kind, id)")
def note_refs(spark, sf):
    return N.note_refs(V.note_refs(spark, sf), V.notes(spark, sf)).select("path", "pos", "md")


@query("note_blocks", views("notes", "note_refs") + f"""SELECT path, CASE kind WHEN 'fn' THEN {N.FOOTNOTE} ELSE {N.ENDNOTE} END AS rank, id AS pos, chr(10) || '[^' || kind || id || ']:' ||
  array_to_string(list_transform(string_split(md, chr(10)), lambda l: chr(9) || l || chr(10)), '') AS text FROM notes SEMI JOIN note_refs USING (path, kind, id)""")
def note_blocks(spark, sf):
    return N.note_blocks(V.notes(spark, sf), V.note_refs(spark, sf))


@query("image_uri", "SELECT page_id, 'data:text/html;base64,' || to_base64(encode(html)) AS uri FROM pages")
def image_uri(spark, sf):
    return V.table(spark, sf, "pages").select(
        "page_id", M.image_uri(F.lit("text/html"), F.encode("html", "UTF-8")).alias("uri")
    )


@query("attach_captions", views("marks") + """, m AS (SELECT *, lag(kind) OVER w AS pk, lead(kind) OVER w AS nk, lead(text) OVER w AS nt FROM marks WHERE kind <> 'other' WINDOW w AS (PARTITION BY path ORDER BY pos))
SELECT path, pos, kind, text, CASE WHEN kind = 'image' THEN CASE WHEN nk = 'caption' THEN nt ELSE '' END END AS alt FROM m WHERE NOT (kind = 'caption' AND coalesce(pk = 'image', false))
UNION ALL SELECT path, pos, kind, text, NULL FROM marks WHERE kind = 'other'""")
def attach_captions(spark, sf):
    return N.attach_captions(V.marks(spark, sf), block_rows=4096)


@query("toc_blocks", views("blocks") + """SELECT path, pos, text FROM blocks WHERE tag NOT IN ('nav', 'li')
UNION ALL SELECT path, min(pos), '![](toc)' || chr(10) || chr(10) FROM blocks WHERE tag IN ('nav', 'li') GROUP BY path""")
def toc_blocks(spark, sf):
    gallery = F.when(F.col("tag").isin("nav", "li"), "Table of Contents")
    return N.toc_blocks(V.blocks(spark, sf), gallery, ["path"])


def _page_document(spark, sf):
    """Blocks of a page: a title header, the body, and its links as footnotes."""
    blocks = V.blocks(spark, sf)
    prefix = M.block_prefix(M.norm_style("tag"))
    body = blocks.select(
        "path", F.lit(N.BODY).alias("rank"), "pos", F.concat(prefix, M.md_escape("text"), F.lit("\n\n")).alias("text")
    )
    header = V.table(spark, sf, "pages").select(
        F.col("page_id").alias("path"), F.lit(N.HEADER).alias("rank"), F.lit(0).alias("pos"),
        F.concat(F.lit("Source: "), "url", F.lit("\n\n")).alias("text"),
    )
    links = V.anchors(spark, sf).select(
        "path", F.lit(N.FOOTNOTE).alias("rank"), F.expr("int(substr(rel_id, 2))").alias("pos"),
        M.note_block(F.concat(F.lit("fn"), F.expr("substr(rel_id, 2)")), "target").alias("text"),
    )
    return [header, body, links]


@query("assemble", views("blocks", "anchors") + f"""SELECT path, CAST(rank AS BIGINT) * 1125899906842624 + CAST(pos AS BIGINT) // 16384 + 1 AS part, string_agg(text, '' ORDER BY pos) AS text FROM (
  SELECT page_id AS path, {N.HEADER} AS rank, 0 AS pos, 'Source: ' || url || chr(10) || chr(10) AS text FROM pages
  UNION ALL SELECT path, {N.BODY}, pos, CASE tag WHEN 'h1' THEN '## ' WHEN 'title' THEN '# ' ELSE '' END || {_escaped('text')} || chr(10) || chr(10) FROM blocks
  UNION ALL SELECT path, {N.FOOTNOTE}, CAST(rel_id[2:] AS INTEGER), chr(10) || '[^fn' || rel_id[2:] || ']:' || chr(9) || target || chr(10) FROM anchors) GROUP BY ALL""")
def assemble(spark, sf):
    return N.assemble(_page_document(spark, sf))
