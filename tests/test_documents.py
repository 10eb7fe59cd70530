"""Document rules on golden fragments and small packages."""

import re

import pytest
from pyspark.sql import functions as F

from doctables.functions import text as M
from doctables.operators import notes as N
from doctables.operators import paragraphs as P
from doctables.operators import tables as T
from doctables.plans import packages as G
from doctables.plans.convert import word_to_markdown
from doctables.sources.packages import unpack
from doctables.sources.staging import staged


@pytest.mark.parametrize("style,want", [
    ("Heading1", "H1"), ("h 2", "H2"), ("HEAD3", "H3"), ("Überschrift 4", "H4"), ("Заголовок5", "H5"), ("Rubrik", "TITLE"),
    ("Rubrik6", "H6"), ("Body Text 2", "NORMAL"), ("Body Text", None), ("List Paragraph", "LIST"), ("Liststycke", "LIST"),
    ("Intense  Quote", "QUOTE"), ("Descripción", "CAPTION"), ("Fotnotstext", "FOOTNOTE"), ("Title2", None), (None, None),
])
def test_norm_style(spark, style, want):
    df = spark.createDataFrame([(style,)], "s string")
    assert df.select(M.norm_style("s").alias("r")).first()["r"] == want


RUN = "text string, bold boolean, italic boolean, underline string, strike boolean, dstrike boolean, ins boolean, del boolean, vert string, mono boolean"


@pytest.mark.parametrize("run,want", [
    (("x", True, True, "single", False, False, False, False, None, False), "***_x_***"),
    ((" x", True, False, None, False, False, False, False, None, False), "**&nbsp;x**"),
    ((" x", False, False, None, False, False, False, False, "superscript", False), "^[ x]"),
    (("x", False, False, "double", True, False, False, False, "subscript", True), "`~__[x]__~`"),
    (("x", False, False, "double", False, False, True, False, None, False), "__x__"),
    (("gone", False, False, None, False, True, False, True, None, False), "~~  ~~"),
    (("", True, True, None, False, False, False, False, None, False), "***  *  **"),
    (("x", None, None, "none", None, None, None, None, None, None), "x"),
    (("2.5%", False, False, "wave", False, False, False, False, None, False), r"_2\.5\%_"),
])
def test_render_run(spark, run, want):
    df = spark.createDataFrame([run], RUN)
    assert P.render_runs(df).first()["md"] == want


def test_alignment(spark):
    df = spark.createDataFrame([("a\nb", j) for j in ("right", "center", "distribute", "start")], "t string, j string")
    got = [r[0] for r in df.select(M.mark_align("t", M.norm_align("j"))).collect()]
    assert got == ["a>>\nb>>", ">>a<<\n>>b<<", "<<a>>\n<<b>>", "a\nb"]


@pytest.mark.parametrize("n,want", [(1, "=" * 80), (3, " ".join(["=" * 26] * 3)), (40, " ".join(["=" * 5] * 40))])
def test_section_line(spark, n, want):
    assert spark.range(1).select(M.section_line(F.lit(n)).alias("r")).first()["r"] == want


def marks_by_loop(paras):
    """List marks kept the way one reads a document: a stack of list numbers by level."""
    stack, out = [], []
    for kind, level, num, start in paras:
        if kind == "Continuation":
            out.append((None, len(stack)))
            continue
        same = kind != "Normal" and len(stack) > level and stack[level] == num
        out.append((("#." if same else f"{start}.") if kind == "OrderedList" else None, None))
        if kind == "Normal":
            stack = []
        else:
            stack = (stack + [None] * level)[:level] + [num]
    return out


@pytest.mark.parametrize("rows,depth", [(2, 3), (5, 12), (100, 3), (7, 40)])
def test_list_marks_against_loop(spark, rows, depth):
    import random

    rng = random.Random(3)
    kinds = ["OrderedList", "OrderedList", "BulletList", "Continuation", "Normal"][: 5 if depth < 10 else 4]
    paras = [(rng.choice(kinds), rng.randint(0, depth), rng.randint(1, 2), rng.randint(1, 9)) for _ in range(160)]
    fmt = {"OrderedList": "decimal", "BulletList": "bullet"}
    data = [(1, i, n if k in fmt else None, lv if k in fmt else None, fmt.get(k), st, "LIST" if k == "Continuation" else None) for i, (k, lv, n, st) in enumerate(paras)]
    df = spark.createDataFrame(data, "path int, pos int, num_id int, ilvl int, fmt string, start int, style string")
    got = P.list_marks(df, block_rows=rows).orderBy("pos").collect()
    for r, (mark, indent), (kind, _, _, _) in zip(got, marks_by_loop(paras), paras):
        assert r["ptype"] == kind
        if mark:
            assert r["mark"].strip() == mark
        if indent is not None:
            assert r["depth"] == indent


def test_marks_shuffle_rows_once(spark):
    """Bookmarks read their input once; a plan exchanges the rows, then one row per block twice."""
    import re

    df = spark.range(100).selectExpr("id % 3 AS path", "id AS pos", "'text' AS kind", "'x' AS text")
    plan = P.drop_field_bookmarks(df)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(path", plan)) <= 4  # the rows' exchange is written twice and reused


def bookmarks_by_loop(kinds):
    """Positions kept: a stack of open bookmarks, as one reads the paragraph."""
    kept, stack, field = set(), [], False
    for i, k in enumerate(kinds):
        if k == "start":
            stack.append(i)
        elif k == "end" and stack:
            at = stack.pop()
            if field:
                kept -= set(range(at, i))
        elif k != "end":
            kept.add(i)
            field = field or k == "field"
    return sorted(kept)


@pytest.mark.parametrize("rows", [2, 100])
def test_bookmarks_against_loop(spark, rows):
    import random

    rng = random.Random(5)
    groups = [[rng.choice(["start", "end", "text", "text", "field"]) for _ in range(rng.randint(1, 14))] for _ in range(60)]
    df = spark.createDataFrame([(g, i, k, "x") for g, ks in enumerate(groups) for i, k in enumerate(ks)], "path int, pos int, kind string, text string")
    got = {}
    for r in P.drop_field_bookmarks(df, block_rows=rows).collect():
        got.setdefault(r["path"], []).append(r["pos"])
    for g, kinds in enumerate(groups):
        assert sorted(got.get(g, [])) == bookmarks_by_loop(kinds), kinds


CELL = "path string, tbl int, row int, cell_no int, span int, header_flag boolean, first_row boolean, jc string, n_cols int, md string"


def table_text(spark, rows, n_cols=4):
    data = [("d", 0, r, c, cell.get("span", 1), cell.get("h", False), cell.get("f", False), cell.get("jc"), n_cols, cell["md"]) for r, row in enumerate(rows) for c, cell in enumerate(row)]
    lines, moved = T.table_lines(spark.createDataFrame(data, CELL))
    text = "\n".join(r["text"] for r in lines.orderBy("row", "rank").collect())
    return text, [(r["note_no"], r["md"]) for r in moved.orderBy("note_no").collect()]


def cells(*texts, **kw):
    return [dict(md=t, **kw) for t in texts]


def test_plain_and_spanned_tables(spark):
    assert table_text(spark, [cells("1", "2", "3", "4"), [dict(md="5, 6, 7", span=3), dict(md="8 \n\n")]])[0] == (
        "| &nbsp; ||||\n|:---|:---|:---|:---|\n| 1 | 2 | 3 | 4 |\n| 5, 6, 7 ||| 8 |"
    )


def test_header_rows_and_alignment(spark):
    head = [dict(md=t, jc=j, h=True) for t, j in [("L", None), ("R", "right"), ("C", "center"), ("J", "both")]]
    body = [dict(md=t, jc=j) for t, j in [("5", None), ("6", "right"), ("7", "center"), ("8", None)]]
    assert table_text(spark, [head, cells("a", h=True), body])[0].split("\n") == [
        "| L | R | C | J |", "| a ||||", "|:---|---:|:--:|:---|", "| 5 | 6 | 7 | 8 |",
    ]
    assert table_text(spark, [cells("1", "2", f=True), cells("3", "4", f=True)], 2)[0] == "| 1 | 2 |\n|:---|:---|\n| 3 | 4 |"
    assert table_text(spark, [cells("1", "2", h=True)], 2)[0] == "| 1 | 2 |"


def test_large_cells_become_notes(spark):
    text, moved = table_text(spark, [cells("a\n\nb", "c"), cells("d|e", "f", "dropped")], 2)
    assert text == "| &nbsp; ||\n|:---|:---|\n| [^n1] | c |\n| [^n2] | f |"
    assert moved == [(1, "a\n\nb"), (2, "d|e")]


def test_pack_text_cuts_all_groups_alike(spark):
    data = [("big", 1, i, f"{i};") for i in range(100)] + [("small", 0, 5, "b"), ("small", 1, 0, "c"), ("small", 0, 1, "a")]
    df = spark.createDataFrame(data, "path string, rank int, pos int, text string")
    got = N.pack_text(df, ["path"], block_rows=30).orderBy("path", "part").collect()
    assert [r["text"] for r in got if r["path"] == "small"] == ["ab", "c"]
    big = [r["text"] for r in got if r["path"] == "big"]
    assert len(big) == 4 and "".join(big) == "".join(f"{i};" for i in range(100))


W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def p(text, props="", run=""):
    return f'<w:p><w:pPr>{props}</w:pPr><w:r><w:rPr>{run}</w:rPr><w:t xml:space="preserve">{text}</w:t></w:r></w:p>'


def num(level, num_id):
    return f'<w:pStyle w:val="ListParagraph"/><w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="{num_id}"/></w:numPr>'


def tc(text, props=""):
    return f"<w:tc><w:tcPr>{props}</w:tcPr>{p(text)}</w:tc>"


BODY = (
    p("Head.", '<w:pStyle w:val="Heading1"/>')
    + '<w:p><w:r><w:t>A </w:t></w:r><w:r><w:rPr><w:b/><w:i w:val="0"/></w:rPr><w:t>bold</w:t><w:br/><w:t>line</w:t></w:r>'
    '<w:hyperlink r:id="rId7"><w:r><w:t>go</w:t></w:r><w:r><w:rPr><w:i/></w:rPr><w:t>to</w:t></w:r></w:hyperlink>'
    '<w:r><w:footnoteReference w:id="2"/></w:r><w:r><w:footnoteReference w:id="9"/></w:r></w:p>'
    + p("one", num(0, 1)) + p("sub", num(1, 1)) + p("more", '<w:pStyle w:val="ListParagraph"/>') + p("two", num(0, 1)) + p("plain") + p("again", num(0, 1))
    + p("10 GOTO", '<w:rPr><w:rFonts w:ascii="Consolas"/></w:rPr>', '<w:rFonts w:ascii="Consolas"/>')
    + p("centred", '<w:jc w:val="center"/><w:pBdr><w:bottom/></w:pBdr>')
    + "<w:tbl><w:tblGrid><w:gridCol/><w:gridCol/></w:tblGrid><w:tr>" + tc("a") + tc("b") + "</w:tr><w:tr>"
    + f'<w:tc>{p("x")}{p("y")}</w:tc>' + tc("z") + "</w:tr></w:tbl>"
    + '<w:p><w:sdt><w:sdtPr><w:alias w:val="Combo"/><w:comboBox><w:listItem w:displayText="Item 1" w:value="1"/><w:listItem w:value="2"/></w:comboBox></w:sdtPr>'
    "<w:sdtContent><w:r><w:t>Pick</w:t></w:r></w:sdtContent></w:sdt></w:p>"
    + '<w:p><w:r><w:fldChar w:fldCharType="begin"><w:ffData><w:name w:val="Legacy"/><w:textInput><w:type w:val="number"/><w:default w:val="100"/><w:maxLength w:val="3"/></w:textInput></w:ffData></w:fldChar></w:r>'
    '<w:bookmarkStart/><w:r><w:instrText>FORMTEXT</w:instrText></w:r><w:r><w:fldChar w:fldCharType="separate"/></w:r>'
    '<w:r><w:t>old text</w:t></w:r><w:r><w:fldChar w:fldCharType="end"/></w:r><w:bookmarkEnd/></w:p>'
    + '<w:p><w:fldSimple w:instr=" TITLE "><w:r><w:t>cached</w:t></w:r></w:fldSimple><w:fldSimple w:instr="SEQ Fig"><w:r><w:t>7</w:t></w:r></w:fldSimple></w:p>'
    + '<w:p><w:r><w:drawing><a:blip xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" r:embed="rId8"/></w:drawing></w:r></w:p>'
    + p("Caption", '<w:pStyle w:val="Caption"/>') + p("Loose", '<w:pStyle w:val="Caption"/>')
    + p("end", '<w:sectPr><w:cols w:num="2"/></w:sectPr>') + p("last")
)
NUMBERING = (
    f'<w:numbering xmlns:w="{W}"><w:abstractNum w:abstractNumId="5"><w:lvl w:ilvl="0"><w:start w:val="3"/><w:numFmt w:val="decimal"/></w:lvl>'
    '<w:lvl w:ilvl="1"><w:start w:val="1"/><w:numFmt w:val="bullet"/></w:lvl></w:abstractNum>'
    '<w:num w:numId="1"><w:abstractNumId w:val="5"/></w:num></w:numbering>'
)
FOOTNOTES = f'<w:footnotes xmlns:w="{W}"><w:footnote w:id="2">{p("Note.")}</w:footnote><w:footnote w:id="3">{p("unused")}</w:footnote></w:footnotes>'

EXPECTED = (
    "Combo: Pick\nCombo Type: StringWithOptions\nLegacy: 100\nLegacy Type: Number\nCombo Item1 Value: 1\nCombo Item1 Display: Item 1\nLegacy MaxLen: 3\n\n"
    "======================================== ========================================\n\n"
    "## Head\\.\n\nA **bold  \nline**[go*to*](https://example.com/)[^fn2]\n\n"
    "3.\tone\n\n\t-\tsub\n\n\t\tmore\n\n#.\ttwo\n\nplain\n\n3.\tagain\n\n```\n10 GOTO\n```\n\n>>centred<<\n\n" + "-" * 80 + "\n\n"
    "| &nbsp; ||\n|:---|:---|\n| a | b |\n| [^n1] | z |\n\n"
    "[%Combo]\n\n[%Legacy]\n\nMy title1\n\n![Caption](data:image/png;base64,iVBORw==)\n\nLoose\n\nend\n\nlast\n\n"
    "\n[^n1]:\tx\n\t\n\ty\n\n[^fn2]:\tNote\\.\n\t\n\t\n"
)


def test_word_to_markdown(spark):
    docx = G.docx_bytes(
        BODY, [("rId7", "hyperlink", "https://example.com/"), ("rId8", "image", "media/i.png"), ("rId9", "numbering", "numbering.xml"), ("rId10", "footnotes", "footnotes.xml")], {"title": "My title"},
        {"word/numbering.xml": NUMBERING, "word/footnotes.xml": FOOTNOTES, "word/media/i.png": b"\x89PNG"},
    )
    files = [("a.docx", "docx", len(docx), docx), ("bad.docx", "docx", 3, b"PK?")]
    parts = staged(unpack(spark.createDataFrame(files, G.SCHEMA)), "parts")
    for block_rows in (1, 7, None):
        args = {"block_rows": block_rows} if block_rows else {}
        rows = word_to_markdown(parts, **args).orderBy("path", "part").collect()
        assert {r["path"] for r in rows} == {"a.docx"}
        assert len({r["part"] for r in rows}) == len(rows)
        assert "".join(r["text"] for r in rows) == EXPECTED


def test_escape_is_undone_by_removing_backslashes(spark):
    text = "a.b:c-(d)\"e\"&[f]*_~`{}<>#+!'^%=|\\ç 1/2,;"
    got = spark.createDataFrame([(text,)], "t string").select(M.md_escape("t").alias("r")).first()["r"]
    assert re.sub(r"\\(.)", r"\1", got) == text
    assert "/" in got and "\\/" not in got and "\\," not in got
