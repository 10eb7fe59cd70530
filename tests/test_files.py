"""Reading, writing and streaming real files in a fresh folder."""

import io
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from doctables.operators import corpus as K
from doctables.operators import params as Q
from doctables.plans import packages as G
from doctables.plans.convert import word_to_markdown, workbook_grid
from doctables.sources import packages as S
from doctables.streaming.convert import convert_changed, converted_texts, file_states, stream_convert

BODY = "<w:p><w:r><w:t>Hello</w:t></w:r></w:p>"


@pytest.fixture(scope="module")
def landing():
    folder = tempfile.mkdtemp(prefix="run-")
    import os

    os.mkdir(f"{folder}/sub")
    sheet = '<row r="1"><c r="A1"><v>1</v></c><c r="B1" t="s"><v>0</v></c></row>'
    files = {
        "a.docx": G.docx_bytes(BODY), "sub/b.DOCX": G.docx_bytes(BODY), "empty.docx": b"", "broken.docx": b"PK\x03\x04junk",
        "c.xlsx": G.xlsx_bytes([("S", "A1:B1", sheet)], [" s "]), "note.txt": b"text",
    }
    for name, data in files.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
    return folder


def names(df):
    return sorted(r["path"].rsplit("/", 1)[1] for r in df.select("path").collect())


def test_scan(spark, landing):
    assert names(S.scan_packages(spark, landing, "*.docx")) == ["a.docx", "broken.docx"]  # Spark lists no empty files
    assert names(S.scan_packages(spark, landing, "*", recursive=True)) == ["a.docx", "b.DOCX", "broken.docx", "c.xlsx", "note.txt"]
    kinds = {r["path"].rsplit("/", 1)[1]: r["kind"] for r in S.scan_packages(spark, landing, "*", True).select("path", "kind").collect()}
    assert kinds["b.DOCX"] == "docx" and kinds["c.xlsx"] == "xlsx" and kinds["note.txt"] is None
    with pytest.raises(ValueError):
        S.scan_packages(spark, landing + "/*")


def test_unpack_keeps_going(spark, landing):
    parts = S.unpack(S.scan_packages(spark, landing, "*.docx"))
    assert names(parts.where("error is not null")) == ["broken.docx"]
    assert names(S.readable(parts).select("path").distinct()) == ["a.docx"]


def test_empty_content_is_a_decode_error_and_classified(spark):
    df = spark.createDataFrame([("e.docx", "docx", 0, b""), ("x.docx", "docx", 4, b"PK??")], G.SCHEMA)
    joined = df.join(S.unpack(df).select("path", "error"), "path")
    got = {r["path"]: r["r"] for r in joined.select("path", S.classify_input("length", "error", "kind", "docx").alias("r")).collect()}
    assert got == {"e.docx": "no content", "x.docx": "decode error"}


def test_malformed_xml_is_a_damaged_file(spark):
    good = G.docx_bytes("<w:p><w:r><w:t>fine</w:t></w:r></w:p>")
    bad = G.docx_bytes("<w:p><w:r><w:t>open</w:t></w:r>")
    files = [("/in/good.docx", "docx", len(good), good), ("/in/bad.docx", "docx", len(bad), bad)]
    parts = S.unpack(spark.createDataFrame(files, G.SCHEMA))
    assert names(parts.where("error is not null")) == ["bad.docx"]
    assert [(r["path"], r["text"]) for r in word_to_markdown(parts).collect()] == [("/in/good.docx", "fine\n\n")]


def test_half_read_workbooks_are_left_out(spark, landing):
    file = S.scan_packages(spark, landing, "*.xlsx").first()
    parts = {n: zipfile.ZipFile(io.BytesIO(file["content"])).read(n) for n in zipfile.ZipFile(io.BytesIO(file["content"])).namelist()}
    parts["xl/worksheets/sheet9.xml"] = b"<worksheet><sheetData>"
    data = G.zip_bytes(parts)
    files = [("good.xlsx", "xlsx", len(file["content"]), bytes(file["content"])), ("half.xlsx", "xlsx", len(data), data)]
    got = workbook_grid(S.unpack(spark.createDataFrame(files, G.SCHEMA))).collect()
    assert [(r["path"], r["text"]) for r in got] == [("good.xlsx", '[1," s "]')]


def test_workbook(spark, landing):
    parts = S.unpack(S.scan_packages(spark, landing, "*.xlsx"))
    assert [r["text"] for r in workbook_grid(parts).collect()] == ['[1," s "]']


def test_workbook_text(spark):
    from doctables.plans.convert import workbook_text

    data = G.xlsx_bytes([("S", "A1:B1", '<row r="1"><c r="A1"><v>1</v></c><c r="B1" t="s"><v>0</v></c></row>'), ("None", None, "")], [" s "])
    part = S.unpack(spark.createDataFrame([("c.xlsx", "xlsx", len(data), data)], G.SCHEMA))
    text = "".join(r["text"] for r in workbook_text(part, indent=False).orderBy("sheet_no", "part").collect())
    assert text == (
        "{'S':{'Name':'S','Left':1,'Top':1,'Right':2,'Bottom':1,'Data':[[1,\" s \"]]},"
        "'None':{'Name':'None','Left':0,'Top':0,'Right':0,'Bottom':0,'Data':null}}"
    )


def test_prefixed_and_rich_workbook_parts(spark):
    """Prefixed names, rich text and a range in single quotes read like the plain form."""
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    xml = (
        f"<x:worksheet xmlns:x='{ns}'><x:dimension ref='A1:C1'/><x:sheetData><x:row r='1'>"
        "<x:c r='A1' t='inlineStr'><x:is><x:r><x:t>a</x:t></x:r><x:r><x:t>b</x:t></x:r></x:is></x:c>"
        "<x:c r='C1' t='str'><x:f>F()</x:f><x:v> v </x:v></x:c></x:row></x:sheetData></x:worksheet>"
    )
    book = G.xlsx_bytes([("S", None, "")], [])

    parts = {n: zipfile.ZipFile(io.BytesIO(book)).read(n) for n in zipfile.ZipFile(io.BytesIO(book)).namelist()}
    parts["xl/worksheets/sheet1.xml"] = xml.encode()
    data = G.zip_bytes(parts)
    unpacked = S.unpack(spark.createDataFrame([("p.xlsx", "xlsx", len(data), data)], G.SCHEMA))
    assert [r["text"] for r in workbook_grid(unpacked).collect()] == ['["ab",," v "]']


def test_stream(spark, landing):
    out, checkpoint = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="run-")
    for _ in range(2):  # the second run finds nothing new
        stream_convert(spark, landing, out, checkpoint).awaitTermination()
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in spark.read.parquet(f"{out}/outcome").collect()}
    assert reasons == {
        "a.docx": None, "broken.docx": "decode error",
        "c.xlsx": "not the expected kind", "note.txt": "not the expected kind",
    }
    assert [r["text"] for r in spark.read.parquet(f"{out}/converted").collect()] == ["Hello\n\n"]


def test_changed_files(spark):
    import os

    landing, out = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="run-")

    def put(name, data, when):
        with open(f"{landing}/{name}", "wb") as f:
            f.write(data)
        os.utime(f"{landing}/{name}", (when, when))

    def book(text):
        return G.xlsx_bytes([("S", "A1:A1", f'<row r="1"><c r="A1" t="str"><v>{text}</v></c></row>')], [])

    def shown():
        return {r["path"].rsplit("/", 1)[1]: r["text"].strip('["]') for r in converted_texts(spark, out).collect()}

    put("a.xlsx", book("one"), 1000)
    put("b [1].xlsx", book("two"), 2000)
    put("c.xlsx", b"PK\x03\x04junk", 3000)
    assert convert_changed(spark, landing, out, "xlsx", max_files=2) == 2  # the oldest first
    assert convert_changed(spark, landing, out, "xlsx", max_files=2) == 1
    assert shown() == {"a.xlsx": "one", "b [1].xlsx": "two"}
    put("a.xlsx", b"half", 4000)  # damaged version: the text before stays
    put("late.xlsx", book("late"), 10)
    put("c.xlsx", book("mended"), 3500)
    assert convert_changed(spark, landing, out, "xlsx") == 3
    assert shown() == {"a.xlsx": "one", "b [1].xlsx": "two", "c.xlsx": "mended", "late.xlsx": "late"}
    assert [convert_changed(spark, landing, out, "xlsx") for _ in range(3)] == [1, 1, 0]  # three tries in all
    put("a.xlsx", book("new"), 5000)
    assert convert_changed(spark, landing, out, "xlsx") == 1 and shown()["a.xlsx"] == "new"
    states = {r["path"].rsplit("/", 1)[1]: (r["reason"], r["tries"]) for r in file_states(spark, out).collect()}
    assert states == {"a.xlsx": (None, 1), "b [1].xlsx": (None, 1), "c.xlsx": (None, 1), "late.xlsx": (None, 1)}


def test_date_formats(spark):
    from doctables.functions import fields as FF

    cases = [
        ("dddd, d MMMM yyyy", "Tuesday, 5 March 2024"), ("ddd dd/MM-yy", "Tue 05/03-24"), ("h:mm:ss am/pm", "2:07:09 PM"), ("HH'h'm tt", "14h7 PM"), ("y t", "24 P"),
        ("", "2024-03-05 14:07:09"), ('"day" d', "day 5"), ("\\d d", "d 5"), ("yyyyy MMM", "02024 Mar"), ("it's d", "iP'9 5"), ("yyy", "2024"), (None, "2024-03-05 14:07:09"),
    ]
    rows = spark.createDataFrame([(i, f) for i, (f, _) in enumerate(cases)], "i int, f string")
    got = rows.select("i", FF.date_text(F.lit("2024-03-05 14:07:09").cast("timestamp_ntz"), F.col("f")).alias("t")).orderBy("i").collect()
    assert [r["t"].replace("\\", "") for r in got] == [t for _, t in cases]


def test_write_and_read_back(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    texts = spark.createDataFrame([("/in/x/a.docx", 0, "t")], "path string, part long, text string")
    S.write_markdown(texts, "/in", f"{folder}/md", "/out")
    assert spark.read.parquet(f"{folder}/md").first()["out_path"] == "/out/x/a.md"
    cells = spark.createDataFrame([("s", 2, 1, "v"), ("s", 1, 1, "u")], "sheet string, row int, col int, value string")
    S.write_cells(cells, f"{folder}/cells", ["sheet"])
    assert spark.read.parquet(f"{folder}/cells").count() == 2


@pytest.mark.parametrize("name,pattern,out,want", [
    ("Report-7.docx", "report-*.docx", "r*.md", "r7.md"), ("a.b.docx", "*.docx", "*.md", "a.b.md"),
    ("x1-y2.docx", "*-*.docx", "*_*.md", "x1_y2.md"), ("other.doc", "*.docx", "*.md", None), ("a+b.docx", "a+*.docx", "fixed.md", "fixed.md"),
])
def test_output_name(spark, name, pattern, out, want):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(K.output_name("n", pattern, out).alias("r")).first()["r"] == want


def test_output_name_checks_wildcards():
    with pytest.raises(ValueError):
        K.output_name(None, "*.docx", "*-*.md")


def header(spark, lines):
    df = spark.createDataFrame([("d", "\n".join(lines) + "\n\nBody [%A]")], "path string, md string")
    return {r["name"]: r for r in Q.parameters(df).collect()}


def test_parameters_from_header(spark):
    got = header(spark, [
        "Name Full: first", "Name: Bo", "Name Full: second", "Name Full X: of full", "Name: Al", "Name Type: ListOfOptions", "Name MaxLen: 5",
        "Name Item3 Value: c", "Name Item1 Value: a", "Name Item1 Display: A", "Name Item0 Value: z", "Name Note: n1", "Name Note: n2",
        "Bad Type: x", "Other: 1", "Other Type: Nonsense", "Other MaxLen: many", ": no key", "no colon",
    ])
    assert set(got) == {"Name Full", "Name", "Bad Type", "Other"}
    name = got["Name"]
    assert (name["type"], name["max_len"], name["values"]) == ("ListOfOptions", 5, ["Bo", "Al"])
    assert [tuple(o) for o in name["options"]] == [("a", "A"), (None, None), ("c", None)]
    assert name["properties"] == {"Note": ["n1", "n2"]}
    assert got["Name Full"]["values"] == ["first", "second"]
    assert got["Name Full"]["properties"] == {"X": ["of full"]}
    assert (got["Other"]["type"], got["Other"]["max_len"]) == ("String", None)


def test_field_instructions(spark):
    from doctables.functions.fields import parse_field

    cases = {
        ' CREATEDATE \\@ "d MMM yyyy" \\* MERGEFORMAT ': ("CREATEDATE", "", "@", "d MMM yyyy"),
        'DATE \\* MERGEFORMAT \\@ yyyy-MM-dd HH:mm': ("DATE", "", "@", "yyyy-MM-dd HH:mm"),
        'docproperty "My \\"own\\" title" \\h': ("DOCPROPERTY", 'My "own" title', "", ""),
        "SEQ Figure \\*ARABIC \\r 5": ("SEQ", "Figure", "*", "ARABIC"),
        "PAGE": ("PAGE", "", "", ""), "REF _Ref12 \\h \\# 0.00": ("REF", "_Ref12", "#", "0.00"), "= 1 + 2": None, "": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "i string")
    got = {r["i"]: r["f"] and tuple(r["f"]) for r in df.select("i", parse_field("i").alias("f")).collect()}
    assert got == cases


def test_long_option_numbers(spark):
    got = header(spark, ["N: v", "N Item000000000002 Value: two", "N Item123456789012 Value: far", "N Item1 Value: one"])["N"]
    assert [tuple(o) for o in got["options"]] == [("one", None), ("two", None)]
    assert got["properties"] == {"Item123456789012 Value": ["far"]}


def test_binding_has_no_join(spark):
    df = spark.createDataFrame([("d", "A: 1\nA B: 2\n\nx")], "path string, md string")
    plan = Q.bound_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def bind_by_loop(keys):
    names, out = {}, []
    for k in keys:
        if k in names:
            out.append((k, None))
            continue
        hit = next((n for n in names if k.startswith(n + " ")), None)
        if hit is None:
            names[k] = True
            out.append((k, None))
        else:
            out.append((hit, k[len(hit) + 1:].lstrip()))
    return out


def test_bind_against_loop(spark):
    import random

    rng = random.Random(11)
    docs = [[" ".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(12)] for _ in range(40)]
    df = spark.createDataFrame([(g, i, k, "v") for g, ks in enumerate(docs) for i, k in enumerate(ks)], "path int, pos int, key string, value string")
    got = {(r["path"], r["pos"]): (r["name"], r["suffix"]) for r in Q.bind_attributes(df).collect()}
    for g, keys in enumerate(docs):
        assert [got[(g, i)] for i in range(len(keys))] == bind_by_loop(keys)


def test_outcome_texts(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (1, 0), (3, 0), (2, 1)], "y long, n long")
    assert [r[0] for r in df.select(K.outcome_text("y", "n")).collect()] == [
        "No files processed.", "File not converted.", "2 files found, bot not converted.", "File converted.", "3 files converted.",
        "3 file(s) found, 2 where converted, 1 where not converted.",
    ]


def test_language_tie_goes_to_first(spark):
    runs = spark.createDataFrame([("d", 0, "sv-SE"), ("d", 1, "en"), ("d", 2, "en-GB"), ("d", 3, "sv")], "path string, pos int, tag string")
    none = spark.createDataFrame([], "path string, name string, value string")
    assert K.doc_language(runs, none).first()["language"] == "sv"
    given = spark.createDataFrame([("d", "Language", "fi")], "path string, name string, value string")
    assert K.doc_language(runs, given).first()["language"] == "fi"


def test_row_diff_counts_repeats(spark):
    a = spark.createDataFrame([("d", "x")] * 3 + [("d", "y")], "path string, line string")
    b = spark.createDataFrame([("d", "x"), ("d", "z")], "path string, line string")
    got = sorted(tuple(r) for r in K.row_diff(a, b).collect())
    assert got == [("d", "x", "removed", 2), ("d", "y", "removed", 1), ("d", "z", "added", 1)]


# --- whole folders ---------------------------------------------------------------------------


def test_convert_folder(spark, landing):
    from doctables.plans.folder import convert_folder

    target = tempfile.mkdtemp(prefix="run-")
    got = convert_folder(spark, landing, target, "*.docx", f"{target}/md/*.md", headers={"Title": "T"}).collect()
    assert [tuple(r) for r in got] == [(1, 1, "2 file(s) found, 1 where converted, 1 where not converted.")]  # upper-case names below only
    texts = [tuple(r) for r in spark.read.parquet(f"{target}/texts").select("out_path", "text").orderBy("part").collect()]
    assert texts == [(f"{target}/md/a.md", "Title: T\n\n"), (f"{target}/md/a.md", "Hello\n\n")]
    again = convert_folder(spark, landing, target, "*", recursive=True).collect()  # beside the files, results written over
    assert [tuple(r) for r in again] == [(2, 3, "5 file(s) found, 2 where converted, 3 where not converted.")]
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in spark.read.parquet(f"{target}/outcomes").collect()}
    assert reasons == {"a.docx": None, "b.DOCX": None, "broken.docx": "decode error", "c.xlsx": "not the expected kind", "note.txt": "not the expected kind"}
    paths = sorted(r["out_path"].rsplit("/", 2)[1:] for r in spark.read.parquet(f"{target}/texts").collect())
    assert [p[1] for p in paths] == ["a.md", "b.md"] or [p[1] for p in paths] == ["b.md", "a.md"]
    with pytest.raises(ValueError):
        convert_folder(spark, landing, target, "*.docx", "/x/*-*.md")
    none = convert_folder(spark, landing, target, "nothing*.docx").collect()
    assert [tuple(r) for r in none] == [(0, 0, "No files processed.")]


def test_steps_of_a_conversion_leave_the_disk(spark, tmp_path):
    """What the next step has taken up is removed, and packages are made once."""
    import os

    from doctables.plans import files
    from doctables.sources.staging import shared_folder

    rows = [(n, "first line\nsecond", "en", "web") for n in (2, 4, 5, 13, 20, 21)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    before = set(os.listdir(shared_folder(spark)))
    texts = files.QUERIES["convert_folder"](spark, str(tmp_path))
    left = sorted(x.rsplit("-", 5)[0] for x in set(os.listdir(shared_folder(spark))) - before)
    assert not {"packages", "runs", "inline", "kept", "texts", "pictures", "lists"} & set(left)
    assert left.count("parts") == left.count("elements") == left.count("paragraphs") == 1
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan
    body = {r["path"]: r["text"] for r in texts.where("part > 0 and text like 'first%'").collect()}
    assert body == {f"docs/web/{n}.docx": f"first line\n\nsecond\n\ndocs/web/{n}\\.docx[^fn2]\n\n" for n in (2, 4, 5)}


def test_one_output_name_for_several_files(spark):
    from doctables.plans.folder import file_outcomes, folder_texts

    files = [(f"/in/{n}.docx", "docx", 0, G.docx_bytes(f"<w:p><w:fldSimple w:instr='FILESIZE'/><w:r><w:t>{n}</w:t></w:r></w:p>")) for n in ("a", "b")]
    package = spark.createDataFrame([(p, k, len(d), d) for p, k, _, d in files], G.SCHEMA)
    part = S.unpack(package)
    got = folder_texts(package, part, file_outcomes(package, part, K.target_path("path", "/in", "*.docx", "/out/all.md"))).collect()
    assert [(r["path"], r["out_path"], r["text"]) for r in got] == [("/in/b.docx", "/out/all.md", f"{len(files[1][3])}b\n\n")]


@pytest.mark.parametrize("path,pattern,out,want", [
    ("/in/x/a.docx", "*.docx", None, "/in/x/a.md"), ("/in/x/a.docx", "*.docx", "/out/", "/out/x/a.md"), ("/in/a.docx", "*.docx", "/out/n-*.md", "/out/n-a.md"),
    ("/in/x/y/a.docx", "*.docx", "/out/*.md", "/out/x/y/a.md"), ("/in/x/a.xlsx", "*.docx", None, None), ("/in/a b.docx", "a*.docx", "*.md", " b.md"),
])
def test_target_path(spark, path, pattern, out, want):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(K.target_path("p", "/in", pattern, out).alias("r")).first()["r"] == want


def test_tags_are_counted_whole(spark, monkeypatch):
    """Counts add up when tags are handed on early and the text is parsed in small pieces."""
    from doctables.plans.folder import file_census, file_languages

    body = "".join(f'<w:p><w:r><w:rPr><w:lang w:val="{c}"/><w:lang w:eastAsia="x"/></w:rPr></w:r><w:odd{i % 5}/></w:p>' for i, c in enumerate(["sv", "en-GB", "en-US", "sv-FI", ""] * 40))
    data = G.docx_bytes(body)
    part = S.unpack(spark.createDataFrame([("d.docx", "docx", len(data), data)], G.SCHEMA))
    row = part.where("role = 'officeDocument'").select("path", "kind", "role", "xml").first()
    monkeypatch.setattr(S, "HELD_TAGS", 3)
    monkeypatch.setattr(S, "PARSE_BYTES", 101)
    counted = spark.createDataFrame(list(S._count_tags(*row)), S.TAG_SCHEMA)
    assert counted.count() > 30
    for tags in (counted, S.read_tags(part)):
        assert {r["element"]: r["n"] for r in file_census(tags).collect()} == {f"odd{i}": 40 for i in range(5)}
        assert file_languages(tags, S.read_props(part)).first()["language"] == "sv"  # 80 of each, sv first
