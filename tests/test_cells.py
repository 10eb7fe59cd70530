"""Spreadsheet rules on literal edge cases."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doctables.functions import cells as C
from doctables.functions import sqlfuncs
from doctables.operators import cells as E
from doctables.operators import sheets as X
from doctables.operators.running import block_of
from doctables.plans import views as V
from doctables.plans.registry import QUERIES


def one(spark, column, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("ref,want", [
    ("A1", (1, 1)), ("XFD1048576", (16384, 1048576)), ("aa10", (27, 10)), ("1A", (1, 1)),
    ("$A$1", None), ("A", None), ("1", None), ("", None), ("A1\n", None), ("ß1", None),
    ("FXSHRXW1", (2147483647, 1)), ("FXSHRXX1", None), ("A99999999999", None),
])
def test_parse_ref(spark, ref, want):
    got = one(spark, C.parse_ref, ref)
    assert (None if got is None else tuple(got)) == want


@pytest.mark.parametrize("ref,want", [
    ("A1:D9", (1, 1, 4, 9)), ("A1", None), ("A1:", None), (":A1", None), ("A1:B2:C3", None),
])
def test_parse_range(spark, ref, want):
    got = one(spark, C.parse_range, ref)
    assert (None if got is None else tuple(got)) == want


@pytest.mark.parametrize("n,want", [(1, "A"), (26, "Z"), (27, "AA"), (702, "ZZ"), (703, "AAA"), (16384, "XFD"), (18279, "AAAA")])
def test_col_name(spark, n, want):
    assert one(spark, C.col_name, n, "int") == want


@pytest.mark.parametrize("d,want", [
    (10.0, "10"), (-174.89999999999998, "-174.89999999999998"), (0.3, "0.3"), (1e7, "10000000"),
    (12345678.9, "12345678.9"), (1e15, "1E+15"), (1.2345678901234568e17, "1.2345678901234568E+17"),
    (0.0001, "0.0001"), (1e-5, "0.00001"), (1.5e-7, "1.5E-07"), (0.0, "0"),
])
def test_number_text(spark, d, want):
    assert one(spark, C.number_text, d, "double") == want


@pytest.mark.parametrize("t,raw,kind", [
    (None, "1e3", "number"), (None, " 12 ", "string"), (None, "TRUE", "boolean"), (None, "yes", "string"),
    (None, "NaN", "string"), (None, "", "string"), ("str", "20", "string"), ("b", "0", "boolean"),
    ("n", "x", "string"), ("d", "1997-05-28", "date"), ("d", "35000.5", "date"), ("d", "soon", "string"),
    ("e", "#N/A", "string"),
])
def test_decode(spark, t, raw, kind):
    df = spark.createDataFrame([(t, raw)], "t string, raw string")
    assert df.select(C.decode_typed("t", "raw").alias("v")).first()["v"]["kind"] == kind


def test_oadate(spark):
    day = datetime.datetime(2001, 1, 1, 12)
    assert one(spark, C.to_oadate, day, "timestamp_ntz") == 36892.5
    assert one(spark, C.from_oadate, 36892.5, "double") == day
    assert one(spark, C.to_oadate, datetime.datetime(1899, 12, 30), "timestamp_ntz") == 0.0


@pytest.mark.parametrize("s,want", [
    ("a\r\nbbb\rcc", ("inlineStr", "a\r\nbbb\r\ncc", "bbb", 2)), ("ab\ncd", ("inlineStr", "ab\r\ncd", "ab", 2)),
    ("a\rb", ("str", "a\rb", "a\rb", 0)), ("", ("str", "", "", 0)),
])
def test_multiline(spark, s, want):
    assert tuple(one(spark, C.multiline, s)) == want


@pytest.mark.parametrize("dtype,value,want", [
    ("int", 7, ("n", "7", 0, "7")), ("double", 1 / 3, ("n", "0.3333333333333333", 0, "0.333333333")),
    ("boolean", True, ("b", "true", 0, "true")), ("decimal(38,0)", 12, ("n", "12", 0, "12")),
    ("float", 0.5, ("n", "0.5", 0, "0.5")), ("date", datetime.date(2001, 1, 1), ("n", "36892", 3, "2001-01-01 00:00:00")),
    ("array<int>", [1, 2], ("str", "[1,2]", 0, "[1,2]")),
])
def test_encode(spark, dtype, value, want):
    df = spark.createDataFrame([(value if "decimal" not in dtype else __import__("decimal").Decimal(value),)], f"v {dtype}")
    assert tuple(df.select(C.encode_value("v", df.schema["v"].dataType).alias("r")).first()["r"]) == want


def test_golden_grid(spark):
    """Blanks, quoted text and shortest numbers, as in the golden workbook with a chart sheet."""
    cells = [(1, 1, "str", "X"), (1, 2, "str", "Y"), (3, 1, "n", "-8"), (3, 2, "n", "-205.6"), (3, 4, "str", "A"), (3, 5, "n", "0.3"), (2, 1, "n", "10.0"), (9, 9, "n", "1")]
    df = spark.createDataFrame([("b", 1, r, c, t, v) for r, c, t, v in cells], "path string, sheet_no int, row int, col int, t string, raw string")
    sheets = spark.createDataFrame([("b", 0, "Graph", None), ("b", 1, "Data's", "A1:E3")], "path string, sheet_no int, sheet_name string, dim_ref string")
    decoded = E.decode_cells(df)
    bounds = E.sheet_bounds(sheets, df)
    lines = E.grid_literal(E.grid_rows(decoded, bounds.where("has_data"), "literal"))
    assert [r["text"] for r in lines.orderBy("row").collect()] == ['["X","Y",,,]', "[10,,,,]", '[-8,-205.6,,"A",0.3]']

    def whole(indent):
        parts = E.workbook_literal(E.sheet_summary(sheets, df), lines, indent, rows_per_part=2)
        return "".join(r["text"] for r in parts.orderBy("sheet_no", "part").collect())

    compact = (
        "{'Graph':{'Name':'Graph','Left':0,'Top':0,'Right':0,'Bottom':0,'Data':null},"
        "'Data's':{'Name':'Data's','Left':1,'Top':1,'Right':5,'Bottom':3,'Data':[[\"X\",\"Y\",,,],[10,,,,],[-8,-205.6,,\"A\",0.3]]}}"
    )
    assert whole(False) == compact
    indented = whole(True)
    assert indented.startswith("{\n\t'Graph':\n\t\t{\n\t\t\t'Name':'Graph',\n\t\t\t'Left':0,")
    assert indented.endswith("\n\t\t\t'Data':\n\t\t\t\t[[\"X\",\"Y\",,,],\n\t\t\t\t [10,,,,],\n\t\t\t\t [-8,-205.6,,\"A\",0.3]]\n\t\t}\n\t}")
    assert "".join(indented.split()) == "".join(compact.split())


def test_grid_fills_rows_and_takes_one_text_per_position(spark):
    df = spark.createDataFrame([("b", 0, 5, 2, "x"), ("b", 0, 5, 2, "w")], "path string, sheet_no int, row int, col int, raw string")
    bounds = spark.createDataFrame([("b", 0, 1, 3, 3, 9000)], "path string, sheet_no int, left int, top int, right int, bottom int")
    rows = E.grid_rows(df, bounds)
    assert rows.count() == 8998
    assert rows.where("row = 5").first()["values"] == [None, "x", None]


@pytest.mark.parametrize("ref,want", [("FXSHRXW1", (2147483647, 1)), ("FXSHRXX1", None), ("B7", (2, 7)), ("AAAAAAAA1", None)])
def test_sql_form_agrees_with_expression(spark, ref, want):
    sqlfuncs.register(spark)
    df = spark.createDataFrame([(ref,)], "ref string")
    got = df.select(C.parse_ref("ref").alias("a"), F.expr("cell_parse_ref(ref)").alias("b")).first()
    assert got["a"] == got["b"] == want


def test_units_and_header(spark):
    schema = T.StructType([
        T.StructField("sheet", T.StringType()), T.StructField("n", T.IntegerType()),
        T.StructField("q", T.StructType([T.StructField("magnitude", T.DoubleType()), T.StructField("unit", T.StringType())])),
        T.StructField("s", T.StringType()),
    ])
    df = spark.createDataFrame([("a", 1, (2.5, "m"), "x"), ("a", 2, None, "two\nlines"), ("a", 3, (3.0, None), None)], schema)
    cells = X.to_cells(df, ["sheet"], ["n", "q", "s"], ["n"], block_of("n", 2)).orderBy("row", "col").collect()
    assert [(c["ref"], c["t"], c["value"], c["style"]) for c in cells] == [
        ("A1", "str", "n", 1), ("B1", "str", "q", 1), ("D1", "str", "s", 1),
        ("A2", "n", "1", 0), ("B2", "n", "2.5", 0), ("C2", "str", "m", 0), ("D2", "str", "x", 0),
        ("A3", "n", "2", 0), ("D3", "inlineStr", "two\r\nlines", 2), ("A4", "n", "3", 0), ("B4", "n", "3", 0),
    ]


CELL_ROWS = "path string, sheet_no int, row int, col int, raw string"
BOX = "path string, sheet_no int, left int, top int, right int, bottom int"


def test_runs_give_the_dense_text(spark):
    import random

    rng = random.Random(2)
    cells = [("p", n, rng.randint(0, 30), rng.randint(0, 9), f"v{i}") for n in range(4) for i in range((0, 1, 12, 60)[n])] + [("p", 1, 7, 3, "z"), ("q", 0, 3, 3, None)]
    boxes = [("p", n, 2, 3, 8, 27) for n in range(4)] + [("q", 0, 3, 3, 3, 9000), ("r", 0, 5, 5, 4, 9), ("s", 0, 1, 1, 2, 2)]
    cell, box = spark.createDataFrame(cells, CELL_ROWS), spark.createDataFrame(boxes, BOX)
    dense = {tuple(r) for r in E.grid_literal(E.grid_rows(cell, box)).collect()}
    assert {tuple(r) for r in E.literal_rows(E.run_literal(E.grid_runs(cell, box))).collect()} == dense


def test_a_huge_range_is_a_few_runs(spark):
    cell = spark.createDataFrame([("p", 0, 5, 2, "1"), ("p", 0, 6, 16384, "2"), ("p", 0, 900_000, 1, "3")], CELL_ROWS)
    box = spark.createDataFrame([("p", 0, 1, 1, 16384, 1048576)], BOX)
    runs = sorted((r["row"], r["to_row"], r["text"]) for r in E.run_literal(E.grid_runs(cell, box)).collect())
    blank = "[" + "," * 16383 + "]"
    assert runs == [
        (1, 4, blank), (5, 5, "[,1" + "," * 16382 + "]"), (6, 6, "[" + "," * 16383 + "2]"), (7, 899_999, blank), (900_000, 900_000, "[3" + "," * 16383 + "]"), (900_001, 1048576, blank),
    ]


# --- literals read back ------------------------------------------------------------------


def _literal(spark, texts):
    from doctables.operators import literals as L

    return L.literal_tokens(spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "path string, part long, text string"))


def test_literal_is_read_back(spark):
    from doctables.operators import literals as L
    from doctables.sources.staging import staged

    values = ["plain", 'say "x"', "back\\slash", "\\", '\\"', "a,b],[c", "'it':{'Name':'x'", "{}[]", "l1\nl2\r\tz", "\\n", "DateTime(1)", "", "\\Q\\B", '"' * 3, "ö 😀"]
    cells = [("b", 0, i + 2, (i % 3) + 2, "str", v) for i, v in enumerate(values)]
    cells += [("b", 0, 3, 6, "n", "-1E-7"), ("b", 0, 3, 7, "b", "1"), ("b", 0, 3, 8, "d", "2024-03-05T07:08:09.250"), ("b", 2, 1, 1, "n", "7")]
    df = spark.createDataFrame(cells, "path string, sheet_no int, row int, col int, t string, raw string")
    sheets = spark.createDataFrame([("b", 0, 'It\'s "A"', None), ("b", 1, "Empty", None), ("b", 2, "Z", "A1:B4")], "path string, sheet_no int, sheet_name string, dim_ref string")
    decoded = E.decode_cells(df)
    lines = E.grid_literal(E.grid_rows(decoded, E.sheet_bounds(sheets, df).where("has_data"), "literal"))
    summary = E.sheet_summary(sheets, df)

    def tokens(indent, rows):
        return staged(L.literal_tokens(L.in_order(E.workbook_literal(summary, lines, indent, rows))), "tokens")

    want = {tuple(r) for r in decoded.select("sheet_no", "row", "col", "literal").collect()}
    indented, compact = tokens(True, 4), tokens(False, 1000)
    got = L.read_literal(indented).collect()
    assert {(r["sheet_no"], r["row"], r["col"], r["literal"]) for r in got} == want
    assert {r["row"]: r["raw"] for r in got if r["sheet_no"] == 0 and r["col"] < 5} == {i + 2: v for i, v in enumerate(values)}
    assert {r["kind"]: r["raw"] for r in got if r["col"] > 5} == {"number": "-1E-07", "boolean": "true", "date": "2024-03-05T07:08:09.250"}
    names = {r["sheet_no"]: (r["sheet_name"], r["left"], r["bottom"], r["has_data"]) for r in L.literal_sheets(compact).collect()}
    assert names == {0: ('It\'s "A"', 2, 16, True), 1: ("Empty", 0, 0, False), 2: ("Z", 1, 4, True)}
    assert L.same_literal(indented, compact).count() == 0


def test_places_of_tokens_are_summed_once(spark):
    """Cells and sheets read the places of tokens; summing them again for each of the two is most of the work."""
    from doctables.operators import literals as L

    token = _literal(spark, ["{'S':{'Name':'S','Left':1,'Top':1,'Right':2,'Bottom':1,'Data':[[1,2]]}}"])
    cells = L.read_literal(token)
    assert {(r["row"], r["col"], r["literal"]) for r in cells.collect()} == {(1, 1, "1"), (1, 2, "2")}
    plan = cells._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window") == 1  # where a row was opened
    assert "posexplode" not in plan


def test_places_go_on_from_block_to_block(spark, monkeypatch):
    """Ten sheets in parts cut anywhere; a block of tokens may hold a whole sheet or one value."""
    from doctables.operators import literals as L

    parts, want = ["{"], set()
    for n in range(10):
        parts.append(f"{',' if n else ''}'S{n}':{{'Name':'S{n}','Left':{n + 1},'Top':{n + 3},'Right':9,'Bottom':9,'Data':{'null' if n % 4 == 2 else '['}")
        if n % 4 != 2:
            for r in range(n % 3 + 1):
                parts += [f"{',' if r else ''}[,{n}", f",,\"{r}", ",[\"]"] if n % 2 else [f"{',' if r else ''}[{r},,\"x\"", "]"]
                if n % 2:
                    parts[-2:] = [f",,\"{r},[\"]"]
                want |= {(n, n + 3 + r, n + 2, str(n)), (n, n + 3 + r, n + 4, f'"{r},["')} if n % 2 else {(n, n + 3 + r, n + 1, str(r)), (n, n + 3 + r, n + 3, '"x"')}
            parts.append("]")
        parts.append("}")
    token = _literal(spark, [*parts, "}"])
    for size in (1, 2, 5, 4096):
        monkeypatch.setattr(L, "TOKEN_BLOCK", size)
        got = [(r["sheet_no"], r["row"], r["col"], r["literal"]) for r in L.read_literal(token).collect()]
        assert sorted(got) == sorted(want)
        assert [(r["sheet_no"], r["sheet_name"], r["top"], r["has_data"]) for r in L.literal_sheets(token).orderBy("sheet_no").collect()] == [
            (n, f"S{n}", n + 3, n % 4 != 2) for n in range(10)
        ]


def test_workbook_of_many_sheets_is_read_back(spark):
    """The number of a part grows with its sheet; from the ninth sheet on it was more than a number can hold once multiplied."""
    from doctables.operators import literals as L

    sheet = "'S':{'Name':'S','Left':1,'Top':1,'Right':1,'Bottom':1,'Data':[[7]]}"
    rows = [("b", n, 0, ("," if n else "{") + sheet + ("}" if n == 11 else "")) for n in range(12)]
    parts = L.in_order(spark.createDataFrame(rows, "path string, sheet_no int, part long, text string"))
    assert sorted(r["sheet_no"] for r in L.read_literal(L.literal_tokens(parts)).collect()) == list(range(12))


def test_staged_tables_leave_no_shuffled_files(spark):
    import time

    from doctables.sources.staging import staged

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {str(files.apply(i).getName()) for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    numbers = staged(spark.range(1000).repartition(5, "id"), "numbers")
    until = time.time() + 3
    while (left := shuffled() - before) and time.time() < until:  # they go in the background
        time.sleep(0.5)
    assert not left
    assert numbers.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_odd_literals(spark):
    from doctables.operators import literals as L

    head = "{'S':{'Name':'S','Left':1,'Top':5,'Right':3,'Bottom':6,'Data':["
    long = "x\\\\\\n\\\"" * 50000
    rows = {(r["row"], r["col"]): r["literal"] for r in L.read_literal(_literal(spark, [head + "[1,,2],", None, "", f'["{long}" , ,DateTime(2024,1,32,0,0,0)]]', "}}"])).collect()}
    assert rows == {(5, 1): "1", (5, 3): "2", (6, 1): f'"{long}"', (6, 3): "DateTime(2024,1,32,0,0,0)"}
    assert L.read_literal(_literal(spark, [])).count() == 0 and L.read_literal(_literal(spark, ["no literal, at [all]"])).count() == 0
    a, b = _literal(spark, [head + "[1,,2]]}}"]), _literal(spark, [head.replace("'Right':3", "'Right':4") + "[1,,3]]}}"])
    got = sorted((r["row"], r["col"], r["a"][:2], r["b"][:2]) for r in L.same_literal(a, b).collect())
    assert got == [(0, 0, '{"', '{"'), (5, 3, "2", "3")]


def test_grid_runs_of_several_bounds(spark):
    """Each bound of a sheet keeps its own cells; the same bound twice adds nothing to rows with cells."""
    cells = spark.createDataFrame([("b", 0, r, c, f"{r}{c}") for r in (2, 4) for c in (1, 3, 9)] + [("b", 0, 9, 1, "x")], "path string, sheet_no int, row int, col int, raw string")
    bounds = spark.createDataFrame([("b", 0, 1, 1, 3, 3), ("b", 0, 1, 1, 3, 3), ("b", 0, 2, 4, 4, 4)], "path string, sheet_no int, left int, top int, right int, bottom int")
    got = sorted((r["row"], r["to_row"], [tuple(c) for c in r["cells"]], r["left"], r["right"]) for r in E.grid_runs(cells, bounds).collect() if r["cells"])
    assert got == [(2, 2, [(1, "21"), (3, "23")], 1, 3), (4, 4, [(3, "43")], 2, 4)]


def test_rows_of_grids_are_read_not_worked_again(spark):
    """Single rows and long runs are two readings of the grid; both were worked from the cells, with eight copies of the bounds."""
    cells = spark.createDataFrame([("b", 0, 2, 1, "a"), ("b", 0, 9000, 2, "b")], "path string, sheet_no int, row int, col int, raw string")
    rows = E.literal_rows(E.run_literal(E.grid_runs(cells, E.used_range(cells).withColumn("top", F.lit(1)))))
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()
    got = {r["row"]: r["text"] for r in rows.collect()}
    assert len(got) == 9000 and (got[1], got[2], got[8999], got[9000]) == ("[,]", "[a,]", "[,]", "[,b]")


@pytest.mark.parametrize("ref,want", [("B7", (2, 7)), ("1A", (1, 1)), ("FXSHRXW1", (2147483647, 1)), ("FXSHRXX1", None), ("A" * 30 + "1", None), ("A", None), ("7", None), ("", None), ("A-1", None), ("A99999999999", None), (None, None)])
def test_reference_is_whole_or_null(spark, ref, want):
    got = spark.createDataFrame([(ref,)], "ref string").select(C.parse_ref("ref").alias("r"), C.parse_range(F.concat("ref", F.lit(":"), "ref")).alias("x")).first()
    assert (got["r"] and tuple(got["r"])) == want and (got["x"] and tuple(got["x"])) == (want and want * 2)


def test_grid_runs_numbers_cells_once(spark, tmp_path):
    """The rows behind the result are written cells; the line items aren't numbered again for every reader."""
    day = datetime.datetime(2020, 1, 2)
    rows = [(k // 3, 10 + k, k % 5, k % 3, float(k), 1.5 * k, 0.1, 0.2, "A", "F", day) for k in range(60)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    names += ", l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = QUERIES["grid_runs"](spark, str(tmp_path))
    assert not [f for f in got.inputFiles() if "lineitem" in f]
    cells = V.cells_hot(spark, str(tmp_path))
    bounds = E.used_range(cells).withColumn("left", F.lit(1)).withColumn("top", F.lit(1)).withColumn("right", F.lit(11))
    want = E.run_literal(E.grid_runs(cells, bounds)).collect()
    assert want and sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def test_grid_rows_of_odd_cells(spark):
    """Repeated positions, cells beyond the bounds or without a column, and rows without cells."""
    rows = [("p", 0, 1, c, x) for c, x in [(2, "b"), (2, "a"), (2, None), (4, "d"), (9, "far"), (0, "near"), (None, "lost")]]
    rows += [("p", 0, 2, c, x) for c, x in [(1, "a"), (2, None), (3, "c"), (4, "d"), (4, "d"), (5, "e")]] + [("p", 0, 3, None, "lost")]
    cell = spark.createDataFrame(rows, "path string, sheet_no int, row int, col int, raw string")
    bounds = spark.createDataFrame([("p", 0, 2, 1, 5, 4)], "path string, sheet_no int, left int, top int, right int, bottom int")
    got = {r.row: r["values"] for r in E.grid_rows(cell, bounds).collect()}
    assert got == {1: ["b", None, "d", None], 2: [None, "c", "d", "e"], 3: [None] * 4, 4: [None] * 4}


def test_bounds_make_no_texts(spark, tmp_path):
    """Bounds of the line items' cells read no column that only texts need."""
    types = ["bigint"] * 3 + ["int"] + ["double"] * 4 + ["string"] * 2 + ["date"]
    spark.sql("SELECT " + ", ".join(f"CAST(1 AS {t}) AS {c}" if t != "date" else f"DATE '2000-01-01' AS {c}" for c, t in zip(V.LINE_COLUMNS, types))).write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = E.used_range(V.cells_hot(spark, str(tmp_path)))._jdf.queryExecution().sparkPlan().toString()
    assert "l_orderkey" in plan and "l_shipdate" not in plan and "l_tax" not in plan
