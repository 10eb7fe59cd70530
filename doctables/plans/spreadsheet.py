"""Queries on spreadsheet operators, with the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from doctables.functions import cells as C
from doctables.operators import cells as E
from doctables.operators import literals as L
from doctables.operators import sheets as X
from doctables.operators.running import block_of
from doctables.plans import views as V
from doctables.plans.oracle_views import views
from doctables.plans.register import registry
from doctables.sources.staging import drop_staged, staged

QUERIES, ORACLE, query = registry()

# SQL fragments shared by several oracles
_NUM = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"
_DATE = r"'^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$'"


def _number_text(x: str) -> str:
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


def _oa(ts: str) -> str:
    return f"CAST((epoch_us({ts}) + 2209161600000000) // 1000 AS DOUBLE) / 86400000.0::DOUBLE"


def _width(text: str) -> str:
    return f"floor((length({text}) * 7.1::DOUBLE + 5) / 7.1::DOUBLE * 256) / 256"


_DECODED = rf""", num AS (SELECT *, CASE WHEN regexp_matches(raw, {_NUM}) THEN CAST(raw AS DOUBLE) END AS number,
  CASE WHEN regexp_matches(lower(raw), '^(true|false|1|0)$') THEN lower(raw) IN ('true', '1') END AS flag,
  CASE WHEN regexp_matches(raw, {_DATE}) THEN CAST(replace(raw, 'T', ' ') AS TIMESTAMP) END AS day FROM cells),
decoded AS (SELECT path, sheet_no, "row", col, t, raw, CASE
    WHEN (t = 'n' OR t IS NULL) AND number IS NOT NULL THEN 'number'
    WHEN (t = 'b' OR t IS NULL) AND flag IS NOT NULL THEN 'boolean'
    WHEN t = 'd' AND (day IS NOT NULL OR number IS NOT NULL) THEN 'date' ELSE 'string' END AS kind,
  number, flag, coalesce(day, TIMESTAMP '1899-12-30' + to_milliseconds(CAST(floor(number * 86400000 + 0.5) AS BIGINT))) AS ts FROM num)
"""
_LITERAL = f"""CASE kind WHEN 'number' THEN {_number_text('number')} WHEN 'boolean' THEN CAST(flag AS VARCHAR)
  WHEN 'date' THEN strftime(ts, 'DateTime(%Y,%-m,%-d,%-H,%-M,%-S)') ELSE '"' || raw || '"' END"""


@query("parse_ref", views("cells") + r"""SELECT path, sheet_no, "row", col,
  CASE WHEN regexp_matches(ref, '^[A-Za-z0-9]+$') THEN CAST(ascii(upper(regexp_extract(ref, '[A-Za-z]'))) - 64 AS INTEGER) END AS ref_col,
  CASE WHEN regexp_matches(ref, '^[A-Za-z0-9]+$') THEN CAST(regexp_extract(ref, '[0-9]+') AS INTEGER) END AS ref_row FROM cells""")
def parse_ref(spark, sf):
    return V.cells(spark, sf).withColumn("r", C.parse_ref("ref")).select(
        "path", "sheet_no", "row", "col", F.col("r.col").alias("ref_col"), F.col("r.row").alias("ref_row")
    )


@query("parse_range", r"""SELECT o_orderkey, CASE WHEN ok THEN 1 + CAST(o_orderkey % 26 AS INTEGER) END AS "left",
  CASE WHEN ok THEN CAST(o_orderkey % 90 + 1 AS INTEGER) END AS top, CASE WHEN ok THEN 26 + 1 + CAST(o_custkey % 26 AS INTEGER) END AS "right",
  CASE WHEN ok THEN CAST(o_custkey + 1 AS INTEGER) END AS bottom FROM (SELECT *, o_orderkey % 7 NOT IN (0, 3) AS ok FROM orders)""")
def parse_range(spark, sf):
    first = C.cell_ref(F.col("o_orderkey") % 26 + 1, F.col("o_orderkey") % 90 + 1)
    last = C.cell_ref(F.col("o_custkey") % 26 + 27, F.col("o_custkey") + 1)
    n = F.col("o_orderkey") % 7
    ref = (
        F.when(n == 0, first)
        .when(n == 3, F.concat(first, F.lit(":"), last, F.lit(":A1")))
        .otherwise(F.concat(first, F.lit(":"), last))
    )
    return (
        V.table(spark, sf, "orders").select("o_orderkey", ref.alias("ref"))
        .withColumn("r", C.parse_range("ref")).select("o_orderkey", "r.left", "r.top", "r.right", "r.bottom")
    )


@query("cell_ref", r"""SELECT l_orderkey, l_linenumber, l_partkey,
  list_aggregate(list_reverse(list_transform(list_filter(
    [l_partkey + 1, l_partkey // 26, ((l_partkey // 26) - 1) // 26, ((((l_partkey // 26) - 1) // 26) - 1) // 26], lambda x: x > 0),
    lambda x: chr(CAST(65 + (x - 1) % 26 AS INTEGER)))), 'string_agg', '') || l_linenumber AS ref,
  l_partkey + 1 AS back FROM lineitem""")
def cell_ref(spark, sf):
    n = F.col("l_partkey") + 1
    ref = C.cell_ref(n, "l_linenumber")
    return V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ref.alias("ref")).withColumn(
        "back", C.parse_ref("ref")["col"].cast("long")
    )


@query("resolve_strings", views("cells", "shared_strings") + """SELECT c.path, sheet_no, "row", col, t, coalesce(text, raw) AS raw
FROM cells c LEFT JOIN shared_strings s ON c.path = s.path AND t = 's' AND TRY_CAST(raw AS INTEGER) = idx""")
def resolve_strings(spark, sf):
    return E.resolve_strings(V.cells(spark, sf), V.shared_strings(spark, sf)).drop("ref")


@query("decode_typed", views("cells") + _DECODED + """SELECT path, sheet_no, "row", col, kind, CASE WHEN kind = 'number' THEN number END AS d,
  CASE WHEN kind = 'boolean' THEN flag END AS b, CASE WHEN kind = 'date' THEN epoch_us(ts) END AS us,
  CASE WHEN kind = 'string' THEN raw END AS s FROM decoded""")
def decode_typed(spark, sf):
    v = E.decode_values(V.cells(spark, sf))
    return v.select("path", "sheet_no", "row", "col", "value.kind", "value.d", "value.b",
                    F.unix_micros(F.col("value.ts").cast("timestamp")).alias("us"), "value.s")


@query("infer_value", rf"""SELECT event_id, i, CASE WHEN regexp_matches(raw, {_NUM}) THEN 'number'
    WHEN regexp_matches(lower(raw), '^(true|false|1|0)$') THEN 'boolean' ELSE 'string' END AS kind,
  CASE WHEN regexp_matches(raw, {_NUM}) THEN CAST(raw AS DOUBLE) END AS d,
  CASE WHEN raw = 'True' THEN true END AS b,
  CASE WHEN NOT regexp_matches(raw, {_NUM}) AND raw <> 'True' THEN raw END AS s
FROM (SELECT event_id, 0 AS i, CAST(value AS VARCHAR) AS raw FROM events UNION ALL SELECT event_id, 1, props FROM events
  UNION ALL SELECT event_id, 2, CASE WHEN event_id % 2 = 0 THEN 'True' ELSE ' 1' END FROM events)""")
def infer_value(spark, sf):
    raws = F.array(F.col("value").cast("string"), F.col("props"),
                   F.when(F.col("event_id") % 2 == 0, "True").otherwise(" 1"))
    return (
        V.table(spark, sf, "events").select("event_id", F.posexplode(raws).alias("i", "raw"))
        .withColumn("v", C.infer_value("raw")).select("event_id", "i", "v.kind", "v.d", "v.b", "v.s")
    )


_BOUNDS = """, box(dim_ref, l, t, r, b) AS (VALUES ('A1:G200', 1, 1, 7, 200), ('B3:F150', 2, 3, 6, 150)),
used AS (SELECT path, sheet_no, min(col) AS l, min("row") AS t, max(col) AS r, max("row") AS b FROM cells GROUP BY ALL),
bounds AS (SELECT s.path, s.sheet_no, s.sheet_name, coalesce(x.l, u.l, 0) AS "left", coalesce(x.t, u.t, 0) AS top,
  coalesce(x.r, u.r, 0) AS "right", coalesce(x.b, u.b, 0) AS bottom, coalesce(x.l, u.l) IS NOT NULL AS has_data
  FROM sheets s LEFT JOIN box x ON s.dim_ref = x.dim_ref LEFT JOIN used u ON u.path = s.path AND u.sheet_no = s.sheet_no)
"""


@query("clip", views("cells", "sheets") + _BOUNDS + """SELECT c.path, c.sheet_no, "row", col, raw FROM cells c
  JOIN sheets s ON c.path = s.path AND c.sheet_no = s.sheet_no JOIN box x ON x.dim_ref = s.dim_ref
  WHERE col BETWEEN l AND r AND "row" BETWEEN x.t AND b""")
def clip(spark, sf):
    return E.clip(V.cells(spark, sf), E.declared_bounds(V.sheets(spark, sf))).drop("ref", "t")


@query("sheet_bounds", views("cells", "sheets") + _BOUNDS +
       'SELECT path, sheet_no, "left", top, "right", bottom, has_data FROM bounds')
def sheet_bounds(spark, sf):
    return E.sheet_bounds(V.sheets(spark, sf), V.cells(spark, sf))


@query("used_range", views("cells_hot") + """SELECT path, sheet_no, min(col) AS "left", min("row") AS top,
  max(col) AS "right", max("row") AS bottom FROM cells_hot GROUP BY ALL""")
def used_range(spark, sf):
    return E.used_range(V.cells_hot(spark, sf))


@query("sheet_summary", views("cells", "sheets") + _BOUNDS + """SELECT path, sheet_no, sheet_name, "left", top, "right", bottom,
  CASE WHEN has_data THEN "right" - "left" + 1 ELSE 0 END AS width, CASE WHEN has_data THEN bottom - top + 1 ELSE 0 END AS height,
  has_data FROM bounds""")
def sheet_summary(spark, sf):
    return E.sheet_summary(V.sheets(spark, sf), V.cells(spark, sf))


@query("grid_rows", views("cells_hot") + """, b AS (SELECT path, max("row") AS bottom FROM cells_hot GROUP BY path),
every AS (SELECT path, unnest(range(1, bottom + 1)) AS r FROM b),
dense AS (SELECT e.path, e.r, c.c, x.raw FROM every e CROSS JOIN (SELECT unnest(range(1, 12)) AS c) c
  LEFT JOIN cells_hot x ON x.path = e.path AND x."row" = e.r AND x.col = c.c)
SELECT path, 0 AS sheet_no, CAST(r AS INTEGER) AS "row", count(*) AS width, string_agg(coalesce(raw, ''), '|' ORDER BY c) AS "values"
FROM dense GROUP BY path, r""")
def grid_rows(spark, sf):
    cells = V.cells_hot(spark, sf)
    used = E.used_range(cells)
    bounds = used.withColumn("left", F.lit(1)).withColumn("top", F.lit(1)).withColumn("right", F.lit(11))
    return E.grid_rows(cells, bounds).select(
        "path", "sheet_no", "row", F.size("values").cast("long").alias("width"),
        F.array_join("values", "|", "").alias("values"),
    )


@query("grid_runs", views("cells_hot") + """, filled AS (SELECT path, "row", '[' || string_agg(repeat(',', col - p) || raw, '' ORDER BY col) || repeat(',', 11 - max(col)) || ']' AS text
  FROM (SELECT *, coalesce(lag(col) OVER (PARTITION BY path, "row" ORDER BY col), 1) AS p FROM cells_hot) GROUP BY path, "row"),
gaps AS (SELECT path, coalesce(lag("row") OVER (PARTITION BY path ORDER BY "row"), 0) + 1 AS f, "row" - 1 AS t FROM filled)
SELECT path, 0 AS sheet_no, "row", "row" AS to_row, text FROM filled UNION ALL SELECT path, 0, f, t, '[,,,,,,,,,,]' FROM gaps WHERE f <= t""")
def grid_runs(spark, sf):
    # cells are numbered once for all that read them; bounds are written so that Spark knows their size and need not shuffle the cells to them
    cells = staged(V.cells_hot(spark, sf).select("path", "sheet_no", "row", "col", "raw"), "cells")
    bounds = E.used_range(cells).withColumn("left", F.lit(1)).withColumn("top", F.lit(1)).withColumn("right", F.lit(11))
    return E.run_literal(E.grid_runs(cells, staged(bounds, "bounds")))


_GRID = views("cells", "sheets") + _DECODED + _BOUNDS + f""",
lit AS (SELECT d.path, d.sheet_no, d."row", col, {_LITERAL} AS x FROM decoded d),
every AS (SELECT path, sheet_no, "left", top, "right", unnest(range(top, bottom + 1)) AS r FROM bounds WHERE has_data),
pos AS (SELECT *, unnest(range("left", "right" + 1)) AS c FROM every),
lines AS (SELECT p.path, p.sheet_no, CAST(p.r AS INTEGER) AS "row", any_value(p.top) AS top,
  '[' || string_agg(coalesce(l.x, ''), ',' ORDER BY p.c) || ']' AS text
  FROM pos p LEFT JOIN lit l ON l.path = p.path AND l.sheet_no = p.sheet_no AND l."row" = p.r AND l.col = p.c
  GROUP BY p.path, p.sheet_no, p.r)
"""


def _lines(spark, sf):
    cells = E.decode_cells(V.cells(spark, sf))
    bounds = E.sheet_bounds(V.sheets(spark, sf), cells).where("has_data")
    return E.grid_literal(E.grid_rows(cells, bounds, "literal"))


@query("grid_literal", _GRID + 'SELECT path, sheet_no, "row", text FROM lines')
def grid_literal(spark, sf):
    return _lines(spark, sf)


@query("workbook_literal", _GRID + r""", ends AS (SELECT *, min(sheet_no) OVER (PARTITION BY path) = sheet_no AS f, max(sheet_no) OVER (PARTITION BY path) = sheet_no AS z FROM bounds)
SELECT path, sheet_no, CAST(0 AS BIGINT) AS part, CASE WHEN f THEN '{' ELSE ',' END || e'\n\t\'' || sheet_name || e'\':\n\t\t{\n\t\t\t\'Name\':\'' || sheet_name
  || e'\',\n\t\t\t\'Left\':' || "left" || e',\n\t\t\t\'Top\':' || top || e',\n\t\t\t\'Right\':' || "right" || e',\n\t\t\t\'Bottom\':' || bottom
  || e',\n\t\t\t\'Data\':' || CASE WHEN has_data THEN e'\n\t\t\t\t[' ELSE 'null' END AS text FROM ends
UNION ALL SELECT path, sheet_no, CASE WHEN has_data THEN bottom // 64 - top // 64 + 2 ELSE 1 END, CASE WHEN has_data THEN ']' ELSE '' END || e'\n\t\t}' || CASE WHEN z THEN e'\n\t}' ELSE '' END FROM ends
UNION ALL SELECT path, sheet_no, "row" // 64 - any_value(top) // 64 + 1, string_agg(CASE WHEN "row" > top THEN e',\n\t\t\t\t ' ELSE '' END || text, '' ORDER BY "row")
  FROM lines GROUP BY path, sheet_no, "row" // 64, top""")
def workbook_literal(spark, sf):
    summary = E.sheet_summary(V.sheets(spark, sf), V.cells(spark, sf))
    return E.workbook_literal(summary, _lines(spark, sf), indent=True, rows_per_part=64)


@query("same_grid", views("cells_hot") + """SELECT path, sheet_no, "row", col, raw AS a,
  CASE WHEN "row" % 100 = 1 AND col = 5 THEN NULL ELSE raw || '?' END AS b FROM cells_hot
  WHERE "row" % 100 = 1 AND col = 5 OR "row" % 50 = 7 AND col = 6""")
def same_grid(spark, sf):
    a = V.cells_hot(spark, sf)
    row, col = F.col("row"), F.col("col")
    other = F.when((row % 50 == 7) & (col == 6), F.concat("raw", F.lit("?"))).otherwise(F.col("raw"))
    b = a.where(~((row % 100 == 1) & (col == 5))).withColumn("raw", other)
    return E.same_grid(a, b)


_INSIDE = """inside AS (SELECT l.* FROM lit l JOIN bounds b ON b.path = l.path AND b.sheet_no = l.sheet_no AND b.has_data
  AND l."row" BETWEEN b.top AND b.bottom AND l.col BETWEEN b."left" AND b."right" WHERE l.x <> '')"""


@query("literal_cells", _GRID + f""", {_INSIDE} SELECT path, sheet_no, "row", col, x AS literal, CASE WHEN x[1] = '"' THEN 'text' WHEN starts_with(x, 'DateTime') THEN 'date'
  WHEN x IN ('true', 'false') THEN 'boolean' ELSE 'number' END AS kind FROM inside""")
def literal_cells(spark, sf):
    cells = staged(E.decode_cells(V.cells(spark, sf)), "cells")  # read for the summary, the bounds and the rows
    summary = E.sheet_summary(V.sheets(spark, sf), cells)
    bounds = E.sheet_bounds(V.sheets(spark, sf), cells).where("has_data")
    texts = E.workbook_literal(summary, E.grid_literal(E.grid_rows(cells, bounds, "literal")), indent=True, rows_per_part=64)
    return L.read_literal(staged(L.literal_tokens(L.in_order(texts)), "tokens")).drop("raw")


@query("same_literal", _GRID + f""", {_INSIDE} SELECT path, sheet_no, "row", col, x AS a, CASE WHEN "row" % 5 = 2 THEN '"other"' END AS b FROM inside WHERE "row" % 5 = 2 OR "row" % 7 = 3""")
def same_literal(spark, sf):
    cells = staged(E.decode_cells(V.cells(spark, sf)), "cells")  # read for the bounds, the summary and both texts
    bounds = staged(E.sheet_bounds(V.sheets(spark, sf), cells), "bounds")
    summary = staged(E.sheet_summary(V.sheets(spark, sf), cells), "summary")
    other = F.when(F.col("row") % 5 == 2, F.lit('"other"')).otherwise(F.col("literal"))
    changed = cells.withColumn("literal", other).where("row % 5 = 2 OR row % 7 <> 3")

    def tokens(cell, indent, rows_per_part):
        lines = E.grid_literal(E.grid_rows(cell, bounds.where("has_data"), "literal"))
        return staged(L.literal_tokens(L.in_order(E.workbook_literal(summary, lines, indent, rows_per_part))), "tokens")

    a, b = tokens(cells, True, 64), tokens(changed, False, 1000)
    for used in (cells, bounds, summary):
        drop_staged(used)
    found = L.same_literal(a, b)
    for used in (a, b):  # it has written what it reads of them
        drop_staged(used)
    return found


# --- tables to sheets -----------------------------------------------------------------


def _quantities(spark, sf):
    """Parts with their size as a quantity; brands ending in 3 have none, some have no unit."""
    unit = F.when(F.col("p_partkey") % 5 == 0, "").when(F.col("p_partkey") % 5 == 1, F.lit(None)).otherwise("kg")
    size = F.when(
        ~F.col("p_brand").endswith("3"),
        F.struct(F.col("p_size").cast("double").alias("magnitude"), unit.alias("unit")),
    )
    return V.table(spark, sf, "part").select("p_partkey", "p_brand", "p_name", size.alias("size"), "p_retailprice")


@query("split_units", """SELECT p_partkey, 0 AS shift, 'n' AS t, CAST(p_size AS VARCHAR) AS value FROM part WHERE NOT p_brand LIKE '%3'
UNION ALL SELECT p_partkey, 1, 'str', 'kg' FROM part WHERE NOT p_brand LIKE '%3' AND p_partkey % 5 > 1""")
def split_units(spark, sf):
    return _quantities(spark, sf).select("p_partkey", F.explode(X.split_units("size")).alias("v")).select("p_partkey", "v.*")


_INCR = """SELECT p_brand, o AS ord, n AS name, CASE WHEN o = 2 AND NOT p_brand LIKE '%3' THEN 2 ELSE 1 END AS incr
FROM (SELECT DISTINCT p_brand FROM part), (VALUES (0, 'p_partkey'), (1, 'p_name'), (2, 'size'), (3, 'p_retailprice')) v(o, n)"""
_PART_COLUMNS = ["p_partkey", "p_name", "size", "p_retailprice"]


@query("col_increments", _INCR)
def col_increments(spark, sf):
    return X.col_increments(_quantities(spark, sf), ["p_brand"], _PART_COLUMNS)


@query("col_positions", f"""SELECT *, CAST(1 + coalesce(sum(incr) OVER (PARTITION BY p_brand ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start
FROM ({_INCR})""")
def col_positions(spark, sf):
    return X.col_positions(col_increments(spark, sf), ["p_brand"])


@query("quantity_cells", f"""WITH p AS (SELECT *, 1 + row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r, NOT p_brand LIKE '%3' AS q FROM part),
c AS (SELECT p_brand, r AS "row", 1 AS col, 'n' AS t, CAST(p_partkey AS VARCHAR) AS value, 0 AS style FROM p
UNION ALL SELECT p_brand, r, 2, 'str', p_name, 0 FROM p
UNION ALL SELECT p_brand, r, 3, 'n', CAST(p_size AS VARCHAR), 0 FROM p WHERE q
UNION ALL SELECT p_brand, r, 4, 'str', 'kg', 0 FROM p WHERE q AND p_partkey % 5 > 1
UNION ALL SELECT p_brand, r, CASE WHEN q THEN 5 ELSE 4 END, 'n', {_number_text('p_retailprice')}, 0 FROM p
UNION ALL SELECT p_brand, 1, CASE WHEN o = 3 AND NOT p_brand LIKE '%3' THEN 5 ELSE o + 1 END, 'str', n, 1
  FROM (SELECT DISTINCT p_brand FROM part), (VALUES (0, 'p_partkey'), (1, 'p_name'), (2, 'size'), (3, 'p_retailprice')) v(o, n))
SELECT p_brand, "row", col, chr(64 + col) || "row" AS ref, t, value, style FROM c""")
def quantity_cells(spark, sf):
    return X.to_cells(_quantities(spark, sf), ["p_brand"], _PART_COLUMNS, ["p_partkey"], block_of("p_partkey", 1024)).drop("display")


@query("to_cells", f"""WITH o AS (SELECT *, 1 + row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS r FROM orders),
c AS (SELECT o_orderstatus, r AS "row", 1 AS col, 'n' AS t, CAST(o_orderkey AS VARCHAR) AS value, 0 AS style FROM o
UNION ALL SELECT o_orderstatus, r, 2, 'n', {_number_text('o_totalprice')}, 0 FROM o
UNION ALL SELECT o_orderstatus, r, 3, 'n', {_number_text('(' + _oa('o_orderdate') + ')')}, 3 FROM o
UNION ALL SELECT o_orderstatus, r, 4, 'str', o_orderpriority, 0 FROM o
UNION ALL SELECT o_orderstatus, 1, i, 'str', n, 1 FROM (SELECT DISTINCT o_orderstatus FROM orders),
  (VALUES (1, 'o_orderkey'), (2, 'o_totalprice'), (3, 'o_orderdate'), (4, 'o_orderpriority')) v(i, n))
SELECT o_orderstatus, "row", col, chr(64 + col) || "row" AS ref, t, value, style FROM c""")
def to_cells(spark, sf):
    columns = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    orders = V.table(spark, sf, "orders")
    return X.to_cells(orders, ["o_orderstatus"], columns, ["o_orderkey"], block_of("o_orderkey", 4096)).drop("display")


_CUSTOMER = f"""WITH o AS (SELECT *, 1 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer),
c AS (SELECT c_nationkey, r AS "row", 1 AS col, 'n' AS t, CAST(c_custkey AS VARCHAR) AS value, 0 AS style, CAST(c_custkey AS VARCHAR) AS display FROM o
UNION ALL SELECT c_nationkey, r, 2, 'str', c_name, 0, c_name FROM o
UNION ALL SELECT c_nationkey, r, 3, 'n', {_number_text('c_acctbal')}, 0, substr({_number_text('c_acctbal')}, 1, 11) FROM o
UNION ALL SELECT c_nationkey, r, 4, 'str', c_mktsegment, 0, c_mktsegment FROM o
UNION ALL SELECT c_nationkey, 1, i, 'str', n, 1, n FROM (SELECT DISTINCT c_nationkey FROM customer),
  (VALUES (1, 'c_custkey'), (2, 'c_name'), (3, 'c_acctbal'), (4, 'c_mktsegment')) v(i, n))
"""


def _customer_cells(spark, sf):
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    return X.to_cells(V.table(spark, sf, "customer"), ["c_nationkey"], columns, ["c_custkey"], block_of("c_custkey", 1024))


@query("with_header", _CUSTOMER + 'SELECT c_nationkey, "row", col, chr(64 + col) || "row" AS ref, t, value, style, display FROM c')
def with_header(spark, sf):
    return _customer_cells(spark, sf)


@query("col_widths", _CUSTOMER + f'SELECT c_nationkey, col, max({_width("display")}) AS width FROM c GROUP BY ALL')
def col_widths(spark, sf):
    return X.col_widths(_customer_cells(spark, sf), ["c_nationkey"])


@query("encode_value", f"""SELECT l_orderkey, l_linenumber, l_partkey, 'n' AS t1, {_number_text('l_extendedprice')} AS v1, 'str' AS t2, l_returnflag AS v2,
  'n' AS t3, {_number_text('(' + _oa('l_shipdate') + ')')} AS v3, 3 AS s3, 'b' AS t4, CASE WHEN l_linestatus = 'F' THEN 'true' ELSE 'false' END AS v4,
  'n' AS t5, CAST(l_suppkey AS VARCHAR) AS v5 FROM lineitem""")
def encode_value(spark, sf):
    lines = V.table(spark, sf, "lineitem").withColumn("closed", F.col("l_linestatus") == "F")
    cols = ["l_extendedprice", "l_returnflag", "l_shipdate", "closed", "l_suppkey"]
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    enc = X.stored_cells(lines, cols, keep)
    out = []
    for i in range(5):
        out += [F.get("cells", F.lit(i))["t"].alias(f"t{i + 1}"), F.get("cells", F.lit(i))["value"].alias(f"v{i + 1}")]
    return enc.select(*keep, *out, F.get("cells", F.lit(2))["style"].alias("s3"))


@query("oadate", f"""SELECT 'o' AS src, o_orderkey AS id, {_oa('o_orderdate')} AS days, epoch_us(o_orderdate) AS back FROM orders
UNION ALL SELECT 'e', event_id, {_oa('ts')}, 1000 * CAST(floor({_oa('ts')} * 86400000 + 0.5) AS BIGINT) - 2209161600000000 FROM events""")
def oadate(spark, sf):
    a = V.table(spark, sf, "orders").select(F.lit("o").alias("src"), F.col("o_orderkey").alias("id"), C.to_oadate("o_orderdate").alias("days"))
    b = V.table(spark, sf, "events").select(F.lit("e").alias("src"), F.col("event_id").alias("id"), C.to_oadate("ts").alias("days"))
    return a.unionByName(b).withColumn("back", F.unix_micros(C.from_oadate("days").cast("timestamp")))


@query("multiline", """SELECT doc_id, CASE WHEN contains(text, chr(10)) THEN 'inlineStr' ELSE 'str' END AS t,
  replace(text, chr(10), chr(13) || chr(10)) AS stored, CASE WHEN contains(text, chr(10)) THEN 2 ELSE 0 END AS style,
  (SELECT x FROM (SELECT unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i) ORDER BY length(x) DESC, i LIMIT 1) AS longest
FROM documents""")
def multiline(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", C.multiline("text").alias("m"))
    return docs.select("doc_id", "m.t", F.col("m.text").alias("stored"), "m.style", "m.longest")


@query("display_text", f"""SELECT l_orderkey, l_linenumber, l_partkey, substr({_number_text('x')}, 1, 11) AS price,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped, CASE WHEN l_linestatus = 'F' THEN 'true' ELSE 'false' END AS closed
FROM (SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS x FROM lineitem)""")
def display_text(spark, sf):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        C.encode_value(price, T.DoubleType())["display"].alias("price"),
        C.encode_value("l_shipdate", T.TimestampNTZType())["display"].alias("shipped"),
        C.encode_value(F.col("l_linestatus") == "F", T.BooleanType())["display"].alias("closed"),
    )


@query("encode_boolean", """SELECT o_custkey, 1 AS "row", 1 AS col, 'A1' AS ref, 'b' AS t,
  CASE WHEN count(*) FILTER (WHERE o_totalprice > 400000) > 0 THEN 'true' ELSE 'false' END AS value, 0 AS style FROM orders GROUP BY o_custkey""")
def encode_boolean(spark, sf):
    asked = V.table(spark, sf, "orders").groupBy("o_custkey").agg(
        (F.count_if(F.col("o_totalprice") > 400000) > 0).alias("yes")
    )
    return asked.select("o_custkey", X.encode_boolean("yes").alias("c")).select("o_custkey", "c.*")


@query("encode_term", """SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'n' ELSE 'str' END AS t, CASE page_id % 4
  WHEN 0 THEN CASE WHEN starts_with(url, 'https://www.') THEN 'w:' || substr(url, 13) WHEN starts_with(url, 'https://') THEN 's:' || substr(url, 9) ELSE url END
  WHEN 1 THEN CAST(page_id AS VARCHAR) WHEN 2 THEN '_:b' || page_id ELSE url END AS value, 0 AS style FROM pages""")
def encode_term(spark, sf):
    n = F.col("page_id") % 4
    term = F.struct(
        F.when(n == 0, "uri").when(n == 2, "bnode").otherwise("literal").alias("kind"),
        F.when(n == 1, F.col("page_id").cast("string")).when(n == 2, F.concat(F.lit("b"), F.col("page_id").cast("string")))
        .otherwise(F.col("url")).alias("value"),
        F.when(n == 1, "http://www.w3.org/2001/XMLSchema#integer").alias("datatype"),
    )
    names = {"s": "https://", "w": "https://www."}
    return V.table(spark, sf, "pages").select("page_id", X.encode_term(term, names).alias("c")).select("page_id", "c.*")
