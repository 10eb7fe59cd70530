"""Queries on fields, parameters and headers, with the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from doctables.functions import fields as FF
from doctables.operators import params as P
from doctables.plans import views as V
from doctables.plans.markdown import _escaped
from doctables.plans.oracle_views import views
from doctables.plans.register import registry

QUERIES, ORACLE, query = registry()


@query("parse_field", views("fields") + r"""SELECT path, pos, upper(regexp_extract(instr, '\w+')) AS command,
  CASE WHEN starts_with(instr, 'SEQ') THEN string_split(instr, ' ')[2] ELSE '' END AS argument,
  CASE WHEN contains(instr, '\*') THEN '*' WHEN contains(instr, '\@') THEN '@' ELSE '' END AS switch,
  CASE WHEN contains(instr, '\') THEN regexp_extract(instr, '\\. (.*)$', 1) ELSE '' END AS format
FROM fields WHERE pos % 6 <> 5""")
def parse_field(spark, sf):
    return P.parse_fields(V.fields(spark, sf)).select("path", "pos", "f.*")


def _field_props(spark, sf):
    """Title, author and dates of each user's documents, from the user's own events."""
    first = V.table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("created"), F.max("ts").alias("modified"), F.count("*").alias("n")
    )
    values = [
        ("Title", F.concat(F.lit("User "), F.col("user_id").cast("string"), F.lit(" (all)"))),
        ("Creator", F.when(F.col("user_id") % 4 > 0, F.concat(F.lit("a-"), F.col("n").cast("string")))),
        ("Created", F.date_format("created", "yyyy-MM-dd HH:mm:ss")),
        ("Modified", F.date_format("modified", "yyyy-MM-dd HH:mm:ss")),
    ]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in values]))
    return first.select(F.col("user_id").alias("path"), each.alias("v")).select("path", "v.*").where(
        F.col("value").isNotNull()
    )


@query("resolve_fields", views("fields") + f"""SELECT path, pos, {_escaped("CASE pos % 6 WHEN 3 THEN 'User ' || path || ' (all)' ELSE 'a-' || (SELECT count(*) FROM events WHERE user_id = path) END")} AS md
FROM fields WHERE pos % 6 = 3 OR pos % 6 = 1 AND path % 4 > 0""")
def resolve_fields(spark, sf):
    return P.resolve_fields(V.fields(spark, sf), _field_props(spark, sf))


@query("seq_numbers", views("fields") + """SELECT path, pos, string_split(instr, ' ')[2] AS name, row_number() OVER (PARTITION BY path, instr ORDER BY pos) AS number
FROM fields WHERE pos % 6 = 0""")
def seq_numbers(spark, sf):
    return P.seq_numbers(V.fields(spark, sf), block_rows=4096)


_FORMATS = ["dd.MM.yyyy", "dddd, d MMMM yyyy", "ddd d/M yy", "h:mm am/pm", "'Day' dd \"of\" MMM", "HH:mm:ss yyyyy", "y-MM tt"]
_SHOWN = """CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 1 THEN strftime(o_orderdate, '%A, %-d %B %Y') WHEN 2 THEN strftime(o_orderdate, '%a %-d/%-m %y')
  WHEN 3 THEN strftime(o_orderdate, '%-I:%M %p') WHEN 4 THEN strftime(o_orderdate, 'Day %d of %b') WHEN 5 THEN strftime(o_orderdate, '%H:%M:%S 0%Y') ELSE year(o_orderdate) % 100 || strftime(o_orderdate, '-%m %p') END"""


@query("date_fields", views("fields") + f"""SELECT f.path, pos, {_escaped("strftime(c, '%Y-%m-%d %H:%M')")} AS md FROM fields f JOIN (SELECT user_id AS path, min(ts) AS c FROM events GROUP BY 1) USING (path) WHERE pos % 6 = 2
UNION ALL SELECT 0, o_orderkey, {_escaped(_SHOWN)} FROM orders""")
def date_fields(spark, sf):
    now = F.lit("2024-01-01 00:00:00")
    dated = P.date_fields(V.fields(spark, sf), _field_props(spark, sf), now)
    plain = V.table(spark, sf, "orders").select(
        F.lit(0).cast("long").alias("path"), F.col("o_orderkey").alias("pos"),
        FF.date_text(F.col("o_orderdate"), V.pick(F.col("o_orderkey"), _FORMATS)).alias("md"),
    )
    return dated.unionByName(plain)


_TYPE = """CASE tag WHEN 'text' THEN 'String' WHEN 'checkBox' THEN 'Boolean' WHEN 'comboBox' THEN 'StringWithOptions' WHEN 'dropDownList' THEN 'ListOfOptions'
  WHEN 'date' THEN 'Date' WHEN 'time' THEN 'Time' WHEN 'number' THEN 'Number' END"""
_VALUE = "CASE WHEN tag = 'checkBox' THEN CAST(checked AS VARCHAR) WHEN default_value IS NOT NULL THEN default_value ELSE shown END"


@query("control_type", views("controls") + f"SELECT path, pos, tag, {_TYPE} AS ptype FROM controls")
def control_type(spark, sf):
    return V.controls(spark, sf).select("path", "pos", "tag", FF.control_type("tag").alias("ptype"))


@query("control_value", views("controls") + f"SELECT path, pos, {_TYPE} AS ptype, {_VALUE} AS value FROM controls WHERE tag <> 'calculated'")
def control_value(spark, sf):
    return P.control_parameters(V.controls(spark, sf)).select("path", "pos", "ptype", "value")


@query("control_options", views("items") + "SELECT path, pos, alias, i, value, display FROM items")
def control_options(spark, sf):
    return P.control_options(V.controls(spark, sf))


_META = views("controls", "items") + f""", kv AS (SELECT path, 0 AS rank, pos, 0 AS g, alias AS k, {_VALUE} AS v FROM controls WHERE tag <> 'calculated'
UNION ALL SELECT path, 0, pos, 1, alias || ' Type', {_TYPE} FROM controls WHERE tag <> 'calculated'
UNION ALL SELECT path, 1, pos, 0, alias || ' MaxLen', CAST(max_len AS VARCHAR) FROM controls WHERE tag <> 'calculated' AND max_len IS NOT NULL
UNION ALL SELECT path, 1, pos, i * 2, alias || ' Item' || i || ' Value', value FROM items
UNION ALL SELECT path, 1, pos, i * 2 + 1, alias || ' Item' || i || ' Display', display FROM items),
split AS (SELECT path, rank, pos, g, k, unnest(string_split(v, chr(10))) AS l, unnest(range(len(string_split(v, chr(10))))) AS j FROM kv),
meta AS (SELECT path, rank, pos, CAST(row_number() OVER (PARTITION BY path, rank, pos ORDER BY g, j) - 1 AS INTEGER) AS line, k, l, k || ': ' || l AS text FROM split)
"""


@query("metadata_lines", _META + "SELECT path, rank, pos, line, text FROM meta")
def metadata_lines(spark, sf):
    return P.metadata_lines(V.controls(spark, sf))


def forms(spark, sf):
    """V7: the header of each form of 40 controls, and a body with placeholders."""
    controls = V.controls(spark, sf)
    lines = P.metadata_lines(controls).select(
        "path", F.struct("rank", "pos", "line", "text").alias("x")
    )
    marks = P.control_parameters(controls).select(
        "path",
        F.struct(F.lit(2).alias("rank"), "pos", F.lit(0).alias("line"), FF.placeholder("alias").alias("text")).alias("x"),
    )

    def joined(rank_test, sep):
        chosen = F.filter("x", rank_test)
        return F.array_join(F.transform(F.sort_array(chosen), lambda e: e["text"]), sep)

    # a form is built from 40 parts
    return lines.unionByName(marks).groupBy("path").agg(F.collect_list("x").alias("x")).select(
        "path",
        F.concat(
            joined(lambda e: e["rank"] < 2, "\n"), F.lit("\n\n\nForm text: "), joined(lambda e: e["rank"] == 2, " and ")
        ).alias("md"),
    )


_FORMS = _META + """, marks AS (SELECT path, string_agg('[%' || alias || ']', ' and ' ORDER BY pos) AS m FROM controls WHERE tag <> 'calculated' GROUP BY path),
heads AS (SELECT path, string_agg(text, chr(10) ORDER BY rank, pos, line) AS h FROM meta GROUP BY path)
"""


@query("placeholders", views("controls") + "SELECT path, pos, '[%' || alias || ']' AS mark, alias AS name FROM controls WHERE tag <> 'calculated'")
def placeholders(spark, sf):
    found = forms(spark, sf).select("path", F.explode(FF.placeholders("md")).alias("name"))
    return found.select(
        "path", (F.regexp_extract("name", r"(\d+)", 1).cast("long") + F.col("name").endswith("Extra").cast("long")).alias("pos"),
        FF.placeholder("name").alias("mark"), "name",
    )


@query("split_header", _FORMS + "SELECT path, h AS header, 'Form text: ' || m AS body FROM heads JOIN marks USING (path)")
def split_header(spark, sf):
    return forms(spark, sf).select("path", FF.split_header("md").alias("s")).select("path", "s.*")


_PAIRS = _META + """, numbered AS (SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY rank, pos, line) - 1 AS INTEGER) AS pos, k AS key, trim(l) AS value FROM meta)
"""


@query("header_pairs", _PAIRS + "SELECT path, pos, key, value FROM numbered")
def header_pairs(spark, sf):
    return P.header_pairs(forms(spark, sf))


_BOUND = _PAIRS + """, bound AS (SELECT n.path, n.pos, n.key, n.value, coalesce(b.name, n.key) AS name, CASE WHEN b.name IS NOT NULL THEN ltrim(substr(n.key, length(b.name) + 2)) END AS suffix
  FROM numbered n LEFT JOIN (SELECT k.path, k.key, arg_min(e.key, e.first) AS name FROM (SELECT path, key, min(pos) AS first FROM numbered GROUP BY ALL) k
    JOIN (SELECT path, key, min(pos) AS first FROM numbered GROUP BY ALL) e ON e.path = k.path AND e.first < k.first AND starts_with(k.key, e.key || ' ') GROUP BY ALL) b
  ON b.path = n.path AND b.key = n.key)
"""


@query("bind_attributes", _BOUND + "SELECT path, pos, key, value, name, suffix FROM bound")
def bind_attributes(spark, sf):
    return P.bound_lines(forms(spark, sf))


_TYPED = _BOUND + """, typed AS (SELECT path, name, coalesce(arg_max(value, pos) FILTER (WHERE suffix = 'Type'), 'String') AS type,
  CAST(arg_max(value, pos) FILTER (WHERE suffix = 'MaxLen') AS INTEGER) AS max_len FROM bound GROUP BY ALL)
"""


@query("typed_attributes", _TYPED + "SELECT path, name, type, max_len FROM typed")
def typed_attributes(spark, sf):
    return P.typed_attributes(P.bound_lines(forms(spark, sf)))


_OPTS = """, opts AS (SELECT path, name, i, arg_max(value, pos) FILTER (WHERE f = 'Value') AS v, arg_max(value, pos) FILTER (WHERE f = 'Display') AS d
  FROM (SELECT *, CAST(regexp_extract(suffix, '^Item([0-9]+) (Value|Display)$', 1) AS INTEGER) AS i, regexp_extract(suffix, '^Item([0-9]+) (Value|Display)$', 2) AS f
    FROM bound WHERE regexp_matches(suffix, '^Item([0-9]+) (Value|Display)$')) GROUP BY ALL)
"""


@query("options_array", _BOUND + _OPTS + """SELECT path, name, max(i) AS n, string_agg(v || '=' || d, ';' ORDER BY i) AS options FROM opts GROUP BY ALL""")
def options_array(spark, sf):
    bound = P.bound_lines(forms(spark, sf))
    text = F.transform("options", lambda o: F.concat(o["value"], F.lit("="), o["display"]))
    return P.options_array(P.option_rows(bound)).select(
        "path", "name", F.size("options").alias("n"), F.array_join(text, ";").alias("options")
    )


_OTHER = "suffix NOT IN ('Type', 'MaxLen') AND NOT regexp_matches(suffix, '^Item([0-9]+) (Value|Display)$')"


@query("properties_map", _BOUND + f"SELECT path, name, suffix, string_agg(value, '|' ORDER BY pos) AS vals FROM bound WHERE {_OTHER} GROUP BY ALL")
def properties_map(spark, sf):
    bound = P.bound_lines(forms(spark, sf))
    return P.properties_map(bound).select("path", "name", F.explode("properties").alias("suffix", "v")).select(
        "path", "name", "suffix", F.array_join("v", "|").alias("vals")
    )


@query("parameters", _TYPED + _OPTS + f"""SELECT b.path, min(b.pos) FILTER (WHERE suffix IS NULL) AS pos, b.name, t.type, t.max_len, string_agg(b.value, '|' ORDER BY b.pos) FILTER (WHERE suffix IS NULL) AS vals,
  (SELECT count(DISTINCT suffix) FROM bound x WHERE x.path = b.path AND x.name = b.name AND {_OTHER}) AS n_properties,
  (SELECT count(*) FROM opts o WHERE o.path = b.path AND o.name = b.name) AS n_options
FROM bound b JOIN typed t ON t.path = b.path AND t.name = b.name GROUP BY b.path, b.name, t.type, t.max_len""")
def parameters(spark, sf):
    out = P.parameters(forms(spark, sf))
    return out.select(
        "path", "pos", "name", "type", "max_len", F.array_join("values", "|").alias("vals"),
        F.coalesce(F.cardinality("properties"), F.lit(0)).cast("long").alias("n_properties"),
        F.coalesce(F.cardinality("options"), F.lit(0)).cast("long").alias("n_options"),
    )


@query("has_parameters", """SELECT doc_id AS path, contains(text, chr(10) || chr(10)) AND regexp_matches(split_part(text, chr(10) || chr(10), 1), '(^|\\n)[^\\n:]+:') AS has_parameters FROM documents""")
def has_parameters(spark, sf):
    return P.has_parameters(V.table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.col("text").alias("md")))
