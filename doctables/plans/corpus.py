"""Queries over many documents, with the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from doctables.functions import fixed, sqlfuncs
from doctables.functions.fields import header_lines as lines_of
from doctables.operators import corpus as K
from doctables.operators import notes as N
from doctables.operators.notes import pack_text
from doctables.plans import views as V
from doctables.plans.markdown import _escaped
from doctables.plans.oracle_views import views
from doctables.plans.spreadsheet import _oa, _width
from doctables.plans.register import registry
from doctables.sources import packages as S

QUERIES, ORACLE, query = registry()


@query("lang_counts", """SELECT source AS path, lang, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY ALL""")
def lang_counts(spark, sf):
    return K.lang_counts(V.lang_runs(spark, sf))


@query("doc_language", """SELECT source AS path, CASE WHEN CAST(source[4:] AS INTEGER) % 3 = 0 THEN 'sv' ELSE arg_max(lang, n * 1000000000 - first) END AS language
FROM (SELECT source, lang, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY ALL) GROUP BY source""")
def doc_language(spark, sf):
    runs = V.lang_runs(spark, sf)
    props = runs.select("path").distinct().select(
        "path", F.lit("Language").alias("name"),
        F.when(F.substring("path", 4, 9).cast("int") % 3 == 0, "sv").otherwise("").alias("value"),
    )
    return K.doc_language(runs, props)


@query("unhandled_census", views("blocks") + """SELECT path, CASE WHEN pos % 2 = 0 THEN '' ELSE 'urn:other#' END || tag AS element, count(*) AS n
FROM blocks WHERE regexp_matches(tag, '^[A-Za-z]') AND (pos % 2 = 1 OR tag NOT IN ('p', 'b', 'br', 'text', 'body', 'title')) GROUP BY ALL""")
def unhandled_census(spark, sf):
    ns = F.when(F.col("pos") % 2 == 0, fixed.WORD_NS).otherwise("urn:other")
    return K.unhandled_census(V.blocks(spark, sf).where(F.col("tag").rlike("^[A-Za-z]")).withColumn("ns", ns), fixed.HANDLED_WORD, fixed.WORD_NS)


@query("unknown_styles", views("paragraphs") + "SELECT DISTINCT path, 'UNKNOWN1' AS style_id FROM paragraphs WHERE style_id = 'Unknown1'")
def unknown_styles(spark, sf):
    return K.unknown_styles(V.paragraphs(spark, sf))


@query("output_name", r"""SELECT page_id, url, CASE WHEN regexp_matches(url, '(?is)^http(.*)://(.*)\.example\.(.*)$') THEN
  'out-' || regexp_extract(url, '(?is)^http(.*)://(.*)\.example\.(.*)$', 1) || '/' || regexp_extract(url, '(?is)^http(.*)://(.*)\.example\.(.*)$', 2) || '.' || regexp_extract(url, '(?is)^http(.*)://(.*)\.example\.(.*)$', 3) || '.md' END AS out
FROM pages""")
def output_name(spark, sf):
    out = K.output_name("url", "HTTP*://*.example.*", "out-*/*.*.md")
    return V.table(spark, sf, "pages").select("page_id", "url", out.alias("out"))


@query("output_path", r"""SELECT page_id, regexp_replace(url, '\.[^./]*$', '') || '.md' AS beside,
  '/out/' || regexp_replace(CASE WHEN starts_with(url, 'https://') THEN url[9:] ELSE url END, '\.[^./]*$', '') || '.md' AS below FROM pages""")
def output_path(spark, sf):
    return V.table(spark, sf, "pages").select(
        "page_id", K.output_path("url", "").alias("beside"), K.output_path("url", "https://", "/out").alias("below")
    )


_INJECTED = views("props") + """, inj AS (SELECT path, 0 AS rank, 0 AS pos, 'Title: Given' || chr(10) AS text FROM (SELECT DISTINCT path FROM props)
UNION ALL SELECT path, 0, 1, 'Note: a' || chr(10) FROM (SELECT DISTINCT path FROM props) UNION ALL SELECT path, 0, 2, 'Note: b' || chr(10) FROM (SELECT DISTINCT path FROM props)
UNION ALL SELECT path, 1, unnest([0, 1]), unnest(['Category: ' || string_split(value, chr(13))[1] || chr(10), 'Category: ' || string_split(value, chr(10))[2] || chr(10)]) FROM props WHERE name = 'Category'
UNION ALL SELECT path, 2, 0, 'Language: ' || value || chr(10) FROM props WHERE name = 'Language'
UNION ALL SELECT path, 5, 0, 'Subject: ' || value || chr(10) FROM props WHERE name = 'Subject'
UNION ALL SELECT path, 6, 0, 'Author: ' || value || chr(10) FROM props WHERE name = 'Creator')
"""


@query("inject_headers", _INJECTED + "SELECT path, CAST(0 AS BIGINT) AS part, string_agg(text, '' ORDER BY rank, pos) || chr(10) AS text FROM inj GROUP BY path")
def inject_headers(spark, sf):
    return K.header_text(K.inject_headers(V.props(spark, sf), {"Title": "Given", "Note": "a\r\n\r\nb"}))


@query("header_lines", """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS line, 'Description: ' || l AS text FROM
  (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS i FROM (SELECT doc_id, trim(text, ' ' || chr(10)) AS t FROM documents)) WHERE l <> ''""")
def header_lines(spark, sf):
    return V.table(spark, sf, "documents").select(
        "doc_id", F.posexplode(lines_of(F.lit("Description"), "text")).alias("line", "text")
    )


@query("outcome", """SELECT source, converted, failed, CASE WHEN converted = 0 AND failed = 0 THEN 'No files processed.' WHEN converted = 0 AND failed = 1 THEN 'File not converted.'
  WHEN converted = 0 THEN failed || ' files found, bot not converted.' WHEN failed = 0 AND converted = 1 THEN 'File converted.' WHEN failed = 0 THEN converted || ' files converted.'
  ELSE (converted + failed) || ' file(s) found, ' || converted || ' where converted, ' || failed || ' where not converted.' END AS message
FROM (SELECT source || CASE WHEN d.doc_id % 100 < 20 THEN '' ELSE '-' || lang END AS source, count(l.doc_id) AS converted, count(*) - count(l.doc_id) AS failed
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1)""")
def outcome(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "source", "lang")
    labels = V.table(spark, sf, "labels").select("doc_id", F.lit(True).alias("done"))
    group = F.concat("source", F.when(F.col("doc_id") % 100 < 20, "").otherwise(F.concat(F.lit("-"), "lang")))
    files = docs.join(labels, "doc_id", "left").withColumn("source", group)
    return K.outcome(files, F.coalesce("done", F.lit(False)), ["source"])


@query("row_diff", """WITH l AS (SELECT source AS path, doc_id % 2 AS side, unnest(string_split(text, chr(10))) AS line FROM documents),
n AS (SELECT path, line, sum(CASE side WHEN 1 THEN 1 ELSE -1 END) AS d FROM l GROUP BY ALL)
SELECT path, line, CASE WHEN d > 0 THEN 'added' ELSE 'removed' END AS change, CAST(abs(d) AS BIGINT) AS n FROM n WHERE d <> 0""")
def row_diff(spark, sf):
    lines = V.table(spark, sf, "documents").select(
        F.col("source").alias("path"), (F.col("doc_id") % 2).alias("side"), F.explode(F.split("text", "\n", -1)).alias("line")
    )
    return K.row_diff(lines.where("side = 0"), lines.where("side = 1"))


@query("sql_functions", views("fields") + rf"""SELECT e.event_id, chr(CAST(65 + e.user_id % 26 AS INTEGER)) AS letter, {_oa('e.ts')} AS days, {_width('e.props')} AS width,
  {_escaped('e.props')} AS md, CASE WHEN e.event_id % 6 <> 5 THEN upper(regexp_extract(instr, '\w+')) END AS command, CAST(e.user_id % 26 + 1 AS INTEGER) AS back,
  chr(CAST(65 + e.user_id % 26 AS INTEGER)) || e.event_id AS ref, date_trunc('milliseconds', e.ts) AS ts_back
FROM events e JOIN fields f ON f.pos = e.event_id""")
def sql_functions(spark, sf):
    sqlfuncs.register(spark)
    V.table(spark, sf, "events").join(
        V.fields(spark, sf).select(F.col("pos").alias("event_id"), "instr"), "event_id"
    ).createOrReplaceTempView("doctables_events")
    return spark.sql(
        "SELECT event_id, cell_col_name(user_id % 26 + 1) AS letter, cell_to_days(ts) AS days, cell_text_width(props) AS width, "
        "md_escape(props) AS md, field_command(instr) AS command, "
        "cell_parse_ref(concat(cell_col_name(user_id % 26 + 1), '7')).col AS back, "
        "cell_ref(user_id % 26 + 1, event_id) AS ref, cell_from_days(cell_to_days(ts)) AS ts_back FROM doctables_events"
    )


@query("kind_of", """SELECT page_id, CASE WHEN page_id % 5 = 1 THEN 'docx' WHEN page_id % 5 IN (2, 4) THEN 'xlsx' END AS kind FROM pages""")
def kind_of(spark, sf):
    n = F.col("page_id") % 5
    name = (
        F.when(n == 1, F.concat("url", F.lit(".DocX")))
        .when(n == 2, F.concat("url", F.lit(".xlsx")))
        .when(n == 3, F.concat("url", F.lit(".doc")))
        .when(n == 4, F.upper(F.lit(fixed.CONTENT_TYPES["xlsx"])))
        .otherwise(F.concat("url", F.lit("/docx")))
    )
    return V.table(spark, sf, "pages").select("page_id", S.kind_of(name).alias("kind"))


@query("classify_input", """SELECT doc_id AS path, CASE WHEN doc_id % 11 = 0 THEN 'no content' WHEN doc_id % 7 = 0 THEN 'decode error' WHEN doc_id % 3 <> 0 THEN 'not the expected kind' END AS reason FROM documents""")
def classify_input(spark, sf):
    files = V.table(spark, sf, "documents").select(
        F.col("doc_id").alias("path"),
        F.when(F.col("doc_id") % 11 == 0, 0).otherwise(F.col("n_chars")).alias("length"),
        F.when(F.col("doc_id") % 7 == 0, "bad zip").alias("error"),
        V.pick(F.col("doc_id"), ["docx", "xlsx", None]).alias("kind"),
    )
    return files.select("path", S.classify_input("length", "error", "kind", "docx").alias("reason"))


@query("write_markdown", views("blocks") + rf"""SELECT '/out/' || regexp_replace(p.url, '\.[^./]*$', '') || '.md' AS out_path, CAST({N.BODY} AS BIGINT) * 1125899906842624 + CAST(b.pos AS BIGINT) // 16384 + 1 AS part, string_agg(b.text || chr(10) || chr(10), '' ORDER BY b.pos) AS text
FROM blocks b JOIN pages p ON p.page_id = b.path GROUP BY p.page_id, p.url, CAST(b.pos AS BIGINT) // 16384""")
def write_markdown(spark, sf):
    blocks = V.blocks(spark, sf).select("path", F.lit(N.BODY).alias("rank"), "pos", F.concat("text", F.lit("\n\n")).alias("text"))
    urls = V.table(spark, sf, "pages").select(F.col("page_id").alias("path"), "url")
    return S.markdown_files(pack_text(blocks, ["path"]).join(urls, "path").drop("path").withColumnRenamed("url", "path"), "", "/out")
