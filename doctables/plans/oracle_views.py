"""DuckDB text of the derived views in ``views``."""

from __future__ import annotations


def pick(n: str, values: list) -> str:
    cases = " ".join(
        f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None
    )
    return f"CASE CAST(({n}) % {len(values)} AS INTEGER) {cases} END"


def views(*names: str) -> str:
    """WITH clause holding the named views and what they need, in order."""
    wanted: list[str] = []

    def add(name: str) -> None:
        if name in wanted:
            return
        needs, _ = VIEWS[name]
        for need in needs:
            add(need)
        wanted.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in wanted) + "\n"


_LINES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINE_TEXT = " ".join(
    f"WHEN {i + 1} THEN " + ("strftime(l_shipdate, '%Y-%m-%d')" if c == "l_shipdate" else f"CAST({c} AS VARCHAR)")
    for i, c in enumerate(_LINES)
)
_STYLES = ["Heading1", "heading 2", "Rubrik 3", "Titre4", "Title", "Quote", "ListParagraph",
           "Caption", "Normal", "Unknown1", None, None]
_ALIGNS = ["left", "start", "center", "right", "both", None]
_UNDER = [None] * 8 + ["single", "double", "wave", "thick", "none"]
_HREF = '<a href="([^"]*)"'

VIEWS: dict[str, tuple[list[str], str]] = {
    "cells": ([], f"""
SELECT path, sheet_no, "row", col, CASE shape WHEN 0 THEN "row" || letter WHEN 1 THEN '$' || letter || "row"
  WHEN 2 THEN lower(letter) || "row" ELSE letter || "row" END AS ref, t, raw
FROM (SELECT 'wb' || (o_orderkey // 1000) AS path, CAST((o_orderkey // 200) % 5 AS INTEGER) AS sheet_no,
  CAST(1 + o_orderkey % 200 AS INTEGER) AS "row", c.col, o_orderkey % 50 AS shape, chr(64 + c.col) AS letter,
  CASE c.col WHEN 1 THEN 'n' WHEN 2 THEN 'str' WHEN 3 THEN 'n' WHEN 4 THEN 'd' WHEN 5 THEN 's' WHEN 6 THEN 'b' END AS t,
  CASE c.col WHEN 1 THEN CAST(o_orderkey AS VARCHAR) WHEN 2 THEN o_orderstatus WHEN 3 THEN CAST(o_totalprice AS VARCHAR)
    WHEN 4 THEN CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN CAST(20000 + o_orderkey % 20000 AS VARCHAR)
      WHEN 3 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T10:20:30' END
    WHEN 5 THEN CASE o_orderkey % 10 WHEN 0 THEN '99' WHEN 1 THEN 'x'
      ELSE CAST(CAST(o_orderpriority[1] AS INTEGER) - 1 AS VARCHAR) END
    WHEN 6 THEN CASE o_orderkey % 3 WHEN 0 THEN '1' WHEN 1 THEN 'FALSE' ELSE 'maybe' END
    ELSE {pick('o_orderkey', ['1e3', ' 12 ', 'TRUE', 'yes', 'NaN', '', '-7.25', 'text'])} END AS raw
  FROM orders, (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS col) c)"""),
    "sheets": ([], f"""
SELECT 'wb' || book AS path, sheet_no, 'Sheet ' || (sheet_no + 1) AS sheet_name,
  {pick('book + sheet_no', [None, 'A1', 'A1:G200', 'B3:F150'])} AS dim_ref
FROM (SELECT DISTINCT o_orderkey // 1000 AS book, CAST((o_orderkey // 200) % 5 AS INTEGER) AS sheet_no FROM orders)"""),
    "shared_strings": ([], """
SELECT DISTINCT 'wb' || (o_orderkey // 1000) AS path,
  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS idx, o_orderpriority AS text FROM orders"""),
    "cells_hot": ([], f"""
SELECT path, 0 AS sheet_no, CAST("row" AS INTEGER) AS "row", col, chr(64 + col) || "row" AS ref,
  CASE WHEN col <= 8 THEN 'n' ELSE 'str' END AS t, CASE col {_LINE_TEXT} END AS raw
FROM (SELECT *, 'wb' || (l_suppkey % 16) AS path, row_number() OVER (PARTITION BY l_suppkey % 16
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS "row" FROM lineitem),
  (SELECT CAST(unnest(range(1, 12)) AS INTEGER) AS col) c
WHERE ("row" + col) % 3 <> 0 AND "row" % 7 <> 3"""),
    "paragraphs": ([], f"""
SELECT doc_id AS path, pos, text, n, {pick('n', _STYLES)} AS style_id, {pick('n', _ALIGNS)} AS jc,
  CASE WHEN n % 4 <> 3 THEN CAST(1 + n % 2 AS INTEGER) END AS num_id, CAST(n % 3 AS INTEGER) AS ilvl,
  n % 11 = 0 AS border, CASE WHEN n % 13 = 0 THEN CAST(1 + n % 3 AS INTEGER) END AS break_cols, n % 9 = 0 AS mono
FROM (SELECT doc_id, CAST(pos AS INTEGER) AS pos, text, doc_id * 7 + pos * 3 AS n FROM
  (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS text FROM
    (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))"""),
    "runs": (["paragraphs"], f"""
SELECT path, para_pos, run_pos, CASE WHEN run_pos > 0 THEN ' ' || word ELSE word END AS text,
  k % 5 = 0 AS bold, k % 7 = 0 AS italic, {pick('k', _UNDER)} AS underline, k % 37 = 0 AS strike,
  k % 41 = 0 AS dstrike, CASE k % 17 WHEN 0 THEN 'superscript' WHEN 1 THEN 'subscript' END AS vert,
  k % 19 = 0 AS mono, k % 23 = 0 AS ins, k % 29 = 0 AS del, CASE WHEN k % 31 = 0 THEN 'r' || (k % 10) END AS link_id
FROM (SELECT path, para_pos, CAST(run_pos AS INTEGER) AS run_pos, word, n + run_pos AS k FROM
  (SELECT path, pos AS para_pos, n, unnest(range(len(w))) AS run_pos, unnest(w) AS word FROM
    (SELECT *, string_split(text, ' ') AS w FROM paragraphs)))"""),
    "blocks": ([], r"""
SELECT * FROM (SELECT path, CAST(pos AS INTEGER) AS pos,
    CASE WHEN pos = 0 OR gt = 0 THEN 'text' WHEN name = '' THEN '!' ELSE name END AS tag,
    CASE WHEN pos = 0 THEN piece WHEN gt = 0 THEN '<' || piece ELSE substr(piece, gt + 1) END AS text
  FROM (SELECT *, strpos(piece, '>') AS gt, regexp_extract(piece, '^/?[A-Za-z][A-Za-z0-9]*') AS name FROM
    (SELECT page_id AS path, unnest(range(len(l))) AS pos, unnest(l) AS piece FROM (SELECT page_id, string_split(html, '<') AS l FROM pages))))
WHERE text <> '' OR tag IN ('h1', 'p', 'li', 'a', 'br', 'b', 'nav')"""),
    "anchors": ([], f"""
SELECT page_id AS path, 'r' || i AS rel_id, target FROM
  (SELECT page_id, unnest(range(len(a))) AS i, unnest(a) AS target FROM
    (SELECT page_id, regexp_extract_all(html, '{_HREF}', 1) AS a FROM pages))"""),
    "table_cells": (["paragraphs"], """
SELECT path, 0 AS tbl, CAST(pos // 4 AS INTEGER) AS "row", CAST(pos % 4 AS INTEGER) AS cell_no,
  CASE WHEN n % 10 = 0 THEN 2 ELSE 1 END AS span, pos // 4 = 0 AND path % 2 = 0 AS header_flag,
  pos // 4 = 0 AND path % 3 = 0 AS first_row, jc, CASE WHEN n % 15 = 0 THEN text || chr(10) || 'more' ELSE text END AS md
FROM paragraphs"""),
    "numbering": ([], """
SELECT doc_id AS path, num_id, num_id * 10 AS abstract_id FROM documents, (SELECT unnest([1, 2]) AS num_id)"""),
    "levels": ([], """
SELECT doc_id AS path, v.* FROM documents, (VALUES (10, 0, 'decimal', 1), (10, 1, 'lowerLetter', 1), (10, 2, 'decimal', 1),
  (20, 0, 'bullet', 5), (20, 1, 'none', 5), (20, 2, 'decimal', 5)) v(abstract_id, ilvl, fmt, start)"""),
    "controls": ([], f"""
SELECT 'form' || (p_partkey // 40) AS path, p_partkey AS pos,
  CASE WHEN p_partkey % 9 = 4 THEN 'Part ' || (p_partkey - 1) || ' Extra' ELSE 'Part ' || p_partkey END AS alias, tag,
  CASE WHEN tag = 'checkBox' THEN p_partkey % 3 = 0 END AS checked,
  CASE WHEN p_partkey % 3 = 0 THEN p_name END AS default_value,
  CASE WHEN p_partkey % 10 = 7 THEN p_type || chr(10) || p_brand ELSE p_type END AS shown,
  CASE WHEN p_partkey % 4 = 0 THEN p_size END AS max_len, p_brand, p_type, p_size, p_name
FROM (SELECT *, {pick('p_size % 8', ['text', 'checkBox', 'comboBox', 'dropDownList', 'date', 'time', 'number', 'calculated'])} AS tag FROM part)"""),
    "items": (["controls"], """
SELECT path, pos, alias, tag, i, value, display FROM (
  SELECT *, 1 AS i, p_brand AS value, 'Brand ' || p_brand AS display FROM controls UNION ALL
  SELECT *, 2, CAST(p_size AS VARCHAR), p_name FROM controls) WHERE tag IN ('comboBox', 'dropDownList')"""),
    "fields": ([], r"""
SELECT user_id AS path, event_id AS pos, CASE event_id % 6 WHEN 0 THEN 'SEQ ' || event_type || ' \* ARABIC' WHEN 1 THEN ' AUTHOR '
  WHEN 2 THEN 'CREATEDATE \@ yyyy-MM-dd HH:mm' WHEN 3 THEN 'title' WHEN 4 THEN 'PAGE' ELSE 'SAVEDATE a b \@ yyyy' END AS instr, ts
FROM events"""),
    "props": ([], """
SELECT path, name, value FROM (
  SELECT c_custkey AS path, 'Title' AS name, c_name AS value FROM customer UNION ALL
  SELECT c_custkey, 'Subject', c_mktsegment FROM customer UNION ALL
  SELECT c_custkey, 'Category', n_name || chr(13) || chr(10) || c_mktsegment FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey UNION ALL
  SELECT c_custkey, 'Language', CASE WHEN c_custkey % 3 <> 0 THEN 'en-GB' END FROM customer UNION ALL
  SELECT c_custkey, 'Creator', 'Clerk ' || (c_custkey % 7) FROM customer) WHERE value IS NOT NULL"""),
    "notes": ([], """
SELECT source AS path, CASE WHEN doc_id % 2 = 0 THEN 'fn' ELSE 'en' END AS kind, doc_id AS id, text AS md FROM documents"""),
    "note_refs": ([], """
SELECT source AS path, CASE WHEN doc_id % 2 = 0 THEN 'fn' ELSE 'en' END AS kind,
  CASE WHEN doc_id % 10 = 9 THEN -doc_id ELSE doc_id END AS id, doc_id AS pos FROM labels JOIN documents USING (doc_id)"""),
    "marks": ([], """
SELECT user_id AS path, event_id AS pos, CASE WHEN event_type IN ('view', 'purchase') THEN 'image'
  WHEN event_type = 'click' THEN 'caption' ELSE 'other' END AS kind, 'evt ' || event_id AS text FROM events"""),
    "bookmark_runs": ([], f"""
SELECT conv_id AS path, turn AS pos, {pick('conv_id + turn', ['start', 'text', 'field', 'text', 'end', 'start', 'text', 'end', 'text'])} AS kind, text
FROM conversations"""),
    "lang_runs": ([], """
SELECT source AS path, doc_id AS pos, CASE WHEN doc_id % 2 = 0 THEN lang || '-X1' ELSE lang END AS tag FROM documents"""),
}
