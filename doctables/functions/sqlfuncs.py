"""The rules as SQL functions, for use from ``spark.sql``. Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from doctables.functions import fields, fixed
from doctables.functions.text import _escape_pattern


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _col_name() -> str:
    parts = []
    for k in range(6, -1, -1):
        shorter = sum(26**i for i in range(1, k + 1))
        parts.append(
            f"CASE WHEN n > {shorter} THEN char(65 + (n - 1 - {shorter}) DIV {26**k} % 26) ELSE '' END"
        )
    return "concat(" + ", ".join(parts) + ")"


_LETTERS = "aggregate(split(translate(upper(ref), '0123456789', ''), ''), 0L, (a, c) -> a * 26 + ascii(c) - 64)"
_REF = (
    "CASE WHEN rlike(ref, '^[A-Za-z0-9]+\\\\z') AND length(translate(upper(ref), '0123456789', '')) BETWEEN 1 AND 7 "
    "AND try_cast(translate(upper(ref), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '') AS INT) IS NOT NULL "
    f"AND {_LETTERS} <= 2147483647 THEN named_struct("
    f"'col', int({_LETTERS}), "
    "'row', int(translate(upper(ref), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) END"
)

def _words() -> str:
    return f"regexp_extract_all(instr, {_quoted(fields.FIELD_WORD)}, 0)"


def _plain(word: str) -> str:
    unquoted = f"regexp_replace(substr({word}, 2, length({word}) - 2), {_quoted(chr(92) * 2 + '(.)')}, {_quoted('$1')})"
    return f"IF(startswith({word}, {_quoted(chr(34))}), {unquoted}, {word})"


def _is_field() -> str:
    ends = [f"coalesce(startswith(get({_words()}, {i}), {_quoted(chr(92))}), true)" for i in (1, 2)]
    return f"instr RLIKE {_quoted(fields.FIELD_COMMAND)} AND ({' OR '.join(ends)})"


def _field_argument() -> str:
    second = f"get({_words()}, 1)"
    return f"IF({_is_field()} AND NOT coalesce(startswith({second}, {_quoted(chr(92))}), true), {_plain(second)}, '')"


def _field_format() -> str:
    out = "''"
    for switch in reversed(fields.FORMAT_SWITCHES):
        mark = _quoted(chr(92) + switch)
        rest = f"slice({_words()}, array_position({_words()}, {mark}) + 1, size({_words()}))"
        stops = f"transform({rest}, (x, i) -> IF(startswith(x, {_quoted(chr(92))}), i, NULL))"
        stop = f"coalesce(array_min(filter({stops}, i -> i IS NOT NULL)), size({rest}))"
        text = f"array_join(transform(slice({rest}, 1, {stop}), x -> {_plain('x')}), ' ')"
        out = f"IF(array_contains({_words()}, {mark}), {text}, {out})"
    return out


FUNCTIONS = {
    "cell_col_name(n BIGINT) RETURNS STRING": _col_name(),
    "cell_parse_ref(ref STRING) RETURNS STRUCT<col INT, row INT>": _REF,
    "cell_parse_range(ref STRING) RETURNS STRUCT<first STRUCT<col INT, row INT>, last STRUCT<col INT, row INT>>": (
        "CASE WHEN instr(ref, ':') > 0 AND cell_parse_ref(substring_index(ref, ':', 1)) IS NOT NULL "
        "AND cell_parse_ref(substr(ref, instr(ref, ':') + 1)) IS NOT NULL THEN named_struct("
        "'first', cell_parse_ref(substring_index(ref, ':', 1)), 'last', cell_parse_ref(substr(ref, instr(ref, ':') + 1))) END"
    ),
    "cell_to_days(ts TIMESTAMP_NTZ) RETURNS DOUBLE": (
        "((timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) + 2209161600000000) DIV 1000) / 86400000D"
    ),
    "cell_ref(col BIGINT, nr BIGINT) RETURNS STRING": "concat(cell_col_name(col), string(nr))",
    "cell_from_days(days DOUBLE) RETURNS TIMESTAMP_NTZ": (
        "timestampadd(MICROSECOND, (bigint(floor(days * 86400000D + 0.5D)) - 2209161600000) * 1000, TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    ),
    "cell_text_width(s STRING) RETURNS DOUBLE": (
        f"floor((length(s) * {fixed.MAX_DIGIT_WIDTH}D + 5) / {fixed.MAX_DIGIT_WIDTH}D * 256) / 256"
    ),
    "md_escape(s STRING) RETURNS STRING": f"regexp_replace(s, {_quoted(_escape_pattern())}, {_quoted(chr(92) * 2 + '$1')})",
    "field_command(instr STRING) RETURNS STRING": f"IF({_is_field()}, upper(get({_words()}, 0)), NULL)",
    "field_argument(instr STRING) RETURNS STRING": _field_argument(),
    "field_format(instr STRING) RETURNS STRING": _field_format(),
}


def register(spark: SparkSession) -> None:
    """Create the functions in the session."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
