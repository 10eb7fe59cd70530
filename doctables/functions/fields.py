"""Column expressions for fields, form controls and header lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from doctables.functions import fixed
from doctables.functions.cells import unify_lines
from doctables.functions.text import md_escape

# a field instruction is words: its command, arguments (plain or quoted) and switches, each a backslash and one character
FIELD_WORD = r'"(?:[^"\\]|\\.)*"|\\[^\s"]|[^\s"\\]+'
FIELD_COMMAND = r"^\s*(\w+)(?![^\s\"\\])"
# switches that give a format: of dates, numbers, texts
FORMAT_SWITCHES = ("@", "#", "*")
# a date format is read in tokens: quoted text, AM/PM, runs of one letter, an escaped character, any other character
DATE_TOKEN = r"""'[^']*'|"[^"]*"|(?i:am/pm)|tt?|d+|M+|y+|H+|h+|m+|s+|\\[\s\S]|[\s\S]"""
DEFAULT_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
PLACEHOLDER = r"\[%([^\]]+)\]"
OPTION = r"^Item\s*([+-]?[0-9]+) (Value|Display)\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(s: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(_col(s), r"^\s+|\s+\z", "")


def parse_field(instr: Column | str) -> Column:
    """Field instruction as struct(command, argument, switch, format); null if it is not a command with at most one
    argument ahead of its switches.

    The argument is the word right after the command, without quotes; empty if a switch
    stands there. Of the switches that give a format, dates' go before numbers' and those
    before texts'; the format is all up to the next switch, without quotes.
    """
    words = F.regexp_extract_all(_col(instr), F.lit(FIELD_WORD), F.lit(0))

    def is_switch(word: Column) -> Column:
        return word.startswith("\\")

    def plain(word: Column) -> Column:
        quoted = word.startswith('"')
        return F.when(quoted, F.regexp_replace(F.substr(word, F.lit(2), F.length(word) - 2), r"\\(.)", "$1")).otherwise(word)

    def after(switch: str) -> Column:
        """Words behind the first such switch, up to the next one; null without it."""
        at = F.array_position(words, "\\" + switch)
        rest = F.slice(words, at + 1, F.size(words))
        stop = F.array_min(F.filter(F.transform(rest, lambda w, i: F.when(is_switch(w), i)), lambda i: i.isNotNull()))
        return F.when(at > 0, F.array_join(F.transform(F.slice(rest, F.lit(1), F.coalesce(stop, F.size(rest))), plain), " "))

    first, second, third = (F.get(words, F.lit(i)) for i in range(3))
    switch = F.coalesce(*[F.when(F.array_contains(words, "\\" + x), x) for x in FORMAT_SWITCHES], F.lit(""))
    return F.when(
        _col(instr).rlike(FIELD_COMMAND) & (second.isNull() | is_switch(second) | third.isNull() | is_switch(third)),
        F.struct(
            F.upper(first).alias("command"),
            F.when(second.isNull() | is_switch(second), "").otherwise(plain(second)).alias("argument"),
            switch.alias("switch"),
            F.coalesce(*[after(x) for x in FORMAT_SWITCHES], F.lit("")).alias("format"),
        ),
    )


def _lookup(key: Column, mapping: dict) -> Column:
    out = F.lit(None).cast("string")
    for name, value in mapping.items():
        if value is not None:
            out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def field_property(command: Column | str) -> Column:
    """Package property a field command shows as text."""
    return _lookup(_col(command), fixed.PROPERTY_FIELDS)


def field_date_property(command: Column | str) -> Column:
    """Package property a date field shows; null for the fields that show the clock."""
    return _lookup(_col(command), fixed.DATE_FIELDS)


def _date_token(ts: Column, token: Column) -> Column:
    """What one token of a date format shows; text that is no token stands for itself."""
    size, letter = F.length(token), F.substring(token, 1, 1)

    def shown(pattern: str) -> Column:
        return F.date_format(ts, pattern)

    year = F.year(ts).cast("string")
    out = F.when(letter.isin("'", '"') & (size > 1), F.substr(token, F.lit(2), size - 2))
    out = out.when((letter == "\\") & (size == 2), F.substring(token, 2, 1))
    out = out.when((token == "tt") | (F.lower(token) == "am/pm"), shown("a")).when(token == "t", F.substring(shown("a"), 1, 1))
    out = out.when(token == "y", (F.year(ts) % 100).cast("string")).when(token == "yy", shown("yy"))
    out = out.when(letter == "y", F.lpad(year, F.greatest(size, F.length(year)), F.lit("0")))
    for one in "dM":
        out = out.when(token == one, shown(one)).when(token == one * 2, shown(one * 2))
    for one, short, full in (("d", "EEE", "EEEE"), ("M", "MMM", "MMMM")):
        out = out.when(token == one * 3, shown(short)).when(letter == one, shown(full))
    for one in "Hhms":
        out = out.when(token == one, shown(one)).when(letter == one, shown(one * 2))
    return out.otherwise(token)


def date_text(ts: Column, pattern: Column) -> Column:
    """Date in a field's own format, or the default one where it gives none, escaped for Markdown.

    Formats hold d to dddd (day, weekday), M to MMMM, y to yyyyy, H, h, m, s, AM/PM, quoted and escaped text; other characters stand
    for themselves.
    """
    chosen = F.when(F.length(pattern) > 0, pattern).otherwise(DEFAULT_DATE_FORMAT)
    tokens = F.regexp_extract_all(chosen, F.lit(DATE_TOKEN), F.lit(0))
    return md_escape(F.array_join(F.transform(tokens, lambda token: _date_token(ts, token)), ""))


def control_type(tag: Column | str) -> Column:
    """Parameter type of a form control; null when it is no parameter."""
    return _lookup(_col(tag), fixed.CONTROL_TYPES)


def control_value(ptype: Column, checked: Column, default: Column, shown: Column) -> Column:
    """Checked state of a checkbox, else the default, else the text shown."""
    return (
        F.when((ptype == "Boolean") & checked.isNotNull(), checked.cast("string"))
        .when(F.length(default) > 0, default)
        .otherwise(F.coalesce(shown, F.lit("")))
    )


def key_lines(key: Column, value: Column) -> Column:
    """``key: line`` for every line of a value."""
    return F.transform(
        F.split(unify_lines(trim_all(value)), "\n", -1), lambda line: F.concat(key, F.lit(": "), line)
    )


def header_lines(key: Column | str, value: Column | str) -> Column:
    """``key: line`` for every line of a value that is not empty."""
    key, value = _col(key), _col(value)
    lines = F.filter(F.split(unify_lines(trim_all(value)), "\n", -1), lambda line: line != "")
    return F.transform(lines, lambda line: F.concat(key, F.lit(": "), line))


def placeholder(name: Column | str) -> Column:
    return F.concat(F.lit("[%"), _col(name), F.lit("]"))


def placeholders(md: Column | str) -> Column:
    """Names of the placeholders in a text, in order."""
    return F.regexp_extract_all(_col(md), F.lit(PLACEHOLDER), F.lit(1))


def split_header(md: Column | str) -> Column:
    """Text as struct(header, body). The header ends at the first empty line; null without one."""
    text = unify_lines(md)
    at = F.instr(text, "\n\n")
    return F.when(
        at > 0,
        F.struct(
            F.substring(text, F.lit(1), at - 1).alias("header"),
            F.regexp_replace(F.substr(text, at), r"^\s+", "").alias("body"),
        ),
    )
