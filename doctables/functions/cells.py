"""Column expressions for spreadsheet cells. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doctables.functions.fixed import MAX_DIGIT_WIDTH, NUMBER_WIDTH_LIMIT

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?\z"
BOOLEAN = r"^(?i:true|false|1|0)\z"
INT = r"^[+-]?[0-9]+\z"

_LETTERS = 7  # enough for any 32-bit column number
_OA_MILLIS = 25569 * 86400000  # from 1899-12-30 to 1970-01-01


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- references -----------------------------------------------------------------


def parse_ref(ref: Column | str) -> Column:
    """``B7`` as struct(col, row); null unless there are letters, digits and nothing else.

    Letters and digits may come in any order (``1A`` is column 1, row 1).
    """
    plain = _col(ref).rlike(r"^[A-Za-z0-9]+\z")
    ref = F.upper(_col(ref))
    letters = F.translate(ref, "0123456789", "")
    digits = F.translate(ref, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    number = F.aggregate(
        F.split(letters, ""),
        F.lit(0).cast("long"),
        lambda total, letter: total * 26 + (F.ascii(letter) - 64).cast("long"),
    )
    good = plain & F.length(letters).between(1, _LETTERS)
    at = F.struct(F.when(good, number.try_cast("int")).alias("col"), digits.try_cast("int").alias("row"))
    # as an element of an array it is computed once, not for each look at it
    return F.get(F.filter(F.array(at), lambda x: x["col"].isNotNull() & x["row"].isNotNull()), F.lit(0))


def parse_range(ref: Column | str) -> Column:
    """``A1:D9`` as struct(left, top, right, bottom); null without a colon or a valid end."""
    ref = _col(ref)
    colon = F.instr(ref, ":")
    first = parse_ref(F.substring_index(ref, ":", 1))
    last = parse_ref(F.substr(ref, colon + 1))
    ends = F.filter(F.array(F.struct(first.alias("first"), last.alias("last"))), lambda x: x["first"].isNotNull() & x["last"].isNotNull())
    box = F.transform(ends, lambda x: F.struct(
        x["first"]["col"].alias("left"), x["first"]["row"].alias("top"), x["last"]["col"].alias("right"), x["last"]["row"].alias("bottom"),
    ))
    return F.when(colon > 0, F.get(box, F.lit(0)))


def col_name(n: Column | str) -> Column:
    """Column number to letters: 1 is A, 26 is Z, 27 is AA."""
    n = _col(n).cast("long")
    parts = []
    for k in range(_LETTERS - 1, -1, -1):
        shorter = sum(26**i for i in range(1, k + 1))  # numbers with at most k letters
        index = F.pmod(_div(n - 1 - shorter, 26**k), F.lit(26))
        parts.append(F.when(n > shorter, F.char(index + 65)).otherwise(""))
    return F.concat(*parts)


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("long"))


def cell_ref(col: Column | str, row: Column | str) -> Column:
    return F.concat(col_name(col), _col(row).cast("string"))


# --- reading values ---------------------------------------------------------------


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def to_oadate(ts: Column | str) -> Column:
    """Timestamp to days since 1899-12-30, in whole milliseconds of local clock time."""
    local = _col(ts).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", _epoch(), local)
    millis = _div(micros + _OA_MILLIS * 1000, 1000)
    return millis.cast("double") / F.lit(86400000.0)


def from_oadate(days: Column | str) -> Column:
    """Days since 1899-12-30 to a timestamp without zone, rounded to the millisecond."""
    millis = F.floor(_col(days) * F.lit(86400000.0) + 0.5).cast("long") - _OA_MILLIS
    return F.timestamp_add("MICROSECOND", millis * 1000, _epoch())


def as_number(raw: Column | str) -> Column:
    """Plain decimal or exponent notation; anything else, also padded text, is null."""
    raw = _col(raw)
    return F.when(raw.rlike(NUMBER), raw.try_cast("double"))


def as_boolean(raw: Column | str) -> Column:
    """``true``/``false``/``1``/``0``, any case."""
    raw = _col(raw)
    return F.when(raw.rlike(BOOLEAN), F.lower(raw).isin("true", "1"))


def as_date(raw: Column | str) -> Column:
    """ISO date or date-time text."""
    raw = _col(raw)
    return F.when(raw.rlike(DATE), F.replace(raw, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz"))


def _value(kind, d=None, b=None, ts=None, s=None) -> Column:
    return F.struct(
        kind.alias("kind"),
        (F.lit(None) if d is None else d).cast("double").alias("d"),
        (F.lit(None) if b is None else b).cast("boolean").alias("b"),
        (F.lit(None) if ts is None else ts).cast("timestamp_ntz").alias("ts"),
        (F.lit(None) if s is None else s).cast("string").alias("s"),
    )


def typed_value(t: Column, raw: Column, number: Column, boolean: Column, date: Column) -> Column:
    """Value of a cell from its declared type and the readings of its text (null where it cannot be read so)."""
    when = F.when(t == "d", F.coalesce(date, from_oadate(number)))
    takes_number = ((t == "n") | t.isNull()) & number.isNotNull()
    takes_bool = ((t == "b") | (t.isNull() & number.isNull())) & boolean.isNotNull()
    kind = (
        F.when(takes_number, "number")
        .when(takes_bool, "boolean")
        .when(when.isNotNull(), "date")
        .otherwise("string")
    )
    return _value(
        kind,
        d=F.when(takes_number, number),
        b=F.when(takes_bool, boolean),
        ts=when,
        s=F.when(kind == "string", raw),
    )


def decode_typed(t: Column | str, raw: Column | str) -> Column:
    """Value of a cell from its declared type; text that does not fit stays a string.

    Untyped cells take the first of number, boolean, string. Shared strings are
    resolved by a join before this (see ``resolve_strings``). For whole tables
    ``decode_cells`` reads each text only once.
    """
    t, raw = _col(t), _col(raw)
    return typed_value(t, raw, as_number(raw), as_boolean(raw), as_date(raw))


def infer_value(raw: Column | str) -> Column:
    """Value of an untyped cell: number, else boolean, else string."""
    return decode_typed(F.lit(None).cast("string"), raw)


# --- text of values ---------------------------------------------------------------


def number_text(d: Column | str) -> Column:
    """Shortest text of a double: whole numbers without a point, exponents as ``E+17``/``E-05``.

    Plain notation is kept from 1e-5 up to 1e15.
    """
    d = _col(d).cast("double")
    text = d.cast("string")
    size = F.abs(d)
    whole = (d == F.floor(d)) & (size < 1e15)
    plain = F.rtrim(text.try_cast(T.DecimalType(38, 21)).cast("string"), F.lit("0"))
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    exponent = F.concat(
        mantissa,
        F.when(power < 0, "E-").otherwise("E+"),
        F.when(F.abs(power) < 10, "0").otherwise(""),
        F.abs(power).cast("string"),
    )
    return (
        F.when(whole, d.cast("bigint").cast("string"))
        .when(~text.contains("E"), text)
        .when((size >= 1e-5) & (size < 1e15), plain)
        .otherwise(exponent)
    )


def quote_text(s: Column | str) -> Column:
    """Text as a double-quoted literal."""
    s = _col(s)
    for plain, escaped in [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]:
        s = F.replace(s, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), s, F.lit('"'))


def name_text(s: Column | str) -> Column:
    """Sheet name as it stands between single quotes (JSON escapes)."""
    s = F.coalesce(_col(s), F.lit(""))
    for plain, escaped in [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]:
        s = F.replace(s, F.lit(plain), F.lit(escaped))
    return s


def literal_text(value: Column | str) -> Column:
    """Text of a decoded value in a grid literal.

    Dates are written ``DateTime(y,m,d,h,m,s)``, with milliseconds when there are any.
    """
    value = _col(value)
    ts = value["ts"]
    millis = F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("int") % 1000
    date = F.concat(
        F.lit("DateTime("),
        F.concat_ws(
            ",",
            F.year(ts).cast("string"),
            F.month(ts).cast("string"),
            F.day(ts).cast("string"),
            F.hour(ts).cast("string"),
            F.minute(ts).cast("string"),
            F.second(ts).cast("string"),
            F.when(millis > 0, millis.cast("string")),
        ),
        F.lit(")"),
    )
    return (
        F.when(value["kind"] == "number", number_text(value["d"]))
        .when(value["kind"] == "boolean", value["b"].cast("string"))
        .when(value["kind"] == "date", date)
        .otherwise(quote_text(value["s"]))
    )


# --- writing values ---------------------------------------------------------------


def unify_lines(s: Column | str) -> Column:
    """CRLF and CR line ends as LF."""
    s = F.replace(_col(s), F.lit("\r\n"), F.lit("\n"))
    return F.replace(s, F.lit("\r"), F.lit("\n"))


def longest_line(s: Column | str) -> Column:
    """Longest line, the first of equals. Expects LF line ends."""
    lines = F.split(_col(s), "\n", -1)
    ranked = F.transform(lines, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("x")))
    return F.array_max(ranked)["x"]


def multiline(s: Column | str) -> Column:
    """Text cell as struct(t, text, longest, style).

    Text with a line feed is stored inline with CRLF line ends and wrap style 2;
    its width counts only the longest line. Other text is kept as it is.
    """
    s = _col(s)
    lf = unify_lines(s)
    many = s.contains("\n")
    return F.struct(
        F.when(many, "inlineStr").otherwise("str").alias("t"),
        F.when(many, F.replace(lf, F.lit("\n"), F.lit("\r\n"))).otherwise(s).alias("text"),
        F.when(many, longest_line(lf)).otherwise(s).alias("longest"),
        F.when(many, 2).otherwise(0).alias("style"),
    )


def encode_value(value: Column | str, dtype: T.DataType) -> Column:
    """Stored form of a value as struct(t, value, style, display).

    ``display`` is the text that column widths are measured on. Styles: 0 plain,
    2 wrapped text, 3 date and time (1, the bold header, is set by the header row).
    """
    value = _col(value)

    def cell(t, text, style, display):
        return F.struct(
            F.lit(t).alias("t") if isinstance(t, str) else t.alias("t"),
            text.alias("value"),
            (F.lit(style) if isinstance(style, int) else style).alias("style"),
            display.alias("display"),
        )

    if isinstance(dtype, T.StringType):
        m = multiline(value)
        return cell(m["t"], m["text"], m["style"], m["longest"])
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = number_text(value) if isinstance(dtype, T.DoubleType) else number_text(
            value.cast("string").cast("double")
        )
        return cell("n", text, 0, F.substring(text, 1, NUMBER_WIDTH_LIMIT))
    if isinstance(dtype, T.DecimalType):
        text = value.cast("string")
        return cell("n", text, 0, F.substring(text, 1, NUMBER_WIDTH_LIMIT))
    if isinstance(dtype, T.IntegralType):
        text = value.cast("string")
        return cell("n", text, 0, text)
    if isinstance(dtype, T.BooleanType):
        text = value.cast("string")
        return cell("b", text, 0, text)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        local = value.cast("timestamp_ntz")
        return cell(
            "n", number_text(to_oadate(local)), 3, F.date_format(local, "yyyy-MM-dd HH:mm:ss")
        )
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return cell("str", text, 0, text)


def text_width(text: Column | str) -> Column:
    """Column width that shows the text, in the file format's width unit."""
    digit = F.lit(MAX_DIGIT_WIDTH)
    return F.floor((F.length(_col(text)) * digit + 5) / digit * 256) / 256
