"""Writing tables as sheets: cells, units, headers and widths in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doctables.functions import cells as C
from doctables.functions import fixed
from doctables.operators.running import row_numbers


def is_quantity(dtype: T.DataType) -> bool:
    """A quantity is struct(magnitude, unit)."""
    return isinstance(dtype, T.StructType) and dtype.fieldNames() == ["magnitude", "unit"]


def col_increments(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns each table column takes: 2 if any row holds a quantity, else 1.

    One aggregate over the data; the result has one row per group and column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    steps = [
        F.max(F.when(F.col(c).isNotNull(), 2).otherwise(1)) if is_quantity(types[c]) else F.lit(1)
        for c in columns
    ]
    each = F.posexplode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"__{i}").alias("incr")) for i, c in enumerate(columns)])
    ).alias("ord", "v")
    return (
        df.groupBy(*keys)
        .agg(*[s.alias(f"__{i}") for i, s in enumerate(steps)])
        .select(*keys, each)
        .select(*keys, "ord", "v.*")
    )


def col_positions(increments: DataFrame, keys: list[str]) -> DataFrame:
    """First sheet column of each table column. A group has one row per table column."""
    earlier = Window.partitionBy(*keys).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return increments.withColumn("start", (1 + F.coalesce(F.sum("incr").over(earlier), F.lit(0))).cast("int"))


def split_units(quantity: Column | str) -> Column:
    """A quantity as an array of struct(shift, t, value): its number and, to the right, its unit."""
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    number = F.struct(
        F.lit(0).alias("shift"), F.lit("n").alias("t"), C.number_text(q["magnitude"]).alias("value")
    )
    unit = F.struct(F.lit(1).alias("shift"), F.lit("str").alias("t"), q["unit"].alias("value"))
    return F.when(
        q.isNotNull(), F.filter(F.array(number, unit), lambda x: F.length(x["value"]) > 0)
    )


def _parts(df: DataFrame, columns: list[str]) -> list[tuple[int, int, Column, T.DataType]]:
    """What each table column stores: (order, shift to the right, value, type)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for i, c in enumerate(columns):
        if is_quantity(types[c]):
            magnitude = types[c]["magnitude"].dataType
            parts.append((i, 0, F.col(c)["magnitude"], magnitude))
            parts.append((i, 1, F.when(F.col(c)["unit"] != "", F.col(c)["unit"]), T.StringType()))
        else:
            parts.append((i, 0, F.col(c), types[c]))
    return parts


_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def stored_cells(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``cells``, the stored cells of each row: (ord, shift, t, value, style, display).

    Day numbers and number texts are columns of their own before the cells are
    made, as the cells use them more than once.
    """
    parts = _parts(df, columns)
    numbers = {
        f"__n{k}": C.to_oadate(v) if isinstance(t, _TIMES) else v.cast("string").cast("double") if isinstance(t, T.FloatType) else v
        for k, (_, _, v, t) in enumerate(parts)
        if isinstance(t, (*_TIMES, T.DoubleType, T.FloatType))
    }
    others = {
        f"__v{k}": v for k, (_, _, v, t) in enumerate(parts) if f"__n{k}" not in numbers or isinstance(t, _TIMES)
    }
    step = df.select(*keep, *[v.alias(n) for n, v in {**numbers, **others}.items()])
    step = step.select(
        *keep, *others, *[C.number_text(n).alias(n) for n in numbers]
    )
    made = []
    for k, (i, shift, _, dtype) in enumerate(parts):
        if f"__n{k}" in numbers:
            is_time = isinstance(dtype, _TIMES)
            text = F.col(f"__n{k}")
            display = (
                F.date_format(F.col(f"__v{k}").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss") if is_time
                else F.substring(text, 1, fixed.NUMBER_WIDTH_LIMIT)
            )
            fields = [F.lit("n").alias("t"), text.alias("value"), F.lit(3 if is_time else 0).alias("style"), display.alias("display")]
        else:
            v = C.encode_value(f"__v{k}", dtype)
            fields = [v[f].alias(f) for f in ("t", "value", "style", "display")]
        made.append(F.struct(F.lit(i).alias("ord"), F.lit(shift).alias("shift"), *fields))
    return step.select(*keep, F.array(*made).alias("cells"))


def to_cells(df: DataFrame, keys: list[str], columns: list[str], order: list[str], block: Column) -> DataFrame:
    """A table as sheet cells: header in row 1, data rows in ``order`` below it.

    ``keys`` name the sheet; ``block`` cuts ``order`` into blocks (see ``running``).
    Nulls leave no cell. Columns: keys, row, col, ref, t, value, style, display.
    """
    positions = col_positions(col_increments(df, keys, columns), keys)
    numbered = row_numbers(df, keys, order, block, "__row")
    placed = (
        stored_cells(numbered, columns, [*keys, "__row"])
        .select(*keys, (F.col("__row") + 1).alias("row"), F.explode("cells").alias("v"))
        .select(*keys, "row", "v.*")
        .where(F.col("value").isNotNull())
    )
    quantities = [i for i, c in enumerate(columns) if is_quantity(df.schema[c].dataType)]
    if quantities:
        starts = positions.groupBy(*keys).agg(
            F.array_agg(F.struct("ord", "start")).alias("s")
        ).select(*keys, F.transform(F.sort_array("s"), lambda x: x["start"]).alias("starts"))
        way = F.pmod(F.col("row"), F.lit(8)).cast("int")
        copies = F.explode(F.array(*[F.lit(i) for i in range(8)]))
        body = placed.withColumn("__way", way).join(starts.withColumn("__way", copies), [*keys, "__way"])
        col = F.get("starts", F.col("ord")) + F.col("shift")
    else:
        body, col = placed, F.col("ord") + 1
    body = body.select(*keys, "row", col.cast("int").alias("col"), "t", "value", "style", "display")
    header = positions.select(
        *keys, F.lit(1).cast("long").alias("row"), F.col("start").alias("col"), F.lit("str").alias("t"),
        F.col("name").alias("value"), F.lit(1).alias("style"), F.col("name").alias("display"),
    )
    return header.unionByName(body).select(
        *keys, "row", "col", C.cell_ref("col", "row").alias("ref"), "t", "value", "style", "display"
    )


def col_widths(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Width of each sheet column: the widest of its display texts."""
    return cells.groupBy(*keys, "col").agg(F.max(C.text_width("display")).alias("width"))


def encode_boolean(value: Column | str) -> Column:
    """A yes/no result as the one cell A1: struct(row, col, ref, t, value, style)."""
    v = C.encode_value(value, T.BooleanType())
    return F.struct(
        F.lit(1).alias("row"), F.lit(1).alias("col"), F.lit("A1").alias("ref"),
        v["t"].alias("t"), v["value"].alias("value"), v["style"].alias("style"),
    )


def encode_term(term: Column | str, namespaces: dict[str, str]) -> Column:
    """A graph term struct(kind, value, datatype) as struct(t, value, style).

    Literals take the type their datatype names (numbers, booleans, date-times);
    URIs are shortened by the longest namespace that starts them; blank nodes
    are written ``_:label``.
    """
    term = F.col(term) if isinstance(term, str) else term
    kind, value = term["kind"], term["value"]
    short = value
    for prefix, uri in sorted(namespaces.items(), key=lambda p: len(p[1])):
        short = F.when(
            value.startswith(uri), F.concat(F.lit(f"{prefix}:"), F.substring(value, len(uri) + 1, 2147483647))
        ).otherwise(short)
    local = F.regexp_extract(F.coalesce(term["datatype"], F.lit("")), "([^#/]*)$", 1)
    number, flag, date = C.as_number(value), C.as_boolean(value), C.as_date(value)
    numeric = local.isin("double", "float", "decimal", "integer", "int", "long", "short", "byte") & number.isNotNull()
    is_flag = (local == "boolean") & flag.isNotNull()
    is_date = local.isin("dateTime", "date") & date.isNotNull()
    literal = kind == "literal"
    text = C.multiline(value)
    return F.struct(
        F.when(literal & (numeric | is_date), "n").when(literal & is_flag, "b")
        .when(literal, text["t"]).otherwise("str").alias("t"),
        F.when(literal & numeric, C.number_text(number))
        .when(literal & is_flag, flag.cast("string"))
        .when(literal & is_date, C.number_text(C.to_oadate(date)))
        .when(literal, text["text"])
        .when(kind == "bnode", F.concat(F.lit("_:"), value))
        .otherwise(short).alias("value"),
        F.when(literal & is_date, 3).when(literal & ~numeric & ~is_flag, text["style"]).otherwise(0).alias("style"),
    )
