"""Fields, form parameters and the headers that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctables.functions import fields as P
from doctables.functions import fixed
from doctables.functions.cells import as_date, unify_lines
from doctables.functions.text import md_escape
from doctables.operators.running import BLOCK_ROWS, block_of, row_numbers, spread_lookup

INTEGER = r"^\s*[+-]?[0-9]+\s*\z"


def parse_fields(field: DataFrame) -> DataFrame:
    """Add the parsed instruction ``f``; fields of another form are dropped."""
    return field.withColumn("f", P.parse_field("instr")).where(F.col("f").isNotNull())


def resolve_fields(field: DataFrame, prop: DataFrame) -> DataFrame:
    """Text of property fields; fields without a property or value are dropped."""
    asked = parse_fields(field).withColumn("name", P.field_property(F.col("f.command"))).where(
        F.col("name").isNotNull()
    )
    found = spread_lookup(asked, prop.select("path", "name", "value"), ["path", "name"], ["pos"], "inner")
    content = F.when(F.col("name") == "FileSize", F.col("value")).otherwise(md_escape("value"))
    return found.where(F.length("value") > 0).select("path", "pos", content.alias("md"))


def seq_numbers(field: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Number the SEQ fields of each name in a document: 1, 2, 3."""
    seq = parse_fields(field).where(F.col("f.command") == "SEQ").select(
        "path", "pos", F.col("f.argument").alias("name")
    )
    return row_numbers(seq, ["path", "name"], ["pos"], block_of("pos", block_rows), "number")


def date_fields(field: DataFrame, prop: DataFrame, now: Column) -> DataFrame:
    """Text of date fields: the property each names, or ``now`` for DATE and TIME."""
    asked = parse_fields(field).where(F.col("f.command").isin(list(fixed.DATE_FIELDS))).withColumn(
        "name", P.field_date_property(F.col("f.command"))
    )
    found = spread_lookup(asked, prop.select("path", "name", "value"), ["path", "name"], ["pos"])
    ts = F.when(F.col("name").isNull(), now.cast("timestamp_ntz")).otherwise(as_date("value"))
    dated = found.withColumn("ts", ts).where(F.col("ts").isNotNull())
    return dated.select("path", "pos", P.date_text(F.col("ts"), F.col("f.format")).alias("md"))


# --- form controls ------------------------------------------------------------------------


def control_parameters(control: DataFrame) -> DataFrame:
    """Controls that are parameters, with their ptype and value."""
    typed = control.withColumn("ptype", P.control_type("tag"))
    value = P.control_value(F.col("ptype"), F.col("checked"), F.col("default_value"), F.col("shown"))
    return typed.where(F.col("ptype").isNotNull() & (F.length("alias") > 0)).withColumn("value", value)


def _valid_items() -> Column:
    return F.filter(
        "items", lambda x: (F.length(x["value"]) > 0) & (F.length(x["display"]) > 0)
    )


def control_options(control: DataFrame) -> DataFrame:
    """Options of each parameter, numbered from 1; items without value or display do not count."""
    return control_parameters(control).select(
        "path", "pos", "alias", F.posexplode(_valid_items()).alias("i", "item")
    ).select("path", "pos", "alias", (F.col("i") + 1).alias("i"), "item.value", "item.display")


def metadata_lines(control: DataFrame) -> DataFrame:
    """Header lines of a form: (path, rank, pos, line, text).

    Rank 0 holds value and type of every parameter, rank 1 lengths and options.
    """
    params = control_parameters(control)
    alias = F.col("alias")
    main = F.concat(
        P.key_lines(alias, F.col("value")), P.key_lines(F.concat(alias, F.lit(" Type")), F.col("ptype"))
    )
    length = F.when(
        F.col("max_len").isNotNull(),
        P.key_lines(F.concat(alias, F.lit(" MaxLen")), F.col("max_len").cast("string")),
    ).otherwise(F.array().cast("array<string>"))

    def option(x: Column, i: Column) -> Column:
        key = F.concat(alias, F.lit(" Item"), (i + 1).cast("string"))
        return F.concat(
            P.key_lines(F.concat(key, F.lit(" Value")), x["value"]),
            P.key_lines(F.concat(key, F.lit(" Display")), x["display"]),
        )

    options = F.when(
        F.col("items").isNotNull(), F.flatten(F.transform(_valid_items(), option))
    ).otherwise(F.array().cast("array<string>"))
    ranked = params.select(
        "path", "pos",
        F.posexplode(F.array(main, F.concat(length, options))).alias("rank", "lines"),
    )
    return ranked.select("path", "rank", "pos", F.posexplode("lines").alias("line", "text"))


# --- headers back to parameters --------------------------------------------------------------


def _header_entries(md: Column | str) -> Column:
    """Header lines as an array of (pos, key, value), split at the first colon that is not first."""
    lines = F.split(P.split_header(md)["header"], "\n", -1)

    def entry(line: Column, i: Column) -> Column:
        colon = F.instr(line, ":")
        return F.when(colon > 1, F.struct(
            i.alias("pos"), P.trim_all(F.substring(line, F.lit(1), colon - 1)).alias("key"), P.trim_all(F.substr(line, colon + 1)).alias("value"),
        ))

    return F.filter(F.transform(lines, entry), lambda e: e.isNotNull())


def header_pairs(doc: DataFrame, md: str = "md") -> DataFrame:
    """Header lines as (path, pos, key, value), split at the first colon that is not first."""
    return doc.select("path", F.explode(_header_entries(md)).alias("e")).select("path", "e.*")


def _bound(lines: DataFrame) -> DataFrame:
    """Rows of (path, entries) with one row per entry and its name and suffix; nothing leaves its row before that.

    The distinct keys of a header, in order, are the map that leading words are looked up in.
    """
    known = lines.withColumn("keys", F.array_distinct(F.transform("entries", lambda e: e["key"])))

    def owner(key: Column, no: Column) -> Column:
        """Place (from 1) of the earliest key before place no + 1 that the key starts with, up to a space."""
        words = F.split(key, " ")
        starts = F.transform(
            F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")
        )
        return F.array_min(F.filter(F.transform(starts, lambda s: F.array_position("keys", s)), lambda at: (at > 0) & (at <= no)))

    bound = known.withColumn("owners", F.transform("keys", owner))
    each = bound.withColumn("e", F.explode("entries")).withColumn("at", F.array_position("keys", F.col("e.key")).cast("int"))
    name = F.get("keys", F.get("owners", F.col("at") - 1).cast("int") - 1)
    named = each.select("path", "e.*", name.alias("owner"))
    rest = F.regexp_replace(F.substr("key", F.length("owner") + 2), r"^\s+", "")
    return named.select(
        "path", "pos", "key", "value", F.coalesce("owner", "key").alias("name"), F.when(F.col("owner").isNotNull(), rest).alias("suffix")
    )


def bound_lines(doc: DataFrame, md: str = "md") -> DataFrame:
    """Header lines of each text with parameter ``name`` and ``suffix``, see bind_attributes; no shuffle, a header is one value."""
    return _bound(doc.select("path", _header_entries(md).alias("entries")))


def bind_attributes(pairs: DataFrame) -> DataFrame:
    """Add the parameter ``name`` of each pair (path, pos, key, value) and, for attributes, the ``suffix``.

    A key is an attribute if, where it first stands, an earlier key followed by a
    space starts it; the earliest such key wins. (That key is always a name:
    were it an attribute itself, its own name would be an earlier match.) The pairs
    of a path come together as one value, as their header was.
    """
    entry = F.struct("pos", "key", "value")
    return _bound(pairs.groupBy("path").agg(F.sort_array(F.collect_list(entry)).alias("entries")))


def _option_index() -> Column:
    return F.regexp_extract("suffix", P.OPTION, 1).try_cast("int")


def _is_option() -> Column:
    """Whether the suffix is an option's; numbers that are no whole number of 32 bits make a property of it."""
    return F.coalesce(F.col("suffix").rlike(P.OPTION) & _option_index().isNotNull(), F.lit(False))


def typed_attributes(bound: DataFrame) -> DataFrame:
    """Type and maximum length of each parameter; the last line of each counts."""
    kind = F.when(F.col("suffix") == "Type", F.struct("pos", "value"))
    length = F.when(F.col("suffix") == "MaxLen", F.struct("pos", "value"))
    last = bound.groupBy("path", "name").agg(F.max(kind).alias("t"), F.max(length).alias("m"))
    given = F.col("t.value")
    return last.select(
        "path", "name",
        F.when(given.isin(fixed.PARAMETER_TYPES), given).otherwise("String").alias("type"),
        F.when(F.col("m.value").rlike(INTEGER), P.trim_all("m.value").try_cast("int")).alias("max_len"),
    )


def option_rows(bound: DataFrame) -> DataFrame:
    """Given options of each parameter: (path, name, i, value, display). Index 0 is dropped."""
    options = bound.where(_is_option()).select(
        "path", "name", "pos", "value", _option_index().alias("i"),
        F.col("suffix").endswith("Value").alias("is_value"),
    )
    return options.where(F.col("i") > 0).groupBy("path", "name", "i").agg(
        F.max_by("value", F.when(F.col("is_value"), F.col("pos"))).alias("value"),
        F.max_by("value", F.when(~F.col("is_value"), F.col("pos"))).alias("display"),
    )


def _options(by_index: DataFrame) -> DataFrame:
    """Add the array ``options`` from sorted entries ``e`` of (i, option), empty options in the gaps."""
    empty = F.struct(F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("display"))

    def with_gap(x: Column, n: Column) -> Column:
        before = F.when(n == 0, 0).otherwise(F.get("e", n - 1)["i"])
        return F.concat(F.array_repeat(empty, (x["i"] - before - 1).cast("int")), F.array(x["o"]))

    return by_index.withColumn("options", F.flatten(F.transform("e", with_gap)))


def options_array(options: DataFrame) -> DataFrame:
    """Options as one array per parameter, empty options in the gaps."""
    entry = F.struct(F.col("i"), F.struct("value", "display").alias("o"))
    by_index = options.groupBy("path", "name").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return _options(by_index).select("path", "name", "options")


def properties_map(bound: DataFrame) -> DataFrame:
    """Other suffixes of each parameter with their values in order."""
    other = F.col("suffix").isNotNull() & ~F.col("suffix").isin("Type", "MaxLen") & ~_is_option()
    lists = bound.where(other).groupBy("path", "name", "suffix").agg(
        F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("v")
    ).select("path", "name", F.struct("suffix", F.transform("v", lambda x: x["value"]).alias("v")).alias("e"))
    return lists.groupBy("path", "name").agg(F.map_from_entries(F.collect_list("e")).alias("properties"))


def parameters(doc: DataFrame, md: str = "md") -> DataFrame:
    """One row per parameter of each text: name, type, max_len, values, properties, options.

    Lines are first gathered per attribute (both lines of an option together), then
    per parameter. A text's header is one value, so both are bounded by it.
    """
    bound = bound_lines(doc, md)
    other = F.when(~_is_option(), F.col("suffix"))
    is_value = F.col("suffix").endswith("Value")
    gathered = (
        bound.withColumn("i", F.when(_is_option(), _option_index()))
        .where(F.col("i").isNull() | (F.col("i") > 0))
        .groupBy("path", "name", other.alias("suffix"), "i")
        .agg(
            F.min("pos").alias("pos"),
            F.sort_array(F.collect_list(F.when(F.col("i").isNull(), F.struct("pos", "value")))).alias("v"),
            F.max_by("value", F.when(is_value, F.col("pos"))).alias("value"),
            F.max_by("value", F.when(~is_value, F.col("pos"))).alias("display"),
        )
        .withColumn("v", F.transform("v", lambda x: x["value"]))
    )
    own = F.col("suffix").isNull() & F.col("i").isNull()
    last = F.element_at("v", -1)
    given = F.max(F.when(F.col("suffix") == "Type", last))
    length = F.max(F.when(F.col("suffix") == "MaxLen", last))
    extra = F.col("suffix").isNotNull() & ~F.col("suffix").isin("Type", "MaxLen")
    return _options(
        gathered.groupBy("path", "name").agg(
            F.min(F.when(own, F.col("pos"))).alias("pos"),
            F.max_by("v", F.when(own, F.lit(1))).alias("values"),
            F.when(given.isin(fixed.PARAMETER_TYPES), given).otherwise("String").alias("type"),
            F.when(length.rlike(INTEGER), P.trim_all(length).try_cast("int")).alias("max_len"),
            F.map_from_entries(F.collect_list(F.when(extra, F.struct("suffix", "v")))).alias("properties"),
            F.sort_array(
                F.collect_list(F.when(F.col("i").isNotNull(), F.struct("i", F.struct("value", "display").alias("o"))))
            ).alias("e"),
        )
    ).select("path", "pos", "name", "type", "max_len", "values", "properties", "options")


def has_parameters(doc: DataFrame, md: str = "md") -> DataFrame:
    """Each text with whether its header gives any parameter."""
    header = P.split_header(md)["header"]
    keyed = F.exists(F.split(header, "\n", -1), lambda line: F.instr(line, ":") > 1)
    return doc.select("path", F.coalesce(keyed, F.lit(False)).alias("has_parameters"))
