"""Work over many documents: languages, censuses, names, headers, differences."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctables.functions import fixed
from doctables.functions.fields import header_lines
from doctables.functions.text import norm_style


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lang_counts(run: DataFrame, times: Column | str | None = None) -> DataFrame:
    """How often each language is tagged in a document, and where first. ``en-GB`` counts as ``en``.

    A row stands for one tag, or for ``times`` of them.
    """
    lang = F.substring_index("tag", "-", 1)
    n = F.count("*") if times is None else F.sum(_col(times))
    return run.groupBy("path", lang.alias("lang")).agg(n.alias("n"), F.min("pos").alias("first"))


def doc_language(run: DataFrame, prop: DataFrame, times: Column | str | None = None) -> DataFrame:
    """Language property of each document, else its most counted language, the first of equals."""
    voted = lang_counts(run, times).groupBy("path").agg(
        F.max_by("lang", F.struct(F.col("n"), (-F.col("first")).alias("f"))).alias("voted")
    )
    given = prop.where((F.col("name") == "Language") & (F.length("value") > 0)).select(
        "path", F.col("value").alias("given")
    )
    return voted.join(given, "path", "full").select("path", F.coalesce("given", "voted").alias("language"))


def unhandled_census(element: DataFrame, handled: dict, home: str | dict[str, str], times: Column | str | None = None) -> DataFrame:
    """Elements (ns, tag) without a rule, counted per document. Names outside ``home`` are prefixed by their vocabulary.

    A row stands for one element, or for ``times`` of them. With a ``home`` for each ``kind`` of document, ``handled`` has the rules
    by kind, other kinds are left out, and all are counted in one pass.
    """
    by_kind = isinstance(home, dict)
    known, name = F.lit(None).cast("boolean"), F.lit(None).cast("string")
    for kind, own in (home if by_kind else {None: home}).items():
        ruled = F.lit(False)
        for ns, names in (handled[kind] if by_kind else handled).items():
            ruled = ruled | ((F.col("ns") == ns) & F.col("tag").isin(names))
        here = F.col("kind") == kind if by_kind else F.lit(True)
        known = F.when(here, ruled).otherwise(known)
        name = F.when(here, F.when(F.col("ns") == own, F.col("tag")).otherwise(F.concat("ns", F.lit("#"), "tag"))).otherwise(name)
    n = F.count("*") if times is None else F.sum(_col(times))
    kinds = ["kind"] if by_kind else []
    return element.where(~known).groupBy("path", *kinds, name.alias("element")).agg(n.alias("n")).drop(*kinds)


def unknown_styles(paragraph: DataFrame) -> DataFrame:
    """Style names without a meaning, once per document."""
    return (
        paragraph.where(F.col("style_id").isNotNull() & norm_style("style_id").isNull())
        .select("path", F.upper("style_id").alias("style_id"))
        .distinct()
    )


# --- names ----------------------------------------------------------------------------------


def wildcard_pattern(pattern: str) -> str:
    """Regular expression of a name pattern where ``*`` stands for any text; case does not matter."""
    return "(?is)^" + "(.*)".join(re.escape(p) for p in pattern.split("*")) + r"\z"


def output_name(name: Column | str, in_pattern: str, out_pattern: str) -> Column:
    """Output name: each ``*`` of ``out_pattern`` takes what that ``*`` matched in the input name.

    Null for names that do not match. The folder part of patterns may hold no ``*``.
    """
    count = in_pattern.count("*")
    if "*" in out_pattern and out_pattern.count("*") != count:
        raise ValueError("number of wildcards does not match")
    regex = wildcard_pattern(in_pattern)
    parts = out_pattern.split("*")
    pieces = [F.lit(parts[0])]
    for i, part in enumerate(parts[1:], 1):
        pieces += [F.regexp_extract(_col(name), regex, i), F.lit(part)]
    return F.when(_col(name).rlike(regex), F.concat(*pieces))


def base_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def with_extension(name: Column, extension: str) -> Column:
    """File name with its extension replaced, or added."""
    return F.concat(F.regexp_replace(name, r"\.[^./]*\z", ""), F.lit(f".{extension}"))


def output_path(path: Column | str, root: str, folder: str | None = None) -> Column:
    """Where the Markdown of a file goes: beside it, or below ``folder`` in the same sub-folder."""
    path = _col(path)
    if folder is None:
        return with_extension(path, "md")
    base = root if not root or root.endswith("/") else root + "/"
    below = F.when(path.startswith(base), F.substring(path, len(base) + 1, 2147483647)).otherwise(path)
    return F.concat(F.lit(folder.rstrip("/") + "/"), with_extension(below, "md"))


def target_path(path: Column | str, root: str, pattern: str, out: str | None = None) -> Column:
    """Where the Markdown of a file below ``root`` goes: beside it, below ``out`` if that ends with a slash, else under
    the name that ``out`` makes of it, in the same sub-folder. Null for names that do not match ``pattern``.
    """
    path = _col(path)
    matches = base_name(path).rlike(wildcard_pattern(pattern))
    if out is None or out.endswith("/"):
        return F.when(matches, output_path(path, root, out))
    folder, slash, name = out.rpartition("/")
    base = root if not root or root.endswith("/") else root + "/"
    below = F.when(path.startswith(base), F.substring(path, len(base) + 1, 2147483647)).otherwise(base_name(path))
    inner = F.regexp_extract(below, r"(?s)^(.*/)?[^/]*\z", 1)
    return F.concat(F.lit(folder + slash), inner, output_name(base_name(path), pattern, name))


# --- headers ---------------------------------------------------------------------------------


def inject_headers(prop: DataFrame, given: dict[str, str]) -> DataFrame:
    """Header lines of each document: (path, rank, pos, text), given headers first.

    A given header replaces the property of the same name; empty lines are dropped.
    """
    rank = F.lit(None).cast("int")
    key = F.lit(None).cast("string")
    for i, (name, label) in enumerate(fixed.PROPERTY_HEADERS):
        if label not in given:
            rank = F.when(F.col("name") == name, i + 1).otherwise(rank)
            key = F.when(F.col("name") == name, label).otherwise(key)
    value = F.when(F.col("name") == "Created", F.substring("value", 1, 10)).otherwise(F.col("value"))
    own = prop.select("path", rank.alias("rank"), key.alias("key"), value.alias("value")).where(
        F.col("rank").isNotNull()
    ).select("path", "rank", F.posexplode(header_lines("key", "value")).alias("pos", "line"))
    if given:
        fixed_lines = F.flatten(F.array(*[header_lines(F.lit(k), F.lit(v)) for k, v in given.items()]))
        first = prop.select("path").distinct().select(
            "path", F.lit(0).alias("rank"), F.posexplode(fixed_lines).alias("pos", "line")
        )
        own = first.unionByName(own)
    return own.select("path", "rank", "pos", F.concat("line", F.lit("\n")).alias("text"))


def header_text(lines: DataFrame) -> DataFrame:
    """The lines of each document's header as one text, with an empty line after it.

    A header holds a few properties, so it is one row (part 0) in every document.
    """
    pieces = F.sort_array(F.collect_list(F.struct("rank", "pos", F.col("text").alias("x"))))
    text = F.array_join(F.transform("p", lambda x: x["x"]), "")
    return lines.groupBy("path").agg(pieces.alias("p")).select(
        "path", F.lit(0).cast("long").alias("part"), F.concat(text, F.lit("\n")).alias("text")
    )


# --- outcome -----------------------------------------------------------------------------------


def outcome_text(converted: Column | str, failed: Column | str) -> Column:
    """Sentence on how many files were converted."""
    yes, no = _col(converted), _col(failed)
    n = lambda c: c.cast("string")
    # fixed values: the wording of the messages
    return (
        F.when((yes == 0) & (no == 0), "No files processed.")
        .when((yes == 0) & (no == 1), "File not converted.")
        .when(yes == 0, F.concat(n(no), F.lit(" files found, bot not converted.")))
        .when((no == 0) & (yes == 1), "File converted.")
        .when(no == 0, F.concat(n(yes), F.lit(" files converted.")))
        .otherwise(
            F.concat(
                n(yes + no), F.lit(" file(s) found, "), n(yes), F.lit(" where converted, "),
                n(no), F.lit(" where not converted."),
            )
        )
    )


def outcome(files: DataFrame, converted: Column, keys: list[str]) -> DataFrame:
    """Converted and not converted files, per group, with the summary text."""
    counts = files.groupBy(*keys).agg(
        F.count_if(converted).alias("converted"), F.count_if(~converted).alias("failed")
    )
    return counts.withColumn("message", outcome_text("converted", "failed"))


def row_diff(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Lines that differ between two sets of texts: (path, line, change, n).

    Order is ignored and repeats count. Both sides are counted in one grouping,
    so a line that stands a billion times is summed before it is moved.
    """
    both = expected.select("path", "line", F.lit(-1).alias("by")).unionByName(
        produced.select("path", "line", F.lit(1).alias("by"))
    )
    net = both.groupBy("path", "line").agg(F.sum("by").alias("by")).where(F.col("by") != 0)
    return net.select(
        "path", "line", F.when(F.col("by") > 0, "added").otherwise("removed").alias("change"),
        F.abs("by").alias("n"),
    )
