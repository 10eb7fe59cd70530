"""Quality rules as a short-circuit cascade, in DataFrame operations alone.

A rule rejects a document by a condition on its text. The cost of each rule is the time a noop write of it takes on
a sample, its selectivity the share of the sample it rejects; rules run in the order of rejections per cost, and
as a CASE, so a rule is computed only for documents that all rules before it passed. The order never changes
which documents stay.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctables.llm import shared

SAMPLE_ROWS = 1000
SYMBOLS = "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: as a lambda's variable it is no expression to repeat."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_chars(w: Column) -> Column:
    """Code points in words."""
    return F.char_length(F.array_join(w, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.octet_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{shared.BLANKS}]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def position_mask(w: Column) -> Column:
    """As many low bits as the word count needs."""
    return F.pow(F.lit(2.0), F.length(F.bin(F.size(w)))).cast("long") - 1


def window_keys(w: Column, mask: Column) -> Column:
    """A number for each 3-word window, sorted: its hash, with its position in the low bits. Null below four words."""
    top = F.bitwise_not(mask)
    key = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(top).bitwiseOR(i.cast("long"))
    return F.when(F.size(w) > 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), key)))


def window_candidates(keys: Column, mask: Column) -> Column:
    """Positions of windows whose hash a neighbour has too."""
    same = lambda x, y: x.bitwiseXOR(y).between(F.lit(0), mask)
    return F.transform(F.filter(keys, lambda x, i: same(x, F.get(keys, i - 1)) | same(x, F.get(keys, i + 1))), lambda x: x.bitwiseAND(mask).cast("int"))


def named_windows(w: Column, at: Column) -> Column:
    """The words and positions of the candidates, sorted."""
    named = lambda p: F.struct(F.get(w, p).alias("a"), F.get(w, p + 1).alias("b"), F.get(w, p + 2).alias("c"), p.alias("p"))
    return F.sort_array(F.transform(at, named))


def repeated_at(t: Column) -> Column:
    """Positions, sorted, of windows whose words a neighbour has too."""
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    return F.sort_array(F.transform(F.filter(t, lambda x, i: same(x, F.get(t, i - 1)) | same(x, F.get(t, i + 1))), lambda x: x["p"]))


def words_covered(at: Column) -> Column:
    """Words in the windows at these sorted positions."""
    step = lambda s, x: F.struct((s["n"] + F.least(F.lit(3), x - s["last"])).alias("n"), x.alias("last"))
    n = F.aggregate(at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), step, lambda s: s["n"])
    return F.coalesce(n, F.lit(0).cast("long"))


def n_repeat_words(w: Column) -> Column:
    """Words in 3-word windows found twice or more.

    Windows are sorted as numbers: the upper bits are a hash, the lower ones, as many as the text's word count
    needs, the position. Neighbours with equal hashes are candidates; those alone are sorted by their words, which settles
    which windows are equal. Linear but for the sorts, at any length.
    """
    keyed = let(F.struct(w.alias("w"), position_mask(w).alias("m")), lambda x: let(window_keys(x["w"], x["m"]), lambda k: let(window_candidates(k, x["m"]), lambda c: let(named_windows(x["w"], c), repeated_at))))
    return let(keyed, words_covered)


def with_repeat_words(df: DataFrame, w: str, name: str) -> DataFrame:
    """n_repeat_words as a column, its steps as columns of their own, which Spark compiles."""
    df = df.withColumn("m_", position_mask(F.col(w))).withColumn("k_", window_keys(F.col(w), F.col("m_")))
    df = df.withColumn("c_", window_candidates(F.col("k_"), F.col("m_"))).withColumn("t_", named_windows(F.col(w), F.col("c_")))
    df = df.withColumn("r_", repeated_at(F.col("t_")))
    return df.withColumn(name, words_covered(F.col("r_"))).drop("m_", "k_", "c_", "t_", "r_")


@dataclass(frozen=True)
class Rule:
    """A rule's name and its condition for rejection, on the text (never null) and its words."""

    name: str
    rejects: Callable[[Column, Column], Column]


#: Documents with fewer words, or with more than half of them in repeated 3-word windows.
BASE = [
    Rule("few_words", lambda t, w: F.size(w) < 50),
    Rule("repeats", lambda t, w: 100 * n_repeat_words(w) > 50 * F.size(w)),
]
#: Wide limits: what they reject is junk in any language.
RULES = [
    Rule("symbols", lambda t, w: 100 * n_symbols(t) > 50 * F.size(w)),
    Rule("dup_lines", lambda t, w: let(F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{shared.BLANKS}]")), lambda x: 100 * (F.size(x) - F.size(F.array_distinct(x))) > 60 * F.size(x))),
    Rule("word_length", lambda t, w: (word_chars(w) < 2 * F.size(w)) | (word_chars(w) > 20 * F.size(w))),
    Rule("few_letters", lambda t, w: 100 * F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))) < 50 * F.size(w)),
]


def rejects(rule: Rule, text: Column) -> Column:
    """The rule's condition on a text; null texts count as empty."""
    t = F.coalesce(text, F.lit(""))
    return let(F.struct(t.alias("t"), shared.words(t).alias("w")), lambda x: F.coalesce(rule.rejects(x["t"], x["w"]), F.lit(False)))


def ordered(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, text: str = "text") -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) by rejections per second, the most first, measured on about sample_rows rows.

    The sample is taken by a hash of the text's row over all rows, and written once. Without rows the order is the given one.
    """
    n = docs.count()
    if not n:
        return [(r, 0.0, 0.0) for r in rules]
    taken = docs.select(text).sample(fraction=min(1.0, 1.2 * sample_rows / n), seed=17).limit(sample_rows)
    sample = shared.written(taken, "rule-sample")
    share = sample.agg(*[F.avg(rejects(r, F.col(text)).cast("double")).alias(r.name) for r in rules]).first()
    found = []
    for r in rules:
        seconds = []
        for _ in range(2):  # the first run also compiles
            start = time.perf_counter()
            sample.select(rejects(r, F.col(text))).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        found.append((r, min(seconds), share[r.name] or 0.0))
    return sorted(found, key=lambda x: -x[2] / max(x[1], 1e-9))


def cascade(text: Column, rules: list[Rule]) -> Column:
    """Name of the first rule that rejects the text, null if none does; later rules are not computed."""
    t = F.coalesce(text, F.lit(""))
    return let(F.struct(t.alias("t"), shared.words(t).alias("w")), lambda x: first_rejecting(x["t"], x["w"], rules))


def first_rejecting(t: Column, w: Column, rules: list[Rule]) -> Column:
    """cascade() on a text that is never null and its words."""
    out = F.when(F.coalesce(rules[0].rejects(t, w), F.lit(False)), rules[0].name)
    for r in rules[1:]:
        out = out.when(F.coalesce(r.rejects(t, w), F.lit(False)), r.name)
    return out


def kept_by_rules(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """Rows that no rule rejects, columns as they are. Null texts are empty and fall under `few_words`."""
    rules = rules or BASE + RULES
    return docs.filter(cascade(F.col(text), [r for r, *_ in ordered(docs, rules, text=text)]).isNull())


def measured(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the base columns and the verdict of the cascade of RULES.

    Null and empty texts have no words and fail the base. Repeated rows stay; other columns are ignored; an empty table gives no rows.
    """
    rules = [r for r, *_ in ordered(docs, RULES)]
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("w", shared.words(F.col("t")))
    t, w = F.col("t"), F.col("w")
    df = with_repeat_words(df, "w", "n_repeat_words")
    df = df.withColumn("base_failed", (F.size(w) < 50) | (100 * F.col("n_repeat_words") > 50 * F.size(w)))
    return df.select(
        "doc_id",
        F.size(w).cast("long").alias("n_words"),
        word_chars(w).alias("word_chars"),
        n_symbols(t).alias("n_symbols"),
        n_dup_lines(t).alias("n_dup_lines"),
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & first_rejecting(t, w, rules).isNull()).alias("kept"),
    )


def op1_quality_rules(spark, sf_dir):
    """Base columns and verdict of all documents."""
    return measured(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))


#: n_repeat_words counts words, not windows, so each window of a repeated text marks its three words.
ORACLE = {
    "op1_quality_rules": r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
g as (select doc_id, unnest(range(1, greatest(len(w) - 1, 1))) as i, w from w where len(w) > 2),
k as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as c from g),
r as (select doc_id, count(distinct p) as n_repeat_words
      from (select doc_id, unnest([i, i + 1, i + 2]) as p from k where c > 1) group by doc_id),
b as (select w.doc_id, w, l, t, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
             (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
             coalesce(n_repeat_words, 0)::bigint as n_repeat_words
      from w left join r on w.doc_id = r.doc_id),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (100 * n_symbols > 50 * n_words) and not (100 * n_dup_lines > 60 * len(l))
       and not (word_chars < 2 * n_words or word_chars > 20 * n_words)
       and not (100 * len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) < 50 * n_words) as kept
from f""",
}
