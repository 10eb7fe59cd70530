"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by (source, lang, topic); values that hold less than SHARE of the tokens form one class per column, so there are at most
(1 / SHARE + 1)^2 * (TOPICS + 1) cells, whatever the corpus. The cells are raked to the target marginals on the driver; a document's weight is its cell's
fitted over its observed tokens, and it is sampled with a probability in proportion, by a hash of its row.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctables.llm import shared

SHARE = 1 / 64
TOPICS = 8
#: Targets are the observed shares to this power: below 1, small sources gain.
POWER = 0.7
OTHER = "(other)"
COLUMNS = ("source", "lang", "topic")


def topic_of(w: Column, topics: int = TOPICS) -> Column:
    """A stand-in topic for tables without one: the class by hash of the text's longest word, the greatest of equal length."""
    longest = F.array_max(F.transform(w, lambda x: F.struct(F.length(x).alias("n"), x.alias("w"))))["w"]
    return F.coalesce(F.pmod(F.xxhash64(longest), F.lit(topics)).cast("string"), F.lit(OTHER))


def rake(observed: np.ndarray, targets: list[np.ndarray], tolerance: float = 1e-9) -> np.ndarray:
    """Scale a table of any rank until its marginals have the targets' shares; empty cells stay empty.

    Target shares of values without tokens are spread over the others. Where empty cells keep the targets out of
    reach, it ends when a round brings them no nearer.
    """
    fitted = observed / max(observed.sum(), 1e-300)
    axes = range(observed.ndim)
    wanted = []
    for a in axes:
        t = np.where(observed.sum(tuple(x for x in axes if x != a)) > 0, targets[a], 0.0)
        wanted.append(t / max(t.sum(), 1e-300))
    before = np.inf
    while True:
        off = 0.0
        for a in axes:
            now = fitted.sum(tuple(x for x in axes if x != a))
            factor = np.divide(wanted[a], now, out=np.zeros_like(now), where=now > 0)
            off = max(off, float(np.abs(now - wanted[a]).max(initial=0)))
            fitted = fitted * factor.reshape([-1 if x == a else 1 for x in axes])
        if off < tolerance or off >= before * (1 - 1e-6):
            break
        before = off
    return fitted * observed.sum()


def _class(name: str, values: list[str]) -> Column:
    c = F.coalesce(F.col(name), F.lit(OTHER))
    return F.when(c.isin(values), c).otherwise(OTHER)


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, seed: int = 5, share: float = SHARE, topic: Column | None = None) -> DataFrame:
    """docs (doc_id, text, source, lang, ...) with n_tokens (words), topic, weight, probability and kept added.

    targets: per column source, lang and topic the wanted share of each value; for a column without, the observed shares to POWER. Values
    beyond the targets are one class, and in a column without targets those with less than `share` of the tokens. The largest weight has probability 1, so nothing is sampled twice and
    the kept tokens' marginals are the targets in expectation. Null values are of the class (other); texts without words have no tokens and the weight of their cell, or 1 if it is empty.
    Rows equal in doc_id and text share their fate. Columns of docs with the added names are replaced, others of any name stay; an empty table gives no rows.
    """
    added = ["n_tokens", "topic", "weight", "probability", "kept"]
    keep = docs.drop(*added)
    name = lambda c: f"__{c}_{tag}"
    tag = next(i for i in itertools.count() if not any(x.lower() in {f"__{c}_{i}" for c in ("words", *COLUMNS)} for x in docs.columns))
    words = F.col(name("words"))
    base = keep.withColumn(name("words"), shared.words(F.col("text")))
    base = base.withColumn("n_tokens", F.size(words).cast("long")).withColumn("topic", topic if topic is not None else topic_of(words)).drop(name("words"))
    sums = shared.written(base.groupBy(*COLUMNS).agg(F.sum("n_tokens").alias("n")), "token-cells")
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    values, wanted = [], []
    for c in COLUMNS:
        goal = (targets or {}).get(c)
        by = sums.groupBy(F.coalesce(c, F.lit(OTHER)).alias("v")).agg(F.sum("n").alias("n"))
        by = by.filter(F.col("v").isin(list(goal)) if goal else F.col("n") >= share * total)
        seen = {r.v: r.n / max(total, 1) for r in by.collect()}  # as many rows as targets, or at most 1 / share
        own = sorted(set(seen) & set(goal) if goal else seen)
        own = [v for v in own if v != OTHER]
        rest = max(0.0, 1 - sum(seen[v] for v in own))
        shares = [goal[v] for v in own] + [max(0.0, 1 - sum(goal[v] for v in own))] if goal else [seen[v] ** POWER for v in own] + [rest**POWER]
        values.append(own + [OTHER])
        wanted.append(np.array(shares))
    classes = [_class(c, v[:-1]).alias(name(c)) for c, v in zip(COLUMNS, values)]
    observed = np.zeros([len(v) for v in values])
    for r in sums.groupBy(*classes).agg(F.sum("n").alias("n")).collect():
        observed[tuple(v.index(r[name(c)]) for c, v in zip(COLUMNS, values))] = r.n
    fitted = rake(observed, wanted)
    weight = np.divide(fitted, observed, out=np.zeros_like(fitted), where=observed > 0)
    most = float(weight.max(initial=0)) or 1.0
    cells = [(*(v[i] for v, i in zip(values, at)), float(weight[at])) for at in zip(*np.nonzero(observed))]
    table = docs.sparkSession.createDataFrame(cells, ", ".join([*(f"{name(c)} string" for c in COLUMNS), "weight double"]))
    out = base.select("*", *classes).join(F.broadcast(table), [name(c) for c in COLUMNS], "left")
    weight_of = F.coalesce("weight", F.lit(1.0))
    p = F.least(F.lit(1.0), weight_of / most)
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) / F.lit(2.0**53)
    return out.select(*keep.columns, "n_tokens", "topic", weight_of.alias("weight"), p.alias("probability"), (u < p).alias("kept"))


def op2_mixture(spark, sf_dir):
    """Weight, probability and fate of all documents under flattened shares of source, language and topic."""
    return mixed(shared.table(spark, sf_dir, "documents")).drop("text", "n_chars")
