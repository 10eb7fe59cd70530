"""Language of whole texts by a linear-chain conditional random field over words.

A word's features are its byte n-grams between boundary marks (those at a mark are its affixes) and the word
itself, hashed to a table of weights per language. Transitions between languages are learned too, from sequences of
which a part is joined from two languages, as in code-switched text. Forward-backward gives each word's posterior
in its text; a text's language is the one with the largest sum of posteriors over words with letters.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doctables.llm import shared

BUCKETS = 1 << 17
SAMPLE_DOCS = 4000
SAMPLE_WORDS = 48
BATCH_BYTES = 2 << 20
BLOCK = 128
CACHE = 400_000
CHUNK = 8192
_LETTER = re.compile(r"[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether a text has a letter of any script; signs for numbers are none."""
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text))


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, number of features of each word): n-grams of 1 to 4 bytes of ^word$, and the word."""
    marked = [b"\x02" + w + b"\x03" for w in words]
    size = np.array([len(m) for m in marked])
    b = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    ends = np.cumsum(size)
    left = np.repeat(ends, size) - np.arange(len(b))  # bytes of the word from here on
    out, of = [], []
    code = np.zeros(len(b), np.uint64)
    for n in range(1, 5):
        code[: len(b) - n + 1] = (code[: len(b) - n + 1] << np.uint64(8)) | b[n - 1 :]
        inside = left >= n
        h = (code[inside] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
        out.append((h >> np.uint64(47)).astype(np.int64))
        of.append(word[inside])
    place = np.arange(len(b)) - np.repeat(ends - size, size)
    whole = np.add.reduceat((b + np.uint64(1)) * _powers(int(size.max()))[place], ends - size) if len(b) else b
    out.append(((whole * np.uint64(0x94D049BB133111EB)) >> np.uint64(47)).astype(np.int64))
    of.append(np.arange(len(words)))
    bucket, owner = np.concatenate(out), np.concatenate(of)
    by = np.argsort(owner, kind="stable")
    return bucket[by], np.bincount(owner, minlength=len(words))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64))


def _sums(weights: np.ndarray, bucket: np.ndarray, count: np.ndarray) -> np.ndarray:
    if not len(count):
        return np.zeros((0, weights.shape[1]))
    return np.add.reduceat(weights[bucket], np.cumsum(count) - count, axis=0)


def posteriors(emit: np.ndarray, start: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(posterior, forward message) of every label at every word of texts on end; start marks first words.

    The words are cut into blocks. A block's steps are multiplied to one matrix, all blocks at a time; a pass
    over the blocks gives each one's incoming forward and backward message; then all blocks run side by side.
    The result is that of a plain forward-backward over each text.
    """
    n, k = emit.shape
    blocks = -(-n // BLOCK)
    e = np.ones((blocks * BLOCK, k))
    # one array of this size after the other is let go of: they are most of what a worker holds
    np.subtract(emit, emit.max(1, keepdims=True), out=e[:n])
    del emit
    np.maximum(e[:n], -30, out=e[:n])
    np.exp(e[:n], out=e[:n])
    s = np.ones(blocks * BLOCK, bool)
    s[:n] = start
    e, s = e.reshape(blocks, BLOCK, k), s.reshape(blocks, BLOCK)
    a = np.exp(trans - trans.max())
    p = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for t in range(BLOCK):
        step = (p.reshape(-1, k) @ a).reshape(blocks, k, k)
        fresh = s[:, t]
        step[fresh] = p[fresh].sum(2, keepdims=True)
        p = step * e[:, t, None, :]
        if t % 8 == 7:
            p /= p.max((1, 2), keepdims=True)
    into, back = np.ones((blocks, k)), np.ones((blocks, k))
    for b in range(blocks - 1):
        m = into[b] @ p[b]
        into[b + 1] = m / m.sum()
    for b in range(blocks - 1, 0, -1):
        m = p[b] @ back[b]
        back[b - 1] = m / m.sum()
    alpha = np.empty((blocks, BLOCK, k))
    m = into
    for t in range(BLOCK):
        m = np.where(s[:, t, None], 1.0, m @ a) * e[:, t]
        m = m / m.sum(1, keepdims=True)
        alpha[:, t] = m
    gamma = np.empty_like(alpha)
    m = back
    for t in range(BLOCK - 1, -1, -1):
        gamma[:, t] = alpha[:, t] * m
        m = np.where(s[:, t, None], 1.0, (e[:, t] * m) @ a.T)
        m = m / m.sum(1, keepdims=True)
    del e
    gamma = gamma.reshape(-1, k)[:n]
    gamma /= gamma.sum(1, keepdims=True)
    return gamma, alpha.reshape(-1, k)[:n]


def train(sequences: list[list[bytes]], labels: list[np.ndarray], k: int, epochs: int = 6, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights of buckets x labels, transitions) by adaptive gradient steps on the conditional likelihood with L2."""
    rng = np.random.default_rng(seed)
    weights, trans = np.zeros((BUCKETS, k)), np.zeros((k, k))
    g_w, g_t = np.full((BUCKETS, k), 1e-2), np.full((k, k), 1e-2)
    made = [features(s) for s in sequences]
    for _ in range(epochs):
        order = rng.permutation(len(sequences))
        for at in range(0, len(order), 128):
            own = order[at : at + 128]
            bucket, count = (np.concatenate([made[i][j] for i in own]) for j in (0, 1))
            gold = np.concatenate([labels[i] for i in own])
            start = np.zeros(len(gold), bool)
            start[np.cumsum([0] + [len(labels[i]) for i in own[:-1]])] = True
            emit = _sums(weights, bucket, count)
            post, alpha = posteriors(emit, start, trans)
            delta = post.copy()
            delta[np.arange(len(gold)), gold] -= 1
            spread = np.repeat(delta, count, axis=0)
            grad = np.stack([np.bincount(bucket, spread[:, j], BUCKETS) for j in range(k)], 1) / len(own) + 1e-5 * weights
            # Expected transitions: of the posterior of a label, the part that came from each label before.
            nxt = np.flatnonzero(~start)
            came = alpha[nxt - 1][:, :, None] * np.exp(trans)
            joint = came / came.sum(1, keepdims=True) * post[nxt][:, None, :]
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[nxt - 1], gold[nxt]), 1)
            grad_t = (joint.sum(0) - seen) / len(own) + 1e-3 * trans
            g_w += grad**2
            g_t += grad_t**2
            weights -= 0.3 * grad / np.sqrt(g_w)
            trans -= 0.1 * grad_t / np.sqrt(g_t)
    return weights.astype(np.float32), trans


def sample(docs: DataFrame, per_lang: int, width: int) -> DataFrame:
    """(lang, words): a window of `width` words from a place by hash, of up to per_lang documents of each language, by hash."""
    keyed = docs.filter("lang is not null and doc_id is not null").select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    # Thin out by hash first, so that the ranking sees few rows of a frequent language.
    n = keyed.groupBy("lang").agg(F.count("*").alias("n"))
    share = keyed.join(n, "lang").filter(F.pmod("h", F.lit(1 << 20)) * F.col("n") <= F.lit(float(3 * per_lang + 64)) * (1 << 20))
    chosen = share.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).filter(F.col("r") <= per_lang)
    # Written, so that Spark knows how few they are and does not shuffle all texts to meet them.
    chosen = shared.written(chosen.select("doc_id", "h"), "sample")
    cut = docs.join(chosen, "doc_id").select("doc_id", "lang", "h", shared.words(F.lower("text")).alias("w"))
    place = F.pmod(F.shiftright("h", 20), F.greatest(F.lit(1), F.size("w") - width + 1)).cast("int") + 1
    return cut.filter(F.size("w") > 0).select("doc_id", "lang", F.slice("w", place, width).alias("words")).orderBy("doc_id")


class Model:
    """Labels, weights and transitions; small and of fixed size, sent with the tasks."""

    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray) -> None:
        self.labels, self.weights, self.trans = labels, weights, trans


def learned(docs: DataFrame, per_lang: int = SAMPLE_DOCS // 4, width: int = SAMPLE_WORDS) -> Model:
    """Fit on a sample of at most per_lang windows of `width` words per language of docs (doc_id, text, lang)."""
    rows = sample(docs, per_lang, width).collect()
    labels = sorted({r.lang for r in rows})
    index = {x: i for i, x in enumerate(labels)}
    rng = np.random.default_rng(11)
    sequences, gold = [], []
    for r in rows:
        sequences.append([w.encode("utf-8", "surrogatepass") for w in r.words])
        gold.append(np.full(len(r.words), index[r.lang]))
    for _ in range(len(rows) // 3):  # code-switched: the first part of one window, then the last part of another
        i, j = rng.integers(len(rows), size=2)
        a, b = len(sequences[i]) // 2, len(sequences[j]) // 2
        sequences.append(sequences[i][:a] + sequences[j][b:])
        gold.append(np.concatenate([gold[i][:a], gold[j][b:]]))
    keep = [i for i, s in enumerate(sequences) if s]
    weights, trans = train([sequences[i] for i in keep], [gold[i] for i in keep], len(labels)) if labels else (np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)))
    return Model(labels, weights, trans)


class Emissions:
    """Scores of words met by a worker, in a bounded cache."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.rows = np.zeros((1 << 12, self.weights.shape[1]))
        self.letters = np.zeros(1 << 12, bool)

    def of(self, words: list[bytes]) -> np.ndarray:
        """Row of each word."""
        new = list(set(words).difference(self.index))
        if len(self.index) + len(new) > CACHE:
            self.clear()
            new = list(set(words))
        if new:
            a, b = len(self.index), len(self.index) + len(new)
            while b > len(self.rows):
                self.rows, self.letters = np.concatenate([self.rows, np.zeros_like(self.rows)]), np.concatenate([self.letters, np.zeros_like(self.letters)])
            for at in range(0, len(new), CHUNK):  # the arrays of all features are many times the words
                own = new[at : at + CHUNK]
                self.rows[a + at : a + at + len(own)] = _sums(self.weights, *features(own))
            self.letters[a:b] = [w.isalpha() or has_letter(w.decode("utf-8", "surrogatepass")) for w in new]
            self.index.update(zip(new, range(a, b)))
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score (0 to 1) added.

    Whole texts. Null texts and texts without letters are `und` with score 0, as is every text when nothing was learned.
    Columns of docs with those names are replaced; ties go to the first language in code point order; only text is read.
    """
    base = docs.drop("lang_pred", "score")
    labels, weights, trans = model.labels, model.weights, model.trans
    held = docs.sparkSession.sparkContext.broadcast(weights)  # BUCKETS x labels
    own = uuid.uuid4().hex

    def identify(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = shared.held(own, lambda: Emissions(held.value))
        for batch in shared.batches_of(it, "text", BATCH_BYTES):
            texts = batch.column("text").to_pylist()
            real = [i for i, t in enumerate(texts) if labels and t and has_letter(t)]
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            if real:
                cut = [texts[i].lower().encode("utf-8", "surrogatepass").split() for i in real]
                size = np.array([len(w) for w in cut])
                row = cache.of([w for words in cut for w in words])
                begin = np.cumsum(size) - size
                start = np.zeros(len(row), bool)
                start[begin] = True
                post = posteriors(cache.rows[row], start, trans)[0]
                post *= cache.letters[row][:, None]
                total = np.add.reduceat(post, begin, axis=0)
                best = total.argmax(1)
                score[real] = np.clip(total.max(1) / np.maximum(total.sum(1), 1e-300), 0, 1)
                for i, b in zip(real, best):
                    lang[i] = labels[b]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang), pa.array(score)], [*batch.schema.names, "lang_pred", "score"])
        shared.trim()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema), "lang_pred string, score double"])
    return base.mapInArrow(identify, schema)


def _trained(docs: DataFrame) -> Model:
    return learned(docs.filter(shared.remainder(F.col("doc_id"), 4) != 2))


def known_language(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """Rows whose text has a language: not `und`, with at least that score. Columns stay as they are."""
    found = identified(docs, _trained(docs))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*docs.columns)


def op4_language(spark, sf_dir):
    """Language of all documents, learned from those not held out."""
    docs = shared.table(spark, sf_dir, "documents")
    found = identified(docs.select("doc_id", "text"), _trained(docs))
    return found.select("doc_id", (shared.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
