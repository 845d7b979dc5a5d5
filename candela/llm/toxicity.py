"""Toxicity by a factorization machine over hashed terms.

Terms are words and word beginnings. Each gives hashed features: that it occurs, and that its count per word
of text reaches a level (on a logarithmic scale). The features that tell the classes of a bounded labelled sample apart (log-likelihood ratio) enter the machine, whose score

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

also weighs pairs, an insult together with the mention of a group for one, which linear weights alone cannot
tell from either part.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import ship, slices, texts
from candela.llm.labelled import held_out, prior, sample
from candela.llm.tokens import MEMO_LENGTH, words_of

BITS = 20
SHORTEST, LONGEST = 3, 8
#: Labelled documents of each class that are learned from, at most.
PER_CLASS = 3000
#: Features of the machine, at most; each occurs in LEAST sampled documents or more.
FEATURES, LEAST = 3000, 5
FACTORS, EPOCHS, RATE, L2 = 8, 40, 0.1, 2e-3
THRESHOLD = 0.3
#: Words of a reader's memo until it becomes the older one, from which words met again come back; words whose terms are
#: spread out at once; features that a task counts before it hands them on. Only memory and speed depend on them.
MEMO_WORDS, BLOCK_WORDS, FLUSH_FEATURES = 1 << 16, 1 << 16, 1 << 18
_STRIP = ".,;:!?\"'()[]{}|*%&$#<>-_/\\"


def terms(word: str) -> list[int]:
    """Hashes of a word's terms: the word itself and its beginnings."""
    w = word.strip(_STRIP).lower()
    if len(w) < SHORTEST:
        return []
    crc, cut, raw = zlib.crc32, 32 - BITS, w.encode("utf-8", "replace")
    first = [raw[:k] if len(raw) == len(w) else w[:k].encode("utf-8", "replace") for k in range(SHORTEST, min(len(w), LONGEST) + 1)]
    return [crc(b"=" + raw) >> cut, *(crc(b"^" + start) >> cut for start in first)]


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct ``keys`` in order, and the sums of each of the ``counts`` over equal ones."""
    names, place = np.unique(keys, return_inverse=True)
    return names, *(np.bincount(place, c, len(names)).astype(np.int64) for c in counts)


def density(counts: np.ndarray, n: int) -> np.ndarray:
    """Level 1 to 10 of each count: doubling of the count per 512 words."""
    return 1 + np.minimum(9, np.frexp(512 * counts // n)[1])  # the exponent is the bit length


def document_features(words: list[str], memo: dict[str, bytes]) -> np.ndarray:
    """Features of one document in order: 16 times a term's hash, plus 0 (the term occurs) and every density level
    that it reaches. ``memo`` gives the packed terms of each of its words."""
    found, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for k in range(0, len(words), BLOCK_WORDS):
        more, n = np.unique(np.frombuffer(b"".join(map(memo.__getitem__, words[k : k + BLOCK_WORDS])), np.uint32), return_counts=True)
        found, counts = summed(np.concatenate((found, more)), np.concatenate((counts, n))) if k else (more, n)
    sizes = density(counts, len(words)) + 1
    ends = np.cumsum(sizes)
    return np.repeat(found.astype(np.int32) << 4, sizes) + (np.arange(len(sizes) and ends[-1], dtype=np.int32) - np.repeat((ends - sizes).astype(np.int32), sizes))


class Reader:
    """Terms of words, kept for a task; with ``wanted``, only terms that can give a wanted feature."""

    def __init__(self, wanted: set[int] | None = None):
        self.wanted = None if wanted is None else np.array(sorted(wanted), np.int32)
        self.wanted_terms = None if wanted is None else {f >> 4 for f in wanted}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _terms(self, word: str) -> bytes:
        found = terms(word)
        return array("I", found if self.wanted_terms is None else self.wanted_terms.intersection(found)).tobytes()

    def features(self, text: str) -> np.ndarray:
        """Features of a text, those wanted, in order."""
        words = words_of(text)
        memo = self.memo
        new = set(words).difference(memo)
        if len(memo) + len(new) > MEMO_WORDS:
            self.older, self.memo = memo, (memo := {})
            new = set(words)
        older = self.older
        memo.update((w, older[w] if w in older else self._terms(w)) for w in new)
        out = document_features(words, memo)
        for w in new:
            if len(w) > MEMO_LENGTH:
                del memo[w]
        return out if self.wanted is None else np.intersect1d(out, self.wanted, assume_unique=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of label 0 and of label 1 (a, b) hold a feature. A feature may come again, in a later batch, when
    more than ``FLUSH_FEATURES`` have been met."""
    reader = Reader()
    counts = nothing = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    held: list[tuple[np.ndarray, int]] = []

    def added() -> tuple[np.ndarray, ...]:
        ones = np.repeat([y for _, y in held], [len(x) for x, _ in held])
        keys = [x for x, _ in held]
        held.clear()
        return summed(np.concatenate((counts[0], *keys)), np.concatenate((counts[1], 1 - ones)), np.concatenate((counts[2], ones)))

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in counts], names=["feature", "a", "b"])

    total = 0
    for batch in batches:
        ys = batch.column("y").to_pylist()
        for start, stop in slices(batch):
            for k, text in enumerate(texts(batch, start, stop), start):
                held.append((reader.features(text), ys[k]))
                total += len(held[-1][0])
                if total >= FLUSH_FEATURES:
                    counts, total = added(), 0
                    if len(counts[0]) >= FLUSH_FEATURES:
                        yield packed()
                        counts = nothing
    if held:
        counts = added()
    yield packed()


def _select(rows: DataFrame, n: dict[int, int], most: int) -> list[int]:
    """The features that tell the classes apart best: log-likelihood ratio of their document counts."""

    def part(x: str, total: int) -> str:  # x * ln(p) + (total - x) * ln(1 - p) at its own share
        return f"(if({x} > 0, {x} * ln({x} / {total}), 0) + if({total} > {x}, ({total} - {x}) * ln(({total} - {x}) / {total}), 0))"

    both = n[0] + n[1]
    ratio = F.expr(f"{part('a', n[0])} + {part('b', n[1])} - {part('(a + b)', both)}")
    found = (
        rows.mapInArrow(_counted, "feature long, a long, b long")
        .groupBy("feature")
        .agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
        .where(F.col("a") + F.col("b") >= LEAST)
        .withColumn("ratio", ratio)
        .where("ratio > 6")
        .orderBy(F.desc("ratio"), "feature")
        .limit(most)
        .collect()
    )
    return sorted(r["feature"] for r in found)


def _vectors(rows: DataFrame, features: list[int]) -> list[tuple[int, list[int]]]:
    wanted = set(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(wanted)
        for batch in batches:
            for start, stop in slices(batch):
                x = [reader.features(t) for t in texts(batch, start, stop)]
                yield pa.RecordBatch.from_arrays([batch.column("y").slice(start, stop - start), pa.array(x, pa.list_(pa.int64()))], names=["y", "x"])

    return sorted((r["y"], list(r["x"])) for r in rows.mapInArrow(run, "y int, x array<long>").collect())


def margin(w0: float, w: np.ndarray, v: np.ndarray, where: np.ndarray, index: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Machine output of ``n`` documents (``index`` holds their features, ``where`` the document of each), and the factor sums."""
    sums = np.zeros((n, v.shape[1]))
    np.add.at(sums, where, v[index])
    squares = np.bincount(where, (v[index] ** 2).sum(axis=1), n)
    return w0 + np.bincount(where, w[index], n) + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def train(samples: list[tuple[int, list[int]]], n_features: int, share: float, seed: int = 5) -> tuple[float, np.ndarray, np.ndarray]:
    """Adagrad on the weighted log loss; sampled classes are weighted back to their share."""
    rng = np.random.default_rng(seed)
    y = np.array([s[0] for s in samples], float)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    weight = np.sqrt(weight)  # half-way to balanced classes: fewer misses at a low threshold
    w0, w, v = float(np.log(share / (1 - share))), np.zeros(n_features), rng.normal(0, 0.02, (n_features, FACTORS))
    g0, gw, gv = 1e-6, np.full(n_features, 1e-6), np.full(v.shape, 1e-6)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(samples))
        for k in range(0, len(order), 256):
            part = order[k : k + 256]
            where = np.repeat(np.arange(len(part)), [len(samples[i][1]) for i in part])
            index = np.concatenate([np.array(samples[i][1], np.int64) for i in part]) if len(where) else np.zeros(0, np.int64)
            z, sums = margin(w0, w, v, where, index, len(part))
            err = weight[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            used = np.bincount(index, minlength=n_features) > 0
            dw = np.bincount(index, err[where], n_features) + L2 * w * used / 10
            dv = np.zeros_like(v)
            np.add.at(dv, index, err[where][:, None] * (sums[where] - v[index]))
            dv += L2 * v * used[:, None]
            g0 += err.sum() ** 2
            gw += dw**2
            gv += dv**2
            w0 -= RATE * err.sum() / np.sqrt(g0)
            w -= RATE * dw / np.sqrt(gw)
            v -= RATE * 0.3 * dv / np.sqrt(gv)
    return w0, w, v


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int = PER_CLASS) -> dict:
    rows, counts = sample(docs, labels, target, per_class, "toxicity-sample")
    n = {0: 0, 1: 0} | {int(r["y"]): int(r["n"]) for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    model: dict = {"prior": prior(counts), "features": [], "w0": None}
    if n[0] and n[1]:
        features = _select(rows, n, FEATURES)
        place = {f: i for i, f in enumerate(features)}
        samples = [(y, [place[f] for f in x]) for y, x in _vectors(rows, features)]
        model["w0"], model["w"], model["v"] = train(samples, len(features), model["prior"])
        model["features"] = features
    return model


def scorer(model: dict):
    """Function from a list of texts to their scores."""
    reader = Reader(set(model["features"]))
    place = {f: i for i, f in enumerate(model["features"])}

    def run(part: list[str]) -> np.ndarray:
        if model["w0"] is None:
            return np.full(len(part), model["prior"])
        found = [[place[f] for f in reader.features(t).tolist()] for t in part]
        where = np.repeat(np.arange(len(part)), [len(f) for f in found])
        index = np.array([i for f in found for i in f], np.int64)
        z, _ = margin(model["w0"], model["w"], model["v"], where, index, len(part))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    return run


def with_score(docs: DataFrame, model: dict, column: str = "__toxicity") -> DataFrame:
    """``docs`` with one more column, the score of its ``text``."""
    ship(docs.sparkSession)
    schema = docs.withColumn(column, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch in batches:
            for start, stop in slices(batch):
                p = score(texts(batch, start, stop))
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], names=[*part.schema.names, column])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """Fit on ``labels`` (doc_id, ``target`` 0/1) and score every whole text: doc_id, held_out, score, predicted.

    Null counts as empty; an empty text has the score of a text without any of the features. Where one class has no
    labelled text, every score is the share of label 1. Null labels and labels other than 0 and 1 are left
    out; labels repeated alike count once. Repeated rows are scored alike; extra columns are not read; an
    empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    scored = with_score(rows, fit(docs, labels, target, per_class), "score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their own columns.

    Null and empty texts are scored as texts without a term; repeated rows and rows without an id are scored one by
    one, by their text alone. A score equal to ``threshold`` is toxic. An empty table gives an empty result."""
    columns = docs.columns
    return with_score(docs, fit(docs, labels, **options)).where(F.col("__toxicity") < threshold).select(*columns)
