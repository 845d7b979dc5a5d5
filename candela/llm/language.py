"""Languages of a text as a mixture, by expectation-maximisation over n-gram likelihoods.

Character trigrams (letters, white space where none) fall into hashed classes; a language is a smoothed
distribution over the classes, counted from all labelled texts. A document is a mixture of languages whose
proportions EM finds from its trigrams. How many languages it holds is chosen by penalised likelihood: sets
grow by the next largest proportion, and a set of k costs ``penalty * (k - 1) / 2 * ln(n)`` (trigrams overlap,
so the penalty is three times the usual). Where the mixture of all languages beats the best single one by less
than a second language costs, no larger set can win, and the single language stands.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import fold_of, ship, slices, texts

BITS = 14
STEPS = 12
PENALTY = 3.0
SMOOTH = 0.5
#: Learning never sees rows whose crc32(id) modulo FOLDS is HELD.
FOLDS, HELD = 3, 1


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(part: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, class) of every trigram of ``part`` whose middle is a letter, document by document."""
    lowered = [t.lower() for t in part]
    points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(part), dtype=np.uint32), [len(t) + 1 for t in lowered])
    letter = _letters()[points]
    points = np.where(letter, points, np.uint32(32))
    middle = np.flatnonzero(letter[1:-1])
    a, b, c = points[middle], points[middle + 1], points[middle + 2]
    h = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return owner[middle], h >> np.uint32(32 - BITS)


def fit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages in code point order, log probabilities [class, language]) from every row given with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for start, stop in slices(batch):
                part = texts(batch, start, stop)
                owner, cls = grams(part)
                names = sorted(set(langs[start:stop]))
                at = np.array([names.index(x) for x in langs[start:stop]])
                found = np.bincount((at[owner].astype(np.int64) << BITS) + cls, minlength=len(names) << BITS).reshape(len(names), -1)
                for name, row in zip(names, found, strict=True):
                    held[name] = held[name] + row if name in held else row.astype(np.int64)
        for name, row in sorted(held.items()):
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(row[used], pa.int64())], names=["lang", "cls", "n"])

    rows = docs.where(F.col(lang_column).isNotNull()).select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    sums = rows.mapInArrow(count, "lang string, cls int, n long").groupBy("lang", "cls").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(sums.column("lang").to_pylist()))  # at most 2**BITS sums a language reach the driver
    table = np.full((1 << BITS, len(names)), SMOOTH)
    place = {x: i for i, x in enumerate(names)}
    if names:
        np.add.at(table, (sums.column("cls").to_numpy(), [place[x] for x in sums.column("lang").to_pylist()]), sums.column("n").to_numpy())
    return names, np.log(table / table.sum(axis=0, keepdims=True))


def _proportions(p: np.ndarray, doc: np.ndarray, n: np.ndarray, starts: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """EM: (proportions [document, language], log likelihood up to each document's own scale)."""
    total = np.add.reduceat(n, starts)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for step in range(steps + 1):
        each = p * share[doc]
        whole = each.sum(axis=1)
        if step == steps:
            return share, np.add.reduceat(n * np.log(whole), starts)
        share = np.add.reduceat(each * (n / whole)[:, None], starts) / total[:, None]
    raise AssertionError


def infer(part: list[str], names: list[str], logp: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> list[list[tuple[str, float]]]:
    """For each text its languages with their proportions, largest first; empty without a letter."""
    out: list[list[tuple[str, float]]] = [[] for _ in part]
    if not names:
        return out
    owner, cls = grams(part)
    if not len(owner):
        return out
    keys, n = np.unique((owner.astype(np.uint64) << np.uint64(BITS)) + cls, return_counts=True)
    ids = (keys >> np.uint64(BITS)).astype(np.int64)
    present, starts = np.unique(ids, return_index=True)
    doc = np.repeat(np.arange(len(present)), np.diff(np.append(starts, len(ids))))
    log = logp[(keys & np.uint64((1 << BITS) - 1)).astype(np.int64)]
    top = log.max(axis=1, keepdims=True)  # the same for all sets of languages, so it may be left out
    log = log - top
    p, n = np.exp(log), n.astype(np.float64)
    total = np.add.reduceat(n, starts)
    single = np.add.reduceat(log * n[:, None], starts)
    best = single.argmax(axis=1)
    best_value = single.max(axis=1)
    share, full = _proportions(p, doc, n, starts, np.ones((len(present), len(names))), steps)
    cost = penalty / 2 * np.log(np.maximum(total, 2))
    for i, d in enumerate(present):
        out[d] = [(names[best[i]], 1.0)]
    mixed = np.flatnonzero(full - cost > best_value)
    if len(mixed):
        rank = np.argsort(-share[mixed], axis=1, kind="stable")
        rows = np.flatnonzero(np.isin(doc, mixed))
        sub = np.searchsorted(mixed, doc[rows])
        cuts = np.searchsorted(sub, np.arange(len(mixed)))
        value = best_value[mixed].copy()
        for k in range(2, len(names) + 1):
            allowed = np.zeros((len(mixed), len(names)))  # a share of 0 stays 0, any other would grow back
            np.put_along_axis(allowed, rank[:, :k], 1.0, axis=1)
            found, like = _proportions(p[rows], sub, n[rows], cuts, allowed, steps)
            better = like - (k - 1) * cost[mixed] > value
            for j in np.flatnonzero(better):
                value[j] = like[j] - (k - 1) * cost[mixed[j]]
                chosen = sorted(((float(found[j, x]), names[x]) for x in rank[j, :k]), key=lambda s: (-s[0], s[1]))
                out[present[mixed[j]]] = [(name, s) for s, name in chosen]
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score (its proportion), langs, shares."""
    ship(docs.sparkSession)
    names, logp = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch):
                found = infer(texts(batch, start, stop), names, logp)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, stop - start),
                        batch.column("held_out").slice(start, stop - start),
                        pa.array([f[0][0] if f else "und" for f in found], pa.string()),
                        pa.array([min(1.0, f[0][1]) if f else 0.0 for f in found], pa.float64()),
                        pa.array([[x for x, _ in f] for f in found], pa.list_(pa.string())),
                        pa.array([[s for _, s in f] for f in found], pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score", "langs", "shares"],
                )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), (fold_of(id_column, FOLDS) == HELD).alias("held_out"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, langs array<string>, shares array<double>")


def languages(docs: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold and name the languages of every whole text.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned. Equal
    proportions go to the language that is first in code point order. Repeated rows are rows of their own;
    extra columns are not read; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    return identify(docs, fit(docs.where(fold_of("doc_id", FOLDS) != HELD)))
