"""Quality by compression: a text is like the texts whose dictionary makes it smaller.

Two zstandard dictionaries are trained, one on good and one on bad labelled text. A text is cut into blocks
(all of it, so that a long text does not become its own dictionary), each block is compressed with either
dictionary, and the sizes are summed. The normalised difference (bad - good) / (bad + good) and the
compression ratio, which tells repetition that either dictionary shrinks alike, go through a logistic
calibration fitted on labelled documents that neither dictionary has seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import ship, slices
from candela.llm.common import raw_texts
from candela.llm.labelled import held_out, logistic, prior, sample

BLOCK = 2048
DICTIONARY = 96 * 1024
LEVEL = 3
#: Labelled documents of each class that are learned from, at most: half for the dictionaries, half for the calibration.
PER_CLASS = 3000
#: Blocks that a dictionary is trained on, at most: of all blocks of its documents, those with the smallest hash.
SAMPLE_BLOCKS = 8192
THRESHOLD = 0.7
FEATURES = 5


def blocks(raw: bytes, size: int = BLOCK) -> list[bytes]:
    return [raw[k : k + size] for k in range(0, len(raw), size)]


class Sizer:
    """Compression features of a text under a good and a bad dictionary."""

    def __init__(self, good: bytes, bad: bytes, level: int = LEVEL):
        make = lambda d: zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(d) if d else None, level=level, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        self.good, self.bad = make(good), make(bad)

    def features(self, raw: bytes) -> list[float]:
        """Difference and ratio over the whole text, the least and greatest difference of a block, log length; zeros for an empty text."""
        if not raw:
            return [0.0] * FEATURES
        good, bad = self.good.compress, self.bad.compress
        sizes = np.array([(len(good(b)), len(bad(b)), len(b)) for b in blocks(raw)], np.float64)
        g, b, n = sizes.sum(axis=0)
        each = (sizes[:, 1] - sizes[:, 0]) / (sizes[:, 1] + sizes[:, 0])
        long = sizes[:, 2] >= min(n, BLOCK / 4)
        return [10 * (b - g) / (b + g), np.log((g + b) / (2 * n)), 10 * each[long].min(), 10 * each[long].max(), np.log(n) / 5]


def _expand(x: np.ndarray) -> np.ndarray:
    """Features, their squares and the products with the difference."""
    return np.column_stack([x, x**2, x[:, :1] * x[:, 1:]])


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """Trained dictionary; from very little text, the text itself."""
    total = sum(map(len, texts))
    if not total:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:]


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = PER_CLASS) -> dict:
    """Dictionaries, calibration and the share of label 1, learned from a bounded sample of labelled rows."""
    rows, counts = sample(docs, labels, target, per_class, "quality-sample")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch):
                parts = []
                for raw in raw_texts(batch, start, stop):
                    parts += blocks(raw)
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["block"])

    def text_of(y: int) -> list[bytes]:
        every = rows.where((F.col("part") == 0) & (F.col("y") == y)).mapInArrow(cut, "block binary")
        return [bytes(r["block"]) for r in every.orderBy(F.xxhash64(F.lit(13), "block"), "block").limit(SAMPLE_BLOCKS).collect()]

    texts = {y: text_of(y) for y in (0, 1)}
    model = {"good": _dictionary(sorted(texts[1]), DICTIONARY), "bad": _dictionary(sorted(texts[0]), DICTIONARY), "prior": prior(counts), "beta": None}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(model["good"], model["bad"])
        for batch in batches:
            for start, stop in slices(batch):
                x = [sizer.features(raw) for raw in raw_texts(batch, start, stop)]
                yield pa.RecordBatch.from_arrays([batch.column("y").slice(start, stop - start), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    seen = rows.where("part = 1 and text != ''").mapInArrow(measure, "y int, x array<double>").collect()
    if model["good"] and model["bad"] and len({r["y"] for r in seen}) == 2:
        seen = sorted((r["y"], tuple(r["x"])) for r in seen)
        y = np.array([s[0] for s in seen], float)
        x = _expand(np.array([s[1] for s in seen]))
        # Classes are sampled apart; weights bring back their shares.
        weight = np.where(y == 1, model["prior"] / y.mean(), (1 - model["prior"]) / (1 - y.mean()))
        model["beta"] = logistic(x, y, weight)
    return model


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(model["good"], model["bad"])
        for batch in batches:
            for start, stop in slices(batch):
                texts = raw_texts(batch, start, stop)
                p = np.full(len(texts), model["prior"])
                if model["beta"] is not None:
                    x = _expand(np.array([sizer.features(raw) for raw in texts]))
                    z = np.column_stack([x, np.ones(len(x))]) @ model["beta"]
                    p = np.where([bool(t) for t in texts], 1 / (1 + np.exp(-np.clip(z, -30, 30))), p)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), batch.column("held_out").slice(start, stop - start), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """Fit on ``labels`` (doc_id, ``target`` 0/1) and score every whole text of ``docs``.

    Null and empty texts get the share of label 1; so does every text where one class has no labelled text
    to learn from. Null labels and labels other than 0 and 1 are left out; labels repeated alike count once.
    Every row is scored, repeated rows alike; extra columns are not read; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    return score(docs, fit(docs, labels, target, per_class), threshold)
