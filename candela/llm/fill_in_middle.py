"""Fill-in-middle transformation by secondary sort.

A text is cut into units (a word with the white space before it, or the white space at the end), its two cut points
come from a hash of the id, and each of its three parts leaves the scan as pieces of at most ``PIECE_UNITS`` units,
keyed by (document, place in the output). Partitioned by document and sorted by that key inside each partition, the
pieces of an output stream past in their order: SHA-256 takes them up one by one, and no text is put together
anywhere. What streams past is also taken apart again at the sentinels, into pieces keyed by (document, place in the
text); a second sort inside the same partitions brings them into that order, without another exchange, and a second
digest tells whether output and form give the text back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import raw_texts, ship, slices

SEED, RATE_PERCENT, SPM_PERCENT = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: A piece has at most so many units, and a longer one (units without end) at most so many bytes.
PIECE_UNITS, PIECE_BYTES = 1024, 1 << 13
#: Parts of a document in the order of its text.
_PREFIX, _MIDDLE, _SUFFIX = 0, 1, 2
#: Parts in the order of the output, with the sentinel before each.
LAYOUTS = {"plain": ((b"", _PREFIX),), "psm": ((PREFIX, _PREFIX), (SUFFIX, _SUFFIX), (MIDDLE, _MIDDLE)), "spm": ((SUFFIX, _SUFFIX), (PREFIX, _PREFIX), (MIDDLE, _MIDDLE))}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

PIECES = "key binary, at int, data binary, doc_id long, n long, form string, prefix_chars long, middle_chars long"
PARTS = "key binary, part int, at int, data binary, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, copies long"
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def unit_ends(raw: bytes) -> np.ndarray:
    """Byte offsets at which the units of ``raw`` end."""
    if not raw:
        return np.empty(0, np.int64)
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(raw))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The four numbers that decide about a document; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def chars(raw: bytes) -> int:
    """Code points of UTF-8 bytes."""
    data = np.frombuffer(raw, np.uint8)
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def pieces_of(raw: bytes, ends: np.ndarray, start: int, stop: int) -> Iterator[bytes]:
    """Units ``start`` to ``stop`` in pieces; one empty piece if there are none."""
    offset = lambda k: int(ends[k - 1]) if k else 0
    for k in range(start, max(stop, start + 1), PIECE_UNITS):
        a, b = offset(k), offset(min(k + PIECE_UNITS, stop))
        for cut in range(a, max(b, a + 1), PIECE_BYTES):
            yield raw[cut : min(cut + PIECE_BYTES, b)]


def plan(doc_id: int | None, raw: bytes, seed: int, rate: int, spm: int) -> tuple[str, np.ndarray, tuple[int, int]]:
    """(form, unit ends, the two cut points in units) of a document."""
    ends = unit_ends(raw)
    h = draws(doc_id, seed)
    cuts = sorted((h[0] % (len(ends) + 1), h[1] % (len(ends) + 1)))
    if not raw or any(s in raw for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return "plain", ends, (len(ends), len(ends))
    return "spm" if h[3] % 100 < spm else "psm", ends, (cuts[0], cuts[1])


class Splitter:
    """Takes an output that arrives in pieces apart at its sentinels, whatever the pieces' borders are."""

    def __init__(self, form: str):
        self.layout, self.now, self.held = LAYOUTS[form], -1, b""

    def feed(self, data: bytes, last: bool) -> Iterator[tuple[int, bytes]]:
        """(part, bytes) of what is certain so far."""
        self.held += data
        while self.now + 1 < len(self.layout):
            sentinel = self.layout[self.now + 1][0]
            at = self.held.find(sentinel)
            if at < 0:
                break
            if self.now >= 0 and at:
                yield self.layout[self.now][1], self.held[:at]
            self.held, self.now = self.held[at + len(sentinel) :], self.now + 1
        more = self.now + 1 < len(self.layout)
        if last and more:
            raise ValueError("a sentinel is missing in an output")
        keep = 2 if more else 0  # the beginning of a sentinel, at most
        if self.now >= 0 and len(self.held) > keep:
            cut = len(self.held) - keep
            yield self.layout[self.now][1], self.held[:cut]
            self.held = self.held[cut:]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the batches, one by one."""
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _packed(rows: Iterator[tuple], schema: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``most`` bytes of data."""
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    arrow = pa.schema([(name, kinds[kind]) for name, kind in fields])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)


def pieces(docs: DataFrame, seed: int = SEED, rate: int = RATE_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """The pieces of every output, one row each; the first one (``at`` 0) also has what is known of the document.

    ``key`` stands for (id, text, input partition). Rows repeated with the same id and text in one partition share a
    key: their pieces are equal and arrive side by side.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = TaskContext.get().partitionId().to_bytes(4, "big")

        def rows() -> Iterator[tuple]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for start, stop in slices(batch):
                    for doc_id, raw in zip(ids[start:stop], raw_texts(batch, start, stop), strict=True):
                        form, ends, (one, two) = plan(doc_id, raw, seed, rate, spm)
                        bounds = {_PREFIX: (0, one), _MIDDLE: (one, two), _SUFFIX: (two, len(ends))}
                        key = hashlib.sha256(b"%d:" % (-1 if doc_id is None else doc_id) + (b"" if doc_id is None else b"+") + raw).digest()[:16] + where
                        known = (doc_id, len(ends), form, None, None)
                        if form != "plain":
                            a, b = (int(ends[k - 1]) if k else 0 for k in (one, two))
                            known = (doc_id, len(ends), form, chars(raw[:a]), chars(raw[a:b]))
                        at = 0
                        for sentinel, part in LAYOUTS[form]:
                            for data in pieces_of(raw, ends, *bounds[part]):
                                yield (key, at, sentinel + data, *(known if at == 0 else (None,) * 5))
                                sentinel, at = b"", at + 1

        yield from _packed(rows(), PIECES)

    return docs.mapInArrow(cut, PIECES)


def _digest_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces in; out: what is known of every output with its digest (``at`` -1), and its parts' pieces."""
    nothing = (None,) * 7

    def rows() -> Iterator[tuple]:
        key, last, known, digest, splitter, copies, n = None, None, (), None, None, 0, 0

        def close() -> Iterator[tuple]:
            for part, data in splitter.feed(b"", True):
                yield key, part, n, data, *nothing
            yield key, -1, -1, None, *known, digest.hexdigest(), copies

        for this, at, data, *more in _rows(batches):
            if this == key and at == last:  # a piece of a repeated row
                copies += at == 0
                continue
            if this != key:
                if key is not None:
                    yield from close()
                key, known, digest, splitter, copies, n = this, more, hashlib.sha256(), Splitter(more[2]), 1, 0
            last = at
            digest.update(data)
            for part, found in splitter.feed(data, False):
                yield key, part, n, found, *nothing
                n += 1
        if key is not None:
            yield from close()

    yield from _packed(rows(), PARTS)


def _digest_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts' pieces in the order of the text in; out: one row per document and repetition."""

    def rows() -> Iterator[tuple]:
        known, digest, copies = None, None, 0
        for _, part, _, data, *more, output, n in _rows(batches):
            if part == -1:
                if known is not None:
                    yield from [(*known, digest.hexdigest())] * copies
                known, digest, copies = (*more, output), hashlib.sha256(), n
            else:
                digest.update(data)
        if known is not None:
            yield from [(*known, digest.hexdigest())] * copies

    yield from _packed(rows(), RESULT)


def _sorted_by_key(docs: DataFrame, seed: int, rate: int, spm: int) -> DataFrame:
    """Pieces partitioned by document and sorted by (document, place in the output)."""
    return pieces(docs, seed, rate, spm).repartition("key").sortWithinPartitions("key", "at")


def _input(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE_PERCENT, spm: int = SPM_PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n (units), form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of these in the order suffix, prefix, middle; a
    text that is empty or holds a sentinel stays plain, with null prefix_chars and middle_chars. Null texts count as
    empty, a null id as empty text where numbers are drawn from it. Repeated rows and ties give a row each, an empty
    table an empty result; other columns are not read. A very long text is read whole by its scan task only;
    afterwards tasks hold a piece at a time. Of rows repeated with one id and text, one a partition is digested.
    """
    ordered = _sorted_by_key(_input(docs, id_column, text_column), seed, rate, spm)
    return ordered.mapInArrow(_digest_outputs, PARTS).sortWithinPartitions("key", "part", "at").mapInArrow(_digest_texts, RESULT)


def transformed(docs: DataFrame, seed: int = SEED, rate: int = RATE_PERCENT, spm: int = SPM_PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The outputs themselves, as ordered pieces to be written: doc_id, form, at, data (pieces after the first have
    no form). Each partition holds whole documents, in order; a row repeated in one partition shows once."""
    ordered = _sorted_by_key(_input(docs, id_column, text_column), seed, rate, spm)

    def unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            last, doc_id = None, None
            for key, at, data, who, _, form, _, _ in _rows(batches):
                if (key, at) != last:
                    doc_id = who if at == 0 else doc_id
                    yield doc_id, form, at, data
                last = key, at

        yield from _packed(rows(), "doc_id long, form string, at int, data binary")

    return ordered.mapInArrow(unique, "doc_id long, form string, at int, data binary")
