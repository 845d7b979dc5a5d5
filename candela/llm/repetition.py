"""Quality rules on repetition inside a text: rolling hashes of its word n-grams, and the characters they cover.

The words of a slice of documents become numbers, exact ones by a dictionary. A polynomial hash rolls over them:
the hash of n words is that of n - 1 words times the base plus the next word, so one pass a length serves all
windows. Windows of one document with one hash are compared number by number; should two different windows share
a hash, the slice is hashed again under another base, so results are exact. A window that is found twice has a
beginning that is found twice, so only the shortest length looks at all windows. For each length the characters
inside *repeated* windows (every occurrence after the first) are measured, overlaps once, and for lines those of
every repetition of an earlier line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import raw_texts, ship, slices

#: Words of a window of the base rule, the fewest words of a text, the largest share of words in repeated windows.
BASE_WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: Largest share (percent) of word characters inside repeated n-grams, by n, and inside repeated lines. One line that a
#: short text of 60 words holds twice stays below all of them.
NGRAM_PERCENT = {5: 20, 6: 19, 7: 18, 8: 17, 9: 16, 10: 15}
LINE_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
BLOCK_BYTES = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(raw: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of ``raw``, about ``size`` bytes of text at a time; no word is cut."""
    start = 0
    while start < len(raw):
        gap = _GAP.search(raw, start + size)
        stop = gap.start() if gap else len(raw)
        yield raw[start:stop].split()
        start = stop


def numbered(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of every word, its document, code points by word number) over all texts of a slice."""
    numbers: dict[bytes, int] = {}
    parts, counts = [np.empty(0, np.int64)], []
    for raw in raws:
        n = 0
        for words in word_blocks(raw):
            parts.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64))
            n += len(words)
        counts.append(n)
    chars = np.array([len(w.decode("utf-8", "replace")) for w in numbers], np.int64)
    return np.concatenate(parts), np.repeat(np.arange(len(raws)), counts), chars


def _values(ids: np.ndarray, owner: np.ndarray, seed: int) -> np.ndarray:
    """A spread 64-bit value for each (document, word)."""
    x = ids.astype(np.uint64) + (owner.astype(np.uint64) << np.uint64(40)) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def repeated_windows(ids: np.ndarray, owner: np.ndarray, lengths: tuple[int, ...], hash_bits: int = 64) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length n: (starts of the windows found before in their document, starts of all found twice or more)."""
    end = np.searchsorted(owner, owner, side="right")
    seed = 0
    while True:
        found = _repeated(ids, owner, end, lengths, seed, hash_bits)
        if found is not None:
            return found
        seed, hash_bits = seed + 1, 64


def _repeated(ids, owner, end, lengths, seed, hash_bits):
    """``repeated_windows`` under one base, or None if two different windows have one hash."""
    value, base = _values(ids, owner, seed), np.uint64(0xD6E8FEB86659FD93 + 2 * seed)
    rolled, reach, found = value.copy(), 1, {}
    starts = np.arange(len(ids))
    for n in sorted(lengths):
        while reach < n:
            rolled = rolled[:-1] * base + value[reach:] if len(rolled) else rolled
            reach += 1
        starts = starts[starts + n <= end[starts]]
        key = rolled[starts] >> np.uint64(64 - hash_bits)
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order][1:] == key[order][:-1])
        first, later = starts[order[same]], starts[order[same + 1]]
        if (owner[first] != owner[later]).any() or any((ids[first + j] != ids[later + j]).any() for j in range(n)):
            return None
        starts = np.union1d(first, later)
        found[n] = (np.unique(later), starts)
    return found


def covered(size: int, starts: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``size`` words lies in a window of ``n`` words that begins at one of ``starts``."""
    change = np.zeros(size + 1, np.int64)
    change[starts] += 1
    change[starts + n] -= 1
    return np.cumsum(change[:-1]) > 0


def repeated_lines(raw: bytes) -> tuple[int, int]:
    """(lines with a word that equal an earlier line, code points of their words)."""
    seen: set[bytes] = set()
    lines = chars = 0
    for line in raw.split(b"\n") if b"\n" in raw else ():
        if line in seen:
            lines += 1
            chars += sum(len(w.decode("utf-8", "replace")) for w in line.split())
        elif line and not line.isspace():
            seen.add(line)
    return lines, chars


def profile(raws: list[bytes], percents: dict[int, int] | None = None, hash_bits: int = 64) -> dict[str, np.ndarray]:
    """Counts of every text of a slice: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    dup_line_chars and dup_chars_<n> for each n of ``percents``."""
    percents = NGRAM_PERCENT if percents is None else percents
    ids, owner, chars = numbered(raws)
    size, per = len(ids), lambda mask, weight=None: np.bincount(owner[mask], None if weight is None else weight[mask], len(raws)).astype(np.int64)
    every, width = np.ones(size, bool), chars[ids] if size else np.empty(0, np.int64)
    out = {"n_words": per(every), "word_chars": per(every, width), "n_symbols": np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raws], np.int64)}
    lines = np.array([repeated_lines(r) for r in raws], np.int64).reshape(-1, 2)
    out["n_dup_lines"], out["dup_line_chars"] = lines[:, 0], lines[:, 1]
    found = repeated_windows(ids, owner, tuple({*percents, BASE_WINDOW}), hash_bits)
    out["n_repeat_words"] = per(covered(size, found[BASE_WINDOW][1], BASE_WINDOW))
    for n in percents:
        out[f"dup_chars_{n}"] = per(covered(size, found[n][0], n), width)
    return out


def repetition(
    docs: DataFrame, percents: dict[int, int] | None = None, line_percent: int = LINE_PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, the counts of ``profile``, base_failed, kept.

    ``base_failed``: under ``MIN_WORDS`` words, or over ``MAX_REPEAT_PERCENT`` percent of the words in windows of
    ``BASE_WINDOW`` words found twice or more. ``kept``: not that, and for no n more than ``percents[n]`` percent
    of the word characters in repeated n-grams, nor more than ``line_percent`` percent in repeated lines.
    Words are runs without ASCII white space, lines are split at line feeds; both compare exactly. A null text
    counts as empty: no word, not kept. Repeated rows and ties are rows of their own, a null id stays null, an
    empty table gives an empty result, other columns are not read. One pass, no shuffle; a very long text is
    held by one task, with about ten numbers for each of its words.
    """
    ship(docs.sparkSession)
    percents = dict(NGRAM_PERCENT if percents is None else percents)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_chars_{n}" for n in percents)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch):
                got = profile(raw_texts(batch, start, stop), percents)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), *(pa.array(got[c]) for c in counts)], names=["doc_id", *counts])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    measured = rows.mapInArrow(measure, "doc_id long, " + ", ".join(f"{c} long" for c in counts))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    over = 100 * F.col("dup_line_chars") > line_percent * F.col("word_chars")
    for n, percent in percents.items():
        over = over | (100 * F.col(f"dup_chars_{n}") > percent * F.col("word_chars"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)
