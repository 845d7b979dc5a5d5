"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where they agree.

A text longer than one chunk is encoded chunk by chunk with the library, each chunk starting ``overlap`` characters
before the end of the one before. Either cut may tear a word. A place is a stable boundary when a word starts there
behind ASCII white space: no token, piece or normalisation reaches across (see ``tokens``). Two chunks are joined at
the first stable boundary of their overlap, after checking that in both encodings a token starts there and that ids and
offsets are equal from there to the last stable boundary of the overlap; the tokens behind it come from the later
chunk. Where the overlap holds no two such places, or the encodings disagree, the overlap is doubled. Nothing is encoded
for an overlap without boundaries: they are looked for in the text first.

Where widening has come to the start of the earlier chunk (one run without white space, or encodings that never agree),
both are encoded once more as one chunk, which then reaches over the next boundary and is at least twice as long. The
encoded characters therefore stay in proportion to the text. Such a run is held in memory as a whole.

Texts of at most one chunk are encoded word by word through the worker's memo.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import ship, slices, texts
from candela.llm.tokens import WordIds, tokenizer_path, word_ids, words_of

CHUNK = 1 << 16
OVERLAP = 256
LIMIT = 2048
#: Not ``\S`` alone: other white space than ASCII's gives no token, so nothing could be compared there.
_BOUNDARY = re.compile(r"(?<=[ \t\n\r\x0b\x0c])\S")


class Chunk:
    """The encoding of ``text[start:end]``: token ids, and offsets as places in the whole text."""

    def __init__(self, encode: Callable, text: str, start: int, end: int):
        self.start, self.end = start, end
        self.encoding = encode(text[start:end])
        self.ids: list[int] = self.encoding.ids

    def token_at(self, place: int) -> int | None:
        """The first of the tokens that start at a place of the text, None if no token starts there."""
        token = self.encoding.char_to_token(place - self.start)
        return token if token is not None and self.offset(token)[0] == place else None

    def offset(self, token: int) -> tuple[int, int]:
        first, last = self.encoding.token_to_chars(token)
        return first + self.start, last + self.start


def joint(done: Chunk, later: Chunk, places: list[int]) -> tuple[int, int] | None:
    """(tokens of ``done`` up to the joint, tokens of ``later`` before it): the joint is the first of ``places``, stable boundaries
    inside the overlap, and both encodings agree from it to the last of them. None if they do not."""
    a, b = (done.token_at(places[0]), done.token_at(places[-1])), (later.token_at(places[0]), later.token_at(places[-1]))
    if None in a or None in b or a[1] == a[0] or done.ids[a[0] : a[1]] != later.ids[b[0] : b[1]]:
        return None
    if any(done.offset(a[0] + k) != later.offset(b[0] + k) for k in range(a[1] - a[0])):
        return None
    return a[0], b[0]


def encode_chunked(text: str, encode: Callable, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[int]]:
    """Token ids of ``text``, in order, in parts of about a chunk. ``encode`` gives the library's encoding of a text."""
    done = Chunk(encode, text, 0, min(len(text), chunk))
    start, skip = 0, 0  # the place of the last joint, and the tokens of ``done`` before it
    while done.end < len(text):
        cut, wide, met = done.end, overlap, None
        while met is None and cut - wide > start:
            places = [m.start() for m in _BOUNDARY.finditer(text, cut - wide + 1, cut)]
            if len(places) > 1:
                later = Chunk(encode, text, cut - wide, min(len(text), cut + chunk))
                met = joint(done, later, places)
            wide *= 2
        if met is None:  # nothing to align with: both are encoded again as one
            beyond = _BOUNDARY.search(text, cut)
            end = max(cut + max(chunk, cut - start), beyond.start() + overlap if beyond else len(text))
            done, skip = Chunk(encode, text, start, min(len(text), end)), 0
        else:
            yield done.ids[skip : met[0]]
            done, start, skip = later, places[0], met[1]
    yield done.ids[skip:]


def text_tokens(text: str, memo: WordIds, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Tokens of each part of a text."""
    if len(text) <= chunk:
        return [sum(map(len, memo.ids(words_of(text)))) // 4]
    return [len(part) for part in encode_chunked(text, lambda t: memo.tokenizer.encode(t, add_special_tokens=False), chunk, overlap)]


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (``n_tokens > limit``), n_chunks.

    No begin, end or added special tokens; special strings inside texts as the library's default has them.
    Null and empty texts have 0 bytes and 0 tokens. Ties and repeated rows are rows of their own; extra
    columns are not read; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    path = tokenizer or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_ids(path)
        for batch in batches:
            n_bytes, n_tokens, n_chunks = [], [], []
            for start, stop in slices(batch):
                for text in texts(batch, start, stop):
                    parts = text_tokens(text, memo, chunk, overlap)
                    n_bytes.append(len(text) if text.isascii() else len(text.encode()))
                    n_tokens.append(sum(parts))
                    n_chunks.append(len(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(n_chunks, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks long")
