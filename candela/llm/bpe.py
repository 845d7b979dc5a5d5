"""Exact BPE encoding by backtracking over longest token matches, and decoding by an offset table.

The tokenizer file's normaliser and pre-tokeniser cut a text into pieces; this module does the merges. It
never runs them one by one. An Aho-Corasick automaton finds the longest token at each place of a piece; the
encoder takes it if the pair (last token, this token) is compatible, that is, if a merge across their
boundary could not have happened; otherwise it tries the next shorter token with the same start, and when
none is left it marks the place as dead and goes back one token. As places are marked at most once, the
work is linear in the piece. The result is the one that merging in rank order gives: a token sequence is
the outcome of BPE if and only if every token is the outcome for its own characters and all neighbours are
compatible, and there is one such sequence.

Compatibility of (l, r) is found by undoing merges along the boundary. Of the two symbols that meet there,
the one made by the later merge is taken apart; the pair that met before existed until that merge, so if the
pair itself merges earlier than that, the boundary would have been lost. (Equal ranks: the leftmost merge
comes first.) Answers are kept in a pair table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import ship, slices, texts
from candela.llm.tokens import MEMO_LENGTH, MEMO_WORDS, byte_alphabet, drops_space, load, simple_pieces, tokenizer_path, words_of

#: Stands for the end-of-word mark; byte-level alphabets do not contain it.
END = "\0"
#: Pairs kept by a task; only memory and speed depend on it.
TABLE_SIZE = 1 << 18


class OffsetTable:
    """Strings for ids in one buffer: entry i is ``buffer[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, entries: list[bytes]):
        self.buffer = np.frombuffer(b"".join(entries), np.uint8)
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])

    def gather(self, ids: np.ndarray) -> bytes:
        """The entries of ``ids``, one after another."""
        out = []
        for k in range(0, len(ids), 1 << 18):
            part = ids[k : k + (1 << 18)]
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            at = np.repeat(self.offsets[part] - ends + sizes, sizes)
            at += np.arange(len(at))
            out.append(self.buffer[at].tobytes())
        return b"".join(out)


class Merges:
    """Merge ranks and parts of a BPE vocabulary, and which tokens may stand side by side."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        n = max(vocab.values()) + 1
        self.rank, self.parts = [-1] * n, [None] * n
        self.text: list[str | None] = [None] * n
        for token, i in vocab.items():
            if len(token) == 1:
                self.text[i] = token
            elif suffix and len(token) == 1 + len(suffix) and token.endswith(suffix):
                self.text[i] = token[0] + END
        for rank, (a, b) in enumerate(merges):
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.pair[left, right] = rank, made
            self.rank[made], self.parts[made] = rank, (left, right)
            if self.text[left] is not None and self.text[right] is not None:
                self.text[made] = self.text[left] + self.text[right]
        self.table: dict[tuple[int, int], bool] = {}

    def _meets(self, left: int, right: int, before: int) -> bool:
        """Whether the boundary of (left, right) outlives every merge of a rank under ``before``."""
        while True:
            found = self.pair.get((left, right))
            if found is not None and found[0] < before:
                return False
            a, b = self.rank[left], self.rank[right]
            if a < 0 and b < 0:
                return True
            if b >= a:  # the right one was made last; at equal rank the pair further left goes first
                before, right = b + 1, self.parts[right][0]
            else:
                before, left = a, self.parts[left][1]

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= TABLE_SIZE:
                self.table.clear()
            known = self.table[key] = self._meets(left, right, len(self.rank))
        return known

    def whole(self) -> list[int]:
        """Ids of the tokens that BPE gives for their own characters."""
        ok = [False] * len(self.rank)
        for i in sorted((i for i, t in enumerate(self.text) if t is not None), key=lambda i: self.rank[i]):
            if self.parts[i] is None:
                ok[i] = True
            else:
                left, right = self.parts[i]
                ok[i] = ok[left] and ok[right] and self._meets(left, right, self.rank[i])
        return [i for i, good in enumerate(ok) if good]


class Encoder:
    """Backtracking encoder for the BPE model of a tokenizers file."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = Merges(model["vocab"], merges, self.suffix)
        self.tokenizer = load(path)
        if not drops_space(path):
            raise ValueError(f"{path}: its tokens may hold white space, so texts cannot be encoded word by word")
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        by_order = "|".join(re.escape(t) for t in sorted(self.special))  # of those that start at one place, the least
        self.special_pattern = re.compile(f"({by_order})") if by_order else None
        self.automaton = ahocorasick.Automaton()
        self.by_text: dict[str, int] = {}
        for i in self.merges.whole():
            text = self.merges.text[i]
            if text not in self.by_text:
                self.by_text[text] = i
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.size = {i: len(t) for t, i in self.by_text.items()}
        self.shorter: dict[int, int] = {}
        self.alphabet = byte_alphabet()
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        n = max(names) + 1
        self.tokens = OffsetTable([names.get(i, "").encode() + b" " for i in range(n)])
        self.numbers = OffsetTable([b"%d " % i for i in range(n)])

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if there is none."""
        known = self.shorter.get(token)
        if known is None:
            text = self.merges.text[token]
            known = next((self.by_text[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.by_text), -1)
            self.shorter[token] = known
        return known

    def piece(self, piece: str) -> list[int]:
        """Token ids of one piece, given in the byte alphabet."""
        whole = piece + END if self.suffix else piece
        n = len(whole)
        longest = [-1] * n
        size = self.size
        for end, (token, length) in self.automaton.iter(whole):
            at = end - length + 1
            if longest[at] < 0 or size[longest[at]] < length:
                longest[at] = token
        out: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest[0]
        compatible, table = self.merges.compatible, self.merges.table
        while at < n:
            if token < 0:  # nothing starts here: go back one token and shorten it
                dead.add(at)
                if not out:
                    raise ValueError(f"{piece!r} has a character outside the vocabulary")
                token = out.pop()
                at -= size[token]
                token = self._shorter(token)
                continue
            end = at + size[token]
            if end not in dead and (not out or (table.get((out[-1], token)) or compatible(out[-1], token))):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                token = self._shorter(token)
        return out

    def _packed(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            known = np.array(self.piece(piece), "<u4").tobytes()
            if len(piece) <= MEMO_LENGTH:
                if len(self.pieces) >= MEMO_WORDS:
                    self.pieces.clear()
                self.pieces[piece] = known
        return known

    def _bytes(self, text: str) -> str:
        return text if text.isascii() and text.isprintable() and " " not in text else "".join(map(self.alphabet.__getitem__, text.encode()))

    def _fresh(self, word: str) -> bytes:
        """Ids of any string: special strings first, then normaliser, pre-tokeniser and merges."""
        parts = self.special_pattern.split(word) if self.special_pattern else [word]
        out = []
        for k, part in enumerate(parts):  # every second part is a special string
            if k % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
                out.extend(self._packed(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))
        return b"".join(out)

    def _learn(self, words: list[str]) -> None:
        """A word of Latin letters, with a full stop, comma or the like behind it or not, is normalised and cut
        here; all others go through the library's normaliser and pre-tokeniser."""
        for word in words:
            found = simple_pieces(word)
            if found is None:
                self.words[word] = self._fresh(word)
            else:
                core, mark = found
                self.words[word] = self._packed(self._bytes(core)) + (self._packed(mark) if mark else b"")

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text."""
        words, memo = words_of(text), self.words
        new = set(words).difference(memo)
        long = {w: self._fresh(w) for w in new if len(w) > MEMO_LENGTH}
        if new:
            short = [w for w in new if w not in long]
            if len(memo) + len(short) > MEMO_WORDS:
                memo.clear()
                short = list({w for w in words if w not in long})
            self._learn(short)
        parts = [long[w] if w in long else memo[w] for w in words] if long else map(memo.__getitem__, words)
        return np.frombuffer(b"".join(parts), "<u4")

    def forget(self) -> None:
        """Let go of what texts have taught: the tokenizer alone is kept."""
        self.words, self.pieces = {}, {}
        self.merges.table.clear()

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens joined by a space, which is what a file without a decoder asks for."""
        return self.tokens.gather(ids)[:-1]

    def decimal(self, ids: np.ndarray) -> bytes:
        return self.numbers.gather(ids)[:-1]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizers file. Workers outlive tasks, so a task empties its memos in the end."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_documents(docs: DataFrame, tokenizer: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids (array of token ids) and decoded (their text) of every whole text; null counts as empty,
    which has no ids and decodes to the empty string."""
    return _run(docs, tokenizer, id_column, text_column, "ids array<long>, decoded string", lambda enc, ids: (ids.tolist(), enc.decode(ids).decode()))


def bpe_digest(docs: DataFrame, tokenizer: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256 of the ids and decoded text that
    ``encode_documents`` gives. Null and empty texts have 0 tokens and the hash of the empty string. Ties and
    repeated rows are rows of their own; extra columns are not read; an empty table gives an empty result."""
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return _run(docs, tokenizer, id_column, text_column, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda enc, ids: (len(ids), sha(enc.decimal(ids)), sha(enc.decode(ids))))


def _encoded(batches: Iterator[pa.RecordBatch], path: str, names: tuple[str, ...], types: tuple[pa.DataType, ...], result) -> Iterator[pa.RecordBatch]:
    """A task's rows: doc_id and what ``result`` makes of the encoder and a text's ids."""
    enc = encoder(path)
    try:
        for batch in batches:
            for start, stop in slices(batch):
                rows = [result(enc, enc.encode(text)) for text in texts(batch, start, stop)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), *columns], names=["doc_id", *names])
    finally:
        enc.forget()


def _run(docs: DataFrame, tokenizer: str | None, id_column: str, text_column: str, schema: str, result) -> DataFrame:
    ship(docs.sparkSession)
    path = tokenizer or tokenizer_path()
    kinds = {"array<long>": pa.list_(pa.int64()), "long": pa.int64(), "string": pa.string()}
    names, types = zip(*((f.split(" ")[0], kinds[f.split(" ")[1]]) for f in schema.split(", ")), strict=True)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(lambda batches: _encoded(batches, path, names, types, result), f"doc_id long, {schema}")
