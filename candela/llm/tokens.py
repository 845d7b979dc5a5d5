"""Tokenizer files and a memo of words, shared by the operators that count, write or encode tokens.

Lemma used throughout: with a tokenizer that drops white space and whose pieces never contain any, the
tokens of a text are those of its ASCII-white-space-separated words, in order. (Neither NFC composition nor
the lower-casing of one character nor a special string reaches across such a space.) Each distinct word is
therefore encoded once per worker and its tokens are reused.
"""

from __future__ import annotations

import json
import os

import numpy as np

#: A worker's memo is emptied when it holds this many words; only speed depends on it.
MEMO_WORDS = 500_000
#: Longer words (runs without a space) are encoded each time and not kept.
MEMO_LENGTH = 200

_tokenizers: dict = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """The tokenizer of a file, loaded once per worker; truncation and padding off."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _tokenizers[path] = tok
    return _tokenizers[path]


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def drops_space(path: str) -> bool:
    """Whether a tokenizers file lower-cases, drops white space and cuts runs of letters from all else, as the lemma asks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = next((c for c in cuts if c["type"] == "Split"), {})
    pattern = split.get("pattern", {}).get("Regex", "")
    return steps == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed" and split.get("invert") is True and "[\\p{L}]+" in pattern and " " not in pattern


def simple_pieces(word: str) -> tuple[str, str] | None:
    """A word of Latin letters, lower-cased, and the one mark behind it (or nothing); None for any other word."""
    core, mark = (word[:-1], word[-1]) if word[-1] in ".,;:!?" else (word, "")
    if not core.isalpha() or max(core) >= "\u0250":
        return None
    low = core.lower()
    return (low, mark) if len(low) == len(core) else None


class WordIds:
    """Word -> its token ids as little-endian unsigned 32-bit integers, through the tokenizers library.

    Words of Latin letters with or without a mark behind them go to the library's model piece by piece (the
    pieces are shared by many words), all others to its whole encoder."""

    def __init__(self, path: str):
        if not drops_space(path):
            raise ValueError(f"{path}: its tokens may hold white space, so texts cannot be encoded word by word")
        self.tokenizer = load(path)
        self.memo: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.alphabet = byte_alphabet()

    def ids(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word of ``words`` (none may hold ASCII white space)."""
        memo = self.memo
        new = set(words).difference(memo)
        if new:
            long = {w: np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in new if len(w) > MEMO_LENGTH}
            short = [w for w in new if len(w) <= MEMO_LENGTH]
            if len(memo) + len(short) > MEMO_WORDS:
                memo.clear()
                short = list({w for w in words if len(w) <= MEMO_LENGTH})
            self._learn(short)
            if long:
                return [memo[w] if len(w) <= MEMO_LENGTH else long[w] for w in words]
        return list(map(memo.__getitem__, words))

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            text = piece if piece.isascii() else "".join(map(self.alphabet.__getitem__, piece.encode()))
            known = np.array([t.id for t in self.tokenizer.model.tokenize(text)], "<u4").tobytes()
            if len(self.pieces) >= MEMO_WORDS:
                self.pieces.clear()
            self.pieces[piece] = known
        return known

    def _learn(self, words: list[str]) -> None:
        other = []
        for w in words:
            found = simple_pieces(w)
            if found is None:
                other.append(w)
            elif found[1]:
                self.memo[w] = self._piece(found[0]) + self._piece(found[1])
            else:
                self.memo[w] = self._piece(found[0])
        for k in range(0, len(other), 20_000):
            self._encode(other[k : k + 20_000])

    def _encode(self, words: list[str]) -> None:
        """Encode the words as one text and cut its tokens where their offsets pass a space."""
        enc = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(enc.ids, "<u4")
        first = np.fromiter((a for a, _ in enc.offsets), np.int64, len(ids))
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        cuts = np.searchsorted(first, starts).tolist()
        packed = ids.tobytes()
        self.memo.update((w, packed[4 * a : 4 * b]) for w, a, b in zip(words, cuts, cuts[1:], strict=False))


_word_ids: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's memo for a tokenizer file."""
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return _word_ids[path]


def words_of(text: str) -> list[str]:
    """Words between ASCII white space. (``str.split()`` would also cut at other separators, which some
    tokenizers keep.)"""
    for space in "\t\n\r\x0b\x0c":
        if space in text:
            text = text.replace(space, " ")
    return [w for w in text.split(" ") if w]
