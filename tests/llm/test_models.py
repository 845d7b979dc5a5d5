"""Scores of the learned models against plain loops over their definitions."""

from __future__ import annotations

import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from candela.llm import bpe, language, quality, toxicity
from candela.llm.labelled import logistic
from candela.llm.tokens import tokenizer_path
from tests.llm.conftest import odd_rows

WORDS = ["insulto", "gruppen", "Gruppe,", "haus", "hat", "ok", "<|x|>", "naïve", "ΑΣΑ", "langeswort"]


def hand_features(text):
    """Feature -> none: a term occurs (0, 1), and its count in 512 words reaches 1, 2, 4 ... 256 (2 to 10)."""
    words = [w for w in text.split(" ") if w]
    counts = Counter()
    for word in words:
        w = word.strip(".,;:!?\"'()[]{}|*%&$#<>-_/\\").lower()
        if len(w) >= 3:
            counts.update([zlib.crc32(("=" + w).encode()) >> 12] + [zlib.crc32(("^" + w[:k]).encode()) >> 12 for k in range(3, min(len(w), 8) + 1)])
    return {16 * t + k for t, c in counts.items() for k in range(11) if k < 2 or 512 * c // len(words) >= 2 ** (k - 2)}


def test_machine_score_is_the_double_sum_over_pairs():
    rng, gen = random.Random(4), np.random.default_rng(4)
    texts = ["", *(" ".join(rng.choices(WORDS, k=rng.randint(1, 60))) for _ in range(25))]
    every = sorted(set().union(*map(hand_features, texts)))
    features = every[::2]
    model = {"features": features, "w0": -1.5, "w": gen.normal(0, 0.3, len(features)), "v": gen.normal(0, 0.2, (len(features), toxicity.FACTORS)), "prior": 0.1}
    for text, got in zip(texts, toxicity.scorer(model)(texts), strict=True):
        x = [i for i, f in enumerate(features) if f in hand_features(text)]
        z = -1.5 + sum(model["w"][i] for i in x)
        for i, j in itertools.combinations(x, 2):
            z += sum(model["v"][i][f] * model["v"][j][f] for f in range(toxicity.FACTORS))
        assert got == pytest.approx(1 / (1 + math.exp(-min(30, max(-30, z)))), abs=1e-9)


def test_features_are_counted_whole_and_with_little_memory(monkeypatch):
    """A task hands its counts on in parts, forgets words on the way and spreads long texts in blocks."""
    rng = random.Random(8)
    texts = ["", *(" ".join(rng.choices(WORDS, k=rng.randint(1, 90))) + f" wort{k} wort{k // 2}" for k in range(60))]
    batch = pa.RecordBatch.from_pydict({"text": texts, "y": pa.array([k % 3 % 2 for k in range(len(texts))], pa.int32())})
    want = Counter()
    for k, text in enumerate(texts):
        want.update((f, k % 3 % 2) for f in hand_features(text))
    for size in (1 << 16, 20):
        for name in ("MEMO_WORDS", "BLOCK_WORDS", "FLUSH_FEATURES"):
            monkeypatch.setattr(toxicity, name, size)
        got = Counter()
        for part in toxicity._counted(iter([batch])):
            for feature, a, b in zip(*(c.to_pylist() for c in part.columns), strict=True):
                got.update({(feature, 0): a, (feature, 1): b})
        assert +got == want
    monkeypatch.undo()
    many = pa.RecordBatch.from_pydict({"text": [" ".join(f"{k}q{j}word" for j in range(500)) for k in range(400)], "y": pa.array([k % 2 for k in range(400)], pa.int32())})
    tracemalloc.start()
    try:
        for part in toxicity._counted(iter([many])):
            del part
        assert tracemalloc.get_traced_memory()[1] < 130e6
    finally:
        tracemalloc.stop()


def test_a_bpe_task_leaves_no_words_in_its_worker():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["many different words", None]})
    result = lambda enc, ids: (len(ids), len(enc.words))
    rows = [r for part in bpe._encoded(iter([batch]), tokenizer_path(), ("n", "known"), (pa.int64(), pa.int64()), result) for r in part.to_pylist()]
    assert rows[0]["n"] >= 3 and rows[0]["known"] == 3 and rows[1]["n"] == 0
    enc = bpe.encoder(tokenizer_path())
    assert not enc.words and not enc.pieces and not enc.merges.table


def matched_pairs(n, rng):
    """(label, features): one of two insults, one of two groups, some noise; only an insult with its own group is toxic."""
    out = []
    for _ in range(n):
        insult, group = rng.randrange(2), rng.randrange(2)
        out.append((int(insult == group), sorted([insult, 2 + group, *(4 + k for k in range(20) if rng.random() < 0.2)])))
    return out


def test_pairs_are_learned_that_linear_weights_cannot_tell():
    rng = random.Random(3)
    seen, unseen = matched_pairs(1500, rng), matched_pairs(500, rng)
    w0, w, v = toxicity.train(seen, 24, 0.5)
    where = np.repeat(np.arange(len(unseen)), [len(x) for _, x in unseen])
    index = np.array([i for _, x in unseen for i in x])
    z, _ = toxicity.margin(w0, w, v, where, index, len(unseen))
    dense = lambda rows: np.array([[float(i in x) for i in range(24)] for _, x in rows])
    beta = logistic(dense(seen), np.array([y for y, _ in seen], float), np.ones(len(seen)))
    linear = np.column_stack([dense(unseen), np.ones(len(unseen))]) @ beta
    right = lambda z: np.mean((z > 0) == np.array([y == 1 for y, _ in unseen]))
    assert right(z) >= 0.98 and right(linear) <= 0.6


def test_every_block_of_a_learned_text_trains_the_dictionaries(spark, monkeypatch):
    lines = {y: [f"{'careful' if y else 'CLICK'} {y} {k} " * 150 for k in range(40)] for y in (0, 1)}  # 40 lines of over a block each
    docs = spark.createDataFrame([(i, "".join(lines[i % 2])) for i in range(60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as quality")
    found = []
    monkeypatch.setattr(quality, "_dictionary", lambda texts, size: found.append(set(texts)) or b"")
    quality.fit(docs, labels)
    assert found == [set(quality.blocks("".join(lines[y]).encode())) for y in (1, 0)]


def test_quality_score_is_the_calibrated_size_difference(odd):
    good, bad = b"well formed sentences about careful work. " * 30, b"BUY now!!! click $$$ " * 60
    beta = np.random.default_rng(2).normal(0, 0.2, 3 * quality.FEATURES)
    model = {"good": good, "bad": bad, "prior": 0.7, "beta": beta}
    got = Counter((r["doc_id"], round(r["score"], 9)) for r in quality.score(odd, model).collect())
    size = lambda d, b: len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=quality.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False).compress(b))
    want = Counter()
    for i, t, _, _ in odd_rows():
        raw = (t or "").encode()
        p = 0.7
        if raw:
            parts = [raw[k : k + 2048] for k in range(0, len(raw), 2048)]
            sizes = [(size(good, b), size(bad, b), len(b)) for b in parts]
            g, b, n = (sum(s[k] for s in sizes) for k in range(3))
            each = [(y - x) / (y + x) for x, y, m in sizes if m >= min(n, 512)]
            x = [10 * (b - g) / (b + g), math.log((g + b) / (2 * n)), 10 * min(each), 10 * max(each), math.log(n) / 5]
            z = sum(c * v for c, v in zip(beta, [*x, *(v * v for v in x), *(x[0] * v for v in x[1:]), 1.0], strict=True))
            p = 1 / (1 + math.exp(-min(30, max(-30, z))))
        want[i, round(p, 9)] += 1
    assert got == want


def plain_em(logs, allowed, steps):
    """(proportions, log likelihood) of ``logs`` = [(count, log probability of each language)]."""
    total = sum(n for n, _ in logs)
    share = [a / sum(allowed) for a in allowed]
    for _ in range(steps):
        new = [0.0] * len(share)
        for n, log in logs:
            each = [s * math.exp(x) for s, x in zip(share, log, strict=True)]
            for k, e in enumerate(each):
                new[k] += n * e / sum(each)
        share = [x / total for x in new]
    return share, sum(n * math.log(sum(s * math.exp(x) for s, x in zip(share, log, strict=True))) for n, log in logs)


def test_mixture_equals_plain_expectation_maximisation():
    rng = random.Random(9)
    names = ["aa", "bb", "cc"]
    letters = {"aa": "abcdea", "bb": "fghija", "cc": "klmnoa"}
    say = lambda lang, k: " ".join("".join(rng.choices(letters[lang], k=4)) for _ in range(k))
    table = np.full((1 << language.BITS, 3), language.SMOOTH)
    for k, name in enumerate(names):
        np.add.at(table[:, k], language.grams([say(name, 3000)])[1], 1)
    logp = np.log(table / table.sum(axis=0))
    texts = ["", "123 ?", *(say(n, 20) for n in names), *(say(a, rng.randint(5, 40)) + " " + say(b, rng.randint(5, 40)) for a in names for b in names), " ".join(say(n, 30) for n in names)]
    found = language.infer(texts, names, logp)
    lengths = set()
    for text, got in zip(texts, found, strict=True):
        logs = [(n, logp[c].tolist()) for c, n in Counter(language.grams([text])[1].tolist()).items()]
        if not logs:
            assert got == []
            continue
        cost = language.PENALTY / 2 * math.log(max(2, sum(n for n, _ in logs)))
        single = [sum(n * log[k] for n, log in logs) for k in range(3)]
        value, want = max(single), {names[single.index(max(single))]: 1.0}
        share, full = plain_em(logs, [1, 1, 1], language.STEPS)
        rank = sorted(range(3), key=lambda k: -share[k])
        for k in (2, 3) if full - cost > value else ():
            some, like = plain_em(logs, [1.0 if x in rank[:k] else 0.0 for x in range(3)], language.STEPS)
            if like - (k - 1) * cost > value:
                value, want = like - (k - 1) * cost, {names[x]: some[x] for x in rank[:k]}
        assert dict(got) == pytest.approx(want, abs=1e-6) and [s for _, s in got] == sorted((s for _, s in got), reverse=True)
        lengths.add(len(got))
    assert lengths == {1, 2, 3}
