"""Repetition rules, fill-in-middle and the filter audit, each against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from candela.llm import fill_in_middle as fim
from candela.llm import filter_audit, repetition
from tests.llm.conftest import LABELS, make_docs, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeating_texts(n=150, seed=8):
    """Short vocabularies, so that windows, lines and single words repeat in many ways."""
    rng = random.Random(seed)
    out = ["", " \n\t ", "a " * 40, "é\n" * 9, "one two\n\none two\n three\none two", "x" * 3000, "a b c d e f g h " * 3, " ".join(f"pp qq rr ss tt u{i}" for i in range(12))]
    for _ in range(n):
        words = [rng.choice("ab éß#|x") * rng.randint(1, 2) for _ in range(rng.randint(0, 90))]
        out.append("".join(w + rng.choice([" ", "\n", "  ", "\t", " ", " "]) for w in words))
    return out


def repetition_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup_lines, line_chars = text.split("\n"), set(), 0, 0
    for line in lines:
        if WORD.search(line):
            if line in seen:
                dup_lines += 1
                line_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)

    def inside(n, first):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        times, places = Counter(grams), set()
        for i, g in enumerate(grams):
            if times[g] > 1 and (first or g in grams[:i]):
                places |= set(range(i, i + n))
        return places

    chars = sum(map(len, words))
    out = {"n_words": len(words), "word_chars": chars, "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup_lines}
    out["n_repeat_words"] = len(inside(8, True))
    dup = {n: sum(len(words[i]) for i in inside(n, False)) for n in repetition.NGRAM_PERCENT}
    out["base_failed"] = len(words) < 20 or 100 * out["n_repeat_words"] > 30 * len(words)
    out["kept"] = not out["base_failed"] and 100 * line_chars <= repetition.LINE_PERCENT * chars and all(100 * dup[n] <= p * chars for n, p in repetition.NGRAM_PERCENT.items())
    return out | {"dup_line_chars": line_chars} | {f"dup_chars_{n}": c for n, c in dup.items()}


def test_repetition_equals_brute_force(spark, empty):
    texts = [*repeating_texts(), None]
    got = repetition.repetition(make_docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    want = {i: repetition_by_hand(t) for i, t in enumerate(texts)}
    assert {r["doc_id"]: {k: v for k, v in r.asDict().items() if k != "doc_id"} for r in got} == want
    assert {True, False} <= {r["kept"] for r in got} and any(not r["kept"] and not r["base_failed"] for r in got)
    assert repetition.repetition(empty).collect() == []


def test_repetition_of_odd_rows(odd):
    short = [(i, t) for i, t, _, _ in odd_rows() if len(t or "") < 50_000]
    got = Counter((r["doc_id"], r["n_words"], r["n_repeat_words"], r["kept"]) for r in repetition.repetition(odd).collect())
    for (i, t), n in Counter(short).items():
        w = repetition_by_hand(t)
        assert got[i, w["n_words"], w["n_repeat_words"], w["kept"]] >= n
    assert sum(got.values()) == len(odd_rows())


@pytest.mark.parametrize("bits", [1, 4, 64])
def test_windows_that_share_a_hash_are_told_apart(bits):
    texts = [t.encode() for t in repeating_texts(60)]
    few, full = repetition.profile(texts, hash_bits=bits), repetition.profile(texts)
    assert all((few[k] == full[k]).all() for k in full)
    ids, owner, _ = repetition.numbered(texts)
    end = np.searchsorted(owner, owner, side="right")
    assert (repetition._repeated(ids, owner, end, (5,), 0, bits) is None) == (bits < 64)


def test_words_are_not_cut_at_block_borders():
    raw = " ".join(f"w{i}é" for i in range(500)).encode()
    assert [w for part in repetition.word_blocks(raw, 7) for w in part] == raw.split()


def fim_by_hand(doc_id, text, rate=50, spm=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text), text
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), form, len(p), len(m), sha(out), sha(text), out


def fim_rows():
    rng = random.Random(5)
    texts = ["a<P>b", "x <S>", "<M>", "<", "a <P", "<S", ">", " <", "ends <", "\n\n", "é" * 30_000, "word " * 9000, " " * 40_000, "x" * 20_000 + " y"]
    texts += ["".join(rng.choice("<<PSM> aé\n") for _ in range(rng.randint(0, 25))) for _ in range(200)]
    return [*odd_rows(), *((1000 + i, t, "en", "s") for i, t in enumerate(texts))]


def test_fill_in_middle_equals_brute_force(spark, empty):
    rows = fim_rows()
    for parts in (1, 5):
        docs = make_docs(spark, rows).repartition(parts)
        assert Counter(tuple(r) for r in fim.fill_in_middle(docs).collect()) == Counter(fim_by_hand(i, t)[:7] for i, t, _, _ in rows)
    always = Counter(tuple(r) for r in fim.fill_in_middle(docs, rate=100, spm=30).collect())
    assert always == Counter(fim_by_hand(i, t, 100, 30)[:7] for i, t, _, _ in rows) and {"psm", "spm", "plain"} == {k[2] for k in always}
    assert fim.fill_in_middle(empty).collect() == []


def test_outputs_arrive_as_ordered_pieces(spark):
    rows = [r for r in fim_rows() if r[0] is not None and r[0] != 500]
    out, form = {}, {}
    for r in fim.transformed(make_docs(spark, rows).repartition(3)).collect():
        assert (r["doc_id"] in out) == (r["at"] > 0) and len(r["data"]) <= fim.PIECE_BYTES + 3
        out[r["doc_id"]] = out.get(r["doc_id"], b"") + bytes(r["data"])
        form[r["doc_id"]] = form.get(r["doc_id"]) or r["form"]
    want = {i: fim_by_hand(i, t) for i, t, _, _ in rows}
    assert {i: (form[i], b.decode()) for i, b in out.items()} == {i: (w[2], w[7]) for i, w in want.items()}


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_splitter_does_not_depend_on_the_borders_of_pieces(size):
    for form, out, want in (("psm", b"<P>a <<S>b>S<M>", {0: b"a <", 2: b"b>S"}), ("spm", b"<S><P><<M>x<", {0: b"<", 1: b"x<"}), ("plain", b"a<S>", {0: b"a<S>"})):
        splitter, parts = fim.Splitter(form), {}
        for k in range(0, len(out) + size, size):
            for part, data in splitter.feed(out[k : k + size], k >= len(out)):
                parts[part] = parts.get(part, b"") + data
        assert parts == want
    with pytest.raises(ValueError):
        list(fim.Splitter("psm").feed(b"<P>no other", True))


def audit_by_hand(rows, labels):
    texts = {}
    for i, t, *_ in rows:
        if i is not None:
            texts[t or ""] = min(i, texts.get(t or "", i))
    good, toxic = ({i for i, *m in labels if i is not None and m[k] == 1} for k in (0, 1))
    docs = []
    for i, t, lang, _ in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and texts[t] < i,
        }
        docs.append((lang or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                redundant = sum(f in d[1] for d in mine) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone), f]
        for (p, order, step), v in out.items():
            if p == part:
                out[p, order, step] = [*v[:6], total[v[6]]]
    return out


def audit_rows():
    rng = random.Random(9)
    rows = list(odd_rows())
    for i in range(700, 900):
        words = [rng.choice(["Ab", "c", "dd", "EE", "f|", "g", "hé"]) + str(rng.randrange(rng.choice([3, 400]))) for _ in range(rng.choice([0, 30, 230, 260]))]
        rows.append((i, " ".join(words), rng.choice(["en", "de", None]), "s"))
    rows += [(i, rng.choice(rows)[1], rng.choice(["en", "fr"]), "s") for i in range(900, 1000)]
    rows += [(5000 + i, "a hot text", "en", "s") for i in range(300)] + [(-7, "a hot text", "de", "s")]
    return rows


def test_filter_audit_equals_brute_force(spark, empty, labels):
    rows = audit_rows()
    marks = [(i, i % 2, int(i % 5 == 0), "x") for i in range(700, 1000)] + [tuple(r) for r in labels.collect()] + [(700, 1, 1, None), (5001, 1, None, None)]
    got = filter_audit.filter_audit(make_docs(spark, rows).repartition(4), spark.createDataFrame(marks, LABELS))
    want = audit_by_hand(rows, [m[:3] for m in marks])
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got.collect()} == want
    assert filter_audit.filter_audit(empty, labels).collect() == []
    none = filter_audit.filter_audit(make_docs(spark, rows), spark.createDataFrame([], LABELS)).collect()
    assert len(none) == len(want) and {(r["good_lost"], r["toxic_lost"]) for r in none} == {(0, 0)}


def test_audit_has_no_python_and_no_cross_join(spark, labels):
    plan = filter_audit.filter_audit(make_docs(spark, odd_rows()), labels)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"))
