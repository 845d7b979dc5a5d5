"""Classifiers, languages, token counts, token files, BPE and the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.llm import bpe, language, quality, token_counts, token_files, toxicity
from candela.llm.tokens import WordIds, load, tokenizer_path, words_of
from tests.llm.conftest import LABELS, make_docs, odd_rows

SF = "/root/testdata/sf0.01"


def ids_of(text):
    return load(tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def random_texts(n, seed=3):
    rng = random.Random(seed)
    letters = "abcdehilnorst'.,!0129 éüñßŉİΣǅ\n\t<|>中́ "
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_backtracking_equals_the_library():
    enc = bpe.encoder(tokenizer_path())
    tok = load(tokenizer_path())
    for text in [*random_texts(400), "a" * 500, "abab" * 200, "<|startoftext|>x<|endoftext|>", "ﬁ ẞ ſ a\x1cb"]:
        want = tok.encode(text, add_special_tokens=False).ids
        ids = enc.encode(text)
        assert ids.tolist() == want, text
        assert enc.decode(ids).decode() == tok.decode(want, skip_special_tokens=False)


def test_pairs_that_merge_are_not_compatible():
    enc = bpe.encoder(tokenizer_path())
    a, b = enc.by_text["t"], enc.by_text["h"]
    assert not enc.merges.compatible(a, b) and enc.piece("th") == [enc.by_text["th\0"]]
    assert all(bpe.encoder(tokenizer_path()).piece(t.rstrip("\0")) == [i] for t, i in list(enc.by_text.items())[600:3000:37] if t.endswith("\0"))


def encode(text):
    return load(tokenizer_path()).encode(text, add_special_tokens=False)


@pytest.mark.parametrize("chunk,overlap", [(37, 5), (64, 1), (1000, 16)])
def test_chunked_equals_whole(chunk, overlap):
    long = " ".join(random_texts(120, 6))
    for text in [*random_texts(200, 5), long, "x" * 3000 + " y", "ab " * 500, " " * 300 + "z", "aa\n" + "b" * 99 + "\tc", "", "a b\xa0 \x85 c " * 90]:
        parts = list(token_counts.encode_chunked(text, encode, chunk, overlap))
        assert [i for part in parts for i in part] == ids_of(text)
        assert sum(token_counts.text_tokens(text, WordIds(tokenizer_path()), chunk, overlap)) == len(ids_of(text))
    assert len(list(token_counts.encode_chunked("ab " * 500, encode, chunk, overlap))) >= 1500 // chunk


def encoded_characters(text, tokenizer, chunk, overlap):
    """(ids, characters handed to the tokenizer, calls of it)."""
    handed = []

    def call(t):
        handed.append(len(t))
        return tokenizer.encode(t, add_special_tokens=False)

    ids = [i for part in token_counts.encode_chunked(text, call, chunk, overlap) for i in part]
    return ids, sum(handed), len(handed)


def test_chunks_that_disagree_widen_their_overlap():
    """Tokens of two words each: chunks of another parity than the one before never agree, so the check has to fail."""
    from tokenizers import Regex, Tokenizer
    from tokenizers.models import WordLevel
    from tokenizers.pre_tokenizers import Split

    rng = random.Random(1)
    words = ["ab", "c", "def"]
    vocab = {t: n for n, t in enumerate(["[?]", *words, *(f"{a} {b}" for a in words for b in words)])}
    pairs = Tokenizer(WordLevel(vocab, unk_token="[?]"))
    pairs.pre_tokenizer = Split(Regex(r"\S+ \S+|\S+"), "removed", invert=True)
    refused = 0
    for _ in range(30):
        text = " ".join(rng.choice(words) for _ in range(400))
        ids, _, calls = encoded_characters(text, pairs, 100, 12)
        assert ids == pairs.encode(text).ids
        refused += calls > len(text) / 100 + 1
    assert refused > 20
    done, later = (token_counts.Chunk(pairs.encode, "ab c def ab c def", a, b) for a, b in ((0, 17), (3, 17)))
    assert token_counts.joint(done, later, [5, 12]) is None  # the later chunk pairs "c def", "ab c"


def test_runs_without_white_space_are_encoded_in_proportion():
    rng = random.Random(8)
    for text in ["".join(rng.choice("abcdefgh,.1") for _ in range(200_000)), "w " * 40_000 + "x" * 150_000 + " y" * 40_000]:
        ids, handed, _ = encoded_characters(text, load(tokenizer_path()), 4096, 64)
        assert ids == ids_of(text) and handed < 2 * len(text)


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError):
        WordIds(tokenizer_path("byte_bpe_50k.json"))


def test_words_of_cuts_at_ascii_white_space_only():
    assert words_of("a\x1cb c \t\n\x0b\x0c\rd") == ["a\x1cb c", "d"]


def test_token_counts(odd, empty):
    got = Counter(tuple(r)[:4] for r in token_counts.token_counts(odd, limit=100, chunk=5000).collect())
    assert got == Counter((i, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 100) for i, t, _, _ in odd_rows())
    assert token_counts.token_counts(empty).collect() == []


def test_bpe_digest(odd, empty):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    tok = load(tokenizer_path())
    want = Counter()
    for i, t, _, _ in odd_rows():
        ids = ids_of(t)
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(tuple(r) for r in bpe.bpe_digest(odd).collect()) == want
    assert bpe.bpe_digest(empty).collect() == []
    rows = {r["doc_id"]: r for r in bpe.encode_documents(odd).collect() if r["doc_id"] is not None}
    assert rows[305]["ids"] == ids_of(odd_rows()[[r[0] for r in odd_rows()].index(305)][1]) and rows[300]["ids"] == [] and rows[300]["decoded"] == ""


def test_many_special_strings_in_one_run():
    text = "x" + "<|endoftext|>" * 3000 + "Naïve<|startoftext|>12½ <|endoftext|><|endoftext|>a"
    assert bpe.encoder(tokenizer_path()).encode(text).tolist() == ids_of(text)


def test_token_files(spark, odd, empty, tmp_path):
    rows = odd.where("doc_id is not null and doc_id != 500")
    texts = {i: t for i, t, _, _ in odd_rows() if i is not None and i != 500}
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_shards(rows, folder, shards=3)
    start, want = 0, {}
    for i in sorted(texts):
        ids = np.array([*ids_of(texts[i]), 1], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_shards(manifest).collect()}
    assert got == want
    shard = manifest.orderBy("shard").collect()[-1]
    one = token_files.read_documents(shard["path"], [0])[0]
    assert one.tolist() == [*ids_of(texts[shard["doc_ids"][0]]), 1]
    import zstandard

    raw = open(shard["path"].removeprefix("file://"), "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(whole) == 4 * shard["n_ids"]  # any reader can read the shard
    broken = bytearray(raw)
    broken[10] ^= 255
    bad = tmp_path / "broken.zst"
    bad.write_bytes(bytes(broken))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.read_documents(f"file://{bad}", [0])
    assert token_files.token_files(odd).count() == len(odd_rows())
    assert token_files.token_files(empty).collect() == []


def accuracy(got, labels, target):
    both = got.join(labels, "doc_id").where("held_out")
    hit = both.groupBy(target).agg(F.avg((F.col("predicted") == F.col(target)).cast("double")).alias("p"))
    return {r[target]: r["p"] for r in hit.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels")]


def test_quality_held_out(tables):
    got = quality.quality(*tables).cache()
    assert got.count() == 1000
    hit = accuracy(got, tables[1], "quality")
    assert hit[1] >= 0.95 and hit[0] >= 0.8


def test_toxicity_held_out(tables):
    got = toxicity.toxicity(*tables).cache()
    assert got.count() == 1000
    hit = accuracy(got, tables[1], "toxic")
    assert hit[0] >= 0.97 and hit[1] >= 0.6  # few toxic labels at this size; some carry no sign of it


def test_machine_learns_pairs(spark):
    """Two words that are toxic together and harmless alone: no linear weights tell that."""
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(900):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(50)}" for _ in range(20)] + ["insulto"] * a + ["gruppen"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        marks.append((i, 1, int(a and b), None))
    hit = accuracy(toxicity.toxicity(make_docs(spark, rows), spark.createDataFrame(marks, LABELS), threshold=0.5), spark.createDataFrame(marks, LABELS).select("doc_id", "toxic"), "toxic")
    assert hit[0] >= 0.97 and hit[1] >= 0.97


@pytest.mark.parametrize("f", [quality.quality, toxicity.toxicity])
def test_classifiers_on_odd_rows(spark, odd, empty, labels, f):
    got = f(odd, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in odd_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert f(empty, labels).collect() == []
    none = f(odd, spark.createDataFrame([], LABELS)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def test_languages_held_out(tables):
    got = language.languages(tables[0]).join(tables[0].select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.98


def test_languages_of_odd_rows(odd, empty):
    got = language.languages(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in odd_rows())
    by = {r["doc_id"]: r for r in got}
    for i in (300, 301, 302, 306):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got) and by[0]["lang_pred"] == "en"
    assert language.languages(empty).collect() == []


def test_mixture_finds_both_languages(tables):
    docs = tables[0]
    names, logp = model = language.fit(docs)
    en = docs.where("lang = 'en' and n_chars > 1500").orderBy("doc_id").first()["text"][:1200]
    de = docs.where("lang = 'de' and n_chars > 1500").orderBy("doc_id").first()["text"][:600]
    (found,) = language.infer([en + " " + de], *model)
    assert [x for x, _ in found] == ["en", "de"] and found[0][1] == pytest.approx(2 / 3, abs=0.12)
    single = language.infer([en, "", "12 34"], names, logp)
    assert single[0] == [("en", 1.0)] and single[1] == single[2] == []


def test_em_raises_the_likelihood(tables):
    names, logp = language.fit(tables[0])
    part = [r["text"] for r in tables[0].orderBy("doc_id").limit(5).collect()]
    owner, cls = language.grams(part)
    p, n = np.exp(logp[cls]), np.ones(len(cls))
    starts = np.unique(owner, return_index=True)[1]
    last = None
    for steps in range(6):
        _, like = language._proportions(p, owner, n, starts, np.ones((len(part), len(names))), steps)
        assert last is None or (like >= last - 1e-9).all()
        last = like


def test_pipeline_and_queries(spark):
    import __spark_entry__ as entry
    import corpus_pipeline

    queries = entry.queries()
    assert [n for n in queries if n.startswith("op")] == sorted((n for n in queries if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert "pipeline" in queries and len([n for n in queries if n.startswith("op")]) == 13
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < docs.count() and {r["doc_id"] for r in docs.collect()} <= set(before)
    texts = Counter(r["text"] for r in docs.select("doc_id", "text").distinct().collect())
    assert max(texts.values()) == 1
    final = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert Counter(r["doc_id"] for r in final.collect()) == Counter(r["doc_id"] for r in docs.collect())
