"""Exact and near duplicates, neighbours, mixing: against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candela.llm import exact_dedup, jaccard_join, mixing, multi_index
from candela.llm.components import components
from tests.llm.conftest import make_docs, odd_rows


@pytest.mark.parametrize("key_bits,capacity,depth", [(64, 50_000, 16), (3, 2, 2), (1, 1, 4)])
def test_exact_dedup_matches_brute_force(odd, key_bits, capacity, depth):
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_dedup(odd, key_bits=key_bits, capacity=capacity, max_depth=depth).collect())
    groups = defaultdict(list)
    for i, t, _, _ in odd_rows():
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    assert got == want


def test_directory_splits_overfull_buckets_only(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("key"))
    tree = {r["leaf"]: r for r in exact_dedup.directory(keys, 40, 8).collect()}
    held = Counter((k["key"] % 2**64) >> 56 for k in keys.collect())
    for leaf, r in tree.items():
        size = lambda d: sum(n for x, n in held.items() if x >> (8 - d) == leaf >> (8 - d))  # noqa: B023, E731
        assert r["bucket"] == (leaf >> (8 - r["depth"])) << (8 - r["depth"])
        assert size(r["depth"]) <= 40 or r["depth"] == 8
        assert r["depth"] == 0 or size(r["depth"] - 1) > 40


def test_dedup_has_no_python(odd):
    plan = exact_dedup.exact_dedup(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_chains_are_made_by_the_owners_of_the_buckets(odd):
    docs = odd.select("doc_id", "text")
    _, keys, tree = exact_dedup.build_index(docs, capacity=2, max_depth=4)
    made = exact_dedup.chains(docs, keys, tree, 4)
    got = {(r["bucket"], r["body"]): (r["keep_id"], r["group_size"]) for r in made.collect()}
    assert {n for _, n in got.values()} == {2, 3, 6} and len({b for b, _ in got}) > 1
    # Without a part of the directory, nothing is found in that part's buckets.
    lost = next(iter(got))[0]
    rest = exact_dedup.chains(docs, keys, tree.where(F.col("bucket") != lost), 4).collect()
    assert {(r["bucket"], r["body"]) for r in rest} == {k for k in got if k[0] != lost}
    # Nothing is exchanged above the owners' ranges.
    exchanges = re.findall(r"Exchange (\w+)\(", made._jdf.queryExecution().executedPlan().toString())
    assert exchanges[0] == "rangepartitioning" and exchanges[1] == "hashpartitioning"


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(odd, empty):
    rows = exact_dedup.drop_copies(odd)
    assert rows.columns == odd.columns
    ids = Counter((r["doc_id"], r["text"]) for r in rows.collect())
    assert max(ids.values()) == 1 and (104, odd_rows()[0][1]) in ids and (0, odd_rows()[0][1]) not in ids
    assert exact_dedup.drop_copies(empty).collect() == []


def brute_components(rows, words=5, percent=75):
    sets = []
    for i, t, _, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (x, (_, a)), (y, (_, b)) in itertools.combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[max(find(x), find(y))] = min(find(x), find(y))
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return Counter((i, len(s), i if not s else least.get(find(x))) for x, (i, s) in enumerate(sets))


def near_family(seed, families=4, members=25):
    """Chains and stars of near copies, subsets of shared passages, short texts."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(4000)
    common = [word() for _ in range(50)]
    rows, i = [], 0
    for _ in range(families):
        text = [word() for _ in range(rng.choice([5, 7, 12, 40, 120]))]
        for _ in range(members):
            edited = list(text)
            for _ in range(rng.randrange(3)):
                edited[rng.randrange(len(edited))] = word()
            if rng.random() < 0.2:
                edited = common[: rng.randrange(50)] + edited
            if rng.random() < 0.3:
                text = edited
            rows.append((i, " ".join(edited), "en", "s"))
            i += 1
    rows += [(i + k, " ".join(common[: 3 + k]), "en", "s") for k in range(30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates_match_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TOKENS_PER_RANGE", 500)
    if seed == 3:  # all pairs in the last round
        monkeypatch.setattr(jaccard_join, "CENTRES", ())
    rows = near_family(seed)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(make_docs(spark, rows)).collect())
    assert got == brute_components(rows)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(odd).collect())
    assert got == brute_components(odd_rows())
    assert jaccard_join.near_duplicates(empty).collect() == []


def test_keep_one_of_each_component(odd):
    rows = jaccard_join.keep_one(odd)
    assert rows.columns == odd.columns
    ids = Counter(r["doc_id"] for r in rows.collect())
    assert ids[0] == 1 and ids[100] == 0 and ids[1] == 1 and ids[200] == ids[201] == 0
    assert ids[300] == ids[301] == ids[302] == 1 and ids[303] == 1 and ids[304] == 0 and ids[None] == 1


def test_keep_one_tells_rows_with_one_id_apart(spark):
    prose = lambda c: " ".join(f"{c}{k}" for k in range(40))
    rows = [(7, prose("p")), (7, prose("q"))]  # one id, not linked
    rows += [(3, prose("a")), (8, prose("a") + " more"), (8, prose("z"))]  # the near copy has the smaller text
    rows += [(9, prose("m") + " x"), (9, prose("m")), (9, prose("m")), (10, prose("m") + " y")]
    rows += [(None, prose("n") + " x"), (None, prose("n")), (None, prose("o"))]
    rows += [(11, ""), (11, None), (11, prose("r")), (None, " \n"), (None, None)]
    got = jaccard_join.keep_one(make_docs(spark, [(i, t, "en", "s") for i, t in rows]).repartition(4)).select("doc_id", "text").collect()
    want = [(7, prose("p")), (7, prose("q")), (3, prose("a")), (8, prose("z")), (9, prose("m")), (None, prose("n")), (None, prose("o"))]
    assert Counter(map(tuple, got)) == Counter(want + rows[-5:])


def test_a_loose_family_is_joined_before_all_pairs_are_taken(spark, monkeypatch):
    """Members of which one pair in some links: centres must have joined most of them, or all pairs of the family are enumerated."""
    rng = random.Random(8)
    base = ["b%d" % k for k in range(100)]
    rows = []
    for i in range(500):
        text = list(base)
        for at in rng.sample(range(100), 2):
            text[at] = "e%d" % rng.randrange(10**6)
        rows.append((i, " ".join(text), "en", "s"))
    made, stored = {}, jaccard_join.stored

    def counted(df, name):
        out = stored(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(make_docs(spark, rows)).collect())
    assert got == brute_components(rows)
    assert made["join-units"] < 20_000, made


def peak_mb(run):
    tracemalloc.start()
    try:
        out = run()
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_join_tasks_hold_little_at_a_time():
    """Half of every text is shared with another one. The peak counts what a step allocates beside its input."""
    part = lambda c, k: " ".join(f"{c}{k}.{j}" for j in range(4000))
    batch = pa.RecordBatch.from_pydict({"text": [part("s", k // 2) + " " + part("t", k // 4) + " " + str(k) for k in range(400)]})
    packed, packs = peak_mb(lambda: list(jaccard_join._scattered(iter([batch]), 1, 5)))
    assert packed < 60
    found, back = peak_mb(lambda: jaccard_join._shared(pa.Table.from_batches(packs), 1))
    assert found < 120
    keys = np.unique(np.concatenate([np.frombuffer(k, np.int64) for k in back.column("keys").to_pylist()]))
    sizes = pa.table({"key": keys, "n": np.full(len(keys), 7997, np.int64)})
    assembled, sets = peak_mb(lambda: jaccard_join._assemble(back, sizes, 75))
    assert sets.num_rows == 400 and assembled < 160


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100)}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, v string")


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "PART", 64)
    monkeypatch.setattr(multi_index, "BLOCK", 2)
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # a vector that a third of the rows share
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0, None] + [0.0] * 6), (2060, [float("nan")] + [1.0] * 7), (2080, [float("inf")] * 8), (2100, [1.0, 2.0]), (None, [1.0] * 8), (0, rows[0][1])]
    table = vectors(spark, rows).repartition(4)
    got = defaultdict(list)
    for r in multi_index.search(table, every=20, k=20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = multi_index.brute_force(table.where("vec_id is null or vec_id != 2100"), 20, 20)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        assert len(got[q]) == 20 and q not in dict(got[q])
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
        hits += len(dict(near).keys() & dict(got[q]).keys())
    assert hits >= 0.9 * 20 * len(want)
    few = multi_index.search(vectors(spark, rows[:5] + [(20, rows[5][1])]), every=20, k=20).collect()
    assert Counter(r["query_id"] for r in few) == {0: 5, 20: 5}
    assert multi_index.search(vectors(spark, []), every=20, k=20).collect() == []


def test_neighbours_of_every_width(spark):
    """Vectors of one component, and of several widths, each among its own."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range((1, 2, 3, 8)[i % 4])]) for i in range(240)]
    rows += [(300, []), (320, [0.0]), (340, [float("nan")])]
    table = vectors(spark, rows).repartition(3)
    got = defaultdict(list)
    for r in multi_index.search(table, every=5, k=6, recall=1.0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = multi_index.brute_force(table, 5, 6)
    assert set(got) == set(want) == set(range(0, 240, 5))
    for width in range(4):
        own = [q for q in want if q % 4 == width]
        assert all(len(got[q]) == 6 and {v % 4 for v, _ in got[q]} == {width} for q in own)
        assert sum(len(dict(want[q]).keys() & dict(got[q]).keys()) for q in own) >= 0.9 * 6 * len(own)
    lone = multi_index.search(vectors(spark, [(i, [float(i + 1)]) for i in range(60)]), every=20, k=20).collect()
    assert [(r["vec_id"], r["score"]) for r in lone if r["query_id"] == 20][:2] == [(59, 21.0 * 60), (58, 21.0 * 59)] and len(lone) == 60


def test_traverse_visits_cells_by_summed_distance():
    import numpy as np

    rng = np.random.default_rng(1)
    a, b, counts = rng.normal(size=7), rng.normal(size=5), rng.integers(0, 4, (7, 5))
    cells = multi_index.traverse(a, b, counts, math.inf)
    order = [a[i] + b[j] for i, j in cells]
    assert order == sorted(order) and set(cells) == set(zip(*map(list, np.nonzero(counts)), strict=True))
    some = multi_index.traverse(a, b, counts, 10)
    assert some == cells[: len(some)] and sum(counts[c] for c in some) >= 10 > sum(counts[c] for c in some[:-1])


def test_quotas():
    assert mixing.quotas({"a": 100, "b": 100, None: 100}) == pytest.approx({"a": 187.5, "b": 75.0, None: 37.5})
    capped = mixing.quotas({"a": 10, "b": 200, "c": 90})
    assert capped["a"] == 30 and capped["b"] == pytest.approx(270 * 2 / 3) and capped["c"] == pytest.approx(90)
    assert mixing.quotas({}) == {} and mixing.quotas({"a": 0}) == {"a": 0.0}


def test_flow_is_cheapest():
    """Against all integer flows of a tiny network."""
    patterns, wanted = {("a",): 2, ("a", "b"): 3, ("b",): 1}, {"a": 4, "b": 3}
    cost = lambda p, words: sum((2 ** (k // patterns[p]) - 1) for k in range(words))
    flow = mixing.route(patterns, wanted)
    assert {s: sum(f.get(s, 0) for f in flow.values()) for s in wanted} == wanted
    spent = sum(cost(p, sum(f.values())) for p, f in flow.items())
    best = min(cost(("a",), x) + cost(("a", "b"), 4 - x + y) + cost(("b",), 3 - y) for x in range(5) for y in range(4))
    assert spent == best
    assert sum(mixing.route({("a",): 2}, {"a": 50})[("a",)].values()) == 6  # no more than three repetitions


def check_mix(docs, rows):
    got = mixing.mix(docs).collect()
    again = Counter(tuple(r) for r in mixing.mix(docs.repartition(5)).drop("members").collect())
    assert again == Counter(tuple(r[c] for c in r.asDict() if c != "members") for r in got)
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += n(t)
    target = mixing.quotas(dict(sizes))
    taken = Counter()
    for r in got:
        (s,) = r["members"]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        taken[s] += r["taken"]
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, n(t)) for i, t, _, _ in rows)
    return target, taken


def test_mix(spark, odd, empty):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), "en", rng.choice(["a", "b", "c", "d", None])) for i in range(800)]
    target, taken = check_mix(make_docs(spark, rows), rows)
    for s, words in target.items():
        assert abs(taken[s] - words) <= max(2, 0.01 * words)
    check_mix(odd, odd_rows())
    assert mixing.mix(empty).collect() == [] and mixing.apply_mix(empty).collect() == []
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(make_docs(spark, rows)).collect()}
    out = mixing.apply_mix(make_docs(spark, rows))
    assert out.columns == odd.columns and Counter(r["doc_id"] for r in out.collect()) == Counter({i: c for i, c in copies.items() if c})


def test_mix_of_overlapping_sources(spark):
    """Words of the overlap serve whichever source lacks them; nothing is repeated while new words remain."""
    rows = [(i, "w w w w", "en", "a" if i < 100 else ("b" if i < 110 else "ab")) for i in range(200)]
    members = F.when(F.col("source") == "ab", F.array(F.lit("b"), F.lit("a"), F.lit("b"))).otherwise(F.array("source"))
    got = mixing.mix(make_docs(spark, rows), members=members, weights=(1, 1), share=0.5).collect()
    taken = Counter()
    for r in got:
        taken[tuple(r["members"])] += r["taken"]
        assert r["copies"] <= 1
    assert sum(taken.values()) == pytest.approx(400, abs=4) and taken[("a", "b")] + taken[("b",)] >= 200


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_mix_with_a_document_larger_than_half_its_source(spark, seed):
    """The long document does not fit; the short ones behind it, in hash order, still fill the quota."""
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(100, 700), "en", "a") for i in range(500)] + [(500, "w " * 400_000, "en", "a")]
    total = sum(len(t) // 2 for _, t, _, _ in rows)
    got = mixing.mix(make_docs(spark, rows), share=180_000 / total, seed=seed).collect()
    assert sum(r["taken"] for r in got) == pytest.approx(180_000, rel=0.01)


def test_flow_grows_with_its_patterns():
    """As many sources as the bound on patterns allows, and as many pairs of sources."""
    import time

    rng = random.Random(12)
    alone = {(s,): rng.randint(1, 1000) for s in range(mixing.MAX_PATTERNS)}
    pairs = {}
    while len(pairs) < mixing.MAX_PATTERNS:
        pairs[tuple(sorted(rng.sample(range(20_000), 2)))] = rng.randint(1, 1000)
    for patterns in (alone, pairs):
        sizes = Counter()
        for p, words in patterns.items():
            for s in p:
                sizes[s] += words
        wanted = mixing.quotas(sizes, total=sum(patterns.values()))
        begun = time.monotonic()
        flow = mixing.route(patterns, wanted)
        assert time.monotonic() - begun < 60
        assert all(sum(f.values()) <= mixing.REPEATS * patterns[p] for p, f in flow.items())
        got = Counter()
        for f in flow.values():
            got.update(f)
        assert all(got[s] <= round(w) for s, w in wanted.items())
        assert sum(got.values()) >= 0.999 * sum(map(round, wanted.values()))
