"""Similarity join on word shingles by grouped prefixes, and the components of its links.

Documents with equal shingle sets are one class. Two sets link when their Jaccard coefficient is at least
``percent`` / 100. All further work concerns distinct sets:

1. Frequencies. Packed shingles are dealt out by their value; a shingle that only one set holds is dropped
   there. The rest goes back to the sets, with its exact document frequency.
2. A partner shares at least ``percent`` of a set, so a set with fewer shared shingles than that has no
   partner and is done. Shingles are ordered rarest first; of a set with n of them, the first
   ``n - ceil(percent n) + 1`` are its prefix, and sets that link have a prefix shingle in common.
3. Sets with equal size and equal prefix are collapsed into one group. Group pairs that share a prefix
   shingle pass the size filter and the positional filter; their members are expanded and verified.

All pairs inside a long posting list would grow with the square of a family of near copies. So the pairs are
verified in rounds. The first compares each group with one centre of each of its families, the next ones with
centres drawn anew for every posting list, more in each round; what links is joined into components, and prefix
shingles that can lead to no other component any more are dropped. Rounds go on while all pairs left between
components are more than the next round would compare. The last takes every candidate pair that is left between
*different* components. A pair inside a component could not change the result, so no link that matters is left
out, and where a family has become one component nothing of it is enumerated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm.common import raw_texts, release, ship, slices, stored
from candela.llm.components import components

WORDS, PERCENT = 5, 75
#: Shingles that one task holds at a time while frequencies are counted, and before they are dealt out, about.
#: A set costs nine bytes in every range that it meets, so wide ranges keep the exchanges near the shingles' own size.
TOKENS_PER_RANGE, TOKENS_PER_FLUSH = 4_000_000, 500_000
#: Slices in which a task counts its range, one after the other.
SLICES = 8
#: Seeds of the centres that each round draws, before all remaining pairs are taken; only the work depends on it.
CENTRES = (range(1), range(1, 3), range(3, 11), range(11, 27))
#: Pairs of 16 bytes that are sent to every executor, at most (16 MB).
BROADCAST_PAIRS = 1_000_000
#: Members of a unit whose shingles are united for the test of a pair of units, about.
BUNDLE = 32
_PRIME = np.uint64(0x9E3779B185EBCA87)
_SHIFT = np.uint64(29)


def shingle_sets(raws: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text: ASCII lower case, words between ASCII white space; a
    text with fewer than ``words`` words has its whole sequence as the one shingle, without words none."""
    digest = xxhash.xxh64_intdigest
    out = []
    for raw in raws:
        found = raw.lower().split()  # bytes: A-Z and \x20, \x09-\x0D only
        if len(found) < words:
            out.append(np.array([digest(b"\0".join(found), seed=len(found))] if found else [], np.uint64))
            continue
        h = np.fromiter(map(digest, found), np.uint64, len(found))
        n = len(found) - words + 1
        acc = np.zeros(n, np.uint64)
        for k in range(words):
            acc ^= h[k : k + n]
            acc *= _PRIME
            acc ^= acc >> _SHIFT
        out.append(np.unique(acc))
    return out


def _key(tokens: np.ndarray) -> int:
    """Name of a set: signed 64-bit hash of its sorted shingles."""
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes(), seed=3)).view(np.int64))


def sets_of(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The columns of ``docs`` but its text, n (size of its set), key (name of the set; null for an empty one)."""
    own = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch):
                found = shingle_sets(raw_texts(batch, start, stop), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(f.name).slice(start, stop - start) for f in own),
                        pa.array([len(t) for t in found], pa.int64()),
                        pa.array([_key(t) if len(t) else None for t in found], pa.int64()),
                    ],
                    names=[*(f.name for f in own), "n", "key"],
                )

    return docs.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in own), "n long", "key long"]))


#: Of a shingle's 64 bits the exchanges carry 48; its range, that is its leading bits, stands for the rest.
LOW_BITS = 48
#: ``range`` is what rows are dealt out by, ``part`` the range of the shingles. A set's size is not sent along.
_PACK = "range int, part int, keys binary, lengths binary, tokens binary, counts binary"


def _low(tokens: np.ndarray) -> bytes:
    """The low 48 bits of each token, six bytes each."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _whole(packed: np.ndarray, part: int) -> np.ndarray:
    """Tokens from their low six bytes and their range."""
    wide = np.zeros((len(packed) // 6, 8), np.uint8)
    wide[:, :6] = packed.reshape(-1, 6)
    return wide.reshape(-1).view("<u8") | np.uint64((part << LOW_BITS) & 0xFFFFFFFFFFFFFFFF)


def _narrow(x: np.ndarray) -> bytes:
    """Counts, each in as few bytes as the largest needs."""
    return x.astype(np.min_scalar_type(int(x.max()))).tobytes()


def _counts(packed: bytes, n: int) -> np.ndarray:
    """The ``n`` counts of ``_narrow``; none if nothing was packed."""
    return np.zeros(0, np.uint32) if not packed else np.frombuffer(packed, f"<u{len(packed) // n}").astype(np.uint32)


def _pack(where: np.ndarray, owner: np.ndarray, keys: np.ndarray, tokens: np.ndarray, counts: np.ndarray | None = None, part: int | None = None) -> Iterator[tuple]:
    """Rows of ``_PACK``, one per range in use: tokens by owner, each owner with its key."""
    order = np.lexsort((owner, where))
    where, owner, tokens = where[order], owner[order], tokens[order]
    counts = counts[order] if counts is not None else None
    used, cuts = np.unique(where, return_index=True)
    for r, a, b in zip(used.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(where)], strict=True):
        who, lengths = np.unique(owner[a:b], return_counts=True)
        yield r, r if part is None else part, keys[who].tobytes(), _narrow(lengths), _low(tokens[a:b]), b"" if counts is None else _narrow(counts[a:b])


def _packs(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    names = [f.split(" ")[0] for f in _PACK.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the sets, the number of tokens of each, the tokens and their counts (none in the first exchange)."""
    keys, lengths, tokens, counts = [], [], [], []
    for part, k, n, t, c in zip(*(table.column(name).to_pylist() for name in ("part", "keys", "lengths", "tokens", "counts")), strict=True):
        keys.append(np.frombuffer(k, np.int64))
        lengths.append(_counts(n, len(keys[-1])))
        tokens.append(_whole(np.frombuffer(t, np.uint8), part))
        counts.append(_counts(c, len(tokens[-1])))
    return tuple(map(np.concatenate, (keys, lengths, tokens, counts)))


def _scattered(batches: Iterable[pa.RecordBatch], ranges: int, words: int) -> Iterator[pa.RecordBatch]:
    """The shingles of every distinct set in ``batches``, packed by range of their value, ``TOKENS_PER_FLUSH`` at a time."""
    seen: set[int] = set()
    held: list[np.ndarray] = []
    keys: list[int] = []

    def flush() -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(held), dtype=np.int32), [len(t) for t in held])
        tokens = np.concatenate(held)
        where = (((tokens >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int32)
        out = _packs(list(_pack(where, owner, np.array(keys, np.int64), tokens)))
        held.clear()
        keys.clear()
        return out

    total = 0
    for batch in batches:
        for start, stop in slices(batch):
            for tokens in shingle_sets(raw_texts(batch, start, stop), words):
                if len(tokens) and (key := _key(tokens)) not in seen:
                    seen.add(key)
                    held.append(tokens)
                    keys.append(key)
                    total += len(tokens)
                if total >= TOKENS_PER_FLUSH:
                    yield flush()
                    total = 0
    if held:
        yield flush()


def _scatter(docs: DataFrame, ranges: int, words: int) -> DataFrame:
    """The packed shingles of every distinct set of a task."""
    return docs.select("text").mapInArrow(lambda batches: _scattered(batches, ranges, words), _PACK)


def _shared(table: pa.Table, back: int) -> pa.Table:
    """Of one range of shingles, those that at least two sets hold, with their frequency, packed by range of the set's key.

    The range is counted in ``SLICES`` by the shingles' next bits, so that one slice at a time is spread out; what is
    found is packed whenever it comes to ``TOKENS_PER_FLUSH``."""
    read = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]  # noqa: E731  no copy
    part = table.column("part")[0].as_py()
    keys, packed = read("keys", np.int64), read("tokens", np.uint8)
    lengths = [_counts(x.as_py(), len(k)) for x, k in zip(table.column("lengths"), keys, strict=True)]
    whole = np.concatenate(keys)
    names, first = np.unique(whole, return_index=True)
    places = np.full(len(whole), -1, np.int32)
    places[first] = np.searchsorted(names, whole[first])  # a set that several tasks met counts once
    places = np.split(places, np.cumsum([len(k) for k in keys])[:-1])
    found, packs = [], []

    def flush() -> None:
        owner, tokens, counts = map(np.concatenate, zip(*found, strict=True))
        found.clear()
        packs.append(_packs(list(_pack(names[owner] % back, owner, names, tokens, counts, part))))

    for k in range(SLICES):
        owners, parts = [], []
        for place, length, low in zip(places, lengths, packed, strict=True):
            owner, tokens = np.repeat(place, length), _whole(low, part)
            here = (owner >= 0) & ((tokens >> np.uint64(LOW_BITS - 16)) % np.uint64(SLICES) == k)
            owners.append(owner[here])
            parts.append(tokens[here])
        owner, tokens = np.concatenate(owners), np.concatenate(parts)
        del owners, parts
        if not len(tokens):
            continue
        order = np.argsort(tokens, kind="stable")
        owner, tokens = owner[order], tokens[order]
        del order
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        n = np.diff(np.append(starts, len(tokens))).astype(np.uint32)
        counts = np.repeat(n, n)
        many = counts > 1
        found.append((owner[many], tokens[many], counts[many]))
        if sum(len(x[1]) for x in found) >= TOKENS_PER_FLUSH:
            flush()
    if found:
        flush()
    return pa.Table.from_batches(packs or [_packs([])])


_SETS = "key long, n int, gid long, single int, prefix array<long>, tokens array<long>"


def _assemble(table: pa.Table, sizes: pa.Table, percent: int) -> pa.Table:
    """Sets of one range that may have a partner: shared shingles rarest first, prefix and group.
    ``sizes`` (key, n) has every set of the range."""
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    columns = [f.split(" ")[0] for f in _SETS.split(", ")]
    if not table.num_rows:
        return pa.table([pa.array([], t) for t in kinds], names=columns)
    keys, lengths, tokens, counts = _unpack(table)
    names = np.unique(keys)
    owner = np.repeat(np.searchsorted(names, keys), lengths)
    known, n_of = sizes.column("key").to_numpy(), sizes.column("n").to_numpy()
    by_key = np.argsort(known)
    n = n_of[by_key[np.searchsorted(known, names, sorter=by_key)]].astype(np.int64)
    order = np.lexsort((tokens, counts, owner))
    tokens = tokens[order].view(np.int64)
    del order, counts
    held = np.bincount(owner, minlength=len(names))
    need = -(-percent * n // 100)
    keep = held >= need
    at = np.arange(len(tokens)) - np.repeat(np.cumsum(held) - held, held)  # owners are in order by now
    first = at < np.repeat(np.where(keep, held - need + 1, 0), held)  # the prefix: n - need + 1 without the dropped shingles
    tokens, first = tokens[kept := np.repeat(keep, held)], first[kept]
    del at, kept, owner
    names, n, held, need = names[keep], n[keep], held[keep], need[keep]
    prefix, cuts = tokens[first], np.concatenate(([0], np.cumsum(held - need + 1)))
    single = n - held
    digest = xxhash.xxh64_intdigest
    gids = [digest(np.array([n[i], single[i]], np.int64).tobytes() + prefix[cuts[i] : cuts[i + 1]].tobytes()) for i in range(len(names))]
    lists = [pa.ListArray.from_arrays(pa.array(c, pa.int32()), pa.array(x, pa.int64())) for c, x in ((cuts, prefix), (np.concatenate(([0], np.cumsum(held))), tokens))]
    flat = [pa.array(c, t) for c, t in zip((names, n, np.array(gids, np.uint64).view(np.int64), single), kinds, strict=False)]
    return pa.table([*flat, *lists], names=columns)


def candidates_sets(docs: DataFrame, classes: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The distinct sets that share enough shingles with others; ``classes`` is ``sets_of`` the same documents."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-total // TOKENS_PER_RANGE))
    packs = _scatter(docs, ranges, words)
    shared = packs.groupBy("range").applyInArrow(lambda t: _shared(t, ranges), _PACK)  # all shingles may be shared, so as many ranges of sets
    sizes = classes.where("key is not null").groupBy("key").agg(F.max("n").alias("n")).withColumn("range", F.pmod("key", F.lit(ranges)).cast("int"))
    whole = shared.groupBy("range").cogroup(sizes.groupBy("range"))
    return stored(whole.applyInArrow(lambda t, n: _assemble(t, n, percent), _SETS), "join-sets")


def _passes(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Size and positional filter: whether two sets that meet at these positions can share enough.

    They need ``percent / (100 + percent)`` of both sizes in common, and no more than this shingle and what
    follows it in the shorter rest. (The bound is meant for their first common shingle, which always passes.)
    """
    rest = F.least(na - pa_, nb - pb)
    return (na * 100 >= nb * percent) & (nb * 100 >= na * percent) & (rest * (100 + percent) >= (na + nb) * percent)


def _only(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``sets`` named by the stored ``keys``: while these are few enough to be sent to every executor, the
    others are left out before a shuffle; with more they are left to the join that follows."""
    return sets.join(F.broadcast(keys), "key", "left_semi") if keys.count() <= BROADCAST_PAIRS else sets


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of set keys that link, compared on their whole sets.

    While the pairs are few enough to be sent to every executor, sets without a pair are left out before
    the shuffle; with more pairs they are left out by the joins themselves."""
    pairs = stored(pairs, "join-pairs")
    if pairs.count() <= BROADCAST_PAIRS:
        keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
        sets, pairs = sets.join(F.broadcast(keys), "key", "left_semi"), F.broadcast(pairs)
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= (F.col("na") + F.col("nb") - both) * percent).select("a", "b")


def _merged(placed: DataFrame, found: DataFrame) -> DataFrame:
    """``placed`` with the components that the links ``found`` join."""
    ends = found.join(placed.select(F.col("key").alias("a"), F.col("comp").alias("ca")), "a").join(placed.select(F.col("key").alias("b"), F.col("comp").alias("cb")), "b")
    roots = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    return stored(placed.join(roots.withColumnRenamed("node", "comp"), "comp", "left").select("key", "gid", F.coalesce("root", "comp").alias("comp")), "join-placed")


def _lists(groups: DataFrame, of: DataFrame) -> DataFrame:
    """The posting lists: a row for each prefix shingle of the units ``of`` (gid, ...). Groups meet their
    units before their prefixes are expanded."""
    return groups.join(of, "gid").select(*of.columns, "n", F.explode("prefix").alias("p")).select(*of.columns, "n", "p.token", "p.pos")


def _to_centres(lists: DataFrame, placed: DataFrame, seeds: Iterable[int], percent: int, each: bool) -> DataFrame:
    """Pairs (a, b) of keys: the members of each unit (group, component) of ``lists``, and the first member of a centre
    unit of another component. Every posting list has a centre for each seed, drawn for ``each`` list of its own or
    by one order of all units, so that lists of the same units have the same one; there are as many rows as
    postings for a seed, at most."""
    own = ["token"] if each else []
    draw = lambda seed: F.min(F.struct(F.xxhash64(F.lit(seed), *own, "comp", "gid").alias("h"), "comp", "head", "n", "pos"))
    drawn = lists.groupBy("token").agg(F.array_distinct(F.array(*map(draw, seeds))).alias("c"), F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y")
    centre = drawn.select("token", F.explode("c").alias("c")).select("token", F.col("c.comp").alias("cc"), F.col("c.head").alias("b"), F.col("c.n").alias("cn"), F.col("c.pos").alias("cp"))
    near = (
        lists.join(centre, "token")
        .where((F.col("comp") != F.col("cc")) & _passes(F.col("n"), F.col("pos"), F.col("cn"), F.col("cp"), percent))
        .select("gid", "comp", "b")
        .distinct()
    )
    return near.join(placed, ["gid", "comp"]).select(F.col("key").alias("a"), "b")


def _reachable(groups: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """``groups`` with those prefix shingles that may lead to a partner in another component: the smallest set of the
    shingle's list is the easiest one to link with, and even it needs enough shingles from the posting on."""
    lists = _lists(groups, placed.groupBy("gid").agg(F.min("comp").alias("x"), F.max("comp").alias("y")))
    ends = lists.groupBy("token").agg(F.min("n").alias("floor"), F.min("x").alias("x"), F.max("y").alias("y")).where("x != y")
    smallest = f"greatest(floor, ceil(n * {percent} / 100))"
    near = lists.drop("x", "y").join(ends.select("token", "floor"), "token").where(f"(n - pos) * {100 + percent} >= (n + {smallest}) * {percent}")
    return near.groupBy("gid").agg(F.first("n").alias("n"), F.collect_list(F.struct("token", "pos")).alias("prefix"))


def _left(lists: DataFrame) -> tuple[int, int]:
    """The number of postings, and of pairs of postings with one shingle in different components."""
    of = lists.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("token").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("own"))
    postings, twice = of.agg(F.sum("c"), F.sum(F.col("c").cast("decimal(38,0)") * F.col("c") - F.col("own"))).first()
    return int(postings or 0), int(twice or 0) // 2


def _bundles(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """(gid, comp, bundle, n, members, union): the members of each unit in bundles of about ``BUNDLE``, with
    all shingles that one of a bundle's members holds."""
    size = placed.groupBy("gid", "comp").agg(F.ceil(F.count(F.lit(1)) / BUNDLE).alias("bundles"))
    dealt = stored(placed.join(size, ["gid", "comp"]).withColumn("bundle", F.pmod(F.xxhash64("key"), F.col("bundles"))), "join-dealt")
    whole = dealt.join(_only(sets, dealt.select("key")).select("key", "n", "tokens"), "key").groupBy("gid", "comp", "bundle")
    return whole.agg(
        F.first("n").alias("n"), F.collect_list("key").alias("members"), F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union")
    )


def _crossing(groups: DataFrame, placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs (a, b) of keys in different components. ``groups`` have the shingles that can have a
    partner; posting lists are reduced to (shingle, component), so nothing is enumerated inside a component. Pairs
    of units are tested by the unions of their members, in bundles, before any member is paired."""
    lists = stored(_lists(groups, placed.select("gid", "comp").distinct()), "join-postings")
    spans = lists.groupBy("token", "comp").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    several = spans.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("token")
    spans = stored(spans.join(several, "token"), "join-spans")
    one = spans.select("token", F.col("comp").alias("ca"), F.col("least").alias("la"), F.col("most").alias("ma"), F.col("rest").alias("ra"))
    two = spans.select("token", F.col("comp").alias("cb"), F.col("least").alias("lb"), F.col("most").alias("mb"), F.col("rest").alias("rb"))
    fits = f"ma * 100 >= lb * {percent} and mb * 100 >= la * {percent} and least(ra, rb) * {100 + percent} >= (la + lb) * {percent}"
    meets = one.join(two, "token").where("ca < cb and " + fits).select("token", "ca", "cb", "lb", "mb", "rb")
    left = lists.select("token", F.col("comp").alias("ca"), F.col("gid").alias("ga"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    right = lists.select("token", F.col("comp").alias("cb"), F.col("gid").alias("gb"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    may = f"na * 100 >= lb * {percent} and mb * 100 >= na * {percent} and least(na - pa, rb) * {100 + percent} >= (na + lb) * {percent}"
    pairs = (
        meets.join(left, ["token", "ca"])
        .where(may)
        .join(right, ["token", "cb"])
        .where(_passes(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent))
        .select("ga", "ca", "gb", "cb")
        .distinct()
    )
    pairs = stored(pairs, "join-units")
    # Only units of a pair are bundled.
    use = pairs.select(F.col("ga").alias("gid"), F.col("ca").alias("comp")).unionByName(pairs.select(F.col("gb").alias("gid"), F.col("cb").alias("comp"))).distinct()
    bundles = stored(_bundles(placed.join(use, ["gid", "comp"], "left_semi"), sets), "join-bundles")
    side = lambda x: bundles.select(*[F.col(c).alias(f"{c}_{x}") for c in bundles.columns])
    met = pairs.join(side("a").withColumnsRenamed({"gid_a": "ga", "comp_a": "ca"}), ["ga", "ca"]).join(side("b").withColumnsRenamed({"gid_b": "gb", "comp_b": "cb"}), ["gb", "cb"])
    shared = F.size(F.array_intersect("union_a", "union_b"))
    kept = met.where(shared * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent)
    return kept.select(F.explode("members_a").alias("a"), "members_b").select("a", F.explode("members_b").alias("b"))


def component_map(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, gid, comp) of every set: see the module's head. ``comp`` is the least key of the component."""
    prefix = F.transform("prefix", lambda token, at: F.struct(token.alias("token"), (F.col("single") + at).alias("pos")))
    groups = stored(sets.dropDuplicates(["gid"]).select("gid", "n", prefix.alias("prefix")), "join-groups")
    placed = stored(sets.select("key", "gid", F.col("key").alias("comp")), "join-placed")
    for k, seeds in enumerate(CENTRES):
        lists = _lists(groups, placed.groupBy("gid", "comp").agg(F.min("key").alias("head")))
        if k > 1:
            lists = stored(lists, "join-lists")
            postings, pairs = _left(lists)
            if pairs <= postings * len(seeds):
                break
        found = stored(verified(_to_centres(lists, placed, seeds, percent, each=k > 0), sets, percent), "join-links")
        if found.isEmpty():
            break
        placed = _merged(placed, found)
        groups = stored(_reachable(groups, placed, percent), "join-groups")
        release(sets.sparkSession)
    groups = _reachable(groups, placed, percent)
    found = stored(verified(_crossing(groups, placed, sets, percent), sets, percent), "join-links")
    return placed if found.isEmpty() else _merged(placed, found)


def _marked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The columns of ``docs`` (doc_id, text and others) but its text, with n, key, root (least key of the component) and
    component (least id of the component). Rows without words have neither key, root nor component."""
    ship(docs.sparkSession)
    classes = stored(sets_of(docs, words), "join-classes")
    sets = candidates_sets(docs.select("doc_id", "text"), classes, words, percent)
    release(docs.sparkSession)
    comps = component_map(sets, percent).select("key", "comp")
    least = classes.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = stored(least.join(comps, "key", "left").select("key", F.coalesce("comp", "key").alias("root"), "least"), "join-rooted")
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    names = stored(rooted.join(lowest, "root").select("key", "root", "component"), "join-names")
    return classes.join(names, "key", "left")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links, itself included), class (name of the shingle set).

    Null texts and texts without words have an empty set, link with nothing and are their own component.
    Rows with a null id take part; a component of such rows alone has a null component_id. Repeated rows
    are rows of their own in one component. Extra columns are not read; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return _marked(docs, words, percent).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.col("key").alias("class"),
    )


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: of each component the row with the smallest id,
    and of several rows with that id the one with the smallest text, once. Rows that share an id but not their
    component are told apart by their text. Of a component in which no row has an id, the row with the smallest
    text stays, once; a row without an id that is linked to one with an id goes. Null and empty texts and others
    without words are linked with nothing and all stay. An empty table gives an empty result."""
    columns = docs.columns
    text = F.coalesce("text", F.lit(""))
    own = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__sha", F.sha2(text.cast("binary"), 256))
    marked = _marked(own.select(F.col("__id").alias("doc_id"), "text", F.col("__sha").alias("sha")), words, percent)
    first = marked.where("key is not null and (doc_id = component or component is null)").select("doc_id", "sha", "root").distinct()
    first = first.select(F.col("doc_id").alias("__i"), F.col("sha").alias("__s"), F.col("root").alias("__root"))
    left = own.join(first, own["__id"].eqNullSafe(first["__i"]) & (own["__sha"] == first["__s"]))
    one = Window.partitionBy("__root", "__id").orderBy(text)
    blank = docs.where(~text.rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*columns).unionByName(blank)
