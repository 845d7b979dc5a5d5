"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold them). The driver sees one row
per pattern, never a document. Word capacity of the patterns is routed to the sources' quotas; the r-th
repetition of a pattern costs more than the one before (convex costs), so that nothing is repeated while
unrepeated words remain that may serve the same quota. A pattern's flow then says how often each of its
documents is taken: whole repetitions of all, and one more for a seeded choice of them.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm.common import ship, stored

WEIGHTS = (5, 2, 1)
REPEATS = 3
SEED = 17
#: Patterns the driver plans for; more of them (a source per document, say) is an error, not a silent cut.
MAX_PATTERNS = 100_000
#: Bits of the range of a document's hash. The seeded choice adds up ranges; only the range at a boundary is ordered by document.
RANGE_BITS = 16


def n_words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ordered(sources: Sequence[str | None]) -> list[str | None]:
    """By code point, null last."""
    return sorted((s for s in set(sources) if s is not None)) + [None] * (None in set(sources))


def quotas(sizes: dict, weights: Sequence[float] = WEIGHTS, share: float = 1.0, repeats: int = REPEATS, total: int | None = None) -> dict:
    """Words wanted of each source. ``share`` of ``total`` (default: the sum of the sizes) goes to the
    sources by weight; a target above ``repeats`` times its source's size stops there and its excess is
    shared again by weight among the others, until none is above."""
    names = ordered(list(sizes))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    total = sum(sizes.values()) if total is None else total
    capped: set = set()
    while True:
        left = share * total - sum(repeats * sizes[s] for s in names if s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: float(repeats * sizes[s]) if s in capped else max(0.0, left) * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > repeats * sizes[s]}
        if not over:
            return target
        capped |= over


def route(patterns: dict[tuple, int], wanted: dict, repeats: int = REPEATS) -> dict[tuple, dict]:
    """Min-cost flow: pattern -> {source: words}. ``patterns`` has each pattern's words (the capacity of one
    repetition), ``wanted`` each source's quota. Repetition r (from 0) costs 2**r - 1 a word.

    Only repetitions cost anything, so an augmenting path costs what the current repetition of its last pattern
    costs, and the cheapest paths are found repetition by repetition. In each, a source first takes words straight
    from its own patterns; what it still lacks comes over shortest paths, on which it may take words from another
    source that can be served elsewhere. A search that finds nothing has seen a closed set of sources: none of
    them is searched again in this repetition. What cannot be routed stays unfilled.
    """
    flow: dict[tuple, dict] = {p: dict.fromkeys(p, 0) for p in patterns}
    used = dict.fromkeys(patterns, 0)
    holders: dict = {s: [] for s in wanted}
    for p, words in patterns.items():
        for s in flow[p] if words > 0 else ():
            if s in holders:
                holders[s].append(p)
    left = {s: round(q) for s, q in wanted.items()}

    def shortest(start, r: int, closed: set) -> tuple | None:
        """(pattern with room, source that takes of it, [(source, pattern it takes words of, source that gives them up)...])."""
        came, queue = {start: None}, deque([start])
        while queue:
            source = queue.popleft()
            for p in holders[source]:
                if used[p] < (r + 1) * patterns[p]:
                    path, at = [], source
                    while came[at] is not None:
                        path.append((*came[at], at))
                        at = came[at][0]
                    return p, source, path
                for giver, words in flow[p].items():
                    if words > 0 and giver not in came and giver not in closed:
                        came[giver] = (source, p)
                        queue.append(giver)
        closed.update(came)
        return None

    for r in range(repeats):
        for s in wanted:
            for p in holders[s]:
                amount = min(left[s], (r + 1) * patterns[p] - used[p])
                if amount > 0:
                    flow[p][s] += amount
                    used[p] += amount
                    left[s] -= amount
        closed: set = set()
        for s in wanted:
            while left[s] > 0 and s not in closed and (found := shortest(s, r, closed)):
                p, end, path = found
                amount = min([left[s], (r + 1) * patterns[p] - used[p], *(flow[via][giver] for _, via, giver in path)])
                flow[p][end] += amount
                used[p] += amount
                for taker, via, giver in path:
                    flow[via][giver] -= amount
                    flow[via][taker] += amount
                left[s] -= amount
    return flow


def _choose(units: DataFrame, rests: dict[int, int]) -> tuple[list[tuple], dict[int, tuple]]:
    """A seeded choice of documents (pattern, doc_id, h, range, size) with about ``rests`` words of each pattern.

    In the order of (h, doc_id) a document is taken if it fits into what is still missing, and passed over
    otherwise. A round does that for a whole stretch: of the documents behind the last one taken that are no
    larger than the gap, those up to the first that does not fit. The gap falls below the size of that one, so
    the rounds are few; they go on until no document fits. Then the document nearest to the gap is added
    where the pattern comes nearer to its words by it. A round brings one row per pattern to the driver.

    Gives the cuts (pattern, gap, h, doc_id): documents of at most ``gap`` words up to that place are taken;
    and the document added last, pattern -> (h, doc_id).
    """
    spark = units.sparkSession
    kind = units.schema["doc_id"].dataType.simpleString()
    gaps, last, cuts = dict(rests), {}, []
    going = sorted(gaps)
    upto = F.sum("words").over(Window.partitionBy("pattern").orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    inside = F.sum("size").over(Window.partitionBy("pattern").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    end = F.struct("h", "doc_id")
    while going:
        state = spark.createDataFrame([(p, gaps[p], *last.get(p, (None, None))) for p in going], f"pattern int, gap long, last_h long, last_id {kind}")
        left = units.join(F.broadcast(state), "pattern").where(
            "size > 0 and size <= gap and (last_h is null or h > last_h or (h = last_h and doc_id is not null and (last_id is null or doc_id > last_id)))"
        )
        ranges = left.groupBy("pattern", "gap", "range").agg(F.sum("size").alias("words"), F.max(end).alias("end")).withColumn("upto", upto)
        found = {
            r["pattern"]: r
            for r in ranges.groupBy("pattern")
            .agg(
                F.max(F.when(F.col("upto") <= F.col("gap"), F.struct("upto", "end"))).alias("fit"),
                F.min(F.when(F.col("upto") > F.col("gap"), F.struct("range", (F.col("upto") - F.col("words")).alias("done")))).alias("edge"),
            )
            .collect()
        }
        fit = {p: r["fit"] for p, r in found.items()}
        edges = [(p, *r["edge"]) for p, r in found.items() if r["edge"]]
        if edges:
            edge = F.broadcast(spark.createDataFrame(edges, "pattern int, range long, done long"))
            at = left.join(edge, ["pattern", "range"]).withColumn("upto", F.col("done") + inside).where("upto <= gap")
            fit |= {r["pattern"]: r["fit"] for r in at.groupBy("pattern").agg(F.max(F.struct("upto", end.alias("end"))).alias("fit")).collect()}
        for p, f in fit.items():
            last[p] = (f["end"]["h"], f["end"]["doc_id"])
            cuts.append((p, gaps[p], *last[p]))
            gaps[p] -= f["upto"]
        going = sorted(p for p, _, _ in edges if gaps[p] > 0)  # without an edge, all that fit are taken
    fills = {}
    missing = [(p, g) for p, g in gaps.items() if g > 0]
    if missing:
        cut = F.broadcast(spark.createDataFrame(cuts, f"p int, most long, last_h long, last_id {kind}"))
        taken = (F.col("pattern") == F.col("p")) & F.expr("size <= most and (h < last_h or (h = last_h and (doc_id is null or doc_id <= last_id)))")
        near = (
            units.join(F.broadcast(spark.createDataFrame(missing, "pattern int, gap long")), "pattern")
            .where("size > gap and size < 2 * gap")
            .join(cut, taken, "left_anti")
            .groupBy("pattern").agg(F.min(F.struct("size", "h", "doc_id")).alias("fill"))
        )
        fills = {r["pattern"]: (r["fill"]["h"], r["fill"]["doc_id"]) for r in near.collect()}
    return cuts, fills


def mix(docs: DataFrame, members: Column | None = None, id_column: str = "doc_id", text_column: str = "text", weights: Sequence[float] = WEIGHTS, share: float = 1.0, repeats: int = REPEATS, seed: int = SEED, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """One row per document: doc_id, members (its sources), size, copies, taken (``copies * size`` words).

    ``members`` gives the sources of a document as an array (default: the one in ``source``); null is a
    source like any other and comes last. Quotas, flow and choice depend on rows and ``seed`` alone, so
    reruns agree. Rows with the same id are chosen together. A document without words takes no part in the
    quotas and has ``taken`` 0; no document is taken more than ``repeats`` times. Extra columns are not
    read; an empty table gives an empty result. More than ``max_patterns`` patterns raise ValueError.
    Further columns: pattern (id of the set of sources).
    """
    spark = docs.sparkSession
    ship(spark)
    sources = F.array(F.col("source").cast("string")) if members is None else members
    slim = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.sort_array(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string"))))).alias("members"),
            n_words(F.col(text_column)).alias("size"),
            F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_column)), 1).alias("h"),
        ).withColumn("range", F.shiftright("h", 63 - RANGE_BITS)),
        "mix-sizes",
    )
    found = slim.groupBy("members").agg(F.sum("size").alias("words")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = {tuple(r["members"]): int(r["words"]) for r in found}
    sizes: dict = {}
    for p, words in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + words
    target = quotas(sizes, weights, share, repeats, total=sum(patterns.values()))
    flow = route(patterns, target, repeats)
    plan = []
    for i, p in enumerate(sorted(patterns, key=lambda p: [(s is None, s or "") for s in p])):
        words = sum(flow[p].values())
        whole, rest = divmod(words, patterns[p]) if patterns[p] else (0, 0)
        plan.append((i, list(p), whole, rest))
    schema = "pattern int, members array<string>, whole long, rest long"
    plan_df = F.broadcast(spark.createDataFrame(plan, schema))  # at most max_patterns rows
    same = slim["members"].eqNullSafe(plan_df["members"])
    rows = slim.join(plan_df, same, "left").drop(plan_df["members"])

    units = stored(rows.where("rest > 0").groupBy("pattern", "doc_id", "h", "range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "mix-units")
    cuts, fills = _choose(units, {i: rest for i, _, _, rest in plan if rest})
    id_type = slim.schema["doc_id"].dataType.simpleString()
    by_pattern: dict[int, list] = {}
    for p, *cut in cuts:
        by_pattern.setdefault(p, []).append(tuple(cut))
    chosen = [(p, by_pattern.get(p, []), fills.get(p)) for p in by_pattern.keys() | fills.keys()]
    chosen_df = F.broadcast(spark.createDataFrame(chosen, f"pattern int, cuts array<struct<gap: long, h: long, id: {id_type}>>, fill struct<h: long, id: {id_type}>"))  # one row per pattern
    together = units.where("n > 1").select("pattern", "doc_id", F.col("size").alias("together"))
    rows = rows.join(chosen_df, "pattern", "left")
    rows = rows.join(together, (rows["pattern"] == together["pattern"]) & rows["doc_id"].eqNullSafe(together["doc_id"]), "left").drop(together["pattern"], together["doc_id"])
    upto = "h < c.h or (h = c.h and (doc_id is null or doc_id <= c.id))"
    taken = F.expr(f"coalesce(exists(cuts, c -> coalesce(coalesce(together, size) <= c.gap and ({upto}), false)), false) or coalesce(h = fill.h and doc_id <=> fill.id, false)")
    extra = taken.cast("long")
    totals = spark.createDataFrame([(list(p), sum(sizes[s] for s in p), float(sum(target[s] for s in p))) for p in patterns], "members array<string>, source_size long, target double")
    totals = F.broadcast(totals)
    out = rows.withColumn("copies", F.col("whole") + extra)
    return out.join(totals, out["members"].eqNullSafe(totals["members"]), "left").select(
        "doc_id", out["members"], "pattern", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each document repeated as often as the mix takes it, with its own columns only.

    Documents that the mix does not take go, those with null or empty texts among them (they have no words). Rows
    that share an id and sources are repeated alike, as often as the one taken most. Ties are settled by the seed; an
    empty table gives an empty result."""
    columns = docs.columns
    picked = mix(docs, **options).where("copies > 0").groupBy(F.col("doc_id").alias("__id"), F.col("members").alias("__m")).agg(F.max("copies").alias("__copies"))
    sources = options.get("members")
    sources = F.array(F.col("source").cast("string")) if sources is None else sources
    own = docs.withColumn("__own", F.col("doc_id")).withColumn("__src", F.sort_array(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string"))))))
    both = own.join(picked, own["__own"].eqNullSafe(picked["__id"]) & own["__src"].eqNullSafe(picked["__m"]))
    return both.withColumn("__k", F.explode(F.expr("sequence(1L, __copies)"))).select(*columns)
