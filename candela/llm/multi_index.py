"""Nearest neighbours by largest inner product through an inverted multi-index.

Each half of the vectors has its own codebook; a cell is a pair of centroids, one of either half. For a query
the cells are visited by summed distance (minus the inner products with the two centroids), the next pair
always taken from a heap over the two sorted lists, until the visited cells hold enough entries; these are
reranked with the exact inner product in double precision.

How many entries are enough is measured, not guessed: on the bounded sample that the codebooks are fitted on,
the share of entries that has to be visited to meet ``recall`` of the true neighbours of sampled queries.
Vectors that lie in clusters need few cells; vectors without any structure need a large share.

On Spark, the entries of one first-half centroid form a bucket, cut by hash into parts of bounded size.
Queries travel in blocks of neighbouring queries to the buckets that one of them visits, each part meets the
blocks as matrices, and the best of each part are merged. Equal vectors are one entry with the smallest ids,
which are all that a result can name.

An inner product needs two vectors of one width, so each width is an index of its own. Vectors of one component
get a second one of 0, which changes no product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm.common import ship, stored

#: Vectors that codebooks and probe share are fitted on, at most.
SAMPLE = 20_000
#: Queries of the sample that the probe share is measured with.
TRIALS = 200
RECALL = 0.97
#: Entries that a cell holds on average, about; centroids of a half at most.
PER_CELL, MOST_CENTROIDS = 40, 256
#: Entries of a part of a bucket; queries of a block; blocks of a group that meets a part at once.
PART, BLOCK, BLOCKS = 8192, 512, 16


def kmeans(x: np.ndarray, k: int, seed: int = 0, steps: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        near = nearest(x, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centroids))
        centroids[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centroids


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(axis=1) - 2 * (x @ centroids.T)).argmin(axis=1)


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """Cells in the order of summed distance until they hold ``enough`` entries.

    ``first``, ``second``: the query's distances to the centroids of either half."""
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    da, db = first[a].tolist(), second[b].tolist()
    held = counts.tolist()
    heap, out, n, rows, columns = [(da[0] + db[0], 0, 0)], [], 0, len(a), len(b)
    while heap and n < enough:
        _, i, j = heapq.heappop(heap)
        count = held[a[i]][b[j]]
        if count:
            out.append((a[i], b[j]))
            n += count
        if j == 0 and i + 1 < rows:  # each pair has one way in: along its row, and rows along the first column
            heapq.heappush(heap, (da[i + 1] + db[0], i + 1, 0))
        if j + 1 < columns:
            heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
    return out


def probe_share(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], k: int, recall: float, trials: int = TRIALS) -> float:
    """Share of entries to visit so that ``recall`` of the true ``k`` nearest of sampled queries are met."""
    if len(x) < 2:
        return 1.0
    half = len(books[0][0])
    cell = nearest(x[:, :half], books[0]) * len(books[1]) + nearest(x[:, half:], books[1])
    counts = np.bincount(cell, minlength=len(books[0]) * len(books[1]))
    queries = np.linspace(0, len(x) - 1, min(trials, len(x))).astype(int)
    needed = []
    for q in queries:
        scores = x @ x[q]
        scores[q] = -np.inf
        top = np.argpartition(-scores, min(k, len(x) - 1) - 1)[: min(k, len(x) - 1)]
        distance = (-(books[0] @ x[q, :half]))[:, None] - (books[1] @ x[q, half:])[None, :]
        order = np.argsort(distance.ravel(), kind="stable")
        upto = np.empty(len(order))
        upto[order] = np.cumsum(counts[order])
        needed.extend(upto[cell[top]] / len(x))
    return float(min(1.0, np.quantile(needed, recall) + 1 / len(x)))


def _own_bucket(batches: Iterator[pa.RecordBatch], book: np.ndarray, half: int, width: int) -> Iterator[pa.RecordBatch]:
    """Queries with the first-half bucket that they lie in themselves."""
    for batch in batches:
        q = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest(q[:, :half], book), pa.int32())], names=[*batch.schema.names, "own"])


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part: an id, no null or non-finite component, not zero."""
    bad = "exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    return (
        vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"))
        .where(f"vec_id is not null and v is not null and size(v) > 0 and not {bad} and exists(v, x -> x != 0)")
    )


def fit(rows: DataFrame, width: int, entries: int, k: int, recall: float, sample: int = SAMPLE) -> tuple[tuple[np.ndarray, np.ndarray], float]:
    """(codebooks, probe share) from the ``sample`` entries of ``width`` components with the smallest hash."""
    some = rows.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(sample).select("v").collect()
    x = np.array([r["v"] for r in some], np.float64)
    centroids = int(np.clip(np.sqrt(entries / PER_CELL), 2, MOST_CENTROIDS))
    books = kmeans(x[:, : width // 2], centroids, 1), kmeans(x[:, width // 2 :], centroids, 2)
    return books, probe_share(x, books, k, recall)


def of_width(rows: DataFrame, width: int) -> DataFrame:
    """The rows whose vector ``v`` has ``width`` components; a single one gets a 0 beside it."""
    same = rows.where(F.size("v") == width)
    if width > 1:
        return same
    return same.withColumn("v", F.concat("v", F.array(F.lit(0)).cast(rows.schema["v"].dataType)))


def search(vectors: DataFrame, every: int = 20, k: int = 20, recall: float = RECALL, sample: int = SAMPLE, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each vector whose id is divisible by ``every``.

    Vectors that are null, empty or zero, that hold null or non-finite components or that have no id take no part. The
    candidates of a query are the vectors of its own width; a job is run for each width in the table. Equal scores go to the smaller id. Rows repeated with the
    same id and vector count once; an id with several vectors is searched with each of them. A query has as
    many rows as it has candidates if these are fewer than ``k``; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_column, vector_column)
    # The k + 1 smallest ids of equal vectors; the limit works before the shuffle, so a vector that very many rows share stays small.
    few = rows.distinct().withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    distinct = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-vectors")
    widths = distinct.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy("width").collect()
    found = [_search(of_width(distinct, w), of_width(rows, w), max(w, 2), n, every, k, recall, sample) for w, n in widths]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def _search(distinct: DataFrame, rows: DataFrame, width: int, total: int, every: int, k: int, recall: float, sample: int) -> DataFrame:
    """The search among vectors of one width: ``distinct`` has a row for each of the ``total`` different ones, with its ids."""
    books, share = fit(distinct, width, total, k, recall, sample)
    half = width // 2

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            i, j = nearest(flat[:, :half], books[0]), nearest(flat[:, half:], books[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids"), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([r.tobytes() for r in flat], pa.binary())], names=["ids", "i", "j", "vec"]
            )

    index = stored(distinct.select("ids", "v").mapInArrow(assign, "ids array<long>, i int, j int, vec binary"), "ann-index")
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in index.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per cell at most
        counts[r["i"], r["j"]] = r["n"]
    held = int(counts.sum())
    enough = max(k + 1, share * held)
    parts = np.maximum(1, -(-counts.sum(axis=1) // PART))
    parts_of = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("i") + 1)

    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    own_schema = f"v {dict(rows.dtypes)['v']}, key long, own int"
    keyed = asked.groupBy("v").agg(F.min("vec_id").alias("key")).mapInArrow(lambda it: _own_bucket(it, books[0], half, width), own_schema)
    keyed = stored(keyed, "ann-queries")
    # Crowds: runs of first-half buckets with about BLOCK * BLOCKS queries; a larger bucket is cut by hash.
    most, crowd, room, first_crowd, cuts = BLOCK * BLOCKS, 0, BLOCK * BLOCKS, [0] * len(books[0]), [1] * len(books[0])
    per_bucket = {r["own"]: r["n"] for r in keyed.groupBy("own").agg(F.count(F.lit(1)).alias("n")).collect()}
    for own in range(len(books[0])):
        n = per_bucket.get(own, 0)
        if n > room:
            crowd, room = crowd + 1, most
        first_crowd[own], cuts[own] = crowd, max(1, -(-n // most))
        if cuts[own] > 1:
            crowd, room = crowd + cuts[own], most
        else:
            room -= n
    look = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("own") + 1)
    h = F.xxhash64("key")
    crowded = keyed.select("key", "v", (look(first_crowd) + F.pmod(h, look(cuts))).cast("long").alias("crowd"), F.pmod(F.shiftrightunsigned(h, 20), F.lit(BLOCKS)).cast("int").alias("block"))

    def block(part: pa.Table) -> pa.Table:
        """The queries of one block, for each bucket that one of them visits."""
        q = part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        keys = part.column("key").to_numpy().astype(np.int64)
        who_crowd = part.column("crowd")[0].as_py()
        first, second = -(q[:, :half] @ books[0].T), -(q[:, half:] @ books[1].T)
        visits = np.zeros((len(books[0]), len(q), len(books[1])), bool)
        for n in range(len(q)):
            cells = np.array(traverse(first[n], second[n], counts, enough))
            visits[cells[:, 0], n, cells[:, 1]] = True
        out = []
        for i in np.flatnonzero(visits.any(axis=(1, 2))):
            who = visits[i].any(axis=1)
            for p in range(parts[i]):
                out.append((int(i), p, who_crowd, keys[who].tobytes(), q[who].tobytes(), np.packbits(visits[i][who], axis=1).tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["i", "part", "crowd", "keys", "q", "mask"])

    def rerank(entries: pa.Table, blocks: pa.Table) -> pa.Table:
        keys, ids, scores = [], [], []
        if entries.num_rows and blocks.num_rows:
            e, own = _matrix(entries.column("vec"), width), entries.column("ids").to_pylist()
            j = entries.column("j").to_numpy()
            least = np.array([x[0] for x in own])
            order = np.argsort(least, kind="stable")  # with a stable sort by score, ties go to the smaller id
            e, j, own = e[order], j[order], [own[x] for x in order]
            for b in blocks.select(["keys", "q", "mask"]).to_pylist():
                who = np.frombuffer(b["keys"], np.int64)
                q = np.frombuffer(b["q"], np.float64).reshape(-1, width)
                mask = np.unpackbits(np.frombuffer(b["mask"], np.uint8).reshape(len(who), -1), axis=1)[:, : len(books[1])].astype(bool)
                s = np.where(mask[:, j], q @ e.T, -np.inf)
                if s.shape[1] > k + 1:
                    worst = np.partition(s, s.shape[1] - k - 1, axis=1)[:, s.shape[1] - k - 1]
                else:
                    worst = np.full(len(who), -np.inf)
                for n in range(len(who)):
                    near = np.flatnonzero((s[n] >= worst[n]) & (s[n] > -np.inf))
                    near = near[np.argsort(-s[n, near], kind="stable")][: k + 1]
                    for x in near:
                        keys.extend([who[n]] * len(own[x]))
                        ids.extend(own[x])
                        scores.extend([s[n, x]] * len(own[x]))
        return pa.table({"key": pa.array(keys, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    visits = stored(crowded.groupBy("crowd", "block").applyInArrow(block, "i int, part int, crowd long, keys binary, q binary, mask binary"), "ann-visits")
    # Every part goes to each crowd of blocks that asks for it.
    wanted = visits.select(F.col("i").alias("bi"), F.col("part").alias("bpart"), F.col("crowd").alias("bcrowd")).distinct()
    cut = index.withColumn("p", F.pmod(F.xxhash64("vec"), parts_of).cast("int"))
    placed = cut.join(wanted, (F.col("i") == F.col("bi")) & (F.col("p") == F.col("bpart"))).select("bi", "bpart", "bcrowd", "ids", "j", "vec")
    found = placed.groupBy("bi", "bpart", "bcrowd").cogroup(visits.groupBy("i", "part", "crowd")).applyInArrow(rerank, "key long, vec_id long, score double")
    order = [F.desc("score"), F.col("vec_id")]
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("n") <= k + 1)
    # Queries with equal vectors share a search; each leaves itself out.
    of = asked.join(keyed, "v").select(F.col("vec_id").alias("query_id"), "key")
    mine = best.join(of, "key").where("vec_id != query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = mine.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(vectors: DataFrame, every: int, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> dict[int, list[tuple[int, float]]]:
    """Exact neighbours of small tables, for tests and for measuring recall."""
    rows = usable(vectors, id_column, vector_column).distinct().collect()
    out = {}
    for width in {len(r["v"]) for r in rows}:
        same = [r for r in rows if len(r["v"]) == width]
        ids, x = np.array([r["vec_id"] for r in same], np.int64), np.array([r["v"] for r in same], np.float64)
        for q in np.flatnonzero(ids % every == 0):
            s = x @ x[q]
            order = [n for n in np.lexsort((ids, -s)) if ids[n] != ids[q]][:k]
            out[int(ids[q])] = [(int(ids[n]), float(s[n])) for n in order]
    return out
