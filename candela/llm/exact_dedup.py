"""Exact duplicates through an extendible-hash index kept in shared files. DataFrame functions only.

Every document becomes an index entry (64-bit key of its bytes, id, SHA-256). The directory starts with
one bucket and doubles, splitting each bucket that holds more than ``capacity`` distinct keys by the next
leading bit of the key, until no bucket is overfull or ``max_depth`` is reached. Buckets are key ranges,
so the index is written range-partitioned: every owner task holds a run of buckets, sorted by key, and a
key with very many entries is spread over several owners.

Texts whose key is met twice look their bucket up in the directory and go there: first every task sums up what it
holds of a text and slices of a text are put together (so one that a third of all rows share is a few rows), then
the rows move to the owners by ranges of (bucket, key). An owner chains the texts of a key by their bytes, so two
texts that collide on the key become two chains, and an entry finds its chain through its bucket. Texts with a
unique key never leave their scan: a bitmap of fixed size, made from the repeated keys, keeps them out of the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm.common import ship, shared_folder, stored

#: Bits of the repeated-key bitmap: 4,096 rows of 4 KB, 16 MB broadcast at most, whatever the input.
BITMAP_BITS = 1 << 27
#: Chain rows are copied to this many salts, so that a key held by a third of all rows meets its chain in as many tasks.
SALTS = 16
#: Slices in which copies of a text are summed up before the rest of them moves to its owner.
SLICES = 4


def _key(body: Column, key_bits: int) -> Column:
    """Leading ``key_bits`` of the hash, the rest zero."""
    if key_bits >= 64:
        return F.xxhash64(body)
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(body), 64 - key_bits), 64 - key_bits)


def directory(keys: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """(leaf, depth, bucket) for each of at most ``2**max_depth`` leaves in use.

    ``keys`` has one row per distinct key. ``depth`` is the number of leading bits at which the leaf's
    bucket stopped splitting, ``bucket`` the first leaf of that bucket's key range.
    """
    leaves = keys.groupBy(F.shiftrightunsigned("key", 64 - max_depth).alias("leaf")).agg(F.count(F.lit(1)).alias("n"))
    levels = leaves.select("leaf", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("d"))
    prefix = F.expr(f"shiftright(leaf, {max_depth} - d)")
    held = levels.withColumn("held", F.sum("n").over(Window.partitionBy("d", prefix)))
    depth = F.coalesce(F.min(F.when(F.col("held") <= capacity, F.col("d"))), F.lit(max_depth))
    return held.groupBy("leaf").agg(depth.alias("depth")).select("leaf", "depth", F.expr(f"shiftleft(shiftright(leaf, {max_depth} - depth), {max_depth} - depth)").alias("bucket"))


def _bitmap(keys: DataFrame) -> DataFrame:
    """One 4 KB bitmap for each range of key positions that holds one of ``keys``."""
    pos = F.pmod(F.col("key"), F.lit(BITMAP_BITS))
    return (
        keys.select(F.bitmap_bucket_number(pos).alias("range"), F.bitmap_bit_position(pos).alias("bit"))
        .groupBy("range")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def _placed(rows: DataFrame, tree: DataFrame, max_depth: int) -> DataFrame:
    """``rows`` with the bucket that the directory gives their key, and its depth."""
    return rows.withColumn("leaf", F.shiftrightunsigned("key", 64 - max_depth)).join(F.broadcast(tree), "leaf").drop("leaf")  # at most 2**max_depth rows


def _among(docs: DataFrame, keys: DataFrame, tree: DataFrame, max_depth: int, key_bits: int) -> DataFrame:
    """(doc_id, body, key, bucket, depth) of the documents whose key may be one of ``keys``; no shuffle of texts."""
    body = F.coalesce(F.col("text"), F.lit(""))
    pos = F.pmod(F.col("key"), F.lit(BITMAP_BITS))
    byte = "cast(conv(hex(substring(bits, 1 + cast(floor(bit / 8) as int), 1)), 16, 10) as int)"
    found = (
        docs.select("doc_id", body.alias("body"), _key(body, key_bits).alias("key"))
        .withColumn("range", F.bitmap_bucket_number(pos))
        .withColumn("bit", F.bitmap_bit_position(pos))
        .join(F.broadcast(_bitmap(keys)), "range")  # at most BITMAP_BITS / 8 bytes
        .where(F.expr(f"shiftright({byte}, cast(bit % 8 as int)) & 1 = 1"))
        .select("doc_id", "body", "key")
    )
    return _placed(found, tree, max_depth)


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = 50_000, max_depth: int = 16, key_bits: int = 64, path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write the index and give (entries, keys, directory), all read from shared files.

    entries: bucket, depth, key, doc_id, text_sha256. keys: key, n.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_column), F.lit(""))
    log = stored(docs.select(F.col(id_column).alias("doc_id"), _key(body, key_bits).alias("key"), F.sha2(body.cast("binary"), 256).alias("text_sha256")), "dedup-log")
    keys = stored(log.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "dedup-keys")
    tree = stored(directory(keys, capacity, max_depth), "dedup-directory")
    path = path or shared_folder(spark, "dedup-index")
    (
        _placed(log, tree, max_depth)
        .select("bucket", "depth", "key", "doc_id", "text_sha256")
        .repartitionByRange("bucket", "key", "doc_id")
        .sortWithinPartitions("bucket", "key", "doc_id")
        .write.parquet(path)
    )
    return spark.read.parquet(path), keys, tree


def chains(docs: DataFrame, keys: DataFrame, tree: DataFrame, max_depth: int = 16, key_bits: int = 64) -> DataFrame:
    """(bucket, key, body, keep_id, group_size, chains) of the texts whose key repeats; ``chains`` of them share the key.

    The exchange by ranges of (bucket, key) is the last one: owners group and count the chains of their key ranges in place."""
    repeated = _among(docs, keys.where("n > 1"), tree, max_depth, key_bits)
    sliced = repeated.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    sums = sliced.groupBy("bucket", "key", "body", "slice").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    owned = sums.repartitionByRange("bucket", "key").groupBy("bucket", "key", "body")
    chained = owned.agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return chained.withColumn("chains", F.count(F.lit(1)).over(Window.partitionBy("bucket", "key")))


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = 50_000, max_depth: int = 16, key_bits: int = 64, path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, bucket, depth.

    Texts are equal when their bytes are equal; null counts as empty. The largest id of a group stays.
    A null id never beats another id; where all ids of a group are null, keep_id is null and the rows
    count as kept. Rows repeated with the same id and text are one document: each of them is marked like
    the document. An empty table gives an empty result. Other columns of ``docs`` are not read.
    ``key_bits`` under 64 forces key collisions (tests).
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    entries, keys, tree = build_index(docs, capacity=capacity, max_depth=max_depth, key_bits=key_bits, path=path)
    body = F.when(F.col("chains") > 1, F.col("body")).alias("body")
    linked = stored(chains(docs, keys, tree, max_depth, key_bits).select("bucket", "key", body, "keep_id", "group_size", "chains"), "dedup-chains")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    out = ["doc_id", "keep_id", "group_size", F.expr("keep_id <=> doc_id").alias("kept"), "text_sha256", "bucket", "depth"]

    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")

    # Keys with one chain: an entry finds it in its bucket by the key alone.
    place = ["bucket", "key", "salt"]
    plain = linked.where("chains = 1 and group_size > 1").select("bucket", "key", "keep_id", "group_size", salts)
    crowded = linked.where("chains > 1").drop("chains")
    simple = (
        entries.withColumn("salt", salt)
        .join(crowded.select("bucket", "key").distinct().select("bucket", "key", salts), place, "left_anti")
        .join(plain, place, "left")
        .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
        .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
    )
    # Keys on which different texts collide: their documents find the chain by the bytes themselves.
    collided = (
        _among(docs, crowded, tree, max_depth, key_bits)
        .withColumn("salt", salt)
        .join(crowded.select("*", salts), [*place, "body"])
        .withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256))
    )
    return simple.select(*out).unionByName(collided.select(*out))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; of rows repeated with the same id and text, one.

    Null and empty texts are equal, so of all of them the row with the largest id stays. Rows without an id stay
    only where no row of their text has one, once. An empty table gives an empty result."""
    columns, by = docs.columns, ["__none", "__id", "__sha"]
    # A text instead of a null id: the join and the window then share one exchange of the documents.
    own_id = lambda rows: rows.withColumn("__none", F.col("doc_id").isNull()).withColumn("__id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    marked = own_id(exact_dedup(docs, **options).where("kept")).select("__none", "__id", F.col("text_sha256").alias("__sha")).distinct()
    own = own_id(docs).withColumn("__sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    one = Window.partitionBy(*by).orderBy("__id")
    return own.join(marked, by, "left_semi").withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*columns)
