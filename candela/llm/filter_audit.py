"""Audit of how filters interact: what each removes in every order of application.

Four filters look at a text alone; the fifth, E, at the whole table: a document fails it if some document with a
smaller id has the same text. E is an existential self-join: a left-semi join on hash, exact text and smaller id. It
only meets texts whose hash repeats (a bitmap of fixed size keeps the others in their scan), its right side is
reduced to the smallest id of each text by map-side aggregation, and copies of a hot text are salted by the size of
their group. The ids that it finds are united with those that fail another filter; their bits are added up by
document and counted by combination, at most 32 for each part. All orders are then read off these counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm.common import ship, stored
from candela.llm.exact_dedup import BITMAP_BITS, _bitmap

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 3, "[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"
#: A text is hot when its group has more than one in so many of all rows: at most so many groups can be.
HOT = 1000
#: Parts into which the copies of a hot text are dealt.
SALTS = 64
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def log_of(docs: DataFrame) -> DataFrame:
    """One narrow row per document: doc_id, part, key (64-bit hash of the text), sha, bits of the filters A to D."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    measured = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")).withColumn("words", words)
    fails = {
        "A": F.size("words") < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct("words")).cast("long") < DISTINCT_PERCENT * F.size("words").cast("long"),
        "C": 100 * capitals.cast("long") > CAPITAL_PERCENT * F.length("text").cast("long"),
        "D": F.regexp_like("text", F.lit(SYMBOLS)),
    }
    bits = sum((F.when(fail, BIT[f]).otherwise(0) for f, fail in fails.items()), F.lit(0))
    return measured.select("doc_id", "part", F.xxhash64("text").alias("key"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"), bits.alias("bits"))


def _may_repeat(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, part, key, body) of the documents whose key may be among ``keys``; no shuffle of texts."""
    byte = "cast(conv(hex(substring(bits, 1 + cast(floor(bit / 8) as int), 1)), 16, 10) as int)"
    place = F.pmod(F.col("key"), F.lit(BITMAP_BITS))
    return (
        docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("body"))
        .withColumn("key", F.xxhash64("body"))
        .withColumns({"range": F.bitmap_bucket_number(place), "bit": F.bitmap_bit_position(place)})
        .join(F.broadcast(_bitmap(keys)), "range")  # at most BITMAP_BITS / 8 bytes
        .where(F.expr(f"shiftright({byte}, cast(bit % 8 as int)) & 1 = 1"))
        .select("doc_id", "part", "key", "body")
    )


def later_copies(docs: DataFrame, log: DataFrame) -> DataFrame:
    """(doc_id, part, sha) of every row that fails E: some smaller id has its very text."""
    groups = log.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    repeated = stored(groups.where("n > 1"), "audit-repeated")
    hot = F.broadcast(repeated.where(F.col("n") > log.count() // HOT).select("key", F.lit(SALTS).alias("salts")))  # at most HOT rows
    met = _may_repeat(docs, repeated.select("key"))
    # A text has one row for each salt on the right; each of its copies takes one of these salts on the left.
    salts = F.coalesce("salts", F.lit(1))
    first = met.groupBy("key", "body").agg(F.min("doc_id").alias("least")).join(hot, "key", "left")
    right = first.select("key", "body", "least", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    left = met.join(hot, "key", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
    smaller = right["least"] < left["doc_id"]
    same = (left["key"] == right["key"]) & (left["salt"] == right["salt"]) & (left["body"] == right["body"])
    found = left.join(right, same & smaller, "left_semi")
    return found.select("doc_id", "part", F.sha2(F.col("body").cast("binary"), 256).alias("sha"))


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, total, combos): documents of every part, and of each combination of failures that occurs in it a
    struct (bits, n, good, toxic)."""
    log = stored(log_of(docs), "audit-log")
    own = log.where("bits > 0").select("doc_id", "part", "sha", "bits", F.lit(1).alias("own"), F.lit(0).alias("copy"))
    late = later_copies(docs, log).select("doc_id", "part", "sha", F.lit(BIT["E"]).alias("bits"), F.lit(0).alias("own"), F.lit(1).alias("copy"))
    # Rows repeated with one id and text are one group here, and counted as often as they occur.
    failed = own.unionByName(late).groupBy("doc_id", "part", "sha").agg(F.bit_or("bits").alias("bits"), F.greatest(F.sum("own"), F.sum("copy")).alias("n"))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = failed.join(marks, "doc_id", "left")
    each = known.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    combos = each.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("combos"))  # at most 31 a part
    return log.groupBy("part").agg(F.count(F.lit(1)).alias("total")).join(combos, "part", "left")


def filter_audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang") -> DataFrame:
    """One row per part, filter order (all 120) and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    A: under 200 words. B: distinct words under 50 percent. C: over 3 percent of the code points are A-Z. D: one of
    ``#$%&*|``. E: the text of a smaller id, anywhere in the table, removed or not. Null texts count as empty; null
    and empty parts are one. A row without an id never fails E and makes no other row fail it, and has no labels;
    rows repeated with one id and text count one by one and do not make each other fail E. An id labelled more than
    once is good or toxic if one of its labels says so. An empty table gives no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.col(part_column).alias("lang"))
    parts = combinations(docs, labels)
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = {f: F.instr("filter_order", f) for f in FILTERS}
    bit_sum = lambda held: sum((F.when(held(place[f]), BIT[f]).otherwise(0) for f in FILTERS), F.lit(0))
    steps = steps.withColumns({"this": bit_sum(lambda p: p == F.col("step")), "before": bit_sum(lambda p: p < F.col("step"))})

    def counted(value: str, holds) -> Column:
        return F.aggregate(
            F.coalesce("combos", F.array().cast("array<struct<bits:int,n:bigint,good:bigint,toxic:bigint>>")),
            F.lit(0).cast("long"),
            lambda sofar, c: sofar + F.when(holds(c["bits"]), c[value]).otherwise(0),
        )

    here = lambda b: (b.bitwiseAND(F.col("this")) != 0) & (b.bitwiseAND(F.col("before")) == 0)
    both = lambda b: (b.bitwiseAND(F.col("this")) != 0) & (b.bitwiseAND(F.col("before")) != 0)
    gone = lambda b: b.bitwiseAND(F.col("this").bitwiseOR(F.col("before"))) != 0
    measured = steps.withColumns(
        {
            "kept": F.col("total") - counted("n", gone),
            "removed": counted("n", here),
            "redundant": counted("n", both),
            "unique_fails": counted("n", lambda b: b == F.col("this")),
            "good_lost": counted("good", here),
            "toxic_lost": counted("toxic", here),
        }
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "this"))  # 120 rows
    return measured.withColumn("shapley", shapley).select("part", "filter_order", "step", *COUNTS)
