"""Operator 12: what each of five filters removes in every order of them, from the combinations of failures."""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm import exactdup
from tapewarden.llm.common import documents, shared_folder, written

SPACES = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
#: Bit of each filter in a combination of failures.
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
#: A hash that at least this part of all rows share is dealt to several tasks.
HOT_PART = 1_000


def text_failures(text: str) -> Column:
    """Bits of the filters A to D that a text fails, from `__words` and the text; E is not among them."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    n, distinct = F.size("__words"), F.size(F.array_distinct("__words"))
    fails = {
        "A": n < 50,
        "B": distinct.cast("bigint") * 100 < n.cast("bigint") * 65,
        "C": F.regexp_count(whole, F.lit("[A-Z]")).cast("bigint") * 100 > F.length(whole).cast("bigint") * 5,
        "D": whole.rlike(r"[#$%&*|]"),
    }
    return sum((F.when(x, BIT[name]).otherwise(0) for name, x in fails.items()), F.lit(0))


def repeats(rows: DataFrame, total: int, folder: str) -> DataFrame:
    """`rows` (doc_id, hash, part, text) whose text an earlier row has: a left-semi join on hash, text and smaller id.

    Of each repeated text one row with its smallest id stands on the right, so
    whether a smaller id exists is known from one comparison and no pair of a
    group is made. Hashes of at least a thousandth of all rows (at most a
    thousand) are dealt to as many parts as they hold such thousandths, with the
    right row in each part. A null id is not smaller than any other, nor is any
    smaller than it.
    """
    copies = F.count(F.lit(1)).alias("copies")
    smallest = written(
        rows.groupBy("hash", "text").agg(F.min("doc_id").alias("smallest"), copies).filter("copies > 1"),
        f"{folder}/smallest",
    )
    hot = smallest.groupBy("hash").agg(F.sum("copies").alias("n")).filter(F.col("n") * HOT_PART >= total)
    hot = F.broadcast(hot.select("hash", F.ceil(F.col("n") * HOT_PART / total).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    left = rows.join(hot, "hash", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id"), parts)).drop("parts")
    right = smallest.join(hot, "hash", "left").select(
        F.col("hash").alias("r_hash"),
        F.col("text").alias("r_text"),
        "smallest",
        F.explode(F.sequence(F.lit(0).cast("bigint"), parts.cast("bigint") - 1)).alias("r_salt"),
    )
    same = (F.col("hash") == F.col("r_hash")) & (F.col("salt") == F.col("r_salt")) & (F.col("text") == F.col("r_text"))
    return left.join(right, same & (F.col("smallest") < F.col("doc_id")), "left_semi").drop("salt")


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Rows by doc_id, part and combination of failures: `doc_id`, `part`, `mask`, `rows`.

    Texts with their ids are shuffled only where the Bloom filter of exact
    deduplication finds them possibly repeated (all of them, where that filter
    would be too large to broadcast); of the others an id, a hash and bits.
    """
    folder = shared_folder(docs.sparkSession, "interaction")
    total = docs.count()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(whole).alias("hash"),
        F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"),
        whole.alias("text"),
    )
    buckets = exactdup.bucket_count(total)
    candidates = rows
    if buckets * exactdup.BUCKET_BITS // 8 <= exactdup.MOST_FILTER_BYTES:
        bitmaps = exactdup.repeat_filter(rows.select("hash"), "hash", buckets)
        candidates = exactdup.probed(rows, "hash", bitmaps, buckets).filter("__maybe").drop("__maybe")
    earlier = repeats(candidates, total, folder)
    words = F.array_remove(F.split("text", SPACES), "")
    own = rows.withColumn("__words", words).select("doc_id", "hash", "part", text_failures("text").alias("bits"), F.lit(1).alias("rows"))
    e = earlier.select("doc_id", "hash", "part", F.lit(BIT["E"]).alias("bits"), F.lit(0).alias("rows"))
    return (
        own.unionByName(e)
        .groupBy("doc_id", "hash", "part")
        .agg(F.bit_or("bits").alias("mask"), F.sum("rows").alias("rows"))
        .drop("hash")
    )


def _steps() -> Column:
    """All orders with their five steps: order, step, bit of its filter, bits of the filters before; 600 fixed entries."""
    steps = [
        {"filter_order": "".join(o), "step": k + 1, "bit": BIT[o[k]], "before": sum(BIT[x] for x in o[:k])}
        for o in permutations(FILTERS)
        for k in range(len(FILTERS))
    ]
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, before int>>")


def audit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
    quality: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """For each part, order of the filters and step: what is kept, removed and lost there.

    `labels` (doc_id, quality, toxic) marks documents: good where a row of theirs
    has quality 1, toxic where one has toxic 1; others count as neither. A null
    text is empty (A fails), a null part is the empty string. Rows that repeat
    an id and a text are counted one by one; E looks for a smaller id, so the
    same id again is no earlier one. An empty table gives no rows.

    Documents are counted by part and combination of failures, at most 32 for
    a part; orders and steps are worked out from these counts alone.
    """
    marks = labels.groupBy(F.col(f"`{doc_id}`").alias("doc_id")).agg(
        F.max((F.col(f"`{quality}`") == 1).cast("int")).alias("good"), F.max((F.col(f"`{toxic}`") == 1).cast("int")).alias("bad")
    )
    failed = failures(docs, doc_id, text, part).join(marks, "doc_id", "left")
    counts = failed.groupBy("part", "mask").agg(
        F.sum("rows").alias("n"),
        F.coalesce(F.sum(F.col("rows") * F.col("good")), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.col("rows") * F.col("bad")), F.lit(0)).alias("bad"),
    )
    combinations = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("c"))
    each = combinations.select("part", "c", F.explode(_steps()).alias("s"))
    bit, before = F.col("s.bit"), F.col("s.before")

    def total(count: str, holds) -> Column:
        return F.aggregate("c", F.lit(0).cast("bigint"), lambda t, x: t + F.when(holds(x["mask"]), x[count]).otherwise(0))

    def removed(mask: Column) -> Column:
        return (mask.bitwiseAND(bit) != 0) & (mask.bitwiseAND(before) == 0)

    # A filter comes first among those a document fails in 120 / (number of these) of all orders.
    shapley = F.aggregate(
        "c",
        F.lit(0).cast("bigint"),
        lambda t, x: t
        + F.when(
            x["mask"].bitwiseAND(bit) != 0,
            x["n"] * F.lit(120).cast("bigint") / F.greatest(F.bit_count(x["mask"]), F.lit(1)),
        )
        .otherwise(0)
        .cast("bigint"),
    )
    return each.select(
        "part",
        "s.filter_order",
        "s.step",
        total("n", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("bad", removed).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def op12_interaction(spark: SparkSession, folder: str) -> DataFrame:
    return audit(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


OP12_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         doc_id > min(doc_id) OVER (PARTITION BY t) AS e
  FROM texts),
failed AS (
  SELECT s.part,
         len(words) < 50 AS a,
         100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(e, false) AS e,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = s.doc_id AND l.quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = s.doc_id AND l.toxic = 1) AS bad
  FROM split s),
counts AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
         count(*) AS n, count_if(good) AS good, count_if(bad) AS bad
  FROM failed GROUP BY ALL),
letters(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT p.l || q.l || r.l || s.l || u.l AS filter_order, [p.b, q.b, r.b, s.b, u.b] AS bits
  FROM letters p, letters q, letters r, letters s, letters u
  WHERE p.b + q.b + r.b + s.b + u.b = 31 AND p.b | q.b | r.b | s.b | u.b = 31),
steps AS (
  SELECT filter_order, k::INT AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before
  FROM orders, range(1, 6) x(k)),
each AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(bad) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT * EXCLUDE (bit), sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM each
"""
