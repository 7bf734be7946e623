"""Operator 11: exact duplicates by a two-pass Bloom filter; only what may be repeated is shuffled. Native functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm.common import documents, shared_folder, written

#: Bits of the filter for each row. Two of them are set by a row, so about 1.4 % of the rows
#: without a copy find both of theirs set by others.
BITS_PER_ROW = 16
#: Bits of one bucket: what `bitmap_construct_agg` puts into one value of 4 KB.
BUCKET_BITS = 32_768
#: The filter, or one slice of it, is broadcast up to this size.
MOST_FILTER_BYTES = 64 << 20
#: Groups of copies that hold at least this part of all rows: at most as many as its inverse.
HOT_PART = 1_000


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def _bits(key: Column) -> tuple[Column, Column]:
    """Two different bits of a key within its bucket, independent of the bucket."""
    h = F.xxhash64(key, F.lit(1))
    first = F.pmod(h, F.lit(BUCKET_BITS))
    apart = F.pmod(F.shiftright(h, 20), F.lit(BUCKET_BITS - 1)) + 1
    return first, F.pmod(first + apart, F.lit(BUCKET_BITS))


def bucket_count(rows: int) -> int:
    return max(1, math.ceil(rows * BITS_PER_ROW / BUCKET_BITS))


def repeat_filter(keys: DataFrame, key: str, buckets: int, least: int = 2) -> DataFrame:
    """First pass: the filter of bits that `least` rows or more have set, as `bucket`, `bits` (4 KB each).

    At scale a task sets few of the many bits, so they travel as numbers, added
    up within the task first (a key that a third of the rows share is a pair of
    numbers a task), and become bitmaps where they meet.
    """
    one, two = _bits(F.col(key))
    set_bits = keys.select(_bucket(F.col(key), buckets).alias("bucket"), F.explode(F.array(one, two)).alias("bit"))
    twice = set_bits.groupBy("bucket", "bit").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return twice.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _is_set(bit: Column) -> Column:
    byte = F.col("__bits").substr((bit / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(bit, F.lit(8)).cast("int")) == 1


def probed(rows: DataFrame, key: str, bitmaps: DataFrame, buckets: int, name: str = "__maybe") -> DataFrame:
    """Second pass: `rows` where they are, with a flag that is true for every repeated key, and rarely for another.

    `bitmaps` is broadcast: the caller bounds it.
    """
    one, two = _bits(F.col(key))
    filters = F.broadcast(bitmaps.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits")))
    return (
        rows.join(filters, _bucket(F.col(key), buckets) == F.col("__bucket"), "left")
        .withColumn(name, F.coalesce(_is_set(one) & _is_set(two), F.lit(False)))
        .drop("__bucket", "__bits")
    )


def _hashes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256).alias("text_sha256")
    )


def flagged(hashes: DataFrame, folder: str, most_filter_bytes: int = MOST_FILTER_BYTES) -> DataFrame:
    """Stored `hashes` (with text_sha256) with `maybe`, stored in `folder`.

    Where the whole filter is larger than `most_filter_bytes`, it is made and
    probed in slices of the hash space, one job after the other, so that no
    broadcast is larger, whatever the number of rows.
    """
    buckets = bucket_count(hashes.count())
    slices = math.ceil(buckets * BUCKET_BITS / 8 / most_filter_bytes)
    for k in range(slices):
        part = hashes
        if slices > 1:
            part = hashes.filter(F.pmod(_bucket(F.col("text_sha256"), buckets), F.lit(slices)) == k)
        bitmaps = repeat_filter(part, "text_sha256", buckets)
        probed(part, "text_sha256", bitmaps, buckets, "maybe").write.parquet(f"{folder}/slice={k}")
    schema = hashes.schema.add("maybe", "boolean")
    return hashes.sparkSession.read.schema(schema).parquet(*[f"{folder}/slice={k}" for k in range(slices)])


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_filter_bytes: int = MOST_FILTER_BYTES
) -> DataFrame:
    """For each row doc_id, keep_id, group_size, kept, text_sha256: which row of equal texts stays.

    Texts are equal when their SHA-256 is. The largest id of a group stays; a
    null id is smaller than any other. A null text is an empty one. Rows that
    repeat id and text are one document: they count in group_size, and `kept`
    is the same for all of them (`deduplicated` leaves one). Columns other than
    id and text are not read; an empty table gives an empty result.

    Texts never leave their rows: ids and hashes are stored, and of these only
    what the filter finds possibly repeated is grouped. A group that holds a
    thousandth of the rows or more is joined back by broadcast (there are at most
    a thousand), the others by hash, so no task gets a large group.
    """
    folder = shared_folder(docs.sparkSession, "exact-duplicates")
    hashes = written(_hashes(docs, doc_id, text), f"{folder}/hashes")
    rows = flagged(hashes, f"{folder}/flagged", most_filter_bytes)
    alone = rows.filter("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "text_sha256"
    )
    maybe = rows.filter("maybe").drop("maybe")
    groups = written(
        maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        f"{folder}/groups",
    )
    is_hot = F.col("group_size") * HOT_PART >= hashes.count()
    hot = F.broadcast(groups.filter(is_hot))
    others = maybe.join(hot.select("text_sha256"), "text_sha256", "left_anti")
    found = maybe.join(hot, "text_sha256").unionByName(others.join(groups.filter(~is_hot), "text_sha256"))
    return alone.unionByName(found).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the rows whose equal text stays elsewhere; of rows that repeat id and text, one stays.

    Only rows that the filter finds possibly repeated are shuffled, as long as
    the filter may be broadcast; beyond that size all rows are.
    """
    marks = exact_duplicates(docs, doc_id, text)
    goes = marks.filter("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    hashed = docs.withColumn("__text_sha256", F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))
    buckets = bucket_count(docs.count())
    if buckets * BUCKET_BITS // 8 <= MOST_FILTER_BYTES:
        bitmaps = repeat_filter(hashed.select("__text_sha256"), "__text_sha256", buckets)
        rows = probed(hashed, "__text_sha256", bitmaps, buckets)
        alone, maybe = rows.filter("NOT __maybe"), rows.filter("__maybe")
    else:
        alone, maybe = hashed.limit(0), hashed
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col("__text_sha256") == F.col("__sha"))
    stay = maybe.join(goes, same, "left_anti").dropDuplicates([doc_id, "__text_sha256"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return alone.select(*columns).unionByName(stay.select(*columns))


def op11_exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(documents(spark, folder))


OP11_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
