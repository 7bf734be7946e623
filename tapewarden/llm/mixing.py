"""Operator 5: mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewarden.llm.common import WORD, documents

ADDED = ("size", "source_size", "target", "taken")
#: Hex digits of a document's seeded key that name its bucket: 16 ** 3 buckets a source.
BUCKET_DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def water_levels(
    sources: DataFrame, weights: Sequence[int], share: float, max_epochs: int, source: str = "source"
) -> DataFrame:
    """Targets of sources (`source`, `source_size`), one row each.

    Sources in code point order, null last, weigh `weights` in turn. Together
    they get `share` of all words; none gets over `max_epochs` times its own.
    What a full source cannot take is shared by weight among the others, until
    none is above. Filling in order of cap by weight finds the level in one
    pass: the first source that stays below its cap sets it for all that follow.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    turns = F.array(*[F.lit(w) for w in weights])
    filling = Window.orderBy((F.col("cap") / F.col("weight")), F.col(source).asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    others = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    return (
        sources.withColumn("weight", F.element_at(turns, (place % len(weights) + 1).cast("int")).cast("bigint"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("all_words") * share - before) / others)
        .withColumn("open", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")))
        .withColumn(
            "level",
            F.first("open", ignorenulls=True).over(
                filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        )
        .withColumn(
            "target",
            F.when(F.col("open").isNull(), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")),
        )
        .select(source, "source_size", "target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 17,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """`docs` with `size`, `source_size`, `target` and `taken`, in words.

    A source takes each document as often as its target holds the source, and
    once more, in seeded order, until the target is met to the word: the last
    one so taken may be taken in part. A document's order is the md5 of the
    seed and its id. Prefix sums run over 4,096 key ranges of a source and then
    within a range, so no task sorts a whole source.

    Null texts and texts without words have size 0 and take 0. A null source is
    a source. Repeated rows count one by one. Columns of `docs` that have the
    name of an added one are replaced.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    sized = (
        docs.drop(*ADDED)
        .withColumn("size", word_count(text))
        .withColumn("__key", key)
        .withColumn("__range", F.substring("__key", 1, BUCKET_DIGITS))
        # Never null, so that window and join deal rows out alike and text is shuffled once.
        .withColumn("__of", F.concat(F.lit("="), F.coalesce(F.col(source), F.lit(""))))
        .withColumn("__of", F.when(F.col(source).isNull(), "").otherwise(F.col("__of")))
    )
    ranges = sized.groupBy(source, "__of", "__range").agg(F.sum("size").alias("range_size"))
    levels = water_levels(
        ranges.groupBy(source).agg(F.sum("range_size").alias("source_size")), weights, share, max_epochs, source
    )
    wanted = F.round("target").cast("bigint")
    earlier = Window.partitionBy("__of").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        ranges.withColumn("__before", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
        .select(F.col(source).alias("__source"), "__of", "__range", "__before")
        .join(levels.withColumnRenamed(source, "__level_source"), F.expr("__source <=> __level_source"))
        .withColumn("__whole", F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0))
        .withColumn("__more", wanted - F.col("__whole") * F.col("source_size") - F.col("__before"))
        .select("__of", "__range", "source_size", "target", "__whole", "__more")
    )
    inside = Window.partitionBy("__of", "__range").orderBy("__key", doc_id, "size")
    prior = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("__more") - F.col("__prior")))
    return (
        sized.withColumn("__prior", prior)
        .join(plan, ["__of", "__range"])
        .withColumn("taken", (F.col("__whole") * F.col("size") + part).cast("bigint"))
        .drop("__key", "__range", "__prior", "__of", "__whole", "__more")
    )


def repeated(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as it is taken.

    A part of a document is the start of its text up to the words taken.
    Documents that take no words are left out.
    """
    mixed = mix(docs, text=text, **options)
    left = F.col("taken") - (F.col("__copy") - 1) * F.col("size")
    # The text up to the end of the n-th word, for the one document of a source that is taken in part.
    # Possessive repeats keep the search from recursing once for each word.
    start = F.expr(
        rf"regexp_extract(`{text}`, concat('^[\\x20\\x09-\\x0D]*+(?:[^\\x20\\x09-\\x0D]++[\\x20\\x09-\\x0D]*+){{', __left, '}}+'), 0)"
    )
    return (
        mixed.filter("taken > 0")
        .withColumn("__copy", F.explode(F.expr("sequence(1L, CAST(ceil(taken / size) AS BIGINT))")))
        .withColumn("__left", left)
        .withColumn(text, F.when(F.col("__left") < F.col("size"), start).otherwise(F.col(text)))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         source_size * 2 AS cap, sum(source_size) OVER () AS all_words
  FROM per_source
), filled AS (
  SELECT *, (all_words * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS own_level
  FROM weighed
), opened AS (
  SELECT *, CASE WHEN own_level * weight <= cap THEN own_level END AS open FROM filled
), levels AS (
  SELECT source, source_size, CASE WHEN open IS NULL THEN cap::DOUBLE
           ELSE first_value(open IGNORE NULLS) OVER (ORDER BY cap / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) * weight END AS target
  FROM opened
), ordered AS (
  SELECT s.doc_id, s.size, l.source_size, l.target, round(l.target)::BIGINT AS wanted,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - s.size AS prior
  FROM sized s JOIN levels l ON s.source IS NOT DISTINCT FROM l.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (wanted // source_size) * size
          + least(size, greatest(0, wanted % source_size - prior)) ELSE 0 END)::BIGINT AS taken
FROM ordered
"""
