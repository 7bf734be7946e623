"""From documents to training tokens: five stages, each stored before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm import bpe, mixing, neardup, secrets, toxicity
from tapewarden.llm.common import shared_folder, small_batches, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer gives less than 0.5.

    The scorer learns from `labels` of documents that are not held out. A null
    or empty text has the bias alone and stays.
    """
    small_batches(spark)
    scorer = toxicity.learnt(spark, sf_dir, docs)
    return toxicity.score(docs, scorer, name="__toxic").filter("__toxic < 0.5").drop("__toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: the one with the least id; of repeated rows, one.

    Word shingles of five, a Jaccard similarity of 0.8 or more. Documents
    without words are no copies of each other; all of them stay.
    """
    small_batches(spark)
    groups = neardup.near_duplicates(docs, width=5, percent=80).filter("component IS NOT NULL")
    each = groups.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "rows"))
    stay = written(
        each.groupBy("component").agg(first.alias("x")).select(
            F.col("x.doc_id").alias("__id"), F.col("x.text_hash").alias("__hash"), F.col("x.rows").alias("__rows")
        ),
        f"{shared_folder(spark, 'stay')}/rows",
    )
    hashed = docs.withColumn("__text_hash", F.xxhash64("text"))
    has_words = F.coalesce(F.col("text").rlike(mixing.WORD), F.lit(False))
    here = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    kept = hashed.filter(has_words).join(stay, here, "left_semi")
    if not stay.filter("__rows > 1").isEmpty():
        # Rows repeated with id and text: one of them.
        kept = kept.dropDuplicates(["doc_id", "__text_hash"])
    return kept.unionByName(hashed.filter(~has_words)).select(*[F.col(f"`{c}`") for c in docs.columns])


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark; `n_chars` follows the text."""
    small_batches(spark)
    field = secrets.fit(docs)
    cleaned = secrets.redact(docs, field)
    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a part of one is the start of its text, and `n_chars` follows."""
    mixed = mixing.repeated(docs)
    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    return mixed.withColumn("n_chars", changed)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document taken: doc_id, source, n_tokens, ids."""
    small_batches(spark)
    return bpe.encode(docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids"
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Scores, random fields and token merges have no SQL; tests/llm compares each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents, each result stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
