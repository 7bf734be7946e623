"""Operators for building training data from documents, and their named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapewarden.llm import (
    backoff,
    bpe,
    collocations,
    exactdup,
    fingerprints,
    interaction,
    language,
    mixing,
    neardup,
    pii,
    quality,
    secrets,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The stages of corpus_pipeline.py, at the top of the repository."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {
    "op1_secrets": secrets.op1_secrets,
    "op2_quality": quality.op2_quality,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language": language.op4_language,
    "op5_mixing": mixing.op5_mixing,
    "op6_pii": pii.op6_pii,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op7_links": fingerprints.op7_links,
    "op8_backoff": backoff.op8_backoff,
    "op8_backoff_trigrams": backoff.op8_backoff_trigrams,
    "op9_bpe": bpe.op9_bpe,
    "op10_neardup": neardup.op10_neardup,
    "op11_exact": exactdup.op11_exact,
    "op12_interaction": interaction.op12_interaction,
    "op13_collocations": collocations.op13_collocations,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {
    "op5_mixing": mixing.OP5_SQL,
    "op8_backoff": backoff.OP8_SQL,
    "op8_backoff_trigrams": backoff.OP8_TRIGRAMS_SQL,
    "op11_exact": exactdup.OP11_SQL,
    "op12_interaction": interaction.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
