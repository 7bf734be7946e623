"""Operator 2: quality rules in a short-circuit cascade, ordered by rejections for their cost. Native functions only."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm.common import WORD, documents, sampled

#: ASCII white space, as it separates words.
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def words(text: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), lambda w: w != "")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each whole text.

    Windows of three words are hashed by 64 bits. Where all are distinct, no
    word repeats; else the windows of a text are sorted with their places, so
    that equal ones are neighbours, and the places they cover are counted. All
    of it happens within the row, without a shuffle. A null text has no words.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    hashed = docs.withColumn("__hash", F.transform(words(text), lambda w: F.xxhash64(w))).withColumn(
        "__lines", F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))
    )
    n = F.size("__hash")
    pairs = F.zip_with(
        F.slice("__hash", 1, F.greatest(n - 1, F.lit(0))),
        F.slice("__hash", 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b)
    )
    counted = hashed.withColumn("__pairs", pairs).withColumn(
        "__windows",
        F.zip_with(
            F.slice("__pairs", 1, F.greatest(n - 2, F.lit(0))),
            F.slice("__hash", 3, F.greatest(n - 2, F.lit(0))),
            lambda a, b: F.xxhash64(a, b)
        ),
    )
    sorted_windows = F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    # Of sorted windows, those that equal the one before or after, by place.
    m = F.size("__sorted")
    twins = F.zip_with(
        F.slice("__sorted", 1, m - 1),
        F.slice("__sorted", 2, m - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(F.array_compact(twins))))
    # A window covers three places, less what the next repeated window covers too.
    covered = F.aggregate(
        "__starts",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return (
        counted.withColumn("__sorted", sorted_windows)
        .withColumn("__starts", F.when(F.col("__sorted").isNotNull(), starts))
        .withColumn("n_words", n.cast("bigint"))
        .withColumn("word_chars", F.length(F.regexp_replace(whole, SPACES, "")).cast("bigint"))
        .withColumn(
            "n_symbols", (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint")
        )
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))
        .drop("__hash", "__lines", "__pairs", "__windows", "__sorted", "__starts")
    )


@dataclass(frozen=True)
class Rule:
    """A reason to reject a document: SQL that is true for bad ones, over the text and its measures."""

    name: str
    rejects: str


#: What the contract itself rejects; always evaluated.
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
RULES: tuple[Rule, ...] = (
    Rule("symbols", "n_symbols * 5 > n_words"),
    Rule("duplicate_lines", "n_dup_lines > 0 AND n_dup_lines * 3 > size(split(text, '\n'))"),
    Rule("word_length", "word_chars > 14 * n_words OR word_chars < 2 * n_words"),
    # Capitals by what lower case changes: no list of letters needed.
    Rule("capitals", "length(regexp_replace(text, '[^\\\\p{Lu}]', '')) * 2 > word_chars"),
    Rule("shouting", "regexp_count(text, '!') * 4 > n_words"),
    Rule("few_letters", "length(regexp_replace(text, '[^\\\\p{L}]', '')) * 2 < word_chars"),
    Rule("repeated_word", "regexp_count(text, '(?<![^\\\\x20\\\\x09-\\\\x0D])([^\\\\x20\\\\x09-\\\\x0D]+)[\\\\x20\\\\x09-\\\\x0D]+\\\\1(?![^\\\\x20\\\\x09-\\\\x0D])') * 5 > n_words"),
)


def ordered(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    most_documents: int = 1000,
    seed: int = 2,
) -> list[tuple[Rule, float, float]]:
    """The rules with the share they reject and their cost in seconds, most rejections for their cost first.

    About `most_documents` documents, chosen by hash, are measured and kept
    for the while; each rule then runs over them alone, and its time beyond
    that of a rule that does nothing is its cost. Order decides how much work
    a document takes, never whether it is kept.
    """
    part = sampled(docs.select(F.col(text).alias("text")), most_documents, "text", seed=seed)
    measured = measures(part.filter("text IS NOT NULL")).persist()
    try:
        there = max(1, measured.count())

        def run(condition: str) -> tuple[int, float]:
            begun = time.perf_counter()
            hits = measured.agg(F.count_if(F.expr(condition)).alias("n")).first()["n"]
            return hits, time.perf_counter() - begun

        run("false")
        idle = run("false")[1]
        found = []
        for rule in rules:
            hits, took = run(rule.rejects)
            found.append((rule, hits / there, max(took - idle, 1e-3)))
    finally:
        measured.unpersist()
    return sorted(found, key=lambda x: (-x[1] / x[2], x[0].name))


def cascade(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """`docs` with the measures, `base_failed` and `kept`.

    The rules are nested conditions in the given order: Spark evaluates a
    later one only for documents that passed those before. A null text fails
    the base and no rule is evaluated for it. Rows are judged one by one, so
    repeated rows get equal verdicts; columns of the new names are replaced.
    """
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    measured = measures(docs.drop(*new), text).withColumn("base_failed", F.expr(BASE_FAILED))
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(F.expr(rule.rejects.replace("text", f"`{text}`") if text != "text" else rule.rejects), False).otherwise(kept)
    return measured.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(kept))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    order = [rule for rule, *_ in ordered(docs)]
    return cascade(docs, order).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
