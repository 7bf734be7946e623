"""The audit against every order applied to every document, one after the other."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from tapewarden.llm import interaction

NAMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text, earlier):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": earlier,
    }


def plain(rows, labels):
    """Apply all 120 orders to each document."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    out, removed_by = {}, Counter()
    for doc_id, text, part in rows:
        text, part = text or "", part or ""
        failed = {k for k, v in fails(text, doc_id is not None and least[text] < doc_id).items() if v}
        for order in permutations("ABCDE"):
            gone = False
            for step, name in enumerate(order, 1):
                c = out.setdefault((part, "".join(order), step), Counter())
                here = name in failed and not gone
                c["redundant"] += name in failed and gone
                c["removed"] += here
                c["unique_fails"] += failed == {name}
                c["good_lost"] += here and doc_id in good
                c["toxic_lost"] += here and doc_id in bad
                removed_by[part, name] += here
                gone = gone or here
                c["kept"] += not gone
    for (part, order, step), c in out.items():
        c["shapley"] = removed_by[part, order[step - 1]]
    return {key: tuple(c[n] for n in NAMES) for key, c in out.items()}


def found(frame):
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in NAMES) for r in frame.collect()}


def check(docs, labels):
    got = found(interaction.audit(docs, labels))
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    assert got == plain(rows, [tuple(r) for r in labels.collect()])
    assert len(got) == 600 * len({s or "" for _, _, s in rows})


def test_audit_equals_every_order_applied(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 0), (4, 1, 1), (4, 0, 0), (5, None, 1), (None, 1, 1), (6, 0, None), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    check(odd.withColumn("mask", F.lit(7)).withColumn("Hash", F.lit("x")), labels)
    check(odd, labels.limit(0))
    assert interaction.audit(none, labels).count() == 0


def test_audit_of_documents_and_of_large_groups_of_copies(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic")
    check(documents, labels)
    plenty = [(i, "copy of a text # " * 20 if i % 3 == 0 else f"word{i % 7} " * (i % 90), f"s{i % 2}") for i in range(3_000)]
    check(spark.createDataFrame(plenty, "doc_id long, text string, source string").repartition(7), labels)


def test_repeats_do_not_depend_on_the_filters_size(spark, odd, monkeypatch):
    few = odd.limit(11)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    want = found(interaction.audit(few, labels))
    monkeypatch.setattr(interaction.exactdup, "MOST_FILTER_BYTES", 0)
    assert found(interaction.audit(few, labels)) == want


def test_hot_groups_are_dealt_to_parts(spark):
    folder = interaction.shared_folder(spark, "hot")
    rows = spark.range(4_000).select(
        F.col("id").alias("doc_id"),
        F.xxhash64(F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string"))).alias("hash"),
        F.lit("p").alias("part"),
        F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    got = {r.doc_id for r in interaction.repeats(rows, 4_000, folder).collect()}
    assert got == set(range(2, 4_000, 2))
