"""Exact duplicates against plain grouping; the filter never misses a repeated key."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tapewarden.llm import exactdup


def plain(rows):
    """Counter of (doc_id, keep_id, group_size, kept, sha) by grouping whole texts."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out.update((i, keep, len(ids), i == keep, sha) for i in ids)
    return out


def found(marks):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in marks.collect())


@pytest.mark.parametrize("bytes_of_filter", [exactdup.MOST_FILTER_BYTES, 4_096])
def test_marks_equal_plain_grouping(odd, documents, none, bytes_of_filter):
    for docs in (odd.withColumn("keep_id", F.lit("x")).withColumn("Maybe", F.lit(1)), documents):
        want = plain((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        assert found(exactdup.exact_duplicates(docs, most_filter_bytes=bytes_of_filter)) == want
    assert exactdup.exact_duplicates(none, most_filter_bytes=bytes_of_filter).count() == 0


def test_slices_of_the_filter_give_the_same_rows(spark):
    """More rows than one bucket of the filter holds, half of them copies, a third of all equal."""
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 2}" if i % 2 else f"text {i}") for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert exactdup.bucket_count(6_000) == 3
    for bytes_of_filter in (4_096, 8_192, 1 << 20):
        assert found(exactdup.exact_duplicates(docs, most_filter_bytes=bytes_of_filter)) == plain(rows)


def test_the_filter_misses_nothing_and_rarely_errs(spark):
    keys = spark.range(40_000).select(F.when(F.col("id") < 4_000, F.col("id") % 2_000).otherwise(F.col("id")).cast("string").alias("key"))
    buckets = exactdup.bucket_count(40_000)
    flags = exactdup.probed(keys, "key", exactdup.repeat_filter(keys, "key", buckets), buckets)
    counts = {(r.repeated, r["__maybe"]): r["count"] for r in flags.withColumn("repeated", F.col("key").cast("int") < 2_000).groupBy("repeated", "__maybe").count().collect()}
    assert counts[True, True] == 4_000 and (True, False) not in counts
    assert 0 < counts[False, True] < 0.025 * 36_000


def test_only_possibly_repeated_rows_are_grouped(spark, documents):
    folder = exactdup.shared_folder(spark, "flags")
    hashes = exactdup.written(exactdup._hashes(documents, "doc_id", "text"), f"{folder}/hashes")
    flags = exactdup.flagged(hashes, folder)
    repeated = sum(n for n in Counter(r.text_sha256 for r in hashes.collect()).values() if n > 1)
    assert repeated <= flags.filter("maybe").count() <= repeated + 0.05 * documents.count()


def test_no_python_runs(odd):
    plans = [exactdup.exact_duplicates(odd), exactdup.deduplicated(odd)]
    for frame in plans:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_one_row_of_equal_texts_stays(odd, documents, none):
    for docs in (odd, documents, none):
        rows = docs.collect()
        stay = {}
        for r in rows:
            key = r.text or ""
            if key not in stay or (r.doc_id is not None and (stay[key] is None or r.doc_id > stay[key])):
                stay[key] = r.doc_id
        kept = exactdup.deduplicated(docs)
        assert kept.columns == docs.columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter(stay.values())
