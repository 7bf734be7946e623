"""Collocations against plain counting of all phrases, at any memory budget, chunk and list size."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tapewarden.llm import collocations

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts[lang, tuple(words[i : i + k])] += 1
    return counts, total


def plain(rows, least, top):
    counts, total = plain_counts(rows)
    found = {}
    for (lang, words), a in counts.items():
        if len(words) > 1 and a >= least:
            cuts = []
            for k in range(1, len(words)):
                x, y = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1000 * a * total[lang] // (x * y), k, x, y))
            score, _, x, y = min(cuts)
            found[lang, words] = (a, x, y, total[lang], score)
    inside = Counter()
    for (lang, words), (a, *_) in found.items():
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                if j - i < len(words):
                    inside[lang, words[i:j]] = max(inside[lang, words[i:j]], a)
    kept = [(lang, words, x) for (lang, words), x in found.items() if 100 * inside[lang, words] < 100 * x[0]]
    out = []
    for lang in {x[0] for x in kept}:
        own = sorted((-x[4], -x[0], " ".join(words).encode(), x) for one, words, x in kept if one == lang)
        out += [(lang, rank, phrase.decode(), *x) for rank, (_, _, phrase, x) in enumerate(own[:top], 1)]
    return sorted(out)


def found(docs, **settings):
    rows = collocations.collocations(docs, **settings).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows)


def prose(seed, n=120):
    draw = random.Random(seed)
    few = ["the", "of", "A", "new", "york", "city", "hot", "dog", "ünïque", "x" * 40]
    out = []
    for k in range(n):
        words = draw.choices(few, weights=[30, 20, 10, 5, 5, 4, 3, 3, 2, 1], k=draw.randrange(1, 60))
        text = "".join(w + draw.choice([" ", "  ", "\t", ". ", ", ", "\n", "\r", "\x0b"] if draw.random() < 0.3 else [" "]) for w in words)
        out.append((k, text + "by the way of new york city. " * (k % 3), draw.choice(["en", "en", "de", None])))
    return out


@pytest.mark.parametrize("budget", [collocations.BUDGET, 400, 40, 4])
def test_all_budgets_give_the_plain_counts(spark, budget):
    """Small budgets make most prefixes frequent, down to whole phrases."""
    rows = prose(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = plain([r[1:] for r in rows], 5, 40)
    assert want and found(docs, least=5, top=40, budget=budget) == want
    counts, total = plain_counts([r[1:] for r in rows])
    got = {(r.lang, r.phrase): r.n for r in collocations.phrase_counts(docs, least=5, budget=budget).collect()}
    expected = {(lang, " ".join(words)): n for (lang, words), n in counts.items() if n >= 5}
    assert got == expected | {(lang, ""): n for lang, n in total.items()}


def test_lists_beyond_their_bound(spark, monkeypatch):
    """With more frequent prefixes than may be listed, all of a length count as frequent; results are the same."""
    rows = prose(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = plain([r[1:] for r in rows], 4, 100)
    for most in (0, 12):
        monkeypatch.setattr(collocations, "MOST_LISTED", most)
        assert found(docs, least=4, top=100, budget=40) == want


def test_segments_cut_long_texts_without_losing_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 64)
    draw = random.Random(3)
    endless = " ".join(draw.choices(["a", "bb", "ccc", "d" * 70], weights=[5, 4, 3, 1], k=3_000))
    rows = [(1, endless, "en"), (2, "a bb ccc. " * 50 + "\t" + endless[:500], "en"), (3, "d" * 500, "en"), *prose(4, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    assert found(docs, least=3, top=500) == plain([r[1:] for r in rows], 3, 500)


def test_odd_rows(spark, odd, none):
    rows = [(r.text, r.lang) for r in odd.collect()]
    want = plain(rows, 2, 50)
    assert want and found(odd.withColumn("phrase", F.lit("x")).withColumn("N", F.lit(1)), least=2, top=50) == want
    assert found(none) == [] and found(odd.filter("text IS NULL"), least=1) == []


def test_scores_are_exact_beyond_64_bits(spark):
    n, x, y, a = 3_000_000_000_000_000, 987_654_321_012, 123_456_789_013, 123_456_789_011
    rows = [("en", "", n), ("en", "u", x), ("en", "v", y), ("en", "u v", a)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, n bigint")
    (r,) = collocations.scored(counts).collect()
    assert r.score == 1000 * a * n // (x * y)
    assert (r.a, r.l, r.r, r.n) == (a, x, y, n)


def test_groups_stay_near_the_budget(spark, documents):
    """No group gets more suffixes than the budget, though some words alone have more."""
    budget = 2_000
    texts = collocations._texts(documents, "text", "lang")
    words = collocations.word_counts(texts).cache()
    frequent = words.filter("phrase != ''").filter(F.col("n") > budget // 8)
    assert frequent.filter(F.col("n") > budget).count() > 0
    prefixes = collocations.Prefixes([collocations._by_lang(frequent)])
    runs = collocations.run_counts(texts, prefixes).filter(F.col("n") > budget // 8).cache()
    for k in range(2, 6):
        prefixes.listed.append(collocations._by_lang(runs.filter(F.size(F.split("phrase", " ")) == k)))
    light = words.filter(F.col("n") <= budget // 8).filter("phrase != ''")
    prefixes.groups = collocations._group_numbers(words, light, budget)
    blocks = collocations.suffix_blocks(texts, prefixes).select("lang", "part", F.aggregate("n", F.lit(0), lambda t, x: t + x).alias("n"))
    sizes = blocks.groupBy("lang", "part").agg(F.sum("n").alias("n"))
    assert sizes.count() > 20 and sizes.agg(F.max("n")).first()[0] <= budget
