"""Toxicity and language: exact parts against brute force, the rest by accuracy on what was held back."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapewarden.llm import language, toxicity
from tapewarden.llm.common import crc_mod

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def restorer(documents):
    counts = [(r.code, r.n) for r in toxicity.trigram_counts(documents).collect()]
    return toxicity.Restorer(toxicity.letter_model(counts))


def test_trigram_counts_cover_all_texts(documents, texts):
    total = sum(r.n for r in toxicity.trigram_counts(documents).collect())
    # Texts are joined by blanks within a batch; each batch has two trigrams less than letters.
    assert abs(total - sum(len(t) + 1 for t in texts.values())) < 100


def test_disguised_words_are_restored(restorer):
    for seen, meant in {"1d10t": "idiot", "idiooot!!": "idiot", "m0r0n": "moron", "tr@sh": "trash", "i.d.i.o.t": "idiot", "house.": "house"}.items():
        assert restorer.word(seen) == meant
    assert "idiot" in restorer.words("you i d i o t there")


def test_long_spaced_doubled_and_sign_only_disguises(restorer):
    assert "moron" in restorer.words("you are a m o r o n")
    assert "idiot" in restorer.words("all of this is so because " + " ".join("youareanidiot" * 5) + " i d i o t"), "over 80 characters"
    assert "moron" in restorer.words("you m  o  r  o  n there")
    assert "moron" in restorer.words("y o u   a r e   a   m o r o n")
    assert "bastard" in restorer.words("some b @ s t a r d here")
    assert restorer.word("stu" + "u" * 60 + "pid") == "stupid"
    assert "idiot" in restorer.words("an iddiot") | restorer.words("an idiott")
    assert "iddiot" in restorer.words("an iddiot"), "the plain reading stays"
    assert "toto" in restorer.words("7070")


def test_decoding_is_the_best_of_all_readings(restorer):
    """Viterbi's path has the score of the best among all readings, tried one by one."""
    draw = random.Random(3)

    def score(word):
        best = -math.inf
        paths = [(0.0, 0, 0, "")]
        for k in range(len(word)):
            further = []
            for total, a, b, text in paths:
                for letter, cost in restorer.readings(word, k):
                    if letter:
                        c = toxicity.letter_number(letter)
                        further.append((total + cost + restorer.model[a][b][c], b, c, text + letter))
                    else:
                        further.append((total + cost, a, b, text))
            paths = further
        best = max(total + restorer.model[a][b][0] for total, a, b, _ in paths)
        return best, {text for total, a, b, text in paths if abs(total + restorer.model[a][b][0] - best) < 1e-9}

    for _ in range(60):
        word = "".join(draw.choice("ab1!0.oo$") for _ in range(6))
        assert restorer.decode(word) in score(word)[1]


def test_toxic_documents_of_the_held_out_part(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scorer = toxicity.learnt(spark, SMALL, docs)
    judged = toxicity.score(docs, scorer).join(labels, "doc_id").filter(crc_mod("doc_id", 5) == 0)
    n = {(r.toxic, r.p): r.n for r in judged.groupBy("toxic", (F.col("score") >= 0.5).alias("p")).agg(F.count("*").alias("n")).collect()}
    assert n.get((0, True), 0) <= 0.02 * n[(0, False)]
    assert n.get((1, True), 0) >= n.get((1, False), 0)


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 0, 1), (7, 1, 0), (None, 1, 1)], "doc_id bigint, toxic int, quality int")
    scorer = toxicity.fit(odd, labels)
    rows = toxicity.score(odd.withColumn("SCORE", F.lit("x")), scorer).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_forward_sums_over_all_segmentations():
    lattices = language.Lattices([" a", "a", "b", "ab", "ba", " ab", "aba"])
    chances = np.random.default_rng(1).dirichlet(np.ones(lattices.size), 2).T

    def total(word, lang):
        if not word:
            return 1.0
        out = 0.0
        for k in range(1, len(word) + 1):
            piece = lattices.numbers.get(word[:k], 0 if k == 1 else None)
            if piece is not None:
                out += chances[piece, lang] * total(word[k:], lang)
        return out

    words = [" aba", " abab", " b", " aabbab", " cab"]
    got = lattices.log_chances(words, chances)
    for i, w in enumerate(words):
        for lang in (0, 1):
            assert math.isclose(got[i, lang], math.log(total(w, lang)), rel_tol=1e-9)
    # The expected uses of pieces, in letters, add up to the letters of the words.
    uses = lattices.expected(words, np.ones(len(words)), np.zeros(len(words), dtype=int), chances)
    sizes = np.array([1] + [len(p) for p in lattices.numbers])
    assert math.isclose(float(sizes @ uses[:, 0]), sum(map(len, words)), rel_tol=1e-9)


def test_languages_of_the_held_out_part(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = crc_mod("doc_id", 4) == 2
    model = language.fit(docs.filter(~held))
    right = language.identify(docs.filter(held), model).filter("lang = lang_pred").count()
    assert right >= 0.97 * docs.filter(held).count()


def test_language_of_odd_rows(odd, none):
    model = language.fit(odd)
    rows = language.identify(odd.withColumn("Score", F.lit("x")), model).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert language.identify(none, model).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.fit(none)).collect()} == {"und"}
