from __future__ import annotations

import re
from collections import Counter

from tapewarden.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def measured(docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return [(r.text, tuple(r[n] for n in names)) for r in quality.measures(docs).collect()]


def test_measures(documents, odd, spark, none):
    more = spark.createDataFrame(
        [("a b c a b c a b c",), ("a a a a",), ("a a a",), ("x\n\nx\n x\nx",), ("a b a b",), ("a b c d a b c",)], "text string"
    )
    for docs in (documents, odd, more):
        for text, got in measured(docs):
            assert got == plain(text)
    assert measured(none) == []


def test_order_does_not_change_verdicts(documents):
    def verdicts(rules):
        return sorted((r.doc_id, r.kept) for r in quality.cascade(documents, rules).collect())

    assert verdicts(quality.RULES) == verdicts(quality.RULES[::-1])


def test_rules_are_ordered_by_rejections_for_cost(documents):
    found = quality.ordered(documents)
    assert {r.name for r, *_ in found} == {r.name for r in quality.RULES}
    gains = [share / cost for _, share, cost in found]
    assert gains == sorted(gains, reverse=True)


def test_labels(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.cascade(docs, quality.RULES).join(labels, "doc_id").filter("NOT base_failed")
    wrong = judged.filter("kept <> (quality = 1)").count()
    assert wrong <= 0.02 * judged.count()


def test_odd_rows(odd, none):
    rows = quality.cascade(odd.withColumn("KEPT", odd.doc_id), quality.RULES).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if not r.text)
    assert quality.cascade(none, quality.RULES).count() == 0


def test_the_plan_has_no_python_and_no_exchange(documents):
    plan = quality.cascade(documents, quality.RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow", plan)
