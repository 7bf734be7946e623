from __future__ import annotations

import math
from collections import Counter

from tapewarden.llm import backoff


def plain(rows):
    lists = [(i, (t or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")) for i, t in rows]
    lists = [(i, [w for w in x if w]) for i, x in lists]
    one = Counter(w for _, x in lists for w in x)
    two = Counter(p for _, x in lists for p in zip(x, x[1:], strict=False))
    before = Counter(v for _, x in lists for v in x[:-1])
    n, out = sum(one.values()), []
    for i, x in lists:
        total, seen = 0.0, 0
        for k, w in enumerate(x):
            if k and two[x[k - 1], w] >= 2:
                total += math.log(two[x[k - 1], w] / before[x[k - 1]])
                seen += 1
            else:
                total += math.log(one[w] / n) + (math.log(0.4) if k else 0)
        out.append((i, len(x), seen, round(total, 4)))
    return sorted(out, key=repr)


def found(docs):
    return sorted(((r.doc_id, r.n_words, r.n_seen, round(r.score, 4)) for r in backoff.score(docs).collect()), key=repr)


def test_scores(documents, odd, none, monkeypatch):
    assert found(documents) == plain([(r.doc_id, r.text) for r in documents.collect()])
    assert found(odd) == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert found(none) == []


def test_many_parts_hot_contexts_and_rare_words(documents, monkeypatch):
    monkeypatch.setattr(backoff, "PART", 3_000)
    monkeypatch.setattr(backoff, "CHUNK", 2_000)
    monkeypatch.setattr(backoff, "HOT_SHARE", 1e-2)
    monkeypatch.setattr(backoff, "COMMON_SHARE", 1e-2)
    assert found(documents) == plain([(r.doc_id, r.text) for r in documents.collect()])


def plain_triples(rows):
    lists = [(i, (t or "").encode().split()) for i, t in rows]
    one = Counter(w for _, x in lists for w in x)
    two = Counter(p for _, x in lists for p in zip(x, x[1:], strict=False))
    three = Counter(p for _, x in lists for p in zip(x, x[1:], x[2:], strict=False))
    before = Counter(v for _, x in lists for v in x[:-1])
    before_two = Counter(p for _, x in lists for p in zip(x[:-1], x[1:-1], strict=False))
    n, out = sum(one.values()), []
    for i, x in lists:
        total, seen, seen_3 = 0.0, 0, 0
        for k, w in enumerate(x):
            if k > 1 and three[x[k - 2], x[k - 1], w] >= 2:
                total += math.log(three[x[k - 2], x[k - 1], w] / before_two[x[k - 2], x[k - 1]])
                seen, seen_3 = seen + 1, seen_3 + 1
            elif k and two[x[k - 1], w] >= 2:
                total += math.log(two[x[k - 1], w] / before[x[k - 1]]) + (math.log(0.4) if k > 1 else 0)
                seen += 1
            else:
                total += math.log(one[w] / n) + math.log(0.4) * min(k, 2)
        out.append((i, len(x), seen, seen_3, round(total, 4)))
    return sorted(out, key=repr)


def found_triples(docs):
    rows = backoff.score(docs, order=3).collect()
    return sorted(((r.doc_id, r.n_words, r.n_seen, r.n_seen_3, round(r.score, 4)) for r in rows), key=repr)


def test_triples_back_off_to_pairs_and_words(documents, odd, none, monkeypatch):
    assert found_triples(odd) == plain_triples([(r.doc_id, r.text) for r in odd.collect()])
    assert found_triples(none) == []
    want = plain_triples([(r.doc_id, r.text) for r in documents.collect()])
    assert found_triples(documents) == want
    # Many parts; hot contexts and hot pairs of words; most words looked up by a join.
    monkeypatch.setattr(backoff, "PART", 3_000)
    monkeypatch.setattr(backoff, "CHUNK", 2_000)
    monkeypatch.setattr(backoff, "HOT_SHARE", 2e-3)
    monkeypatch.setattr(backoff, "COMMON_SHARE", 1e-2)
    assert found_triples(documents) == want


def test_common_words_take_few_bytes(spark):
    """Pairs of common words travel by their places in the word table, not by hashes of eight bytes; rare ones stay whole."""
    import numpy as np
    import random

    deal = random.Random(3)
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{deal.randrange(200)}" for _ in range(2_000)) + f" rare{i}") for i in range(20)], "doc_id int, text string"
    )
    words = np.sort(np.unique(backoff.Hasher()([f"w{i}".encode() for i in range(200)])))
    none = np.zeros(0, dtype=np.uint64)

    def size(*common):
        rows = backoff.packed_pairs(docs, none, 4, "doc_id", "text", 2, None, *common).filter("words IS NOT NULL").collect()
        pairs = sum(len(r.docs) // 2 for r in rows)
        return sum(len(r.words) + len(r.rare) for r in rows) / pairs, rows

    few, rows = size(words)
    assert few < 3.1 < size()[0]
    got = np.concatenate([backoff.decoded(words, [r.words], [r.rare]) for r in rows])
    assert set(got.tolist()) == set(backoff.Hasher()([w for r in docs.collect() for w in backoff.split(r.text)]).tolist())
