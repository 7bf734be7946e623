from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tapewarden.llm import neardup


def plain_sets(rows, width):
    out = []
    for _, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in lower.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
        n = min(width, len(words))
        out.append({tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set())
    return out


def plain_components(rows, width, percent):
    sets = plain_sets(rows, width)
    above = list(range(len(rows)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                above[top(i)] = top(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[top(i)] = min(doc_id, ids.get(top(i), doc_id))
    return sorted(((d, len(s), d if not s else ids.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(docs, width, percent):
    rows = neardup.near_duplicates(docs, width, percent).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_of_documents(documents, odd, width, percent):
    for docs in (documents, odd):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert found(docs, width, percent) == plain_components(rows, width, percent)


def copies(n, seed):
    """A cloud of copies of copies, each with some words changed, and texts that share a passage with it."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    texts = [[word() for _ in range(80)]]
    for _ in range(n - 1):
        text = list(draw.choice(texts[-20:]))
        for _ in range(draw.randrange(1, 6)):
            text[draw.randrange(80)] = word()
        texts.append(text)
    passage = texts[0][:30]
    texts += [passage + [word() for _ in range(60)] for _ in range(30)]
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def test_a_group_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = copies(150, 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(docs, 3, 85) == plain_components(rows, 3, 85)


def test_tables_without_rows_or_links(spark, none):
    assert found(none, 5, 80) == []
    docs = spark.createDataFrame([(2, "a b c"), (1, "d e f g"), (3, None)], "doc_id bigint, text string")
    assert found(docs, 5, 80) == [(1, 1, 1), (2, 1, 2), (3, 0, 3)]


def test_matches_needed():
    assert neardup.least_matches(1.0) == 32
    t = neardup.least_matches(0.85)
    draws = np.random.default_rng(1).binomial(32, 0.85, 2_000_000)
    assert (draws < t).mean() < 5e-6
    assert (draws < t + 2).mean() > 1e-6


def test_common_counts_and_forest():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 300, 120).astype(np.uint64)) for _ in range(20)] + [np.array([9999], dtype=np.uint64)]
    got = neardup.common_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))
    same = np.arange(50, dtype=np.uint64)
    n = 40
    group = pa.table({
        "node": pa.array([bytes([k]) for k in range(n)], pa.binary()), "n_shingles": pa.array([50] * n, pa.int64()),
        "block": pa.array([0] * n, pa.int32()), "signature": pa.array([[1] * 32] * n, pa.list_(pa.int64())),
        "shingles": pa.array([same.tobytes()] * n, pa.binary()),
    })
    assert neardup.links_of(group, 17, 85).num_rows == n - 1


def test_lists_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 2)
    monkeypatch.setattr(neardup, "WIDER", 3)
    rows = copies(100, 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(docs, 3, 85) == plain_components(rows, 3, 85)


def chain(n, seed):
    """Texts that share a passage with the one before and another with the one after, and a copy of each thirtieth."""
    draw = random.Random(seed)
    words = lambda k: ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(k)]
    passages = [words(30) for _ in range(n + 1)]
    texts = [passages[k] + words(15) + passages[k + 1] for k in range(n)]
    texts += [[*texts[k], "end"] for k in range(0, n, 30)]
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def test_texts_that_only_share_passages_are_not_compared_by_blocks(spark, monkeypatch):
    compared, with_sets = [], []
    pairs, sets = neardup.block_pairs, neardup.full_sets

    def block_pairs(*given):
        compared.append((out := pairs(*given)).count())
        return out

    def full_sets(docs, nodes, *given):
        with_sets.append(nodes.count())
        return sets(docs, nodes, *given)

    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "block_pairs", block_pairs)
    monkeypatch.setattr(neardup, "full_sets", full_sets)
    rows = chain(300, 4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(docs, 3, 85) == plain_components(rows, 3, 85)
    assert sum(compared) <= 2 * len(rows)
    assert sum(with_sets) <= len(rows) / 4


def test_agreeing_joins_different_roots_only():
    def table(roots, blocks):
        n = len(roots)
        return pa.table({
            "node": pa.array([bytes([k]) for k in range(n)], pa.binary()), "root": pa.array(roots, pa.binary()),
            "n_shingles": pa.array([50] * n, pa.int64()), "block": pa.array(blocks, pa.int32()),
            "signature": pa.array([[1] * 32] * (n - 1) + [[2] * 32], pa.list_(pa.int64())),
        })

    def joined(roots, blocks):
        return neardup.agreeing(table(roots, blocks), 16, 85).num_rows

    n = 600
    own = [k.to_bytes(2, "big") for k in range(n)]
    small = own[:40]
    assert joined(small, [0] * 40) == 38
    assert joined([b"x"] * 40, [0] * 40) == 0
    assert joined([b"x"] * 20 + small[20:], [0] * 40) == 19
    assert joined(small, [0] * 20 + [1] * 20) == 38
    assert joined([b"x"] * 20 + [b"y"] * 20, [0] * 20 + [1] * 20) == 1


def test_full_sets_of_the_wanted_rows(spark, monkeypatch):
    rows = [(k, f"word{k} and more of it {k % 7}") for k in range(400)] + [(None, "no id here at all"), (3, "word3 and more of it 3")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    signed = neardup.sign(docs, 3, 32, "doc_id", "text")
    nodes = signed.filter("doc_id IS NULL OR doc_id < 5").selectExpr("node", "struct(doc_id, text_hash) AS row").distinct()
    got = neardup.full_sets(docs, nodes, 3, "doc_id", "text").collect()
    shingler = neardup.Shingler(3)
    assert sorted(bytes(r.node) for r in got) == sorted(bytes(r.node) for r in nodes.collect())
    assert {bytes(r.shingles) for r in got} == {shingler(t).tobytes() for d, t in rows if d is None or d < 5}
