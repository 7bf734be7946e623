from __future__ import annotations

from tapewarden.llm import mixing


def plain_levels(sizes, weights, share, epochs):
    """Water-filling in rounds: what is above a cap is shared anew until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > epochs * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = float(epochs * sizes[s])
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "ä": 5, "z": 0, None: 300, "B": 77}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.water_levels(frame, (3, 1, 2), 1.5, 2).collect()}
    want = plain_levels(sizes, (3, 1, 2), 1.5, 2)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_documents_meet_their_targets(odd, documents, none):
    for docs in (odd.withColumn("Size", odd.doc_id), documents):
        rows = mixing.mix(docs).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
        for source in {r.source for r in rows}:
            own = [r for r in rows if r.source == source]
            assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
            assert sum(r["size"] for r in own) == own[0].source_size
    assert mixing.mix(none).count() == 0


def test_runs_agree(documents):
    def taken():
        return sorted((r.doc_id, r.taken) for r in mixing.mix(documents).collect())

    assert taken() == taken()


def test_the_mix_itself_has_the_words_taken(documents, odd):
    for docs in (documents, odd):
        wanted = {}
        for r in mixing.mix(docs).collect():
            wanted[r.doc_id] = wanted.get(r.doc_id, 0) + r.taken
        got = {}
        for r in mixing.repeated(docs).select("doc_id", mixing.word_count().alias("n")).collect():
            got[r.doc_id] = got.get(r.doc_id, 0) + r.n
        assert got == {k: n for k, n in wanted.items() if n}
