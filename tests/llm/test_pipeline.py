from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest

from tapewarden.llm import bpe, mixing, neardup, secrets, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline():
    import corpus_pipeline

    return corpus_pipeline


def test_each_stage_does_what_its_operator_says(spark, documents, pipeline):
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "secrets", "mixing", "tokens"]
    stages = dict(pipeline.STAGES)

    clean = stages["toxicity"](spark, documents, FOLDER).cache()
    scorer = toxicity.learnt(spark, FOLDER, documents)
    toxic = {r.doc_id for r in toxicity.score(documents, scorer).collect() if r.score >= 0.5}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in documents.collect()} - toxic

    unique = stages["near_copies"](spark, clean, FOLDER).cache()
    groups = neardup.near_duplicates(clean, 5, 80).collect()
    assert Counter(r.doc_id for r in unique.collect()) == Counter({r.component_id for r in groups})

    safe = stages["secrets"](spark, unique, FOLDER).cache()
    assert safe.count() == unique.count()
    assert all(not secrets.base_spans(r.text) and r.n_chars == len(r.text) for r in safe.collect())

    mixed = stages["mixing"](spark, safe, FOLDER).cache()
    taken = {r.doc_id: r.taken for r in mixing.mix(safe).collect()}
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({k: n for k, n in taken.items() if n})

    tokens = stages["tokens"](spark, mixed, FOLDER).collect()
    codec = bpe.Codec(bpe.default_vocabulary())
    assert Counter((r.doc_id, codec.decode(r.ids)) for r in tokens) == Counter((r.doc_id, r.text) for r in mixed.collect())
    for stage in (clean, unique, safe, mixed):
        assert stage.columns == documents.columns


def test_stages_on_odd_rows(spark, odd, none, pipeline):
    for docs in (odd, none):
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            assert out.count() <= 2 * docs.count()
            if name in ("secrets", "tokens"):
                assert out.count() == docs.count()
    stay = dict(pipeline.STAGES)["near_copies"](spark, odd, FOLDER).collect()
    # One of the three rows with equal text; the rows without words all stay.
    assert Counter(r.doc_id for r in stay) == Counter([1, 2, 3, 4, 6, 7, None, 9, 10])


BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest_batch(session):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    texts = session.range(0, 10_000, 1, 1).selectExpr("repeat('x', 300) AS text")
    return texts.mapInArrow(run, "n bigint").agg({"n": "max"}).first()[0]


@pytest.mark.parametrize("name", ["toxicity", "near_copies", "secrets", "tokens"])
def test_python_workers_get_small_batches(spark, pipeline, name):
    session = spark.newSession()
    docs = session.read.parquet(f"{FOLDER}/documents.parquet")
    assert largest_batch(session) > 2 << 20
    assert dict(pipeline.STAGES)[name](session, docs, FOLDER).count()
    assert largest_batch(session) < 2 << 20


def test_results_do_not_depend_on_batches_and_a_session_keeps_its_bound(spark, documents, pipeline):
    rows = {}
    for size in ("64m", "4k"):
        session = spark.newSession()
        session.conf.set(BOUND, size)
        # Many near-copies in one group, so that a group comes in several batches.
        docs = session.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 400")
        copies = session.range(150).selectExpr(
            "id + 5000 AS doc_id",
            "concat_ws(' ', transform(sequence(1, 300), x -> concat('w', if(x = 7, id, x)))) AS text",
            "'en' AS lang", "'z' AS source", "length(text) AS n_chars",
        )
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(copies)
        for name, stage in pipeline.STAGES[:3]:
            docs = stage(session, docs, FOLDER)
        rows[size] = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        assert session.conf.get(BOUND) == size
    assert rows["64m"] == rows["4k"]
    assert sum(i >= 5000 for i, _ in rows["4k"]) == 1
