"""The registered queries that have no SQL, run as registered: a row a document, columns, flags and digests."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tapewarden.llm import QUERIES

FOLDER = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op2_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op3_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op7_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op7_links": "doc_id bigint, class_id bigint, n_links bigint",
    "op9_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_neardup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_a_row_for_each_document(spark, texts, name):
    got = QUERIES[name](spark, FOLDER)
    types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    for column in COLUMNS[name].split(", "):
        column, kind = column.split()
        assert types[column] == kind
    found = got.collect()
    rows = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and set(rows) == set(texts)
    for i, r in rows.items():
        text = texts[i] or ""
        if "score" in types:
            assert 0 <= r.score <= 1
            rest = zlib.crc32(str(i).encode())
            assert r.held_out == (rest % 5 == 0 if name == "op3_toxicity" else rest % 4 == 2)
        if "predicted" in types:
            assert r.predicted == int(r.score >= 0.5)
        if "spans" in types:
            base = [s for s in r.spans.split(",") if s and s.split(":")[0] not in ("handle", "number", "crf")]
            assert len(base) == sum(r[c] for c in types if c.startswith("n_"))
            assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        if "base_failed" in types:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.kept and r.base_failed)
        if "decoded_sha256" in types:
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        if "component_id" in types:
            assert r.component_id <= i and r.kept == (r.component_id == i)
            assert rows[r.component_id].component_id == r.component_id
        if "class_id" in types:
            assert r.class_id <= i and rows[r.class_id].n_links == r.n_links
