from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tapewarden.llm import fingerprints as fp


def plain_walk(walk, codes):
    at, out = 0, []
    for c in codes.tolist():
        at += walk.rows[c % fp.CLASSES][at % fp.PERIOD]
        out.append(at)
    return np.array(out, dtype=np.int64)


def plain_print(walk, text):
    codes = fp.code_points(text)
    return walk.fingerprint(codes, plain_walk(walk, codes))


def test_walks_side_by_side_equal_walks_alone(texts):
    walk = fp.Walk()
    codes = [fp.code_points(t) for t in ["", "a", *texts.values()]]
    for one, ends in zip(codes, walk.ends(codes, [0] * len(codes)), strict=True):
        assert (plain_walk(walk, one) == ends).all()


def test_likeness_falls_with_edits(texts):
    walk, draw = fp.Walk(), random.Random(5)
    text = max(texts.values(), key=len)
    own = plain_print(walk, text)
    last = 1.0
    for edits in (0, 3, 60, 1500):
        changed = list(text)
        for _ in range(edits):
            k = draw.randrange(len(changed))
            changed[k : k + 1] = draw.choice([[], ["q"], ["q", "z"]])
        near = fp.likeness(own, plain_print(walk, "".join(changed)))
        assert near <= last + 0.02
        last = near
    assert last < 0.5


def test_edited_texts(documents, odd, none):
    walk = fp.Walk()
    for docs in (documents, odd):
        got = fp.edited(docs).collect()
        rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (-(2**63) if r[0] is None else r[0], r[1]))
        want = []
        for k, (i, text) in enumerate(rows):
            after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
            changed = text[: len(text) - half] + after[:half]
            a, b, c = (plain_print(walk, x) for x in (text, changed, after))
            want.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), fp.likeness(a, b), fp.likeness(a, c)))
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert fp.edited(none).count() == 0


def test_small_blocks_give_the_same_neighbours(documents):
    blocks = fp.with_next(documents, rows_per_block=7).collect()
    ids = sorted(r.id for r in blocks if not r.guest)
    follows = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    by = {}
    for r in blocks:
        by.setdefault(r.block, []).append((r.guest, r.id))
    for rows in by.values():
        rows.sort()
        for (_, a), (_, b) in zip(rows, rows[1:], strict=False):
            assert follows[a] == b
        assert rows[-1][0] == 1


def test_banding_finds_near_copies(spark, texts):
    base = list(texts.values())[:40]
    rows = [(k, t) for k, t in enumerate(base)] + [(1000 + k, t[: len(t) // 3] + "zz" + t[len(t) // 3 :]) for k, t in enumerate(base) if len(t) > 400]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    prints = fp.fingerprints(docs).cache()
    found = {(r.a, r.b) for r in fp.similar_pairs(prints, least=0.7).collect()}
    of = {r.doc_id: r.class_id for r in fp.classes(prints).collect()}
    wanted = [(of[k], of[1000 + k]) for k, t in enumerate(base) if len(t) > 400]
    assert sum(a == b or (min(a, b), max(a, b)) in found for a, b in wanted) >= 0.9 * len(wanted)
    assert fp.fingerprints(docs.limit(0)).count() == 0


def test_all_pairs_of_a_bucket_larger_than_a_block(spark):
    """Alike classes that share one large bucket only, neither its first nor neighbours in it."""
    draw = np.random.default_rng(2)
    codes = draw.integers(0, 256, (2 * fp.BLOCK + 90, fp.PLACES), dtype=np.uint8)
    codes[:, ::32] = 7
    half = len(codes) // 2
    # Pairs differ in one place of each other band.
    codes[half : 2 * half] = codes[:half]
    codes[half : 2 * half, 1:32] ^= draw.integers(1, 256, (half, 31), dtype=np.uint8)
    prints = spark.createDataFrame([(k, c.tobytes().hex()) for k, c in enumerate(codes)], "doc_id bigint, fingerprint string")
    found = {(r.a, r.b): r.likeness for r in fp.similar_pairs(prints, least=0.6).collect()}
    want = {}
    for a in range(len(codes)):
        share = (codes[a + 1 :] == codes[a]).mean(axis=1)
        want |= {(a, a + 1 + int(k)): float(share[k]) for k in np.flatnonzero(share >= 0.6)}
    assert len(want) >= half
    assert found == want


def test_links_equal_brute_force(spark, documents, odd, none):
    """All pairs of different fingerprints, in a bucket larger than a block too, for clashing columns, nulls and copies."""
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    # Texts alike but for their ends: a bucket of more classes than a block holds.
    long = max((t or "" for _, t in rows), key=len)[:3000]
    rows += [(100_000 + k, long + f" end {k} " + "z" * (k % 7)) for k in range(2 * fp.BLOCK + 40)] + [(7, long), (None, long)]
    many = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).withColumn("class_id", F.lit("x"))
    walk = fp.Walk()
    for docs in (many, odd):
        got = fp.links(docs).collect()
        texts = [(r.doc_id, r.text or "") for r in docs.collect()]
        codes = [fp.code_points(t) for _, t in texts]
        prints = {t: walk.fingerprint(c, e) for (_, t), c, e in zip(texts, codes, walk.ends(codes, [0] * len(codes)), strict=True)}
        classes = {}
        for i, t in texts:
            classes.setdefault(prints[t].tobytes(), []).append(i)
        keys = list(classes)
        table = np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, fp.PLACES)
        n = {}
        for key, row in zip(keys, table, strict=True):
            alike = ((table == row).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
            n[key] = int((alike >= 0.8).sum()) - 1
        want = {}
        for key, ids in classes.items():
            least = min((i for i in ids if i is not None), default=None)
            for i in ids:
                want.setdefault(i, []).append((least, n[key]))
        assert len(got) == len(texts)
        found = {}
        for r in got:
            found.setdefault(r.doc_id, []).append((r.class_id, r.n_links))
        links_found = sum(x for rows_of in found.values() for _, x in rows_of)
        links_wanted = sum(x for rows_of in want.values() for _, x in rows_of)
        assert 0.98 * links_wanted <= links_found <= links_wanted
        assert {i: sorted(c for c, _ in rows_of if c is not None) for i, rows_of in found.items()} == {
            i: sorted(c for c, _ in rows_of if c is not None) for i, rows_of in want.items()
        }
        for i, rows_of in found.items():
            assert all(x <= most for (_, x), (_, most) in zip(sorted(rows_of, key=repr), sorted(want[i], key=repr), strict=True))
    assert fp.links(none).count() == 0
