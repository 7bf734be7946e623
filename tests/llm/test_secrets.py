from __future__ import annotations

import random

import numpy as np
import pytest

from tapewarden.llm import secrets


def plain_spans(text):
    """The base spans by a scan that tries each place in turn."""
    import re

    out = []
    for number, (kind, pattern, group, least) in enumerate(secrets.BASE):
        found, at = re.compile(pattern, re.A | (re.I if kind == "assign" else 0)), 0
        while m := found.search(text, at):
            at = m.end()
            if len(m.group(group)) >= least:
                out.append((m.start(), m.end(), number))
    return sorted(out)


def test_base_spans(texts):
    odd = [
        "token: api_key: abcdef", 'PASSWORD = "abc123', "AKIA" + "A" * 15, "AKIA" + "A" * 16, "a" * 23, "a" * 24 + "g",
        "token=token=abcdef", "Kpassword:x12345", "AKIAAKIA" + "B" * 20, "é😀 secret=" + "z" * 9,
    ]
    for text in [*texts.values(), *odd]:
        assert sorted(secrets.base_spans(text)) == plain_spans(text)


@pytest.fixture(scope="module")
def windows():
    draw = random.Random(1)
    out = []
    for _ in range(400):
        words = [draw.choice(["the", "of", "tree", "lamp", "12", "."]) for _ in range(9)]
        tags = [0] * 9
        if draw.random() < 0.6:
            words[3:6] = ["token", "=", "".join(draw.choice("abcdef0123456789") for _ in range(32))]
            tags[5] = 1
        out.append((words, tags, ["f.code=False"]))
    return out


def test_the_field_learns_and_finds_what_no_pattern_has(windows):
    tag = secrets.Tagger(secrets.fit_windows(windows))
    text = "the lamp token = 0123abcd99ef0123abcd99ef0123abcd of tree ."
    assert [text[a:b] for a, b in tag(text)] == ["0123abcd99ef0123abcd99ef0123abcd"]
    assert tag("the lamp of the tree . of 12 the") == []


def test_cut_runs_decode_as_the_whole(windows):
    field = secrets.fit_windows(windows)
    tagger = secrets.Tagger(field)
    draw = random.Random(2)
    for _ in range(200):
        words = [draw.choice(["the", "token", "=", "12", "abcd1234abcd1234", "AKIA12345678", '"', "of"]) for _ in range(30)]
        text = " ".join(words)
        tokens = secrets.TOKEN.findall(text)
        classes = [secrets.EDGE, secrets.EDGE, *map(secrets.token_class, tokens), secrets.EDGE, secrets.EDGE]
        emissions = []
        for k in range(len(tokens)):
            names = secrets.own_features(classes[k + 2]) + secrets.file_features(text, len(tokens))
            for where, shift in zip(secrets.NEAR, (0, 1, 3, 4), strict=True):
                names += secrets.near_features(classes[k + shift], where)
            emissions.append(field.score(names).tolist())
        tags = secrets.viterbi(emissions, field.moves.tolist(), field.first.tolist())
        places = [m.span() for m in secrets.TOKEN.finditer(text)]
        spans = []
        for k, t in enumerate(tags):
            if t == secrets.IN and k and tags[k - 1] != secrets.OUT:
                spans[-1] = (spans[-1][0], places[k][1])
            elif t != secrets.OUT:
                spans.append(places[k])
        spans = [(a, a + len(text[a:b].rstrip(".-/"))) for a, b in spans]
        assert tagger(text) == [(a, b) for a, b in spans if b - a >= 6]


def test_odd_rows(odd, none):
    field = secrets.fit(odd)
    rows = secrets.digests(odd.withColumn("Spans", odd.doc_id), field).collect()
    assert len(rows) == odd.count()
    empty = next(r for r in rows if r.doc_id == 1)
    assert (empty.n_hex, empty.spans) == (0, "")
    assert empty.base_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert secrets.digests(none, secrets.fit(none)).count() == 0


def test_redaction_removes_each_span(spark):
    docs = spark.createDataFrame([(1, "a token=abcdef0123456789abcdef01 b"), (2, None), (3, "nothing")], "doc_id int, text string")
    field = secrets.Field({}, np.zeros((3, 3)), np.array([0.0, -50.0, -50.0]))
    assert [r.text for r in secrets.redact(docs, field).orderBy("doc_id").collect()] == ["a [SECRET] b", None, "nothing"]
