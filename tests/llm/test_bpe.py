from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from tapewarden.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.default_vocabulary())


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_ids_and_text_equal_the_library(library, codec, texts):
    odd = ["", "a<|endoftext|>b <|endoftext|>", "  \n\n x\t y  ", "日本語 🎉🎉 ́", "a" * 5000, "<|endoftext", "it's  we'LL"]
    for text in [*texts.values(), *odd]:
        ids = codec(text)
        assert ids == ids_of(library, text)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_random_strings(library, codec):
    draw = random.Random(4)
    for _ in range(300):
        text = "".join(draw.choice("ab c\n'sé日🎉1.") for _ in range(draw.randrange(60)))
        assert codec(text) == ids_of(library, text)


def test_bytes_that_are_no_text(codec):
    ids = codec("日")
    assert codec.decode(ids[:1]) == "�"


def test_odd_rows(spark, odd, none):
    rows = bpe.encode(odd.withColumn("IDS", odd.doc_id)).collect()
    assert len(rows) == odd.count()
    assert all(len(r.ids) > 0 for r in rows if r.text)
    back = bpe.decode(bpe.encode(odd)).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert bpe.encode(none).count() == 0
