"""Operator 9: byte-pair encoding by a priority queue of merge ranks, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Sequence

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from tapewarden.llm.common import annotate, documents

#: Words whose ids a task keeps at most; beyond it the table starts anew.
CACHED_WORDS = 400_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one byte-level vocabulary file.

    A text is cut at special tokens, each rest by the vocabulary's pattern, and
    every piece is merged by itself. Bytes form a doubly linked list of symbols.
    A heap holds (rank, place) of adjacent pairs that can merge; an entry whose
    pair has changed meanwhile is stale and skipped. The heap's lowest entry is
    the lowest rank, leftmost first, so a piece of n bytes takes O(n log n).
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        of_letter = {letter: b for b, letter in enumerate(letters)}
        vocab = data["model"]["vocab"]
        self.specials = {x["content"]: x["id"] for x in data["added_tokens"]}
        self.bytes_of = {i: bytes(of_letter[c] for c in piece) for piece, i in vocab.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.specials.items()}
        self.of_byte = [vocab[letter] for letter in letters]
        #: (left id, right id) in one number -> rank and merged id in one number.
        self.merges: dict[int, int] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocab[left] << 20 | vocab[right]] = rank << 20 | vocab[left + right]
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, list[int]] = {}
        self.at_special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")").split
            if self.specials
            else None
        )

    def merge(self, piece: bytes) -> list[int]:
        ids = [self.of_byte[b] for b in piece]
        n = len(ids)
        get = self.merges.get
        heap = []
        for i in range(n - 1):
            found = get(ids[i] << 20 | ids[i + 1])
            if found is not None:
                heap.append(((found >> 20) << 32 | i, found & 0xFFFFF, ids[i], ids[i + 1]))
        if not heap:
            return ids
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            key, merged, left, right = pop(heap)
            i = key & 0xFFFFFFFF
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = get(merged << 20 | ids[k])
                if found is not None:
                    push(heap, ((found >> 20) << 32 | i, found & 0xFFFFF, merged, ids[k]))
            h = before[i]
            if h >= 0:
                found = get(ids[h] << 20 | merged)
                if found is not None:
                    push(heap, ((found >> 20) << 32 | h, found & 0xFFFFF, ids[h], merged))
        return [x for x in ids if x >= 0]

    def __call__(self, text: str) -> list[int]:
        """The ids of a text."""
        if self.at_special is None or not any(s in text for s in self.specials):
            return self.ordinary(text)
        out: list[int] = []
        for part in self.at_special(text):
            out += [self.specials[part]] if part in self.specials else self.ordinary(part)
        return out

    def ordinary(self, text: str) -> list[int]:
        known, out = self.known, []
        for piece in self.cut(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                ids = known[piece] = self.merge(piece.encode("utf-8", "surrogatepass"))
            out += ids
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: their byte strings joined; bytes that are no UTF-8 become U+FFFD."""
        bytes_of = self.bytes_of
        return b"".join([bytes_of[i] for i in ids]).decode("utf-8", "replace")


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """`docs` with `ids`, an array of token ids; a null or empty text has none.

    Repeated rows give repeated results. Texts are encoded whole, whatever
    their length; a column named `ids` is replaced.
    """
    path = vocabulary or default_vocabulary()

    def make():
        of = Codec(path)
        return lambda texts: {"ids": [of(x) for x in texts]}

    return annotate(docs, make, "ids array<int>", text)


def decode(rows: DataFrame, vocabulary: str | None = None, ids: str = "ids") -> DataFrame:
    """`rows` with `decoded`, the text of the ids; null ids give an empty text."""
    path = vocabulary or default_vocabulary()

    def make():
        of = Codec(path)
        return lambda lists: {"decoded": [of.decode(x) for x in lists]}

    return annotate(rows, make, "decoded string", ids)


def digests(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """`docs` with `n_tokens` and the digests of a text's ids and of the text decoded from them.

    Encoding and decoding in one pass, so ids need not leave the task.
    """
    path = vocabulary or default_vocabulary()

    def make():
        of = Codec(path)

        def work(texts: list[str]) -> dict[str, list]:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for x in texts:
                ids = of(x)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
                back = of.decode(ids)
                out["decoded_sha256"].append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
            return out

        return work

    return annotate(docs, make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", text)


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
