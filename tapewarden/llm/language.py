"""Operator 4: language by unigram pieces, summed over all segmentations of each word."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm.common import annotate, crc_mod, documents, sampled

LETTERS = re.compile(r"[^\W\d_]+")
#: Longer runs of letters are cut into parts of so many, which keeps sums within doubles.
LONGEST_RUN = 48
LONGEST_PIECE = 12
#: Words whose scores a task keeps at most; beyond it the table starts anew.
CACHED_WORDS = 400_000
UNKNOWN = "und"


def vocabulary(path: str) -> list[str]:
    """Pieces of letters of a public vocabulary file, lower case, in order; a word's start is written as a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).replace("▁", " ").lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if re.fullmatch(r" ?[^\W\d_]+", p) and len(p) <= LONGEST_PIECE)


def default_vocabulary() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class Lattices:
    """Sums over all segmentations of words into pieces, for many words at once.

    Words of equal length are rows of one matrix. A letter that no piece covers
    is read by the unknown piece (number 0), so each word has a segmentation.
    """

    def __init__(self, pieces: Sequence[str]) -> None:
        self.numbers = {p: i for i, p in enumerate(pieces, 1)}
        self.size = len(pieces) + 1

    def edges(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of the words, all as long as one another, a space in front."""
        n = len(words[0])
        get = self.numbers.get
        out = []
        for end in range(1, n + 1):
            for start in range(max(0, end - LONGEST_PIECE), end):
                single = end - start == 1
                found = [get(w[start:end], 0) for w in words]
                pieces = np.array(found, dtype=np.int32)
                rows = np.arange(len(words)) if single else np.flatnonzero(pieces)
                if len(rows):
                    out.append((start, end, rows, pieces[rows]))
        return out

    def forward(self, words: list[str], chances: np.ndarray, edges=None) -> np.ndarray:
        """Sums up to each place: words x places x languages."""
        n = len(words[0])
        sums = np.zeros((n + 1, len(words), chances.shape[1]))
        sums[0] = 1.0
        for start, end, rows, pieces in edges or self.edges(words):
            if len(rows) == len(words):
                sums[end] += sums[start] * chances[pieces]
            else:
                sums[end, rows] += sums[start, rows] * chances[pieces]
        return sums

    def log_chances(self, words: list[str], chances: np.ndarray) -> np.ndarray:
        """log P(word) for each language; words of any lengths up to LONGEST_RUN, a space in front."""
        out = np.empty((len(words), chances.shape[1]))
        for rows, group in by_length(words):
            out[rows] = np.log(self.forward(group, chances)[-1])
        return out

    def expected(self, words: list[str], counts: np.ndarray, languages: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, pieces x languages, by forward and backward sums.

        `counts[i]` occurrences of `words[i]` in the language `languages[i]`.
        """
        out = np.zeros((self.size, chances.shape[1]))
        for rows, group in by_length(words):
            n = len(group[0])
            edges = self.edges(group)
            sums = self.forward(group, chances, edges)
            back = np.zeros_like(sums)
            back[n] = 1.0
            for start, end, at, pieces in reversed(edges):
                back[start, at] += back[end, at] * chances[pieces]
            mine, here = languages[rows], np.arange(len(group))
            weight = counts[rows] / sums[n, here, mine]
            for start, end, at, pieces in edges:
                uses = sums[start, at, mine[at]] * chances[pieces, mine[at]] * back[end, at, mine[at]] * weight[at]
                np.add.at(out, (pieces, mine[at]), uses)
        return out


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for rows in groups.values():
        # So many rows that the sums of a group stay small.
        step = max(1, 400_000 // len(words[rows[0]]))
        for low in range(0, len(rows), step):
            part = rows[low : low + step]
            yield np.array(part), [words[i] for i in part]


def runs(text: str) -> list[str]:
    """Runs of letters of a text in lower case; long ones in parts."""
    found = LETTERS.findall(text.lower())
    if any(len(w) > LONGEST_RUN for w in found):
        found = [w[k : k + LONGEST_RUN] for w in found for k in range(0, len(w), LONGEST_RUN)]
    return found


class Model:
    """Piece probabilities of each language and how to score texts by them."""

    def __init__(self, pieces: list[str], languages: list[str], chances: np.ndarray) -> None:
        self.pieces, self.languages, self.chances = pieces, languages, chances

    def make(self):
        lattices, chances = Lattices(self.pieces), self.chances
        known: dict[str, int] = {}
        table = np.zeros((0, chances.shape[1]), dtype=np.float32)

        def score(texts: list[str]) -> np.ndarray:
            """log P of each text in each language; NaN where a text has no letters."""
            nonlocal table
            if len(known) > CACHED_WORDS:
                known.clear()
                table = table[:0]
            found = [runs(x) for x in texts]
            new = list({w for x in found for w in x} - known.keys())
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                scored = lattices.log_chances([" " + w for w in new], chances)
                table = np.concatenate([table, scored.astype(np.float32)])
            out = np.full((len(texts), chances.shape[1]), np.nan)
            get = known.__getitem__
            for i, x in enumerate(found):
                if x:
                    out[i] = table[list(map(get, x))].sum(axis=0, dtype=np.float64)
            return out

        return score


def fit(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    text: str = "text",
    lang: str = "lang",
    most_documents: int = 4000,
    rounds: int = 3,
    smoothing: float = 0.05,
    seed: int = 3,
) -> Model:
    """A model of the languages in `docs` (text, lang): the caller leaves out what is held back.

    About `most_documents` documents with a language, chosen by hash, are
    reduced to counts of words by language in Spark. Each round of expectation
    and maximisation runs over that table in tasks; the driver gets the
    expected uses of the pieces, a row for each language and piece.
    """
    pieces = vocabulary(vocabulary_path or default_vocabulary())
    chosen = sampled(docs.select(text, lang).filter(F.col(lang).isNotNull()), most_documents, text, lang, seed=seed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(y, Counter()).update(runs(x or ""))
        for y, words in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([y] * len(words)), pa.array(list(words)), pa.array(list(words.values()))],
                names=["lang", "word", "n"],
            )

    words = (
        chosen.mapInArrow(count, "lang string, word string, n bigint")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .persist()
    )
    try:
        languages = [r[0] for r in words.select("lang").distinct().orderBy("lang").collect()]
        chances = np.full((len(pieces) + 1, max(1, len(languages))), 1.0 / (len(pieces) + 1))
        for _ in range(rounds if languages else 0):
            step = [(r["piece"], r["lang"], r["uses"]) for r in uses(words, pieces, languages, chances).collect()]
            total = np.full(chances.shape, smoothing)
            for piece, y, n in step:
                total[piece, y] += n
            chances = total / total.sum(axis=0)
    finally:
        words.unpersist()
    return Model(pieces, languages, chances)


def uses(words: DataFrame, pieces: list[str], languages: list[str], chances: np.ndarray) -> DataFrame:
    """Expected uses of pieces (`piece`, `lang` as numbers) over a table of words with counts."""
    number = {y: i for i, y in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(pieces)
        total = np.zeros(chances.shape)
        for batch in batches:
            of = [" " + w for w in batch.column(1).to_pylist()]
            langs = np.array([number[y] for y in batch.column(0).to_pylist()])
            total += lattices.expected(of, batch.column(2).to_numpy().astype(float), langs, chances)
        piece, y = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece), pa.array(y), pa.array(total[piece, y])], names=["piece", "lang", "uses"]
        )

    return (
        words.mapInArrow(run, "piece bigint, lang bigint, uses double")
        .groupBy("piece", "lang")
        .agg(F.sum("uses").alias("uses"))
    )


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, the chance of that language among those learnt.

    A null text, or one without letters, is `und` with score 0, and so is every
    text if no language was learnt. Of equal chances, the first language by
    name. Rows are scored one by one; columns of the new names are replaced.
    """

    def make():
        of, names = model.make(), model.languages

        def work(texts: list[str]) -> dict[str, list]:
            if not names:
                return {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)}
            logs = of(texts)
            best = np.where(np.isnan(logs[:, 0]), 0, np.nan_to_num(logs, nan=-np.inf).argmax(axis=1))
            top = logs[np.arange(len(logs)), best]
            shares = 1 / np.exp(logs - top[:, None]).sum(axis=1)
            silent = np.isnan(top)
            return {
                "lang_pred": [UNKNOWN if s else names[b] for s, b in zip(silent, best, strict=True)],
                "score": np.where(silent, 0.0, shares),
            }

        return work

    return annotate(docs, make, "lang_pred string, score double", text)


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = fit(docs.filter(~held_out))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )
