"""Operator 3: toxicity of texts restored from leetspeak, spacing and repetition by a noisy channel."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm.common import annotate, crc_mod, documents, seeded

# Signs and the letters they stand for in leetspeak.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
SEPARATORS = ".-_*~' "
LETTERS = 28  # a to z, 0 for what ends a word, 27 for any other letter
CHUNK = 4_000_000

#: Signs around a word that stand for no letter.
PLAIN_EDGES = "\"'()[]{}<>.,;:!?*#%&~`/\\=«»…"
EDGES = "\"'()[]{}<>.,;:!?*#%&$|+-_~`/\\=«»…"
ODD = re.compile(r"[^\W\d_][0-9@$!|+(*.\-_~]|[0-9@$!|+(][^\W\d_]|([^\W\d_])\1\1")
#: What may be a disguise or may not: a doubled letter, or signs alone. Both readings count.
MAYBE_ODD = re.compile(r"([^\W\d_])\1|^[0-9@$!|+(*.\-_~]{3,}$")
DOUBLED = re.compile(r"(.)\1")
SPACED = re.compile(r"(?<!\S)(?:(?:[^\W_]|[@$!|+(])\s+){2,}(?:[^\W_]|[@$!|+(])(?!\S)")
#: Costs of ending a word at a narrow blank of a spaced run: each gives a reading, from long words to short ones.
BREAKS = (-2.5, -1.0, 0.0, 1.0)
#: Cost of reading on at a wider blank.
READ_ON = -4.0
#: Longer words are restored each time anew.
LONGEST_KEPT = 60
#: Words that a task remembers at most in each of two halves; when the newer is full, the older one goes.
CACHED_WORDS = 100_000


def letter_number(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts of letter trigrams over all texts: `code`, `n`; LETTERS ** 3 rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([letter_number(chr(c)) for c in range(0x250)], dtype=np.int32)
        total = np.zeros(LETTERS**3, dtype=np.int64)
        for batch in batches:
            block: list[str] = []
            size = 0
            for x in [*batch.column(0).to_pylist(), None]:
                if x is not None:
                    block.append(x)
                    size += len(x)
                if block and (x is None or size > CHUNK):
                    codes = np.frombuffer(" ".join(block).lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
                    numbers = table[np.minimum(codes, 0x24F)]
                    pairs = numbers[:-1] * LETTERS + numbers[1:]
                    total += np.bincount(pairs[:-1] * LETTERS + numbers[2:], minlength=LETTERS**3)
                    block, size = [], 0
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["code", "n"])

    counts = docs.select(text).mapInArrow(run, "code bigint, n bigint")
    return counts.groupBy("code").agg(F.sum("n").alias("n"))


def letter_model(counts: Iterable[tuple[int, int]]) -> np.ndarray:
    """log P(letter | two before), smoothed by the shorter histories, over all letters and ends."""
    three = np.zeros((LETTERS,) * 3)
    for code, n in counts:
        three[code // LETTERS**2, code // LETTERS % LETTERS, code % LETTERS] = n
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one.sum() + LETTERS)
    p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
    p3 = (three + 20 * p2) / (three.sum(axis=2, keepdims=True) + 20)
    return np.log(p3)


class Recent:
    """What `make` gives for a word, remembered for the words met last: at most two halves of CACHED_WORDS."""

    def __init__(self, make: Callable[[str], tuple[str, ...]]) -> None:
        self.make = make
        self.new: dict[str, tuple[str, ...]] = {}
        self.old: dict[str, tuple[str, ...]] = {}

    def of(self, word: str) -> tuple[str, ...]:
        got = self.new.get(word)
        if got is None:
            got = self.old.get(word)
            if got is None:
                got = self.make(word)
            if len(word) <= LONGEST_KEPT:
                if len(self.new) >= CACHED_WORDS:
                    self.old, self.new = self.new, {}
                self.new[word] = got
        return got

    def all_of(self, words: Iterable[str]) -> set[str]:
        out: set[str] = set()
        known = self.new
        for word in words:
            got = known.get(word)
            if got is None:
                got = self.of(word)
                known = self.new
            if got:
                out.update(got)
        return out


class Restorer:
    """Restores words: the best path through the lattice of what each sign may stand for.

    A letter stands for itself; a sign for its letters in leetspeak; a
    separator within a word, and a letter that repeats the one before, may be
    left out. Each reading has a channel cost; the letter model scores the
    letters read. Viterbi keeps the best path for each pair of last letters.
    """

    def __init__(self, model: np.ndarray) -> None:
        self.model = model.tolist()
        self.recent = Recent(self.forms)

    def readings(self, word: str, k: int) -> list[tuple[str, float]]:
        c = word[k]
        if c.isalpha():
            out = [(c, -0.02)]
            if k and word[k - 1] == c:
                repeats = k > 1 and word[k - 2] == c or k + 1 < len(word) and word[k + 1] == c
                out.append(("", -0.3 if repeats else -4.0))
            return out
        out = [(letter, -1.5) for letter in LEET.get(c, "")]
        if c in SEPARATORS or k and word[k - 1] == c:
            out.append(("", -1.0))
        return out or [("", -3.0)]

    def decode(self, word: str, wide: list[bool] | None = None, end: float = 0.0) -> str:
        """The most likely letters behind a word of any signs, in lower case.

        With `wide`, one entry for each blank of a spaced run, a word may end
        at each blank, at the cost `end` if it is narrow: the words read have a blank between them.

        Letters before the first place with a choice cost every path the same,
        and so do those behind the last one once a single path is left.
        """
        model = self.model
        first, last = 0, len(word)
        if wide is None:
            choices = [k for k, c in enumerate(word) if not c.isalpha() or k and word[k - 1] == c]
            if not choices:
                return word
            first, last = choices[0], choices[-1]
        before = [letter_number(c) for c in word[max(0, first - 2) : first]]
        # Last two letters -> (score, letters read, as a linked list).
        start = (0, 0, *before)[-2:]
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {start: (0.0, None)}
        for k in range(first, len(word)):
            if k and wide is not None:
                ends, goes_on = (0.0, READ_ON) if wide[k - 1] else (end, 0.0)
                broken = {
                    (b, 0): (score + ends + model[a][b][0], (letters, " "))
                    for (a, b), (score, letters) in sorted(paths.items(), key=lambda x: x[1][0] + model[x[0][0]][x[0][1]][0])
                    if b
                }
                paths = {state: (score + goes_on, letters) for state, (score, letters) in paths.items()} | broken
            further: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            read = [(letter, letter_number(letter) if letter else -1, cost) for letter, cost in self.readings(word, k)]
            for (a, b), (score, letters) in paths.items():
                for letter, number, cost in read:
                    if number < 0:
                        state, total, then = (a, b), score + cost, letters
                    else:
                        state, total, then = (b, number), score + cost + model[a][b][number], (letters, letter)
                    if state not in further or further[state][0] < total:
                        further[state] = (total, then)
            paths = further
            if k >= last and len(paths) == 1:
                return word[:first] + self.best(paths) + word[k + 1 :]
        return word[:first] + self.best(paths)

    def best(self, paths: dict[tuple[int, int], tuple[float, tuple | None]]) -> str:
        """The letters of the best path when the word ends here."""
        model = self.model
        _, letters = max(
            ((score + model[a][b][0], then) for (a, b), (score, then) in paths.items()), key=lambda x: x[0]
        )
        out = []
        while letters is not None:
            letters, letter = letters
            out.append(letter)
        return "".join(reversed(out))

    def word(self, raw: str) -> str:
        """A word without the signs around it, restored if it looks disguised."""
        core = raw.strip(PLAIN_EDGES)
        if core.endswith("$$$"):
            core = core.rstrip("$")
        return self.decode(core) if ODD.search(core) else core.strip(EDGES)

    def other(self, raw: str) -> str:
        """The restored form of a word that may be a disguise or may not, else the empty string."""
        # Signs at the edges of a word of signs alone may stand for letters.
        core = raw if MAYBE_ODD.fullmatch(raw) else raw.strip(PLAIN_EDGES)
        return self.decode(core) if MAYBE_ODD.search(core) else ""

    def forms(self, raw: str) -> tuple[str, ...]:
        """Both readings of a word in lower case."""
        if raw.isalpha() and not DOUBLED.search(raw):
            return (raw,)
        return tuple(w for w in dict.fromkeys((self.word(raw), self.other(raw))) if w)

    def spaced(self, run: str) -> set[str]:
        """Words behind a run of single letters: the whole run, its parts between wider blanks, and words by word ends in the lattice."""
        letters, blanks = "".join(run.split()), [len(x) for x in re.findall(r"\s+", run)]
        narrow = min(blanks)
        wide = [n > narrow for n in blanks]
        parts, low = [], 0
        for k, w in enumerate(wide, 1):
            if w:
                parts.append(letters[low:k])
                low = k
        parts.append(letters[low:])
        ended = [w for end in BREAKS for w in self.decode(letters, wide, end).split()]
        return {self.decode(letters), *map(self.decode, parts), *ended}

    def split(self, text: str) -> tuple[set[str], set[str]]:
        """The distinct words of a text in lower case as they stand, and the words behind its spaced runs."""
        low = text.lower()
        raw = low.split()
        single = [k for k, w in enumerate(raw) if len(w) == 1]
        behind: set[str] = set()
        # A run has three single signs side by side.
        if any(b - a == 2 for a, b in zip(single, single[2:])):
            for m in SPACED.finditer(low):
                behind |= self.spaced(m.group())
            behind.discard("")
        return set(raw), behind

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text."""
        raw, behind = self.split(text)
        return self.recent.all_of(raw) | behind


def copy_key(text: str) -> Column:
    """A number that near-copies mostly share and others do not: the least hash of three words in a row."""
    hashed = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: F.xxhash64(w))
    n = F.size(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"))
    rows = F.arrays_zip(
        F.slice(hashed, 1, F.greatest(n - 2, F.lit(1))).alias("a"),
        F.slice(hashed, 2, F.greatest(n - 2, F.lit(1))).alias("b"),
        F.slice(hashed, 3, F.greatest(n - 2, F.lit(1))).alias("c"),
    )
    return F.array_min(F.transform(rows, lambda r: F.xxhash64(r)))


def features(word: str) -> list[str]:
    """What can speak for a label in a word: itself and its beginnings."""
    return [word, *("^" + word[:k] for k in range(4, min(8, len(word) + 1)))]


@dataclass
class Scorer:
    """A letter model, weights of word features and a bias."""

    letters: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0

    def make(self) -> Callable[[list[str]], list[float]]:
        restorer, weights = Restorer(self.letters), self.weights

        def hits(words: Iterable[str]) -> tuple[str, ...]:
            return tuple(f for w in words for f in features(w) if f in weights)

        # From a word as it stands straight to the features of both its readings that have a weight.
        recent = Recent(lambda raw: hits(restorer.forms(raw)))

        def score(texts: list[str]) -> list[float]:
            out = []
            for x in texts:
                raw, behind = restorer.split(x)
                found = recent.all_of(raw)
                if behind:
                    found.update(hits(behind))
                total = self.bias + sum(weights[f] for f in sorted(found))
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))
            return out

        return score


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most_documents: int = 12_000,
    most_features: int = 20_000,
    least_documents: int = 5,
    seed: int = 11,
) -> Scorer:
    """A scorer learnt from `labels` (doc_id, label): the caller leaves out what is held back.

    The letter model counts all texts. Labels come from at most
    `most_documents` documents, chosen by hash, of near-copies mostly one.
    Their word features are
    counted by label in Spark; the at most `most_features` ones that lean most
    to label 1 get weights by logistic regression over the same documents.
    Without labels of both kinds every score is near 0.
    """
    letters = letter_model((r["code"], r["n"]) for r in trigram_counts(docs, text).collect())
    chosen = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(doc_id)
        .agg(F.max(F.col(label).cast("int")).alias("__label"))
        .orderBy(seeded(doc_id, seed=seed), doc_id)
        .limit(most_documents)
    )
    # At most most_documents rows of two numbers.
    known = (
        docs.select(doc_id, text)
        .join(F.broadcast(chosen), doc_id)
        .select(text, "__label", copy_key(text).alias("__key"))
        .dropDuplicates(["__key", "__label"])
        .select(text, "__label")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters)
        seen = {0: Counter(), 1: Counter()}
        documents_of = Counter()
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                documents_of[y] += 1
                seen[y].update({f for w in restorer.words(x or "") for f in features(w)})
        names = list(seen[0].keys() | seen[1].keys())
        for low in range(0, len(names), 50_000):
            part = names[low : low + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([seen[1][f] for f in part]), pa.array([seen[0][f] for f in part])],
                names=["feature", "with_label", "without"],
            )
        # The empty feature counts the documents.
        yield pa.RecordBatch.from_arrays(
            [pa.array([""]), pa.array([documents_of[1]]), pa.array([documents_of[0]])],
            names=["feature", "with_label", "without"],
        )

    counted = (
        known.mapInArrow(count, "feature string, with_label bigint, without bigint")
        .groupBy("feature")
        .agg(F.sum("with_label").alias("with_label"), F.sum("without").alias("without"))
        .filter(F.col("with_label") >= F.when(F.col("feature") == "", 0).otherwise(least_documents))
        .orderBy((F.col("with_label") / (F.col("without") + 1)).desc(), "feature")
    )
    totals = counted.filter("feature = ''").first()
    if totals is None or not totals["with_label"] or not totals["without"]:
        return Scorer(letters)
    usual = totals["with_label"] / totals["without"]
    leaning = counted.filter((F.col("feature") != "") & (F.col("with_label") > 3 * usual * (F.col("without") + 1)))
    names = [r["feature"] for r in leaning.limit(most_features).collect()]
    index = {f: i for i, f in enumerate(names)}

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters)
        for batch in batches:
            found = [
                sorted({index[f] for w in restorer.words(x or "") for f in features(w) if f in index})
                for x in batch.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["found", "label"]
            )

    # At most most_documents rows of short lists; copies of the same row are counted.
    rows = (
        known.mapInArrow(hits, "found array<int>, label int")
        .groupBy("found", "label")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("found", "label")
        .collect()
    )
    weights, bias = logistic([r["found"] for r in rows], [r["label"] for r in rows], [r["n"] for r in rows], len(names))
    return Scorer(letters, {f: float(w) for f, w in zip(names, weights, strict=True) if abs(w) > 1e-3}, bias)


def logistic(rows: list[list[int]], labels: list[int], counts: list[int], width: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on sparse rows of features that are there or not."""
    at = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    columns = np.array([i for x in rows for i in x], dtype=np.int64)
    y = np.array(labels, dtype=float)
    n = np.array(counts, dtype=float)
    # The rarer label weighs more, by the root of how much rarer it is: few clear words are enough then.
    n = np.where(y > 0, n * math.sqrt(max(n @ (1 - y), 1) / max(n @ y, 1)), n)
    weights, bias = np.zeros(width), math.log((n @ y + 1) / (n @ (1 - y) + 1))
    past, past_bias = np.full(width, 1e-6), 1e-6
    for _ in range(600):
        total = bias + np.bincount(at, weights[columns], minlength=len(rows))
        gap = n * (y - 1 / (1 + np.exp(-np.clip(total, -30, 30))))
        slope = np.bincount(columns, gap[at], minlength=width) - 0.05 * weights
        past += slope * slope
        weights += 1.0 * slope / np.sqrt(past)
        past_bias += gap.sum() ** 2
        bias += 1.0 * gap.sum() / math.sqrt(past_bias)
    return weights, float(bias)


def score(docs: DataFrame, scorer: Scorer, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with a score from 0 to 1 of each whole text; null and empty texts get the bias alone.

    Rows are scored one by one, so repeated rows get equal scores; a column
    that has the score's name is replaced.
    """

    def make():
        of = scorer.make()
        return lambda texts: {name: of(texts)}

    return annotate(docs, make, f"`{name}` double", text)


def learnt(spark: SparkSession, folder: str, docs: DataFrame) -> Scorer:
    """A scorer from the labels of documents that are not held out."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(crc_mod("doc_id", 5) != 0)
    return fit(docs, labels)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return score(docs, learnt(spark, folder, docs)).select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
