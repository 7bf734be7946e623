"""Operator 13: collocations from counts of truncated suffix subtrees, built apart for groups of word prefixes."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm.common import documents, shared_folder, written

#: Words of the longest phrase: the depth at which suffixes are cut.
DEPTH = 5
#: Suffixes of one group of prefixes at most, counted before equal ones are added up.
BUDGET = 400_000
#: Frequent words, or frequent prefixes of one length, that tasks are told at most. Were there more, all phrases
#: are counted one by one.
MOST_LISTED = 500_000
#: Bits of the filter of frequent words that tasks get at most: 8 MB.
MOST_FILTER_BITS = 1 << 26
#: Bytes of text that a task splits into words at a time.
CHUNK = 4_000_000
#: Parts of a language that are ranked apart before their first rows are ranked together.
RANK_PARTS = 64

# Upper case falls and all ends of pieces become full stops, which no word can hold.
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9
)


def _number(lang: bytes, prefix: bytes) -> int:
    return zlib.crc32(lang + b"\0" + prefix)


def _number_of(lang: str, prefix: str) -> Column:
    """The same number by Spark."""
    return F.crc32(F.concat(F.col(lang), F.lit("\0"), F.col(prefix)).cast("binary"))


@dataclass
class Prefixes:
    """What a task has to know of the vertical partition."""

    #: One entry a length from 1 on: the frequent prefixes by language.
    listed: list[dict[bytes, set[bytes]]] = field(default_factory=list)
    #: Number of groups by language.
    groups: dict[bytes, int] = field(default_factory=dict)
    #: Bits of the words that are frequent enough to be in a phrase, hashed; a few others look so too.
    alive: bytes | None = None

    def of(self, lang: bytes, length: int) -> set[bytes]:
        return self.listed[length - 1].get(lang, set()) if length <= len(self.listed) else set()


def _segments(blob: bytes) -> Iterator[tuple[bytes, int]]:
    """Folded text in parts of about CHUNK bytes, with the number of words at the end that only complete phrases.

    Cuts are at ends of pieces; a longer piece is cut at a blank, and the next
    words follow the cut.
    """
    low = 0
    while len(blob) - low > CHUNK:
        cut = blob.rfind(b".", low, low + CHUNK)
        if cut >= 0:
            yield blob[low:cut], 0
            low = cut + 1
            continue
        cut = max(blob.rfind(b" ", low + 1, low + CHUNK), blob.rfind(b"\t", low + 1, low + CHUNK))
        if cut < 0:
            ends = [x for x in (blob.find(c, low + CHUNK) for c in (b".", b" ", b"\t")) if x >= 0]
            cut = min(ends, default=len(blob))
        # The piece may end within the words that follow.
        further = []
        place = cut
        while len(further) < DEPTH - 1 and place < len(blob):
            end = place
            while end < len(blob) and blob[end] in b" \t":
                end += 1
            if end == len(blob) or blob[end] == 46:
                break
            place = min([x for x in (blob.find(c, end) for c in (b".", b" ", b"\t")) if x >= 0], default=len(blob))
            further.append(blob[end:place])
        yield b" ".join([blob[low:cut], *further]), len(further)
        low = cut
    yield blob[low:], 0


class Words:
    """The words of one segment as numbers of a dictionary, 0 where no phrase goes on."""

    def __init__(self, segment: bytes, extra: int, lang: bytes, prefixes: Prefixes) -> None:
        words = segment.replace(b".", b" . ").split()
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.dictionary = coded.dictionary
        self.lang = lang
        self.prefixes = prefixes
        self.values = self.dictionary.to_pylist()
        usable = np.array([w != b"." for w in self.values], dtype=bool)
        if prefixes.alive is not None:
            bits = len(prefixes.alive) * 8
            at = np.array([_number(lang, w) for w in self.values], dtype=np.int64) % bits
            table = np.frombuffer(prefixes.alive, dtype=np.uint8)
            usable &= (table[at >> 3] >> (at & 7)).astype(np.uint8) & 1 == 1
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.codes = np.where(usable[codes], codes + 1, 0) if len(codes) else codes
        self.starts = len(codes) - extra

    def pairs(self) -> np.ndarray:
        """Places from which a phrase of two words or more goes on."""
        codes = np.concatenate([self.codes, [0]])
        return np.flatnonzero((codes[: self.starts] > 0) & (codes[1 : self.starts + 1] > 0))

    def windows(self, length: int, at: np.ndarray) -> list[np.ndarray]:
        """The words from each place on, 0 behind the end of a phrase."""
        padded = np.concatenate([self.codes, np.zeros(length, dtype=np.int64)])
        out = [padded[at]]
        for k in range(1, length):
            out.append(np.where(out[-1] > 0, padded[at + k], 0))
        return out

    def counted(self, length: int, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The different windows from these places, and how often each is there."""
        columns = self.windows(length, at)
        keys = {}
        for k in range(0, length, 2):
            keys[f"k{k}"] = columns[k] << 32 | columns[k + 1] if k + 1 < length else columns[k]
        groups = pa.table(keys).group_by(list(keys), use_threads=False).aggregate([([], "count_all")])
        out = []
        for k in range(0, length, 2):
            key = groups[f"k{k}"].to_numpy()
            out += [key >> 32, key & 0xFFFFFFFF] if k + 1 < length else [key]
        return out, groups["count_all"].to_numpy()

    def phrases(self, columns: list[np.ndarray]) -> pa.Array:
        parts = [self.dictionary.take(pa.array(c - 1, pa.int64(), mask=c == 0)) for c in columns]
        if len(parts) == 1:
            return parts[0]
        return pc.binary_join_element_wise(*parts, b" ", null_handling="skip")

    def by_word(self, of: Callable[[bytes], int], kind: type) -> np.ndarray:
        """A number for each code: 0 for the end of a phrase, else what `of` gives for its word."""
        return np.array([0, *map(of, self.values)], dtype=kind)


def _by_segment(
    work: Callable[[Words], Iterator[dict]], prefixes: Prefixes, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function over (lang, text) that hands the texts of each language to `work` in segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for segment, extra in _segments(b".".join(texts).translate(_FOLD)):
                    for out in work(Words(segment, extra, lang, prefixes)):
                        out["lang"] = pa.array([lang.decode()] * len(out["n"]))
                        yield pa.RecordBatch.from_arrays([out[f.name].cast(f.type) for f in schema], schema=schema)
            held.clear()

        for batch in batches:
            langs = batch.column(0).cast(pa.binary()).to_pylist()
            for lang, text in zip(langs, batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if text:
                    held.setdefault(lang, []).append(text)
                    size += len(text)
                    if size >= CHUNK:
                        yield from flush()
                        size = 0
        yield from flush()

    return run


_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
#: One row for a group and segment: suffixes by line, compressed, with the length of the prefix that led each here and how often it is there.
_BLOCKS = pa.schema(
    [
        ("lang", pa.string()),
        ("part", pa.int32()),
        ("suffixes", pa.binary()),
        ("depths", pa.list_(pa.int8())),
        ("n", pa.list_(pa.int32())),
    ]
)


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """`lang`, `phrase`, `n`: occurrences of every word; the empty phrase counts all words."""

    def work(words: Words) -> Iterator[dict]:
        at = np.flatnonzero(words.codes[: words.starts])
        counts = np.bincount(words.codes[at], minlength=len(words.values) + 1)[1:]
        there = np.flatnonzero(counts)
        yield {"phrase": words.dictionary.take(pa.array(there)), "n": pa.array(counts[there])}
        yield {"phrase": pa.array([b""]), "n": pa.array([len(at)])}

    counted = texts.mapInArrow(_by_segment(work, Prefixes(), _COUNTS), "lang string, phrase string, n bigint")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def run_counts(texts: DataFrame, prefixes: Prefixes, every: bool = False) -> DataFrame:
    """`lang`, `phrase`, `n` of all runs of two to DEPTH frequent words; with `every`, of words that may be in a phrase.

    A prefix is at most as frequent as each of its words, so these runs hold all frequent prefixes.
    """

    def work(words: Words) -> Iterator[dict]:
        if not every:
            listed = prefixes.of(words.lang, 1)
            words.codes = np.where(words.by_word(listed.__contains__, bool)[words.codes], words.codes, 0)
        at = words.pairs()
        for length in range(2, DEPTH + 1):
            if not len(at):
                return
            columns, n = words.counted(length, at)
            keep = columns[-1] > 0
            if keep.any():
                yield {"phrase": words.phrases([c[keep] for c in columns]), "n": pa.array(n[keep])}

    counted = texts.mapInArrow(_by_segment(work, prefixes, _COUNTS), "lang string, phrase string, n bigint")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def suffix_blocks(texts: DataFrame, prefixes: Prefixes) -> DataFrame:
    """Suffixes of two to DEPTH words by the group of their shortest prefix that is not frequent.

    Equal suffixes of a segment are added up, and those of one group are one
    row. Suffixes whose prefixes are all frequent are left out: every count
    along them is known.
    """

    def work(words: Words) -> Iterator[dict]:
        at = words.pairs()
        if not len(at):
            return
        columns, n = words.counted(DEPTH, at)
        parts = prefixes.groups.get(words.lang, 1)
        listed = prefixes.of(words.lang, 1)
        part = words.by_word(lambda w: -1 if w in listed else _number(words.lang, w) % parts, np.int64)[columns[0]]
        depth = np.ones(len(n), dtype=np.int8)
        open_ = np.flatnonzero(part < 0)
        for k in range(2, DEPTH + 1):
            open_ = open_[columns[k - 1][open_] > 0]
            if not len(open_):
                break
            coded = words.phrases([c[open_] for c in columns[:k]]).dictionary_encode()
            listed = prefixes.of(words.lang, k)
            number = [-1 if p in listed else _number(words.lang, p) % parts for p in coded.dictionary.to_pylist()]
            part[open_] = np.array(number, dtype=np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
            depth[open_] = k
            open_ = open_[part[open_] < 0]
        keep = np.flatnonzero(part >= 0)
        if not len(keep):
            return
        # In order of their words, so that lines of a group resemble the ones before.
        keep = keep[np.lexsort((columns[1][keep] << 32 | columns[2][keep], part[keep] << 32 | columns[0][keep]))]
        part = part[keep]
        begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        offsets = pa.array(np.append(begins, len(part)), pa.int32())
        lines = pa.ListArray.from_arrays(offsets, words.phrases([c[keep] for c in columns]))
        yield {
            "part": pa.array(part[begins]),
            "suffixes": pa.array([zlib.compress(x, 1) for x in pc.binary_join(lines, b"\n").to_pylist()]),
            "depths": pa.ListArray.from_arrays(offsets, pa.array(depth[keep])),
            "n": pa.ListArray.from_arrays(offsets, pa.array(n[keep].astype(np.int32))),
        }

    schema = "lang string, part int, suffixes binary, depths array<tinyint>, n array<int>"
    return texts.mapInArrow(_by_segment(work, prefixes, _BLOCKS), schema)


def subtree_counts(suffix: pa.Array, depth: np.ndarray, n: np.ndarray, least: int) -> tuple[pa.Array, np.ndarray]:
    """Phrases of two words or more with their counts, from the subtree of these suffixes.

    Sorted suffixes are the subtree's leaves from left to right: a node is a run
    of leaves with the same first words, and its count the total of the run.
    Nodes above the prefix that led a suffix here are not complete and left out.
    """
    lists = pc.split_pattern(suffix, " ")
    coded = lists.flatten().dictionary_encode()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    table = np.zeros((len(lengths), DEPTH), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    table[row, np.arange(len(codes)) - np.repeat(ends - lengths, lengths)] = codes
    order = np.lexsort((table[:, 4], table[:, 2] << 32 | table[:, 3], table[:, 0] << 32 | table[:, 1]))
    table, depth, n = table[order], depth[order], n[order]
    begins = np.ones(len(table), dtype=bool)
    begins[1:] = table[1:, 0] != table[:-1, 0]
    phrases, counts = [], []
    for k in range(2, DEPTH + 1):
        begins[1:] |= table[1:, k - 1] != table[:-1, k - 1]
        first = np.flatnonzero(begins)
        total = np.add.reduceat(n, first)
        keep = (total >= least) & (table[first, k - 1] > 0) & (depth[first] <= k)
        if keep.any():
            parts = [coded.dictionary.take(pa.array(table[first[keep], j] - 1)) for j in range(k)]
            phrases.append(pc.binary_join_element_wise(*parts, " "))
            counts.append(total[keep])
    if not phrases:
        return pa.array([], pa.string()), np.zeros(0, dtype=np.int64)
    return pa.concat_arrays(phrases), np.concatenate(counts)


def _subtrees(least: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        lines = pc.split_pattern(pa.array(["\n".join(zlib.decompress(x).decode() for x in table["suffixes"].to_pylist())]), "\n").flatten()
        flat = lambda name: pc.list_flatten(table[name]).to_numpy()
        phrases, counts = subtree_counts(lines, flat("depths"), flat("n").astype(np.int64), least)
        langs = pa.array([key[0].as_py()] * len(counts), pa.string())
        return pa.Table.from_arrays([langs, phrases.cast(pa.string()), pa.array(counts, pa.int64())], schema=_COUNTS)

    return run


def _group_numbers(words: DataFrame, light: DataFrame, budget: int) -> dict[bytes, int]:
    """Groups by language, as many as it takes that none has more than `budget` suffixes.

    `light` are the words that lead to a group themselves; groups get longer
    prefixes besides, and all of them together are at most half of the budgets.
    They are dealt by hash; were a group too large, there are twice as many.
    `words` has the number of all words of each language: one row of it a
    language is collected.
    """
    totals = {r["lang"]: r["n"] for r in words.filter("phrase = ''").collect()}
    groups = {lang: max(1, math.ceil(2 * n / budget)) for lang, n in totals.items()}
    for _ in range(8 if groups else 0):
        number = F.create_map(*[x for lang, g in groups.items() for x in (F.lit(lang), F.lit(g))])
        dealt = light.select("lang", "n", F.pmod(_number_of("lang", "phrase"), number[F.col("lang")]).alias("part"))
        full = dealt.groupBy("lang", "part").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.max("n").alias("n"))
        over = [r["lang"] for r in full.filter(F.col("n") > budget).collect()]
        if not over:
            break
        groups |= {lang: 2 * groups[lang] for lang in over}
    return {lang.encode(): g for lang, g in groups.items()}


def _filter_of(words: DataFrame) -> bytes:
    """A bitmap of hashed frequent words, at least 16 bits a word as long as it stays within the bound."""
    bits = 1 << 15
    there = words.count()
    while bits < min(16 * there, MOST_FILTER_BITS):
        bits *= 2
    at = F.pmod(_number_of("lang", "phrase"), F.lit(bits))
    maps = (
        words.select(F.floor(at / 32_768).alias("bucket"), F.pmod(at, F.lit(32_768)).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    out = bytearray(bits // 8)
    # At most MOST_FILTER_BITS / 32768 rows of 4 KB.
    for r in maps.collect():
        out[r["bucket"] * 4_096 : (r["bucket"] + 1) * 4_096] = r["bits"]
    return bytes(out)


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, budget: int = BUDGET
) -> DataFrame:
    """`lang`, `phrase`, `n` of every phrase of one to five words with n >= `least`, and of the empty phrase (all words).

    Vertical partitioning: words are counted first. Those of more than an eighth
    of `budget` are frequent: they do not lead a group, the first of their longer
    prefixes that is not frequent does. Which of these are frequent follows from
    counting runs of frequent words. Prefixes that lead are dealt to groups of at
    most about `budget` suffixes, so one task holds one group, whatever the
    frequency of a word, and builds its subtree, cut at five words. A word below
    `least` ends a suffix, as it is in no phrase; which words these are, tasks
    mostly know from a filter of bounded size.
    """
    texts = _texts(docs, text, lang)
    folder = shared_folder(docs.sparkSession, "phrases")
    limit = max(1, budget // 8)
    words = written(
        word_counts(texts).filter((F.col("n") >= least) | (F.col("phrase") == "")), f"{folder}/words"
    )
    alive = words.filter("phrase != ''")
    prefixes = Prefixes(alive=_filter_of(alive))
    frequent = alive.filter(F.col("n") > limit)
    listed = frequent.count() <= MOST_LISTED
    if listed:
        prefixes.listed.append(_by_lang(frequent))
        runs = written(run_counts(texts, prefixes).filter(F.col("n") > limit), f"{folder}/runs")
        size = F.size(F.split("phrase", " "))
        by_length = {r["k"]: r["count"] for r in runs.groupBy(size.alias("k")).count().collect()}
        listed = max(by_length.values(), default=0) <= MOST_LISTED
    if not listed:
        every = written(run_counts(texts, prefixes, every=True).filter(F.col("n") >= least), f"{folder}/every")
        return words.unionByName(every)
    for k in range(2, max(by_length, default=1) + 1):
        prefixes.listed.append(_by_lang(runs.filter(size == k)))
    prefixes.groups = _group_numbers(words, alive.filter(F.col("n") <= limit), budget)
    blocks = suffix_blocks(texts, prefixes).groupBy("lang", "part")
    below = written(blocks.applyInArrow(_subtrees(least), "lang string, phrase string, n bigint"), f"{folder}/subtrees")
    return words.unionByName(runs.filter(F.col("n") >= least)).unionByName(below)


def _by_lang(phrases: DataFrame) -> dict[bytes, set[bytes]]:
    """Phrases by language, on the driver: the caller has counted them."""
    out: dict[bytes, set[bytes]] = {}
    for r in phrases.toLocalIterator():
        out.setdefault(r["lang"].encode(), set()).add(r["phrase"].encode())
    return out


def scored(counts: DataFrame) -> DataFrame:
    """Candidates of two words or more at their lowest-scoring cut: lang, phrase, a, l, r, n, score."""
    size = F.size(F.split("phrase", " "))
    own = counts.filter("phrase != ''").withColumn("size", size)
    cuts = own.filter("size > 1").select(
        "lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    cuts = cuts.select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    all_words = counts.filter("phrase = ''").select("lang", F.col("n"))
    lower = own.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    upper = own.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    joined = cuts.join(lower, ["lang", "first"]).join(upper, ["lang", "rest"]).join(all_words, "lang")
    big = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    # Exact: whole decimals of up to 38 digits, and a division that gives the whole part.
    scores = joined.withColumns(
        {"over": (big["a"] * big["n"]).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)"), "under": big["l"] * big["r"]}
    ).withColumn("score", F.expr("over div under"))
    best = F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")
    return scores.groupBy("lang", "phrase").agg(best).select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def closed(candidates: DataFrame) -> DataFrame:
    """Candidates without those that stand inside a longer one as often as anywhere.

    A longer phrase is at most as frequent as one inside it, and so is every
    phrase between them: if the counts are equal, a candidate of one word more
    has that count too. So each candidate is compared with its two parts of one word less.
    """
    size = F.size(F.split("phrase", " "))
    longer = candidates.select("a", "lang", "phrase", (size - 1).alias("k")).filter("k > 1")
    inside = longer.select(
        "lang",
        "a",
        F.explode(
            F.array(F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', -k)"))
        ).alias("phrase"),
    )
    return candidates.join(inside, ["lang", "phrase", "a"], "left_anti")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    top: int = 2_000,
    budget: int = BUDGET,
) -> DataFrame:
    """The first `top` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    A null text has no words, a null language is `und`; all columns but these
    two are ignored. Ties in score go to the more frequent phrase, then to the
    smaller one by bytes, so ranks are the same in every run. Repeated rows
    count each time. Without a phrase of `least` occurrences a language has no rows.
    """
    folder = shared_folder(docs.sparkSession, "collocations")
    counts = written(phrase_counts(docs, text, lang, least, budget), f"{folder}/counts")
    left = closed(written(scored(counts), f"{folder}/scored"))
    order = "ORDER BY score DESC, a DESC, phrase"
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = left.withColumn("part", part).withColumn("in_part", F.expr(f"row_number() OVER (PARTITION BY lang, part {order})"))
    ranked = first.filter(F.col("in_part") <= top).withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order})"))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(documents(spark, folder))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
phrases AS (
  SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split), range(1, 6) x(k)
  WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, size, phrase, count(*) AS c FROM phrases GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
cuts AS (
  SELECT lang, phrase, size, c AS a, k,
         array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS tail
  FROM f, range(1, 5) x(k) WHERE k < size),
scores AS (
  SELECT cuts.lang, cuts.phrase, cuts.size, a, p.c AS l, q.c AS r, n,
         ((1000::HUGEINT * a * n) // (p.c::HUGEINT * q.c))::BIGINT AS score, k
  FROM cuts
  JOIN f p ON p.lang = cuts.lang AND p.phrase = head
  JOIN f q ON q.lang = cuts.lang AND q.phrase = tail
  JOIN total ON total.lang = cuts.lang),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT DISTINCT b.lang, array_to_string(string_split(b.phrase, ' ')[i:i + m - 1], ' ') AS phrase, b.a AS longer
  FROM best b, range(2, 5) x(m), range(1, 5) y(i) WHERE m < b.size AND i + m - 1 <= b.size),
left_ AS (
  SELECT * FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.longer >= 100 * b.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
