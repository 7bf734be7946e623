"""Operator 8: stupid-backoff scores of documents from n-gram count tables partitioned by hash."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm.common import documents, shared_folder, written
from tapewarden.llm.neardup import mixed

ALPHA = 0.4
#: Pairs of words are taken as seen from so many occurrences on: one alone is the scored text itself.
LEAST_COUNT = 2
#: Words with more than this share of all are scored without a join: at most 1 / share of them.
COMMON_SHARE = 1e-6
#: Contexts with more than this share are spread by the word that follows: at most 1 / share of them.
HOT_SHARE = 1e-3
#: Pairs in a hash part of the count table, about: what one task counts at once.
PART = 800_000
#: Words of a chunk, whose pairs are packed together, about.
CHUNK = 1_500_000
CACHED_WORDS = 300_000
#: Binary columns of packed pairs.
PACKED = ("contexts", "runs", "words", "rare", "befores", "rare_befores", "docs", "counts")
#: Stands for the lack of a context before the first word of a document.
START = np.uint64(0)


class Hasher:
    """64-bit hashes of words, never 0."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w) or 1
        return np.array([known[w] for w in words], dtype=np.uint64)


def split(text: str | None) -> list[bytes]:
    """Words of a text: runs of bytes other than ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """`word, n, followed`: how often each word (its hash) occurs, and how often with a word after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        n: Counter = Counter()
        last: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(n)
            for low in range(0, len(words), 100_000):
                part = words[low : low + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hasher(part).view(np.int64)),
                        pa.array([n[w] for w in part], pa.int64()),
                        pa.array([n[w] - last[w] for w in part], pa.int64()),
                    ],
                    names=["word", "n", "followed"],
                )
            n.clear()
            last.clear()

        for batch in batches:
            for x in batch.column(0).to_pylist():
                words = split(x)
                if words:
                    n.update(words)
                    last[words[-1]] += 1
            if len(n) > CACHED_WORDS:
                yield from flush()
        yield from flush()

    counted = docs.select(text).mapInArrow(run, "word bigint, n bigint, followed bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("followed").alias("followed"))


def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key in a sorted table, 0 where it has none."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def joined(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """One hash of two words in a row."""
    return mixed(mixed(u) ^ v)


def before(doc: np.ndarray, w: np.ndarray, by: int) -> np.ndarray:
    """For each word the one `by` places before it in its document, START where there is none."""
    out = np.full(len(w), START, dtype=np.uint64)
    out[by:] = np.where(doc[by:] == doc[:-by], w[:-by], START)
    return out


def hot_pairs(docs: DataFrame, hot: np.ndarray, text: str) -> DataFrame:
    """`pair, n`: how often two hot words in a row have a word after them; no more rows than hot words squared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        n: Counter = Counter()
        for batch in batches:
            hashes = [hasher(split(x)) for x in batch.column(0).to_pylist()]
            w = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
            doc = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
            known = np.isin(w, hot)
            at = np.flatnonzero(known[:-2] & known[1:-1] & (doc[:-2] == doc[2:]))
            pairs, times = np.unique(joined(w[at], w[at + 1]), return_counts=True)
            for pair, k in zip(pairs.view(np.int64).tolist(), times.tolist(), strict=True):
                n[pair] += k
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())], names=["pair", "n"])

    return docs.select(text).mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def coded(common: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Words as places in the sorted table of common ones, counted from 1, or 0."""
    return lookup(common, np.arange(1, len(common) + 1), w).astype("<u4")


def planes(code: np.ndarray) -> bytes:
    """The three low bytes of codes, byte after byte: high ones are mostly 0 and take next to nothing."""
    return code.view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes()


def decoded(common: np.ndarray, packed: list[bytes], rare: list[bytes]) -> np.ndarray:
    """The hashes of words from `planes` of their codes and the hashes of those without one."""
    code = np.zeros((sum(len(x) for x in packed) // 3, 4), dtype=np.uint8)
    low = 0
    for x in packed:
        high = low + len(x) // 3
        code[low:high, :3] = np.frombuffer(x, dtype=np.uint8).reshape(3, -1).T
        low = high
    code = code.view("<u4").ravel()
    out = np.empty(len(code), dtype=np.uint64)
    known = code > 0
    out[known] = common[code[known] - 1]
    out[~known] = np.frombuffer(b"".join(rare), dtype="<u8")
    return out


def packed_pairs(
    docs: DataFrame,
    hot: np.ndarray,
    parts: int,
    doc_id: str,
    text: str,
    order_n: int = 2,
    hot_two: np.ndarray | None = None,
    common: np.ndarray | None = None,
) -> DataFrame:
    """Pairs of words (for order 3, with the word before them) of each document, packed by hash part.

    Rows: `part`, `base` (number of the chunk's first document), and bytes of
    `contexts` with their `runs`, then for each pair `words`, `befores` (order
    3), `docs` (place in the chunk) and `counts`. Words in the sorted hashes
    `common` go by three bytes of their place there, others by their hash in
    `rare` and `rare_befores`. A pair or triple is there once
    for each document that has it, so none has more entries than there are
    documents. Rows without `contexts` stand for the documents: `base`,
    `doc_id`, `n_words`.

    Pairs and triples go by the context next to their last word, so what is
    counted for one context is in one part. Those of a hot context go by the
    last word (order 2), or by the word before the context and, if these two
    are hot too, by the last word also. First words need no table: they
    go by document.
    """
    kind = docs.schema[doc_id].dataType
    common = np.zeros(0, dtype=np.uint64) if common is None else common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        number = task << 36
        schema = None

        def packed(ids: pa.Array, sizes: list[int], hashes: list[np.ndarray], base: int) -> Iterator[pa.RecordBatch]:
            n = len(sizes)
            none = pa.nulls(n, pa.binary())
            spread = pa.array((np.arange(base, base + n) % parts).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [spread, pa.array(np.arange(base, base + n)), ids, pa.array(sizes, pa.int64()), *[none] * 8],
                schema=schema,
            )
            w = np.concatenate(hashes)
            if not len(w):
                return
            doc = np.repeat(np.arange(n, dtype=np.uint64), sizes)
            v = before(doc, w, 1)
            u = before(doc, w, 2) if order_n > 2 else np.zeros_like(w)
            is_hot = np.isin(v, hot)
            if order_n > 2:
                two = joined(u, v)
                spread_by = np.where(u == START, v ^ mixed(doc), two)
                spread_by = np.where(np.isin(two, hot_two) & (u != START), two ^ mixed(w), spread_by)
            else:
                spread_by = v ^ mixed(w)
            spread_by = np.where(v == START, mixed(doc + np.uint64(base)), np.where(is_hot, spread_by, v))
            part = (mixed(spread_by) % np.uint64(parts)).astype(np.uint64)
            # Order by part, context, word and document; hashes of context and word take what bits are left.
            key = part << np.uint64(48) | (mixed(v) >> np.uint64(40)) << np.uint64(24) | (mixed(w ^ v) >> np.uint64(40))
            order = np.lexsort((mixed(u) & ~np.uint64(0xFFFF) | doc if order_n > 2 else doc, key))
            part, v, w, u, doc = part[order], v[order], w[order], u[order], doc[order]
            new = np.concatenate([[True], (part[1:] != part[:-1]) | (v[1:] != v[:-1]) | (w[1:] != w[:-1]) | (u[1:] != u[:-1]) | (doc[1:] != doc[:-1])])
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(v))).astype(np.uint32)
            part, v, w, u, doc = part[at], v[at], w[at], u[at], doc[at].astype(np.uint16)
            heads = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (part[1:] != part[:-1])]))
            runs = np.diff(np.append(heads, len(v))).astype(np.uint32)
            code = coded(common, w)
            code_before = coded(common, u) if order_n > 2 else code
            rows: list[list] = [[] for _ in range(9)]
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                a, b = np.searchsorted(heads, [low, high])
                here = slice(low, high)
                values = [int(part[low]), v[heads[a:b]].tobytes(), runs[a:b].tobytes()]
                values += [planes(code[here]), w[here][code[here] == 0].tobytes()]
                values += [planes(code_before[here]), u[here][code_before[here] == 0].tobytes()] if order_n > 2 else [None, None]
                values += [doc[here].tobytes(), counts[here].tobytes()]
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            m = len(rows[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32()), pa.array([base] * m, pa.int64()), pa.nulls(m, ids.type), pa.nulls(m, pa.int64())]
                + [pa.array(x, pa.binary()) for x in rows[1:]],
                schema=schema,
            )

        for batch in batches:
            schema = pa.schema(
                [("part", pa.int32()), ("base", pa.int64()), ("doc_id", batch.column(0).type), ("n_words", pa.int64())]
                + [(x, pa.binary()) for x in PACKED]
            )
            texts = batch.column(1).to_pylist()
            low = 0
            while low < len(texts):
                high, size, hashes = low, 0, []
                while high < len(texts) and high - low < 60_000 and size < CHUNK:
                    hashes.append(hasher(split(texts[high])))
                    size += len(hashes[-1])
                    high += 1
                yield from packed(batch.column(0).slice(low, high - low), [len(h) for h in hashes], hashes, number)
                number += high - low
                low = high

    fields = f"part int, base bigint, doc_id {kind.simpleString()}, n_words bigint, " + ", ".join(f"{x} binary" for x in PACKED)
    return docs.select(doc_id, text).mapInArrow(run, fields)


def scored_part(
    group: pa.Table,
    common: tuple[np.ndarray, np.ndarray],
    hot: tuple[np.ndarray, np.ndarray],
    total: int,
    alpha: float,
    least: int,
    order_n: int = 2,
    hot_two: tuple[np.ndarray, np.ndarray] | None = None,
) -> pa.Table:
    """Scores of the pairs or triples of one hash part, summed by document.

    Rows: `row`, `score`, `seen`, `seen_3` for what is known here; `row`, `word`,
    `n`, `steps` for those that back off, by so many steps, to a word whose
    count is in another table; and the documents' own rows as they came. For
    order 3 and hot contexts, whose pairs lie in several parts: `context`,
    `word`, `n` with the part's count of each pair, and with `row` and `steps`
    also for what backs off to such a pair.
    """
    kind = group.schema.field("doc_id").type
    own = group.filter(pa.compute.is_null(group.column("contexts")))
    pairs = group.filter(pa.compute.is_valid(group.column("contexts")))

    def all_of(name: str, dtype: str) -> np.ndarray:
        return np.frombuffer(b"".join(pairs.column(name).to_pylist()), dtype=dtype)

    def words_of(words: str, rare: str) -> np.ndarray:
        return decoded(common[0], pairs.column(words).to_pylist(), pairs.column(rare).to_pylist())

    v = np.repeat(all_of("contexts", "<u8"), all_of("runs", "<u4"))
    w = words_of("words", "rare")
    u = words_of("befores", "rare_befores") if order_n > 2 else np.zeros(len(w), dtype=np.uint64)
    lengths = [len(x) // 2 for x in pairs.column("docs").to_pylist()]
    row = np.repeat(pairs.column("base").to_numpy(), lengths) + all_of("docs", "<u2")
    n = all_of("counts", "<u4").astype(np.int64)
    if order_n > 2:
        order = np.lexsort((u, w, v))
        u = u[order]
    else:
        order = np.lexsort((w, v))
    v, w, row, n = v[order], w[order], row[order], n[order]
    steps = (v != START).astype(np.int64) + (u != START)
    scores = np.zeros(len(v))
    pair_here = triple_here = pair_pending = pending = np.zeros(len(v), dtype=bool)
    hot_counts: tuple[np.ndarray, np.ndarray, np.ndarray] = (v[:0], w[:0], n[:0])
    if len(v):

        def counts(new: np.ndarray) -> np.ndarray:
            return np.add.reduceat(n, np.flatnonzero(new))[np.cumsum(new) - 1]

        new_v = np.concatenate([[True], v[1:] != v[:-1]])
        new = new_v | np.concatenate([[True], w[1:] != w[:-1]])
        pair_counts, context_counts = counts(new), counts(new_v)
        spread = lookup(*hot, v)
        context_counts = np.where(spread > 0, spread, context_counts)
        pair_here = (pair_counts >= least) & (v != START)
        words = lookup(*common, w)
        with np.errstate(divide="ignore"):
            back = np.log(words) - math.log(max(total, 1)) + steps * math.log(alpha)
        pair_scores = np.log(pair_counts) - np.log(context_counts) + (steps - 1) * math.log(alpha)
        if order_n > 2:
            triple_counts = counts(new | np.concatenate([[True], u[1:] != u[:-1]]))
            by_two = np.lexsort((u, v))
            sv, su, sn = v[by_two], u[by_two], n[by_two]
            new_two = np.concatenate([[True], (sv[1:] != sv[:-1]) | (su[1:] != su[:-1])])
            two_counts = np.empty(len(v), dtype=np.int64)
            two_counts[by_two] = np.add.reduceat(sn, np.flatnonzero(new_two))[np.cumsum(new_two) - 1]
            known = lookup(*hot_two, joined(u, v))
            two_counts = np.where((known > 0) & (spread > 0), known, two_counts)
            triple_here = (triple_counts >= least) & (u != START)
            # Pairs of hot contexts are counted in several parts.
            pair_pending = ~triple_here & (spread > 0)
            first = np.flatnonzero(new & (spread > 0))
            hot_counts = v[first], w[first], pair_counts[first]
            pair_here = pair_here & ~triple_here & ~pair_pending
        pending = ~triple_here & ~pair_here & ~pair_pending & (words == 0)
        scores = np.where(pair_here, pair_scores, np.where((words > 0) & ~pair_pending, back, 0.0))
        if order_n > 2:
            scores = np.where(triple_here, np.log(triple_counts) - np.log(two_counts), scores)
        scores = scores * n
    rows, place = np.unique(row, return_inverse=True)

    def summed(what: np.ndarray) -> np.ndarray:
        return np.bincount(place, what, minlength=len(rows))

    seen = summed(np.where(pair_here | triple_here, n, 0)).astype(np.int64)
    seen_3 = summed(np.where(triple_here, n, 0)).astype(np.int64)
    mine = own.num_rows
    sizes = (len(rows), int(pending.sum()), int(pair_pending.sum()), len(hot_counts[0]), mine)

    def column(type_: pa.DataType, *parts) -> pa.ChunkedArray:
        parts = [pa.nulls(k, type_) if x is None else pa.array(x, type_) if isinstance(x, np.ndarray) else x for x, k in zip(parts, sizes, strict=True)]
        return pa.chunked_array(parts, type_)

    def own_of(name: str) -> pa.Array:
        return own.column(name).combine_chunks()

    def signed(x: np.ndarray) -> np.ndarray:
        return x.astype(np.uint64).view(np.int64)

    whole = pa.int64()
    return pa.table(
        {
            "row": column(whole, rows, row[pending], row[pair_pending], None, own_of("base")),
            "score": column(pa.float64(), summed(scores), None, None, None, None),
            "seen": column(whole, seen, None, None, None, None),
            "seen_3": column(whole, seen_3, None, None, None, None),
            "context": column(whole, None, None, signed(v[pair_pending]), signed(hot_counts[0]), None),
            "word": column(whole, None, signed(w[pending]), signed(w[pair_pending]), signed(hot_counts[1]), None),
            "n": column(whole, None, n[pending], n[pair_pending], hot_counts[2], None),
            "steps": column(whole, None, steps[pending], steps[pair_pending], None, None),
            "doc_id": column(kind, None, None, None, None, own_of("doc_id")),
            "n_words": column(whole, None, None, None, None, own_of("n_words")),
        }
    )


def score(
    docs: DataFrame, alpha: float = ALPHA, least: int = LEAST_COUNT, doc_id: str = "doc_id", text: str = "text", order: int = 2
) -> DataFrame:
    """`doc_id, n_words, n_seen, score`: the sum of log stupid-backoff scores of each document's words.

    S(w | v) = c(v w) / c(v .) if the pair v w occurs at least `least` times in
    all texts, else alpha * c(w) / N; the first word has c(w) / N. With `order`
    3, S(w | u v) = c(u v w) / c(u v .) if the triple occurs so often, else
    alpha * S(w | v), and `n_seen_3` counts the words scored by a triple,
    `n_seen` those scored by a triple or pair. Words are runs of characters
    other than ASCII white space, as written.

    Pairs or triples are exploded by document, dealt by the hash of the word
    before the last (further, where it is hot) and joined with the counts of
    their hash part, which the same task makes. Backed-off words are looked up
    in the word table: the common ones, at most 1 / COMMON_SHARE, in each task,
    the others by a join; for order 3, pairs of hot contexts in a pair table.
    A null or empty text has no words and score 0. Repeated rows are scored one
    by one and count like any text.
    """
    if order not in (2, 3):
        raise ValueError(f"order must be 2 or 3, not {order}")
    spark = docs.sparkSession
    folder = shared_folder(spark, "backoff")
    words = written(word_counts(docs, text), f"{folder}/words")
    sums = words.agg(F.sum("n").alias("n"), F.sum("followed").alias("followed")).first()
    total, followed = sums["n"] or 0, sums["followed"] or 0

    def table(rows: DataFrame, key: str, column: str, more_than: float) -> tuple[np.ndarray, np.ndarray]:
        rows = rows.filter(F.col(column) > more_than).select(key, column).toArrow()
        keys = rows.column(key).to_numpy().view(np.uint64)
        by_key = np.argsort(keys)
        return keys[by_key], rows.column(column).to_numpy()[by_key]

    common = table(words, "word", "n", total * COMMON_SHARE)
    hot = table(words, "word", "followed", followed * HOT_SHARE)
    # Two words in a row are hot only if each is.
    hot_two = table(hot_pairs(docs, hot[0], text), "pair", "n", followed * HOT_SHARE) if order > 2 else None
    parts = max(1, min(30_000, -(-total * order // (2 * PART))))
    kind = docs.schema[doc_id].dataType
    scored = written(
        packed_pairs(docs, hot[0], parts, doc_id, text, order, hot_two[0] if hot_two else None, common[0])
        .groupBy("part")
        .applyInArrow(
            lambda group: scored_part(group, common, hot, total, alpha, least, order, hot_two),
            f"row bigint, score double, seen bigint, seen_3 bigint, context bigint, word bigint, n bigint, steps bigint, doc_id {kind.simpleString()}, n_words bigint",
        ),
        f"{folder}/scored",
    )
    late = scored.filter("word IS NOT NULL AND context IS NULL").select("row", "word", F.col("n").alias("times"), "steps")
    known = scored.filter("word IS NULL").select("row", "score", "seen", "seen_3", "doc_id", "n_words")

    def scores(rows: DataFrame, value: Column, seen: Column) -> DataFrame:
        return rows.select(
            "row",
            value.alias("score"),
            seen.cast("bigint").alias("seen"),
            F.lit(0).cast("bigint").alias("seen_3"),
            F.lit(None).cast(kind).alias("doc_id"),
            F.lit(None).cast("bigint").alias("n_words"),
        )

    if order > 2:
        pairs = (
            scored.filter("row IS NULL").groupBy("context", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        )
        # At most 1 / HOT_SHARE rows.
        contexts = words.filter(F.col("followed") > followed * HOT_SHARE).select(F.col("word").alias("context"), "followed")
        waiting = (
            scored.filter("row IS NOT NULL AND context IS NOT NULL")
            .select("row", "context", "word", F.col("n").alias("times"), "steps")
            .join(pairs, ["context", "word"], "left")
        )
        late = late.unionByName(waiting.filter("n IS NULL").select("row", "word", "times", "steps"))
        paired = waiting.filter("n IS NOT NULL").join(F.broadcast(contexts), "context")
        value = F.col("times") * (F.log("n") - F.log("followed") + (F.col("steps") - 1) * math.log(alpha))
        known = known.unionByName(scores(paired, value, F.col("times")))
    value = F.col("times") * (F.log("n") - math.log(max(total, 1)) + F.col("steps") * math.log(alpha))
    late = scores(late.join(words.select("word", "n"), "word"), value, F.lit(0))
    out = (
        known.unionByName(late)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.coalesce(F.sum("seen"), F.lit(0)).alias("n_seen"),
            F.coalesce(F.sum("seen_3"), F.lit(0)).alias("n_seen_3"),
            F.coalesce(F.sum("score"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
    return out if order > 2 else out.drop("n_seen_3")


def op8_backoff(spark: SparkSession, folder: str) -> DataFrame:
    scored = score(documents(spark, folder).select("doc_id", "text"))
    return scored.select("doc_id", "n_words", "n_seen", F.round("score", 5).alias("score"))


def op8_backoff_trigrams(spark: SparkSession, folder: str) -> DataFrame:
    """As op8_backoff, with triples of words that back off to pairs, then to words."""
    scored = score(documents(spark, folder).select("doc_id", "text"), order=3)
    return scored.select("doc_id", "n_words", "n_seen", "n_seen_3", F.round("score", 5).alias("score"))


OP8_SQL = r"""
WITH listed AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), placed AS (
  SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM listed
), pairs AS (
  SELECT r, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS v FROM placed
), word AS (
  SELECT w, count(*) AS n FROM placed GROUP BY w
), context AS (
  SELECT v, count(*) AS n FROM pairs WHERE v IS NOT NULL GROUP BY v
), pair AS (
  SELECT v, w, count(*) AS n FROM pairs WHERE v IS NOT NULL GROUP BY v, w HAVING count(*) >= 2
), total AS (
  SELECT count(*) AS n FROM placed
), scored AS (
  SELECT p.r, pair.n IS NOT NULL AS seen,
         CASE WHEN pair.n IS NOT NULL THEN ln(pair.n) - ln(context.n)
              WHEN p.v IS NULL THEN ln(word.n) - ln(total.n)
              ELSE ln(word.n) - ln(total.n) + ln(0.4) END AS s
  FROM pairs p JOIN word ON p.w = word.w CROSS JOIN total
  LEFT JOIN context ON p.v = context.v LEFT JOIN pair ON p.v = pair.v AND p.w = pair.w
), summed AS (
  SELECT r, sum(s) AS s, count(*) FILTER (seen) AS n_seen FROM scored GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_seen, 0)::BIGINT AS n_seen, round(coalesce(s, 0), 5) AS score
FROM listed LEFT JOIN summed USING (r)
"""

OP8_TRIGRAMS_SQL = r"""
WITH listed AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), placed AS (
  SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM listed
), triples AS (
  SELECT r, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS v, lag(w, 2) OVER (PARTITION BY r ORDER BY i) AS u FROM placed
), word AS (
  SELECT w, count(*) AS n FROM placed GROUP BY w
), context AS (
  SELECT v, count(*) AS n FROM triples WHERE v IS NOT NULL GROUP BY v
), pair AS (
  SELECT v, w, count(*) AS n FROM triples WHERE v IS NOT NULL GROUP BY v, w HAVING count(*) >= 2
), two AS (
  SELECT u, v, count(*) AS n FROM triples WHERE u IS NOT NULL GROUP BY u, v
), triple AS (
  SELECT u, v, w, count(*) AS n FROM triples WHERE u IS NOT NULL GROUP BY u, v, w HAVING count(*) >= 2
), total AS (
  SELECT count(*) AS n FROM placed
), scored AS (
  SELECT t.r, triple.n IS NOT NULL AS seen_3, triple.n IS NOT NULL OR pair.n IS NOT NULL AS seen,
         CASE WHEN triple.n IS NOT NULL THEN ln(triple.n) - ln(two.n)
              WHEN pair.n IS NOT NULL THEN ln(pair.n) - ln(context.n) + CASE WHEN t.u IS NULL THEN 0 ELSE ln(0.4) END
              WHEN t.v IS NULL THEN ln(word.n) - ln(total.n)
              ELSE ln(word.n) - ln(total.n) + CASE WHEN t.u IS NULL THEN ln(0.4) ELSE 2 * ln(0.4) END END AS s
  FROM triples t JOIN word ON t.w = word.w CROSS JOIN total
  LEFT JOIN context ON t.v = context.v LEFT JOIN pair ON t.v = pair.v AND t.w = pair.w
  LEFT JOIN two ON t.u = two.u AND t.v = two.v
  LEFT JOIN triple ON t.u = triple.u AND t.v = triple.v AND t.w = triple.w
), summed AS (
  SELECT r, sum(s) AS s, count(*) FILTER (seen) AS n_seen, count(*) FILTER (seen_3) AS n_seen_3 FROM scored GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_seen, 0)::BIGINT AS n_seen,
       coalesce(n_seen_3, 0)::BIGINT AS n_seen_3, round(coalesce(s, 0), 5) AS score
FROM listed LEFT JOIN summed USING (r)
"""
