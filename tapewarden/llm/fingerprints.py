"""Operator 7: fingerprints by randomised edit embedding, banding and verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tapewarden.llm.common import annotate, documents, shared_folder, written

#: Sampled places of the embedding: bytes of a fingerprint.
PLACES = 128
#: Characters are told apart by so many classes (their code modulo it) in the walk.
CLASSES = 256
#: The walk's random steps repeat after so many places.
PERIOD = 4096
#: Characters walked at once in a task.
CHUNK = 4_000_000
#: With fewer texts left, walking them one by one costs less.
FEW = 24
#: Code points read at a sampled place: the walk's own and those that follow.
READ = 4
#: Rows of a block, and rows that a task handles at once, at most.
TEXTS = 2000
#: Classes of a bucket that a task compares with as many others, about.
BLOCK = 256
#: Bands of `links`, of six places each: at a likeness of 0.8 a pair shares one with a chance of 0.998.
BANDS = 21
#: Rows of one class are dealt to so many parts where classes go back to rows.
SALTS = 16
NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


class Walk:
    """The shared random walk, its sampled places and the hash of what stands there.

    The embedding of a text x writes x[i] at each place and then moves to i + 1
    or stays, by a random bit of the place and the character. So a character
    fills the places up to the first whose bit says move: `steps` has their
    number for each character class and place. A text fills about two places a
    character. After an insertion or deletion two walks meet again soon, and
    from there on write the same.
    """

    def __init__(self, seed: int = 7, places: int = PLACES) -> None:
        random = np.random.default_rng(seed)
        moves = random.integers(0, 2, (CLASSES, PERIOD), dtype=np.uint8)
        moves[:, PERIOD - 1] = 1
        steps = np.zeros((CLASSES, PERIOD), dtype=np.int64)
        run = np.zeros(CLASSES, dtype=np.int64)
        for place in range(PERIOD - 1, -1, -1):
            run = np.where(moves[:, place] == 1, 1, run + 1)
            steps[:, place] = run
        self.steps = steps.astype(np.uint8 if steps.max() < 256 else np.int16)
        self.rows = self.steps.tolist()
        # Sampled place of each coordinate for embeddings of any length: the last record below the length.
        # Records of a random order thin out as 1 / place, so embeddings of like lengths share most places.
        self.records = []
        for _ in range(places):
            at, records = 0.0, [0]
            while at < 2.0**42:
                at = max(at + 1, (at + 1) / max(random.random(), 1e-9))
                records.append(int(at))
            self.records.append(np.array(records))
        self.salts = random.integers(1, 1 << 63, places, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def ends(self, codes: list[np.ndarray], starts: list[int]) -> list[np.ndarray]:
        """Where each character's run of places ends, for texts whose walks begin at the given places."""
        order = sorted(range(len(codes)), key=lambda k: -len(codes[k]))
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(codes)
        lengths = np.array([len(codes[k]) for k in order])
        if not len(lengths) or not lengths[0]:
            return out
        # Column by column: the characters at one index of all texts that are long enough.
        shared = int(lengths[FEW - 1]) if len(lengths) >= FEW else 0
        active = np.searchsorted(-lengths, -np.arange(shared), side="left") if shared else np.zeros(0, dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(active)])
        columns = np.empty(int(offsets[-1]), dtype=np.int64)
        for row, k in enumerate(order):
            n = min(len(codes[k]), shared)
            columns[offsets[:n] + row] = codes[k][:n] % CLASSES
        walked = np.empty(len(columns), dtype=np.int64)
        places = np.array([starts[k] for k in order], dtype=np.int64)
        flat = self.steps.reshape(-1)
        columns *= PERIOD
        for i in range(shared):
            low, high = offsets[i], offsets[i + 1]
            n = high - low
            now = places[:n]
            now += flat[columns[low:high] + (now & (PERIOD - 1))]
            walked[low:high] = now
        rows = self.rows
        for row, k in enumerate(order):
            n = len(codes[k])
            own = np.empty(n, dtype=np.int64)
            m = min(n, shared)
            own[:m] = walked[offsets[:m] + row]
            if n > m:
                at, rest = int(places[row]) if m else starts[k], []
                for c in (codes[k][m:] % CLASSES).tolist():
                    at += rows[c][at & (PERIOD - 1)]
                    rest.append(at)
                own[m:] = rest
            out[k] = own
        return out

    def fingerprint(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A byte for each sampled place: a hash of what the embedding has there."""
        n = len(codes)
        if not n:
            return np.zeros(len(self.records), dtype=np.uint8)
        length = 2 * n
        places = np.array([r[np.searchsorted(r, length) - 1] for r in self.records])
        at = np.searchsorted(ends, places, side="right")
        value = np.zeros(len(places), dtype=np.uint64)
        for k in range(READ):
            there = at + k
            symbol = np.where(there < n, codes[np.minimum(there, n - 1)].astype(np.uint64) + np.uint64(1), np.uint64(0))
            value = (value ^ symbol) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        return ((value * self.salts) >> np.uint64(56)).astype(np.uint8)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def walk_texts(walk: Walk, codes: list[np.ndarray]) -> list[np.ndarray]:
    """Fingerprints of texts, by chunks that bound a task's memory."""
    out: list[np.ndarray] = []
    low = 0
    while low < len(codes):
        high, size = low, 0
        while high < len(codes) and (high == low or size + len(codes[high]) <= CHUNK):
            size += len(codes[high])
            high += 1
        part = codes[low:high]
        ends = walk.ends(part, [0] * len(part))
        out += [walk.fingerprint(c, e) for c, e in zip(part, ends, strict=True)]
        low = high
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal places, less what chance makes equal."""
    return max(0.0, (float((a == b).mean()) - 1 / 256) / (1 - 1 / 256)) if len(a) else 1.0


def fingerprints(docs: DataFrame, seed: int = 7, places: int = PLACES, text: str = "text") -> DataFrame:
    """`docs` with `fingerprint`, hexadecimal; equal texts have equal ones, null counts as empty.

    Rows are handled one by one; a column named `fingerprint` is replaced.
    """
    def make():
        walk = Walk(seed, places)
        return lambda texts: {
            "fingerprint": [f.tobytes().hex() for f in walk_texts(walk, [code_points(x) for x in texts])]
        }

    return annotate(docs, make, "fingerprint string", text)


def classes(prints: DataFrame, doc_id: str = "doc_id", fingerprint: str = "fingerprint") -> DataFrame:
    """`prints` with `class_id`, the least id among the rows of the same fingerprint."""
    least = prints.groupBy(F.col(fingerprint).alias("__f")).agg(F.min(doc_id).alias("class_id"))
    return prints.join(least, F.col(fingerprint) == F.col("__f")).drop("__f")


def similar_pairs(
    prints: DataFrame, least: float = 0.6, bands: int = 32, doc_id: str = "doc_id", fingerprint: str = "fingerprint"
) -> DataFrame:
    """Pairs (`a`, `b`, `likeness`) of rows whose fingerprints are alike: bit-sampled bands, then verification.

    Each band is a sample of places; rows equal in a band are candidates. Equal
    fingerprints are one class, represented by its least id; `classes` says which
    class a row is in, so copies are not expanded into pairs. All classes of a
    band's bucket are compared with each other, by pairs of blocks of about
    BLOCK classes, so no task holds a large bucket. A pair is returned by the
    first band it shares. Work and result grow with the square of a bucket.
    """
    heads_of = prints.groupBy(F.col(fingerprint).alias("f")).agg(F.min(doc_id).alias("id"))
    width = PLACES // bands
    # Every bands-th byte from the band's number on.
    keys = F.array(*[F.concat(*[F.substring("f", 1 + 2 * (b + k * bands), 2) for k in range(width)]) for b in range(bands)])
    posted = heads_of.select("id", "f", F.posexplode(keys).alias("band", "key"))
    sizes = posted.groupBy("band", "key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"))
    members = (
        posted.join(sizes.filter("n > 1"), ["band", "key"])
        .withColumn("block", F.pmod(F.xxhash64("f"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "id", "f")
    )
    kind = prints.schema[doc_id].dataType.simpleString()

    def compared(group: pa.Table) -> pa.Table:
        band, x, y = (group.column(c)[0].as_py() for c in ("band", "x", "y"))
        ids, block = group.column("id"), group.column("block").to_numpy()
        codes = np.frombuffer(bytes.fromhex("".join(group.column("f").to_pylist())), dtype=np.uint8).reshape(-1, PLACES)
        rows, others = np.flatnonzero(block == x), np.flatnonzero(block == y)
        one, two, near = [], [], []
        for k, row in enumerate(rows):
            against = others[k + 1 :] if x == y else others
            equal = codes[against] == codes[row]
            shared = equal[:, : width * bands].reshape(-1, width, bands).all(axis=1)
            alike = equal.mean(axis=1)
            found = np.flatnonzero((alike >= least) & (shared.argmax(axis=1) == band))
            one += [row] * len(found)
            two += against[found].tolist()
            near += alike[found].tolist()
        return pa.table(
            {"p": ids.take(pa.array(one, pa.int64())), "q": ids.take(pa.array(two, pa.int64())), "likeness": pa.array(near, pa.float64())}
        )

    return (
        members.groupBy("band", "key", "x", "y")
        .applyInArrow(compared, f"p {kind}, q {kind}, likeness double")
        .filter("p <> q")
        .groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
        .agg(F.max("likeness").alias("likeness"))
    )


def links(
    docs: DataFrame, least: float = 0.8, bands: int = BANDS, seed: int = 7, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row for each row: `doc_id`, `class_id`, `n_links`.

    `class_id` is the least id of the rows with the same fingerprint, which equal
    texts share. `n_links` is the number of other classes whose fingerprint is
    at least `least` alike: candidates are equal in one of `bands` samples of
    places, and are verified on all places. A pair is counted by the first band
    it shares. Buckets of any size are compared whole, by pairs of blocks of
    about BLOCK classes; tasks return counts, not pairs. Bands are posted
    without fingerprints, which join the members of buckets of two or more.
    A null text counts as empty; a null id is less than none, so it is a class's
    id only where the class has no other. An empty table gives no rows.
    """
    folder = shared_folder(docs.sparkSession, "prints")
    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    prints = fingerprints(chosen, seed).select("id", F.unhex("fingerprint").alias("f"))
    prints = written(prints.withColumn("c", F.unhex(F.md5("f"))), f"{folder}/rows")
    heads = written(prints.groupBy("c").agg(F.min("id").alias("class_id"), F.first("f").alias("f")), f"{folder}/classes")
    width = PLACES // bands
    # Every bands-th byte from the band's number on.
    keys = F.array(*[F.xxhash64(*[F.substring("f", 1 + b + k * bands, 1) for k in range(width)]) for b in range(bands)])
    posted = heads.select("c", F.posexplode(keys).alias("band", "key"))
    sizes = posted.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = (
        posted.join(sizes, ["band", "key"])
        .join(heads.select("c", "f"), "c")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("c"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "c", "f")
    )

    def counted(group: pa.Table) -> pa.Table:
        band, x, y = (group.column(k)[0].as_py() for k in ("band", "x", "y"))
        block = group.column("block").to_numpy()
        codes = np.frombuffer(b"".join(group.column("f").to_pylist()), dtype=np.uint8).reshape(-1, PLACES)
        rows, others = np.flatnonzero(block == x), np.flatnonzero(block == y)
        n = np.zeros(len(codes), dtype=np.int64)
        for k, row in enumerate(rows):
            against = others[k + 1 :] if x == y else others
            equal = codes[against] == codes[row]
            alike = (equal.mean(axis=1) - 1 / 256) / (1 - 1 / 256)
            near = np.flatnonzero(alike >= least)
            shared = equal[near][:, : width * bands].reshape(-1, width, bands).all(axis=1)
            near = near[shared.argmax(axis=1) == band]
            n[row] += len(near)
            n[against[near]] += 1
        linked = np.flatnonzero(n)
        return pa.table({"c": group.column("c").take(pa.array(linked)), "n": pa.array(n[linked])})

    counts = (
        members.groupBy("band", "key", "x", "y")
        .applyInArrow(counted, "c binary, n bigint")
        .groupBy("c")
        .agg(F.sum("n").alias("n_links"))
    )
    classed = heads.select("c", "class_id").join(counts, "c", "left")
    salted = classed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = prints.select("c", "id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    return rows.join(salted, ["c", "salt"]).select(
        F.col("id").alias(doc_id), "class_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_block: int = TEXTS) -> DataFrame:
    """Rows (`id, text, order, block, guest`): each block holds its rows and, as a guest, the row after its last.

    Ids are cut into blocks at approximate quantiles, 4,096 at most, whose
    bounds the driver holds. A bound is an id that occurs, so the first row of
    each block is known without another pass: it is the guest of the block
    before. The first row of all is the guest of the last block.
    """
    order = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63)))
    ids = docs.select(order.alias("order"))
    parts = max(1, min(4096, -(-ids.count() // rows_per_block)))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    found = ids.agg(F.min("order").alias("least"), F.percentile_approx("order", shares, 20 * 4096).alias("bounds")).first()
    bounds = sorted(set(found["bounds"] or ()) - {found["least"]}) if parts > 1 else []
    block = F.lit(0)
    if bounds:
        array = F.array(*[F.lit(b).cast("bigint") for b in bounds])
        block = F.size(F.filter(array, lambda b: b <= F.col("order")))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), order.alias("order")).withColumn("block", block)
    firsts = [] if found["least"] is None else [found["least"], *bounds]
    guests = rows.filter(F.col("order").isin(firsts)).withColumn(
        "block", F.when(F.col("block") == 0, len(bounds)).otherwise(F.col("block") - 1)
    )
    return rows.withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1)))


def edited(docs: DataFrame, seed: int = 7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and how alike they and the next row's are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text has, in place of its last half,
    the first characters of the next document by id; a null id comes first, and
    rows of one id follow each other by text. A single row is its own next.
    A null text counts as empty; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(seed)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                columns = (batch.column(k).to_pylist() for k in range(4))
                yield from zip(*columns, strict=True)

        def finished(part: list[tuple]) -> pa.RecordBatch:
            """Results of all rows of a part but the last, whose own turn comes with its next."""
            codes = [code_points(x[1] or "") for x in part]
            ends = walk.ends(codes, [0] * len(codes))
            prints = [walk.fingerprint(c, e) for c, e in zip(codes, ends, strict=True)]
            pairs = [(k, k + 1) for k in range(len(part) - 1) if not part[k][3] and part[k][2] == part[k + 1][2]]
            heads = [len(codes[k]) - len(codes[k]) // 2 for k, _ in pairs]
            tails = [codes[j][: len(codes[k]) // 2] for k, j in pairs]
            more = walk.ends(tails, [int(ends[k][h - 1]) if h else 0 for (k, _), h in zip(pairs, heads, strict=True)])
            out: dict[str, list] = {name: [] for name in NAMES}
            for (k, j), head, tail, rest in zip(pairs, heads, tails, more, strict=True):
                both = np.concatenate([codes[k][:head], tail])
                other = walk.fingerprint(both, np.concatenate([ends[k][:head], rest]))
                changed = (part[k][1] or "")[:head] + (part[j][1] or "")[: len(tail)]
                out["doc_id"].append(part[k][0])
                out["n_chars"].append(len(codes[k]))
                out["edited_sha256"].append(hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest())
                out["fingerprint"].append(prints[k].tobytes().hex())
                out["edited_fingerprint"].append(other.tobytes().hex())
                out["near_edited"].append(likeness(prints[k], other))
                out["near_next"].append(likeness(prints[k], prints[j]))
            return pa.RecordBatch.from_pydict(out, schema=schema)

        part: list[tuple] = []
        size = 0
        for row in rows():
            part.append(row)
            size += len(row[1] or "")
            if size > CHUNK or len(part) > TEXTS:
                yield finished(part)
                part, size = part[-1:], len(row[1] or "")
        if part:
            yield finished(part)

    kind = docs.schema[doc_id].dataType.simpleString()
    fields = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    schema = to_arrow_schema(T._parse_datatype_string(fields))
    return (
        with_next(docs, doc_id, text)
        .repartition("block")
        .sortWithinPartitions("block", "guest", "order", "text")
        .select("id", "text", "block", "guest")
        .mapInArrow(run, fields)
    )


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited(documents(spark, folder).select("doc_id", "text"))


def op7_links(spark: SparkSession, folder: str) -> DataFrame:
    return links(documents(spark, folder))
