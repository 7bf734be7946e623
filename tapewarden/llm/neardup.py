"""Operator 10: near-duplicates by an inverted join on MinHash coordinates, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm import exactdup
from tapewarden.llm.common import documents, shared_folder, written

COORDINATES = 32
#: Chance that a pair at the threshold itself shows too few equal coordinates.
MISS = 1e-6
#: Words whose hashes a task keeps at most; beyond it the table starts anew.
CACHED_WORDS = 300_000
#: Nodes of a block: two blocks are compared in one task.
BLOCK = 256
#: Where signatures are compared without the sets, a block has so many times the nodes.
WIDER = 8
#: Shingles hashed at once.
CHUNK = 2_000_000


def least_matches(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The most equal coordinates that a pair of this similarity shows with a chance of 1 - miss."""
    below = 0.0
    for k in range(coordinates + 1):
        below += math.comb(coordinates, k) * similarity**k * (1 - similarity) ** (coordinates - k)
        if below > miss:
            return max(1, k)
    return coordinates


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed shingles of `width` words, ASCII capitals in lower case."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """The sorted distinct shingles of a text; a text of fewer words has one, an empty one none."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.array([known[w] for w in words], dtype=np.uint64)
        width = min(self.width, len(words))
        total = np.full(len(words) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(words) - width + 1 + k])
        return np.unique(total)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """For each set that is not empty, the elements (coordinate and least value, in one number)."""
    random = np.random.default_rng(10)
    factors = random.integers(1, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 1 << 63, coordinates, dtype=np.uint64)
    salts = np.arange(coordinates, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), coordinates), dtype=np.uint64)
    for k in range(coordinates):
        least = np.minimum.reduceat(flat * factors[k] + shifts[k], starts)
        out[:, k] = mixed(least + salts[k])
    return out.view(np.int64)


def node_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def sign(docs: DataFrame, width: int, coordinates: int, doc_id: str, text: str) -> DataFrame:
    """A row for each row of `docs`: `doc_id, text_hash, node, n_shingles, signature`.

    Rows with equal sets have equal nodes. An empty set has no node and no signature.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        empty = np.zeros(0, dtype=np.int64)
        for batch in batches:
            sets = [shingler(x or "") for x in batch.column(2).to_pylist()]
            elements: list[np.ndarray] = [empty] * len(sets)
            low = 0
            while low < len(sets):
                high, size = low, 0
                while high < len(sets) and (high == low or size + len(sets[high]) <= CHUNK):
                    size += len(sets[high])
                    high += 1
                full = [i for i in range(low, high) if len(sets[i])]
                if full:
                    for i, row in zip(full, signatures([sets[i] for i in full], coordinates), strict=True):
                        elements[i] = row
                low = high
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([node_of(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(elements, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "node", "n_shingles", "signature"],
            )

    # The id may be of any type; it comes back as it went in.
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    ).mapInArrow(run, f"doc_id {kind}, text_hash bigint, node binary, n_shingles bigint, signature array<bigint>")


def postings(nodes: DataFrame, matches: int) -> DataFrame:
    """`element, node, weight`: the elements under which a node has to be found.

    Two signatures with `matches` equal elements share one of the rarest
    (length - matches + 1) of each, elements in order of frequency (prefix
    filter). An element that no other node has can't be shared, so a node with
    k shared elements is posted under its rarest k - matches + 1, most nodes
    under none. `weight` is how many nodes share the node's elements, summed:
    highest for the middle of a group of copies.
    """
    elements = nodes.select("node", F.explode("signature").alias("element"))
    often = elements.groupBy("element").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    shared = (
        elements.join(often, "element")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("often", "element"))).alias("shared"))
        .filter(F.size("shared") >= matches)
    )
    return shared.select(
        "node",
        F.aggregate("shared", F.lit(0).cast("bigint"), lambda total, x: total + x["often"]).alias("weight"),
        F.explode(F.slice("shared", F.lit(1), F.size("shared") - (matches - 1))).alias("x"),
    ).select("node", "weight", F.col("x.element").alias("element"))


def matching(pairs: DataFrame, nodes: DataFrame, matches: int, similarity: float) -> DataFrame:
    """Pairs (`a`, `b`) whose sizes allow the similarity and whose signatures agree in enough places."""
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    # Each coordinate has elements of its own, so equal places are common elements.
    equal = F.size(F.filter(F.zip_with("s_a", "s_b", lambda x, y: x == y), lambda same: same))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (similarity - 1e-9))
        .filter(equal >= matches)
        .select("a", "b")
    )


def full_sets(docs: DataFrame, nodes: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """`node, shingles` (sorted numbers as bytes) of the given nodes, from the text of one row each.

    A Bloom filter of their ids and hashes, broadcast, keeps the other texts out
    of the shuffle; a filter that is full at its greatest size lets more of them
    through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sets = [shingler(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                names=["node", "shingles"],
            )

    wanted = nodes.select("node", "row.*")
    most = max(1, exactdup.MOST_FILTER_BYTES * 8 // exactdup.BUCKET_BITS)
    buckets = min(most, exactdup.bucket_count(wanted.count()))
    keys = wanted.select(F.xxhash64("doc_id", "text_hash").alias("key"))
    bitmaps = exactdup.repeat_filter(keys, "key", buckets, least=1)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    return (
        exactdup.probed(rows.withColumn("key", F.xxhash64("id", "hash")), "key", bitmaps, buckets)
        .filter("__maybe")
        .join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")))
        .select("node", "text")
        .dropDuplicates(["node"])
        .mapInArrow(run, "node binary, shingles binary")
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * common >= percent * all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), dtype="<u8") for v in (x, y))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        .select("a", "b", "set_a", "set_b")
        .mapInArrow(run, "a binary, b binary")
    )


def components(edges: DataFrame, folder: str) -> DataFrame:
    """`node, root`: the least node that edges (`a`, `b`) reach, for each node of an edge.

    Each round takes the least root among a node and its neighbours and then
    the root of that root, so the rounds grow with the logarithm of a chain's
    length. Rounds are written to the shared folder.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), f"{folder}/links"
    )
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), f"{folder}/roots-0")
    turn = 0
    while True:
        turn += 1
        near = (
            both.join(roots, both["b"] == roots["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        better = roots.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        over = roots.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        jumped = better.join(over, "root", "left").select(
            "node", F.least("root", F.coalesce("beyond", "root")).alias("root"), "was"
        )
        stored = written(jumped, f"{folder}/roots-{turn}")
        roots = stored.select("node", "root")
        if stored.filter("root <> was").isEmpty():
            return roots


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share."""
    out = np.zeros((len(sets), len(sets)), dtype=np.int64)
    shingles, columns, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # A shingle of one set is common to no two.
    place = np.cumsum(often > 1) - 1
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    of, columns = of[often[columns] > 1], place[columns[often[columns] > 1]]
    order = np.argsort(columns, kind="stable")
    of, columns = of[order], columns[order]
    for low in range(0, int(place[-1]) + 1, 4096):
        here = slice(*np.searchsorted(columns, [low, low + 4096]))
        there = np.zeros((len(sets), 4096), dtype=np.float32)
        there[of[here], columns[here] - low] = 1
        out += (there @ there.T).astype(np.int64)
    return out


def alike(
    signs: np.ndarray, sizes: np.ndarray, others: np.ndarray, other_sizes: np.ndarray, matches: int, percent: int
) -> np.ndarray:
    """For each two of the nodes and the others, whether at least `matches` signature places are equal and sizes allow the similarity."""
    equal = np.zeros((len(signs), len(others)), dtype=np.uint8)
    for k in range(signs.shape[1]):
        equal += signs[:, k, None] == others[None, :, k]
    fits = 100 * np.minimum(sizes[:, None], other_sizes) >= percent * np.maximum(sizes[:, None], other_sizes)
    return (equal >= matches) & fits


def top(above: list[int], i: int) -> int:
    """The root of `i`; `above` has the node above each, itself for a root."""
    while above[i] != i:
        above[i] = above[above[i]]
        i = above[i]
    return i


def table_of(found: list[tuple[bytes, bytes]]) -> pa.Table:
    return pa.table(
        {
            "a": pa.array([x for x, _ in found], pa.binary()),
            "b": pa.array([y for _, y in found], pa.binary()),
        }
    )


def agreeing(group: pa.Table, matches: int, percent: int) -> pa.Table:
    """Pairs of a block, or of two, that agree in enough signature places and join nodes of different roots.

    Of pairs that close a circle none is returned.
    """
    names = group.column("node").to_pylist()
    sizes = group.column("n_shingles").to_numpy()
    block = group.column("block").to_numpy()
    signs = np.array(group.column("signature").to_pylist(), dtype=np.int64)
    # The first node of each root stands above the others.
    first: dict[bytes, int] = {}
    above = [first.setdefault(x, i) for i, x in enumerate(group.column("root").to_pylist())]
    root = np.array(above)
    apart = block.min() != block.max()
    parts = [x[low : low + BLOCK] for b in np.unique(block) for x in [np.flatnonzero(block == b)] for low in range(0, len(x), BLOCK)]
    found: list[tuple[bytes, bytes]] = []
    for n, here in enumerate(parts):
        for there in parts[n:]:
            if apart and block[here[0]] == block[there[0]]:
                continue
            kept = root[here, None] != root[None, there]
            if not kept.any():
                continue
            kept &= alike(signs[here], sizes[here], signs[there], sizes[there], matches, percent)
            before = len(found)
            for i, j in zip(*(x.tolist() for x in np.nonzero(kept)), strict=True):
                x, y = top(above, int(here[i])), top(above, int(there[j]))
                if x != y:
                    above[x] = y
                    found.append((names[here[i]], names[there[j]]))
            if len(found) > before:
                root = np.array([top(above, i) for i in range(len(names))])
    return table_of(found)


def links_of(group: pa.Table, matches: int, percent: int) -> pa.Table:
    """Links among the nodes of a block, or between those of two blocks, that join what is not joined yet.

    Pairs are kept where at least `matches` signature places are equal, then
    confirmed on the full sets. Of links that close a circle none is returned,
    so there are fewer links than nodes.
    """
    names = group.column("node").to_pylist()
    sizes = group.column("n_shingles").to_numpy()
    block = group.column("block").to_numpy()
    signs = np.array(group.column("signature").to_pylist(), dtype=np.int64)
    kept = np.triu(alike(signs, sizes, signs, sizes, matches, percent), 1)
    if block.min() != block.max():
        kept &= block[:, None] != block[None, :]
    left, right = np.nonzero(kept)
    found: list[tuple[bytes, bytes]] = []
    if len(left):
        used = np.unique(np.concatenate([left, right]))
        raw = group.column("shingles").take(pa.array(used)).to_pylist()
        sets = [np.frombuffer(x, dtype="<u8") for x in raw]
        at = np.searchsorted(used, np.arange(len(names)))
        if len(left) <= 4 * len(used):
            common = np.array(
                [len(np.intersect1d(sets[at[i]], sets[at[j]], assume_unique=True)) for i, j in zip(left, right, strict=True)]
            )
        else:
            common = common_counts(sets)[at[left], at[right]]
        holds = 100 * common >= percent * (sizes[left] + sizes[right] - common)
        above = list(range(len(names)))
        for i, j in zip(left[holds].tolist(), right[holds].tolist(), strict=True):
            x, y = top(above, i), top(above, j)
            if x != y:
                above[x] = y
                found.append((names[i], names[j]))
    return table_of(found)


def block_pairs(members: DataFrame, size: int) -> DataFrame:
    """`members` (group, node, settled) once for each pair of blocks (`x`, `y`) that has to be compared.

    A group has blocks of about `size` nodes by hash, those of settled nodes
    apart: settled nodes of a group are joined already, so no pair of their
    blocks is compared.
    """
    counts = members.groupBy("group").agg(
        F.ceil(F.count(F.when(~F.col("settled"), 1)) / size).cast("int").alias("open_blocks"),
        F.ceil(F.count(F.when(F.col("settled"), 1)) / size).cast("int").alias("settled_blocks"),
    )
    turn = F.xxhash64("node")
    block = F.when(
        F.col("settled"), F.col("open_blocks") + F.pmod(turn, F.greatest("settled_blocks", F.lit(1)))
    ).otherwise(F.pmod(turn, F.greatest("open_blocks", F.lit(1))))
    others = F.when(
        F.col("settled"), F.expr("IF(open_blocks > 0, sequence(0, open_blocks - 1), array())")
    ).otherwise(F.expr("sequence(0, open_blocks + settled_blocks - 1)"))
    return (
        members.join(counts, "group")
        .withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(others))
        .withColumn("x", F.least("block", "other"))
        .withColumn("y", F.greatest("block", "other"))
        .drop("other", "open_blocks", "settled_blocks", "settled")
    )


def open_lists(posted: DataFrame, roots: DataFrame, size: int) -> DataFrame:
    """Members (group, node, root, settled) of the posting lists in which some nodes are not joined yet.

    The pair of a list of two is the one of its middle. Of lists with the same
    nodes one stays. In a list of more than `size` nodes those of its most
    frequent root are settled.
    """
    placed = (
        posted.select(F.col("element").alias("group"), "node")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    # Two hashes of 64 bits tell sets of nodes apart.
    same = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"same_{k}") for k in (0, 1)]
    lists = (
        placed.groupBy("group", "root")
        .agg(F.count(F.lit(1)).alias("n"), *same)
        .groupBy("group")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("roots"),
            F.max(F.struct("n", "root"))["root"].alias("main"),
            *[F.bit_xor(f"same_{k}").alias(f"same_{k}") for k in (0, 1)],
        )
        .filter("n > 2 AND roots > 1")
        .groupBy("n", "same_0", "same_1")
        .agg(F.min(F.struct("group", "main")).alias("x"))
        .select("n", "x.*")
    )
    return placed.join(lists, "group").select(
        "group", "node", "root", ((F.col("n") > size) & (F.col("root") == F.col("main"))).alias("settled")
    )


def linked(
    docs: DataFrame,
    signed: DataFrame,
    folder: str,
    width: int,
    percent: int,
    coordinates: int = COORDINATES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame | None:
    """`node, root` of the nodes that are linked with others; None if there are none.

    Signatures first: each node of a posting list is compared with the middle,
    whose elements are the most shared; lists that this does not join are
    compared by pairs of blocks. Nodes whose signatures agree, directly or
    through others, form groups; each link is within one. Nodes that only share
    lists by chance, which join more of a corpus the larger it is, form none.

    Then full sets, of the nodes of groups only. A group of up to BLOCK nodes is
    compared in one task. In a larger one what the middles join to the group's
    largest component is settled; the rest is compared with everything, by
    pairs of blocks. A task returns a forest of links, never all pairs.
    """
    similarity = percent / 100
    matches = least_matches(similarity, coordinates)
    nodes = written(
        signed.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("row"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ),
        f"{folder}/nodes",
    )
    posted = written(postings(nodes, matches), f"{folder}/postings")
    middles = (
        posted.groupBy("element")
        .agg(F.max(F.struct("weight", "node"))["node"].alias("b"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    spokes = written(
        posted.join(middles, "element").filter("node <> b").select(F.col("node").alias("a"), "b").distinct(),
        f"{folder}/spokes",
    )
    if spokes.isEmpty():
        return None
    met = spokes.select(F.col("a").alias("node")).union(spokes.select("b")).distinct()
    signs = written(nodes.join(met, "node"), f"{folder}/signs")
    near = written(matching(spokes, signs, matches, similarity), f"{folder}/near")
    roots = components(near, f"{folder}/near-roots")
    wide = WIDER * BLOCK
    more = written(
        block_pairs(open_lists(posted, roots, wide), wide)
        .join(signs.select("node", "n_shingles", "signature"), "node")
        .groupBy("group", "x", "y")
        .applyInArrow(lambda group: agreeing(group, matches, percent), "a binary, b binary"),
        f"{folder}/more",
    )
    if not more.isEmpty():
        roots = components(near.union(more), f"{folder}/groups")
    groups = roots.withColumnRenamed("root", "group")
    if groups.isEmpty():
        return None
    busy = signs.join(groups, "node")
    sets = written(full_sets(docs, busy, width, doc_id, text), f"{folder}/sets")
    large = written(groups.groupBy("group").count().filter(F.col("count") > BLOCK), f"{folder}/large")
    members = busy.select("group", "node", "n_shingles", "signature").withColumn("settled", F.lit(False))
    edges = None
    if not large.isEmpty():
        in_large = groups.join(large.select("group"), "group", "left_semi")
        pairs = near.join(in_large, near["a"] == in_large["node"], "left_semi")
        of_large = sets.join(in_large.select("node"), "node", "left_semi")
        edges = written(confirmed(pairs, of_large, percent), f"{folder}/edges-1")
        roots = components(edges, f"{folder}/first")
        placed = in_large.join(roots, "node")
        main = (
            placed.groupBy("group", "root")
            .count()
            .groupBy("group")
            .agg(F.max(F.struct("count", "root"))["root"].alias("main"))
        )
        settled = placed.join(main, "group").filter("root = main").select("node", F.lit(True).alias("joined"))
        members = members.join(settled, "node", "left").withColumn("settled", F.coalesce("joined", F.lit(False))).drop("joined")
    found = written(
        block_pairs(members, BLOCK)
        .join(sets, "node")
        .groupBy("group", "x", "y")
        .applyInArrow(lambda group: links_of(group, matches, percent), "a binary, b binary"),
        f"{folder}/edges-2",
    )
    return components(found if edges is None else found.unionByName(edges), f"{folder}/second")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`doc_id, text_hash, n_shingles, component, component_id, kept` for each row of `docs`.

    Documents whose shingle sets have a Jaccard similarity of `percent` or more
    are linked; `component` names what links join, `component_id` is the least
    id in it and `kept` whether the row has that id. Equal sets are one node, whatever their number. Pairs are
    found where signatures agree in so many coordinates that a pair at the
    threshold is missed once in a million, and confirmed on the full sets.

    A null or empty text, or one of white space, is linked with nothing and is
    its own component. Repeated rows are in one component and have the same
    answer. A null id never is a component's id unless the component has no
    other; it is kept only then. Other columns of `docs` play no part.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "neardup")
    signed = written(sign(docs, width, coordinates, doc_id, text), f"{folder}/signed")
    roots = linked(docs, signed, folder, width, percent, coordinates, doc_id, text)
    ids = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    if roots is not None:
        placed = ids.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        of_root = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        ids = placed.join(of_root, "root").select("node", F.col("root").alias("component"), "component_id")
    else:
        ids = ids.select("node", F.col("node").alias("component"), F.col("least").alias("component_id"))
    out = signed.join(ids, "node", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        "component",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_neardup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return near_duplicates(docs, width=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")
