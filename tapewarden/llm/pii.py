"""Operator 6: personal data by fixed patterns and by boosted trees over candidate spans. Native functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm.common import documents

# The base kinds in the order that breaks ties. The patterns take what the contract's take;
# possessive repeats and the look at the sign before only spare the search vain steps on long runs.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: High-recall patterns whose matches are candidates of the trees.
CANDIDATES = {
    "handle": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)*+",
    "number": r"\+?+\(?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
}
KINDS = (*BASE, *CANDIDATES)
#: A text without one of these has no match; the search is spared.
NEEDS = {"email": ("@",), "phone": ("+",), "handle": ("@", "(at)", "[at]")}
#: Arrays are gone through in parts of this length, so that the work follows the number of matches, not its square.
PART = 128

#: Characters to the left of a candidate that its context features see.
NEAR = 24


def sql(text: str) -> str:
    """A string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bound(value: str, name: str, then: str) -> str:
    """SQL of `then`, in which `name` stands for a value that is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def parts(array: str) -> str:
    """SQL of an array in parts of PART elements; none where it is empty."""
    cut = f"transform(sequence(0, size(a) div {PART}), c -> slice(a, c * {PART} + 1, {PART}))"
    return bound(array, "a", f"filter({cut}, c -> size(c) > 0)")


def walked(array: str, of: str, step: str) -> str:
    """SQL of an array of structs `of` that come from going over `array` with a whole number as state.

    `step`, from a state `t` (at, out) and an element `x`, gives the next state.
    """
    inner = f"aggregate(c, named_struct('at', s.at, 'out', CAST(array() AS ARRAY<{of}>)), (t, x) -> {step})"
    further = bound(inner, "y", "named_struct('at', y.at, 'all', concat(s.all, array(y.out)))")
    start = f"named_struct('at', 0, 'all', CAST(array() AS ARRAY<ARRAY<{of}>>))"
    return f"aggregate({parts(array)}, {start}, (s, c) -> {further}, s -> flatten(s.all))"


HIT = "STRUCT<start: INT, end: INT, hit: STRING, left: STRING, right: STRING>"


def matches(kind: str, pattern: str, text: str = "__text") -> str:
    """SQL for all matches in a text: array of (start, end, hit, left, right), in code points, end exclusive.

    The matches and the gaps between them, in turn, make up the text, so their
    lengths give the places.
    """
    both = f"named_struct('f', regexp_extract_all({text}, {sql(pattern)}, 0), 'g', split({text}, {sql(pattern)}, -1))"
    zipped = "arrays_zip(z.f, slice(z.g, 1, size(z.f)), slice(z.g, 2, size(z.f)))"
    step = f"""named_struct(
        'at', t.at + length(x.`1`) + length(x.f),
        'out', concat(t.out, array(named_struct(
            'start', t.at + length(x.`1`), 'end', t.at + length(x.`1`) + length(x.f), 'hit', x.f,
            'left', substring(x.`1`, -{NEAR}, {NEAR}), 'right', substring(x.`2`, 1, 2)))))"""
    found = bound(both, "z", walked(zipped, HIT, step))
    needed = " OR ".join(f"instr({text}, '{sign}') > 0" for sign in NEEDS.get(kind, ()))
    needed = f"({needed}) AND " if needed else ""
    return f"CASE WHEN {needed}{text} RLIKE {sql(pattern)} THEN {found} ELSE CAST(array() AS ARRAY<{HIT}>) END"


def digits(hit: str) -> str:
    return f"regexp_replace({hit}, '[^0-9]', '')"


def national(hit: str) -> str:
    """SQL of a number without a plus and the country code that it leads in."""
    return f"regexp_replace({hit}, '^[+][0-9]{{1,3}}[ .-]?', '')"


def octets(hit: str) -> str:
    small = "coalesce(try_cast(regexp_replace(p, '^0+(?=[0-9])', '') AS INT) <= 255, false)"
    return f"forall(split({hit}, '[.]'), p -> {small})"


def luhn(number: str) -> str:
    """SQL that is true where a string of digits passes the Luhn check."""
    digit = f"CAST(substring(reverse({number}), i, 1) AS INT)"
    doubled = f"(IF(i % 2 = 0, 2 * {digit} - IF({digit} > 4, 9, 0), {digit}))"
    return f"aggregate(sequence(1, length({number})), 0, (s, i) -> s + {doubled}) % 10 = 0"


HOLDS = {
    "email": "true",
    "ip": octets("x.hit"),
    "card": f"CASE WHEN length({digits('x.hit')}) BETWEEN 14 AND 19 THEN {luhn(digits('x.hit'))} ELSE false END",
    "phone": f"length({digits('x.hit')}) BETWEEN 10 AND 15",
}

# Features of a candidate x: SQL of small whole numbers, and how many values each can have. What the base patterns
# ask for (a leading plus with what it brings, a sign @, dots written as dots) is not among them: with it, the trees
# could only repeat the base. Shape, checks that fail and the words to the left decide.
FEATURES: dict[str, tuple[str, int]] = {
    "kind": ("IF(x.kind = 4, 0, 1)", 2),
    "digits": (
        f"CASE WHEN x.kind = 4 OR length({digits('x.hit')}) < 10 THEN 0 WHEN length({digits('x.hit')}) < 14 THEN 1 "
        f"WHEN length({digits('x.hit')}) < 16 THEN 2 WHEN length({digits('x.hit')}) < 20 THEN 3 ELSE 4 END",
        5,
    ),
    "brackets": ("IF(x.kind = 5 AND x.hit LIKE '%(%', 1, 0)", 2),
    "dots": (r"least(IF(x.kind = 4, 1, 4), size(regexp_extract_all(x.hit, '[.](?! )|[(\\[]dot[)\\]]', 0)))", 5),
    "gaps": (f"IF(x.kind = 4, 0, least(3, length({national('x.hit')}) - length(translate({national('x.hit')}, ' -', ''))))", 4),
    "check": (
        f"CASE WHEN x.kind = 5 AND length({digits('x.hit')}) BETWEEN 12 AND 19 THEN IF({luhn(digits('x.hit'))}, 2, 1) ELSE 0 END",
        3,
    ),
    "small_parts": (f"IF(x.hit RLIKE '^[0-9]+([.][0-9]+){{3}}$' AND {octets('x.hit')}, 1, 0)", 2),
    "joined": ("IF(x.left RLIKE '[A-Za-z0-9_=]$', 1, 0) + IF(x.right RLIKE '^[A-Za-z0-9_=]', 2, 0)", 4),
    "named": (
        "CASE WHEN x.left RLIKE '(?i)(phone|tel|call|fax|mobile|contact)[^A-Za-z]*$' THEN 1 "
        "WHEN x.left RLIKE '(?i)(card|visa|account|iban|ssn|passport)[^A-Za-z]*$' THEN 2 "
        "WHEN x.left RLIKE '(?i)(mail|address|host|ip)[^A-Za-z]*$' THEN 3 "
        "WHEN x.left RLIKE '(?i)(order|invoice|ticket|serial|part|item|version|build|id|no|ref|isbn|date)[^A-Za-z]*$' THEN 4 ELSE 0 END",
        5,
    ),
}
#: True for a candidate that no base pattern could take whatever its shape, as it lacks the sign that the pattern asks
#: for: its label is unknown, not "no", so it counts UNLABELLED of a candidate that a base pattern looked at and refused.
UNSEEN = (
    "(x.kind = 4 AND NOT x.hit LIKE '%@%' OR x.kind = 5 AND NOT startswith(x.hit, '+') "
    f"AND length({digits('x.hit')}) NOT BETWEEN 14 AND 19 AND NOT x.hit RLIKE '^[0-9]+([.][0-9]+){{3}}$')"
)
UNLABELLED = 0.25
#: One text in so many, by hash, is held back from the trees and calibrates their thresholds.
HELD = 4
#: Cells of the table that the trees are fitted to: no more than the features have values together.
CELLS = math.prod(n for _, n in FEATURES.values())


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `__base` and `__candidates`: arrays of (start, kind, end, hit, left, right) of the text.

    `__parts` has the places of the base spans in parts.
    """
    whole = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    for number, (kind, pattern) in enumerate({**BASE, **CANDIDATES}.items()):
        whole = whole.withColumn(f"__{kind}", F.expr(matches(kind, pattern)))
        held = f"filter(__{kind}, x -> {HOLDS[kind]})" if kind in HOLDS else f"__{kind}"
        ordered = f"transform({held}, x -> named_struct('start', x.start, 'kind', {number}, 'end', x.end, 'hit', x.hit, 'left', x.left, 'right', x.right))"
        whole = whole.withColumn(f"__{kind}", F.expr(ordered))
    return whole.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.array_sort(F.concat(*[F.col(f"__{k}") for k in BASE])).alias("__base"),
        F.array_sort(F.concat(*[F.col(f"__{k}") for k in CANDIDATES])).alias("__candidates"),
    ).withColumn("__parts", F.expr(BASE_PARTS.format(parts("transform(__base, b -> named_struct('start', b.start, 'end', b.end))"))))


#: Parts of the base spans, by start, with the places they lie between. TOUCHES finds them as `q`, which is bound
#: outside the lambda of `x`: an optimizer that moved the column into it would work it out for every candidate.
BASE_PARTS = "transform({}, p -> named_struct('low', p[0].start, 'high', array_max(transform(p, b -> b.end)), 'spans', p))"
TOUCHES = (
    "exists(q, p -> p.low < x.end AND x.start < p.high "
    "AND exists(p.spans, b -> b.start < x.end AND x.start < b.end))"
)


@dataclass
class Trees:
    """Boosted regression trees over the features, and the least score that redacts, by candidate kind."""

    trees: list[tuple]
    start: float
    thresholds: tuple[float, float]

    def score(self, x: str = "x") -> str:
        """SQL of the chance that a candidate with features in fields of `x` is personal data."""
        total = " + ".join([repr(self.start), *(tree_sql(t, x) for t in self.trees)])
        return f"1 / (1 + exp(-({total})))"


def tree_sql(tree: tuple | float, x: str) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    feature, bound, low, high = tree
    return f"IF({x}.{feature} <= {bound}, {tree_sql(low, x)}, {tree_sql(high, x)})"


def cells(found: DataFrame) -> DataFrame:
    """Weights of the candidates of all texts by features: all of them, those that touch a base span, and both again for texts held back.

    Weights are multiples of UNLABELLED, so their sums do not depend on order.
    """
    fields = ", ".join(f"'{name}', CAST({code} AS INT)" for name, (code, _) in FEATURES.items())
    label = f"'hit', IF({TOUCHES}, 1.0D, 0.0D), 'weight', IF({UNSEEN}, {UNLABELLED}D, 1.0D)"
    seen = F.expr(bound("__parts", "q", f"transform(__candidates, x -> named_struct({fields}, {label}))"))
    sums = {"n": ("weight", 0), "hits": ("hit", 0), "held_n": ("weight", 1), "held_hits": ("hit", 1)}
    return (
        found.filter("size(__candidates) > 0")
        .select("__held", F.explode(seen).alias("x"))
        .select("__held", "x.*")
        .withColumn("weight", F.greatest("weight", "hit"))
        .groupBy(*FEATURES)
        .agg(*[F.sum(F.when(F.col("__held") == side, F.col(of)).otherwise(0.0)).alias(name) for name, (of, side) in sums.items()])
        .orderBy(*FEATURES)
    )


def grow(rows: Sequence[dict], slopes: list[float], curves: list[float], depth: int) -> tuple | float:
    """The tree of at most this depth that lowers the loss the most, split by split."""
    g, h = sum(slopes), sum(curves)
    leaf = float(-g / (h + 1.0)) * 0.3
    if depth == 0:
        return leaf
    best = (1e-6, None, 0)
    for feature, (_, values) in FEATURES.items():
        by = [[0.0, 0.0] for _ in range(values)]
        for r, s, c in zip(rows, slopes, curves, strict=True):
            by[r[feature]][0] += s
            by[r[feature]][1] += c
        left_g = left_h = 0.0
        for bound in range(values - 1):
            left_g += by[bound][0]
            left_h += by[bound][1]
            gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
            if left_h > 1e-9 and h - left_h > 1e-9 and gain > best[0]:
                best = (gain, feature, bound)
    _, feature, bound = best
    if feature is None:
        return leaf
    parts = []
    for side in (True, False):
        keep = [i for i, r in enumerate(rows) if (r[feature] <= bound) == side]
        parts.append(grow([rows[i] for i in keep], [slopes[i] for i in keep], [curves[i] for i in keep], depth - 1))
    return (feature, bound, *parts)


def tree_value(tree: tuple | float, row: dict) -> float:
    while not isinstance(tree, float):
        feature, bound, low, high = tree
        tree = low if row[feature] <= bound else high
    return tree


def fit_trees(rows: Sequence[dict], rounds: int = 25, depth: int = 3, precision: float = 0.9) -> Trees:
    """Trees for a table of cells (features, n, hits, held_n, held_hits) by gradient boosting of the log loss.

    The threshold of a candidate kind is the least score at which at least
    `precision` of the held-back weight that reaches it, and at least half of
    `precision` of that of the last cell let in, touches a base span; over 1 if
    there is none, or nothing was held back.
    """
    n = sum(r["n"] for r in rows)
    hits = sum(r["hits"] for r in rows)
    start = math.log((hits + 1) / (n - hits + 1))
    total = [start] * len(rows)
    trees = []
    for _ in range(rounds if 0 < hits < n else 0):
        p = [1 / (1 + math.exp(-max(-30.0, min(30.0, t)))) for t in total]
        slopes = [q * r["n"] - r["hits"] for q, r in zip(p, rows, strict=True)]
        curves = [q * (1 - q) * r["n"] for q, r in zip(p, rows, strict=True)]
        tree = grow(rows, slopes, curves, depth)
        trees.append(tree)
        total = [t + tree_value(tree, r) for t, r in zip(total, rows, strict=True)]
    thresholds = []
    for kind in (0, 1):
        least, seen, good = 2.0, 0.0, 0.0
        held = ((t, r) for t, r in zip(total, rows, strict=True) if r["kind"] == kind and r["held_n"] > 0)
        for t, r in sorted(held, key=lambda x: -x[0]):
            seen += r["held_n"]
            good += r["held_hits"]
            if good < precision * seen or r["held_hits"] < precision * r["held_n"] * 0.5:
                break
            least = 1 / (1 + math.exp(-max(-30.0, min(30.0, t))))
        thresholds.append(least)
    return Trees(trees, start, (thresholds[0] - 1e-9, thresholds[1] - 1e-9))


def fit(docs: DataFrame, text: str = "text") -> Trees:
    """Trees fitted to all candidates of all texts, counted by their features in Spark.

    A candidate that touches a base span is a positive; one that a base pattern
    looked at and refused is a negative; one that lacks the sign a base pattern
    asks for is unlabelled, a negative of weight UNLABELLED. The features hide
    that sign, so shape and context judge it. Texts held back by hash calibrate
    the thresholds. The driver gets the table of counts, at most CELLS rows
    whatever the number of texts.
    """
    held = F.when(F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(11)), F.lit(HELD)) == 0, 1).otherwise(0)
    found = spans(docs.select(text, held.alias("__held")), text)
    return fit_trees([r.asDict() for r in cells(found).collect()])


def find(docs: DataFrame, trees: Trees, text: str = "text", name: str = "pii") -> DataFrame:
    """`docs` with `pii`: an array of (start, kind, end) in code points, end exclusive, by start, then kind.

    Kinds number KINDS. All base spans stay. Candidates that touch none are
    added where their score reaches the threshold of their kind; of two such
    candidates that overlap, the one that starts first stays. Null and empty
    texts have none. Rows are handled one by one; a column of the name is replaced.
    """
    fields = ", ".join(f"'{f}', CAST({code} AS INT)" for f, (code, _) in FEATURES.items())
    free = bound("__parts", "q", f"filter(__candidates, x -> NOT {TOUCHES})")
    described = f"transform({free}, x -> named_struct('start', x.start, 'no', x.kind, 'end', x.end, {fields}))"
    low, high = trees.thresholds
    passed = f"filter({described}, x -> {trees.score()} >= IF(x.kind = 0, {low!r}D, {high!r}D))"
    slim = "transform({}, x -> named_struct('start', x.start, 'kind', {}, 'end', x.end))"
    apart = walked(
        "__added",
        "STRUCT<start: INT, kind: INT, end: INT>",
        "IF(x.start >= t.at, named_struct('at', x.end, 'out', concat(t.out, array(x))), t)",
    )
    found = spans(docs.drop(name), text)
    return (
        found.withColumn("__added", F.expr(slim.format(passed, "x.no")))
        .withColumn(name, F.array_sort(F.concat(F.expr(slim.format("__base", "x.kind")), F.expr(apart))))
        .drop("__base", "__candidates", "__parts", "__added")
    )


def redact(docs: DataFrame, trees: Trees, text: str = "text", mark: str = "[PII]") -> DataFrame:
    """`docs` with each span of personal data in the text replaced by `mark`; spans that overlap, as one."""
    cut = f"""aggregate(__pii, named_struct('at', 0, 'text', ''),
        (s, x) -> named_struct(
            'at', greatest(s.at, x.end),
            'text', IF(x.start >= s.at, concat(s.text, substring(`{text}`, s.at + 1, x.start - s.at), {sql(mark)}), s.text)),
        s -> concat(s.text, substring(`{text}`, s.at + 1)))"""
    found = find(docs, trees, text, "__pii")
    return found.withColumn(text, F.when(F.size("__pii") > 0, F.expr(cut)).otherwise(F.col(text))).drop("__pii")


def joined(spans_of: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"array_join(transform({spans_of}, x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.end)), ',')"
    )


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = find(docs, fit(docs)).drop("text")
    counts = [
        F.size(F.expr(f"filter(pii, x -> x.kind = {number})")).cast("bigint").alias(f"n_{kind}")
        for number, kind in enumerate(BASE)
    ]
    base = joined(f"filter(pii, x -> x.kind < {len(BASE)})")
    return found.select(
        "doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined("pii").alias("spans")
    )
