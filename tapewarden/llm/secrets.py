"""Operator 1: secrets found by fixed patterns and by a linear-chain conditional random field."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.llm.common import annotate, documents, sampled, seeded

# The base patterns, in the order that breaks ties.
BASE: tuple[tuple[str, str, int, int], ...] = (
    # kind, pattern, group whose length counts, least length
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
KINDS = tuple(kind for kind, *_ in BASE) + ("crf",)

#: Tokens of the random field: runs of letters, digits and + / . _ - or runs of other signs.
TOKEN = re.compile(r"[\w+/.-]+|[^\w\s+/.-]+")
OUT, BEGIN, IN = 0, 1, 2
KEYWORD = re.compile(r"pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|credential|auth|bearer|private_?key", re.I)
#: Tokens whose features a task keeps at most; beyond it the table starts anew.
CACHED_TOKENS = 200_000


def base_spans(text: str, patterns=None) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of each base match that holds, in no set order."""
    spans = []
    for number, (found, group, least) in enumerate(patterns or compiled()):
        for m in found(text):
            if m.end(group) - m.start(group) >= least:
                spans.append((m.start(), m.end(), number))
    return spans


def compiled() -> list[tuple[Callable, int, int]]:
    flags = {"assign": re.IGNORECASE | re.ASCII}
    # A run of fewer than 24 digits can't hold: as runs are maximal, the bound may stand in the pattern.
    text = {"hex": r"[0-9a-f]{24,}"}
    return [
        (re.compile(text.get(kind, pattern), flags.get(kind, re.ASCII)).finditer, group, least)
        for kind, pattern, group, least in BASE
    ]


def token_class(token: str) -> tuple:
    """What the field sees of a token: shape, length, variety, and whether it is a key word or a sign."""
    n = len(token)
    size = 0 if n < 6 else 1 if n < 8 else 2 if n < 12 else 3 if n < 16 else 4 if n < 20 else 5 if n < 32 else 6
    if token.isalpha() and (n == 1 or token[1:].islower()):
        return ("key", size, 1, 0, 0, 0) if KEYWORD.search(token) else ("word", min(size, 3), 1, 0, 0, 0)
    if not any(c.isalnum() for c in token):
        sign = "=" if "=" in token else ":" if ":" in token else "q" if '"' in token or "'" in token else "s"
        return ("sign", sign, 0, 0, 0, 0)
    digits = sum(c.isdigit() for c in token)
    lower = sum(c.islower() for c in token)
    upper = sum(c.isupper() for c in token)
    kinds = (digits > 0) + (lower > 0) + (upper > 1)
    if KEYWORD.search(token):
        return ("key", size, kinds, 0, 0, 0)
    if not digits and not upper > 1:
        return ("word", min(size, 3), kinds, 0, 0, 0)
    changes = 0
    last = None
    for c in token:
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else "-"
        changes += last is not None and k != last
        last = k
    mix = min(4, int(8 * changes / n))
    spread = min(4, int(4 * len(set(token)) / math.sqrt(16 * n)))
    hexed = all(c in "0123456789abcdefABCDEF" for c in token)
    prefix = token[:4] if upper >= 4 and token[:4].isupper() else ""
    return ("mixed" if digits < n else "number", size, kinds, mix, spread, (hexed, prefix))


def own_features(c: tuple) -> list[str]:
    out = [f"t={c[0]}", f"tl={c[0]}{c[1]}", f"tk={c[0]}{c[2]}", f"all={c[:5]}"]
    if c[0] in ("mixed", "number"):
        out += [f"m={c[3]}", f"s={c[4]}", f"h={c[5][0]}{c[1]}", f"p={c[5][1]}"]
    return out


def near_features(c: tuple, where: str) -> list[str]:
    return [f"{where}={c[0]}", f"{where}={c[0]}{c[1]}"]


def file_features(text: str, tokens: int) -> list[str]:
    """What the field sees of the whole text."""
    signs = text.count("=") + text.count(":") + text.count("{")
    return [f"f.code={signs * 20 > tokens}", f"f.key={'=' in text}", f"f.long={tokens > 400}"]


FILE = [f"f.{name}={value}" for name in ("code", "key", "long") for value in (False, True)]
NEAR = ("p2", "p1", "n1", "n2")
EDGE = ("edge", "", 0, 0, 0, 0)


@dataclass
class Field:
    """Weights of the random field: of a feature for each tag, and between tags."""

    weights: dict[str, np.ndarray]
    moves: np.ndarray
    first: np.ndarray

    def score(self, features: Sequence[str]) -> np.ndarray:
        zero = np.zeros(3)
        return sum((self.weights.get(f, zero) for f in features), zero)


def viterbi(emissions: list[list[float]], moves: list[list[float]], first: Sequence[float]) -> list[int]:
    """The best tags of one run of tokens; of equal paths, the one with lower tags."""
    (oo, ob, oi), (bo, bb, bi), (io, ib, ii) = moves
    eo, eb, ei = emissions[0]
    o, b, i = first[0] + eo, first[1] + eb, first[2] + ei
    back = []
    for eo, eb, ei in emissions[1:]:
        to, tb, ti = (o + oo, b + bo, i + io), (o + ob, b + bb, i + ib), (o + oi, b + bi, i + ii)
        o, b, i = max(to), max(tb), max(ti)
        back.append((to.index(o), tb.index(b), ti.index(i)))
        o, b, i = o + eo, b + eb, i + ei
    tags = [(o, b, i).index(max(o, b, i))]
    for step in reversed(back):
        tags.append(step[tags[-1]])
    return tags[::-1]


class Numbers(dict):
    """Class numbers of tokens, found when first asked for."""

    def __init__(self, tagger: Tagger) -> None:
        self.tagger = tagger

    def __missing__(self, token: str) -> int:
        n = self[token] = self.tagger.number(token_class(token))
        return n


class Tagger:
    """Tags whole texts.

    Where a token's score as outside beats another tag by more than the moves
    into and out of that tag can make good, the best path does not take that
    tag there. Tokens that can only be outside cut a text into runs that
    Viterbi decodes one by one, with the same result as over the whole text.
    """

    def __init__(self, field: Field) -> None:
        self.field = field
        self.known = Numbers(self)
        self.numbers: dict[tuple, int] = {}
        self.own: list[np.ndarray] = []
        self.near: list[list[np.ndarray]] = [[] for _ in NEAR]
        self.tables = None
        self.edge = self.number(EDGE)
        moves, first = field.moves, field.first
        self.moves, self.first = moves.tolist(), first.tolist()
        into = np.maximum((moves - moves[:, :1]).max(axis=0), first - first[OUT])
        out_of = np.maximum((moves - moves[:1]).max(axis=1), 0.0)
        #: How much the moves can make good for each tag, against outside.
        self.bound = into + out_of

    def number(self, c: tuple) -> int:
        n = self.numbers.get(c)
        if n is None:
            n = self.numbers[c] = len(self.own)
            self.own.append(self.field.score(own_features(c)))
            for table, where in zip(self.near, NEAR, strict=True):
                table.append(self.field.score(near_features(c, where)))
            self.tables = None
        return n

    def __call__(self, text: str) -> list[tuple[int, int]]:
        """Spans that the field takes for secrets."""
        tokens = TOKEN.findall(text)
        if not tokens:
            return []
        if len(self.known) > CACHED_TOKENS:
            self.known.clear()
        ids = list(map(self.known.__getitem__, tokens))
        if self.tables is None:
            self.tables = [np.array(x) for x in (self.own, *self.near)]
        own, p2, p1, n1, n2 = self.tables
        e = self.edge
        at = np.array([e, e, *ids, e, e])
        emissions = own[at[2:-2]] + p2[at[:-4]] + p1[at[1:-3]] + n1[at[3:-1]] + n2[at[4:]]
        emissions += self.field.score(file_features(text, len(tokens)))
        short = emissions[:, :1] - emissions
        free = np.flatnonzero((short[:, BEGIN] <= self.bound[BEGIN]) | (short[:, IN] <= self.bound[IN]))
        if not len(free):
            return []
        spans: list[tuple[int, int]] = []
        places = None
        for run in np.split(free, np.flatnonzero(np.diff(free) > 1) + 1):
            # One outside token before and after, where there is one, carries the moves into and out of the run.
            low, high = max(0, run[0] - 1), min(len(ids), run[-1] + 2)
            first = self.first if low == 0 else (0.0, -1e9, -1e9)
            tags = viterbi(emissions[low:high].tolist(), self.moves, first)
            if not any(tags):
                continue
            if places is None:
                places = [m.span() for m in TOKEN.finditer(text)]
            for k, tag in enumerate(tags, low):
                if tag == IN and spans and k and tags[k - 1 - low] != OUT and k > low:
                    spans[-1] = (spans[-1][0], places[k][1])
                elif tag != OUT:
                    spans.append(places[k])
        trimmed = ((a, a + len(text[a:b].rstrip(".-/"))) for a, b in spans)
        return [(a, b) for a, b in trimmed if b - a >= 6]


def training_windows(text: str, patterns, width: int, most: int, plain: int) -> list[tuple[list[str], list[int], list[str]]]:
    """Token windows of a text with their tags by the base patterns: around matches, and some without."""
    found = base_spans(text, patterns)
    tokens = [(m.start(), m.end(), m.group()) for m in TOKEN.finditer(text)]
    tags = [OUT] * len(tokens)
    secrets = []
    for a, b, kind in found:
        if kind == 0:
            m = re.compile(BASE[0][1], re.IGNORECASE | re.ASCII).match(text, a)
            a = m.start(2) if m else a
        secrets.append((a, b))
    k = 0
    hits = []
    for a, b in sorted(secrets):
        while k > 0 and tokens[k - 1][1] > a:
            k -= 1
        while k < len(tokens) and tokens[k][1] <= a:
            k += 1
        inside = False
        while k < len(tokens) and tokens[k][0] < b:
            if tags[k] == OUT:
                tags[k] = IN if inside else BEGIN
                hits.append(k)
            inside = True
            k += 1
    words = [t for *_, t in tokens]
    extra = file_features(text, len(words))
    out = []
    for k in sorted(set(hits))[:most]:
        low = max(0, k - width // 2)
        out.append((words[low : low + width], tags[low : low + width], extra))
    for part in range(plain):
        low = part * len(words) // max(plain, 1)
        if words[low : low + width]:
            out.append((words[low : low + width], tags[low : low + width], extra))
    return out


def fit(
    docs: DataFrame,
    text: str = "text",
    most_documents: int = 3000,
    most_windows: int = 6000,
    width: int = 17,
    rounds: int = 80,
    seed: int = 5,
) -> Field:
    """A field fitted to tags that the base patterns give, on a bounded sample.

    About `most_documents` documents, chosen by hash, give windows of `width`
    tokens; at most `most_windows` of them reach the driver. The likelihood is
    maximised by gradient steps over all windows at once.
    """

    def make():
        patterns = compiled()

        def work(texts: list[str]) -> dict[str, list]:
            found = [training_windows(x, patterns, width, 6, 2) for x in texts]
            return {"windows": [[{"w": w, "t": t, "f": f} for w, t, f in x] for x in found]}

        return work

    chosen = sampled(docs.select(text).filter(F.col(text) != ""), most_documents, text, seed=seed)
    windows = (
        annotate(chosen, make, "windows array<struct<w:array<string>,t:array<int>,f:array<string>>>", text)
        .select(F.explode("windows").alias("x"))
        .select("x.*")
        .orderBy(seeded("w", "t", seed=seed), "w", "t", "f")
        .limit(most_windows)
        .collect()
    )
    return fit_windows([(r["w"], r["t"], r["f"]) for r in windows], rounds)


def fit_windows(windows: list[tuple[list[str], list[int], list[str]]], rounds: int = 80) -> Field:
    """Maximum likelihood by full-batch adaptive gradient steps, forward and backward over all windows at once."""
    index: dict[str, int] = {}
    width = max((len(w) for w, *_ in windows), default=1)
    n = len(windows)
    per = []
    tags = np.zeros((n, width), dtype=np.int64)
    mask = np.zeros((n, width), dtype=bool)
    cache: dict[str, tuple] = {}
    for i, (words, t, extra) in enumerate(windows):
        classes = [EDGE, EDGE, *(cache.setdefault(w, token_class(w)) for w in words), EDGE, EDGE]
        for k in range(len(words)):
            names = own_features(classes[k + 2])
            for where, shift in zip(NEAR, (0, 1, 3, 4), strict=True):
                names += near_features(classes[k + shift], where)
            per.append((i, k, [index.setdefault(f, len(index)) for f in names + list(extra)]))
        tags[i, : len(t)] = t
        mask[i, : len(t)] = True
    if not per or not (tags == BEGIN).any():
        # Nothing to learn from: everything is outside.
        return Field({}, np.zeros((3, 3)), np.array([0.0, -50.0, -50.0]))
    rows = np.concatenate([np.full(len(f), i * width + k) for i, k, f in per])
    columns = np.concatenate([np.array(f) for *_, f in per])
    weights = np.zeros((len(index), 3))
    moves = np.zeros((3, 3))
    moves[OUT, IN] = -8.0
    first = np.array([0.0, 0.0, -8.0])
    grown = [np.full(x.shape, 1e-6) for x in (weights, moves, first)]
    onehot = np.eye(3)[tags] * mask[:, :, None]
    following = mask[:, 1:]
    seen_moves = np.einsum("nta,ntb->ab", onehot[:, :-1] * following[:, :, None], onehot[:, 1:])
    seen_first = onehot[:, 0].sum(axis=0)
    for _ in range(rounds):
        emissions = np.zeros((n * width, 3))
        for tag in range(3):
            emissions[:, tag] = np.bincount(rows, weights[columns, tag], minlength=n * width)
        emissions = emissions.reshape(n, width, 3)
        forward = np.zeros((n, width, 3))
        backward = np.zeros((n, width, 3))
        forward[:, 0] = first + emissions[:, 0]
        for k in range(1, width):
            step = np.logaddexp.reduce(forward[:, k - 1, :, None] + moves, axis=1) + emissions[:, k]
            forward[:, k] = np.where(mask[:, k, None], step, forward[:, k - 1])
        for k in range(width - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (emissions[:, k + 1] + backward[:, k + 1])[:, None, :], axis=2)
            backward[:, k] = np.where(mask[:, k + 1, None], step, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
        pairs = np.exp(
            forward[:, :-1, :, None]
            + moves
            + (emissions[:, 1:] + backward[:, 1:])[:, :, None, :]
            - total[:, None, None, None]
        )
        gap = (onehot - chance).reshape(-1, 3)
        slopes = [
            np.stack([np.bincount(columns, gap[rows, t], minlength=len(index)) for t in range(3)], axis=1) - 0.05 * weights,
            seen_moves - (pairs * following[:, :, None, None]).sum(axis=(0, 1)) - 0.05 * moves,
            seen_first - chance[:, 0].sum(axis=0) - 0.05 * first,
        ]
        for value, slope, past in zip((weights, moves, first), slopes, grown, strict=True):
            past += slope * slope
            value += 0.5 * slope / np.sqrt(past)
    return Field({f: weights[i] for f, i in index.items()}, moves, first)


def all_spans(text: str, patterns, tag: Callable[[str], list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """Base spans and the field's spans that touch none of them, by start, then kind."""
    spans = base_spans(text, patterns)
    taken = sorted((a, b) for a, b, _ in spans)
    for a, b in tag(text):
        if all(b <= x or y <= a for x, y in taken):
            spans.append((a, b, len(BASE)))
    return sorted(spans, key=lambda s: (s[0], s[2]))


def find(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """`docs` with `secrets`: an array of (kind, start, end) in code points, end exclusive.

    Null and empty texts have none. Rows are handled one by one, so repeated
    rows give repeated results; a column named `secrets` is replaced.
    """

    def make():
        patterns, tagger = compiled(), Tagger(field)

        def work(texts: list[str]) -> dict[str, list]:
            found = [all_spans(x, patterns, tagger) for x in texts]
            return {"secrets": [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in x] for x in found]}

        return work

    return annotate(docs, make, "secrets array<struct<kind:string,start:int,end:int>>", text)


def redact(docs: DataFrame, field: Field, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with each secret in the text replaced by `mark`; spans that overlap are replaced as one."""
    there = docs.schema[text].dataType.simpleString()

    def make():
        patterns, tagger = compiled(), Tagger(field)

        def clean(x: str) -> str:
            out, end = [], 0
            for a, b, _ in all_spans(x, patterns, tagger):
                if a >= end:
                    out += [x[end:a], mark]
                end = max(end, b)
            return "".join(out) + x[end:] if out else x

        return lambda texts: {"__clean": [clean(x) for x in texts]}

    cleaned = annotate(docs, make, f"__clean {there}", text)
    return cleaned.withColumn(text, F.when(F.col(text).isNotNull(), F.col("__clean"))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def digests(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """`docs` with counts of base spans, the digest of the base spans and all spans as text."""

    def make():
        patterns, tagger = compiled(), Tagger(field)

        def work(texts: list[str]) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for x in texts:
                found = all_spans(x, patterns, tagger)
                named = [(k, f"{KINDS[k]}:{a}:{b}") for a, b, k in found]
                for number, column in enumerate(("n_assign", "n_access", "n_hex")):
                    out[column].append(sum(k == number for k, _ in named))
                base = ",".join(s for k, s in named if k < len(BASE))
                out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                out["spans"].append(",".join(s for _, s in named))
            return out

        return work

    return annotate(docs, make, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", text)


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return digests(docs, fit(docs)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
