"""Secret scanning: fixed patterns, and a battery of randomness tests for everything else.

Patterns find assignments, access keys and long hexadecimal runs. Besides, every long run of key characters that
no pattern explains is tested: its encoding is inferred from the characters it uses, and three statistics ask
whether it looks like draws from that alphabet: chi-squared of the symbol counts, the number of runs above and below
the middle of the alphabet, and the serial correlation of neighbouring symbols.

A test of randomness has randomness as its null hypothesis, and false discoveries are natural strings taken for
secrets. So the three p-values, combined, serve as a score, and the p-value of a candidate is the share of natural strings
of its length class that score at least as high. Natural strings follow the letter pairs of the whole corpus: the pairs
are counted over all texts, and strings drawn from that chain give the distribution. Its tail is split into levels: the tenth with
the highest scores is copied and redrawn, letter by letter, among natural strings that score no less, as often as it takes to resolve the
p-values that the number of candidates asks for. Benjamini and Hochberg's rule over the distinct candidates of a length class then bounds
the share of false discoveries; it needs only their counts per class and p-value, of which there are a fixed number. Copies do not move it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import stage

KINDS = ("assign", "access", "hex", "random")
MIN_RANDOM = 20
RATE = 0.01
DRAWS = 20_000
LEVEL = 2_000  # strings per level of the tail, a tenth of which goes on to the next
LEAST_DRAWS = 20  # a p-value rests on at least so many strings
CLASSES = (20, 24, 32, 48, 64)

# Keywords stand in either case; the value alone is case-sensitive, and so is the rest of the pattern.
ASSIGN = re.compile(
    r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_RANDOM)
LONG = re.compile(r"[A-Za-z0-9+/_=-]{%d}" % MIN_RANDOM)

#: Alphabets in order of size; the first that holds all characters of a candidate is its encoding. No encoder writes letters alone, so a
#: word counts as one of digits and letters that lacks digits, which speaks against it.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "upper36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_SETS = {k: (frozenset(v), {c: i for i, c in enumerate(v)}) for k, v in ALPHABETS.items()}


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """Pattern matches of a text: start, kind, end in code points, by start and then kind as listed."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def encoding_of(token: str) -> str | None:
    """Smallest alphabet that holds all characters, padding aside; None if no encoding does."""
    used = frozenset(token.rstrip("="))
    return next((k for k, (letters, _) in _SETS.items() if used <= letters), None)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str) -> tuple[float, float, float]:
    """p-values of the three tests under the hypothesis that the token is drawn from its alphabet."""
    kind, body = encoding_of(token), token.rstrip("=")
    if kind is None:
        return 0.0, 0.0, 0.0
    index, n, m = _SETS[kind][1], len(body), len(ALPHABETS[kind])
    x = np.array([index[c] for c in body], float)
    counts = np.bincount(x.astype(int), minlength=m)
    chi = float(((counts - n / m) ** 2).sum() * m / n)
    # Mean and variance of the statistic for n draws; Wilson and Hilferty's cube root makes it nearly normal.
    df = m - 1
    uniform = _normal_tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    high = x >= m / 2
    n1, n2 = int(high.sum()), n - int(high.sum())
    if n1 and n2:
        mean = 2 * n1 * n2 / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = 2 * _normal_tail(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var))
    else:
        runs = 2.0 ** (1 - n)
    spread = x - x.mean()
    total = float((spread**2).sum())
    r = float((spread[1:] * spread[:-1]).sum() / total) if total else 1.0
    serial = 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n))
    return uniform, min(runs, 1.0), min(serial, 1.0)


def score(token: str) -> float:
    """Fisher's combination of the battery: the probability, for a random token, of p-values as small together."""
    ps = battery(token)
    if min(ps) <= 0:
        return 0.0
    half = -sum(math.log(p) for p in ps)  # half the chi-squared statistic with six degrees of freedom
    return math.exp(-half) * (1 + half + half * half / 2)


def candidates(text: str, taken: list[tuple[int, str, int]]) -> list[tuple[int, int, int, float, int]]:
    """Runs of key characters that no span in ``taken`` (by start) touches: start, end, length class, score, hash without the padding."""
    if not LONG.search(text):
        return []
    found, at, far = [], 0, 0
    for m in CANDIDATE.finditer(text):
        # Both come by start: `far` is the farthest end of the spans that start before this run ends.
        while at < len(taken) and taken[at][0] < m.end():
            far, at = max(far, taken[at][2]), at + 1
        if far <= m.start():
            body = m.group().rstrip("=")
            own = int.from_bytes(hashlib.blake2b(body.encode(), digest_size=8).digest(), "little", signed=True)
            found.append((m.start(), m.end(), int(np.searchsorted(CLASSES, len(body), "right")) - 1, score(body), own))
    return found


_LETTER = np.full(256, 26, np.int64)
_LETTER[97:123] = _LETTER[65:91] = np.arange(26)


def letter_pairs(text: str) -> np.ndarray:
    """Counts of neighbouring ASCII letters, in lower case; place 26 stands for anything else."""
    codes = _LETTER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    return np.bincount(codes[:-1] * 27 + codes[1:], minlength=729)


def letter_scores(x: np.ndarray) -> np.ndarray:
    """:func:`score` of many strings of lower-case letters at once; a row of ``x`` has the letters' numbers, from 0, at one place of all strings."""
    size, n = x.shape
    counts = np.zeros((26, n))
    for row in x:
        counts[row, np.arange(n)] += 1
    m = len(ALPHABETS["lower36"])
    chi, df = (counts * counts).sum(0) * m / size - size, m - 1
    tails = np.vectorize(_normal_tail, otypes=[float])
    uniform = tails(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    high = x + 10 >= m / 2
    n1 = high.sum(0)
    mean = 2 * n1 * (size - n1) / size + 1
    var = np.maximum((mean - 1) * (mean - 2) / (size - 1), 1e-9)
    runs = 2 * tails(np.abs(1 + (high[1:] != high[:-1]).sum(0) - mean) / np.sqrt(var))
    runs = np.where((n1 > 0) & (n1 < size), np.minimum(runs, 1.0), 2.0 ** (1 - size))
    spread = x - x.mean(0)
    total = (spread**2).sum(0)
    r = np.where(total > 0, (spread[1:] * spread[:-1]).sum(0) / np.where(total > 0, total, 1), 1.0)
    ps = np.array([uniform, runs, np.minimum(2 * tails(np.abs(r + 1 / size) * math.sqrt(size)), 1.0)])
    half = -np.log(np.maximum(ps, 1e-300)).sum(0)
    out = np.where(ps.min(0) > 0, np.exp(-half) * (1 + half + half * half / 2), 0.0)
    for i in np.flatnonzero(x.max(0) < 6):  # hexadecimal
        out[i] = score((x[:, i].astype(np.uint8) + 97).tobytes().decode())
    return out


def natural_scores(pairs: np.ndarray, size: int, least: float, draws: int = DRAWS) -> tuple[np.ndarray, np.ndarray]:
    """Scores of strings of ``size`` letters from the chain of ``pairs``, ascending, and the share of natural strings each stands for.

    Shares from the top down add up to p-values, resolved to below ``least``. Every level of the tail is moved by Gibbs steps that keep
    the chain's law among the strings above the level's score. Half a count is added to each pair, since a pair that the corpus lacks is
    not impossible. The seed is fixed.
    """
    chain = np.asarray(pairs, float).reshape(27, 27)[:26, :26] + 0.5
    start, steps = chain.sum(1) / chain.sum(), chain / chain.sum(1, keepdims=True)
    rng = np.random.default_rng(size)

    def pick(weights: np.ndarray) -> np.ndarray:
        upto = np.cumsum(weights, 1)
        return (upto < rng.random(len(upto))[:, None] * upto[:, -1:]).sum(1).clip(0, 25)

    letters = [pick(np.broadcast_to(start, (draws, 26)))]
    for _ in range(1, size):
        letters.append(pick(steps[letters[-1]]))
    x, share, scores, shares = np.array(letters), 1.0, [], []
    value = letter_scores(x)
    while True:
        level = np.sort(value)[-max(len(value) // 10, 1)]
        above = value >= level
        if share <= least or above.all():
            break
        scores.append(value[~above])
        shares.append(np.full(len(scores[-1]), share / len(value)))
        share *= above.mean()
        live = rng.choice(np.flatnonzero(above), LEVEL)
        x, value = x[:, live], value[live]
        for at in rng.permutation(size):
            weights = steps[x[at - 1]] if at else np.broadcast_to(start, (LEVEL, 26))
            if at + 1 < size:
                weights = weights * steps.T[x[at + 1]]
            moved = x.copy()
            moved[at] = pick(weights)
            new = letter_scores(moved)
            x, value = np.where(new >= level, moved, x), np.where(new >= level, new, value)
    scores, shares = np.concatenate([*scores, value]), np.concatenate([*shares, np.full(len(value), share / len(value))])
    order = np.argsort(scores, kind="stable")
    return scores[order], shares[order]


def tail(natural: np.ndarray, shares: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Estimated share of natural strings that score at least as high as each of ``scores``; scores above nearly all drawn get the least one."""
    summed = np.cumsum(shares[::-1]) + shares[::-1]
    at = np.maximum(len(natural) - np.searchsorted(natural, scores, "left"), min(LEAST_DRAWS, len(natural))) - 1
    return np.minimum(summed[at], 1.0)


def discovery_bound(scores: np.ndarray, natural: np.ndarray, shares: np.ndarray, counts: np.ndarray, rate: float) -> float:
    """Smallest score that counts as a discovery: the largest k with p(k) <= rate * k / n, or infinity."""
    order = np.argsort(-scores)
    p = tail(natural, shares, scores[order])
    rank = np.cumsum(counts[order])
    passed = np.flatnonzero(p <= rate * rank / counts.sum())
    return float(scores[order][passed[-1]]) if len(passed) else math.inf


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Secrets in each text of ``docs(doc_id, text)``: ``doc_id, base, spans``, arrays of start, kind, end.

    Starts and ends are code points, ends exclusive; ``base`` are the pattern matches, ``spans`` these and the candidates that pass the
    tests. Both are ordered by start and then by kind as listed in ``KINDS``. A NULL text counts as empty and has none; each of several
    repeated rows gets its own result and counts in the letter pairs; an empty table gives no rows; further columns are ignored.
    """
    spans = "array<struct<start:long,kind:string,end:long>>"
    # Ids go through Python as text: pandas would turn numbers next to a NULL into floats.
    schema = f"doc_id string, base {spans}, tested array<struct<start:long,end:long,class:int,score:double,hash:long>>, pairs array<long>"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs, base, tested = np.zeros(729, np.int64), [], []
            for text in batch["text"]:
                text = text or ""
                own = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in own])
                tested.append([dict(zip(("start", "end", "class", "score", "hash"), c, strict=True)) for c in candidates(text, own)])
                pairs += letter_pairs(text)
            out = pd.DataFrame({"doc_id": batch["doc_id"], "base": base, "tested": tested, "pairs": None})
            yield out
            yield pd.DataFrame({"doc_id": [None], "base": [None], "tested": [None], "pairs": [pairs.tolist()]})

    found = stage(docs.select(docs["doc_id"].cast("string").alias("doc_id"), "text").mapInPandas(scan, schema), "secrets")
    counted = found.filter("pairs is not null").select(F.posexplode("pairs").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n"))
    pairs = np.zeros(729)
    for row in counted.collect():  # 729 rows at most
        pairs[row.i] = row.n
    rows = found.filter("pairs is null")
    # Scores are compared on a grid, so their number does not grow with the corpus.
    grid = F.floor(F.col("t.score") * 10_000) / 10_000
    # Equal strings have equal scores and hashes, and count once however many copies the corpus has.
    distinct = rows.select(F.explode("tested").alias("t")).select(F.col("t.class").alias("c"), grid.alias("s"), "t.hash").distinct()
    table = distinct.groupBy("c", "s").agg(F.count("*").alias("n")).toPandas()
    bounds = []
    for c, size in enumerate(CLASSES):
        own = table[table["c"] == c]
        if not len(own):
            bounds.append(math.inf)
            continue
        natural, shares = natural_scores(pairs, size, rate / own["n"].sum() / LEAST_DRAWS)
        natural = np.floor(natural * 10_000) / 10_000
        bounds.append(discovery_bound(own["s"].to_numpy(float), natural, shares, own["n"].to_numpy(float), rate))
    def passes(t):
        return F.floor(t["score"] * 10_000) / 10_000 >= F.element_at(F.array(*[F.lit(b) for b in bounds]), t["class"] + 1)

    extra = F.transform(
        F.filter("tested", passes),
        lambda t: F.struct(t["start"].alias("start"), F.lit("random").alias("kind"), t["end"].alias("end")),
    )
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])

    def before(a, b):
        left, right = F.struct(a["start"], order[a["kind"]]), F.struct(b["start"], order[b["kind"]])
        return F.when(left < right, -1).when(left > right, 1).otherwise(0)

    return rows.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "base", F.array_sort(F.concat("base", extra), before).alias("spans"))


def digest(spans):
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
