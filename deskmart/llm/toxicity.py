"""Toxicity: a classifier whose scores do not follow mentions of groups of people.

Features are the words of a text and their beginnings (the first four, five and six letters), each counted once, as
toxic words are often inflected or joined with others. Of a bounded sample of labelled texts the features with the
largest association with the label are kept, and a logistic regression is fitted to them. Beside each labelled sentence
that mentions an identity term stands its counterfactual, the same text with the term swapped for another of its
group; the loss penalises the squared difference of their scores, which drives the weights of such terms together
and stops neutral mentions from passing for insults.

The sample bound is a parameter; scoring covers whole texts of all rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import stage

SAMPLE_ROWS = 10_000
SAMPLE_CHARS = 64_000_000
FEATURES = 2_000
FOLDS = 5

#: Terms that mention a group without judging it; a swap replaces a term by the next of its row.
IDENTITY_TERMS = (
    ("woman", "man"),
    ("women", "men"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "transgender"),
    ("black", "white", "asian", "hispanic", "african", "european"),
    ("immigrant", "native", "refugee"),
    ("immigrants", "natives", "refugees"),
    ("old", "young"),
    ("blind", "deaf", "disabled"),
)
WORD = re.compile(r"[^\W\d_]+")


def swaps(groups: Sequence[Sequence[str]] = IDENTITY_TERMS) -> dict[str, str]:
    return {t: group[(i + 1) % len(group)] for group in groups for i, t in enumerate(group)}


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    found = set(words)
    for n in (4, 5, 6):
        found.update(w[:n] + "-" for w in words if len(w) >= n)
    return found


def counterfactual(words: set[str], swap: dict[str, str]) -> set[str]:
    return {swap.get(w, w) for w in words}


@dataclass
class Model:
    """Weights of features, and the constant."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        """Between 0 and 1; a text without known features, empty or NULL, gets the constant's score."""
        known = features_of(words_of(text)) & self.weights.keys()
        z = self.bias + sum(self.weights[f] for f in sorted(known))  # sorted: sums do not depend on the process
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit(
    texts: Sequence[str | None],
    labels: Sequence[int],
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
    n_features: int = FEATURES,
    l1: float = 3e-4,
    penalty: float = 10.0,
    steps: int = 500,
    min_share: float = 0.002,
) -> Model:
    """Logistic regression with equal weight of both classes, an ``l1`` norm and the counterfactual ``penalty``, by Adam's method.

    The norm keeps features that many toxic texts support; a word that only copies of one text share gets no weight. Features of less than
    ``min_share`` of the texts of a class are left out from the start.
    """
    y = np.asarray(labels, float)
    if len(y) == 0 or y.min() == y.max():
        rate = (float(y.sum()) + 0.5) / (len(y) + 1) if len(y) else 0.25
        return Model({}, float(np.log(rate / (1 - rate))))
    seen = (Counter(), Counter())
    for text, label in zip(texts, y, strict=True):
        seen[int(label)].update(features_of(words_of(text)))
    n1, n0 = y.sum(), len(y) - y.sum()
    strength = {}
    for f in {*seen[0], *seen[1]}:
        a, b = seen[1][f], seen[0][f]
        if max(a / n1, b / n0) >= min_share and a + b >= 3:
            p, q = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1)
            share = (a + b + 1) / (n1 + n0 + 2)
            strength[f] = abs(p - q) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    best = sorted(strength, key=lambda f: (-strength[f], f))[:n_features]
    at = {f: i for i, f in enumerate(best)}
    swap = swaps(groups)

    def rows(sets: Iterator[set[str]]) -> tuple[np.ndarray, np.ndarray]:
        r, c = [], []
        for i, words in enumerate(sets):
            own = sorted(at[f] for f in features_of(words) if f in at)
            r += [i] * len(own)
            c += own
        return np.array(r, np.int64), np.array(c, np.int64)

    r, c = rows(words_of(t) for t in texts)
    pair = [i for i, t in enumerate(texts) if not words_of(t).isdisjoint(swap)]
    r2, c2 = rows(counterfactual(words_of(texts[i]), swap) for i in pair)
    pair = np.array(pair, np.int64)
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    w, speed, size = (np.zeros(len(best) + 1) for _ in range(3))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(r, w[c], len(y)) + w[-1], -50, 50)))
        own = weight * (p - y)
        grad = np.zeros(len(w))
        if len(pair):
            q = 1 / (1 + np.exp(-np.clip(np.bincount(r2, w[c2], len(pair)) + w[-1], -50, 50)))
            gap = 2 * penalty * (p[pair] - q) / len(pair)
            own[pair] += gap * p[pair] * (1 - p[pair])
            other = -gap * q * (1 - q)
            grad += np.append(np.bincount(c2, other[r2], len(best)), other.sum())
        grad += np.append(np.bincount(c, own[r], len(best)), own.sum())
        speed = 0.9 * speed + 0.1 * grad
        size = 0.99 * size + 0.01 * grad * grad
        rate = 0.05 / (np.sqrt(size / (1 - 0.99**step)) + 1e-6)
        w -= rate * speed / (1 - 0.9**step)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - rate[:-1] * l1, 0)
    return Model({f: float(w[i]) for f, i in at.items() if w[i]}, float(w[-1]))


def held_out(doc_id):
    """Rows kept from training: the CRC-32 of the id as text is divisible by ``FOLDS``; a NULL id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == 0


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a sample of rows of ``docs(doc_id, text)`` with a label in ``labels(doc_id, toxic)``, held-out ones left out.

    The sample has at most ``sample_rows`` whole texts, half of them toxic if there are as many, and of these, in the order of a hash
    of their ids, each that ``sample_chars`` characters still have room for. Rows with a NULL label or id teach nothing; of an id with
    several labels the largest counts, of one with several texts that with the smallest hash, so the order of the rows does not matter.
    """
    marks = labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    picked = None
    for label in (1, 0):
        part = marks.filter(F.col("toxic") == label).orderBy(order, "doc_id").limit(sample_rows // 2)
        picked = part if picked is None else picked.union(part)
    # At most `sample_rows` ids: the bound of this broadcast is the parameter.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic")).alias("first")
    rows = rows.groupBy("doc_id").agg(first).select(order.alias("place"), "doc_id", "first.text", "first.toxic")
    rows = stage(rows, "toxicity-sample")
    total, kept = 0, []
    for r in rows.select("place", "doc_id", F.char_length("text").alias("n")).orderBy("place", "doc_id").collect():
        if total + (r.n or 0) <= sample_chars:
            total += r.n or 0
            kept.append((r.doc_id,))
    wanted = F.broadcast(docs.sparkSession.createDataFrame(kept, rows.select("doc_id").schema))
    taken = rows.join(wanted, "doc_id").orderBy("place", "doc_id").collect()
    return fit([r.text for r in taken], [r.toxic for r in taken])


def score_column(docs: DataFrame, model: Model):
    """Score of the text column ``text`` by ``model``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(t) for t in batch], dtype="float64")

    return score(docs["text"].cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text)``.

    Empty and NULL texts get the constant's score. Repeated rows get equal scores; an empty table gives no rows; without
    labels every score is below one half. Further columns are ignored and never reach the classifier.
    """
    scored = docs.select("doc_id", score_column(docs, train(docs, labels, sample_rows)).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
