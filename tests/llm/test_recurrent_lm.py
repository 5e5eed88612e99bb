"""The recurrent language model: word counts and scores against plain loops, gradients against differences, training against held-out texts."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from awkward import SF_DIR, awkward, awkward_rows, make_docs, rows, shipped  # noqa: F401

from deskmart.llm import queries, recurrent_lm
from deskmart.llm.common import stage

SMALL = recurrent_lm.Shape(classes=3, class_size=4, endings=5, hidden=5, rounds=2, every=1, windows=2)
NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]


def _held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def _counts(table):
    counts = Counter()
    for i, text in table:
        if not _held_out(i):
            counts.update([*_words(text), ""])
    return counts


def _base(table):
    """Rows without the model's score."""
    counts = _counts(table)
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, text in table:
        tokens = [*_words(text), ""]
        score = math.fsum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        out.append((i, _held_out(i), len(tokens), sum(counts[t] > 0 for t in tokens), total, score))
    return out


def _sort(rows):
    return sorted(rows, key=lambda r: (repr(r[0]), r[2], r[5]))


@pytest.mark.parametrize("known", [5, 200_000])
def test_words_and_frequencies(spark, make_docs, rows, known, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "SCORED_TOKENS", 3000)
    table = [*rows, (2**53 + 1, "ÀÉ Straße THE the x\x00y " + "w" * 200), (2**53 + 2, None), (9, " \t\n\x0b\x0c\r \x1c \xa0 　 b")]
    got = recurrent_lm.score_documents(make_docs(table, extra=True), SMALL, known_words=known)
    assert got.columns == NAMES
    for a, e in zip(_sort([tuple(r) for r in got.collect()]), _sort(_base(table)), strict=True):
        assert a[:5] == e[:5]
        assert math.isclose(a[5], e[5], rel_tol=1e-9) and a[6] < 0


def _plain_score(w, v, counts, text):
    """Token by token, gate by gate."""
    s, h = v.shape, v.shape.hidden
    symbol = dict(zip(v.words.to_pylist(), v.symbols.tolist()))
    endings = {e: i for i, e in enumerate(v.endings.to_pylist())}

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    state, last, score = [0.0] * h, 0, 0.0
    for word in [*_words(text), ""]:
        given, own = w.gates[last].tolist(), [sum(state[i] * float(w.state[i, j]) for i in range(h)) for j in range(3 * h)]
        update = [sigmoid(given[j] + own[j]) for j in range(h)]
        reset = [sigmoid(given[h + j] + own[h + j]) for j in range(h)]
        new = [math.tanh(given[2 * h + j] + reset[j] * own[2 * h + j]) for j in range(h)]
        state = [update[j] * state[j] + (1 - update[j]) * new[j] for j in range(h)]

        def share(weights, bias, column):
            logits = [sum(state[i] * float(weights[i, j]) for i in range(h)) + float(bias[j]) for j in range(len(bias))]
            return math.exp(logits[column]) / sum(map(math.exp, logits))

        x = symbol.get(word, -1)
        if x < 0:
            x = s.head + endings.get(word[-2:], s.endings - 1)
        if x < s.head:
            k = x // s.class_size
            p = share(w.outer, w.outer_bias, k) * share(w.inner[k], w.inner_bias[k], x % s.class_size)
        else:
            p = share(w.outer, w.outer_bias, s.classes + x - s.head) * (counts[word] + 0.5) / v.mass[x - s.head]
        score += math.log10(p)
        last = x
    return score


def test_scores_follow_the_weights(spark, make_docs, monkeypatch):
    table = [(i, t if t is None else t[:900]) for i, t in awkward_rows()]
    docs, shape = make_docs(table), SMALL
    counts = stage(recurrent_lm.word_counts(docs.filter(~recurrent_lm.held_out(docs["doc_id"]))), "counts")
    v = recurrent_lm.Vocabulary.gather(counts, shape, 30)
    rng = np.random.default_rng(2)
    w = recurrent_lm.Weights(*[(a + rng.normal(0, 0.5, a.shape)).astype(np.float32) if a.max() > -30 else a for a in v.weights().arrays()])
    monkeypatch.setattr(recurrent_lm, "train", lambda docs, vocabulary: w)
    got = recurrent_lm.score_documents(docs, shape, known_words=30).collect()
    plain = _counts(table)
    assert sum(v.symbols < shape.head) == shape.head and len(v.words) < len(plain)
    for i, text in table:
        wanted = _plain_score(w, v, plain, text)
        assert any(r.doc_id == i and math.isclose(r.score, wanted, rel_tol=1e-4) for r in got)


def test_probabilities_add_up():
    w, shape = _random_weights()
    states = np.random.default_rng(5).normal(0, 1, (4, shape.hidden)).astype(np.float32)
    everything = np.arange(shape.head + shape.endings)
    for s in states:
        p = recurrent_lm.log_probabilities(w, shape, np.repeat(s[None], len(everything), axis=0), everything)
        assert math.isclose(np.exp(p).sum(), 1, rel_tol=1e-5)


def _random_weights(kind=np.float32):
    shape, rng = SMALL, np.random.default_rng(4)
    h, c = shape.hidden, shape.classes + shape.endings
    sizes = [(shape.head + shape.endings, 3 * h), (h, 3 * h), (h, c), (c,), (shape.classes, h, shape.class_size), (shape.classes, shape.class_size)]
    return recurrent_lm.Weights(*[rng.normal(0, 0.6, size).astype(kind) for size in sizes]), shape


def test_gradients_are_slopes():
    w, shape = _random_weights(np.float64)
    rng = np.random.default_rng(6)
    inputs, targets = (rng.integers(0, shape.head + shape.endings, (7, 3)) for _ in range(2))
    fresh = rng.random((7, 3)) < 0.2
    start = rng.normal(0, 1, (3, shape.hidden)).astype(np.float32)

    def loss(w):
        return recurrent_lm.gradients(w, shape, inputs, targets, fresh, start)[0]

    _, grads, _ = recurrent_lm.gradients(w, shape, inputs, targets, fresh, start)
    dense = np.zeros_like(w.gates)
    dense[grads[0][0]] = grads[0][1]
    for a, g in zip(w.arrays(), [dense, *grads[1:]]):
        for at in rng.choice(a.size, min(12, a.size), replace=False):
            place, step = np.unravel_index(at, a.shape), 1e-2
            kept = a[place]
            a[place] = kept + step
            up = loss(w)
            a[place] = kept - step
            down = loss(w)
            a[place] = kept
            assert abs((up - down) / (2 * step) - g[place]) < 1e-2 + 2e-2 * abs(g[place])


def _each(w, shape, symbols, offsets):
    found = np.full(len(symbols), np.nan)
    for texts, places, logs in recurrent_lm.scored(w, shape, symbols, offsets):
        assert (np.searchsorted(offsets, places, "right") - 1 == texts).all()
        found[places] = logs
    return found


def test_state_is_carried_through_the_whole_text():
    """Texts of all lengths side by side score as each does alone, step by step; the first word still matters at the end."""
    w, shape = _random_weights()
    rng = np.random.default_rng(8)
    lengths = np.array([1, 700, 3, 90, 700, 1])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    symbols = rng.integers(0, shape.head, offsets[-1])
    together = _each(w, shape, symbols, offsets)
    for a, b in zip(offsets[:-1], offsets[1:]):
        alone = _each(w, shape, symbols[a:b], np.array([0, b - a]))
        assert np.allclose(alone, together[a:b], atol=1e-4)
    state, last = np.zeros((1, shape.hidden), np.float32), np.zeros(1, np.int64)
    a, b = offsets[1], offsets[2]
    for t in range(a, b):
        state = recurrent_lm.step(w, last, state)[0]
        assert abs(recurrent_lm.log_probabilities(w, shape, state, symbols[t : t + 1])[0] - together[t]) < 1e-4
        last = symbols[t : t + 1]


def test_training_learns_order(spark, make_docs):
    """Texts of two kinds whose words follow each other: the model learns both from the words before, frequencies cannot."""
    rng = random.Random(3)
    chains = [[f"{k}{i}" for i in range(12)] for k in "ab"]

    def text():
        words, n = rng.choice(chains), rng.randint(5, 60)
        at = rng.randrange(12)
        return " ".join(words[(at + j) % 12] for j in range(n))

    table = [(i, text()) for i in range(1500)]
    got = recurrent_lm.score_documents(make_docs(table), recurrent_lm.Shape(classes=4, class_size=8, endings=4, every=1, rounds=3)).collect()
    new = [r for r in got if r.held_out]
    assert len(new) > 200
    assert sum(r.score for r in new) > 0.6 * sum(r.base_score for r in new)
    again = recurrent_lm.score_documents(make_docs(table), recurrent_lm.Shape(classes=4, class_size=8, endings=4, every=1, rounds=3)).collect()
    assert all(math.isclose(a.score, b.score, rel_tol=1e-3) for a, b in zip(sorted(got), sorted(again), strict=True))


def test_given_table(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = queries.QUERIES["op12_recurrent_lm"](spark, SF_DIR).collect()
    for a, e in zip(_sort([tuple(r) for r in got]), _sort(_base(table)), strict=True):
        assert a[:5] == e[:5] and math.isclose(a[5], e[5], rel_tol=1e-9)
    new = [r for r in got if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)


def test_small_tables(spark, make_docs):
    assert recurrent_lm.score_documents(make_docs([])).collect() == []
    taught = next(i for i in range(100) if not _held_out(i))
    apart = next(i for i in range(100) if _held_out(i))
    for table in ([(apart, "no one teaches")], [(taught, None), (apart, "")], [(None, "x y x")]):
        got = recurrent_lm.score_documents(make_docs(table), SMALL).collect()
        for a, e in zip(_sort([tuple(r) for r in got]), _sort(_base(table)), strict=True):
            assert a[:5] == e[:5] and math.isclose(a[5], e[5], rel_tol=1e-9, abs_tol=1e-12) and math.isfinite(a[6])


def test_words_of_texts():
    texts = [t for t in awkward() if t is not None]
    words, parent = recurrent_lm.split_words(pa.array(texts))
    found = [[] for _ in texts]
    for w, p in zip(words.to_pylist(), parent):
        found[p].append(w)
    assert found == [_words(t) for t in texts]


def test_training_reads_every_text(spark, make_docs, monkeypatch):
    """By default the rounds together train on each text that is not held out, once."""
    table = [(i, f"w{i} x w{i}") for i in range(300)] + [(None, "wn x wn"), (7, None)]
    docs = make_docs(table)
    taught = docs.filter(~recurrent_lm.held_out(docs["doc_id"]))
    shape = recurrent_lm.Shape()
    v = recurrent_lm.Vocabulary.gather(stage(recurrent_lm.word_counts(taught), "counts"), shape)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches, sent):
        for batch in batches:
            seen.add(batch.num_rows)
        yield from ()

    monkeypatch.setattr(recurrent_lm, "_trained", counted)
    recurrent_lm.train(taught, v)
    assert seen.value == sum(not _held_out(i) for i, _ in table)


@pytest.mark.parametrize("n", [1, 7, 2 * 32 * 5 + 3, 1000])
def test_training_moves_by_every_token(n, monkeypatch):
    """Lanes that the tokens do not fill go on with void steps, which add nothing; no token is left out."""
    w, shape = _random_weights()
    symbols = np.random.default_rng(n).integers(0, shape.head + shape.endings, n).astype(np.int32)
    told, plain = [], recurrent_lm.gradients

    def counted(w, shape, inputs, targets, fresh, state, void):
        told.extend(targets[~void].tolist())
        found = plain(w, shape, inputs, targets, fresh, state, void)
        again = plain(w, shape, np.where(void, 3, inputs), np.where(void, 1, targets), fresh, state, void)
        assert found[0] == again[0] and all(np.array_equal(a, b) for a, b in zip(found[1][1:], again[1][1:]) if not void[:-1].any())
        return found

    monkeypatch.setattr(recurrent_lm, "gradients", counted)
    trainer = recurrent_lm.Trainer(w, shape)
    trainer.train(symbols, np.array([0, n]))
    assert trainer.tokens == n and sorted(told) == sorted(symbols.tolist())
