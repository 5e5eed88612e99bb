"""A gated recurrent language model over words, in numpy, with a class-factored output.

The probability of a word is that of its class, given the state, times that of the word inside its class. The most frequent words fill
classes of equal size, and inside these the state decides as well. All other words, known or not, belong to classes by
their endings, and inside these the counts of the whole training corpus decide; so every text has a probability, and the counts of all words go into it.

Weights start as the word frequencies of the corpus. In each round, every task trains a copy on its share of the texts by truncated backpropagation,
and Spark averages the copies. Scores carry the state through a whole document, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import arrow_schema, chunks, frequent_floor, ship, stage
from deskmart.operators.skew import HotKeys

CHUNK_BYTES = 4 << 20  # of text split into words at once; a longer document is a chunk of its own
SCORED_TOKENS = 3_000_000  # whose texts advance side by side
KNOWN_WORDS = 300_000  # most frequent words, sent to all tasks; the others are joined
LONGEST_KNOWN = 64  # bytes; bounds what is sent
KEPT_WORDS = 500_000  # distinct words that a task counts before it hands them over
OUTPUT_ROWS = 1 << 13  # states whose outputs are computed together
BLOCK = 1 << 10  # of them whose classes are computed at once, so that they stay in the processor's cache
END = ""  # the token after the last word


@dataclass(frozen=True)
class Shape:
    """Sizes of the model and of its training."""

    classes: int = 32  # of frequent words
    class_size: int = 64
    endings: int = 64  # classes of all other words; the last of them takes what no ending takes
    hidden: int = 16
    window: int = 32  # steps through which errors flow back
    lanes: int = 256  # texts trained side by side, at most
    windows: int = 32  # that a pass over few texts has at least, by fewer lanes
    rounds: int = 3
    every: int = 1  # one of so many training texts fits the weights; 1: all of them
    rate: float = 0.05
    start: float = 1e-6  # of the sums of squared gradients

    @property
    def head(self) -> int:
        return self.classes * self.class_size


def _symbol_type(shape: Shape) -> type:
    return np.int16 if shape.head + shape.endings < 1 << 15 else np.int32


# Words


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, A-Z lower-cased, and the index of each one's text."""
    listed = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, parent = listed.flatten(), pc.list_parent_indices(listed)
    told = pc.greater(pc.binary_length(words), 0)
    return words.filter(told), parent.filter(told).to_numpy().astype(np.int64)


def ending(words: pa.Array) -> pa.Array:
    return pc.utf8_slice_codeunits(words, start=-2)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of words and ends of texts."""
    empty = pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    kept = empty

    def merged(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["word", "n"])

    for chunk in chunks(batches, CHUNK_BYTES):
        words, _ = split_words(chunk["text"].combine_chunks())
        seen = pc.value_counts(words)
        kept = merged([kept, pa.table({"word": seen.field(0), "n": seen.field(1)}), pa.table({"word": [END], "n": pa.array([len(chunk)], pa.int64())})])
        if len(kept) > KEPT_WORDS:
            yield from kept.to_batches()
            kept = empty
    yield from kept.to_batches()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c``: how often each word stands in ``docs(text)``; the empty word counts the texts."""
    partial = docs.select(docs["text"].cast("string").alias("text")).mapInArrow(_counted, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("c"))


# The vocabulary


@dataclass
class Vocabulary:
    """Known words with their counts and symbols; symbols below ``shape.head`` are frequent words, the others classes of endings."""

    shape: Shape
    words: pa.Array
    counts: np.ndarray
    symbols: np.ndarray
    endings: pa.Array  # of the classes, without the last
    mass: np.ndarray  # per class of endings: counts of its words, and half for each and for one more
    total: int
    distinct: int

    @classmethod
    def gather(cls, counts: DataFrame, shape: Shape, known_words: int = KNOWN_WORDS) -> Vocabulary:
        """From ``counts(word, c)``, all of them; at most ``known_words`` words of bounded length and the classes reach the driver."""
        total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        short = counts.filter(F.octet_length("word") <= LONGEST_KNOWN)
        least = frequent_floor(short, "c", known_words)
        first = {r.word: r.c for r in short.orderBy(F.col("c").desc(), "word").limit(shape.head).collect()}
        head = list(first)
        if END in head:
            head.remove(END)
        head = [END, *head][: shape.head]
        table = short.filter((F.col("c") >= least) | F.col("word").isin(END)).toArrow()
        # A head word may be rarer than the bound; END is there even without any training text.
        known = {END: 0} | dict(zip(table["word"].to_pylist(), table["c"].to_pylist(), strict=True)) | {w: first[w] for w in head if w in first}
        tail = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(w,) for w in head], "word string")), "word", "left_anti")
        by_ending = tail.groupBy(F.when(F.char_length("word") > 2, F.expr("right(word, 2)")).otherwise(F.col("word")).alias("ending"))
        by_ending = stage(by_ending.agg(F.sum("c").alias("c"), F.count("*").alias("v")), "lm-endings")
        top = by_ending.orderBy(F.col("c").desc(), "ending").limit(shape.endings - 1).collect()
        c, v = by_ending.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
        sums = [(r.c, r.v) for r in top] + [(0, 0)] * (shape.endings - 1 - len(top))
        sums.append((c - sum(s[0] for s in sums), v - sum(s[1] for s in sums)))
        words = sorted(known)
        endings = pa.array([r.ending for r in top], pa.string())
        place = {w: i for i, w in enumerate(head)}
        arrow = pa.array(words, pa.string())
        symbols = np.array([place.get(w, -1) for w in words], np.int32)
        symbols = np.where(symbols < 0, shape.head + _class_of(arrow, endings, shape), symbols).astype(np.int32)
        mass = np.array([n + 0.5 * (k + 1) for n, k in sums])
        mass[len(top) : shape.endings - 1] = 0.0  # no word ends so
        return cls(shape, arrow, np.array([known[w] for w in words], np.int64), symbols, endings, mass, total, distinct)

    def weights(self) -> Weights:
        """The frequencies of the corpus, and small random numbers elsewhere."""
        s, rng = self.shape, np.random.default_rng(17)
        counts = np.full(s.head, -0.5)
        at = self.symbols < s.head
        counts[self.symbols[at]] = self.counts[at]
        prior = (counts + 0.5).reshape(s.classes, s.class_size)
        per_class = np.concatenate([prior.sum(axis=1), self.mass])
        with np.errstate(divide="ignore"):
            # Places without a word get no probability worth naming, but stay finite.
            inner = np.maximum(np.log(prior / np.maximum(prior.sum(axis=1, keepdims=True), 1e-9)), -40)
            outer = np.maximum(np.log(per_class / per_class.sum()), -40)
        h, c = s.hidden, s.classes + s.endings
        return Weights(
            rng.normal(0, 0.1, (s.head + s.endings, 3 * h)).astype(np.float32),
            rng.normal(0, h**-0.5, (h, 3 * h)).astype(np.float32),
            np.zeros((h, c), np.float32),
            outer.astype(np.float32),
            np.zeros((s.classes, h, s.class_size), np.float32),
            inner.astype(np.float32),
        )

    def encode(self, texts: pa.Array) -> Encoded:
        """Symbols of all tokens, the end of each text included."""
        words, parent = split_words(texts)
        at = pc.index_in(words, value_set=self.words)
        rare = pc.is_null(at).to_numpy(zero_copy_only=False)
        known = at.fill_null(0).to_numpy()
        symbol = np.where(rare, 0, self.symbols[known]).astype(np.int32)
        count = np.where(rare, 0, self.counts[known])
        unknown = words.filter(pa.array(rare))
        symbol[rare] = self.shape.head + _class_of(unknown, self.endings, self.shape)
        n = len(texts)
        lengths = np.bincount(parent, minlength=n) + 1
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        place, ends = np.arange(len(symbol)) + parent, offsets[1:] - 1
        all_symbols, all_counts, all_rare = np.zeros(offsets[-1], np.int32), np.full(offsets[-1], self.count_of_end), np.zeros(offsets[-1], bool)
        all_symbols[place], all_counts[place], all_rare[place] = symbol, count, rare
        all_symbols[ends] = 0
        return Encoded(all_symbols, offsets, all_counts, all_rare, unknown, parent[rare])

    @property
    def count_of_end(self) -> int:
        return int(self.counts[0])  # the empty word sorts first


@dataclass
class Encoded:
    symbols: np.ndarray
    offsets: np.ndarray
    counts: np.ndarray
    rare: np.ndarray  # tokens whose count is not known here
    unknown: pa.Array  # their words
    unknown_text: np.ndarray


def _class_of(words: pa.Array, endings: pa.Array, shape: Shape) -> np.ndarray:
    found = pc.index_in(ending(words), value_set=endings)
    return found.fill_null(shape.endings - 1).to_numpy().astype(np.int32)


# The network


@dataclass
class Weights:
    """``gates``: what each symbol adds to the three gates; ``state``: what the state adds; then class and word outputs."""

    gates: np.ndarray
    state: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.gates, self.state, self.outer, self.outer_bias, self.inner, self.inner_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def like(self, flat: np.ndarray) -> Weights:
        parts, at = [], 0
        for a in self.arrays():
            parts.append(flat[at : at + a.size].reshape(a.shape).astype(a.dtype))
            at += a.size
        return Weights(*parts)

    def copy(self) -> Weights:
        return Weights(*[a.copy() for a in self.arrays()])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def step(w: Weights, symbols: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state, and what its errors need: update gate, reset gate, candidate, the state's part of it."""
    return _step(w, w.gates[symbols], state)


def _step(w: Weights, given: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    h = state.shape[1]
    own = state @ w.state
    gate = _sigmoid(given[:, : 2 * h] + own[:, : 2 * h])
    update, reset = gate[:, :h], gate[:, h:]
    candidate = np.tanh(given[:, 2 * h :] + reset * own[:, 2 * h :])
    return candidate + update * (state - candidate), update, reset, candidate, own[:, 2 * h :]


def _logits(weights: np.ndarray, bias: np.ndarray, states: np.ndarray) -> np.ndarray:
    """A row per output, a column per state."""
    x = weights.T @ states.T
    x += bias[:, None]
    return x


def _softmax(x: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of one row per column, and all probabilities, in the place of ``x``."""
    x -= x.max(axis=0)
    at = x[row, np.arange(x.shape[1])]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    x /= total
    return at - np.log(total), x


def _log_softmax(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Log-probability of one row per column; ``x`` is overwritten."""
    x -= x.max(axis=0)
    at = x[row, np.arange(x.shape[1])]
    np.exp(x, out=x)
    return at - np.log(x.sum(axis=0))


def _by_class(shape: Shape, targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Class of each target, and for each class of frequent words where its targets stand."""
    group = np.where(targets < shape.head, targets // shape.class_size, targets - (shape.head - shape.classes))
    order = np.argsort(group.astype(np.int16), kind="stable")
    bounds = np.searchsorted(group[order], np.arange(shape.classes + 1))
    return group, [(k, order[bounds[k] : bounds[k + 1]]) for k in range(shape.classes) if bounds[k] < bounds[k + 1]]


def log_probabilities(w: Weights, shape: Shape, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities of ``targets`` (a word, or a class of endings as a whole) after ``states``."""
    group, members = _by_class(shape, targets)
    found = np.empty(len(targets))
    for at in (slice(i, i + BLOCK) for i in range(0, len(targets), BLOCK)):
        found[at] = _log_softmax(_logits(w.outer, w.outer_bias, states[at]), group[at])
    for k, at in members:
        found[at] += _log_softmax(_logits(w.inner[k], w.inner_bias[k], states[at]), targets[at] % shape.class_size)
    return found


def scored(w: Weights, shape: Shape, symbols: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts, places and natural log-probabilities of all tokens, each given all before it in its text.

    All texts advance side by side, longest first, so those that still go on are the first.
    """
    order = np.argsort(-np.diff(offsets), kind="stable")
    begin, length = offsets[:-1][order], np.diff(offsets)[order]
    state = np.zeros((len(order), shape.hidden), np.float32)
    last = np.zeros(len(order), np.int64)  # the end of a text stands before the first word of each
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held, active = 0, len(order)
    for t in range(int(length[0]) if len(length) else 0):
        while length[active - 1] <= t:
            active -= 1
        state = step(w, last[:active], state[:active])[0]
        places = begin[:active] + t
        waiting.append((order[:active], places, state))
        last = symbols[places]
        held += active
        if held >= OUTPUT_ROWS or t + 1 == length[0]:
            texts, at, states = (np.concatenate(x) for x in zip(*waiting, strict=True))
            yield texts, at, log_probabilities(w, shape, states, symbols[at])
            waiting.clear()
            held = 0


def gradients(
    w: Weights, shape: Shape, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, state: np.ndarray, void: np.ndarray | None = None
) -> tuple[float, list, np.ndarray]:
    """Loss and gradients over one window of (steps, lanes), and the state after it.

    ``fresh`` marks steps at which a text begins, where the state starts anew; ``void`` marks those that hold no token and teach nothing. Errors flow back
    to the start of the window. The gradient of ``gates`` comes as (symbols, rows).
    """
    steps, lanes = inputs.shape
    h = shape.hidden
    given, begins = w.gates[inputs], fresh.any(axis=1)
    befores, candidates, owns, states = (np.empty((steps, lanes, h), np.float32) for _ in range(4))
    gates = np.empty((steps, lanes, 2 * h), np.float32)
    for t in range(steps):
        if begins[t]:
            state = np.where(fresh[t][:, None], np.float32(0), state)
        befores[t] = state
        state, gates[t, :, :h], gates[t, :, h:], candidates[t], owns[t] = _step(w, given[t], state)
        states[t] = state
    flat, wanted = states.reshape(-1, h), targets.ravel()
    told = None if void is None or not void.any() else ~void.ravel()
    n, loss = len(wanted), 0.0
    group, members = _by_class(shape, wanted)
    d_outer, d_outer_bias = np.zeros_like(w.outer), np.zeros_like(w.outer_bias)
    d_states = np.empty((n, h), np.float32)
    for at in (slice(i, i + BLOCK) for i in range(0, n, BLOCK)):
        logs, wrong = _softmax(_logits(w.outer, w.outer_bias, flat[at]), group[at])
        wrong[group[at], np.arange(len(logs))] -= 1
        if told is not None:
            logs, wrong = logs * told[at], wrong * told[at]
        loss -= float(logs.sum())
        d_outer += (wrong @ flat[at]).T
        d_outer_bias += wrong.sum(axis=1)
        d_states[at] = (w.outer @ wrong).T
    d_inner, d_inner_bias = np.zeros_like(w.inner), np.zeros_like(w.inner_bias)
    for k, at in members:
        own, column = flat[at], wanted[at] % shape.class_size
        logs, wrong = _softmax(_logits(w.inner[k], w.inner_bias[k], own), column)
        wrong[column, np.arange(len(at))] -= 1
        if told is not None:
            logs, wrong = logs * told[at], wrong * told[at]
        loss -= float(logs.sum())
        d_inner[k], d_inner_bias[k] = (wrong @ own).T, wrong.sum(axis=1)
        d_states[at] += (w.inner[k] @ wrong).T
    d_states = d_states.reshape(steps, lanes, h)
    # What does not depend on later errors, for all steps at once.
    update, reset = gates[:, :, :h], gates[:, :, h:]
    to_update = (befores - candidates) * update * (1 - update)
    to_candidate = (1 - update) * (1 - candidates * candidates)
    to_reset = owns * reset * (1 - reset)
    d_candidates, d_own = np.empty((steps, lanes, h), np.float32), np.empty((steps, lanes, 3 * h), np.float32)
    later, back = np.zeros((lanes, h), np.float32), np.ascontiguousarray(w.state.T)
    for t in reversed(range(steps)):
        d, d_candidate, own = d_states[t] + later, d_candidates[t], d_own[t]
        np.multiply(d, to_candidate[t], out=d_candidate)
        np.multiply(d, to_update[t], out=own[:, :h])
        np.multiply(d_candidate, to_reset[t], out=own[:, h : 2 * h])
        np.multiply(d_candidate, reset[t], out=own[:, 2 * h :])
        later = d * update[t] + own @ back
        if begins[t]:
            later = np.where(fresh[t][:, None], np.float32(0), later)
    d_state = befores.reshape(-1, h).T @ d_own.reshape(-1, 3 * h)
    d_own[:, :, 2 * h :] = d_candidates  # the gates take the candidate's error before its reset
    rows = d_own.reshape(-1, 3 * h)
    by_symbol = np.argsort(inputs.ravel().astype(_symbol_type(shape)), kind="stable")  # two bytes sort by radix
    symbols = inputs.ravel()[by_symbol]
    first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    d_rows = np.add.reduceat(rows[by_symbol], first, axis=0)
    return loss, [(symbols[first], d_rows), d_state, d_outer, d_outer_bias, d_inner, d_inner_bias], state


class Trainer:
    """Adagrad over windows of lanes that run through the texts one after the other."""

    def __init__(self, w: Weights, shape: Shape):
        self.w, self.shape = w.copy(), shape
        self.seen = [np.full_like(a, self.shape.start) for a in self.w.arrays()]
        self.tokens = 0

    def _move(self, grads: list) -> None:
        rate = self.shape.rate
        for a, g, seen in zip(self.w.arrays(), grads, self.seen, strict=True):
            if isinstance(g, tuple):
                rows, g = g
                seen[rows] += g * g
                a[rows] -= rate * g / np.sqrt(seen[rows])
            else:
                seen += g * g
                a -= rate * g / np.sqrt(seen)

    def train(self, symbols: np.ndarray, offsets: np.ndarray) -> float:
        """One pass over all tokens of the texts; where they do not fill the last lane, void steps do. Returns the loss a token."""
        s, n = self.shape, len(symbols)
        if not n:
            return 0.0
        lanes = max(1, min(s.lanes, n // (s.window * s.windows)))
        steps = -(-n // lanes)
        fresh = np.zeros(n, bool)
        fresh[offsets[:-1]] = True
        inputs = np.where(fresh, 0, np.append(0, symbols[:-1]))
        more = lanes * steps - n
        void = np.arange(n + more) >= n
        inputs, targets, fresh, void = (np.append(x, np.zeros(n + more - len(x), x.dtype)).reshape(lanes, steps).T for x in (inputs, symbols, fresh, void))
        state, loss = np.zeros((lanes, s.hidden), np.float32), 0.0
        for t in range(0, steps, s.window):
            part = slice(t, t + s.window)
            told, grads, state = gradients(self.w, s, inputs[part], targets[part], fresh[part], state, void[part])
            scale = 1.0 / max(1, np.count_nonzero(~void[part]))
            self._move([(g[0], g[1] * scale) if isinstance(g, tuple) else g * scale for g in grads])
            loss += told
        self.tokens += n
        return loss / n


# Over the corpus


def _trained(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Weights after training on the rows of a task, times the number of its tokens."""
    vocabulary, start = sent.value
    trainer = Trainer(start, vocabulary.shape)
    for chunk in chunks(batches, CHUNK_BYTES):
        if len(chunk):
            told = vocabulary.encode(chunk["text"].combine_chunks())
            trainer.train(told.symbols, told.offsets)
    if trainer.tokens:
        flat = trainer.w.flat().astype(np.float64) * trainer.tokens
        yield pa.RecordBatch.from_pydict({"i": np.arange(len(flat), dtype=np.int32), "v": flat, "n": np.full(len(flat), trainer.tokens)})


def train(docs: DataFrame, vocabulary: Vocabulary) -> Weights:
    """Weights fitted on all rows of ``docs(doc_id, text)``: each round has its own rows, by hash, its tasks start alike, their results are averaged.

    A task a core trains a copy, so copies grow with the cluster and rows with the corpus. Only averages reach the driver.
    """
    spark, shape = docs.sparkSession, vocabulary.shape
    w = vocabulary.weights()
    lot = F.pmod(F.xxhash64(docs["doc_id"], docs["text"]), F.lit(shape.rounds * shape.every))
    for r in range(shape.rounds):
        sent = spark.sparkContext.broadcast((vocabulary, w))
        rows = docs.filter(lot == r).select(docs["text"].cast("string").alias("text")).coalesce(spark.sparkContext.defaultParallelism)
        copies = rows.mapInArrow(lambda b, sent=sent: _trained(b, sent), "i int, v double, n long")
        mean = copies.groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).toArrow()  # a row per weight
        if len(mean):
            flat = np.empty(len(mean))
            flat[mean["i"].to_numpy()] = mean["v"].to_numpy()
            w = w.like(flat)
        sent.destroy()
    return w


def _split(chunk: pa.Table, vocabulary: Vocabulary) -> tuple[dict[str, pa.Array], np.ndarray, np.ndarray]:
    """Columns of the result that need no model, with what counts add to the score as ``model``; the symbols, and the lengths of the texts."""
    n, shape = len(chunk), vocabulary.shape
    told = vocabulary.encode(chunk["text"].combine_chunks())
    own = np.log10(told.counts + 0.5)
    own[told.rare] = 0.0  # their counts are joined
    tail = told.symbols >= shape.head
    inner = np.log10(np.maximum(vocabulary.mass, 1e-300))
    more = np.where(tail, own - inner[np.where(tail, told.symbols - shape.head, 0)], 0.0)
    first = told.offsets[:-1]
    rare = pa.table({"text": told.unknown_text, "word": told.unknown}).group_by(["text", "word"], use_threads=False).aggregate([("word", "count")])
    rare = rare.sort_by("text")
    bounds = pa.array(np.searchsorted(rare["text"].to_numpy(), np.arange(n + 1)), pa.int32())
    columns = {c: chunk[c].combine_chunks() for c in ("row", "doc_id", "held_out")} | {
        "n_tokens": pa.array(np.diff(told.offsets)),
        "n_known": pa.array(np.add.reduceat((told.counts > 0) & ~told.rare, first, dtype=np.int64)),
        "base": pa.array(np.add.reduceat(own, first)),
        "model": pa.array(np.add.reduceat(more, first)),
        "words": pa.ListArray.from_arrays(bounds, rare["word"].combine_chunks()),
        "times": pa.ListArray.from_arrays(bounds, rare["word_count"].combine_chunks()),
    }
    return columns, told.symbols.astype(_symbol_type(shape)), np.diff(told.offsets)


def _scores(batches: Iterator[pa.RecordBatch], sent, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    vocabulary, w = sent.value
    waiting, held = [], 0

    def out() -> Iterator[pa.RecordBatch]:
        symbols, lengths = (np.concatenate([x[i] for x in waiting]) for i in (1, 2))
        sums = np.zeros(len(lengths))
        for texts, _, logs in scored(w, vocabulary.shape, symbols, np.concatenate([[0], np.cumsum(lengths)])):
            sums += np.bincount(texts, logs, minlength=len(sums))
        at = 0
        for columns, _, own in waiting:
            columns["model"] = pc.add(columns["model"], pa.array(sums[at : at + len(own)] / np.log(10)))
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)
            at += len(own)
        waiting.clear()

    for chunk in chunks(batches, CHUNK_BYTES):
        if len(chunk):
            waiting.append(_split(chunk, vocabulary))
            held += len(waiting[-1][1])
        if held >= SCORED_TOKENS:
            yield from out()
            held = 0
    if waiting:
        yield from out()


def held_out(doc_id: Column) -> Column:
    """Rows that teach nothing: crc32 of the id as text leaves 1 when divided by 5. A NULL id teaches."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score_documents(docs: DataFrame, shape: Shape = Shape(), known_words: int = KNOWN_WORDS) -> DataFrame:
    """Log-probabilities, base 10, of each whole text of ``docs(doc_id, text)`` and its end.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: the score of the model and that of smoothed word frequencies, both learnt from the rows not held out.
    NULL texts count as empty and have one token, the end. Rows with equal or NULL ids are scored one by one. An empty table gives no rows;
    without any training row the frequencies are the smoothing alone. Further columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), docs["doc_id"].alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"),
        docs["text"].cast("string").alias("text"),
    )
    taught = rows.filter(~F.col("held_out"))
    counts = stage(word_counts(taught), "lm-counts")
    vocabulary = Vocabulary.gather(counts, shape, known_words)
    w = train(taught, vocabulary)

    kind = docs.schema["doc_id"].dataType.simpleString()
    layout = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, words array<string>, times array<long>"
    schema = arrow_schema(spark, layout)
    sent = spark.sparkContext.broadcast((vocabulary, w))
    found = stage(rows.mapInArrow(lambda batches: _scores(batches, sent, schema), layout), "lm-scores")
    rare = found.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("n"))
    hot = HotKeys.find(rare, [("word",)])
    told = hot.left_join(rare, counts, ["word"])
    c = F.coalesce("c", F.lit(0))
    rest = told.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(c + 0.5)).alias("_rest"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("_known")
    )
    joined = found.drop("words", "times").join(rest, "row", "left")
    scale = float(np.log10(vocabulary.total + 0.5 * (vocabulary.distinct + 1)))
    more = F.coalesce("_rest", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )

