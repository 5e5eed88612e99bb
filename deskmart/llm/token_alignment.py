"""Alignment of two tokenizers over whole texts, as an Arrow pipeline whose partial counts Spark merges.

Inside a task, batches stay Arrow tables from text to counts. Token lists are flattened with the index of their document; sums of token lengths, cut at
document borders, give the byte at which every token ends; a hash join on (document, end) finds the ends that both tokenizers
share; running sums over them number the groups between shared ends; a second join on the group pairs its ids. ``group_by`` counts the
pairs of a document and the documents of a pair in the task, Spark adds these up over the corpus.

Texts are cut at single spaces between other characters, where neither tokenizer can join across, and each distinct cutting of a batch is encoded once.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import arrow_schema, chunks, frequent_floor, ship, stage

CHUNK_BYTES = 12 << 20  # of text cut and encoded at once; a longer document is a chunk of its own
ALIGNED_TOKENS = 400_000  # of the first vocabulary, aligned at once
ENCODED = 20_000  # cuttings handed to a tokenizer at once
PAIR_ROWS = 2_000_000  # of paired ids made at once
KEPT_PAIRS = 1_000_000  # distinct pairs that a task counts before it hands them over
HEAD_PAIRS = 1_000_000  # most frequent pairs, looked up from a broadcast table
SPACE = "▁"  # stands for a space in the pieces of the second tokenizer
# Next to these characters, white space or invisible, a space may belong to a longer token.
_ODD = r"\x{0}-\x{20}\x{7f}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2064}\x{2581}\x{3000}\x{feff}"


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable Latin-1 as itself, the others counted up from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level vocabulary file; texts are encoded as they are, special tokens in them as plain text."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(content.decode())
        self._tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.tokens[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        split = json.loads(content).get("pre_tokenizer") or {}
        #: Whether words split off before merging begin at a space and never hold one inside.
        self.cut_at_spaces = split.get("type") == "ByteLevel" and split.get("use_regex", True)

    def encode(self, texts: list[str]) -> list[list[int]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        return [e.ids for e in self._tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A piece model, which writes a space before every text."""

    def __init__(self, content: bytes):
        import sentencepiece

        self._processor = p = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.tokens = [bytes([int(n[3:-1], 16)]) if p.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.cut_at_spaces = not any(SPACE in n.lstrip(SPACE) for n in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._processor.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Tokenizers:
    """Contents of the two files, as sent to the tasks."""

    first: bytes
    second: bytes

    @classmethod
    def load(cls, byte_level: str, pieces: str) -> Tokenizers:
        return cls(Path(byte_level).read_bytes(), Path(pieces).read_bytes())


@lru_cache(maxsize=2)
def _built(kind: type, content: bytes):
    made = kind(content)
    made.bytes_of = pa.array(made.tokens, pa.binary())
    made.length = np.array([len(t) for t in made.tokens], np.int64)
    made.name_of = pa.array([str(i) for i in range(len(made.tokens))])
    return made


def _encoded(tokenizer: ByteLevel | Pieces, texts: list[str]) -> pa.ListArray:
    """Lists of ids, made in parts so that the tokenizer's own records of a text do not pile up."""
    parts = [pa.array([], pa.list_(pa.int32()))]
    for i in range(0, len(texts), ENCODED):
        lists = tokenizer.encode(texts[i : i + ENCODED])
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in lists])]).astype(np.int32)
        ids = np.fromiter(chain.from_iterable(lists), np.int32, offsets[-1])
        parts.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)))
    return pa.concat_arrays(parts)


def cut(texts: pa.Array, at_spaces: bool) -> tuple[pa.Array, np.ndarray]:
    """Cuttings of the texts and the index of each one's text; joined by single spaces they are the texts again."""
    if not at_spaces:
        return texts, np.arange(len(texts))
    words = pc.split_pattern(texts, " ")
    flat, parent = words.flatten(), pc.list_parent_indices(words).to_numpy()
    begins = pc.match_substring_regex(flat, f"^[^{_ODD}]").to_numpy(zero_copy_only=False)
    ends = pc.match_substring_regex(flat, f"[^{_ODD}]$").to_numpy(zero_copy_only=False)
    first = np.ones(len(flat), bool)
    first[1:] = (parent[1:] != parent[:-1]) | (begins[1:] & ends[:-1])
    if first.all():
        return flat, parent
    start = np.flatnonzero(first)
    runs = pa.ListArray.from_arrays(pa.array(np.append(start, len(flat)), pa.int32()), flat)
    return pc.binary_join(runs, " "), parent[start]


@dataclass
class Tokens:
    """Tokens of consecutive texts per tokenizer: ids and the index of their text; none for texts that the tokens do not spell."""

    once: tuple[pa.ListArray, pa.ListArray]  # ids of each distinct cutting
    index: pa.Array  # the distinct cutting of each cutting
    parent: np.ndarray  # its text

    def slices(self, n: int) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
        """First and last text, and the tokens between, in slices of about :data:`ALIGNED_TOKENS`; texts are counted from the first."""
        made = np.concatenate([[0], np.cumsum(pc.list_value_length(self.once[0]).to_numpy()[self.index.to_numpy()])])
        bounds = np.searchsorted(self.parent, np.arange(n + 1))
        before, first = made[bounds], 0
        while first < n:
            last = max(first + 1, int(np.searchsorted(before, before[first] + ALIGNED_TOKENS, "right")) - 1)
            low, high = bounds[first], bounds[last]
            sides = []
            for tokens in self.once:
                taken = tokens.take(self.index.slice(low, high - low))
                inner = pc.list_parent_indices(taken).to_numpy()
                sides.append((taken.flatten().to_numpy(), self.parent[low:high][inner] - first))
            yield first, last, sides
            first = last


def tokenize(texts: pa.Array, a: ByteLevel, b: Pieces) -> Tokens:
    cuttings, parent = cut(texts, a.cut_at_spaces and b.cut_at_spaces)
    coded = pc.dictionary_encode(cuttings)
    spaced = pc.binary_join_element_wise("", coded.dictionary, " ")
    once = _encoded(a, spaced.to_pylist()), _encoded(b, coded.dictionary.to_pylist())
    lost = np.zeros(len(spaced), bool)
    for side, tokens in zip((a, b), once, strict=True):
        spelt = pc.binary_join(pa.ListArray.from_arrays(tokens.offsets, side.bytes_of.take(tokens.values)), b"")
        lost |= pc.not_equal(spelt, spaced.cast(pa.binary())).to_numpy(zero_copy_only=False)
    out_of = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).copy()
    out_of[parent[lost[coded.indices.to_numpy()]]] = True  # the whole text has no tokens then
    kept = ~out_of[parent]
    return Tokens(once, coded.indices.filter(pa.array(kept)), parent[kept])


def _token_ends(ids: np.ndarray, text: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Byte at which each token ends in its text: a running sum that starts anew with every text."""
    running = pc.cumulative_sum(pa.array(length[ids])).to_numpy()
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    before = np.concatenate([[0], running])[first]
    return running - np.repeat(before, np.diff(np.append(first, len(text))))


def _groups(a_ends: np.ndarray, a_text: np.ndarray, b_ends: np.ndarray, b_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each token's group, counted over all texts: a group ends where tokens of both sides end.

    The key of the join is the document and the byte in one number.
    """
    far = max(int(a_ends.max(initial=0)), int(b_ends.max(initial=0))) + 1
    a = pa.table({"document_end": a_text * far + a_ends, "a": np.arange(len(a_ends))})
    b = pa.table({"document_end": b_text * far + b_ends, "b": np.arange(len(b_ends))})
    shared = a.join(b, "document_end", join_type="inner", use_threads=False)
    numbers = []
    for side, n in (("a", len(a_ends)), ("b", len(b_ends))):
        closes = np.zeros(n, np.int64)
        closes[shared[side].to_numpy()] = 1
        numbers.append(pc.cumulative_sum(pa.array(closes)).to_numpy() - closes)
    return numbers[0], numbers[1]


def _counted(group: np.ndarray, ids: np.ndarray, name: str, width: int) -> pa.Table:
    """``group``, id and how often it stands there, by group."""
    counted = pa.table({"key": group * width + ids}).group_by("key", use_threads=False).aggregate([("key", "count")]).sort_by("key")
    key = counted["key"].to_numpy()
    return pa.table({"group": key // width, name: key % width, f"n_{name}": counted["key_count"]})


def _linked(a: pa.Table, b: pa.Table, text_of: np.ndarray, width: int) -> list[pa.Table]:
    """``text, pair, links`` of all ids that share a group; ``pair`` holds both ids. Made in pieces of at most :data:`PAIR_ROWS` rows."""
    groups, b_groups = a["group"].to_numpy(), b["group"].to_numpy()
    made = np.cumsum(np.bincount(b_groups, minlength=len(text_of))[groups])
    pieces, start = [], 0
    while start < len(made):
        stop = max(start + 1, int(np.searchsorted(made, (made[start - 1] if start else 0) + PAIR_ROWS, "right")))
        low, high = np.searchsorted(b_groups, [groups[start], groups[stop - 1] + 1])
        both = a.slice(start, stop - start).join(b.slice(low, high - low), "group", join_type="inner", use_threads=False)
        pair = both["a"].to_numpy() * width + both["b"].to_numpy()
        pieces.append(_summed(text_of[both["group"].to_numpy()], pair, pc.multiply(both["n_a"], both["n_b"])))
        start = stop
    return pieces


def _summed(text: np.ndarray, pair: np.ndarray, links: pa.Array | np.ndarray) -> pa.Table:
    """``text, pair, links`` with one row per text and pair."""
    far = int(pair.max(initial=0)) + 1
    table = pa.table({"key": text * far + pair, "links": links}).group_by("key", use_threads=False).aggregate([("links", "sum")])
    key = table["key"].to_numpy()
    return pa.table({"text": key // far, "pair": key % far, "links": table["links_sum"]})


def _merged(pieces: list[pa.Table]) -> pa.Table:
    if len(pieces) == 1:
        return pieces[0]
    table = pa.concat_tables(pieces)
    return _summed(*[table[c].to_numpy() for c in ("text", "pair", "links")])


def _joined(names: pa.Array, sizes: np.ndarray, mark: str) -> pa.Array:
    """Names in order, put together in runs of the given sizes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names), mark)


def _aligned(sides: list[tuple[np.ndarray, np.ndarray]], n: int, a: ByteLevel, b: Pieces) -> tuple[pa.Table, pa.Table]:
    (a_ids, a_text), (b_ids, b_text) = sides
    a_group, b_group = _groups(_token_ends(a_ids, a_text, a.length), a_text, _token_ends(b_ids, b_text, b.length), b_text)
    n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
    a_size, b_size = (np.bincount(g, minlength=n_groups) for g in (a_group, b_group))
    text_of = np.zeros(n_groups, np.int64)
    text_of[a_group] = a_text
    per_text = np.bincount(text_of, minlength=n)
    written = [_joined(s.name_of.take(pa.array(ids)), size, ",") for s, ids, size in ((a, a_ids, a_size), (b, b_ids, b_size))]
    told = pa.table(
        {
            "n_a": np.bincount(a_text, minlength=n).astype(np.int64),
            "n_b": np.bincount(b_text, minlength=n).astype(np.int64),
            "n_groups": per_text.astype(np.int64),
            "n_links": np.bincount(text_of, a_size * b_size, minlength=n).astype(np.int64),
            "groups": _joined(pc.binary_join_element_wise(*written, "|"), per_text, ";"),
        }
    )
    # Groups of one token a side are links as they stand; in the others ids are counted before they are paired.
    single = (a_size == 1) & (b_size == 1)
    a_one, b_one, width = single[a_group], single[b_group], len(b.tokens)
    plain = _summed(a_text[a_one], a_ids[a_one].astype(np.int64) * width + b_ids[b_one], np.ones(int(a_one.sum()), np.int64))
    counted = [_counted(g[~one], ids[~one], c, len(s.tokens)) for g, ids, one, c, s in ((a_group, a_ids, a_one, "a", a), (b_group, b_ids, b_one, "b", b))]
    return told, _merged([plain, *_linked(*counted, text_of, width)])


def align(texts: pa.Array, a: ByteLevel, b: Pieces) -> tuple[pa.Table, pa.Table]:
    """Per text ``n_a, n_b, n_groups, n_links, groups``, and ``text, pair, links`` with the numbers of the texts, in order.

    ``groups`` is written as ``a1,a2|b1;a3|b2,b3``.
    """
    told, links = [], []
    texts = texts.fill_null("")
    for first, last, sides in tokenize(texts, a, b).slices(len(texts)):
        numbers, pairs = _aligned(sides, last - first, a, b)
        told.append(numbers)
        pairs = pairs.sort_by("text")
        links.append(pairs.set_column(0, "text", pc.add(pairs["text"], first)))
    return pa.concat_tables(told), pa.concat_tables(links)


def _align_partition(batches: Iterator[pa.RecordBatch], sent, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of documents with their pairs, and rows that hold nothing but counts of pairs."""
    files = sent.value
    a, b = _built(ByteLevel, files.first), _built(Pieces, files.second)
    empty = pa.table({"pair": pa.array([], pa.int64()), "docs": pa.array([], pa.int64())})
    kept = empty

    def written(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    def counts() -> pa.RecordBatch:
        lists = {f"counted_{c}": pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept[c].combine_chunks()) for c in ("pair", "docs")}
        return written(1, **lists)

    for chunk in chunks(batches, CHUNK_BYTES):
        if not len(chunk):
            continue
        told, links = align(chunk["text"].combine_chunks(), a, b)
        offsets = np.searchsorted(links["text"].to_numpy(), np.arange(len(chunk) + 1)).astype(np.int32)
        lists = {c: pa.ListArray.from_arrays(pa.array(offsets), links[c].combine_chunks()) for c in ("pair", "links")}
        digests = [hashlib.sha256(g.as_buffer()).hexdigest() if g.as_buffer().size else "" for g in told["groups"]]
        numbers = {c: told[c].combine_chunks() for c in ("n_a", "n_b", "n_groups", "n_links")}
        ids = {c: chunk[c].combine_chunks() for c in ("row", "doc_id")}
        yield written(len(chunk), **ids, **numbers, groups_sha256=pa.array(digests, pa.string()), **lists)
        seen = links.group_by("pair", use_threads=False).aggregate([("pair", "count")]).rename_columns({"pair_count": "docs"}).select(["pair", "docs"])
        kept = pa.concat_tables([kept, seen]).group_by("pair", use_threads=False).aggregate([("docs", "sum")]).rename_columns({"docs_sum": "docs"})
        kept = kept.select(["pair", "docs"])
        if len(kept) > KEPT_PAIRS:
            yield counts()
            kept = empty
    if len(kept):
        yield counts()


def align_documents(docs: DataFrame, tokenizers: Tokenizers, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Groups and links of the tokens of each row of ``docs(doc_id, text)``.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. The count of an id pair is the number of rows in which it is
    linked. NULL and empty texts, and those that the tokens of a side do not spell byte by byte, have zeros and an empty string. Repeated
    rows are documents of their own, so is each row with a NULL doc_id. An empty table gives no rows, further columns are ignored.

    The ``head_pairs`` most frequent pairs meet the links in a broadcast table; all others, each in few documents, in a join.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(tokenizers)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    layout = (
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pair array<long>, links array<long>, counted_pair array<long>, counted_docs array<long>"
    )
    schema = arrow_schema(spark, layout)
    found = stage(rows.mapInArrow(lambda batches: _align_partition(batches, sent, schema), layout), "alignment")
    own = found.filter("row is not null")

    width = len(_built(Pieces, tokenizers.second).tokens)
    partial = found.filter("counted_pair is not null").select(F.explode(F.arrays_zip("counted_pair", "counted_docs")).alias("c"))
    counted = stage(partial.groupBy(F.col("c.counted_pair").alias("pair")).agg(F.sum("c.counted_docs").alias("docs")), "alignment-counts")
    a_id = F.floor(F.col("pair") / width).cast("int")
    highest = counted.groupBy(a_id.alias("a")).agg(F.max("docs").alias("highest"))  # a row per id of the first vocabulary
    counted = stage(
        counted.withColumn("a", a_id).join(F.broadcast(highest), "a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best")), "alignment-best"
    )
    head = counted.filter(F.col("docs") >= frequent_floor(counted, "docs", head_pairs))

    links = own.select("row", F.explode(F.arrays_zip("pair", "links")).alias("l")).select("row", "l.pair", "l.links")
    sums = [F.sum(F.col("links") * F.col("docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best")]
    often = links.join(F.broadcast(head), "pair").groupBy("row").agg(*sums)
    seldom = links.join(F.broadcast(head.select("pair")), "pair", "left_anti").join(counted, "pair").groupBy("row").agg(*sums)
    both = often.unionByName(seldom).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    joined = own.drop("pair", "links", "counted_pair", "counted_docs").join(both, "row", "left")
    none = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256",
    )

