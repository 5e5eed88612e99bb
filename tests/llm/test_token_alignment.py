"""Alignment of tokenizers against whole texts encoded one by one and paired in plain loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from awkward import awkward_rows, make_docs, rows, shipped  # noqa: F401
from tokenizers import Tokenizer

from deskmart.llm import queries, token_alignment

FILES = f"{queries.TOKENIZERS}/byte_bpe_50k.json", f"{queries.TOKENIZERS}/piece_bpe_32k.model"
ODD = [
    "  two  spaces   and more ", "\ttab\t tab \n\nline \r\n end\n", "a b   c　d  e", "under▁score", " ▁", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "é ́x ﬁ ½ Ⅳ", "nul\x00 byte \x00", "it's we'll 'd 123 4567.89 — … !!", "​ zero ​ width‍ ", "x" * 3000 + " " * 200 + "y", "﻿bom ﻿", "日本 語 テキスト ", " ", "\n", "\U0001f469‍\U0001f4bb ok",
]


@pytest.fixture(scope="module")
def files():
    return token_alignment.Tokenizers.load(*FILES)


@pytest.fixture(scope="module")
def whole():
    """Encoders of whole texts: (ids, bytes of each token) of both sides."""
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    letters = token_alignment.byte_letters()

    def encode(text):
        a = first.encode(" " + text, add_special_tokens=False)
        b = second.encode(text)
        pieces = [second.id_to_piece(i) for i in b]
        spelt = [bytes([int(p[3:-1], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        return a.ids, [bytes(letters[c] for c in t) for t in a.tokens], b, spelt

    return encode


def _groups(text, encode):
    a, a_bytes, b, b_bytes = encode(text) if text else ([], [], [], [])
    told = (" " + text).encode() if text else b""
    if b"".join(a_bytes) != told or b"".join(b_bytes) != told or not text:
        return []

    def ends(parts):
        at, found = 0, []
        for p in parts:
            at += len(p)
            found.append(at)
        return found

    a_ends, b_ends = ends(a_bytes), ends(b_bytes)
    shared = sorted(set(a_ends) & set(b_ends))
    groups, low = [], 0
    for high in shared:
        groups.append(([i for i, e in zip(a, a_ends) if low < e <= high], [i for i, e in zip(b, b_ends) if low < e <= high]))
        low = high
    return groups


def _brute(table, encode):
    aligned = [(i, _groups(t, encode)) for i, t in table]
    docs = Counter()
    for _, groups in aligned:
        docs.update({(x, y) for a, b in groups for x in a for y in b})
    highest = defaultdict(int)
    for (x, _), n in docs.items():
        highest[x] = max(highest[x], n)
    out = []
    for i, groups in aligned:
        links = [(x, y) for a, b in groups for x in a for y in b]
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                i,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(docs[p] == highest[p[0]] for p in links),
                sum(docs[p] for p in links),
                hashlib.sha256(written.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize(("chunk", "pair_rows", "head"), [(1 << 22, 1 << 20, 1 << 20), (2000, 50, 300), (2000, 1 << 20, 0)])
def test_alignment(spark, make_docs, rows, files, whole, monkeypatch, chunk, pair_rows, head):
    table = [*rows, *[(2**53 + i, t) for i, t in enumerate(ODD)], (2**53 + 1, "again"), (None, "again")]
    table = [(i, t if t is None or len(t) < 6000 else t[:6000]) for i, t in table]
    inner = token_alignment._align_partition

    def small_parts(batches, sent, schema):
        token_alignment.CHUNK_BYTES, token_alignment.PAIR_ROWS, token_alignment.KEPT_PAIRS = chunk, pair_rows, 100 * pair_rows
        token_alignment.ALIGNED_TOKENS, token_alignment.ENCODED = chunk // 4, 100
        return inner(batches, sent, schema)

    monkeypatch.setattr(token_alignment, "_align_partition", small_parts)
    got = token_alignment.align_documents(make_docs(table, extra=True), files, head_pairs=head)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(table, whole)


def test_cutting_keeps_tokens(files, whole):
    """Random mixtures of words and odd spaces: cut or whole, the tokens are the same."""
    rng = random.Random(11)
    parts = ["word", "'s", " ", "  ", "\n", "\t", " ", "12", "é", "é", " ", "​", ".", "—", "日本", "x" * 40, "A", "\x00", "▁", "<s>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    a, b = token_alignment._built(token_alignment.ByteLevel, files.first), token_alignment._built(token_alignment.Pieces, files.second)
    assert a.cut_at_spaces and b.cut_at_spaces
    ((_, _, ((a_ids, a_text), (b_ids, b_text))),) = token_alignment.tokenize(pa.array(texts), a, b).slices(len(texts))
    for i, text in enumerate(texts):
        first, first_bytes, second, second_bytes = whole(text)
        told = (" " + text).encode()
        spelt = b"".join(first_bytes) == told == b"".join(second_bytes)
        assert a_ids[a_text == i].tolist() == (first if spelt else [])
        assert b_ids[b_text == i].tolist() == (second if spelt else [])


def test_one_group_of_many_tokens(files):
    """Ids that share one long group are counted before they are paired."""
    n = 3000
    a = token_alignment._counted(np.zeros(n, np.int64), np.arange(n) % 7, "a", 10)
    b = token_alignment._counted(np.zeros(n, np.int64), np.arange(n) % 5, "b", 10)
    linked = token_alignment._merged(token_alignment._linked(a, b, np.zeros(1, np.int64), 10))
    assert len(linked) == 35 and sum(linked["links"].to_pylist()) == n * n


def test_given_table(spark, files, whole):
    from awkward import SF_DIR

    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(table, whole)


def test_empty_tables(spark, make_docs, files):
    assert token_alignment.align_documents(make_docs([]), files).collect() == []
    got = token_alignment.align_documents(make_docs([(1, None), (2, "")]), files).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
