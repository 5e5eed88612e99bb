"""Fixtures of the corpus tests; test modules import them by name."""

from __future__ import annotations

import os
import random

import pytest

from deskmart.llm.common import ship

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make_docs(spark):
    """Documents of (doc_id, text) or (doc_id, text, source), with extra columns whose names operators use inside."""

    def make(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("h", "fp", "size", "copies", "score", "cell", "label", "bucket", "n", "spans", "path", "vslot", "_order", "shard"):
                df = df.selectExpr("*", f"'x' as {name}")
            # Values that change on a way through pandas, a type without hash or order, and names that operators might add.
            df = df.selectExpr(
                "*", "if(doc_id % 2 = 0, null, 9007199254740993) as far", "timestamp'1500-01-01' as old", "map('a', doc_id) as pairs", "77 as _bench_n_hit", "78 as _overlaps"
            )
        return df.repartition(3)

    return make


def awkward(seed=5, words=400):
    """Texts with copies, near copies, shared passages, odd characters, long runs and very short ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghilmnorstuäéß") for _ in range(rng.randint(1, 9))) for _ in range(words)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    texts = [prose(rng.randint(1, 150)) for _ in range(25)]
    texts += [texts[3], texts[3], texts[3] + " end", texts[4].upper()]
    texts += [prose(20) + " " + passage + " " + prose(10) for _ in range(5)]
    texts += ["", "   ", "a", "é" * 70, "x" * 500, "ab" * 200, "the " * 300, "日本語" * 60, "\U0001f600 " * 40, None, None]
    texts += [prose(4000), passage]
    return texts


def awkward_rows(seed=5):
    rows = [(i * 3 + 7, t) for i, t in enumerate(awkward(seed))]
    large = [(2**53 + 1, rows[4][1]), (2**53 + 2, rows[6][1]), (2**53 + 3, None), (2**53 + 4, rows[5][1] + " end"), (-(2**63), rows[3][1])]
    return [*rows, rows[2], rows[2], rows[-1], (None, rows[5][1]), (None, None), *large]


@pytest.fixture
def rows():
    return awkward_rows()
