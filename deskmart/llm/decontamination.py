"""Benchmark decontamination by winnowing.

Winnowing keeps the smallest hash of k consecutive words in each window of such hashes, for
documents and benchmark items alike. Two texts that share ``span`` words share all hashes of that span,
hence the kept one: with windows of ``span - k + 1`` hashes no shared span is missed. Documents
meet the benchmark on kept hashes, and each meeting is extended, by exact comparison of words,
to the spans around it.

An item shorter than ``span`` words is one span as a whole; it is looked up by a hash of all its words, since
windows of its length would keep every hash anyway.

Spark tasks fingerprint items and documents alike. The items' kept hashes, eight bytes each, go to the tasks as sorted numbers, in blocks of bounded size; where a
document meets them, the spans around are compared by a digest of their words, in a join with the spans of the items. So the
benchmark may grow like the corpus, and texts never move: results are joined by the digest of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import small, stage

SPAN = 13
GRAM = 5
BLOCK_GRAMS = 4_000_000  # kept hashes sent at once, 32 MB
SPAN_ROWS = 400_000  # broadcast at most

# ASCII letters and digits, and every byte of other characters, make words; the rest separates them.
_KEEP = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, as UTF-8; none for NULL."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().translate(_KEEP).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive word codes."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = _mix(h * np.uint64(0xD6E8FEB86659FD93) + codes[j : j + n].astype(np.uint64) + np.uint64(1))
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, by doubling."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the hashes that are smallest in some window; of few hashes, of the only window."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64)
    if n <= window:
        return np.flatnonzero(hashes == hashes.min())
    low = sliding_min(hashes, window)
    # A hash is kept if it equals the largest of the minima of the windows that hold it.
    pad = np.zeros(window - 1, hashes.dtype)
    high = ~sliding_min(~np.concatenate([pad, low, pad]), window)
    return np.flatnonzero(high == hashes)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _digest(words: list[bytes]) -> bytes:
    """Tells a span by its words; 128 bits stand for the comparison word by word."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def fingerprint_item(words: list[bytes], span: int, gram: int) -> tuple[int, list[int], list[bytes]]:
    """Length of the spans of an item, its kept hashes, and digests of its spans."""
    size = min(span, len(words))
    if size == 0:
        return 0, [], []
    hashes = word_hashes(words)
    if size < span:
        kept = gram_hashes(hashes, size)
    else:
        kept = gram_hashes(hashes, gram)
        kept = np.unique(kept[winnow(kept, span - gram + 1)])
    return size, kept.view(np.int64).tolist(), [_digest(words[i : i + size]) for i in range(len(words) - size + 1)]


def _meets(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return table[at] == hashes


def candidate_spans(words: list[bytes], kept: dict[int, np.ndarray], span: int, gram: int) -> list[tuple[int, int, bytes]]:
    """Start, length and digest of the spans of a document around its meetings with ``kept``, hashes by length of span."""
    found: list[tuple[int, int]] = []
    hashes = word_hashes(words) if words else np.zeros(0, np.uint64)
    for size, table in kept.items():
        if len(words) < size:
            continue
        if size < span:
            found += [(s, size) for s in np.flatnonzero(_meets(gram_hashes(hashes, size), table)).tolist()]
            continue
        own = gram_hashes(hashes, gram)
        places = winnow(own, span - gram + 1)
        places = places[_meets(own[places], table)]
        if len(places):
            # Extend: every span of the document that holds a meeting.
            starts = np.unique(places[:, None] - np.arange(span - gram + 1)[None, :])
            found += [(s, span) for s in starts[(starts >= 0) & (starts + span <= len(words))].tolist()]
    return [(s, n, _digest(words[s : s + n])) for s, n in found]


def fingerprint_items(benchmark: DataFrame, span: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """``size, gram``, distinct kept hashes, and ``span, items``, the ids of the items that hold a span, of ``benchmark(item_id, text)``."""

    def items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *fingerprint_item(words_of(t), span, gram)) for i, t in zip(batch["item"], batch["text"], strict=True)]
            yield pd.DataFrame(rows, columns=["item", "size", "grams", "spans"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    told = stage(rows.mapInPandas(items, "item string, size int, grams array<long>, spans array<binary>"), "benchmark")
    grams = stage(told.select("size", F.explode("grams").alias("gram")).distinct(), "benchmark-grams")
    spans = told.select("item", F.explode(F.array_distinct("spans")).alias("span")).groupBy("span").agg(F.collect_set("item").alias("items"))
    return grams, stage(spans, "benchmark-spans")


def _candidates(texts: DataFrame, grams: DataFrame, span: int, gram: int, block_grams: int) -> DataFrame:
    """``key, n_words, start, size, span`` of all candidate spans of ``texts(key, text)``; hashes are sent in blocks of about ``block_grams``."""
    context = texts.sparkSession.sparkContext
    blocks, out = max(1, -(-grams.count() // block_grams)), None
    for b in range(blocks):
        table = grams.filter(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == b).toArrow()  # one block at a time
        sizes, values = table["size"].to_numpy(), table["gram"].to_numpy().view(np.uint64)
        sent = context.broadcast({int(n): np.sort(values[sizes == n]) for n in np.unique(sizes)})

        def scan(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for key, text in zip(batch["key"], batch["text"], strict=True):
                    words = words_of(text)
                    rows += [(key, len(words), *c) for c in candidate_spans(words, sent.value, span, gram)]
                yield pd.DataFrame(rows, columns=["key", "n_words", "start", "size", "span"])

        part = stage(texts.mapInPandas(scan, "key string, n_words long, start long, size long, span binary"), "benchmark-meetings")
        out = part if out is None else out.unionByName(part)
        sent.destroy()
    return out


def _merged(spans: pd.Series) -> list[list[dict]]:
    """Runs of words that the spans of each row cover."""
    out = []
    for row in spans:
        runs: list[list[int]] = []
        for a, b in sorted((s["start"], s["end"]) for s in row):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        out.append([{"start": a, "end": b} for a, b in runs])
    return out


def overlapping_texts(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """``key, n_words, n_hit, items, spans`` of each distinct text of ``docs(text)`` that shares a span; ``key`` is the MD5 of the text."""
    grams, held = fingerprint_items(benchmark, span, gram)
    texts = docs.select(F.md5(docs["text"].cast("string")).alias("key"), docs["text"].cast("string").alias("text")).filter("text is not null")
    near = _candidates(texts, grams, span, gram, block_grams)
    # Copies of a text give equal rows; a passage that many texts share is one span, so the join does not multiply.
    near = near.distinct().join(small(held, SPAN_ROWS), "span")
    whole = F.struct("start", (F.col("start") + F.col("size")).alias("end"))
    by_text = near.groupBy("key").agg(
        F.first("n_words").alias("n_words"), F.collect_list(whole).alias("all"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def merged(spans: pd.Series) -> pd.Series:
        return pd.Series(_merged(spans), dtype=object)

    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    told = by_text.select("key", "n_words", "items", merged("all").alias("spans"))
    return stage(told.withColumn("n_hit", hit), "benchmark-hits")


def _free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, block_grams: int = BLOCK_GRAMS, prefix: str = "bench_"
) -> DataFrame:
    """All columns of ``docs`` and what its ``text`` shares with the items of ``benchmark(item_id, text)``.

    Added, named with ``prefix``: ``n_words``, ``n_hit`` (words inside shared spans), ``items`` (their ids
    as strings, sorted), ``spans`` (merged runs of hit words: start, end). A NULL text has no words and no hits, nor has a
    NULL or empty item; items without an id give hits, but no entry in ``items``. Repeated rows give repeated rows, repeated items count once.
    Columns of ``docs`` that bear an added name are replaced; all others stay as they are, whatever their types.
    """
    names = {n: prefix + n for n in ("n_words", "n_hit", "items", "spans")}
    rest = docs.drop(*names.values())
    found = overlapping_texts(docs, benchmark, span, gram, block_grams)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(words_of(t)) for t in texts], dtype="int64")

    key, words, hit = (_free_name(rest, n) for n in ("_text_key", "_n_words", "_found"))
    text = F.col("text").cast("string")
    keyed = rest.withColumn(key, F.md5(text)).withColumn(words, count(text))
    told = found.select(F.col("key").alias(f"{key}_"), F.struct("n_hit", "items", "spans").alias(hit))
    joined = keyed.join(told, F.col(key) == F.col(f"{key}_"), "left")
    empty = {"n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>"), "spans": F.array().cast("array<struct<start:long,end:long>>")}
    added = [F.coalesce(F.col(hit)[n], none).alias(names[n]) for n, none in empty.items()]
    return joined.select(*rest.columns, F.col(words).alias(names["n_words"]), *added)


def keep_clean(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """The rows of ``docs`` that are not :func:`contaminated`, with the columns of ``docs`` as they are. Of contaminated texts only the digest is sent to the rows."""
    found = overlapping_texts(docs, benchmark, span, gram, block_grams)
    key = _free_name(docs, "_text_key")
    bad = stage(found.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("key").alias(f"{key}_")), "contaminated")
    keyed = docs.withColumn(key, F.md5(F.col("text").cast("string")))
    return keyed.join(small(bad, SPAN_ROWS), F.col(key) == F.col(f"{key}_"), "left_anti").drop(key)


def contaminated(n_hit, n_words):
    """At least a twentieth of the words is shared, and one word at all."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def items_digest(items):
    """SHA-256 of the comma-joined item ids."""
    return F.sha2(F.concat_ws(",", F.array_sort(items)), 256)


