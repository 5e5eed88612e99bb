"""Document fingerprints from closed syncmers, in DataFrame functions alone.

A text is read as units: runs of up to two characters that start with each word. Of the ``K`` consecutive units at each
place, a hash is formed for each inner pair of neighbours; the place is an anchor if the smallest of these lies at
an edge, first or last. Whether it does follows from the K units alone, whatever stands around them, so an edit
changes the anchors that it touches and no others, and anchors of equal passages are equal and keep their order.

The fingerprint of a text is the sketch of its anchors: the ``SKETCH`` smallest distinct hashes. Likeness is the share of the smallest
hashes of both texts together that both have, which is the Jaccard similarity of the anchor sets if they are small, and
an unbiased estimate of it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmart.llm.common import let, stage

K = 6
UNIT = r"\S{1,2}"
SKETCH = 128


def units(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))


def anchor_array(parts: Column, with_place: bool = False) -> Column:
    """Hashes of the anchors of an array of units in order, or structs of hash and place.

    A text of fewer than K units, and one without any anchor, has all its units together as the only anchor; no units, none.
    """

    def pairs(u):
        return F.transform(u, lambda x, i: F.xxhash64(x, F.get(u, i + 1)))

    def anchors(h):
        def at(x, i):
            edge = F.least(x, F.get(h, i + 4))
            inner = F.least(F.get(h, i + 1), F.get(h, i + 2), F.get(h, i + 3))
            value = F.hash(x, F.get(h, i + 2), F.get(h, i + 4))  # three pairs: all six units
            # Places near the end lack their last pair.
            return F.when(F.get(h, i + 4).isNotNull() & (edge <= inner), F.struct(value.alias("hash"), i.alias("place")) if with_place else value)

        return F.array_compact(F.transform(h, at))

    def whole(u):
        value = F.hash(u)
        return F.array(F.struct(value.alias("hash"), F.lit(0).alias("place")) if with_place else value)

    def of(u):
        # The last unit has no neighbour to pair with.
        found = let(F.slice(pairs(u), 1, F.greatest(F.size(u) - 1, F.lit(0))), anchors)
        return let(found, lambda a: F.when(F.size(u) == 0, F.slice(whole(u), 1, 0)).when(F.size(a) == 0, whole(u)).otherwise(a))

    return let(parts, of)


def sketch(text: Column, size: int = SKETCH) -> Column:
    """The ``size`` smallest distinct anchor hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(anchor_array(units(text)))), 1, size)


def likeness(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Share of the ``size`` smallest hashes of both sketches that both have; 1 for two empty sketches."""

    def of(low):
        return F.when(F.size(low) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(a, b), low)) / F.size(low)
        )

    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, size), of)


def as_text(fingerprint: Column) -> Column:
    """Eight hexadecimal digits per hash."""
    return F.concat_ws("", F.transform(fingerprint, lambda x: F.lower(F.lpad(F.right(F.hex(x.cast("long")), F.lit(8)), 8, "0"))))


def anchors(docs: DataFrame) -> DataFrame:
    """Anchors of ``docs(doc_id, text)`` for positional matching: ``doc_id, hash, place``, the place counted in units."""
    found = anchor_array(units(docs["text"]), with_place=True)
    return docs.select("doc_id", F.explode(found).alias("a")).select("doc_id", "a.hash", "a.place")


#: A document's place in the order: documents without id first, then by id, then by a hash of the text. Never NULL.
KEY = ["has_id", "id", "h"]


def following(rows: DataFrame) -> DataFrame:
    """Distinct ``rows(has_id, id, h, ...)`` and ``next``, the key of the next row in their order; the last gets the first.

    Rows are sorted into ranges, ranges are looked through side by side, and the last row of each gets the first of the
    next range, of which there is one row per range.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(rows.repartitionByRange(ranges, *KEY).withColumn("_range", F.spark_partition_id()), "order")
    key = F.struct(*KEY)
    firsts = placed.groupBy("_range").agg(F.min(key).alias("_first"))
    in_order = Window.orderBy("_range")
    wrap = F.first("_first").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("_range", F.coalesce(F.lead("_first").over(in_order), wrap).alias("_then"))
    after = F.lead(key).over(Window.partitionBy("_range").orderBy(*KEY))
    both = placed.join(F.broadcast(firsts), "_range")  # one row per range: as many as shuffle partitions
    return both.select(*rows.columns, F.coalesce(after, "_then").alias("next"))


def compare_with_edits(docs: DataFrame, size: int = SKETCH) -> DataFrame:
    """Fingerprints of each text of ``docs(doc_id, text)``, of its edited text, and how alike it is to that and to the next.

    The edited text has the last quarter of the characters replaced by as many first ones (or all) of the next document by ascending
    doc_id; the first follows the last. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    A NULL text counts as empty; a NULL doc_id comes first; rows with equal doc_id come by a hash of the text, and
    rows that agree in both have one place in the order: each is returned. A single document is its own next. An empty table gives no
    rows; further columns are ignored.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    doc_id = docs["doc_id"]
    texts = docs.select(
        doc_id.isNotNull().alias("has_id"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")
    )
    lengths = texts.groupBy(*KEY).agg(F.first(F.char_length("text").cast("long")).alias("n"))
    # At the next document: its sketch and its first characters travel to the one before.
    back = stage(following(lengths), "following").select(
        *[F.col(f"next.{k}").alias(k) for k in KEY],
        *[F.col(k).alias(f"for_{k}") for k in KEY],
        F.floor(F.col("n") / 4).cast("int").alias("take"),
    )
    # Texts and their sketches are dealt out by key once. Both joins are merge joins, so that they share this exchange.
    here = texts.withColumn("fp", sketch(F.col("text"), size))
    head = F.when(F.col("take") > 0, F.left("text", "take")).otherwise("")
    sent = here.join(back.hint("merge"), KEY).select(*[F.col(f"for_{k}").alias(k) for k in KEY], head.alias("head"), F.col("fp").alias("next_fp"))
    sent = sent.groupBy(*KEY).agg(F.first("head").alias("head"), F.first("next_fp").alias("next_fp"))
    joined = here.join(sent.hint("merge"), KEY).withColumn("doc_id", F.when(F.col("has_id"), F.col("id")))
    n = F.char_length("text")
    edited = F.concat(F.left("text", n - F.floor(n / 4).cast("int")), F.col("head"))
    edited = joined.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    done = edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "next_fp", sketch(F.col("edited"), size).alias("edited_fp"))
    return done.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp"), size).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp"), size).alias("near_next"),
    )
