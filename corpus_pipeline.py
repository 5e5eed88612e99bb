"""From raw documents to training shards: five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next stage's ``docs``. All but
the last return the columns of ``documents``. Rows without text, empty texts and repeated rows pass by the rules of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskmart.llm import decontamination, mixing, simhash_neardup, slot_sharding, toxicity
from deskmart.llm.common import read, ship, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half."""
    ship(spark)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score_column(docs, model) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates; a group without any doc_id keeps one row."""
    ship(spark)
    return simhash_neardup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is shared with the benchmark."""
    ship(spark)
    return decontamination.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    ship(spark)
    return mixing.repeat_by_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document that is left: shard and slot."""
    return slot_sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL cannot express the classifier, the fingerprints or the seeded choice; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
