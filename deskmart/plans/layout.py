"""Tables laid out for the marts, so that monthly runs do not move their wide rows again.

The marts deal out wide rows by a digest of ids. A table that stores this digest and is bucketed by it is read where it
lies: the join with the lookups, the numbering and the search for copies then shuffle the narrow side alone. A role frame over such a
table is used like any other; the marts notice the digest column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from deskmart.operators.ordering import row_key
from deskmart.plans import inventory_mart, sales_mart


def _save(df: DataFrame, table: str, key: str, buckets: int, month: str | None, mode: str) -> None:
    # Copies of a bucket's rows from many tasks would make many small files; one exchange brings each bucket together.
    writer = df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
    (writer if month is None else writer.partitionBy(month)).saveAsTable(table)


def save_sales(deals: DataFrame, table: str, buckets: int, by_month: bool = True, mode: str = "overwrite") -> None:
    """Write the sales role to ``table`` in ``buckets`` buckets of the digest of its ids, partitioned by month if wanted.

    The number of buckets should match the shuffle partitions of the runs that read the table. NULL ids have a digest like all others.
    """
    keyed = deals.withColumn(sales_mart.SALE, row_key(*sales_mart.SALE_IDS))
    _save(keyed, table, sales_mart.SALE, buckets, sales_mart.MONTH if by_month else None, mode)


def save_spaces(spaces: DataFrame, table: str, buckets: int, by_month: bool = True, mode: str = "overwrite") -> None:
    """Write the snapshot role to ``table`` in ``buckets`` buckets of the digest of what its lookups depend on."""
    keyed = inventory_mart.keyed(spaces).drop("term_key")
    _save(keyed, table, inventory_mart.SPACE, buckets, "report_month" if by_month else None, mode)
