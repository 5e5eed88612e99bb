"""Occupancy and capacity roll-ups of the monthly space snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskmart.functions.expr import ratio, sku_bucket
from deskmart.operators.population import SALES_START, reported_regions


def next_months(spaces: DataFrame, as_of: date | None, first: int = 1, until: int = 4) -> DataFrame:
    """Rows dated in the full months ``first`` .. ``until - 1`` after ``as_of`` (default: today).

    Both bounds fold to date literals, so they reach the scan and prune months.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    low, high = (F.trunc(F.add_months(today, n), "MM") for n in (first, until))
    return spaces.filter((F.col("date") >= low) & (F.col("date") < high))


def forward_occupancy_by_sku(active: DataFrame, as_of: date | None) -> DataFrame:
    """Next three months per building (id and name) and SKU."""
    return (
        next_months(active, as_of)
        .groupBy("location_uuid", "location_name", "sku")
        .agg(F.sum("occupancy").alias("SKU_occ"), F.sum("capacity").alias("SKU_capacity"))
        .withColumn("SKU_Occupancy", ratio("SKU_occ", "SKU_capacity"))
    )


def forward_occupancy(by_sku: DataFrame) -> DataFrame:
    """Next three months per building, rolled up from :func:`forward_occupancy_by_sku`."""
    return (
        by_sku.groupBy("location_uuid", "location_name")
        .agg(F.sum("SKU_occ").alias("n3m_AddOccup"), F.sum("SKU_capacity").alias("n3m_AddCap"))
        .withColumn("n3m_Occupancy", ratio("n3m_AddOccup", "n3m_AddCap"))
    )


def current_occupancy(active: DataFrame, locations: DataFrame) -> DataFrame:
    """Per report month and building, for reported regions."""
    return (
        active.filter(F.col("report_month") >= F.lit(SALES_START))
        .join(
            reported_regions(locations).select(F.col("uuid").alias("location_uuid")),
            "location_uuid",
        )
        .groupBy("report_month", "location_uuid")
        .agg(F.sum("occupancy").alias("occ_current"), F.sum("capacity").alias("cap_current"))
        .withColumn("current_building_occupancy", ratio("occ_current", "cap_current"))
    )


def sku_group_occupancy(active: DataFrame) -> DataFrame:
    """Per date, building and SKU bucket (the bucket may be NULL when the capacity is unknown)."""
    return (
        active.select("date", "location_uuid", sku_bucket().alias("sku_group"), "occupancy", "capacity")
        .groupBy("date", "location_uuid", "sku_group")
        .agg(F.sum("occupancy").alias("sku_occupancy"), F.sum("capacity").alias("sku_capacity"))
    )


def location_occupancy(by_sku_group: DataFrame) -> DataFrame:
    """Per date and building, rolled up from :func:`sku_group_occupancy`."""
    return by_sku_group.groupBy("date", "location_uuid").agg(
        F.sum("sku_occupancy").alias("building_occupancy"), F.sum("sku_capacity").alias("building_capacity")
    )


def occupancy_levels(active: DataFrame) -> DataFrame:
    """Occupancy per date, building and SKU bucket next to that of the whole building.

    One scan and one roll-up serve both levels. The window runs over the buckets of
    a building and date, five rows at most. The unknown bucket keeps its row, with
    no bucket value, so that every space finds its building.
    """
    whole = Window.partitionBy("date", "location_uuid")
    return sku_group_occupancy(active).select(
        "date",
        "location_uuid",
        "sku_group",
        F.when(F.col("sku_group").isNotNull(), F.col("sku_occupancy")).alias("sku_occupancy"),
        F.sum("sku_occupancy").over(whole).alias("building_occupancy"),
    )
