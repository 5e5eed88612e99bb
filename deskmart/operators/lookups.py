"""Ad hoc lookups of snapshot rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spaces_of_building(spaces: DataFrame, location_name: str, month: date) -> DataFrame:
    """Distinct snapshot rows of one building and month."""
    return spaces.filter((F.col("location_name") == location_name) & (F.col("report_month") == F.lit(month))).distinct()


def history_of_location(spaces: DataFrame, location_uuid: str) -> DataFrame:
    """Distinct snapshot rows of one location, oldest month first.

    The order is completed with the other columns: a few months cannot be spread
    over many sort tasks, whole rows can.
    """
    rows = spaces.filter(F.col("location_uuid") == location_uuid).distinct()
    rest = [c for c in rows.columns if c != "report_month"]
    return rows.orderBy(F.asc_nulls_last("report_month"), *[F.asc_nulls_last(c) for c in rest])
