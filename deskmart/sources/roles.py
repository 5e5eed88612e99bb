"""Logical input tables ("roles") and where they come from.

Operators never name a physical table. They receive the DataFrames held by a
:class:`Roles` object, so the same code serves catalog tables, Parquet folders
and the adapter views in :mod:`deskmart.sources.adapter`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that operators read from each role. A table may have others: lookups of whole rows
# return them, everything else leaves them out of its plan.
ROLE_COLUMNS: dict[str, str] = {
    "spaces": "date report_month location_uuid location_name reservable_uuid reservable_name "
    "reservable_type reservation_uuid account_uuid account_name sku occupancy capacity term_id "
    "is_month_to_month commitment_full_duration commitment_remaining_duration "
    "commitment_term_created_utc commitment_term_start_utc commitment_term_end_utc "
    "commitment_term_start_local commitment_term_end_local commitment_term_cancelled_utc "
    "applied_discount local_currency usd_price local_currency_price market_price_local "
    "market_price_usd net_paid_price_usd net_paid_price_local",
    "accounts": "account_uuid is_affiliate",
    "locations": "uuid region territory country market ww_code building_code",
    "reservables": "uuid floor_uuid",
    "deals": "sales_reporting_month deal_uuid primary_reservation_uuid salesforce_opportunity_id "
    "reservable_uuid location_uuid initial_sale_date reservation_start_date reservation_end_date "
    "resulting_commitment_term_start resulting_commitment_term_end "
    "resulting_commitment_term_months region subregion territory sales_market city location_name "
    "deal_type reservation_deal_activity is_renewal_deal sales_account_name billing_account_name "
    "reservable_name product product_grouping commitment_bucket sku sku_group currency "
    "primary_reservation_capacity primary_reservation_capacity_today gross_desk_sales "
    "new_desk_sales renewal_desk_sales desk_months reservation_price_usd reservation_price_local "
    "core_committed_value_usd core_committed_value_local "
    "gross_committed_value_changed_before_discount_local addon_committed_value_changed_local "
    "is_affiliate _run_at",
    "records": "sales_reporting_month territory deal_uuid primary_reservation_uuid location_uuid "
    "price_id vat_adjust_factor applied_months price_local price_usd_sales_comp_fx "
    "committed_value_changed_local primary_reservation_capacity sales_record_reservation_type "
    "sales_record_type desk_account_impact is_renewal_deal term_id term_start_date term_end_date",
    "desks": "deal_uuid reservable_uuid location_uuid primary_reservation_uuid region deal_type "
    "initial_sale_date sales_reporting_month net_commitment_term_months_changed",
    "exits": "location_uuid floor_uuids member_communication_date included_in_q_4_spiff",
    "exclusions": "deal_uuid reservation_uuid reason_for_exclusion",
    "reservations": "uuid notes created_at updated_at",
    "opportunities": "sf_opportunity_id opportunity_owner_id referral_type",
    "team_members": "team_sf_object_id sf_user_id",
    "users": "sf_user_id email",
    "discount_versions": "reservable_uuid term start_at end_at recommended_discount",
    "rates": "report_month source_currency budget_rate",
}


# What the columns hold, by name; all others hold text.
DATES = frozenset(
    "date report_month sales_reporting_month initial_sale_date reservation_start_date reservation_end_date "
    "resulting_commitment_term_start resulting_commitment_term_end term_start_date term_end_date member_communication_date".split()
)
MOMENTS = frozenset(
    "commitment_term_created_utc commitment_term_start_utc commitment_term_end_utc commitment_term_start_local "
    "commitment_term_end_local commitment_term_cancelled_utc created_at updated_at start_at end_at _run_at".split()
)
FLAGS = frozenset("is_affiliate is_renewal_deal is_month_to_month included_in_q_4_spiff".split())
NUMBERS = frozenset(
    "occupancy capacity commitment_full_duration commitment_remaining_duration usd_price local_currency_price market_price_local "
    "market_price_usd net_paid_price_usd net_paid_price_local resulting_commitment_term_months primary_reservation_capacity "
    "primary_reservation_capacity_today gross_desk_sales new_desk_sales renewal_desk_sales desk_months reservation_price_usd "
    "reservation_price_local core_committed_value_usd core_committed_value_local gross_committed_value_changed_before_discount_local "
    "addon_committed_value_changed_local vat_adjust_factor applied_months price_local price_usd_sales_comp_fx "
    "committed_value_changed_local net_commitment_term_months_changed term recommended_discount budget_rate".split()
)
# Identifiers of a commitment term, compared as text or as they are.
_ANY = frozenset(["term_id"])
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def _utc(c: Column) -> Column:
    """The moment of a TIMESTAMP as UTC wall-clock time, whatever the session's zone."""
    seconds = (F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _checked(role: str, frame: DataFrame, field: T.StructField) -> Column:
    """The column under the type that operators rely on, or an error."""
    name, kind, c = field.name.lower(), field.dataType, frame[f"`{field.name}`"]
    if name not in ROLE_COLUMNS[role].split() or name in _ANY:
        return c
    if name in DATES or name in MOMENTS:
        fits = isinstance(kind, _TIMES)
        if isinstance(kind, T.TimestampType):
            c = _utc(c)
        if name in DATES and not isinstance(kind, T.DateType):
            c = c.cast("date")
    elif name in FLAGS:
        fits = isinstance(kind, T.BooleanType)
    elif name in NUMBERS:
        fits = isinstance(kind, T.NumericType)
    else:
        fits = isinstance(kind, T.StringType)  # CHAR and VARCHAR included
    if not fits:
        raise ValueError(f"role {role!r}: column {field.name!r} is {kind.simpleString()}")
    return c.alias(field.name)


class Roles(Mapping[str, DataFrame]):
    """Immutable mapping ``role -> DataFrame`` with attribute access.

    Every frame must carry the columns of :data:`ROLE_COLUMNS` with fitting types; what is missing or of another kind
    is reported when the registry is built, not deep inside a mart. Dates given as timestamps become
    dates, and a TIMESTAMP becomes UTC wall-clock time, so that months do not depend on a session's
    zone. Columns of other names stay.
    """

    def __init__(self, frames: Mapping[str, DataFrame]):
        checked = {}
        for role, frame in frames.items():
            needed = ROLE_COLUMNS[role].split()
            present = {c.lower() for c in frame.columns}
            missing = [c for c in needed if c.lower() not in present]
            if missing:
                raise ValueError(f"role {role!r} lacks columns {missing}")
            checked[role] = frame.select(*[_checked(role, frame, f) for f in frame.schema.fields])
        self._frames = checked

    def __getitem__(self, role: str) -> DataFrame:
        return self._frames[role]

    def __getattr__(self, role: str) -> DataFrame:
        if role.startswith("_"):
            raise AttributeError(role)
        try:
            return self._frames[role]
        except KeyError:
            raise AttributeError(role) from None

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    @classmethod
    def from_tables(
        cls,
        spark: SparkSession,
        tables: Mapping[str, str],
        renames: Mapping[str, Mapping[str, str]] | None = None,
    ) -> Roles:
        """Resolve each role to a (one- to three-part) table name.

        ``renames[role]`` maps a physical column to the role column it plays,
        e.g. ``{"accounts": {"is_own_company_affiliate": "is_affiliate"}}``.
        """
        return cls._load(lambda name: spark.table(name), tables, renames)

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        paths: Mapping[str, str],
        renames: Mapping[str, Mapping[str, str]] | None = None,
    ) -> Roles:
        """Resolve each role to a Parquet path (partitioned folders included)."""
        return cls._load(lambda path: spark.read.parquet(path), paths, renames)

    @classmethod
    def _load(cls, read, where, renames) -> Roles:
        renames = renames or {}
        return cls({r: read(w).withColumnsRenamed(dict(renames.get(r, {}))) for r, w in where.items()})
