"""One query per operator, on the role views of a test-table folder.

Every query covers whole tables. ``tidy`` fixes the output types so that results
compare across engines: BIGINT, DOUBLE rounded to six places, DATE, STRING, BOOLEAN.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmart.functions import expr as X
from deskmart.functions.text_rules import like_test
from deskmart.operators import (
    contacts,
    discounts,
    free_months,
    lookups,
    occupancy,
    ordering,
    population,
    promos,
    quality,
    rates,
    relocation,
    renewals,
    texts,
)
from deskmart.operators.sizing import materialize, scratch
from deskmart.operators.skew import HotKeys
from deskmart.plans import inventory_mart as inventory
from deskmart.plans import sales_mart as sales
from deskmart.sources import sinks
from deskmart.sources.adapter import ONE_BLOCK, LazyRoles

AS_OF = date(2023, 3, 15)
BRAND = population.Brand("Acme", "AC")
SALE = ["sales_reporting_month", "deal_uuid", "primary_reservation_uuid"]
LIKE_PATTERNS = {
    "plain": "%The%",
    "two_pieces": "%and%on%",
    "four_pieces": "%Q3%Dedicated%space%promo%",
    "one_char": "%t_e%",
    "at_end": "%promo",
    "whole_word": "%license%",
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def tidy(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)  # no negative zero
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = c.cast("date")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(fn: Callable[[LazyRoles], DataFrame]) -> Callable[[LazyRoles], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: tidy(fn(LazyRoles(spark, sf_dir, spread_below=ONE_BLOCK)))
    return fn


def mart_query(fn: Callable[[LazyRoles], DataFrame]) -> Callable[[LazyRoles], DataFrame]:
    """A query whose views find their base tables laid out: read once for all views, and in tasks of bounded size."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: tidy(fn(LazyRoles(spark, sf_dir, spread_below=ONE_BLOCK, lay_out=True)))
    return fn


def _active(r: LazyRoles, since: date | None = None) -> DataFrame:
    return population.active_spaces(r.spaces, r.accounts, since)


# --- lookups -----------------------------------------------------------------


@query
def adhoc_distinct_filter(r):
    return lookups.spaces_of_building(r.spaces, "Building 12", date(2023, 5, 1))


@query
def adhoc_history_sorted(r):
    return lookups.history_of_location(r.spaces, "L7")


@query
def project_rename(r):
    return r.deals.select(
        *SALE,
        F.col("resulting_commitment_term_end").alias("term_end_date"),
        F.col("reservation_price_usd").alias("list_price_usd"),
    )


@query
def distinct_project(r):
    return texts.distinct_texts(r.reservations.select("uuid", "notes"), "notes")


@query
def sorted_output(r):
    buildings = r.locations.select(F.col("uuid").alias("location_uuid"), "region", "territory")
    rows = r.spaces.select("date", "report_month", "location_uuid").distinct()
    cols = ["date", "report_month", "region", "territory", "location_uuid"]
    return rows.join(buildings, "location_uuid").select(*cols).orderBy(*[F.asc_nulls_last(c) for c in cols])


# --- predicates --------------------------------------------------------------


@query
def filter_eq(r):
    return r.records.filter(F.col("territory") == "Brazil").select(*SALE, "price_id", "price_local")


@query
def filter_neq(r):
    return r.spaces.filter(F.col("sku") != population.EXCLUDED_SKU).select("date", "reservable_uuid", "sku", "occupancy")


@query
def filter_in_notin(r):
    return r.deals.filter(
        ~F.col("region").isin(*population.EXCLUDED_REGIONS)
        & X.in_or_null("product_grouping", BRAND.product_groupings)
        & X.not_in_or_null("reservable_name", BRAND.membership_names)
        & ~F.col("reservation_deal_activity").isin(*population.CLOSING_ACTIVITIES)
    ).select(*SALE, "product_grouping", "reservable_name")


@query
def filter_range(r):
    return occupancy.next_months(r.spaces, AS_OF).select("date", "reservable_uuid", "location_uuid", "occupancy")


@query
def filter_between(r):
    return r.desks.filter(
        F.col("sales_reporting_month").between(F.lit(relocation.FIRST_MONTH), F.lit(relocation.LAST_MONTH))
    ).select("deal_uuid", "reservable_uuid", "sales_reporting_month")


@query
def filter_null_tolerant(r):
    return population.without_affiliates(r.spaces, r.accounts).select(
        "date", "reservable_uuid", "account_uuid", "occupancy"
    )


@query
def bool_precedence(r):
    return r.desks.filter(
        (F.col("deal_type") == "Transfer")
        | ((F.col("deal_type") == "Move Out Notice") & (F.col("net_commitment_term_months_changed") < 0))
    ).select("deal_uuid", "reservable_uuid", "deal_type", "net_commitment_term_months_changed")


@query
def population_filter(r):
    buildings = population.reported_territories(r.locations).select(F.col("uuid").alias("location_uuid"), "country")
    return (
        r.deals.filter(population.reported_sale(BRAND))
        .join(buildings, "location_uuid")
        .select(*SALE, "location_uuid", "country", "product")
    )


# --- text rules --------------------------------------------------------------


@query
def like_rules(r):
    notes = r.reservations.filter(F.col("notes").isNotNull())
    return notes.select("uuid", *[like_test(F.col("notes"), p).alias(n) for n, p in LIKE_PATTERNS.items()])


@query
def ilike_rules(r):
    notes = r.reservations.filter(F.col("notes").isNotNull()).withColumn("low", F.lower("notes"))
    return notes.select("uuid", *[like_test(F.col("low"), p.lower()).alias(n) for n, p in LIKE_PATTERNS.items()])


@query
def note_tag_counts(r):
    return promos.note_tag_counts(r.reservations).select("uuid", "created_at", "label", "tag")


@query
def note_tags(r):
    return promos.note_tags(r.reservations)


@query
def promo_applied(r):
    moved = relocation.relocation_deals(r.desks, r.reservables, r.exits).withColumn("_moved", F.lit(True))
    tags = promos.note_tags(r.reservations).select(
        F.col("uuid").alias("primary_reservation_uuid"), F.col("created_month").alias("sales_reporting_month"), "rule"
    )
    latest = promos.with_code_outcome(materialize(promos.latest_promo(_active(r))))
    rows = sales.with_latest_promo(r.deals, latest)
    rows = rows.join(moved, "deal_uuid", "left").join(tags, ["primary_reservation_uuid", "sales_reporting_month"], "left")
    label = promos.promo_label(F.coalesce("_moved", F.lit(False)), F.col("_code_rule"), F.col("rule"))
    return rows.select(*SALE, "applied_discount", label.alias("promo_applied"))


# --- scalars -----------------------------------------------------------------


@query
def null_handling(r):
    return r.deals.select(
        *SALE,
        F.coalesce("resulting_commitment_term_start", "reservation_start_date").alias("move_in_date"),
        F.nullifzero("resulting_commitment_term_months").alias("months_or_null"),
        F.zeroifnull("resulting_commitment_term_months").alias("months_or_zero"),
    )


@query
def safe_division(r):
    value = F.col("reservation_price_usd") * F.col("resulting_commitment_term_months")
    return r.deals.select(*SALE, X.div0("core_committed_value_usd", value).alias("paid_share"))


@query
def text_concat(r):
    buildings = r.locations.select(F.col("uuid").alias("location_uuid"), "building_code")
    return r.deals.join(buildings, "location_uuid", "left").select(
        *SALE, X.building_label("building_code", "location_name").alias("building_code_and_name")
    )


@query
def month_columns(r):
    return r.spaces.select(
        "reservable_uuid",
        "report_month",
        X.month_of("commitment_term_created_utc").alias("sale_month"),
        X.month_of("commitment_term_start_utc").alias("start_month"),
        X.month_of("commitment_term_end_utc").alias("end_month"),
    )


@query
def term_id(r):
    return r.spaces.select("reservable_uuid", "reservation_uuid", X.term_key("term_id", "report_month").alias("term_id"))


@query
def lateral_alias_chain(r):
    rows = sales.with_policy(r.deals.withColumn("max_discount", F.lit(0.05)))
    return rows.select(*SALE, "avg_disc", "Disc_Difference", "OOP")


@query
def sku_bucket(r):
    return r.spaces.select(
        "reservable_uuid",
        "report_month",
        X.sku_bucket().alias("sku_group"),
        F.when(F.col("sku") == "DD", "DD").otherwise(F.col("reservable_type")).alias("sku_or_type"),
    )


@query
def occupancy_band(r):
    share = X.ratio("sku_occupancy", "sku_capacity")
    return occupancy.sku_group_occupancy(_active(r)).select(
        "date", "location_uuid", "sku_group", X.occupancy_band(share).alias("occupancy_group")
    )


@query
def memberships(r):
    return r.spaces.select("reservable_uuid", "report_month", X.memberships().alias("memberships"))


# --- occupancy ---------------------------------------------------------------


@query
def sku_group_occupancy(r):
    return occupancy.sku_group_occupancy(_active(r, population.INVENTORY_START))


@query
def location_occupancy(r):
    return occupancy.location_occupancy(occupancy.sku_group_occupancy(_active(r, population.INVENTORY_START)))


@query
def current_occupancy(r):
    return occupancy.current_occupancy(_active(r), r.locations)


@query
def forward_occupancy(r):
    return occupancy.forward_occupancy(occupancy.forward_occupancy_by_sku(_active(r), AS_OF))


@query
def sku_forward_occupancy(r):
    return occupancy.forward_occupancy_by_sku(_active(r), AS_OF)


@query
def group_by_forms(r):
    return (
        r.spaces.groupBy("location_uuid", F.year("date").alias("year"), X.sku_bucket().alias("sku_group"))
        .agg(F.sum("occupancy").alias("occupancy"), F.count("*").alias("n"))
    )


# --- joins -------------------------------------------------------------------


@query
def left_join_single(r):
    notes = r.reservations.select(F.col("uuid").alias("primary_reservation_uuid"), "notes").distinct()
    return r.deals.join(notes, "primary_reservation_uuid", "left").select(*SALE, "notes")


@query
def left_join_composite(r):
    now = occupancy.current_occupancy(_active(r), r.locations).withColumnRenamed("report_month", SALE[0])
    return r.deals.join(now, [SALE[0], "location_uuid"], "left").select(*SALE, "location_uuid", "occ_current", "cap_current")


@query
def left_join_using(r):
    return r.spaces.join(r.accounts, "account_uuid", "left").select("account_uuid", "reservable_uuid", "date", "is_affiliate")


@query
def join_computed_key(r):
    tags = promos.note_tags(r.reservations)
    keyed = tags.select(F.col("uuid").alias(SALE[2]), F.col("created_month").alias(SALE[0]), "rule")
    return r.deals.join(keyed, [SALE[2], SALE[0]], "left").select(*SALE, "rule")


@query
def left_then_reject(r):
    kept = population.reported_territories(population.reported_regions(r.locations))
    buildings = kept.select(F.col("uuid").alias("location_uuid"), "region", "territory")
    return r.spaces.join(buildings, "location_uuid").select("date", "reservable_uuid", "location_uuid", "region", "territory")


def _listed(r):
    listed = r.exclusions.select(
        "deal_uuid", F.col("reservation_uuid").alias(SALE[2]), "reason_for_exclusion", F.lit(True).alias("_listed")
    )
    return r.deals.join(listed, ["deal_uuid", SALE[2]], "left")


@query
def sublease_flag(r):
    flag = X.flagged_label("reason_for_exclusion", F.col("_listed"), population.SUBLEASE, population.NOT_SUBLEASE)
    return _listed(r).select(*SALE, flag.alias("incl_excl_sublease"))


@query
def exclusion_filter(r):
    return population.keep_unless_reason(_listed(r), F.col("_listed")).select(*SALE, "reason_for_exclusion")


# --- intervals and rates -----------------------------------------------------


def _with_sale_discount(r):
    rows = r.deals.withColumn("term", X.discount_term_bucket("resulting_commitment_term_months"))
    found = discounts.sale_discounts(r.deals, r.discount_versions)
    return rows.join(found, ["reservable_uuid", "term", "initial_sale_date"], "left").withColumn(
        "max_discount", F.coalesce("recommended_discount", F.lit(0.0))
    )


@query
def discount_at_sale(r):
    return _with_sale_discount(r).select(*SALE, "term", "max_discount")


@query
def max_discount_month(r):
    return discounts.max_discount_by_month(r.spaces, r.locations, r.discount_versions)


@query
def fx_rate(r):
    keyed = rates.monthly_rates(r.rates, SALE[0], "currency")
    return r.deals.join(keyed, [SALE[0], "currency"], "left").select(*SALE, "currency", "budget_rate")


@query
def fx_rate_frozen(r):
    return rates.with_frozen_rate(r.spaces, r.rates).select(
        "reservable_uuid", "report_month", "local_currency", "budget_rate"
    )


@query
def vat_factor(r):
    factors = rates.vat_factors(r.records).drop("territory")
    return r.deals.join(factors, SALE, "left").select(*SALE, "vat_adjust_factor")


# --- pricing -----------------------------------------------------------------


@query
def floor_price(r):
    months = "resulting_commitment_term_months"
    return _with_sale_discount(r).select(
        *SALE,
        X.floor_price("reservation_price_usd", "max_discount", months).alias("floor_price_usd"),
        X.floor_price("reservation_price_local", "max_discount", months).alias("floor_price_local"),
        X.floor_price("reservation_price_usd", "max_discount").alias("monthly_floor_usd"),
    )


@query
def policy_verdict(r):
    return sales.with_policy(_with_sale_discount(r)).select(*SALE, "max_discount", "avg_disc", "Disc_Difference", "OOP")


@query
def mrr(r):
    return free_months.monthly_rate(r.deals, BRAND).select(*SALE, "MRR")


@query
def free_month_detect(r):
    return free_months.free_month_records(r.records, free_months.monthly_rate(r.deals, BRAND)).select(
        *SALE, "price_id", "applied_months", "price_local", "MRR", "disc_desk_months", "is_free_month"
    )


@query
def free_months_rollup(r):
    return free_months.free_months(r.records, free_months.monthly_rate(r.deals, BRAND))


QUERIES["free_months"] = QUERIES.pop("free_months_rollup")


@query
def net_desk_months(r):
    free = free_months.free_months(r.records, free_months.monthly_rate(r.deals, BRAND))
    return r.deals.join(free, SALE, "left").select(
        *SALE,
        (F.col("desk_months") - F.zeroifnull("disc_desk_months")).alias("desk_months_xfm"),
        F.zeroifnull("applied_months").alias("applied_free_months"),
    )


# --- windows -----------------------------------------------------------------


@query
def row_number_global(r):
    rows = r.deals.select(*SALE, "gross_desk_sales")
    return ordering.number_rows(rows, [F.asc_nulls_last(c) for c in SALE], "Row_Number")


@query
def latest_promo(r):
    return promos.latest_promo(_active(r))


@query
def running_max(r):
    return promos.promo_history(_active(r))


@query
def latest_promo_join(r):
    rows = sales.with_latest_promo(r.deals, promos.latest_promo(_active(r)))
    return rows.select(*SALE, "resulting_commitment_term_start", "applied_discount")


@query
def deal_size_band(r):
    rows = r.deals.select(*SALE, sales.resulting_desks().alias("resulting_desks"))
    hot = HotKeys.find(r.deals, [("deal_uuid", SALE[0])])
    rows = ordering.with_group_total(rows, ["deal_uuid", SALE[0]], "resulting_desks", "deal_capacity", hot)
    return rows.withColumn("deal_capacity_group", X.deal_size_band("deal_capacity"))


@query
def adjusted_sales_filter(r):
    moved = relocation.relocation_deals(r.desks, r.reservables, r.exits)
    return sales.with_adjusted_sales(r.deals, moved).select(*SALE, "gross_desk_sales", "gross_desk_sales_mod")


# --- lifecycle ---------------------------------------------------------------


@mart_query
def renewal_class(r):
    return renewals.renewal_class(r.records)


@query
def renewal_join(r):
    rows = r.spaces.withColumn("term_key", X.term_key("term_id", "report_month"))
    return renewals.with_renewal_flag(rows, renewals.renewal_class(r.records)).select(
        "reservable_uuid", "report_month", "reservation_uuid", "term_key", "renewal_flag"
    )


@query
def relocation_deals(r):
    return relocation.relocation_deals(r.desks, r.reservables, r.exits)


@query
def relocation_deals_ext(r):
    return relocation.relocation_deals(r.desks, r.reservables, r.exits, include_shortened=True)


@query
def relocation_flag(r):
    deals = relocation.relocation_deals(r.desks, r.reservables, r.exits, include_shortened=True)
    moved = relocation.relocated_reservations(r.desks, deals).select(
        F.col("primary_reservation_uuid").alias("reservation_uuid"), F.lit("Relocation Deal").alias("is_relocation_deal")
    )
    return r.spaces.join(moved, "reservation_uuid", "left").select(
        "reservable_uuid", "report_month", "reservation_uuid", "is_relocation_deal"
    )


# --- contacts ----------------------------------------------------------------


@query
def email_list(r):
    mails = contacts.opportunity_emails(r.opportunities, r.team_members, r.users)
    return contacts.sale_emails(r.deals, mails)


# --- quality -----------------------------------------------------------------


@mart_query
def dq_unique_sales(r):
    return quality.duplicates(sales.sales_rows(r, BRAND, AS_OF), SALE)


@mart_query
def dq_unique_inventory(r):
    return quality.duplicates(inventory.inventory_rows(r, columns=["reservable_uuid", "report_month"]), ["reservable_uuid", "report_month"])


@mart_query
def dq_sales_population(r):
    return quality.sales_population(sales.sales_rows(r, BRAND, AS_OF), population.SALES_START)


@mart_query
def dq_inventory_population(r):
    return quality.inventory_population(inventory.inventory_rows(r, columns=["date"]), population.INVENTORY_START)


@mart_query
def dq_exclusions(r):
    listed = r.exclusions.withColumnRenamed("reservation_uuid", SALE[2])
    sold = quality.not_listed(
        sales.sales_rows(r, BRAND, AS_OF), listed, ["deal_uuid", SALE[2]], population.UPLOAD_ERROR, "sales exclusions"
    )
    held = quality.not_listed(
        inventory.inventory_rows(r, columns=["reservation_uuid"]), r.exclusions, ["reservation_uuid"], population.UPLOAD_ERROR, "inventory exclusions"
    )
    return sold.union(held)


@mart_query
def dq_written_marts(r):
    """The checks of both marts, taken while each is written once."""
    told = [
        sinks.write_by_month(
            sales.sales_rows(r, BRAND, AS_OF), scratch(r.exclusions.sparkSession), SALE[0], checks=quality.sales_checks(r.exclusions, population.SALES_START)
        ),
        sinks.write_by_month(
            inventory.inventory_rows(r), scratch(r.exclusions.sparkSession), "report_month", checks=quality.inventory_checks(r.exclusions, population.INVENTORY_START)
        ),
    ]
    return told[0].union(told[1])


# --- marts -------------------------------------------------------------------


@mart_query
def sales_mart(r):
    return sales.sales_mart(r, BRAND, AS_OF)


@mart_query
def inventory_mart(r):
    return inventory.inventory_mart(r)
