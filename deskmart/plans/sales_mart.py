"""Sales mart: one row per sales transaction that sold at least one desk."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskmart.functions.expr import (
    building_label,
    deal_size_band,
    discount_term_bucket,
    div0,
    flagged_label,
    floor_price,
    occupancy_band,
    policy_label,
)
from deskmart.functions.promo_rules import PROMO_RULES, PromoRule
from deskmart.operators.contacts import opportunity_emails, sale_emails
from deskmart.operators.discounts import sale_discounts
from deskmart.operators.free_months import free_months, monthly_rate
from deskmart.operators.occupancy import current_occupancy, forward_occupancy, forward_occupancy_by_sku
from deskmart.operators.ordering import number_in_groups, row_key, rows_before
from deskmart.operators.population import (
    CLOSING_ACTIVITIES,
    NOT_SUBLEASE,
    SALES_START,
    SUBLEASE,
    Brand,
    active_spaces,
    keep_unless_reason,
    reported_sale,
    reported_territories,
)
from deskmart.operators.promos import latest_promo, note_tags, promo_label, with_code_outcome
from deskmart.operators.rates import monthly_rates, vat_factors
from deskmart.operators.relocation import relocation_deals
from deskmart.operators.sizing import BROADCAST_ROWS, materialize, measured, plan_plainly, together
from deskmart.operators.skew import ROWS_PER_TASK, HotKeys, agree
from deskmart.operators.texts import distinct_texts
from deskmart.sources.roles import Roles

RES, DEAL, MONTH = "primary_reservation_uuid", "deal_uuid", "sales_reporting_month"


def with_adjusted_sales(deals: DataFrame, relocations: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Mark relocation deals, count one more desk for them, keep sales of at least one desk."""
    marked = relocations.withColumn("_relocated", F.lit(True))
    rows = (hot or HotKeys.none()).left_join(deals, marked, [DEAL])
    extra = F.when(F.col("_relocated"), 1).otherwise(0)
    return rows.withColumn("gross_desk_sales_mod", F.col("gross_desk_sales") + extra).filter(
        F.col("gross_desk_sales_mod") > 0
    )


def with_latest_promo(deals: DataFrame, promos: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Attach the code of the commitment that a sale created.

    A sale reported after its commitment began gets none: its start is blanked in
    the key, which keeps the join a hash join. ``promos`` are latest-promo rows, with the
    outcome of their codes or without; several of them per commitment multiply the sale.
    """
    term = {
        RES: F.col("reservation_uuid"),
        "_start": F.col("commitment_term_start_utc").cast("timestamp_ntz"),
        "_end": F.col("commitment_term_end_utc").cast("timestamp_ntz"),
    }
    told = [c for c in ("applied_discount", "_code_rule") if c in promos.columns]
    right = promos.select(*[c.alias(n) for n, c in term.items()], *told)
    begins_later = F.col(MONTH) <= F.col("resulting_commitment_term_start")
    rows = deals.withColumns(
        {
            "_start": F.when(begins_later, F.col("resulting_commitment_term_start").cast("timestamp_ntz")),
            "_end": F.col("resulting_commitment_term_end").cast("timestamp_ntz"),
        }
    )
    return (hot or HotKeys.none()).left_join(rows, right, [RES, "_start", "_end"], (RES,)).drop("_start", "_end")


def with_policy(rows: DataFrame) -> DataFrame:
    """Granted discount, its distance to the listed ``max_discount`` and the verdict."""
    months = F.col("resulting_commitment_term_months")
    return (
        rows.withColumn(
            "avg_disc", 1 - div0("core_committed_value_usd", F.col("reservation_price_usd") * months)
        )
        .withColumn("Disc_Difference", F.col("max_discount") - F.col("avg_disc"))
        .withColumn("OOP", policy_label("Disc_Difference"))
    )


def with_sale_key(deals: DataFrame) -> DataFrame:
    """``deals`` with the digest of their ids; a table laid out by it (``plans.layout``) has it already."""
    return deals if SALE in deals.columns else deals.withColumn(SALE, row_key(*SALE_IDS))


def resulting_desks():
    return F.when(~F.col("reservation_deal_activity").isin(*CLOSING_ACTIVITIES), F.col("primary_reservation_capacity_today"))


# Counted for hot values; a join may use one of them that covers some of its columns.
SALE_IDS, _SPACE_DAY = (RES, DEAL, MONTH), ("reservable_uuid", "initial_sale_date")
# Ids may be NULL; where rows of a sale have to find each other, this digest of the three stands for them.
SALE = "_sale"
_JOIN_KEYS = [(DEAL,), (RES,), (RES, DEAL), (RES, MONTH), SALE_IDS, (SALE,), (MONTH, DEAL), ("salesforce_opportunity_id",), _SPACE_DAY, (MONTH, "currency")]

# What the lookups of a sale depend on; few columns next to the width of a sale.
LOOKUP_KEY = [
    RES,
    DEAL,
    MONTH,
    "salesforce_opportunity_id",
    "reservable_uuid",
    "term",
    "initial_sale_date",
    "resulting_commitment_term_start",
    "resulting_commitment_term_end",
]
# What they yield. ``_note`` is the digest of a note, whose text comes last.
LOOKUPS = [
    "recommended_discount",
    "referral_type",
    "email_list",
    "applied_months",
    "disc_desk_months",
    "vat_adjust_factor",
    "_note_rule",
    "applied_discount",
    "_code_rule",
    "_note",
    "reason_for_exclusion",
    "_listed",
    "_relocated",
]


def sale_lookups(
    sold: DataFrame, exclusions: DataFrame, opportunities: DataFrame, records: DataFrame, hot: HotKeys, free: DataFrame, mails: DataFrame,
    discounts: DataFrame, promos: DataFrame, tags: DataFrame, moved: DataFrame, notes: DataFrame,
) -> DataFrame:
    """All lookups keyed by ids of a sale, on its distinct :data:`LOOKUP_KEY`.

    Each lookup has another key, so each moves its rows. Here the moving rows are
    the ids alone; the wide sales meet the finished lookups in a single join. Since
    the lookups depend on the key only, that join multiplies a sale exactly as the
    separate joins would. Of a note only the digest is looked up, so no text moves.
    """
    referrals = opportunities.select(
        F.col("sf_opportunity_id").alias("salesforce_opportunity_id"), "referral_type"
    )
    listed = exclusions.select(
        DEAL, F.col("reservation_uuid").alias(RES), "reason_for_exclusion", F.lit(True).alias("_listed")
    )
    vat = vat_factors(records).drop("territory")

    rows = sold.select(*LOOKUP_KEY).distinct()
    rows = keep_unless_reason(hot.left_join(rows, listed, [RES, DEAL]), F.col("_listed"))
    rows = hot.left_join(rows, moved.withColumn("_relocated", F.lit(True)), [DEAL])
    rows = hot.left_join(rows, tags, [RES, MONTH])
    rows = with_latest_promo(rows, promos, hot)
    rows = hot.left_join(rows, notes, [RES])
    # Texts and what multiplies most come late, so that they move through few joins.
    rows = hot.left_join(rows, referrals, ["salesforce_opportunity_id"])
    rows = hot.left_join(rows, free, SALE_IDS)
    rows = hot.left_join(rows, vat, SALE_IDS)
    rows = hot.left_join(rows, mails, SALE_IDS)
    return hot.left_join(rows, discounts, ["reservable_uuid", "term", "initial_sale_date"], _SPACE_DAY).select(*LOOKUP_KEY, *LOOKUPS)


# What the lookups, filters and counts of a sale read: about half of its columns, written once and read by all of them.
NARROW = [
    *[c for c in LOOKUP_KEY if c != "term"],
    "resulting_commitment_term_months",
    "region",
    "subregion",
    "location_uuid",
    "sku",
    "currency",
    "product",
    "product_grouping",
    "reservable_name",
    "reservation_deal_activity",
    "is_affiliate",
    "primary_reservation_capacity",
    "primary_reservation_capacity_today",
    "gross_desk_sales",
    "gross_committed_value_changed_before_discount_local",
    "addon_committed_value_changed_local",
]


@dataclass(frozen=True)
class Joined:
    """Sales with everything joined: those whose ids are in few rows, those whose ids are hot (None without such), all with few columns of their own.

    ``noted`` has the reservation and the digests of the notes of each sale that has any."""

    rows: DataFrame
    large: DataFrame | None
    slim: DataFrame
    hot: HotKeys
    noted: DataFrame


def _joined_sales(
    roles: Roles, brand: Brand, as_of: date | None, rules: Sequence[PromoRule], rows_per_task: int | None,
    months: tuple[date, date] | None,
) -> Joined:
    """The sales with everything joined.

    Filters and the joins to small tables leave the wide rows in place; the lookups
    then arrive in one join, for which sales and lookups are dealt out by the digest of a sale's ids, any of which may be NULL.
    """

    def sold(deals: DataFrame) -> DataFrame:
        kept = deals.filter(reported_sale(brand))
        if months is not None:
            kept = kept.filter(F.col(MONTH).between(F.lit(months[0]), F.lit(months[1])))
        return with_sale_key(kept.withColumn("term", discount_term_bucket("resulting_commitment_term_months")))

    def sold_desks() -> DataFrame:
        """The written sales; those of no desk, not even one for a relocation, go before their ids move."""
        kept = sold(deals).filter(F.col("gross_desk_sales") > -1)
        return with_adjusted_sales(kept, moved).drop("_relocated", "gross_desk_sales_mod") if few_moved else kept

    plan_plainly(roles.deals.sparkSession)
    active = active_spaces(roles.spaces, measured(roles.accounts.filter("is_affiliate")))
    # Lookups keyed by the month of a sale meet no sale before the first reported month.
    reported = F.col(MONTH) >= F.lit(SALES_START)
    records = roles.records.filter(reported)
    # Independent, and each much narrower than what it reads: computed side by side, then joined.
    deals, by_sku, now, moved, tags, rates, promos, notes, hot_versions = together(
        lambda: materialize(roles.deals.select(*NARROW)).filter(reported),
        lambda: measured(forward_occupancy_by_sku(active, as_of)),
        lambda: measured(
            current_occupancy(active, roles.locations).select(
                F.col("report_month").alias(MONTH), "location_uuid", "occ_current", "cap_current"
            )
        ),
        lambda: measured(relocation_deals(roles.desks, roles.reservables, roles.exits)),
        lambda: measured(
            note_tags(roles.reservations, rules).select(
                F.col("uuid").alias(RES), F.col("created_month").alias(MONTH), F.col("rule").alias("_note_rule")
            )
        ),
        lambda: measured(monthly_rates(roles.rates, MONTH, "currency")),
        lambda: materialize(latest_promo(active.filter(F.col("reservation_uuid").isNotNull()))),
        lambda: materialize(roles.reservations.select(F.col("uuid").alias(RES), F.md5("notes").alias("_note")).distinct()),
        lambda: HotKeys.find(roles.discount_versions, [("reservable_uuid", "term")], rows_per_task),
    )
    few_moved = moved.count() <= BROADCAST_ROWS
    ahead, hot, team, free, discounts = together(
        lambda: measured(forward_occupancy(by_sku).drop("location_name")),
        lambda: HotKeys.find(with_sale_key(deals), _JOIN_KEYS, rows_per_task),
        lambda: materialize(opportunity_emails(roles.opportunities, roles.team_members, roles.users)),
        lambda: materialize(free_months(records, monthly_rate(deals, brand)).drop("MRR")),
        lambda: materialize(sale_discounts(sold_desks(), roles.discount_versions, hot_versions)),
    )
    mails = materialize(sale_emails(deals, team, hot).drop("salesforce_opportunity_id"))
    promos = with_code_outcome(promos, rules)
    lookups = materialize(sale_lookups(sold_desks(), roles.exclusions, roles.opportunities, records, hot, free, mails, discounts, promos, tags, moved, notes))

    ahead_by_sku = by_sku.select("location_uuid", "sku", "SKU_occ", "SKU_capacity")
    buildings = reported_territories(roles.locations).select(
        F.col("uuid").alias("location_uuid"), "country", "market", "building_code"
    )
    others = [c for c in LOOKUP_KEY if c not in SALE_IDS]
    noted = lookups.filter(F.col("_note").isNotNull()).select(row_key(*SALE_IDS).alias(SALE), RES, "_note").distinct()
    found = lookups.withColumn(SALE, row_key(*SALE_IDS)).drop(*SALE_IDS).withColumnsRenamed({c: f"_of_{c}" for c in others})

    def told(rows: DataFrame) -> DataFrame:
        rows = hot.left_join(rows.join(buildings, "location_uuid"), rates, [MONTH, "currency"])
        rows = rows.join(ahead, "location_uuid", "left")
        rows = rows.join(ahead_by_sku, ["location_uuid", "sku"], "left")
        rows = rows.join(now, [MONTH, "location_uuid"], "left")
        # Every sale has a lookup row, unless an exclusion removed it.
        same_key = agree(others, [f"_of_{c}" for c in others])
        rows = hot.join(rows, found.hint("merge"), [SALE], "inner", residual=same_key)
        rows = rows.drop(*[f"_of_{c}" for c in others]).withColumn("resulting_desks", resulting_desks())
        extra = F.when(F.col("_relocated"), 1).otherwise(0)
        return rows.withColumn("gross_desk_sales_mod", F.col("gross_desk_sales") + extra).filter("gross_desk_sales_mod > 0")

    wide = sold(roles.deals)
    large = hot.tables.get((SALE,))
    if large is None:
        return Joined(told(wide), None, told(sold_desks()), hot, noted)
    keys = large.select(SALE)
    return Joined(told(wide.join(keys, SALE, "left_anti")), told(wide.join(keys, SALE, "left_semi")), told(sold_desks()), hot, noted)


def sales_rows(
    roles: Roles,
    brand: Brand,
    as_of: date | None,
    rules: Sequence[PromoRule] = PROMO_RULES,
    rows_per_task: int | None = ROWS_PER_TASK,
    months: tuple[date, date] | None = None,
) -> DataFrame:
    """The filtered sales with everything joined but the text of the notes, before totals and numbering."""
    joined = _joined_sales(roles, brand, as_of, rules, rows_per_task, months)
    rows = joined.rows if joined.large is None else joined.rows.unionByName(joined.large)
    return rows.drop(SALE)


def sale_texts(noted: DataFrame, reservations: DataFrame, hot: HotKeys) -> DataFrame:
    """``notes`` of each sale with the digest that tells them apart, written once. The texts find the few ids of the sales, so that the
    wide rows need not move to the texts."""
    texts = distinct_texts(reservations.select(F.col("uuid").alias(RES), "notes"), "notes").withColumn("_digest", F.md5("notes"))
    found = hot.join(noted, texts, [RES], "inner", residual=agree(["_note"], ["_digest"]))
    return materialize(found.select(SALE, "_digest", "notes"))


def with_numbers(joined: Joined, texts: DataFrame | None = None) -> DataFrame:
    """``Row_Number`` of each sale, and ``deal_capacity``, the desks of its deal and month; its ``notes`` too, if :func:`sale_texts` are given.

    Both follow from the (month, deal, reservation) groups of the slim rows: rows are counted and desks summed, and
    running totals in report order say where a group starts. Only the places inside a group need the sales themselves. The
    groups lie where the join with the lookups has left them, so a window finds the places; a group too large for a task is sorted by
    range and numbered in pieces.
    """
    groups = joined.slim.groupBy(SALE, *SALE_IDS).agg(F.count("*").alias("_rows"), F.sum("resulting_desks").alias("_desks"))
    groups = rows_before(groups, [MONTH, DEAL, RES], "_rows", "_first")
    totals = groups.groupBy(MONTH, DEAL).agg(F.sum("_desks").alias("deal_capacity"))
    places = joined.hot.join(groups, totals, [MONTH, DEAL], "inner", null_safe=True).select(SALE, "_first", "deal_capacity")
    order = [F.asc_nulls_last(c) for c in NUMBER_ORDER]
    placed = joined.rows.withColumn("_place", F.row_number().over(Window.partitionBy(SALE).orderBy(*order)))
    numbered = placed.join(places.hint("merge"), SALE)
    same_note = agree(["_note"], ["_digest"])
    if texts is not None:
        numbered = HotKeys.none().left_join(numbered, texts.hint("merge"), [SALE], residual=same_note)
    if joined.large is not None:
        few = places.join(joined.hot.tables[(SALE,)].select(SALE), SALE, "left_semi")  # a row per hot group
        large = number_in_groups(joined.large, SALE, order, "_place").join(F.broadcast(few), SALE)
        if texts is not None:
            large = joined.hot.left_join(large, texts, [SALE], residual=same_note)
        numbered = numbered.unionByName(large)
    return numbered.withColumn("Row_Number", F.col("_first") + F.col("_place")).drop("_first", "_place", "_digest", SALE)


def sales_mart(
    roles: Roles,
    brand: Brand,
    as_of: date | None = None,
    rules: Sequence[PromoRule] = PROMO_RULES,
    rows_per_task: int | None = ROWS_PER_TASK,
    months: tuple[date, date] | None = None,
) -> DataFrame:
    """The 69 columns of the mart; ``Row_Number`` tells the order, the rows come in none.

    Sales that a join multiplies stay multiplied, each with its own number, as in
    the report this reproduces; ``quality.duplicates`` shows them. ``months`` (first and last) limits the
    sales, whose numbers then start at 1.
    """
    joined = _joined_sales(roles, brand, as_of, rules, rows_per_task, months)
    rows = with_numbers(joined, sale_texts(joined.noted, roles.reservations, joined.hot))
    months = "resulting_commitment_term_months"
    rows = with_policy(rows.withColumn("max_discount", F.coalesce("recommended_discount", F.lit(0.0))))
    return rows.select(
        "Row_Number",
        MONTH,
        "initial_sale_date",
        F.coalesce("resulting_commitment_term_start", "reservation_start_date").alias("move_in_date"),
        "reservation_start_date",
        "reservation_end_date",
        F.col("resulting_commitment_term_end").alias("term_end_date"),
        "region",
        "subregion",
        "territory",
        "country",
        "sales_market",
        "market",
        "city",
        "location_name",
        "location_uuid",
        building_label("building_code", "location_name").alias("building_code_and_name"),
        "n3m_AddOccup",
        "n3m_AddCap",
        "occ_current",
        "cap_current",
        DEAL,
        "deal_type",
        "referral_type",
        "reservation_deal_activity",
        "salesforce_opportunity_id",
        "is_renewal_deal",
        flagged_label("reason_for_exclusion", F.col("_listed"), SUBLEASE, NOT_SUBLEASE).alias("incl_excl_sublease"),
        "sales_account_name",
        "billing_account_name",
        "reservable_name",
        "product_grouping",
        "reservable_uuid",
        RES,
        "commitment_bucket",
        "sku",
        F.when(F.col("sku") == "DD", "DD").otherwise(F.col("sku_group")).alias("sku_group"),
        "SKU_occ",
        "SKU_capacity",
        "resulting_desks",
        "deal_capacity",
        deal_size_band("deal_capacity").alias("deal_capacity_group"),
        "primary_reservation_capacity",
        months,
        (F.col("desk_months") - F.zeroifnull("disc_desk_months")).alias("desk_months_xfm"),
        F.zeroifnull("applied_months").alias("applied_free_months"),
        "desk_months",
        "budget_rate",
        "vat_adjust_factor",
        "reservation_price_usd",
        "reservation_price_local",
        "max_discount",
        floor_price("reservation_price_usd", "recommended_discount", months).alias("floor_price_usd"),
        floor_price("reservation_price_local", "recommended_discount", months).alias("floor_price_local"),
        "core_committed_value_usd",
        "core_committed_value_local",
        "gross_desk_sales",
        "new_desk_sales",
        "renewal_desk_sales",
        "avg_disc",
        "Disc_Difference",
        "OOP",
        occupancy_band("n3m_Occupancy").alias("occupancy_group"),
        "email_list",
        "applied_discount",
        promo_label(
            F.coalesce("_relocated", F.lit(False)), F.col("_code_rule"), F.col("_note_rule"), rules
        ).alias("promo_applied"),
        "notes",
        "gross_desk_sales_mod",
        "_run_at",
    )


# The report orders by month, deal and reservation. The others settle sales that a join multiplied or that are
# repeated: first what the lookups yield, then the sale's own columns. Sales alike in all of them are copies.
NUMBER_ORDER = [
    "n3m_AddOccup",
    "n3m_AddCap",
    "SKU_occ",
    "SKU_capacity",
    "budget_rate",
    "vat_adjust_factor",
    "recommended_discount",
    "applied_discount",
    "email_list",
    "reason_for_exclusion",
    "referral_type",
    "_note",
    "salesforce_opportunity_id",
    "reservable_uuid",
    "location_uuid",
    "initial_sale_date",
    "reservation_start_date",
    "reservation_end_date",
    "resulting_commitment_term_start",
    "resulting_commitment_term_end",
    "resulting_commitment_term_months",
    "region",
    "subregion",
    "territory",
    "sales_market",
    "city",
    "location_name",
    "deal_type",
    "reservation_deal_activity",
    "is_renewal_deal",
    "sales_account_name",
    "billing_account_name",
    "reservable_name",
    "product_grouping",
    "commitment_bucket",
    "sku",
    "sku_group",
    "currency",
    "primary_reservation_capacity",
    "primary_reservation_capacity_today",
    "gross_desk_sales",
    "new_desk_sales",
    "renewal_desk_sales",
    "desk_months",
    "reservation_price_usd",
    "reservation_price_local",
    "core_committed_value_usd",
    "core_committed_value_local",
    "_run_at",
]
