"""Business rules on hand-written rows: boundaries, NULLs, ties."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from deskmart.functions import expr as X
from deskmart.operators import contacts, discounts, free_months, lookups, occupancy, population, quality, rates, relocation, renewals
from deskmart.operators.population import Brand
from deskmart.plans import sales_mart as sales

BRAND = Brand("Acme", "AC")


def values(df, c, inputs, kind):
    rows = df.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(inputs)], f"i int, {kind}")
    return [r.out for r in rows.select("i", c.alias("out")).orderBy("i").collect()]


def test_sku_bucket(spark):
    got = values(spark, X.sku_bucket(), [("DD", 60), ("S", 9), ("S", 10), ("S", 49), ("S", 50), ("S", None), (None, 3)], "sku string, capacity int")
    assert got == ["DD", "1-9P", "10-49P", "10-49P", "50P+", None, "1-9P"]


def test_deal_size_band(spark):
    got = values(spark, X.deal_size_band("n"), [1, 9, 10, 49, 50, 0, None], "n int")
    assert got == ["1-9P", "1-9P", "10-49P", "10-49P", "50P+", "50P+", "50P+"]


def test_occupancy_band(spark):
    got = values(spark, X.occupancy_band("s"), [0.5999, 0.6, 0.7, 0.8, 0.9, 1.4, None], "s double")
    assert got == ["<60%", "60-69%", "70-79%", "80-89%", "90%+", "90%+", None]


def test_term_bucket(spark):
    got = values(spark, X.discount_term_bucket("m"), [0, 1, 2, 6, 7, 12, 13, 24, 25, None], "m int")
    assert got == [1, 1, 6, 6, 12, 12, 24, 24, 36, 1]


def test_div0_and_ratio(spark):
    pairs = [(6, 3), (6, 0), (None, 3), (6, None), (None, 0)]
    assert values(spark, X.div0("a", "b"), pairs, "a int, b int") == [2.0, 0.0, None, None, 0.0]
    assert values(spark, X.ratio("a", "b"), pairs, "a int, b int") == [2.0, None, None, None, None]


def test_term_key_and_label(spark):
    got = values(spark, X.term_key("t", "m"), [("7", date(2023, 5, 1)), (None, date(2023, 5, 1)), (None, None)], "t string, m date")
    assert got == ["7", "M2M2023-05-01", None]
    assert values(spark, X.building_label("a", "b"), [("B1", "Main"), (None, "Main")], "a string, b string") == ["B1 - Main", None]


def test_memberships(spark):
    got = values(spark, X.memberships("f", "r", "c"), [(6, 6, 4), (6, 5, 4), (None, None, 4)], "f int, r int, c int")
    assert got == [4, 0, 0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_month_is_independent_of_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, X.month_of("t"), [datetime(2023, 5, 31, 23, 59), datetime(2023, 6, 1)], "t timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [date(2023, 5, 1), date(2023, 6, 1)]


def test_policy(spark):
    rows = spark.createDataFrame(
        [(0, 0.0, 0.0, 6, 0.1), (1, 90.0, 10.0, None, 0.1), (2, 89.7, 10.0, 10, 0.1), (3, 90.1, 10.0, 10, 0.1), (4, 85.0, 10.0, 10, 0.1)],
        "i int, core_committed_value_usd double, reservation_price_usd double, resulting_commitment_term_months int, max_discount double",
    )
    got = [(round(r.avg_disc, 6) if r.avg_disc is not None else None, r.OOP) for r in sales.with_policy(rows).orderBy("i").collect()]
    assert got == [(1.0, "OOP"), (None, "In Policy"), (0.103, "OOP"), (0.099, "In Policy"), (0.15, "OOP")]


SPACE = "date date, report_month date, location_uuid string, location_name string, sku string, account_uuid string, occupancy bigint, capacity bigint"


def test_affiliates(spark):
    accounts = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "account_uuid string, is_affiliate boolean")
    spaces = spark.createDataFrame([(k, "S") for k in ("a", "b", "c", "gone", None)] + [("b", "HD"), ("b", None)], "account_uuid string, sku string")
    assert sorted(str(r.account_uuid) for r in population.active_spaces(spaces, accounts).collect()) == ["None", "b", "c", "gone"]


def test_forward_occupancy_window_and_renaming(spark):
    days = [(date(2023, 1, 31), "X"), (date(2023, 2, 1), "X"), (date(2023, 4, 30), "Y"), (date(2023, 5, 1), "X")]
    spaces = spark.createDataFrame([(d, d.replace(day=1), "L", n, "S", None, 1, c) for (d, n), c in zip(days, (5, 4, 0, 3), strict=True)], SPACE)
    by_sku = occupancy.forward_occupancy_by_sku(spaces, date(2023, 1, 31))
    got = sorted(tuple(r) for r in occupancy.forward_occupancy(by_sku).collect())
    assert got == [("L", "X", 1, 4, 0.25), ("L", "Y", 1, 0, None)]


def test_occupancy_levels_keep_unknown_buckets(spark):
    d = date(2023, 5, 1)
    spaces = spark.createDataFrame([(d, d, "L", "X", "S", None, o, c) for o, c in ((2, 5), (3, None), (4, 60))], SPACE)
    got = {r.sku_group: (r.sku_occupancy, r.building_occupancy) for r in occupancy.occupancy_levels(spaces).collect()}
    assert got == {"1-9P": (2, 9), None: (None, 9), "50P+": (4, 9)}


def test_sale_discount_is_half_open_and_max_discount_closed(spark):
    versions = spark.createDataFrame(
        [("p", 6, datetime(2023, 1, 10), datetime(2023, 1, 20), 0.1), ("p", 6, datetime(2023, 1, 20), None, 0.2), ("p", 6, datetime(2023, 1, 25), datetime(2023, 1, 26), 0.3)],
        "reservable_uuid string, term int, start_at timestamp_ntz, end_at timestamp_ntz, recommended_discount double",
    )
    days = [date(2023, 1, n) for n in (9, 10, 20, 25, 26)]
    deals = spark.createDataFrame([("p", 3, d) for d in days], "reservable_uuid string, resulting_commitment_term_months int, initial_sale_date date")
    got = sorted((r.initial_sale_date.day, r.recommended_discount) for r in discounts.sale_discounts(deals, versions).collect())
    assert got == [(10, 0.1), (20, 0.2), (25, 0.2), (25, 0.3), (26, 0.2)]

    spaces = spark.createDataFrame([(d, d, "p", "L", "S") for d in days], "report_month date, date date, reservable_uuid string, location_uuid string, sku string")
    sites = spark.createDataFrame([("L", "EMEA")], "uuid string, region string")
    best = {r.report_month.day: r.reservable_discount for r in discounts.max_discount_by_month(spaces, sites, versions).collect()}
    assert best == {9: 0.0, 10: 0.1, 20: 0.2, 25: 0.3, 26: 0.3}


def test_frozen_rate(spark):
    table = spark.createDataFrame([(date(2022, 11, 1), "EUR", 1.1), (date(2022, 12, 1), "EUR", 1.2), (date(2023, 1, 1), "EUR", 9.9)], "report_month date, source_currency string, budget_rate double")
    months = [(date(2022, 11, 1), "EUR"), (date(2022, 12, 1), "EUR"), (date(2023, 1, 1), "EUR"), (date(2023, 1, 1), "XXX"), (None, "EUR")]
    spaces = spark.createDataFrame(months, "report_month date, local_currency string")
    got = [r.budget_rate for r in rates.with_frozen_rate(spaces, table).orderBy(F.asc_nulls_last("report_month"), "local_currency").collect()]
    assert got == [1.1, 1.2, 1.2, None, None]


RECORD = (
    "primary_reservation_uuid string, term_id string, sales_reporting_month date, term_start_date date, term_end_date date, "
    "is_renewal_deal boolean, sales_record_type string, desk_account_impact string"
)


def test_renewal_class_and_join(spark):
    m, s, e = date(2023, 5, 1), date(2023, 5, 10), date(2023, 11, 9)
    grow = ("Transfer In", "Account Expansion")
    rows = [
        ("renews", "1", m, s, e, True, "New", "None"),
        ("both", "1", m, s, e, True, "New", "None"),
        ("both", "1", m, s, e, False, *grow),
        ("grows", "1", m, s, e, False, *grow),
        ("shrinks", "1", m, s, e, True, "Transfer In", "Account Contraction"),
        ("neither", "1", m, s, e, None, None, None),
        ("monthly", None, m, s, e, True, "New", "None"),
    ]
    classes = renewals.renewal_class(spark.createDataFrame(rows, RECORD))
    got = {r.primary_reservation_uuid: (r.term_id, r.renewal_flag) for r in classes.collect()}
    assert got == {
        "renews": ("1", "Renewal"),
        "both": ("1", "New Sale"),
        "grows": ("1", "New Sale"),
        "shrinks": ("1", "Renewal"),
        "neither": ("1", "New Sale"),
        "monthly": ("M2M2023-05-01", "Renewal"),
    }
    april, may, june = date(2023, 4, 30), date(2023, 5, 2), date(2023, 6, 1)
    spaces = spark.createDataFrame(
        [("local", may, april), ("utc", april, may), ("no", april, june), ("both", may, may)],
        "case string, commitment_term_start_local date, commitment_term_start_utc date",
    ).select("*", F.lit("renews").alias("reservation_uuid"), F.lit("1").alias("term_key"), F.lit(e).alias("commitment_term_end_local"), F.lit(e).alias("commitment_term_end_utc"))
    found = {r.case: r.renewal_flag for r in renewals.with_renewal_flag(spaces, classes).collect()}
    assert found == {"local": "Renewal", "utc": "Renewal", "no": None, "both": "Renewal"}


def test_relocation(spark):
    nov = date(2022, 11, 1)
    desks = [
        ("floor in list", "p1", "L", "US & Canada", "Transfer", nov, nov, 0),
        ("floor not in list", "p2", "L", "US & Canada", "Transfer", nov, nov, 0),
        ("floor unknown", "p3", "L", "US & Canada", "Transfer", nov, nov, 0),
        ("whole building", "p2", "W", "US & Canada", "Transfer", nov, nov, 0),
        ("whole building, floor unknown", "p3", "W", "US & Canada", "Transfer", nov, nov, 0),
        ("before notice", "p1", "L", "US & Canada", "Transfer", date(2022, 10, 1), nov, 0),
        ("late month", "p1", "L", "US & Canada", "Transfer", nov, date(2023, 1, 1), 0),
        ("not in program", "p1", "N", "US & Canada", "Transfer", nov, nov, 0),
        ("notice -1", "p1", "L", "EMEA", "Move Out Notice", nov, nov, -1),
        ("notice 0", "p1", "L", "US & Canada", "Move Out Notice", nov, nov, 0),
        ("notice ?", "p1", "L", "US & Canada", "Move Out Notice", nov, nov, None),
    ]
    desks = spark.createDataFrame(
        [(*d, "r-" + d[0]) for d in desks],
        "deal_uuid string, reservable_uuid string, location_uuid string, region string, deal_type string, initial_sale_date date, "
        "sales_reporting_month date, net_commitment_term_months_changed int, primary_reservation_uuid string",
    )
    floors = spark.createDataFrame([("p1", "F1"), ("p2", "F2"), ("p3", None)], "uuid string, floor_uuid string")
    exits = spark.createDataFrame(
        [("L", "F1,F9", date(2022, 10, 15), True), ("W", None, date(2022, 10, 15), True), ("N", None, date(2022, 10, 15), False)],
        "location_uuid string, floor_uuids string, member_communication_date date, included_in_q_4_spiff boolean",
    )
    plain = {r.deal_uuid for r in relocation.relocation_deals(desks, floors, exits).collect()}
    assert plain == {"floor in list", "whole building"}
    wide = relocation.relocation_deals(desks, floors, exits, include_shortened=True)
    assert {r.deal_uuid for r in wide.collect()} == plain | {"notice -1"}
    flagged = {r.primary_reservation_uuid for r in relocation.relocated_reservations(desks, wide).collect()}
    assert flagged == {"r-floor in list", "r-whole building"}


def test_exclusions(spark):
    rows = spark.createDataFrame(
        [("a", None, None), ("b", True, "Renewal Contract Upload Error"), ("c", True, "Sublease Deal"), ("d", True, "Other"), ("e", True, None)],
        "k string, listed boolean, reason_for_exclusion string",
    )
    kept = population.keep_unless_reason(rows, F.col("listed"))
    flag = X.flagged_label("reason_for_exclusion", F.col("listed"), population.SUBLEASE, population.NOT_SUBLEASE)
    got = {r.k: r.f for r in kept.select("k", flag.alias("f")).collect()}
    assert got == {"a": "Not Sublease Deal", "c": "Sublease Deal", "d": "Not Sublease Deal", "e": "Not Sublease Deal"}


def test_emails(spark):
    opportunities = spark.createDataFrame([("o1", "u3"), ("o2", "u3"), ("o3", None), ("o4", "u9")], "sf_opportunity_id string, opportunity_owner_id string")
    team = spark.createDataFrame([("o1", "u2"), ("o1", "u1"), ("o1", "u1b"), ("o3", "u1"), ("o4", "u5")], "team_sf_object_id string, sf_user_id string")
    users = spark.createDataFrame([("u1", "a@x"), ("u1b", "a@x"), ("u2", "b@x"), ("u3", "own@x"), ("u5", None)], "sf_user_id string, email string")
    mails = contacts.opportunity_emails(opportunities, team, users)
    got = {r.sf_opportunity_id: (r.email_a, r.email_b) for r in mails.collect()}
    assert got == {"o1": ("a@x, b@x", "own@x"), "o2": (None, "own@x"), "o3": ("a@x", None), "o4": (None, None)}
    empty = {r.sf_opportunity_id: r.email_a for r in contacts.opportunity_emails(opportunities, team, users, "").collect()}
    assert empty["o2"] == "" and empty["o1"] == "a@x, b@x"
    deals = spark.createDataFrame(
        [(date(2022, 1, 1), "d1", "r", "o1"), (date(2021, 12, 1), "d2", "r", "o1"), (date(2022, 2, 1), "d3", "r", None), (date(2022, 2, 1), "d4", "r", "o2")],
        "sales_reporting_month date, deal_uuid string, primary_reservation_uuid string, salesforce_opportunity_id string",
    )
    texts = {r.deal_uuid: r.email_list for r in contacts.sale_emails(deals, mails).collect()}
    assert texts == {"d1": "a@x, b@x, own@x", "d3": None, "d4": None}


def test_monthly_rate_and_free_months(spark):
    m = date(2023, 1, 1)
    base = "sales_reporting_month date, deal_uuid string, primary_reservation_uuid string"
    deals = spark.createDataFrame(
        [
            (m, "d1", "r", 4, 600.0, 0.0, 6, False, "EMEA", "desk", 1),
            (m, "d2", "r", 4, 605.0, 2.0, 6, None, "EMEA", "desk", 1),  # 100.5 rounds up
            (m, "d3", "r", 4, 600.0, 0.0, 0, False, "EMEA", "desk", 1),
            (m, "d4", "r", 4, 600.0, 0.0, 6, True, "EMEA", "desk", 1),
            (m, "d5", "r", 4, 600.0, 0.0, 6, False, "Israel", "desk", 1),
            (m, "d6", "r", 4, 600.0, 0.0, 6, False, "EMEA", "The ACME all access pass", 1),
            (m, "d7", "r", 4, 600.0, 0.0, None, False, "EMEA", "desk", 0),
        ],
        f"{base}, primary_reservation_capacity int, gross_committed_value_changed_before_discount_local double, "
        "addon_committed_value_changed_local double, resulting_commitment_term_months int, is_affiliate boolean, subregion string, "
        "product string, gross_desk_sales int",
    )
    rated = free_months.monthly_rate(deals, BRAND)
    assert {r.deal_uuid: r.MRR for r in rated.collect()} == {"d1": 100.0, "d2": 101.0, "d3": None}
    records = spark.createDataFrame(
        [(m, "d1", "r", p, n, "DiscountReservation", 3) for p, n in ((-100.4, 2), (99.5, 1), (-101.0, 1), (-100.0, 0))]
        + [(m, "d1", "r", -100.0, 1, "PrimaryReservation", 3), (m, "d3", "r", 0.0, 1, "DiscountReservation", 3)],
        f"{base}, price_local double, applied_months int, sales_record_reservation_type string, primary_reservation_capacity int",
    ).select("*", *[F.lit(None).cast("string").alias(c) for c in ("location_uuid", "price_id", "price_usd_sales_comp_fx", "committed_value_changed_local")])
    flagged = free_months.free_month_records(records, rated)
    assert sorted((r.deal_uuid, r.price_local, r.is_free_month) for r in flagged.collect()) == [("d1", -101.0, False), ("d1", -100.4, True), ("d1", 99.5, True), ("d3", 0.0, False)]
    assert [(r.deal_uuid, r.MRR, r.applied_months, r.disc_desk_months) for r in free_months.free_months(records, rated).collect()] == [("d1", 100.0, 3, 9)]


def test_latest_promo_join_needs_a_sale_before_the_start(spark):
    t = datetime(2023, 2, 1)
    promos = spark.createDataFrame([("r", t, None, "x"), ("r", t, datetime(2023, 8, 1), "CODE")], "reservation_uuid string, commitment_term_start_utc timestamp_ntz, commitment_term_end_utc timestamp_ntz, applied_discount string")
    deals = spark.createDataFrame(
        [("early", "r", date(2023, 1, 1), date(2023, 2, 1)), ("same", "r", date(2023, 2, 1), date(2023, 2, 1)), ("late", "r", date(2023, 3, 1), date(2023, 2, 1)), ("open", "r", date(2023, 1, 1), None)],
        "k string, primary_reservation_uuid string, sales_reporting_month date, resulting_commitment_term_start date",
    ).withColumn("resulting_commitment_term_end", F.lit(date(2023, 8, 1)))
    got = {r.k: r.applied_discount for r in sales.with_latest_promo(deals, promos).collect()}
    assert got == {"early": "CODE", "same": "CODE", "late": None, "open": None}


def test_adjusted_sales(spark):
    deals = spark.createDataFrame([("a", 0), ("b", 0), ("c", 3), ("d", -1), ("e", None)], "deal_uuid string, gross_desk_sales int")
    moved = spark.createDataFrame([("a",), ("c",), ("d",)], "deal_uuid string")
    got = {r.deal_uuid: r.gross_desk_sales_mod for r in sales.with_adjusted_sales(deals, moved).collect()}
    assert got == {"a": 1, "c": 4}


def test_lookups(spark):
    d1, d2 = date(2023, 5, 1), date(2023, 6, 1)
    rows = [("12 Main", "l1", d2, 1), ("12 Main", "l1", d1, 1), ("12 Main", "l1", d1, 1), ("other", "l2", d1, 1)]
    spaces = spark.createDataFrame(rows, "location_name string, location_uuid string, report_month date, x int")
    assert lookups.spaces_of_building(spaces, "12 Main", d1).count() == 1
    assert [r.report_month for r in lookups.history_of_location(spaces, "l1").collect()] == [d1, d2]


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", None)], "k string, v int")
    assert [tuple(r) for r in quality.duplicates(df, ["k"]).orderBy("k").collect()] == [("a", 2), ("b", 2)]
    assert tuple(quality.check(df, "v", F.col("v") > 1).first())[0::2] == ("v", 2)


def test_brand_values():
    assert BRAND.product_groupings[4:6] == ("HeadquartersByAcme", "HQxAC")
    assert BRAND.membership_names[1] == "Acme Anywhere Membership"
