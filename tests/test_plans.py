"""What the plans must and must not contain, and the shape of the marts."""

from __future__ import annotations

import re
import time
from datetime import date

import pytest
from conftest import ROOT, SF_DIR
from pyspark.sql import functions as F

from deskmart import queries as Q
from deskmart.functions import expr as X
from deskmart.functions.promo_rules import PROMO_RULES
from deskmart.operators import lookups, occupancy, ordering, population, quality, relocation, renewals, sizing, texts
from deskmart.operators.sizing import materialize
from deskmart.plans import inventory_mart as inventory
from deskmart.plans import layout
from deskmart.plans import sales_mart as sales
from deskmart.sources.adapter import LazyRoles
from deskmart.sources.roles import ROLE_COLUMNS, Roles
from deskmart.sources.sinks import write_by_month


@pytest.fixture(scope="module")
def roles(spark, tmp_path_factory):
    """The role views written as Parquet tables, read back through the registry."""
    folder, views = tmp_path_factory.mktemp("roles"), LazyRoles(spark, SF_DIR)
    for role in ROLE_COLUMNS:
        views[role].write.parquet(f"{folder}/{role}")
    return Roles.from_parquet(spark, {role: f"{folder}/{role}" for role in ROLE_COLUMNS})


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(Q.QUERIES))
def test_no_cross_join_python_or_single_task(spark, key):
    plan = plan_of(Q.QUERIES[key](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
    # The only unpartitioned exchange sums one row per sort partition for the row numbers.
    single = plan.count("Exchange SinglePartition")
    whole = key in ("dq_sales_population", "dq_inventory_population", "dq_exclusions")  # one row of counts
    assert single == 0 or (single <= 1 and key in ("row_number_global", "sales_mart")) or whole


def test_filters_and_columns_reach_the_scan(roles):
    plan = plan_of(lookups.spaces_of_building(roles.spaces, "Building 12", date(2023, 5, 1)))
    assert "EqualTo(location_name,Building 12)" in plan and "EqualTo(report_month,2023-05-01)" in plan
    ahead = plan_of(occupancy.forward_occupancy_by_sku(population.active_spaces(roles.spaces, roles.accounts), Q.AS_OF))
    assert "GreaterThanOrEqual(date,2023-04-01)" in ahead and "LessThan(date,2023-07-01)" in ahead
    scan = re.search(r"ReadSchema: struct<date[^>]*>", ahead).group(0)
    assert "price" not in scan and "reservable" not in scan


def exchanges(df, column: str) -> int:
    """Exchanges of the plan, reused ones included, that move ``column``."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.initialPlan())
            continue
        outputs = node.output()
        if "ShuffleExchange" in node.getClass().getSimpleName():
            found += column in [outputs.apply(i).name() for i in range(outputs.size())]
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_sales_move_once_for_lookups_and_numbers_and_texts_once(roles, no_broadcast):
    """One exchange for the small building table, which this test keeps from being broadcast; see README."""
    mart = sales.sales_mart(roles, Q.BRAND, Q.AS_OF)
    assert exchanges(mart, "notes") == 1  # for its own join; no note is repeated
    rows = sales.with_numbers(sales._joined_sales(roles, Q.BRAND, Q.AS_OF, PROMO_RULES, None, None))
    assert exchanges(rows, "city") == 2  # buildings, then lookups and numbers together


def test_wide_spaces_move_once_and_for_the_sort(roles, no_broadcast):
    wide = inventory.inventory_rows(roles, rows_per_task=None)
    assert exchanges(wide, "reservable_type") <= 3  # accounts, buildings; lookups and DISTINCT together
    mart = inventory.inventory_mart(roles, rows_per_task=None)
    assert exchanges(mart, "Renewal_Flag") == 1  # the ranges of the sort


def test_texts_move_for_their_own_join_alone(roles):
    """Three reservations have a row twice: their texts meet, no other text moves."""
    twice = roles.reservations.union(roles.reservations.orderBy("uuid").limit(3)).select("uuid", "notes")
    found = texts.distinct_texts(twice, "notes")
    assert sorted(map(str, found.collect())) == sorted(map(str, twice.distinct().collect()))
    assert exchanges(found, "notes") <= 1 and "Exchange" not in plan_of(texts.distinct_texts(roles.reservations.select("uuid", "notes"), "notes"))
    assert sorted(map(str, texts.distinct_texts(twice, "notes", max_repeated=2).collect())) == sorted(map(str, found.collect()))


def test_tables_laid_out_for_the_marts(spark, roles):
    """Bucketed by the digest, wide rows meet their lookups without an exchange; the marts stay the same."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layout.save_sales(roles.deals, "laid_out_sales", buckets)
    layout.save_spaces(roles.spaces, "laid_out_spaces", buckets)
    own = Roles({**roles, "deals": spark.table("laid_out_sales"), "spaces": spark.table("laid_out_spaces")})
    rows = sales.with_numbers(sales._joined_sales(own, Q.BRAND, Q.AS_OF, PROMO_RULES, None, None))
    assert exchanges(rows, "city") == 0
    assert exchanges(inventory.inventory_rows(own, rows_per_task=None), "reservable_type") == 0
    for build in (lambda r: sales.sales_mart(r, Q.BRAND, Q.AS_OF), inventory.inventory_rows):
        got, want = (sorted(map(str, build(r).collect())) for r in (own, roles))
        assert got == want != []


def test_sales_without_ids_stay(roles):
    """A third of the sales without a reservation, another without a deal: each sale keeps its row, salted or not."""
    third = F.pmod(F.xxhash64(*roles.deals.columns), F.lit(3))
    kept = roles.deals.filter("gross_desk_sales > 0").withColumns(
        {
            "primary_reservation_uuid": F.when(third != 0, F.col("primary_reservation_uuid")),
            "deal_uuid": F.when(third != 1, F.col("deal_uuid")),
        }
    )
    own = Roles({**roles, "deals": kept, "exclusions": roles.exclusions.limit(0)})
    plain, salted = (sales.sales_mart(own, Q.BRAND, Q.AS_OF, rows_per_task=n).collect() for n in (None, 200))
    assert sorted(map(str, plain)) == sorted(map(str, salted))
    assert sorted(r.Row_Number for r in plain) == list(range(1, len(plain) + 1))
    sold = kept.filter(population.reported_sale(Q.BRAND)).join(
        population.reported_territories(roles.locations).select(F.col("uuid").alias("location_uuid")), "location_uuid"
    ).collect()
    ids = "primary_reservation_uuid", "deal_uuid"
    for column in ids:
        got, want = ({(r.initial_sale_date, r.reservable_uuid, r.core_committed_value_usd) for r in rows if r[column] is None} for rows in (plain, sold))
        assert got == want and len(got) > 20


def test_a_hot_sale_is_numbered_in_pieces(roles):
    """A third of the rows on one sale, NULL ids among them: the same numbers as by one window."""
    third = F.pmod(F.xxhash64(*roles.deals.columns), F.lit(3)) == 0
    hot = roles.deals.filter("gross_desk_sales > 0").withColumns(
        {
            "primary_reservation_uuid": F.when(~third, F.col("primary_reservation_uuid")),
            "deal_uuid": F.when(third, "D-hot").otherwise(F.col("deal_uuid")),
            "sales_reporting_month": F.when(third, F.lit(date(2022, 3, 1))).otherwise(F.col("sales_reporting_month")),
        }
    )
    own = Roles({**roles, "deals": hot})
    joined = sales._joined_sales(own, Q.BRAND, Q.AS_OF, PROMO_RULES, 100, None)
    assert joined.large is not None
    plain, pieces = (sorted(map(str, sales.sales_mart(own, Q.BRAND, Q.AS_OF, rows_per_task=n).collect())) for n in (None, 100))
    assert plain == pieces and sum("D-hot" in r for r in plain) > 300


def test_checks_while_writing(roles, tmp_path, spark):
    """What the writer counted is what the checks of the finished marts say, planted violations included."""
    late = roles.exclusions.union(spark.createDataFrame([("none", "none", population.UPLOAD_ERROR)], roles.exclusions.schema))
    rows = materialize(sales.sales_rows(roles, Q.BRAND, Q.AS_OF))
    some = rows.filter("deal_uuid is not null and primary_reservation_uuid is not null").select("deal_uuid", F.col("primary_reservation_uuid").alias("reservation_uuid")).limit(5)
    listed = late.unionByName(some.withColumn("reason_for_exclusion", F.lit(population.UPLOAD_ERROR)))
    start = date(2021, 1, 1)
    got = write_by_month(rows, str(tmp_path / "sales"), "sales_reporting_month", checks=quality.sales_checks(listed, start))
    names = listed.withColumnRenamed("reservation_uuid", "primary_reservation_uuid")
    want = quality.sales_population(rows, start).union(
        quality.not_listed(rows, names, ["deal_uuid", "primary_reservation_uuid"], population.UPLOAD_ERROR, "sales exclusions")
    )
    told = {tuple(r) for r in got.collect()}
    assert told == {tuple(r) for r in want.collect()} and min(v for _, _, v in told) > 0
    written = spark.read.parquet(str(tmp_path / "sales"))
    assert sorted(written.columns) == sorted(rows.columns) and written.count() == next(iter(told))[1]
    assert write_by_month(rows.limit(3), str(tmp_path / "plain"), "sales_reporting_month") is None


def test_sales_mart(roles):
    mart = sales.sales_mart(roles, Q.BRAND, Q.AS_OF)
    assert len(mart.columns) == 69
    rows = mart.select("Row_Number", "gross_desk_sales_mod", "sales_reporting_month").orderBy("Row_Number").collect()
    assert [r.Row_Number for r in rows] == list(range(1, len(rows) + 1))
    assert [r.sales_reporting_month for r in rows] == sorted(r.sales_reporting_month for r in rows)
    assert quality.sales_population(mart, population.SALES_START).first().violations == 0
    listed = roles.exclusions.withColumnRenamed("reservation_uuid", "primary_reservation_uuid")
    found = quality.not_listed(mart, listed, ["deal_uuid", "primary_reservation_uuid"], population.UPLOAD_ERROR, "x").first()
    assert (found.rows, found.violations) == (len(rows), 0)


def test_row_numbers_do_not_depend_on_the_layout(spark, roles):
    """Two notes for each reservation: numbers of multiplied sales are the same whatever the partitions."""
    twice = roles.reservations.union(roles.reservations.withColumn("notes", F.concat(F.coalesce("notes", F.lit("")), F.lit(" again"))))
    own = Roles({**roles, "reservations": twice, "deals": roles.deals.union(roles.deals.limit(50))})
    numbered = []
    for n in ("3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        numbered.append(sorted(map(str, sales.sales_mart(own, Q.BRAND, Q.AS_OF).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert numbered[0] == numbered[1]


def test_months_of_the_marts(roles):
    months = (date(2020, 3, 1), date(2020, 5, 1))
    whole = sales.sales_mart(roles, Q.BRAND, Q.AS_OF).filter(F.col("sales_reporting_month").between(*months)).drop("Row_Number")
    part = sales.sales_mart(roles, Q.BRAND, Q.AS_OF, months=months)
    assert sorted(map(str, part.drop("Row_Number").collect())) == sorted(map(str, whole.collect())) != []
    whole = inventory.inventory_rows(roles).filter(F.col("report_month").between(*months))
    assert sorted(map(str, inventory.inventory_rows(roles, months=months).collect())) == sorted(map(str, whole.collect())) != []


def test_checks_find_planted_violations(spark):
    sold = spark.createDataFrame(
        [("D1", "R1", date(2020, 1, 1), 1), ("D2", "R2", date(2019, 5, 1), 1), ("D3", "R3", date(2020, 1, 1), 0), ("D4", "R4", None, 2)],
        "deal_uuid string, primary_reservation_uuid string, sales_reporting_month date, gross_desk_sales_mod long",
    )
    assert tuple(quality.sales_population(sold, population.SALES_START).first()) == ("sales population", 4, 3)
    spaces = spark.createDataFrame([(date(2019, 12, 1),), (date(2020, 1, 1),)], "date date")
    assert tuple(quality.inventory_population(spaces, population.INVENTORY_START).first()) == ("inventory population", 2, 1)
    named = [("D1", "R1", population.UPLOAD_ERROR), ("D1", "R1", population.UPLOAD_ERROR), ("D2", "R2", "Other"), ("D3", "R4", population.UPLOAD_ERROR)]
    exclusions = spark.createDataFrame(named, "deal_uuid string, primary_reservation_uuid string, reason_for_exclusion string")
    on = ["deal_uuid", "primary_reservation_uuid"]
    assert tuple(quality.not_listed(sold, exclusions, on, population.UPLOAD_ERROR, "n").first()) == ("n", 4, 1)


def test_inventory_mart(roles):
    mart = inventory.inventory_mart(roles)
    assert len(mart.columns) == 43
    rows = [tuple("~" if v is None else str(v) for v in r) for r in mart.select("date", "report_month", "region", "territory").collect()]
    assert rows == sorted(rows)
    assert quality.inventory_population(mart, population.INVENTORY_START).first().violations == 0


def test_writing_a_month_keeps_the_others(roles, tmp_path, spark):
    path, rows = str(tmp_path / "inventory"), inventory.inventory_rows(roles)
    write_by_month(rows, path, "report_month")
    before = spark.read.parquet(path).groupBy("report_month").count().collect()
    assert len(before) > 2 and any((tmp_path / "inventory").glob("report_month=*"))
    month = max(r.report_month for r in before)
    write_by_month(rows.filter(F.col("report_month") == month).limit(1), path, "report_month")
    after = {r.report_month: r["count"] for r in spark.read.parquet(path).groupBy("report_month").count().collect()}
    assert after == {r.report_month: r["count"] for r in before} | {month: 1}


def test_marts_with_hot_keys_equal_the_plain_ones(roles):
    """A bound of a few rows makes ordinary keys hot, so every salted path runs."""
    for build in (
        lambda n: sales.sales_mart(roles, Q.BRAND, Q.AS_OF, rows_per_task=n),
        lambda n: inventory.inventory_mart(roles, rows_per_task=n),
    ):
        salted, plain = (sorted(map(str, build(n).collect())) for n in (3, None))
        assert salted == plain


def test_roles_report_missing_columns_and_types(spark):
    with pytest.raises(ValueError, match="is_affiliate"):
        Roles({"accounts": spark.createDataFrame([("a",)], "account_uuid string")})
    with pytest.raises(ValueError, match="'is_affiliate' is string"):
        Roles({"accounts": spark.createDataFrame([("a", "yes")], "account_uuid string, is_affiliate string")})
    frame = spark.createDataFrame([("a", True, 1)], "account_uuid string, is_affiliate boolean, extra int")
    assert Roles({"accounts": frame}).accounts.columns == ["account_uuid", "is_affiliate", "extra"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_months_of_timestamps_are_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    instants = ["2023-06-01T00:00:00Z", "2023-05-31T23:59:59.123456Z", "2022-11-06T05:30:00Z", "1950-01-01T00:00:00Z"]
    frame = spark.createDataFrame([("r", "n", t) for t in instants], "uuid string, notes string, t string")
    frame = frame.selectExpr("uuid", "notes", "cast(t as timestamp) as created_at", "cast(t as timestamp) as updated_at")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = Roles({"reservations": frame}).reservations.select(X.month_of("created_at").alias("m"), F.col("created_at").cast("string").alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [str(r.m) for r in rows] == ["2023-06-01", "2023-05-01", "2022-11-01", "1950-01-01"]
    assert rows[1].s == "2023-05-31 23:59:59.123456" and rows[2].s == "2022-11-06 05:30:00"


def test_months_given_as_moments(spark, roles):
    deals = roles.deals.withColumn("sales_reporting_month", F.col("sales_reporting_month").cast("timestamp_ntz"))
    own = Roles({**roles, "deals": deals})
    got, want = (sorted(map(str, sales.sales_mart(r, Q.BRAND, Q.AS_OF).collect())) for r in (own, roles))
    assert got == want


def test_roles_from_tables(spark, tmp_path):
    spark.createDataFrame([("a", True)], "account_uuid string, own_company boolean").createOrReplaceTempView("accounts_table")
    roles = Roles.from_tables(spark, {"accounts": "accounts_table"}, {"accounts": {"own_company": "is_affiliate"}})
    assert roles["accounts"].first().is_affiliate is True


def test_roles_of_a_catalog(spark):
    """Names of three parts, as in catalog.schema.table."""
    spark.sql("create database if not exists corp")
    spark.createDataFrame([("a", True)], "account_uuid string, is_affiliate boolean").write.mode("overwrite").saveAsTable("spark_catalog.corp.accounts")
    roles = Roles.from_tables(spark, {"accounts": "spark_catalog.corp.accounts"})
    assert [tuple(r) for r in roles.accounts.collect()] == [("a", True)]


def test_sources_hold_no_collect_of_data():
    files = [p for p in (ROOT / "deskmart").rglob("*.py") if "llm" not in p.parts]
    assert [p.name for p in files if re.search(r"\.(collect|toPandas|toLocalIterator)\(", p.read_text())] == []


def test_wide_sales_do_not_move_to_the_texts(roles, no_broadcast):
    """The texts come to the sales: the wide rows of the whole mart move as often as without any text."""
    rows = sales.with_numbers(sales._joined_sales(roles, Q.BRAND, Q.AS_OF, PROMO_RULES, None, None))
    mart = sales.sales_mart(roles, Q.BRAND, Q.AS_OF, rows_per_task=None)
    assert exchanges(mart, "city") == exchanges(rows, "city")


def test_views_of_the_marts_share_a_layout(spark, no_broadcast):
    """Lines and orders are dealt out once, whatever the number of views; the rows stay the same."""
    own, plain = LazyRoles(spark, SF_DIR, lay_out=True), LazyRoles(spark, SF_DIR)
    for role in ("spaces", "deals", "records", "desks"):
        assert exchanges(own[role], "l_orderkey") <= 1 < exchanges(plain[role], "l_orderkey") + exchanges(plain[role], "o_orderkey")
        assert sorted(map(str, own[role].collect())) == sorted(map(str, plain[role].collect())) != []


def test_sales_of_no_desk_stay_if_relocated(roles):
    """Sales of no desk go before the joins, unless a relocation counts one for them."""
    mart = sales.sales_rows(roles, Q.BRAND, Q.AS_OF)
    moved = {r.deal_uuid for r in relocation.relocation_deals(roles.desks, roles.reservables, roles.exits).collect()}
    none = roles.deals.withColumn("gross_desk_sales", F.lit(0).cast("long"))
    found = sales.sales_rows(Roles({**roles, "deals": none}), Q.BRAND, Q.AS_OF).collect()
    want = [r.deal_uuid for r in mart.collect() if r.deal_uuid in moved]
    assert {r.deal_uuid for r in found} >= set(want) and all(r.deal_uuid in moved and r.gross_desk_sales_mod == 1 for r in found)


def test_terms_are_spread_by_their_number(roles, monkeypatch):
    """The tasks that group commitment terms grow with the records; the classes stay the same."""
    want = sorted(map(str, renewals.renewal_class(roles.records).collect()))
    n = roles.records.count()
    monkeypatch.setattr(sizing, "GROUPED_ROWS", n // 40)
    classes = renewals.renewal_class(roles.records)
    assert classes.rdd.getNumPartitions() >= 40
    assert sorted(map(str, classes.collect())) == want


@pytest.mark.parametrize("columns", [["reservable_uuid", "report_month"], ["date"], ["reservation_uuid"]])
def test_some_columns_of_the_inventory(roles, no_broadcast, columns):
    """The same rows, also of copies and of rows that differ in one other column; the others stay where they are."""
    few = roles.spaces.limit(300)
    odd = few.withColumns({"reservable_name": F.lit(None).cast("string"), "reservable_type": F.col("reservable_name")})
    own = Roles({**roles, "spaces": roles.spaces.union(few).union(odd).union(odd), "rates": roles.rates.withColumn("budget_rate", F.col("budget_rate") * F.lit(-0.0))})
    got, whole = inventory.inventory_rows(own, columns=columns), inventory.inventory_rows(own)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(*columns).collect())) != []
    assert [c for c in inventory.inventory_rows(own).columns if c in inventory.OWN] == inventory.OWN
    # Accounts and buildings, which this test keeps from being broadcast, come first.
    assert exchanges(got, "market_price_usd") < exchanges(whole, "market_price_usd")


def test_hashes_tell_rows_apart(spark):
    rows = [(None, "a", 0.0, 1), ("a", None, 0.0, 1), ("a", "", 0.0, 1), ("", "a", 0.0, 1), ("a", "", -0.0, 1), ("a", "", None, 1), ("a", "", float("nan"), 1), ("a", "", 0.0, None)]
    df = spark.createDataFrame(rows, "a string, b string, c double, d int")
    hashed = df.select(*[h.alias(n) for n, h in zip("xy", ordering.row_hashes(df), strict=True)])
    assert hashed.distinct().count() == hashed.select("x").distinct().count() == hashed.select("y").distinct().count() == df.distinct().count() == 7


def test_wide_spaces_do_not_move_to_many_affiliates(roles, no_broadcast, monkeypatch):
    """Affiliates too many to broadcast meet the ids of the spaces; the rows stay the same."""
    monkeypatch.setattr(inventory, "measured", materialize)  # nothing is broadcast
    before = inventory.inventory_rows(roles)
    monkeypatch.setattr(inventory, "BROADCAST_ROWS", 0)
    after = inventory.inventory_rows(roles)
    assert exchanges(after, "reservable_type") == exchanges(before, "reservable_type") - 1
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect())) != []


def test_joined_views_are_written_once(spark):
    """Spaces and sales are read several times; their base tables are joined once."""
    views = LazyRoles(spark, SF_DIR, lay_out=True)
    for role in ("spaces", "deals"):
        assert "Join" not in plan_of(views[role]) and "Aggregate" not in plan_of(views[role])


def test_lookups_of_spaces_are_written_before_the_rows_move(roles, no_broadcast):
    """The exchanges of the lookups are over and gone then: those of the last step carry the rows, or small tables."""
    assert exchanges(inventory.inventory_rows(roles), "term_end_date") == exchanges(inventory.inventory_rows(roles), "end_at") == 0


def test_finished_steps_leave_no_shuffle_files(spark, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left():
        blocks_now, n = blocks.getAllBlocks(), 0
        for i in range(blocks_now.size()):
            n += blocks_now.apply(i).name().startswith(f"shuffle_{shuffle}_")
        return n

    shuffle = spark.range(1).rdd.context._jsc.sc().newShuffleId() + 1
    path = str(tmp_path / "step")
    spark.range(100_000).repartition(7, "id").write.parquet(path)
    assert left()
    sizing.release(spark, path, least=1 << 40)  # too little to be worth it
    time.sleep(2)
    assert left()
    for _ in range(30):
        sizing.release(spark, path, least=1)
        if not left():
            break
        spark.range(9).count()  # the last plan may be held until the next one
        time.sleep(0.2)
    assert not left()
