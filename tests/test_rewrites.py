"""Rewrites for scale give what the plain form gives, also when keys are hot."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from compare import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from deskmart.operators import discounts, promos
from deskmart.operators import ordering
from deskmart.operators.ordering import number_in_groups, number_rows, row_key, rows_before, running_over_groups, with_group_total
from deskmart.operators.sizing import measured
from deskmart.operators.skew import HotKeys


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    left = rows_of(cols, [tuple(r) for r in a.select(*cols).collect()])
    assert left == rows_of(cols, [tuple(r) for r in b.select(*cols).collect()])
    return left


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 'h' and NULL hold a third of the rows each; half of the hot rows are exact copies."""
    return spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "h").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 11).alias("v"),
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("h", 1), ("h", 2), ("k5", 3), ("k8", 4), ("none", 5), (None, 6)], "k string, w int")


def salts(hot, key):
    return [r._salts for r in hot.tables[key].collect()]


def test_hot_keys_are_found_with_enough_salts(skewed):
    hot = HotKeys.find(skewed, [("k",), ("v",), ("k", "v")], rows_per_task=500)
    assert salts(hot, ("k",)) == [4, 4]  # 'h' and NULL
    assert len(salts(hot, ("v",))) == 1
    assert salts(hot, ("k", "v")) == [3, 3]
    sampled = HotKeys.find(skewed.crossJoin(skewed.sparkSession.range(20)), [("k",)], rows_per_task=8000)
    assert {r.k for r in sampled.tables[("k",)].collect()} == {"h", None}
    assert set(salts(sampled, ("k",))) <= {5, 6}
    assert HotKeys.find(skewed, [("k",)], rows_per_task=None).tables == {}
    assert HotKeys.find(skewed, [("k",)], rows_per_task=10**6).tables == {}


TYPED = {
    "date, moment": ("date '2023-05-01'", "timestamp_ntz '2023-05-01 00:00:00'"),
    "int, double": ("7", "cast(7 as double)"),
    "int, decimal": ("7", "cast(7 as decimal(10,2))"),
    "zero, minus zero": ("cast(0 as double)", "cast(-0.0 as double)"),
    "char": ("cast('ab' as string)", "cast('ab' as varchar(5))"),
}


@pytest.mark.parametrize("how", ["left", "inner", "right"])
@pytest.mark.parametrize("pair", sorted(TYPED))
def test_salted_join_of_keys_of_other_types(spark, pair, how):
    a, b = TYPED[pair]
    many = spark.range(1000).selectExpr(f"if(id < 900, {a}, null) as k", "id as v")
    few = spark.sql(f"select {b} as k, 1 as w union all select null, 2")
    hot = HotKeys.find(many, [("k",)], rows_per_task=100)
    assert len(salts(hot, ("k",))) == 1
    got, want = (x.join(many, few, ["k"], how).select("v", "w").distinct() for x in (hot, HotKeys.none()))
    assert len(same(got, want)) >= 900


def test_keys_of_text_and_number_are_refused(spark):
    many = spark.range(100).selectExpr("1 as k", "id as v")
    hot = HotKeys.find(many, [("k",)], rows_per_task=10)
    with pytest.raises(TypeError, match="string"):
        hot.left_join(many, spark.sql("select '1' as k, 1 as w"), ["k"])


@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_left_join_equals_plain(skewed, lookup, null_safe):
    hot = HotKeys.find(skewed, [("k",)], rows_per_task=300)
    assert len(same(
        hot.left_join(skewed, lookup, ["k"], null_safe=null_safe),
        HotKeys.none().left_join(skewed, lookup, ["k"], null_safe=null_safe),
    )) == 8000


def test_salted_join_with_residual_equals_plain(skewed, lookup):
    hot = HotKeys.find(skewed, [("k",)], rows_per_task=300)
    residual = F.col("w") < F.col("v")
    for how in ("left", "inner"):
        same(hot.join(skewed, lookup, ["k"], how, residual=residual), HotKeys.none().join(skewed, lookup, ["k"], how, residual=residual))


def test_salts_spread_copies(skewed, lookup):
    from deskmart.operators.skew import _salted

    hot = HotKeys.find(skewed.filter("k = 'h'"), [("k",)], rows_per_task=500)
    left, _ = _salted(skewed.filter("k = 'h'"), lookup, ("k",), hot.tables[("k",)])
    sizes = [r["count"] for r in left.groupBy("_salt").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 1400


def test_numbering_equals_global_window(skewed):
    order = [F.asc_nulls_last("k"), F.asc_nulls_last("v")]
    ours = number_rows(skewed, order, "n")
    assert sorted(r.n for r in ours.select("n").collect()) == list(range(1, 6001))
    same(ours, skewed.withColumn("n", F.row_number().over(Window.orderBy(*order))))


def test_numbers_of_ties_do_not_depend_on_the_layout(spark):
    rows = spark.range(400).selectExpr("id % 2 as k", "id as v")
    numbered = [number_rows(rows.repartition(n), [F.asc("k")], "n") for n in (3, 7)]
    same(*numbered)


def test_numbers_in_groups_equal_the_window(spark, skewed, monkeypatch):
    """No partition of the sorted rows holds a hot key alone, and the numbers are those of a window."""
    rows, sorted_rows = skewed.withColumn("k", F.coalesce("k", F.lit("none"))), []
    plain = ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda df: sorted_rows.append(plain(df)) or sorted_rows[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else rows as few as these become one partition
    ours = number_in_groups(rows, "k", [F.asc_nulls_last("v")], "n")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    same(ours, rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.asc_nulls_last("v")))))
    part = F.shiftrightunsigned("_id", ordering._LOCAL_ROW_BITS)
    assert max(r["count"] for r in sorted_rows[0].groupBy(part).count().collect()) < 1500


def test_row_keys_tell_values_apart(spark):
    values = [(None, None), (None, ""), ("", None), ("", ""), ("a", "b"), ("a:1:b", None), ("a", None), ("ab", ""), ("1:a", "b"), ("-", "-")]
    keys = [r.k for r in spark.createDataFrame(values, "x string, y string").select(row_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == len(values) and None not in keys


def test_rows_before_groups(spark):
    groups = spark.range(500).selectExpr("if(id = 9, null, id * 37 % 501) as k", "id % 5 as c").repartition(7)
    got = {r.k: r.b for r in rows_before(groups, ["k"], "c", "b").collect()}
    total, want = 0, {}
    for r in sorted(groups.collect(), key=lambda r: (r.k is None, r.k or 0)):
        want[r.k] = total
        total += r.c
    assert got == want


def test_numbering_survives_empty_input(skewed):
    assert number_rows(skewed.filter("v < 0"), [F.asc("v")], "n").count() == 0


def test_group_total_of_a_hot_key_equals_window(skewed):
    hot = HotKeys.find(skewed, [("k",)], rows_per_task=300)
    same(
        with_group_total(skewed, ["k"], "v", "total", hot),
        with_group_total(skewed, ["k"], "v", "total", HotKeys.none()),
    )


@pytest.mark.parametrize("rows_per_task", [20, None])
def test_running_values_equal_window(spark, rows_per_task):
    groups = spark.range(400).select(
        F.when(F.col("id") < 300, "h").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        F.when(F.col("id") % 97 == 5, F.lit(None)).otherwise((F.col("id") * 37) % 401).alias("o"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") * 13) % 101).alias("v"),
    ).groupBy("k", "o").agg(F.max("v").alias("v"))
    w = Window.partitionBy("k").orderBy(F.asc_nulls_last("o")).rangeBetween(Window.unboundedPreceding, 0)
    ours = running_over_groups(groups, ["k"], "o", {"m": ("max", "v"), "s": ("sum", "v")}, rows_per_task)
    same(ours, groups.withColumns({"m": F.max("v").over(w), "s": F.sum("v").over(w)}))


def _promo_rows(spark):
    t0 = datetime(2022, 1, 1)
    rows = []
    for i in range(600):
        res = "hot" if i < 400 else f"r{i % 20}"
        created = None if i % 13 == 0 else t0 + timedelta(hours=(i * 7) % 90)
        code = None if i % 3 else f"C{(i * 5) % 17:02d}"
        rows.append((res, f"n{i % 2}", "a", "1", created, t0, t0, None, code))
    return spark.createDataFrame(
        rows,
        "reservation_uuid string, location_name string, account_name string, term_id string, "
        "commitment_term_created_utc timestamp_ntz, commitment_term_start_utc timestamp_ntz, "
        "commitment_term_end_utc timestamp_ntz, commitment_term_cancelled_utc timestamp_ntz, applied_discount string",
    )


def test_promo_history_of_a_hot_term(spark):
    rows = _promo_rows(spark)
    cut, whole = promos.promo_history(rows, rows_per_task=10), promos.promo_history(rows, rows_per_task=None)
    same(cut, whole)
    same(promos.latest_promo(rows), whole.filter("rank = 1").drop("rank"))


def test_promo_history_of_vacant_spaces(spark):
    """A third of the rows on no reservation and one term: salted on the way back, with the same outcome."""
    space = "if(id % 3 = 0, null, concat('r', id % 40))"
    rows = spark.range(3000).selectExpr(
        f"{space} as reservation_uuid", "concat('l', id) as location_name", "'a' as account_name", "if(id % 3 = 0, 't', concat('t', id % 7)) as term_id",
        "timestamp_ntz'2022-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 3 * (id % 2) as int)) as commitment_term_created_utc",
        "timestamp_ntz'2022-02-01 00:00:00' as commitment_term_start_utc", "timestamp_ntz'2023-02-01 00:00:00' as commitment_term_end_utc",
        "cast(null as timestamp_ntz) as commitment_term_cancelled_utc", "if(id % 5 = 0, null, concat('c', id % 11)) as applied_discount",
    )
    assert len(same(promos.latest_promo(rows, rows_per_task=50), promos.latest_promo(rows, rows_per_task=None))) > 1000
    same(promos.promo_history(rows, rows_per_task=50), promos.promo_history(rows, rows_per_task=None))


def test_discounts_of_a_hot_reservable(spark):
    day0 = date(2022, 1, 1)
    versions = [("hot", 1, datetime(2022, 1, 1 + i % 20), None if i % 9 == 0 else datetime(2022, 2, 1 + i % 20), None if i % 10 == 3 else -0.01 * (i % 30)) for i in range(300)]
    versions += [("cold", 6, datetime(2022, 1, 5), datetime(2022, 1, 9), 0.2)]
    versions = spark.createDataFrame(versions, "reservable_uuid string, term int, start_at timestamp_ntz, end_at timestamp_ntz, recommended_discount double")
    dates = [(r, day0 + timedelta(days=d)) for r in ("hot", "cold", "new") for d in range(0, 70, 3)]
    spaces = spark.createDataFrame([(d.replace(day=1), d, r, "L", "S") for r, d in dates], "report_month date, date date, reservable_uuid string, location_uuid string, sku string")
    sites = spark.createDataFrame([("L", "EMEA")], "uuid string, region string")
    hot = HotKeys.find(versions, [("reservable_uuid",), ("reservable_uuid", "term")], rows_per_task=50)
    assert [salts(hot, k) for k in hot.tables] == [[6], [6]]
    same(discounts.max_discount_by_month(spaces, sites, versions, hot), discounts.max_discount_by_month(spaces, sites, versions))
    deals = spark.createDataFrame([(r, m, d) for r, d in dates for m in (1, 4, None)], "reservable_uuid string, resulting_commitment_term_months int, initial_sale_date date")
    same(discounts.sale_discounts(deals, versions, hot), discounts.sale_discounts(deals, versions))


def test_measured_marks_only_small_frames(skewed):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    small = measured(skewed.groupBy("k").count(), max_rows=100)
    assert "broadcast" in plan(skewed.join(small, "k"))
    assert "broadcast" not in plan(skewed.join(measured(skewed.select("k"), max_rows=100), "k"))
