"""How often wide rows are sent around, and that results stay the same."""

import re
from datetime import date

from pyspark.sql import functions as F

from shelfcast.catalog.groups import QUERIES
from shelfcast.operators.frames import mark_folds, ts_folds
from shelfcast.plans.features import wide_features
from shelfcast.schema import ORDER
from shelfcast.settings import settle
from shelfcast.sources import load
from shelfcast.sources.fixture import Retail

SALES = "receipt_id long, line_part long, line_supp long, line_no int, sku string, store_id string, sale_date date, quantity double, base_price double, price double"


def lines(spark):
    rows = [(k // 3, k, 1, 1, f"s{k % 2}", "a", date(2020, 1, 1 + k // 8), float(k % 5), 9.0, 8.0 - k % 3 * 6) for k in range(60)]
    rows += [(None, 7, 1, 1, "s0", "a", None, 1.0, 9.0, -2.0)]
    return spark.createDataFrame([r for r in rows for _ in range(3)], SALES)


def test_folds_are_marked_as_they_are_numbered(spark):
    rows = settle(lines(spark))
    for folds in (2, 3, 7):
        count = lambda d: sorted(map(repr, d.groupBy(*ORDER, "fold").count().collect()))
        assert count(mark_folds(rows, folds)) == count(ts_folds(rows, folds))


def test_receipts_take_one_shuffle_of_the_sales(spark):
    sales = settle(lines(spark))
    back = spark.createDataFrame([(1, "s1", "a", 1.0), (1, "s1", "a", 1.0), (None, "s0", "a", 5.0), (99, "s0", "a", 5.0)], "receipt_id long, sku string, store_id string, returned_qty double")
    both = load.join_receipts(sales, back)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1
    assert both.agg(F.sum("returned_qty")).first()[0] == 2.0 * both.where("receipt_id = 1 and sku = 's1'").count()
    one = both.where("receipt_id = 1").first()
    assert one["receipt_total"] == 3 * (8.0 + 2.0 - 4.0) and one["certificate_total"] == 3 * 4.0
    lost = both.where("receipt_id is null").first()
    assert (lost["receipt_total"], lost["certificate_total"], lost["returned_qty"]) == (None, 0.0, 0.0)


def test_sales_joined_by_receipt_stay_where_they_lie(spark):
    sales = settle(lines(spark))
    cards = settle(spark.createDataFrame([(k, str(k)) for k in (0, 1, 1, 5, None)], "receipt_id long, card string"))
    back = settle(spark.createDataFrame(
        [(1, "s1", "a", 1.0), (1, "s1", "a", 2.0), (None, "s0", "a", 5.0), (99, "s0", "a", 5.0), (2, None, "a", 5.0)],
        "receipt_id long, sku string, store_id string, returned_qty double",
    ))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = sales.join(cards, "receipt_id", "left")
        both = load.join_receipts(joined, back, in_place=True)
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("REPARTITION_BY_COL") == 1  # the returns only
        as_rows = lambda d: sorted(map(repr, d.collect()))
        assert as_rows(both) == as_rows(load.join_receipts(joined, back))
        assert both.columns == load.join_receipts(joined, back).columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_trends_read_the_sales_once(spark):
    plan = QUERIES["trend_diff"].build(Retail(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan  # joins and receipts lie behind the written lines


def test_wide_rows_are_not_shuffled_after_the_windows(spark):
    holidays = spark.createDataFrame([(date(2020, 1, 3), "x", "state", 1)], "holiday_date date, holiday_name string, holiday_type string, day_off int")
    promotions = spark.createDataFrame([(5, "d", 0, 5.0, date(2020, 1, 1), date(2020, 1, 9))], "promo_id int, promo_type string, is_clearance int, discount_pct double, start_date date, end_date date")
    given = lines(spark).withColumns({"promo_id": F.lit(5), "promo_code": F.lit("c"), "weighed": F.lit(0), "customer_card": F.lit("1")})
    empty = spark.createDataFrame([], "receipt_id long, sku string, store_id string, returned_qty double")
    found = wide_features(settle(load.load(given, empty, promotions, holidays)), holidays, promotions)
    plan = found._jdf.queryExecution().executedPlan().toString()
    rows = [e for e in re.findall("Exchange hashpartitioning\\(([^)]*)", plan) if "sku" in e]
    assert len(rows) == 2 and "SortMergeJoin" not in plan


def _join_widths(node) -> list[int]:
    """Columns that leave each join of a plan."""
    found = [node.output().size()] if node.nodeName() == "Join" else []
    children = node.children()
    return found + [n for k in range(children.size()) for n in _join_widths(children.apply(k))]


def test_wide_rows_are_looked_up_in_few_columns(spark):
    """About a hundred columns, one by one through a dozen joins, took most of the time of the model's frame."""
    holidays = spark.createDataFrame([(date(2020, 1, 3), "x", "state", 1)], "holiday_date date, holiday_name string, holiday_type string, day_off int")
    promotions = spark.createDataFrame([(5, "d", 0, 5.0, date(2020, 1, 1), date(2020, 1, 9))], "promo_id int, promo_type string, is_clearance int, discount_pct double, start_date date, end_date date")
    given = lines(spark).withColumns({"promo_id": F.lit(5), "promo_code": F.lit("c"), "weighed": F.lit(0), "customer_card": F.lit("1")})
    given = given.unionByName(given.limit(2).withColumns({"sku": F.lit(None).cast("string"), "store_id": F.lit("b")}))
    empty = spark.createDataFrame([], "receipt_id long, sku string, store_id string, returned_qty double")
    loaded = settle(load.load(given, empty, promotions, holidays))
    found = wide_features(loaded, holidays, promotions)
    widths = _join_widths(found._jdf.queryExecution().optimizedPlan())
    assert len(found.columns) > 100 and len(widths) > 7 and max(widths) < 40
    rows = found.collect()
    assert len(rows) == loaded.count()
    assert {(r.days_to_holiday, r.days_to_state, r.month, r.sku_day_relative) for r in rows if r.sale_date is None} == {(999, 999, None, 1.0)}
    assert {(r.price_vs_sku_mean, r.sku_mean_discount, r.promo_sales_mean, r.store_rank) for r in rows if r.sku is None} == {(1.0, None, None, 0.5)}
    by_hand = {r.sku: r.m for r in loaded.groupBy("sku").agg(F.avg("price").alias("m")).collect()}
    assert all(abs(r.price_vs_sku_mean - r.price / by_hand[r.sku]) < 1e-9 for r in rows if r.sku)
