import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast import schema as S
from shelfcast.operators.dates import holiday_distance, holiday_distance_by_type
from shelfcast.sources import files, load

DAY = dt.date(2024, 3, 8)


@pytest.fixture(scope="module")
def tables(spark):
    def sale(receipt, line, sku, day, qty, base, price, promo, code=None, card=None, weighed=0):
        return (receipt, line, 1, line, sku, "E1", day, qty, base, price, promo, code, card, weighed)

    sales = spark.createDataFrame(
        [
            sale(1, 1, "a", DAY, 3.0, 10.0, 8.0, 5, "X", "77"),
            sale(1, 2, "a", DAY, 2.0, 10.0, -4.0, 0, None, "  "),
            sale(2, 1, "b", DAY + dt.timedelta(1), 1.0, 0.0, 5.0, 9, None, None, None),
        ],
        S.SALES,
    )
    returns = spark.createDataFrame(
        [(1, "a", "E1", DAY, 1.0), (1, "a", "E1", DAY, 0.5), (99, "a", "E1", DAY, 7.0)], S.RETURNS
    )
    promotions = spark.createDataFrame(
        [
            (5, "old", "Нет", 1.0, "01.01.2023", "31.12.2023"),
            (5, "new", "Да", 2.0, "01.03.2024", "2024-03-31"),
        ],
        S.PROMOTIONS_TEXT,
    )
    holidays = spark.createDataFrame(
        [(DAY, "women", "state", 1), (DAY, "zzz", "other", 0)], S.HOLIDAYS
    )
    return sales, returns, load.parse_promotions(promotions), holidays


def test_load_edges(tables):
    rows = load.load(*tables).orderBy("receipt_id", "line_no").collect()
    assert len(rows) == 3
    first, second, third = rows
    # Both lines of the returned key get the whole returned quantity.
    assert [first["returned_qty"], second["returned_qty"], third["returned_qty"]] == [1.5, 1.5, 0.0]
    assert first["net_sales"] == 1.5 and second["net_sales"] == 0.5
    assert first["receipt_total"] == 4.0 and first["certificate_total"] == 4.0
    assert third["certificate_total"] == 0.0
    # Of two holidays on a day the first name counts, of two promotions the later one.
    assert (first["is_holiday"], first["holiday_type"], first["day_off"]) == (1, "state", 1)
    assert (first["promo_type"], first["promo_active"], first["is_clearance"]) == ("new", 1, 1)
    assert (second["promo_active"], third["promo_type"], third["promo_active"]) == (0, "none", 0)
    assert (first["customer_card"], second["customer_card"], third["weighed"]) == (77, 0, 0)
    assert (first["promo_code_used"], second["promo_code_used"]) == (1, 0)


def test_matched_returns(tables):
    assert load.matched_returns(tables[1], tables[0]).count() == 2


def test_optional_columns_and_products(tables, spark):
    sales = tables[0].drop("weighed", "customer_card", "promo_code")
    row = load.load(sales, *tables[1:]).first()
    assert (row["weighed"], row["customer_card"], row["promo_code_used"]) == (0, 0, 0)
    products = spark.createDataFrame([("a", "food"), ("a", "food")], "sku string, kind string")
    assert load.load(*tables, products).where("kind = 'food'").count() == 2


def test_holiday_distance_edges(spark, tables):
    days = [DAY - dt.timedelta(1200), DAY - dt.timedelta(3), DAY, DAY + dt.timedelta(5)]
    df = spark.createDataFrame([(d,) for d in days], "sale_date date")
    got = holiday_distance(df, tables[3]).orderBy("sale_date").collect()
    assert [r["days_to_holiday"] for r in got] == [999, 3, 0, 999]
    assert [r["days_since_holiday"] for r in got] == [999, 999, 0, 5]
    none = holiday_distance(df, tables[3].limit(0)).collect()
    assert {(r["days_to_holiday"], r["days_since_holiday"]) for r in none} == {(999, 999)}
    typed = holiday_distance_by_type(df, tables[3]).orderBy("sale_date").collect()
    assert [r["days_to_state"] for r in typed] == [999, 3, 0, 999]
    assert holiday_distance_by_type(df, tables[3].limit(0)).columns == ["sale_date"]


def test_csv_keeps_blank_text(spark, tables, tmp_path):
    path = str(tmp_path / "sales")
    files.write_result(tables[0], path)
    back = load.read_csv(spark, path, S.SALES)
    assert {r["customer_card"] for r in back.collect()} == {"77", "  ", None}


def test_file_inventory(spark, tmp_path):
    for name in ("a.eps", "sub/b.eps", "sub/c.EPS", "d.jpg", "sub/deep/e.x.eps"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text("x" * len(name))
    got = files.file_inventory(spark, str(tmp_path), "eps")
    assert {r["stem"] for r in got.collect()} == {"a", "b", "e.x"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]


def test_row_cap(tables):
    assert load.row_cap(tables[0], 2).count() == 2


def test_promo_lookup_unknown(tables, spark):
    from shelfcast.operators.promo import promo_lookup

    got = {r["promo_id"]: r["promo_type_ext"] for r in promo_lookup(tables[0], tables[2]).collect()}
    assert got == {5: "new", 0: "none", 9: "none"}
    assert promo_lookup(tables[0], tables[2]).where(F.col("clearance_ext") == 1).count() == 1
