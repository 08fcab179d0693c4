"""Queries for sources, projections, filters and joins."""

from pyspark.sql import functions as F

from shelfcast import schema as S
from shelfcast.catalog.base import ID, ORD, Query
from shelfcast.functions import columns as C
from shelfcast.models.prepare import align_features, apply_codes, category_codes, drop_invalid, index_categories
from shelfcast.operators import dates, frames, pricing, promo, target
from shelfcast.operators.quality import zero_safe_rows
from shelfcast.settings import new_path, settle
from shelfcast.sources import files, load
from shelfcast.sources.fixture import HOLIDAY_TYPES

SALES = f"{ID} base_price price promo_id promo_code customer_card weighed"


def _csv_round_trip(r):
    path = new_path(r.spark, "sales-csv")
    files.write_result(r.sales, path)
    return load.read_csv(r.spark, path, S.SALES)


def _text_dates(r):
    """Orders as promotion rows: day-first dates, ISO dates, unreadable ones."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    text = (
        F.when(key % 3 == 0, F.date_format(day, "dd.MM.yyyy"))
        .when(key % 3 == 1, F.date_format(day, "yyyy-MM-dd")).otherwise("soon")
    )
    return r.table("orders").select(
        key.alias("promo_id"), F.lit("discount").alias("promo_type"),
        F.lit("-").alias("is_clearance"), F.col("o_totalprice").alias("discount_pct"),
        F.date_format(day, "dd.MM.yyyy").alias("start_date"), text.alias("end_date"),
    )


# Flag words to test; the list is laid over the orders by key.
WORDS = ["Да", " да ", "TRUE", "true", "Нет", "нет", "False", "-", "", "1", "0", "2", "0.5", "maybe", None]


def _flags(r):
    words = F.array(*[F.lit(w).cast("string") for w in WORDS])
    at = (F.col("o_orderkey") % len(WORDS)).cast("int")
    return r.table("orders").select("o_orderkey", F.get(words, at).alias("word")).withColumn(
        "flag", C.clean_flag(F.col("word"))
    )


def _word_sql() -> str:
    cases = " ".join(
        f"WHEN {i} THEN " + ("NULL" if w is None else f"'{w}'") for i, w in enumerate(WORDS)
    )
    return f"CASE o_orderkey % {len(WORDS)} {cases} END"


def _splits(r):
    out = None
    for mode, inclusive in (("upto", True), ("before", False)):
        for part, rows in zip(("train", "test"), target.train_test_split(r.loaded, 30, inclusive)):
            one = rows.groupBy(F.lit(mode).alias("mode"), F.lit(part).alias("part")).agg(
                F.count(F.lit(1)).alias("row_count"), F.min("sale_date").alias("first_date"),
                F.max("sale_date").alias("last_date"), F.sum("net_sales").alias("total"),
            )
            out = one if out is None else out.unionByName(one)
    return out


CATEGORIES = ("sku", "store_id", "promo_type", "holiday_type")


def _index(r):
    train, _ = target.train_test_split(r.loaded, 365)
    return index_categories(train, list(CATEGORIES)).transform(r.loaded)


def _codes(r):
    train, _ = target.train_test_split(r.loaded, 365)
    train = settle(train.select(*CATEGORIES), "categories")
    return apply_codes(r.loaded, {name: category_codes(train, name) for name in CATEGORIES})


def _code_sql(name: str) -> str:
    return (
        f"(SELECT {name} AS v, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {name}) - 1 AS code "
        f"FROM loaded WHERE sale_date <= (SELECT MAX(sale_date) FROM loaded) - 365 GROUP BY {name})"
    )


def _code_column(name: str) -> str:
    table = _code_sql(name)
    return (
        f"COALESCE((SELECT code FROM {table} c WHERE c.v = l.{name}), "
        f"(SELECT COUNT(*) FROM {table} c)) AS {name}_code"
    )


def _spoiled(r):
    """Some features made NaN or infinite, to be dropped."""
    bad = F.when(F.col("quantity") == 1, F.lit(float("inf"))).when(
        F.col("quantity") == 2, F.lit(float("nan"))
    ).when(F.col("quantity") == 3, None).otherwise(F.col("price"))
    return drop_invalid(r.loaded.withColumn("feature", bad), ["feature", "net_sales"])


def _point(r):
    return frames.point_filter(r.loaded, "Brand#2", "S3")


def _tail(r):
    return frames.history_tail(r.loaded, "Brand#2", "S3", "2000-06-01", 90)


def future(r):
    return frames.future_grid(r.loaded, 7)


CALENDAR_SQL = """(ISODOW(sale_date) - 1) AS weekday, MONTH(sale_date) AS month, YEAR(sale_date) AS year,
  CASE WHEN ISODOW(sale_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  DAYOFYEAR(sale_date) AS day_of_year, WEEKOFYEAR(sale_date) AS week_of_year,
  QUARTER(sale_date) AS quarter, DAY(sale_date) AS day_of_month"""

CASES_SQL = """SELECT ROW_NUMBER() OVER (ORDER BY sku, store_id) AS case_id, sku, store_id,
  CAST(sale_date + INTERVAL 7 DAY AS DATE) AS sale_date, FLOOR(price * 0.95 + 0.5) AS price
FROM (SELECT sku, store_id, sale_date, price,
        ROW_NUMBER() OVER (PARTITION BY sku, store_id ORDER BY sale_date DESC, receipt_id DESC,
          line_part DESC, line_supp DESC, line_no DESC, quantity DESC, base_price DESC) AS rn
      FROM sales WHERE price > 0) t
WHERE rn = 1"""


def cases(r):
    """One scoring case per group: its last line, 5 % cheaper, a week later."""
    last = F.max_by(F.struct("sale_date", "price"), F.struct(*S.ORDER))
    found = r.sales.where("price > 0").groupBy(*S.GROUP).agg(last.alias("c"))
    return found.select(
        F.concat_ws("|", *S.GROUP).alias("case_id"), *S.GROUP,
        F.date_add("c.sale_date", 7).alias("sale_date"),
        F.floor(F.col("c.price") * 0.95 + 0.5).cast("double").alias("price"),
    )


QUERIES = {
    # ---- sources ----
    "load_sales": Query(_csv_round_trip, SALES, "SELECT * FROM sales"),
    "load_promotions": Query(
        lambda r: load.parse_promotions(_text_dates(r)),
        "promo_id is_clearance start_date@ end_date@",
        """SELECT o_orderkey AS promo_id, 0 AS is_clearance, CAST(o_orderdate AS DATE) AS start_date,
          CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS end_date FROM orders""",
    ),
    "load_products": Query(
        lambda r: load.join_products(r.sales, None).unionByName(
            load.join_products(r.sales, r.products), allowMissingColumns=True
        ).groupBy("sku", F.coalesce("product_type", F.lit("absent")).alias("product_type")).agg(
            F.count(F.lit(1)).alias("row_count")
        ),
        "sku product_type row_count",
        """SELECT s.sku, p.t AS product_type, COUNT(*) AS row_count FROM sales s JOIN (
          SELECT p_brand AS sku, MIN(p_type) AS t FROM part GROUP BY p_brand
          UNION ALL SELECT DISTINCT p_brand, 'absent' FROM part) p ON p.sku = s.sku GROUP BY 1, 2""",
    ),
    "row_cap": Query(
        lambda r: load.row_cap(r.sales, 10_000), SALES,
        f"SELECT * FROM sales ORDER BY {ORD} LIMIT 10000",
    ),
    "write_forecast": Query(
        lambda r: _forecast_file(r), "sale_date@ sku store_id forecast~4",
        """SELECT sale_date + 7 AS sale_date, sku, store_id, AVG(quantity) AS forecast
          FROM sales GROUP BY 1, 2, 3""",
    ),
    "file_inventory": Query(
        lambda r: files.file_inventory(r.spark, r.folder, "parquet"), "stem extension length"
    ),
    "load": Query(
        lambda r: r.loaded,
        f"{ID} base_price price promo_id weighed promo_code_used customer_card returned_qty net_sales "
        "receipt_total certificate_total is_holiday holiday_type day_off promo_active promo_type "
        "discount_pct is_clearance",
        "SELECT * FROM loaded",
    ),
    # ---- projections ----
    "clean_bool": Query(
        _flags, "o_orderkey flag",
        f"""SELECT o_orderkey, CASE WHEN LOWER(TRIM(w)) IN ('да', 'true') THEN 1
          WHEN COALESCE(TRY_CAST(TRIM(w) AS DOUBLE), 0) <> 0 THEN 1 ELSE 0 END AS flag
          FROM (SELECT o_orderkey, {_word_sql()} AS w FROM orders) t""",
    ),
    "fill_defaults": Query(
        lambda r: load.join_promotions(load.join_holidays(r.sales, r.holidays), r.promotions),
        f"{ID} promo_type discount_pct is_clearance holiday_type day_off",
        "SELECT * FROM loaded",
    ),
    "presence_flags": Query(
        lambda r: load.clean_sales(load.join_holidays(r.sales, r.holidays)),
        f"{ID} is_holiday promo_code_used", "SELECT * FROM loaded",
    ),
    "clean_card": Query(
        lambda r: load.clean_sales(r.sales), f"{ID} customer_card", "SELECT * FROM loaded"
    ),
    "weighed_flag": Query(
        lambda r: load.clean_sales(
            r.sales.withColumn("weighed", F.when(F.col("quantity") > 5, F.col("weighed")))
        ),
        f"{ID} weighed",
        "SELECT * REPLACE (CASE WHEN quantity > 5 THEN weighed ELSE 0 END AS weighed) FROM loaded",
    ),
    "net_sales": Query(
        lambda r: load.join_returns(r.sales, r.returns), f"{ID} returned_qty net_sales",
        "SELECT * FROM loaded",
    ),
    "discount": Query(
        lambda r: pricing.discount(r.sales), f"{ID} discount_real~6 had_discount",
        """SELECT *, GREATEST(0, LEAST(1, COALESCE(1 - price / NULLIF(base_price, 0), 0))) AS discount_real,
          CASE WHEN price < base_price THEN 1 ELSE 0 END AS had_discount FROM sales""",
    ),
    "calendar": Query(
        lambda r: dates.calendar(r.sales),
        f"{ID} weekday month year is_weekend day_of_year week_of_year quarter day_of_month",
        f"SELECT *, {CALENDAR_SQL} FROM sales",
    ),
    "days_since_start": Query(
        lambda r: dates.days_since_start(r.sales), f"{ID} days_since_start",
        "SELECT *, sale_date - (SELECT MIN(sale_date) FROM sales) AS days_since_start FROM sales",
    ),
    "cyclic_time": Query(
        lambda r: dates.cyclic_time(r.sales),
        f"{ID} sin_day~6 cos_day~6 sin_week~6 cos_week~6 sin_month~6 cos_month~6",
        """SELECT *, SIN(2 * PI() * DAYOFYEAR(sale_date) / 365) AS sin_day,
          COS(2 * PI() * DAYOFYEAR(sale_date) / 365) AS cos_day,
          SIN(2 * PI() * (ISODOW(sale_date) - 1) / 7) AS sin_week,
          COS(2 * PI() * (ISODOW(sale_date) - 1) / 7) AS cos_week,
          SIN(2 * PI() * MONTH(sale_date) / 12) AS sin_month,
          COS(2 * PI() * MONTH(sale_date) / 12) AS cos_month FROM sales""",
    ),
    "month_edges": Query(
        lambda r: dates.month_edges(r.sales), f"{ID} month_start month_end payday",
        """SELECT *, CASE WHEN DAY(sale_date) <= 5 THEN 1 ELSE 0 END AS month_start,
          CASE WHEN DAY(sale_date) >= 25 THEN 1 ELSE 0 END AS month_end,
          CASE WHEN DAY(sale_date) IN (1, 14, 15, 16, 29, 30, 31) THEN 1 ELSE 0 END AS payday FROM sales""",
    ),
    "sale_season": Query(
        lambda r: dates.sale_season(r.sales), f"{ID} sale_season",
        "SELECT *, CASE WHEN MONTH(sale_date) >= 11 THEN 1 ELSE 0 END AS sale_season FROM sales",
    ),
    "cross_features": Query(
        lambda r: target.cross_features(dates.calendar(r.loaded)),
        f"{ID} sku_store weekday_weighed promo_weighed weekend_promo",
        """SELECT *, sku || '_' || store_id AS sku_store,
          CONCAT(ISODOW(sale_date) - 1, '_', weighed) AS weekday_weighed,
          CONCAT(promo_active, '_', weighed) AS promo_weighed,
          CONCAT(CASE WHEN ISODOW(sale_date) >= 6 THEN 1 ELSE 0 END, '_', promo_active) AS weekend_promo
          FROM loaded""",
    ),
    "log_target": Query(
        lambda r: target.add_log_target(r.loaded.withColumn("net_sales", F.col("net_sales") - 5))
        .withColumn("back", F.expm1("log_net_sales")),
        f"{ID} log_net_sales~6 back~6",
        """SELECT *, LN(1 + GREATEST(net_sales - 5, 0)) AS log_net_sales,
          GREATEST(net_sales - 5, 0) AS back FROM loaded""",
    ),
    "align_features": Query(
        lambda r: align_features(r.sales, ["price", "lag_1", "quantity", "ma_7"], list(S.ORDER[:5])),
        "sale_date@ receipt_id line_part line_supp line_no price lag_1 quantity ma_7",
        "SELECT *, 0 AS lag_1, 0 AS ma_7 FROM sales",
    ),
    "drop_invalid": Query(
        _spoiled, f"{ID} feature net_sales",
        "SELECT *, price AS feature FROM loaded WHERE quantity NOT IN (1, 2, 3)",
    ),
    "index_categories": Query(
        _index, f"{ID} sku_code~0 store_id_code~0 promo_type_code~0 holiday_type_code~0",
        "SELECT l.*, " + ", ".join(
            _code_column(n) for n in ("sku", "store_id", "promo_type", "holiday_type")
        ) + " FROM loaded l",
    ),
    "category_codes": Query(
        _codes, f"{ID} sku_code~0 store_id_code~0 promo_type_code~0 holiday_type_code~0",
        "SELECT l.*, " + ", ".join(
            _code_column(n) for n in ("sku", "store_id", "promo_type", "holiday_type")
        ) + " FROM loaded l",
    ),
    # ---- filters ----
    "point_filter": Query(
        _point, f"{ID} net_sales",
        "SELECT * FROM loaded WHERE sku = 'Brand#2' AND store_id = 'S3'",
    ),
    "history_tail": Query(
        _tail, f"{ID} net_sales",
        """SELECT * FROM loaded WHERE sku = 'Brand#2' AND store_id = 'S3'
          AND sale_date < DATE '2000-06-01' AND sale_date >= DATE '2000-06-01' - 90""",
    ),
    "train_test_split": Query(
        _splits, "mode part row_count first_date@ last_date@ total",
        """SELECT mode, part, COUNT(*) AS row_count, MIN(sale_date) AS first_date,
          MAX(sale_date) AS last_date, SUM(net_sales) AS total FROM (
          SELECT 'upto' AS mode, CASE WHEN sale_date <= d THEN 'train' ELSE 'test' END AS part, sale_date, net_sales FROM cut
          UNION ALL SELECT 'before', CASE WHEN sale_date < d THEN 'train' ELSE 'test' END, sale_date, net_sales FROM cut)
          t GROUP BY mode, part""",
        {"cut": "SELECT *, (SELECT MAX(sale_date) FROM loaded) - 30 AS d FROM loaded"},
    ),
    "future_rows": Query(
        lambda r: frames.future_rows(
            frames.union_history_future(r.sales, future(r)), target.last_date(r.sales)
        ),
        "sku store_id sale_date@",
        """SELECT sku, store_id, (SELECT MAX(sale_date) FROM sales) + i AS sale_date
          FROM (SELECT DISTINCT sku, store_id FROM sales) p
          CROSS JOIN (VALUES (1),(2),(3),(4),(5),(6),(7)) v(i)""",
    ),
    "zero_safe_rows": Query(
        lambda r: zero_safe_rows(r.loaded.withColumn("net_sales", F.col("net_sales") - 1)),
        f"{ID} net_sales",
        "SELECT * REPLACE (net_sales - 1 AS net_sales) FROM loaded WHERE net_sales <> 1",
    ),
    # ---- joins ----
    "returns_semi": Query(
        lambda r: load.matched_returns(r.returns, r.sales),
        "receipt_id sku store_id return_date@ returned_qty",
        "SELECT * FROM returns WHERE receipt_id IN (SELECT receipt_id FROM sales)",
    ),
    "sales_returns": Query(
        lambda r: load.join_returns(r.sales, load.matched_returns(r.returns, r.sales)),
        f"{ID} returned_qty", "SELECT * FROM loaded",
    ),
    "sales_holidays": Query(
        lambda r: load.join_holidays(r.sales, r.holidays),
        f"{ID} is_holiday holiday_type day_off", "SELECT * FROM loaded",
    ),
    "sales_promotions": Query(
        lambda r: load.join_promotions(r.sales, r.promotions),
        f"{ID} promo_active promo_type discount_pct is_clearance", "SELECT * FROM loaded",
    ),
    "sales_products": Query(
        lambda r: load.join_products(r.sales, r.products),
        f"{ID} product_type product_size product_parts",
        """SELECT s.*, p.* EXCLUDE (b) FROM sales s LEFT JOIN (SELECT p_brand AS b, MIN(p_type) AS product_type,
          MAX(p_size) AS product_size, COUNT(*) AS product_parts FROM part GROUP BY p_brand) p ON p.b = s.sku""",
    ),
    "promo_lookup": Query(
        lambda r: promo.promo_lookup(r.sales, r.promotions),
        f"{ID} promo_type_ext clearance_ext",
        """SELECT s.*, COALESCE(p.promo_type, 'none') AS promo_type_ext,
          COALESCE(p.is_clearance, 0) AS clearance_ext
          FROM sales s LEFT JOIN promos p ON p.promo_id = s.promo_id""",
    ),
    "future_grid": Query(
        future, "sku store_id sale_date@",
        """SELECT sku, store_id, (SELECT MAX(sale_date) FROM sales) + i AS sale_date
          FROM (SELECT DISTINCT sku, store_id FROM sales) p
          CROSS JOIN (VALUES (1),(2),(3),(4),(5),(6),(7)) v(i)""",
    ),
    "batch_history": Query(
        lambda r: frames.batch_history(cases(r), r.loaded), f"case_id {ID} net_sales",
        """SELECT c.sku || '|' || c.store_id AS case_id, l.* FROM cases c JOIN loaded l ON l.sku = c.sku
          AND l.store_id = c.store_id AND l.sale_date < c.sale_date AND l.sale_date >= c.sale_date - 90""",
        {"cases": CASES_SQL},
    ),
    "holiday_distance": Query(
        lambda r: dates.holiday_distance(r.sales, r.holidays),
        f"{ID} days_to_holiday days_since_holiday",
        "SELECT * FROM sales JOIN near_holidays USING (sale_date)",
    ),
    "holiday_distance_by_type": Query(
        lambda r: dates.holiday_distance_by_type(r.sales, r.holidays),
        f"{ID} " + " ".join(f"days_to_{t}" for t in HOLIDAY_TYPES),
        "SELECT * FROM sales JOIN (SELECT d.sale_date, " + ", ".join(
            f"""LEAST(999, COALESCE(MIN(CASE WHEN h.holiday_type = '{t}' AND h.holiday_date >= d.sale_date
              THEN h.holiday_date - d.sale_date END), 999)) AS days_to_{t}""" for t in HOLIDAY_TYPES
        ) + """ FROM (SELECT DISTINCT sale_date FROM sales) d CROSS JOIN holidays h
          GROUP BY d.sale_date) n USING (sale_date)""",
    ),
    # ---- set operations ----
    "union_history_future": Query(
        lambda r: frames.union_history_future(r.sales, future(r))
        .fillna({"receipt_id": -1}).groupBy("sku", "store_id").agg(
            F.count(F.lit(1)).alias("row_count"), F.count("price").alias("known_prices"),
            F.sum("receipt_id").alias("receipts"), F.max("sale_date").alias("last_date"),
        ),
        "sku store_id row_count known_prices receipts last_date@",
        """SELECT sku, store_id, COUNT(*) + 7 AS row_count, COUNT(price) AS known_prices,
          CAST(SUM(receipt_id) - 7 AS BIGINT) AS receipts,
          (SELECT MAX(sale_date) FROM sales) + 7 AS last_date FROM sales GROUP BY sku, store_id""",
    ),
    "distinct_pairs": Query(
        lambda r: frames.distinct_pairs(r.sales), "sku store_id",
        "SELECT DISTINCT sku, store_id FROM sales",
    ),
}


def _forecast_file(r):
    path = new_path(r.spark, "forecast")
    table = r.sales.groupBy("sale_date", *S.GROUP).agg(F.avg("quantity").alias("forecast"))
    shifted = table.withColumn("sale_date", F.date_add("sale_date", 7))
    files.write_result(shifted, path)
    return load.read_csv(r.spark, path, shifted.schema)
