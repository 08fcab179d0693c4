"""Queries for aggregations, group transforms, ordered windows and target statistics."""

from pyspark.sql import functions as F

from shelfcast.catalog.base import ID, ORD, W, Query
from shelfcast.operators import frames, history, pricing, promo, quality, stores, summary, target
from shelfcast.operators.dates import holiday_distance
from shelfcast.settings import settle
from shelfcast.sources import load


def _avg(value: str, keys: str) -> str:
    return f"AVG({value}) OVER (PARTITION BY {keys})"


def _frame(rows: int) -> str:
    return f"OVER ({W} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _lag_sql(lags, keys: str) -> str:
    median = f"MEDIAN(net_sales) OVER (PARTITION BY {keys})"
    columns = ", ".join(f"COALESCE(LAG(net_sales, {n}) OVER ({W}), {median}) AS lag_{n}" for n in lags)
    return f"SELECT *, {columns} FROM loaded"


def _rolling_sql(windows, stats: dict[str, str]) -> str:
    columns = ", ".join(
        f"{call.format(frame=_frame(n))} AS {name}_{n}" for n in windows for name, call in stats.items()
    )
    return f"SELECT *, {columns} FROM loaded"


ROLLING = {
    "ma": "AVG(net_sales) {frame}",
    "median": "MEDIAN(net_sales) {frame}",
    "max": "MAX(net_sales) {frame}",
    "min": "MIN(net_sales) {frame}",
    "std": "COALESCE(STDDEV_SAMP(net_sales) {frame}, 0)",
}
SUMS = {
    "rolling_sum": "SUM(net_sales) {frame}",
    "rolling_mean": "AVG(net_sales) {frame}",
    "rolling_median": "MEDIAN(net_sales) {frame}",
    "rolling_count": "COUNT(net_sales) {frame}",
}
SLOPE_SQL = f"""SELECT *, CASE WHEN COUNT(net_sales) {_frame(7)} >= 3
  THEN REGR_SLOPE(net_sales, pos) {_frame(7)} ELSE 0 END AS trend_slope_7
  FROM (SELECT *, ROW_NUMBER() OVER ({W}) AS pos FROM loaded) t"""
SCORES_SQL = f"""SELECT *, (net_sales - m) / CASE WHEN s = 0 THEN 1 ELSE s END AS z_score FROM (
  SELECT *, AVG(net_sales) {_frame(30)} AS m, STDDEV_SAMP(net_sales) {_frame(30)} AS s,
    COUNT(net_sales) {_frame(30)} AS n FROM loaded) t WHERE n >= 5"""
SEASON = "mean_sales~6 median_sales~6 std_sales~6 ratio~6"


def _season_sql(part: str, value: str, names: list[str], first: int) -> str:
    label = " ".join(f"WHEN {i + first} THEN '{n}'" for i, n in enumerate(names))
    return f"""SELECT {part}, CASE {part} {label} END AS {part}_name, mean_sales, median_sales, std_sales,
      mean_sales / AVG(mean_sales) OVER () AS ratio FROM (
      SELECT {value} AS {part}, AVG(net_sales) AS mean_sales, MEDIAN(net_sales) AS median_sales,
        STDDEV_SAMP(net_sales) AS std_sales FROM loaded GROUP BY {value}) t"""


def _encoding_sql() -> str:
    columns = ", ".join(
        f"COALESCE(AVG(y) OVER (PARTITION BY {f}), (SELECT AVG(y) FROM dated)) AS {f}_target_mean"
        for f in target.ENCODED
    )
    return f"SELECT *, {columns} FROM dated"


def _with_weekday(df):
    return df.withColumns({"weekday": F.weekday("sale_date"), "month": F.month("sale_date")})


def _boxcox_sql() -> dict[str, str]:
    fit = """SELECT p, -n / 2 * LN(sq - m * m) + (p - 1) * logs AS fit, m, SQRT(sq - m * m) AS sd FROM (
      SELECT p, SUM(c) AS n, SUM(c * y) / SUM(c) AS m, SUM(c * y * y) / SUM(c) AS sq, SUM(c * LN(v)) AS logs
      FROM (SELECT p, v, c, CASE WHEN p = 0 THEN LN(v) ELSE (POWER(v, p) - 1) / p END AS y
            FROM counts CROSS JOIN {powers} g) t GROUP BY p) u WHERE sq - m * m > 0"""
    best = "SELECT p, m, sd FROM {fits} ORDER BY fit DESC, p LIMIT 1"
    return {
        "clipped": """SELECT * REPLACE (GREATEST(0, LEAST(net_sales, (SELECT QUANTILE_CONT(net_sales, 0.995)
          FROM loaded))) AS net_sales) FROM loaded""",
        "counts": """SELECT net_sales AS v, COUNT(*) AS c FROM clipped
          WHERE net_sales > 0 AND weighed = 0 GROUP BY net_sales""",
        "powers1": "SELECT CAST(i AS DOUBLE) / 10 AS p FROM (SELECT UNNEST(GENERATE_SERIES(-20, 20)) AS i) t",
        "fits1": fit.format(powers="powers1"),
        "best1": best.format(fits="fits1"),
        "powers2": """SELECT CAST(i AS DOUBLE) / 1000 AS p FROM (SELECT UNNEST(GENERATE_SERIES(
          CAST(ROUND(p * 1000) AS BIGINT) - 100, CAST(ROUND(p * 1000) AS BIGINT) + 100)) AS i FROM best1) t""",
        "fits2": fit.format(powers="powers2"),
        "best2": best.format(fits="fits2"),
    }


def _folds_sql(folds: int) -> str:
    n = "(SELECT COUNT(*) FROM loaded)"
    size = f"CAST(FLOOR({n} / {folds + 1}) AS BIGINT)"
    return f"""SELECT *, CASE WHEN row_index < {n} - {folds} * {size} THEN 0
      ELSE CAST(FLOOR((row_index - ({n} - {folds} * {size})) / {size}) AS INT) + 1 END AS fold
      FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {ORD}) - 1 AS row_index FROM loaded) t"""


def _wide(r):
    from shelfcast.plans.features import wide_features

    return wide_features(settle(r.loaded), r.holidays, r.promotions)


def _lean(r):
    from shelfcast.plans.features import lean_features

    return lean_features(settle(r.loaded), r.holidays, r.promotions)


WIDE_SQL = f"""SELECT *, ISODOW(sale_date) - 1 AS weekday,
  COALESCE(price / NULLIF({_avg('price', 'sku')}, 0), 1) AS price_vs_sku_mean,
  price - {_avg('price', 'store_id, sale_date')} AS price_dev_store_day,
  COALESCE(price / NULLIF(LAG(price) OVER ({W}), 0) - 1, 0) AS price_change,
  CAST(SUM(promo_active) OVER (PARTITION BY store_id, sale_date) AS BIGINT) AS promos_in_store_day,
  AVG(promo_active) OVER (PARTITION BY sku ORDER BY store_id, {ORD}
    ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS promo_share_30,
  COALESCE(LAG(net_sales, 30) OVER ({W}), MEDIAN(net_sales) OVER (PARTITION BY sku)) AS lag_30,
  AVG(net_sales) {_frame(14)} AS ma_14, MEDIAN(net_sales) {_frame(30)} AS median_30,
  MAX(net_sales) {_frame(90)} AS max_90, MIN(net_sales) {_frame(7)} AS min_7,
  COALESCE(STDDEV_SAMP(net_sales) {_frame(30)}, 0) AS std_30,
  AVG(net_sales) {_frame(7)} - AVG(net_sales) {_frame(30)} AS trend_7_30,
  COALESCE(net_sales / NULLIF({_avg('net_sales', 'sku, sale_date')}, 0), 1) AS sku_day_relative,
  sku || '_' || store_id AS sku_store
  FROM loaded JOIN near_holidays USING (sale_date)"""
LEAN_SQL = f"""SELECT *, {_avg('net_sales', 'sku')} AS sku_mean,
  price - {_avg('price', 'sku')} AS price_dev_sku,
  COALESCE(LAG(net_sales, 14) OVER ({W}), MEDIAN(net_sales) OVER (PARTITION BY sku, store_id)) AS lag_14,
  AVG(net_sales) {_frame(90)} AS ma_90, SUM(net_sales) {_frame(30)} AS rolling_sum_30,
  MEDIAN(net_sales) {_frame(7)} AS rolling_median_7, COUNT(net_sales) {_frame(3)} AS rolling_count_3,
  CAST(LEN(LIST_DISTINCT(LIST(promo_id) OVER (PARTITION BY sku, store_id ORDER BY sale_date
    RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW))) AS INT) AS promos_30d
  FROM loaded JOIN near_holidays USING (sale_date)"""


def _trends(r):
    from shelfcast.operators.skew import ordered

    rows = r.lines("net_sales")
    df = history.with_median(rows, ["sku"], "net_sales", "_median")
    df = ordered(
        df, history.GROUP, history.ORDER,
        lambda d, w: history.rolling_columns(
            history.lag_columns(d, w, [1], "net_sales", "_median"), w, [7, 30], ["mean"], "net_sales"
        ),
        30, source=rows,
    )
    return history.trend_diff(df)


QUERIES = {
    # ---- receipts ----
    "returns_agg": Query(
        lambda r: load.sum_returns(load.matched_returns(r.returns, r.sales)),
        "receipt_id sku store_id returned_qty", "SELECT * FROM returns_sum",
    ),
    "receipt_total": Query(
        lambda r: load.add_receipt_totals(r.sales), f"{ID} receipt_total", "SELECT * FROM loaded"
    ),
    "certificate_total": Query(
        lambda r: load.add_receipt_totals(r.sales), f"{ID} certificate_total", "SELECT * FROM loaded"
    ),
    # ---- prices ----
    "price_vs_sku_mean": Query(
        lambda r: pricing.price_vs_sku_mean(r.sales), f"{ID} price_vs_sku_mean~6",
        f"SELECT *, COALESCE(price / NULLIF({_avg('price', 'sku')}, 0), 1) AS price_vs_sku_mean FROM sales",
    ),
    "price_dev_store_day": Query(
        lambda r: pricing.price_dev_store_day(r.sales), f"{ID} price_dev_store_day~4",
        f"SELECT *, price - {_avg('price', 'store_id, sale_date')} AS price_dev_store_day FROM sales",
    ),
    "price_dev_sku": Query(
        lambda r: pricing.price_dev_sku(r.sales), f"{ID} price_dev_sku~4",
        f"SELECT *, price - {_avg('price', 'sku')} AS price_dev_sku FROM sales",
    ),
    "price_change": Query(
        lambda r: pricing.price_change(r.sales.withColumn("price", F.expr("if(line_no = 3, null, price)"))),
        f"{ID} price_change~6",
        f"""SELECT *, COALESCE(known / NULLIF(LAG(known) OVER ({W}), 0) - 1, 0) AS price_change FROM (
          SELECT *, LAST_VALUE(CASE WHEN line_no <> 3 THEN price END IGNORE NULLS) OVER ({W}
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known FROM sales) t""",
    ),
    # ---- promotions ----
    "promos_in_store_day": Query(
        lambda r: promo.promos_in_store_day(r.loaded), f"{ID} promos_in_store_day",
        """SELECT *, CAST(SUM(promo_active) OVER (PARTITION BY store_id, sale_date) AS BIGINT)
          AS promos_in_store_day FROM loaded""",
    ),
    "sku_mean_discount": Query(
        lambda r: promo.sku_mean_discount(pricing.discount(r.sales)), f"{ID} sku_mean_discount~6",
        """SELECT *, AVG(GREATEST(0, LEAST(1, COALESCE(1 - price / NULLIF(base_price, 0), 0))))
          OVER (PARTITION BY sku) AS sku_mean_discount FROM sales""",
    ),
    "promo_effectiveness": Query(
        lambda r: promo.promo_effectiveness(r.loaded),
        f"{ID} promo_sales_mean~6 promo_effectiveness~6",
        f"""SELECT *, {_avg('net_sales', 'sku, store_id, promo_active')} AS promo_sales_mean,
          COALESCE({_avg('CASE WHEN promo_active = 1 THEN net_sales END', 'sku, store_id')} /
          NULLIF({_avg('CASE WHEN promo_active = 0 THEN net_sales END', 'sku, store_id')}, 0), 1)
          AS promo_effectiveness FROM loaded""",
    ),
    "promo_share_30": Query(
        lambda r: promo.promo_share_30(r.loaded), f"{ID} promo_share_30~6",
        f"""SELECT *, AVG(promo_active) OVER (PARTITION BY sku ORDER BY store_id, {ORD}
          ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS promo_share_30 FROM loaded""",
    ),
    "recent_promo_7": Query(
        lambda r: promo.recent_promo_7(r.loaded), f"{ID} recent_promo_7",
        f"""SELECT *, COALESCE(MAX(promo_active) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0)
          AS recent_promo_7 FROM loaded""",
    ),
    "distinct_promos_30d": Query(
        lambda r: promo.distinct_promos_30d(r.sales), f"{ID} promos_30d",
        """SELECT *, CAST(LEN(LIST_DISTINCT(LIST(promo_id) OVER (PARTITION BY sku, store_id ORDER BY sale_date
          RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW))) AS INT) AS promos_30d FROM sales""",
    ),
    # ---- weighed goods and stores ----
    "weighed_group_mean": Query(
        lambda r: stores.weighed_group_mean(r.loaded), f"{ID} weighed_group_mean~6 weighed_group_ratio~6",
        f"""SELECT *, {_avg('net_sales', 'weighed, store_id')} AS weighed_group_mean,
          COALESCE(net_sales / NULLIF({_avg('net_sales', 'weighed, store_id')}, 0), 1)
          AS weighed_group_ratio FROM loaded""",
    ),
    "weighed_price_ratio": Query(
        lambda r: stores.weighed_price_ratio(r.loaded), f"{ID} price_ratio_weighed~6 price_ratio_unit~6",
        f"""SELECT *, CASE WHEN weighed = 1 THEN ratio ELSE 0 END AS price_ratio_weighed,
          CASE WHEN weighed = 0 THEN ratio ELSE 0 END AS price_ratio_unit FROM (SELECT *,
          COALESCE(price / NULLIF({_avg('price', 'weighed, store_id')}, 0), 0) AS ratio FROM loaded) t""",
    ),
    "weighed_quantile_scale": Query(
        lambda r: stores.weighed_quantile_scale(r.lines("net_sales", "weighed")), f"{ID} sales_scale_weighed~6 sales_scale_unit~6",
        """SELECT *, CASE WHEN weighed = 1 THEN v ELSE 0 END AS sales_scale_weighed,
          CASE WHEN weighed = 0 THEN v ELSE 0 END AS sales_scale_unit FROM (SELECT *,
          GREATEST(0, LEAST(1, (net_sales - q25) / CASE WHEN q75 = q25 THEN 1 ELSE q75 - q25 END)) AS v
          FROM (SELECT *, QUANTILE_CONT(net_sales, 0.25) OVER (PARTITION BY weighed, store_id) AS q25,
            QUANTILE_CONT(net_sales, 0.75) OVER (PARTITION BY weighed, store_id) AS q75 FROM loaded) t) u""",
    ),
    "store_day_activity": Query(
        lambda r: stores.store_day_activity(r.loaded), f"{ID} store_day_sales store_day_share~6",
        """SELECT *, COALESCE(net_sales / NULLIF(store_day_sales, 0), 0) AS store_day_share FROM (
          SELECT *, SUM(net_sales) OVER (PARTITION BY store_id, sale_date) AS store_day_sales FROM loaded) t""",
    ),
    "store_rank": Query(
        lambda r: stores.store_rank(r.loaded), f"{ID} store_rank~6",
        """SELECT * FROM loaded JOIN (SELECT store_id, (RANK() OVER (ORDER BY m) +
          (COUNT(*) OVER (PARTITION BY m) - 1) / 2.0) / COUNT(*) OVER () AS store_rank FROM (
          SELECT store_id, AVG(net_sales) AS m FROM loaded GROUP BY store_id) t) s USING (store_id)""",
    ),
    "sku_day_relative": Query(
        lambda r: stores.sku_day_relative(r.loaded), f"{ID} sku_day_relative~6",
        f"""SELECT *, COALESCE(net_sales / NULLIF({_avg('net_sales', 'sku, sale_date')}, 0), 1)
          AS sku_day_relative FROM loaded""",
    ),
    "sku_mean": Query(
        lambda r: stores.sku_mean(r.loaded), f"{ID} sku_mean~6",
        f"SELECT *, {_avg('net_sales', 'sku')} AS sku_mean FROM loaded",
    ),
    "target_encoding": Query(
        lambda r: target.target_encoding(_with_weekday(r.loaded)),
        f"{ID} " + " ".join(f"{f}_target_mean~6" for f in target.ENCODED),
        _encoding_sql(),
        {"dated": """SELECT *, ISODOW(sale_date) - 1 AS weekday, MONTH(sale_date) AS month,
          CASE WHEN sale_date < (SELECT MAX(sale_date) FROM loaded) - 30 THEN net_sales END AS y FROM loaded"""},
    ),
    # ---- reports ----
    "store_summary": Query(
        lambda r: summary.store_summary(r.loaded),
        "store_id mean_sales~6 total_sales sku_count row_count rating~3",
        """SELECT *, ROUND((RANK() OVER (ORDER BY total_sales) + (COUNT(*) OVER (PARTITION BY total_sales) - 1)
          / 2.0) / COUNT(*) OVER (), 3) AS rating FROM (SELECT store_id, AVG(net_sales) AS mean_sales,
          SUM(net_sales) AS total_sales, COUNT(DISTINCT sku) AS sku_count, COUNT(*) AS row_count
          FROM loaded GROUP BY store_id) t""",
    ),
    "product_summary": Query(
        lambda r: summary.product_summary(r.loaded),
        "sku mean_sales~6 total_sales store_count day_count weighed",
        """SELECT sku, AVG(net_sales) AS mean_sales, SUM(net_sales) AS total_sales,
          COUNT(DISTINCT store_id) AS store_count, COUNT(DISTINCT sale_date) AS day_count,
          MAX(weighed) AS weighed FROM loaded GROUP BY sku""",
    ),
    "promo_effect_by_sku": Query(
        lambda r: summary.promo_effect_by_sku(r.loaded),
        "sku sales_without_promo~6 sales_with_promo~6 days_without_promo days_with_promo promo_effect~6",
        """SELECT *, sales_with_promo / CASE WHEN sales_without_promo = 0 THEN 1 ELSE sales_without_promo END
          AS promo_effect FROM (SELECT sku,
          COALESCE(AVG(CASE WHEN promo_active = 0 THEN net_sales END), 0) AS sales_without_promo,
          COALESCE(AVG(CASE WHEN promo_active = 1 THEN net_sales END), 0) AS sales_with_promo,
          COUNT(DISTINCT CASE WHEN promo_active = 0 THEN sale_date END) AS days_without_promo,
          COUNT(DISTINCT CASE WHEN promo_active = 1 THEN sale_date END) AS days_with_promo
          FROM loaded GROUP BY sku) t WHERE days_with_promo >= 5""",
    ),
    "promo_effect_by_type": Query(
        lambda r: summary.promo_effect_by_type(r.loaded),
        "promo_type mean_sales~6 sku_count day_count type_effect~6",
        """SELECT promo_type, AVG(net_sales) AS mean_sales, COUNT(DISTINCT sku) AS sku_count,
          COUNT(DISTINCT sale_date) AS day_count, AVG(net_sales) /
          (SELECT AVG(net_sales) FROM loaded WHERE promo_active = 0) AS type_effect
          FROM loaded GROUP BY promo_type""",
    ),
    "season_weekday": Query(
        lambda r: summary.season_weekday(r.loaded), f"weekday weekday_name {SEASON}",
        _season_sql("weekday", "ISODOW(sale_date) - 1", summary.WEEKDAY_NAMES, 0),
    ),
    "season_month": Query(
        lambda r: summary.season_month(r.loaded), f"month month_name {SEASON}",
        _season_sql("month", "MONTH(sale_date)", summary.MONTH_NAMES, 1),
    ),
    "season_holiday": Query(
        lambda r: summary.season_holiday(holiday_distance(r.loaded, r.holidays)),
        "period mean_sales~6 ratio~6",
        "SELECT period, AVG(net_sales) AS mean_sales, AVG(net_sales) / (SELECT AVG(net_sales) FROM loaded) "
        "AS ratio FROM (" + " UNION ALL ".join(
            f"SELECT '{summary.HOLIDAY_PERIODS[k]}' AS period, net_sales FROM near WHERE {test}"
            for k, test in {
                "before": "days_to_holiday BETWEEN 1 AND 7", "on": "is_holiday = 1",
                "after": "days_since_holiday BETWEEN 1 AND 7",
                "normal": "days_to_holiday > 7 AND days_since_holiday > 7",
            }.items()
        ) + ") t GROUP BY period",
        {"near": "SELECT * FROM loaded JOIN near_holidays USING (sale_date)"},
    ),
    # ---- ordered windows ----
    "lags": Query(
        lambda r: history.lags(r.lines("net_sales")), f"{ID} " + " ".join(f"lag_{n}" for n in history.LAGS_WIDE),
        _lag_sql(history.LAGS_WIDE, "sku"),
    ),
    "lags_lean": Query(
        lambda r: history.lags(r.lines("net_sales"), history.LAGS_LEAN, fill_by=history.GROUP),
        f"{ID} " + " ".join(f"lag_{n}" for n in history.LAGS_LEAN),
        _lag_sql(history.LAGS_LEAN, "sku, store_id"),
    ),
    "rolling_stats": Query(
        lambda r: history.rolling_stats(r.lines("net_sales")),
        f"{ID} " + " ".join(f"{s}_{n}~6" for n in history.WINDOWS_WIDE for s in ROLLING),
        _rolling_sql(history.WINDOWS_WIDE, ROLLING),
    ),
    "rolling_mean": Query(
        lambda r: history.rolling_mean(r.loaded),
        f"{ID} " + " ".join(f"ma_{n}~6" for n in history.WINDOWS_LEAN),
        _rolling_sql(history.WINDOWS_LEAN, {"ma": ROLLING["ma"]}),
    ),
    "rolling_sum_count": Query(
        lambda r: history.rolling_sum_count(r.loaded),
        f"{ID} " + " ".join(f"{s}_{n}~6" for n in history.WINDOWS_SUMS for s in SUMS),
        _rolling_sql(history.WINDOWS_SUMS, SUMS),
    ),
    "trend_diff": Query(
        _trends, f"{ID} trend_1_7~6 trend_7_30~6",
        f"""SELECT *, COALESCE(LAG(net_sales) OVER ({W}), MEDIAN(net_sales) OVER (PARTITION BY sku))
          - AVG(net_sales) {_frame(7)} AS trend_1_7,
          AVG(net_sales) {_frame(7)} - AVG(net_sales) {_frame(30)} AS trend_7_30 FROM loaded""",
    ),
    "trend_slope": Query(
        lambda r: history.trend_slope(r.loaded), f"{ID} trend_slope_7~6", SLOPE_SQL
    ),
    "acceleration": Query(
        lambda r: history.trend_slope(r.loaded), f"{ID} acceleration_7~6",
        f"""SELECT *, COALESCE(trend_slope_7 - LAG(trend_slope_7) OVER ({W}), 0) AS acceleration_7
          FROM ({SLOPE_SQL}) s""",
    ),
    "yoy_change": Query(
        lambda r: history.yoy_change(r.loaded), f"{ID} yoy_change~6",
        f"""SELECT *, COALESCE(net_sales / NULLIF(LAG(net_sales) OVER (
          PARTITION BY sku, store_id, DAYOFYEAR(sale_date) ORDER BY {ORD}), 0), 1) AS yoy_change FROM loaded""",
    ),
    "anomalies": Query(
        lambda r: quality.anomalies(r.loaded, threshold=2.0), f"{ID} net_sales z_score~6",
        f"SELECT * FROM ({SCORES_SQL}) s WHERE ABS(z_score) > 2",
    ),
    "anomaly_counts": Query(
        lambda r: quality.anomaly_counts(quality.anomalies(r.loaded, threshold=2.0)),
        "sku store_id anomaly_count",
        f"""SELECT sku, store_id, COUNT(*) AS anomaly_count FROM ({SCORES_SQL}) s WHERE ABS(z_score) > 2
          GROUP BY sku, store_id ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    ),
    "ts_folds": Query(
        lambda r: frames.ts_folds(r.loaded, 5), f"{ID} row_index fold", _folds_sql(5)
    ),
    "sort_sales": Query(
        lambda r: history.numbered(r.sales).orderBy("sku", "store_id", "position"), f"{ID} position",
        f"SELECT *, ROW_NUMBER() OVER ({W}) AS position FROM sales",
    ),
    # ---- whole feature sets ----
    "wide_features": Query(
        _wide,
        f"{ID} weekday days_to_holiday price_vs_sku_mean~6 price_dev_store_day~4 price_change~6 "
        "promos_in_store_day promo_share_30~6 lag_30~6 ma_14~6 median_30~6 max_90~6 min_7~6 std_30~6 "
        "trend_7_30~6 sku_day_relative~6 sku_store",
        WIDE_SQL,
    ),
    "lean_features": Query(
        _lean,
        f"{ID} days_since_holiday sku_mean~6 price_dev_sku~4 lag_14~6 ma_90~6 rolling_sum_30~6 "
        "rolling_median_7~6 rolling_count_3 promos_30d",
        LEAN_SQL,
    ),
    # ---- target ----
    "winsorize_target": Query(
        lambda r: target.winsorize_target(r.lines("net_sales")), f"{ID} net_sales~6", "SELECT * FROM clipped",
        _boxcox_sql(),
    ),
    "boxcox_target": Query(
        lambda r: target.boxcox_target(target.winsorize_target(r.lines("net_sales", "weighed"))), f"{ID} boxcox_net_sales~4",
        """SELECT c.*, CASE WHEN net_sales > 0 AND weighed = 0 THEN ((CASE WHEN p = 0 THEN LN(net_sales)
          ELSE (POWER(net_sales, p) - 1) / p END) - m) / sd ELSE 0 END AS boxcox_net_sales
          FROM clipped c CROSS JOIN best2""",
        _boxcox_sql(),
    ),
}
