"""Queries for forecast quality, models, scoring, change streams and messages."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from shelfcast.catalog.base import ID, W, Query
from shelfcast.catalog.rows import CASES_SQL, cases
from shelfcast.functions.columns import forecast_value
from shelfcast.models import ensemble as E
from shelfcast.models import linear
from shelfcast.models.search import search_params, trial_params
from shelfcast.operators import quality, summary
from shelfcast.operators.dates import holiday_distance
from shelfcast.operators.history import previous_mean
from shelfcast.operators.skew import ordered
from shelfcast.operators.target import split_date, train_test_split
from shelfcast.plans import jobs
from shelfcast.plans.state import FeatureState, grid_features
from shelfcast.schema import GROUP, ORDER
from shelfcast.settings import new_path, settle
from shelfcast.sources.files import write_result
from shelfcast.streaming import messages

SMALL = {"gbt": {"maxIter": 8, "maxDepth": 4}, "forest": {"numTrees": 8, "maxDepth": 5}}


# ---- quality -----------------------------------------------------------------

def scored(r):
    return previous_mean(r.lines("net_sales", "weighed", "promo_active"))


DIFF = "(net_sales - predicted)"
MAPD_SQL = f"AVG(ABS({DIFF} / (net_sales + 1e-7))) * 100"
ERRORS_SQL = f"SQRT(AVG({DIFF} * {DIFF})) AS rmse, AVG(ABS{DIFF}) AS mae, {MAPD_SQL} AS mapd"
METRICS_SQL = f"""SQRT(AVG({DIFF} * {DIFF})) AS rmse, AVG(ABS{DIFF}) AS mae,
  AVG(CASE WHEN net_sales <> 0 THEN ABS({DIFF} / net_sales) END) * 100 AS mape,
  AVG(2 * ABS{DIFF} / (ABS(net_sales) + ABS(predicted) + 1e-7)) * 100 AS smape"""
WITHIN_SQL = ", ".join(
    f"AVG(CASE WHEN ABS({DIFF} / (net_sales + 1e-7)) <= {t} THEN 1.0 ELSE 0.0 END) * 100 AS within_{round(t * 100)}"
    for t in quality.TOLERANCES
)
SKU_SQL = f"SELECT sku, AVG(ABS{DIFF}) AS mean_abs_error FROM scored GROUP BY sku"


def _best_sql(side: str, k: int) -> str:
    way = "DESC" if side == "worst" else "ASC"
    return f"(SELECT '{side}' AS side, * FROM ({SKU_SQL}) t ORDER BY mean_abs_error {way}, sku LIMIT {k})"


def _report(r):
    lines = r.lines("net_sales", "is_holiday")
    scored = settle(previous_mean(lines).select("sku", "net_sales", "predicted"), "scored")
    return quality.report_table(
        scored, summary.season_weekday(lines), summary.season_month(lines),
        summary.season_holiday(holiday_distance(lines, r.holidays)), k=5,
    )


def _long(section: str, item: str, values: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, CAST({item} AS VARCHAR) AS item, '{v}' AS name, "
        f"CAST({v} AS DOUBLE) AS value FROM ({source}) t" for v in values
    )


def _report_sql() -> str:
    from shelfcast.catalog.groups import QUERIES as G
    from shelfcast.catalog.groups import _season_sql

    season = ["mean_sales", "median_sales", "std_sales", "ratio"]
    accuracy = ["rmse", "mae", "mape", "smape", "within_10", "within_20", "within_30"]
    return " UNION ALL ".join(
        [
            _long("accuracy", "'all'", accuracy, f"SELECT {METRICS_SQL}, {WITHIN_SQL} FROM scored"),
            _long("season_weekday", "weekday_name", season,
                  _season_sql("weekday", "ISODOW(sale_date) - 1", summary.WEEKDAY_NAMES, 0)),
            _long("season_month", "month_name", season,
                  _season_sql("month", "MONTH(sale_date)", summary.MONTH_NAMES, 1)),
            _long("season_holiday", "period", ["mean_sales", "ratio"], G["season_holiday"].sql),
            _long("worst_skus", "sku", ["mean_abs_error"], f"SELECT * FROM {_best_sql('worst', 5)} w"),
            _long("best_skus", "sku", ["mean_abs_error"], f"SELECT * FROM {_best_sql('best', 5)} b"),
        ]
    )


# ---- ensembles of simple predictors ------------------------------------------

SIMPLE = {"p1": 7, "p2": 30, "p3": 1}
SIMPLE_SQL = "SELECT *, " + ", ".join(
    f"COALESCE(AVG(net_sales) OVER ({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) AS {name}"
    for name, n in SIMPLE.items()
) + " FROM loaded"


def simple_members(r):
    def means(d, w):
        return d.withColumns(
            {
                name: F.coalesce(F.avg("net_sales").over(w.rowsBetween(-n, -1)), F.lit(0.0))
                for name, n in SIMPLE.items()
            }
        )

    return ordered(r.lines("net_sales"), GROUP, ORDER, means, 30)


# ---- trained models ----------------------------------------------------------

# Frames and models of one folder are shared by the queries of one session.
_kept: dict[tuple, object] = {}


def _key(r, name: str) -> tuple:
    return r.spark.sparkContext.applicationId, r.folder, name


def _known(r, name: str) -> bool:
    return _key(r, name) in _kept


def _keep(r, name: str, make):
    if not _known(r, name):
        _kept[_key(r, name)] = make()
    return _kept[_key(r, name)]


def frame(r):
    return _keep(r, "frame", lambda: jobs.model_frame(r.loaded, r.holidays, r.promotions))


def model(r) -> E.Ensemble:
    def make():
        train, _ = train_test_split(frame(r))
        return jobs.fit_ensemble(train, *jobs.wide_feature_lists(frame(r)), params=SMALL)

    return _keep(r, "model", make)


def lean(r) -> E.Ensemble:
    return _keep(
        r, "lean",
        lambda: jobs.fit_lean(
            jobs.lean_frame(r.loaded, r.holidays, r.promotions), params=SMALL["gbt"]
        ),
    )


def matrix(r):
    """Training rows with vectors and the log target.

    Encodings and category codes are learnt from columns without windows; only the matrix needs whole rows. So
    the frame is not written for it, but used if there is one.
    """
    def make():
        if _known(r, "frame"):
            rows = known = loaded = frame(r)
        else:
            loaded = settle(r.loaded, "loaded", "zstd")
            rows, known = jobs.model_features(loaded, r.holidays, r.promotions)
        train = F.col("sale_date") <= F.lit(split_date(loaded))
        features, categorical = jobs.wide_feature_lists(rows)
        missing = {*categorical, "sku", "store_id"} - set(known.columns)
        if missing:
            raise ValueError(f"nothing to learn codes from: {sorted(missing)}")
        prep = E.prepare_matrix(known.where(train), features, categorical, "net_sales")
        rows = prep.apply(rows.where(train)).select(
            *ORDER, "features", F.log1p("net_sales").alias(E.LABEL),
            (F.col("sale_date") > F.lit("2001-08-01").cast("date")).alias("_late"),
        )
        return settle(rows, "matrix", "zstd")

    return _keep(r, "matrix", make)


def _prepared(r):
    from pyspark.ml.functions import vector_to_array

    return matrix(r).select(*ORDER, F.size(vector_to_array("features")).alias("feature_count"), E.LABEL)


def _member(kind: str):
    def run(r):
        fitted = E.fit_member(kind, matrix(r), SMALL.get(kind), "_late")
        rows = fitted.transform(matrix(r)).withColumn("_p", F.expm1(f"_{kind}"))
        truth = F.expm1(E.LABEL)
        return rows.groupBy(F.col("_late").alias("validation")).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sqrt(F.avg(F.pow(truth - F.col("_p"), 2))).alias("rmse"),
            F.avg(F.abs(truth - F.col("_p"))).alias("mae"),
        )

    return run


def _search(kind: str, trials: int = 2, folds: int = 3, halving: int = 1):
    """Scores of a member's trials; trees stay as small as in the other queries."""

    def run(r):
        drawn = [{**t, **SMALL.get(kind, {})} for t in trial_params(kind, trials)]
        return search_params(matrix(r), kind, drawn, folds, halving=halving)[0]

    return run


def _stored(r):
    path = new_path(r.spark, "model")
    model(r).save(r.spark, path)
    back = E.Ensemble.load(r.spark, path)
    _, test = train_test_split(frame(r))
    once = model(r).predict(test).select(*ORDER, F.col("predicted").alias("before"))
    again = back.predict(test).select(*ORDER, F.col("predicted").alias("after"))
    return once.join(again, ORDER).select(
        *ORDER, "before", "after", (F.abs(F.col("before") - F.col("after")) < 1e-9).alias("same")
    )


def _scored_csv(r):
    _, test = train_test_split(frame(r))
    source, path = new_path(r.spark, "rows"), new_path(r.spark, "scored")
    write_result(test, source)
    jobs.score_csv(r.spark, model(r), source, test.schema, path)
    schema = test.withColumn("forecast", F.lit(0.0)).schema
    return r.spark.read.schema(schema).option("header", True).csv(path).select(*ORDER, "forecast")


def _score_test(r):
    _, test = train_test_split(frame(r))
    return jobs.score_rows(model(r), test).select(*ORDER, *E.member_columns(), "forecast")


# ---- least squares -----------------------------------------------------------

LINEAR, RIDGE = list(SIMPLE), 0.01
LINE_ID = [c.rstrip("@") for c in ID.split()]


def linear_rows(r):
    """Training and test rows with the features and the label."""
    members = settle(simple_members(r), "members")
    parts = train_test_split(members)
    return [linear.prepared(part, LINEAR, "net_sales", keep=LINE_ID) for part in parts]


def _linear_model(r):
    train, test = linear_rows(r)
    return linear.fit(train, LINEAR, ridge=RIDGE), test


def _linear_scores(r):
    found, test = _linear_model(r)
    model = linear.LeastSquares.of(settle(found.table(r.spark), "coefficients"))
    return model.score(test)


def _linear_csv(r):
    model, test = _linear_model(r)
    source, path = new_path(r.spark, "rows"), new_path(r.spark, "scored")
    write_result(test, source)
    jobs.score_csv(r.spark, model, source, test.schema, path)
    return r.spark.read.schema(model.score(test).schema).option("header", True).csv(path)


RIDGES = (0.0, 0.01, 0.1, 1.0, 10.0)


def _linear_path(r):
    """Validation error of every penalty; the last 30 days of the training rows choose."""
    train, _ = train_test_split(settle(simple_members(r), "members"))
    parts = [linear.prepared(part, LINEAR, "net_sales") for part in train_test_split(train)]
    _, errors = linear.path(*parts, LINEAR, RIDGES)
    return r.spark.createDataFrame(errors, "ridge double, rmse double")


def _linear_tables(days: str = "(SELECT MAX(sale_date) FROM loaded) - 30", ridges: tuple = (RIDGE,)) -> dict[str, str]:
    """The normal equations of three features, solved by Cramer's rule for every penalty."""
    names = enumerate(LINEAR, 1)
    pairs = [(i, j) for i in (1, 2, 3) for j in (1, 2, 3)]
    cover = lambda i, j: f"COVAR_POP({LINEAR[i - 1]}, {LINEAR[j - 1]})"
    moments = [f"AVG({f}) AS m{i}, COVAR_POP({f}, label) AS s{i}y" for i, f in names]
    moments += [f"{cover(i, j)} AS s{i}{j}" for i, j in pairs]

    def determinant(replaced: int) -> str:
        at = lambda i, j: f"s{i}y" if j == replaced else f"(s{i}{j} * (1 + ridge))" if i == j else f"s{i}{j}"
        return " + ".join(
            f"{at(1, a)} * ({at(2, b)} * {at(3, c)} - {at(2, c)} * {at(3, b)})" for a, b, c in ((1, 2, 3), (2, 3, 1), (3, 1, 2))
        )

    return {
        "simple": SIMPLE_SQL,
        "labelled": """SELECT *, CASE WHEN net_sales > -1 THEN LN(1 + net_sales) END AS label,
          sale_date <= (SELECT MAX(sale_date) FROM loaded) - 30 AS known FROM simple""",
        "split": f"SELECT *, sale_date <= {days} AS training FROM labelled",
        "ridges": " UNION ALL ".join(f"SELECT {k!r} AS ridge" for k in ridges),
        "moments": f"SELECT AVG(label) AS my, {', '.join(moments)} FROM split WHERE training AND label IS NOT NULL",
        "solved": "SELECT *, " + ", ".join(f"({determinant(k)}) / ({determinant(0)}) AS b{k}" for k in (1, 2, 3)) + " FROM moments CROSS JOIN ridges",
        "raw_forecasts": """SELECT l.*, ridge, my + b1 * (p1 - m1) + b2 * (p2 - m2) + b3 * (p3 - m3) AS raw
          FROM split l CROSS JOIN solved WHERE NOT training""",
        "forecasts": "SELECT *, GREATEST(EXP(raw) - 1, 0) AS forecast FROM raw_forecasts",
    }


LINEAR_SQL = "SELECT * FROM forecasts"
COEFFICIENTS_SQL = " UNION ALL ".join(
    [f"SELECT '{linear.INTERCEPT}' AS feature, my - b1 * m1 - b2 * m2 - b3 * m3 AS coefficient FROM solved"]
    + [f"SELECT '{f}', b{i} FROM solved" for i, f in enumerate(LINEAR, 1)]
)


# ---- feature state -----------------------------------------------------------

STATE_DAYS = 7
STATE_COLUMNS = (
    "sku store_id sale_date@ price~2 lag_1~6 lag_30~6 lag_90~6 ma_7~6 ma_90~6 median_14~6 max_30~6 min_7~6 "
    "std_30~4 trend_slope_7~4 acceleration_7~4 recent_promo_7 price_change~6 promo_share_30~6 price_vs_sku_mean~6 "
    "sku_mean_discount~6 price_dev_store_day~4 promo_sales_mean~6 promo_effectiveness~6 weighed_group_mean~6 "
    "price_ratio_weighed~6 price_ratio_unit~6 store_rank~6 days_since_start"
)


def _state_features(r):
    """Grid features from the merged states of two halves of the history."""
    half = F.pmod(F.xxhash64(*ORDER), F.lit(2))
    loaded = settle(r.loaded, "loaded")
    state = FeatureState.build(loaded.where(half == 0)).merge(FeatureState.build(loaded.where(half == 1)))
    return grid_features(state, state.grid(r.holidays, r.promotions, STATE_DAYS), r.holidays, r.promotions)


def _state_tables() -> dict[str, str]:
    """The same features over the whole history and the grid."""
    back = lambda n: f"({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    newest = ", ".join(f"{c} DESC" for c in ORDER)
    same = "sku, store_id, sale_date, receipt_id, line_part, line_supp, line_no, quantity, base_price, price, weighed, promo_active, net_sales"
    return {
        "attributes": f"""SELECT sku, price, base_price, weighed FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY sku ORDER BY {newest}) AS rn FROM loaded) t WHERE rn = 1""",
        "grid": f"""SELECT p.sku, p.store_id, CAST(m.d + CAST(i AS INT) AS DATE) AS sale_date, a.price, a.base_price, a.weighed
          FROM (SELECT DISTINCT sku, store_id FROM loaded) p CROSS JOIN (SELECT MAX(sale_date) AS d FROM loaded) m
          CROSS JOIN (SELECT UNNEST(GENERATE_SERIES(1, {STATE_DAYS})) AS i) g LEFT JOIN attributes a ON a.sku = p.sku""",
        "every_row": f"""SELECT {same}, FALSE AS future FROM loaded UNION ALL
          SELECT sku, store_id, sale_date, NULL, NULL, NULL, NULL, NULL, base_price, price, weighed, 0, NULL, TRUE FROM grid""",
        "numbered": f"""SELECT *, ROW_NUMBER() OVER ({W}) AS rn,
          GREATEST(0, LEAST(1, 1 - COALESCE(price / NULLIF(base_price, 0), 1))) AS discount FROM every_row""",
        "looked": f"""SELECT *, {", ".join(f"LAG(net_sales, {n}) OVER ({W}) AS before_{n}" for n in (1, 30, 90))},
          {", ".join(f"AVG(net_sales) OVER {back(n)} AS ma_{n}" for n in (7, 90))},
          MEDIAN(net_sales) OVER {back(14)} AS median_14, MAX(net_sales) OVER {back(30)} AS max_30,
          MIN(net_sales) OVER {back(7)} AS min_7, COALESCE(STDDEV_SAMP(net_sales) OVER {back(30)}, 0) AS std_30,
          COALESCE(CASE WHEN COUNT(net_sales) OVER {back(7)} >= 3 THEN REGR_SLOPE(net_sales, rn) OVER {back(7)} END, 0) AS trend_slope_7,
          COALESCE(MAX(promo_active) OVER {back(7)}, 0) AS recent_promo_7,
          COALESCE(price / NULLIF(LAG(price) OVER ({W}), 0) - 1, 0) AS price_change,
          AVG(promo_active) OVER (PARTITION BY sku ORDER BY store_id, {", ".join(ORDER)} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS promo_share_30
          FROM numbered""",
        "trended": f"SELECT *, COALESCE(trend_slope_7 - LAG(trend_slope_7) OVER ({W}), 0) AS acceleration_7 FROM looked",
        "by_sku": """SELECT sku, AVG(price) AS sku_price, AVG(discount) AS sku_mean_discount, MEDIAN(net_sales) AS med FROM numbered GROUP BY sku""",
        "by_pair": """SELECT sku, store_id, AVG(CASE WHEN promo_active = 1 THEN net_sales END) AS on_mean,
          AVG(CASE WHEN promo_active = 0 THEN net_sales END) AS off_mean FROM every_row GROUP BY sku, store_id""",
        "by_kind": "SELECT weighed, store_id, AVG(net_sales) AS weighed_group_mean, AVG(price) AS kind_price FROM every_row GROUP BY weighed, store_id",
        "by_day": "SELECT store_id, sale_date, AVG(price) AS day_price FROM every_row WHERE future GROUP BY store_id, sale_date",
        "by_store": """SELECT store_id, (RANK() OVER (ORDER BY mean) + (COUNT(*) OVER (PARTITION BY mean) - 1) / 2.0) / COUNT(*) OVER () AS store_rank
          FROM (SELECT store_id, AVG(net_sales) AS mean FROM every_row GROUP BY store_id) t""",
    }


STATE_SQL = """SELECT t.*, COALESCE(before_1, med) AS lag_1, COALESCE(before_30, med) AS lag_30, COALESCE(before_90, med) AS lag_90,
  COALESCE(price / NULLIF(sku_price, 0), 1) AS price_vs_sku_mean, sku_mean_discount, price - day_price AS price_dev_store_day,
  off_mean AS promo_sales_mean, COALESCE(on_mean / NULLIF(off_mean, 0), 1) AS promo_effectiveness, weighed_group_mean,
  CASE WHEN t.weighed = 1 THEN COALESCE(price / NULLIF(kind_price, 0), 0) ELSE 0 END AS price_ratio_weighed,
  CASE WHEN t.weighed = 0 THEN COALESCE(price / NULLIF(kind_price, 0), 0) ELSE 0 END AS price_ratio_unit,
  store_rank, t.sale_date - (SELECT MIN(sale_date) FROM loaded) AS days_since_start
  FROM trended t JOIN by_sku USING (sku) JOIN by_pair USING (sku, store_id) JOIN by_kind k ON k.weighed = t.weighed AND k.store_id = t.store_id
  JOIN by_day d ON d.store_id = t.store_id AND d.sale_date = t.sale_date JOIN by_store s ON s.store_id = t.store_id WHERE future"""


# ---- streams -----------------------------------------------------------------

def events(r):
    return r.table("events").select("user_id", "ts", "event_id", "event_type")


def event_messages(events):
    """The events as message texts, every seventh one cut short."""
    text = F.concat(
        F.lit('{"type": "'), F.col("event_type"), F.lit('"'),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(
            F.concat(F.lit(', "text": "v'), F.col("event_id").cast("string"), F.lit('"'))
        ),
        F.when(F.col("event_id") % 7 == 0, "").otherwise("}"),
    )
    return events.select("event_id", text.alias("message"))


def _to_the_end(spark, result, name: str):
    """Run a streaming query until its input ends, and read its result."""
    path = new_path(spark, name)
    query = (
        result.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", new_path(spark, f"{name}-log"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(path)


def _streamed(r, change, name: str):
    """A streaming query over the table's files."""
    source = (
        r.spark.readStream.schema(r.table("events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(r.folder)
    )
    return _to_the_end(r.spark, change(source), name)


# Micro-batches of the disordered stream, the most that an event is late, and how long rows wait.
BATCHES, LATENESS, DELAY = 4, timedelta(hours=6), timedelta(hours=12)
# The session of the event that closes the stream.
CLOSING = -1


def disordered(r) -> str:
    """The events as files in order of arrival, up to ``LATENESS`` late; at the end comes one event of
    a session of its own, later than all, which moves the watermark past them."""
    late = F.pmod(F.xxhash64("event_id"), F.lit(int(LATENESS.total_seconds())))
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = settle(events(r).withColumn("_arrival", at + late), "arrivals")
    first, last = rows.agg(F.min("_arrival"), F.max("_arrival")).first()
    step = ((last or 0) - (first or 0)) // BATCHES + 1
    path = new_path(r.spark, "event-files")
    for k in range(BATCHES):
        batch = rows.where(F.floor((F.col("_arrival") - F.lit(first)) / step) == k).drop("_arrival")
        batch.coalesce(1).write.mode("append").parquet(path)
    end = rows.agg(F.max("ts").alias("ts")).select(
        F.lit(CLOSING).cast("bigint").alias("user_id"), (F.col("ts") + F.expr("interval 10000 days")).alias("ts"),
        F.lit(CLOSING).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("event_type"),
    )
    end.write.mode("append").parquet(path)
    return path


def _changes_stream(r, expiry: timedelta):
    source = r.spark.readStream.schema(events(r).schema).option("maxFilesPerTrigger", 1).parquet(disordered(r))
    result = messages.changes_only_stream(source, delay=DELAY, expiry=expiry)
    return _dated(_to_the_end(r.spark, result, "changes").where(F.col("user_id") != CLOSING))


CHANGES = "user_id ts_text event_id event_type"
CHANGES_SQL = """SELECT *, STRFTIME(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM (SELECT *,
  LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) t
  WHERE before IS NULL OR before <> event_type"""
# A session idle for longer than this starts anew.
IDLE = timedelta(hours=18)
EXPIRY_SQL = """SELECT *, STRFTIME(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM (SELECT *,
  LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before,
  LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ts_before FROM events) t
  WHERE before IS NULL OR before <> event_type OR ts - ts_before > INTERVAL 18 HOUR"""
MESSAGES_SQL = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'v' || event_id END AS text
  FROM events WHERE event_type = 'click' AND event_id % 7 <> 0"""



def _dated(df):
    return df.withColumn("ts_text", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def _messages(events):
    return messages.json_messages(event_messages(events), wanted="click")


QUERIES = {
    "metrics": Query(
        lambda r: quality.metrics(scored(r)), "rmse~6 mae~6 mape~6 smape~6",
        f"SELECT {METRICS_SQL} FROM scored",
    ),
    "mapd": Query(lambda r: quality.mapd(scored(r)), "mapd~2", f"SELECT {MAPD_SQL} AS mapd FROM scored"),
    "error_percentiles": Query(
        lambda r: quality.error_percentiles(scored(r)),
        "error_p50~6 error_p75~6 error_p90~6 error_p95~6 error_p99~6",
        "SELECT " + ", ".join(
            f"QUANTILE_CONT(ABS{DIFF}, {q}) AS error_p{round(q * 100)}" for q in quality.PERCENTILES
        ) + " FROM scored",
    ),
    "within_tolerance": Query(
        lambda r: quality.within_tolerance(scored(r)), "within_10~6 within_20~6 within_30~6",
        f"SELECT {WITHIN_SQL} FROM scored",
    ),
    "errors_by_weighed": Query(
        lambda r: quality.errors_by(scored(r), "weighed"), "weighed rmse~6 mae~6 mapd~2",
        f"SELECT weighed, {ERRORS_SQL} FROM scored GROUP BY weighed",
    ),
    "errors_by_promo": Query(
        lambda r: quality.errors_by(scored(r), "promo_active"), "promo_active rmse~6 mae~6 mapd~2",
        f"SELECT promo_active, {ERRORS_SQL} FROM scored GROUP BY promo_active",
    ),
    "errors_by_weekday": Query(
        lambda r: quality.errors_by(scored(r).withColumn("weekday", F.weekday("sale_date")), "weekday"),
        "weekday rmse~6 mae~6 mapd~2",
        f"SELECT ISODOW(sale_date) - 1 AS weekday, {ERRORS_SQL} FROM scored GROUP BY 1",
    ),
    "row_errors": Query(
        lambda r: quality.row_errors(scored(r)), f"{ID} abs_error~6 rel_error~2",
        f"SELECT *, ABS{DIFF} AS abs_error, ABS({DIFF} / (net_sales + 1e-7)) * 100 AS rel_error FROM scored",
    ),
    "worst_best_skus": Query(
        lambda r: quality.worst_best_skus(scored(r), 10), "side sku mean_abs_error~6",
        f"SELECT * FROM {_best_sql('worst', 10)} w UNION ALL SELECT * FROM {_best_sql('best', 10)} b",
    ),
    "report_table": Query(_report, "section item name value~4", _report_sql(), {
        "near": "SELECT * FROM loaded JOIN near_holidays USING (sale_date)"
    }),
    "nonneg_forecast": Query(
        lambda r: scored(r).withColumn(
            "forecast", forecast_value(F.col("predicted") - 20, F.col("weighed"))
        ),
        f"{ID} forecast~6",
        """SELECT *, CASE WHEN weighed = 0 THEN ROUND_EVEN(GREATEST(predicted - 20, 0), 0)
          ELSE GREATEST(predicted - 20, 0) END AS forecast FROM scored""",
    ),
    # ---- ensembles ----
    "ensemble_weights": Query(
        lambda r: E.ensemble_weights(simple_members(r), "net_sales", list(SIMPLE)),
        "w1~1 w2~1 w3~1 rmse~6",
        """SELECT i / 10.0 AS w1, j / 10.0 AS w2, (10 - i - j) / 10.0 AS w3,
          SQRT(AVG(POWER(net_sales - i / 10.0 * p1 - j / 10.0 * p2 - (10 - i - j) / 10.0 * p3, 2))) AS rmse
          FROM simple CROSS JOIN grid WHERE i + j <= 10 GROUP BY i, j""",
        {"simple": SIMPLE_SQL, "grid": """SELECT i, j FROM (SELECT UNNEST(GENERATE_SERIES(0, 10)) AS i) a
          CROSS JOIN (SELECT UNNEST(GENERATE_SERIES(0, 10)) AS j) b"""},
    ),
    "ensemble_predict": Query(
        lambda r: E.ensemble_predict(simple_members(r), (0.5, 0.3, 0.2), list(SIMPLE)),
        f"{ID} predicted~6",
        "SELECT *, 0.5 * p1 + 0.3 * p2 + 0.2 * p3 AS predicted FROM simple", {"simple": SIMPLE_SQL},
    ),
    # ---- models ----
    "prepare_matrix": Query(_prepared),
    "fit_member_1": Query(_member("gbt")),
    "fit_member_2": Query(_member("forest")),
    "fit_member_3": Query(_member("linear")),
    "search_params": Query(_search("linear")),
    "search_member_1": Query(_search("gbt")),
    "search_member_2": Query(_search("forest")),
    "search_halving": Query(_search("linear", trials=4, halving=2)),
    "model_store": Query(_stored),
    "feature_importance": Query(lambda r: model(r).importance(r.spark)),
    "score_rows": Query(_score_test),
    "score_csv": Query(_scored_csv),
    "linear_matrix": Query(
        lambda r: linear.prepared(simple_members(r), LINEAR, "net_sales", keep=LINE_ID), f"{ID} p1~6 p2~6 p3~6 label~6",
        "SELECT *, CASE WHEN net_sales > -1 THEN LN(1 + net_sales) END AS label FROM simple", {"simple": SIMPLE_SQL},
    ),
    "linear_fit": Query(
        lambda r: _linear_model(r)[0].table(r.spark), "feature coefficient~6", COEFFICIENTS_SQL, _linear_tables()
    ),
    "linear_path": Query(
        _linear_path, "ridge~3 rmse~6",
        "SELECT ridge, SQRT(AVG(POWER(label - raw, 2))) AS rmse FROM raw_forecasts WHERE known AND label IS NOT NULL GROUP BY ridge",
        _linear_tables("(SELECT MAX(sale_date) FROM labelled WHERE known) - 30", RIDGES),
    ),
    "linear_scores": Query(_linear_scores, f"{ID} forecast~6", LINEAR_SQL, _linear_tables()),
    "linear_score_csv": Query(_linear_csv, f"{ID} forecast~6", LINEAR_SQL, _linear_tables()),
    "forecast_future": Query(
        lambda r: jobs.forecast_future(model(r), r.loaded, r.holidays, r.promotions, 7)
    ),
    "state_features": Query(_state_features, STATE_COLUMNS, STATE_SQL, _state_tables()),
    "batch_score": Query(
        lambda r: jobs.batch_score(lean(r), cases(r), r.loaded, r.holidays, r.promotions)
    ),
    "batch_features": Query(
        lambda r: jobs.case_features(cases(r), r.loaded, r.holidays, r.promotions),
        "case_id sku store_id sale_date@ price lag_1~6 lag_7~6 ma_7~6 ma_30~6 sku_mean~6 "
        "rolling_count_30 rolling_median_7~6 days_since_start price_dev_sku~4",
        """SELECT c.sku || '|' || c.store_id AS case_id, c.sku, c.store_id, c.sale_date, c.price,
          COALESCE(h.last, h.med) AS lag_1, COALESCE(h.seventh, h.med) AS lag_7, h.ma_7, h.ma_30,
          h.mean AS sku_mean, COALESCE(h.n30, 0) AS rolling_count_30, h.med_7 AS rolling_median_7,
          COALESCE(c.sale_date - h.first_date, 0) AS days_since_start,
          c.price - (COALESCE(h.prices, 0) + c.price) / (COALESCE(h.n, 0) + 1) AS price_dev_sku
          FROM cases c LEFT JOIN (SELECT sku, store_id, MEDIAN(net_sales) AS med, AVG(net_sales) AS mean,
            SUM(price) AS prices, COUNT(*) AS n, MIN(sale_date) AS first_date,
            MAX(CASE WHEN rn = 1 THEN net_sales END) AS last,
            MAX(CASE WHEN rn = 7 THEN net_sales END) AS seventh,
            AVG(CASE WHEN rn <= 7 THEN net_sales END) AS ma_7,
            MEDIAN(CASE WHEN rn <= 7 THEN net_sales END) AS med_7,
            AVG(CASE WHEN rn <= 30 THEN net_sales END) AS ma_30,
            COUNT(CASE WHEN rn <= 30 THEN net_sales END) AS n30 FROM past GROUP BY sku, store_id) h
          ON h.sku = c.sku AND h.store_id = c.store_id""",
        {
            "cases": CASES_SQL,
            "past": """SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l.sku, l.store_id ORDER BY l.sale_date DESC,
              receipt_id DESC, line_part DESC, line_supp DESC, line_no DESC, quantity DESC, base_price DESC) AS rn
              FROM cases c JOIN loaded l ON l.sku = c.sku AND l.store_id = c.store_id
              AND l.sale_date < c.sale_date AND l.sale_date >= c.sale_date - 90""",
        },
    ),
    # ---- events ----
    "changes_only": Query(
        lambda r: _dated(messages.changes_only(events(r))), CHANGES, CHANGES_SQL
    ),
    "changes_only_stream": Query(lambda r: _changes_stream(r, timedelta(days=20_000)), CHANGES, CHANGES_SQL),
    "changes_with_expiry": Query(
        lambda r: _dated(messages.changes_only(events(r), expiry=IDLE)), CHANGES, EXPIRY_SQL
    ),
    "changes_with_expiry_stream": Query(lambda r: _changes_stream(r, IDLE), CHANGES, EXPIRY_SQL),
    "json_messages": Query(lambda r: _messages(r.table("events")), "event_id text", MESSAGES_SQL),
    "json_messages_stream": Query(
        lambda r: _streamed(r, _messages, "messages"), "event_id text", MESSAGES_SQL
    ),
}
