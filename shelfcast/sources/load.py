"""Reading the input tables and joining them into one wide sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast import schema as S
from shelfcast.functions.columns import (
    clean_card,
    clean_flag,
    day_first_date,
    present,
)

RETURN_KEY = ["receipt_id", "sku", "store_id"]


# ---- files -------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, schema, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_promotions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return parse_promotions(read_table(spark, path, S.PROMOTIONS_TEXT, fmt))


def parse_promotions(raw: DataFrame) -> DataFrame:
    """Promotion rows with text dates and a text clearance flag to typed columns."""
    return raw.withColumns(
        {
            "is_clearance": clean_flag(F.col("is_clearance")),
            "start_date": day_first_date(F.col("start_date")),
            "end_date": day_first_date(F.col("end_date")),
        }
    )


def row_cap(sales: DataFrame, rows: int = 100_000) -> DataFrame:
    """The first ``rows`` rows; a switch for trial runs, off unless called."""
    return sales.orderBy(*S.ORDER).limit(rows)


# ---- returns and receipts ----------------------------------------------------

def matched_returns(returns: DataFrame, sales: DataFrame) -> DataFrame:
    """Returns whose receipt exists among the sales."""
    return returns.join(sales.select("receipt_id").distinct(), "receipt_id", "left_semi")


def sum_returns(returns: DataFrame) -> DataFrame:
    return returns.groupBy(*RETURN_KEY).agg(F.sum("returned_qty").alias("returned_qty"))


def _receipt_keys(spread: Sequence[str]) -> list[Column]:
    """What one receipt's rows share. Rows without a receipt belong together nowhere, so they are spread."""
    return [F.col("receipt_id"), F.when(F.col("receipt_id").isNull(), F.xxhash64(*spread)).alias("_spread")]


def _returned(keys: list[Column]) -> Column:
    """The returned quantity of the row's receipt, SKU and store; rows without one of these have none."""
    known = F.col("receipt_id").isNotNull() & F.col("sku").isNotNull() & F.col("store_id").isNotNull()
    line = Window.partitionBy(*keys, "sku", "store_id")
    return F.when(known, F.coalesce(F.sum("_returned").over(line), F.lit(0.0))).otherwise(0.0)


def _with_returns(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Sales lines and returns below each other, so that one shuffle by receipt brings them together."""
    kinds = {f.name: f.dataType for f in sales.schema}
    back = returns.where(F.col("receipt_id").isNotNull()).select(*RETURN_KEY, F.col("returned_qty").alias("_returned"))
    both = sales.withColumns({"_returned": F.lit(None).cast("double"), "_sale": F.lit(True)}).unionByName(
        back.withColumn("_sale", F.lit(False)), allowMissingColumns=True
    )
    return both.withColumns({c: F.col(c).cast(kinds[c]) for c in RETURN_KEY})


def join_returns(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Add the returned and the net quantity.

    No separate filter on existing receipts: a return without a sale meets no row of
    the sales. Rows are sent to their receipt once.
    """
    keys = _receipt_keys(["sku", "store_id"])
    rows = _with_returns(sales, returns).repartition(*keys)
    rows = rows.withColumn("returned_qty", _returned(keys)).where("_sale")
    return _net(rows, sales)


def _net(rows: DataFrame, sales: DataFrame, *more: str) -> DataFrame:
    others = [c for c in sales.columns if c not in RETURN_KEY]
    net = (F.col("quantity") - F.col("returned_qty")).alias("net_sales")
    return rows.select(*RETURN_KEY, *others, "returned_qty", net, *more)


def _totals(keys: list[Column]) -> dict[str, Column]:
    price = F.col("price")
    receipt = Window.partitionBy(*keys)
    known = F.col("receipt_id").isNotNull()
    given = F.coalesce(F.sum(F.when(price < 0, price)).over(receipt), F.lit(0.0))
    return {
        "receipt_total": F.when(known, F.sum(price).over(receipt)),
        "certificate_total": F.when(known, F.abs(given)).otherwise(0.0),
    }


def add_receipt_totals(sales: DataFrame) -> DataFrame:
    """Receipt sum, and the certificate amount (negative prices) of the receipt.

    There are about as many receipts as rows, so rows are sent to their receipt.
    """
    keys = _receipt_keys(["price"])
    rows = sales.withColumns(_totals(keys))
    return rows.select("receipt_id", *[c for c in rows.columns if c != "receipt_id"])


def join_receipts(sales: DataFrame, returns: DataFrame, in_place: bool = False) -> DataFrame:
    """``join_returns`` and ``add_receipt_totals`` from one shuffle by receipt.

    ``in_place`` is for sales that come from a join by receipt. Where that join shuffles them, they stay as
    they lie, and only the returns are sent to them. Lines without a receipt have neither totals nor
    returns, so they are read apart and not moved.
    """
    if in_place:
        return _join_in_place(sales, returns)
    keys = _receipt_keys(["sku", "store_id"])
    rows = _with_returns(sales, returns).repartition(*keys)
    rows = rows.withColumn("returned_qty", _returned(keys)).withColumns(_totals(keys))
    return _net(rows.where("_sale"), sales, "receipt_total", "certificate_total")


def _join_in_place(sales: DataFrame, returns: DataFrame) -> DataFrame:
    sale, keys = F.col("receipt_id").isNotNull(), [F.col("receipt_id")]
    kinds = {f.name: f.dataType for f in sales.schema}
    lines = sales.where(sale).withColumns({"_returned": F.lit(None).cast("double"), "_sale": F.lit(True)})
    back = returns.select(*[F.col(c).cast(kinds[c]).alias(c) for c in RETURN_KEY], F.col("returned_qty").alias("_returned"))
    back = back.where(sale).withColumn("_sale", F.lit(False))
    # Spark leaves a repartition out where the rows lie so already, and knows that both sides of the union do.
    rows = lines.repartition(*keys).unionByName(back.repartition(*keys), allowMissingColumns=True)
    rows = rows.withColumn("returned_qty", _returned(keys)).withColumns(_totals(keys))
    rows = _net(rows.where("_sale"), sales, "receipt_total", "certificate_total")
    total = F.lit(None).cast(rows.schema["receipt_total"].dataType)
    loose = sales.where(~sale).withColumns(
        {"returned_qty": F.lit(0.0), "receipt_total": total, "certificate_total": F.lit(0.0)}
    )
    return rows.unionByName(_net(loose, sales, "receipt_total", "certificate_total"))


# ---- dimensions --------------------------------------------------------------
#
# Read from files, so Spark knows their size and broadcasts them when they are small
# (spark.sql.autoBroadcastJoinThreshold); no hint is given.

def unique_holidays(holidays: DataFrame) -> DataFrame:
    """One row per date: the holiday whose name sorts first."""
    pick = F.min(F.struct("holiday_name", "holiday_type", "day_off"))
    return holidays.groupBy(F.col("holiday_date").alias("sale_date")).agg(pick.alias("h")).select(
        "sale_date", "h.holiday_name", "h.holiday_type", "h.day_off"
    )


def join_holidays(sales: DataFrame, holidays: DataFrame) -> DataFrame:
    joined = sales.join(unique_holidays(holidays), "sale_date", "left")
    return joined.select(
        *sales.columns,
        present(F.col("holiday_name")).alias("is_holiday"),
        F.coalesce("holiday_type", F.lit(S.NO_HOLIDAY)).alias("holiday_type"),
        F.coalesce("day_off", F.lit(0)).alias("day_off"),
    )


def unique_promotions(promotions: DataFrame) -> DataFrame:
    """One row per promotion; of repeated ids the one that starts last is kept."""
    latest = F.max(
        F.struct("start_date", "end_date", "promo_type", "is_clearance", "discount_pct")
    )
    return promotions.groupBy("promo_id").agg(latest.alias("p")).select("promo_id", "p.*")


def active_promo(promo_id: Column, date: Column, start: Column, end: Column) -> Column:
    return F.coalesce(((promo_id != 0) & date.between(start, end)).cast("int"), F.lit(0))


def join_promotions(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Add promotion type, discount, clearance flag and whether it runs on the sale date."""
    joined = sales.join(unique_promotions(promotions), "promo_id", "left")
    return joined.select(
        *sales.columns,
        active_promo(
            F.col("promo_id"), F.col("sale_date"), F.col("start_date"), F.col("end_date")
        ).alias("promo_active"),
        F.coalesce("promo_type", F.lit(S.NO_PROMO)).alias("promo_type"),
        F.coalesce("discount_pct", F.lit(0.0)).alias("discount_pct"),
        F.coalesce("is_clearance", F.lit(0)).alias("is_clearance"),
    )


def join_products(sales: DataFrame, products: DataFrame | None) -> DataFrame:
    """Add product attributes; the product table may be absent."""
    if products is None:
        return sales
    return sales.join(products.dropDuplicates(["sku"]), "sku", "left")


def clean_sales(sales: DataFrame) -> DataFrame:
    """Flags and numbers of the sales line itself; optional columns may be absent."""
    has = set(sales.columns)
    code = present(F.col("promo_code")) if "promo_code" in has else F.lit(0)
    weighed = F.coalesce(F.col("weighed").cast("int"), F.lit(0)) if "weighed" in has else F.lit(0)
    card = clean_card(F.col("customer_card")) if "customer_card" in has else F.lit(0).cast("bigint")
    return sales.withColumns(
        {"promo_code_used": code, "weighed": weighed, "customer_card": card}
    ).drop("promo_code")


# ---- the whole load ----------------------------------------------------------

def load(
    sales: DataFrame,
    returns: DataFrame,
    promotions: DataFrame,
    holidays: DataFrame,
    products: DataFrame | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Wide sales table. ``promotions`` must be typed (see ``parse_promotions``); ``in_place``: see ``join_receipts``."""
    wide = clean_sales(sales.withColumn("sku", F.col("sku").cast("string")))
    wide = join_receipts(wide, returns, in_place)
    wide = join_holidays(wide, holidays)
    wide = join_promotions(wide, promotions)
    return join_products(wide, products)
