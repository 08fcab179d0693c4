"""Retail input tables derived from the star-schema test tables.

Money is in whole minor units, so that sums do not depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.schema import GROUP, ORDER
from shelfcast.settings import settle
from shelfcast.sources.load import load

PROMOTION_ROWS = [
    "(5, 'discount', 'Нет', CAST(5 AS DOUBLE), DATE '1995-01-01', DATE '1997-12-31')",
    "(6, 'discount', 'нет', CAST(6 AS DOUBLE), DATE '1996-06-01', DATE '1999-06-30')",
    "(7, 'bundle', 'false', CAST(7 AS DOUBLE), DATE '1995-01-01', DATE '2001-12-31')",
    "(8, 'bundle', '-', CAST(NULL AS DOUBLE), DATE '1998-01-01', DATE '2000-12-31')",
    "(9, 'clearance', 'Да', CAST(9 AS DOUBLE), DATE '1995-01-01', DATE '2001-12-31')",
    "(10, 'clearance', 'TRUE', CAST(10 AS DOUBLE), DATE '1999-01-01', DATE '1999-12-31')",
]
PROMOTIONS_SQL = (
    "SELECT * FROM (VALUES " + ", ".join(PROMOTION_ROWS) + ") "
    "AS t(promo_id, promo_type, is_clearance, discount_pct, start_date, end_date)"
)
HOLIDAYS_SQL = """SELECT MAKE_DATE(y.y, h.m, h.d) AS holiday_date, h.name AS holiday_name,
  h.kind AS holiday_type, h.off AS day_off
FROM (VALUES (1995),(1996),(1997),(1998),(1999),(2000),(2001)) AS y(y)
CROSS JOIN (VALUES (1, 1, 'new_year', 'state', 1), (2, 23, 'defender', 'state', 1),
  (5, 9, 'victory', 'state', 1), (1, 7, 'christmas', 'religious', 1),
  (8, 28, 'assumption', 'religious', 0), (12, 31, 'eve', 'family', 0))
  AS h(m, d, name, kind, off)"""
# Columns of the test tables used here; stating them saves a look at every file.
RAW = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}
HOLIDAY_TYPES = ["family", "religious", "state"]


@dataclass
class Retail:
    """The retail tables over one folder of test tables."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.folder}/{name}.parquet")

    def _lines(self) -> DataFrame:
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        supplier = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
        )
        return (
            self.table("lineitem").join(part, "l_partkey").join(supplier, "l_suppkey")
            .withColumns(
                {
                    "sku": F.col("p_brand"),
                    "store_id": F.concat(F.lit("S"), F.col("s_nationkey").cast("string")),
                    "sale_date": F.col("l_shipdate").cast("date"),
                }
            )
        )

    @cached_property
    def sales(self) -> DataFrame:
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        whole = lambda c: F.floor(c + 0.5).cast("double")
        cents = whole(F.col("l_extendedprice") * 100)
        tenth = -whole(F.col("l_extendedprice") * 10)
        discounted = whole(F.col("l_extendedprice") * 100 * (1 - F.col("l_discount")))
        return self._lines().join(orders, "l_orderkey", "left").select(
            F.col("l_orderkey").alias("receipt_id"),
            F.col("l_partkey").alias("line_part"),
            F.col("l_suppkey").alias("line_supp"),
            F.col("l_linenumber").alias("line_no"),
            "sku", "store_id", "sale_date",
            F.col("l_quantity").alias("quantity"),
            cents.alias("base_price"),
            F.when((F.col("l_orderkey") + F.col("l_partkey")) % 50 == 0, tenth)
            .otherwise(discounted).alias("price"),
            F.when(F.col("l_discount") >= 0.045, whole(F.col("l_discount") * 100).cast("int"))
            .otherwise(0).alias("promo_id"),
            F.when(F.col("l_tax") >= 0.055, F.lit("CODE")).alias("promo_code"),
            F.when(F.col("o_custkey") % 4 == 0, F.lit("  "))
            .otherwise(F.col("o_custkey").cast("string")).alias("customer_card"),
            (F.ascii(F.substring("p_brand", -1, 1)) % 2).cast("int").alias("weighed"),
        )

    @cached_property
    def returns(self) -> DataFrame:
        moved = F.when(F.col("l_partkey") % 20 == 0, 1_000_000_000).otherwise(0)
        return self._lines().where(F.col("l_returnflag") == "R").select(
            (F.col("l_orderkey") + moved).alias("receipt_id"),
            "sku", "store_id",
            F.date_add("sale_date", 7).alias("return_date"),
            F.floor(F.col("l_quantity") / 2).cast("double").alias("returned_qty"),
        )

    @cached_property
    def promotions_text(self) -> DataFrame:
        return self.spark.sql(PROMOTIONS_SQL)

    @cached_property
    def promotions(self) -> DataFrame:
        from shelfcast.functions.columns import clean_flag

        return self.promotions_text.withColumn("is_clearance", clean_flag(F.col("is_clearance")))

    @cached_property
    def holidays(self) -> DataFrame:
        return self.spark.sql(HOLIDAYS_SQL)

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").groupBy(F.col("p_brand").alias("sku")).agg(
            F.min("p_type").alias("product_type"),
            F.max("p_size").alias("product_size"),
            F.count(F.lit(1)).alias("product_parts"),
        )

    @cached_property
    def loaded(self) -> DataFrame:
        return load(self.sales, self.returns, self.promotions, self.holidays, in_place=True)

    def lines(self, *columns: str) -> DataFrame:
        """``loaded`` with only what places a line and the named columns, written once for several readers."""
        return settle(self.loaded.select(*dict.fromkeys([*ORDER, *GROUP, *columns])), "lines")
