"""How a registered query is described: the Spark side, its columns, the equal SQL.

Columns are written once and used for both sides: ``x`` as it is, ``x~4`` rounded
to 4 decimals, ``x@`` a date as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.fixture import HOLIDAYS_SQL, PROMOTIONS_SQL, Retail

ID = "receipt_id line_part line_supp line_no sku store_id sale_date@ quantity"
ORD = "sale_date, receipt_id, line_part, line_supp, line_no, quantity, base_price"
W = f"PARTITION BY sku, store_id ORDER BY {ORD}"

SALES_SQL = """SELECT l.l_orderkey AS receipt_id, l.l_partkey AS line_part,
  l.l_suppkey AS line_supp, l.l_linenumber AS line_no, p.p_brand AS sku,
  CONCAT('S', CAST(s.s_nationkey AS VARCHAR(8))) AS store_id,
  CAST(l.l_shipdate AS DATE) AS sale_date, l.l_quantity AS quantity,
  FLOOR(l.l_extendedprice * 100 + 0.5) AS base_price,
  CASE WHEN (l.l_orderkey + l.l_partkey) % 50 = 0 THEN -FLOOR(l.l_extendedprice * 10 + 0.5)
       ELSE FLOOR(l.l_extendedprice * 100 * (1 - l.l_discount) + 0.5) END AS price,
  CASE WHEN l.l_discount >= 0.045 THEN CAST(FLOOR(l.l_discount * 100 + 0.5) AS INT) ELSE 0 END AS promo_id,
  CASE WHEN l.l_tax >= 0.055 THEN 'CODE' ELSE NULL END AS promo_code,
  CASE WHEN o.o_custkey % 4 = 0 THEN '  ' ELSE CAST(o.o_custkey AS VARCHAR(20)) END AS customer_card,
  CAST(ASCII(SUBSTRING(p.p_brand, LENGTH(p.p_brand), 1)) % 2 AS INT) AS weighed
FROM lineitem l
JOIN part p ON p.p_partkey = l.l_partkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey"""

RETURNS_SQL = """SELECT l.l_orderkey + CASE WHEN l.l_partkey % 20 = 0 THEN 1000000000 ELSE 0 END AS receipt_id,
  p.p_brand AS sku, CONCAT('S', CAST(s.s_nationkey AS VARCHAR(8))) AS store_id,
  CAST(CAST(l.l_shipdate AS DATE) + INTERVAL 7 DAY AS DATE) AS return_date,
  CAST(FLOOR(l.l_quantity / 2) AS DOUBLE) AS returned_qty
FROM lineitem l
JOIN part p ON p.p_partkey = l.l_partkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE l.l_returnflag = 'R'"""

LOADED_SQL = """SELECT s.receipt_id, s.line_part, s.line_supp, s.line_no, s.sku, s.store_id, s.sale_date,
  s.quantity, s.base_price, s.price, s.promo_id, s.weighed,
  CASE WHEN s.promo_code IS NOT NULL THEN 1 ELSE 0 END AS promo_code_used,
  COALESCE(TRY_CAST(TRIM(s.customer_card) AS BIGINT), 0) AS customer_card,
  COALESCE(r.returned_qty, 0) AS returned_qty,
  s.quantity - COALESCE(r.returned_qty, 0) AS net_sales,
  SUM(s.price) OVER (PARTITION BY s.receipt_id) AS receipt_total,
  ABS(COALESCE(SUM(CASE WHEN s.price < 0 THEN s.price END) OVER (PARTITION BY s.receipt_id), 0)) AS certificate_total,
  CASE WHEN h.holiday_name IS NOT NULL THEN 1 ELSE 0 END AS is_holiday,
  COALESCE(h.holiday_type, 'none') AS holiday_type, COALESCE(h.day_off, 0) AS day_off,
  CASE WHEN s.promo_id <> 0 AND s.sale_date BETWEEN p.start_date AND p.end_date THEN 1 ELSE 0 END AS promo_active,
  COALESCE(p.promo_type, 'none') AS promo_type, COALESCE(p.discount_pct, 0) AS discount_pct,
  COALESCE(p.is_clearance, 0) AS is_clearance
FROM sales s
LEFT JOIN returns_sum r ON r.receipt_id = s.receipt_id AND r.sku = s.sku AND r.store_id = s.store_id
LEFT JOIN holidays h ON h.holiday_date = s.sale_date
LEFT JOIN promos p ON p.promo_id = s.promo_id"""

TABLES = {
    "sales": SALES_SQL,
    "returns": RETURNS_SQL,
    "promotions": PROMOTIONS_SQL,
    "holidays": HOLIDAYS_SQL,
    "returns_sum": """SELECT receipt_id, sku, store_id, SUM(returned_qty) AS returned_qty FROM returns
  WHERE receipt_id IN (SELECT receipt_id FROM sales) GROUP BY receipt_id, sku, store_id""",
    "promos": """SELECT promo_id, promo_type,
  CASE WHEN LOWER(TRIM(is_clearance)) IN ('да', 'true') THEN 1 ELSE 0 END AS is_clearance,
  discount_pct, start_date, end_date FROM promotions""",
    "loaded": LOADED_SQL,
    "scored": f"""SELECT *, COALESCE(AVG(net_sales) OVER (
  {W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS predicted FROM loaded""",
    "near_holidays": """SELECT d.sale_date,
  LEAST(999, COALESCE(MIN(CASE WHEN h.holiday_date >= d.sale_date THEN h.holiday_date - d.sale_date END), 999)) AS days_to_holiday,
  LEAST(999, COALESCE(MIN(CASE WHEN h.holiday_date <= d.sale_date THEN d.sale_date - h.holiday_date END), 999)) AS days_since_holiday
FROM (SELECT DISTINCT sale_date FROM sales) d CROSS JOIN holidays h GROUP BY d.sale_date""",
}


def _spark_column(spec: str):
    if spec.endswith("@"):
        return F.date_format(spec[:-1], "yyyy-MM-dd").alias(spec[:-1])
    if "~" in spec:
        name, digits = spec.split("~")
        return (F.round(F.col(name).cast("double"), int(digits)) + F.lit(0.0)).alias(name)
    return F.col(spec)


def _sql_column(spec: str) -> str:
    if spec.endswith("@"):
        return f"STRFTIME({spec[:-1]}, '%Y-%m-%d') AS {spec[:-1]}"
    if "~" in spec:
        name, digits = spec.split("~")
        return f"ROUND(CAST({name} AS DOUBLE), {digits}) + 0.0 AS {name}"
    return spec


@dataclass
class Query:
    build: Callable[[Retail], DataFrame]
    columns: str = ""
    sql: str | None = None
    # Extra named subqueries in front of ``sql``.
    tables: dict[str, str] | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Retail(spark, folder))
        return df.select(*map(_spark_column, self.columns.split())) if self.columns else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        named = ",\n".join(f"{n} AS ({q})" for n, q in {**TABLES, **(self.tables or {})}.items())
        columns = ", ".join(map(_sql_column, self.columns.split())) or "*"
        return f"WITH {named}\nSELECT {columns} FROM ({self.sql}) result"
