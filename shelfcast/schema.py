"""Input schemas and the row order used by every ordered window."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


SALES = _struct(
    receipt_id=LongType, line_part=LongType, line_supp=LongType, line_no=IntegerType,
    sku=StringType, store_id=StringType, sale_date=DateType, quantity=DoubleType,
    base_price=DoubleType, price=DoubleType, promo_id=IntegerType, promo_code=StringType,
    customer_card=StringType, weighed=IntegerType,
)
RETURNS = _struct(
    receipt_id=LongType, sku=StringType, store_id=StringType, return_date=DateType,
    returned_qty=DoubleType,
)
# Promotion dates arrive as day-first or ISO text.
PROMOTIONS_TEXT = _struct(
    promo_id=IntegerType, promo_type=StringType, is_clearance=StringType,
    discount_pct=DoubleType, start_date=StringType, end_date=StringType,
)
HOLIDAYS = _struct(
    holiday_date=DateType, holiday_name=StringType, holiday_type=StringType, day_off=IntegerType
)

# Total order of sales lines inside any group. Features such as lags count rows in
# this order, so it must be unique; receipts and lines identify a row.
ORDER = ["sale_date", "receipt_id", "line_part", "line_supp", "line_no", "quantity", "base_price"]
GROUP = ["sku", "store_id"]
NO_PROMO = "none"
NO_HOLIDAY = "none"
