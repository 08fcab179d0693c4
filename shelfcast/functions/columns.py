"""Column expressions: cleaning, discounts, calendar parts, transforms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words for yes and no in flag columns (compared in lower case).
YES_WORDS = ["да", "true"]
NO_WORDS = ["нет", "false", "-", ""]


def ratio(top: Column, bottom: Column, fill: float) -> Column:
    """top / bottom, with ``fill`` where the result is missing or the divisor is 0."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(float(fill)))


def clean_flag(c: Column) -> Column:
    """Yes/no text to 1/0; a number is 1 unless it is 0, anything else is 0."""
    word = F.lower(F.trim(c.cast("string")))
    number = F.coalesce(word.try_cast("double"), F.lit(0.0))
    return (
        F.when(word.isin(YES_WORDS), 1)
        .when(word.isNull() | word.isin(NO_WORDS), 0)
        .otherwise((~F.isnan(number) & (number != 0)).cast("int"))
    )


def clean_card(c: Column) -> Column:
    """Card number; blank or unreadable text gives 0."""
    return F.coalesce(F.trim(c.cast("string")).try_cast("double").try_cast("bigint"), F.lit(0))


def day_first_date(c: Column) -> Column:
    """Dates written as dd.MM.yyyy or yyyy-MM-dd; other text gives NULL."""
    return F.coalesce(F.try_to_date(c, "dd.MM.yyyy"), F.try_to_date(c, "yyyy-MM-dd"))


def present(c: Column) -> Column:
    return c.isNotNull().cast("int")


def real_discount(price: Column, base: Column) -> Column:
    share = 1 - ratio(price, base, 1.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def not_negative(c: Column) -> Column:
    """NULL stays NULL (``greatest`` would skip it)."""
    return F.when(c < 0, 0.0).otherwise(c)


def between_flag(c: Column, low, high) -> Column:
    return F.coalesce(c.between(low, high).cast("int"), F.lit(0))


def calendar_parts(date: Column) -> dict[str, Column]:
    weekday = F.weekday(date)
    return {
        "weekday": weekday,
        "month": F.month(date),
        "year": F.year(date),
        "is_weekend": (weekday >= 5).cast("int"),
        "day_of_year": F.dayofyear(date),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
        "day_of_month": F.dayofmonth(date),
    }


def cyclic(position: Column, period: int) -> tuple[Column, Column]:
    angle = position * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def cyclic_parts(date: Column) -> dict[str, Column]:
    parts = {
        "day": (F.dayofyear(date), 365),
        "week": (F.weekday(date), 7),
        "month": (F.month(date), 12),
    }
    out = {}
    for name, (position, period) in parts.items():
        out[f"sin_{name}"], out[f"cos_{name}"] = cyclic(position, period)
    return out


def month_edges(date: Column) -> dict[str, Column]:
    day = F.dayofmonth(date)
    return {
        "month_start": (day <= 5).cast("int"),
        "month_end": (day >= 25).cast("int"),
        "payday": (day.between(14, 16) | (day >= 29) | (day <= 1)).cast("int"),
    }


def sale_season(date: Column) -> Column:
    return F.month(date).isin(11, 12).cast("int")


def log_target(c: Column) -> Column:
    return F.log1p(not_negative(c))


def forecast_value(predicted: Column, weighed: Column) -> Column:
    """Forecasts are never negative; unit goods are rounded, halves to even."""
    clipped = not_negative(predicted)
    return F.when(weighed == 0, F.bround(clipped, 0)).otherwise(clipped)


def finite(c: Column) -> Column:
    """NULL instead of NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
