"""

Reads the joined sales table as written by Spark, then times the usual pandas ways:
per-group rolling, per-row Python callbacks where pandas has no built-in.
"""

import json
import sys
import time

import numpy as np
import pandas as pd

GROUP = ["sku", "store_id"]


def timed(spent: dict, name: str, work):
    start = time.time()
    work()
    spent[name] = round(time.time() - start, 2)


def main(path: str) -> None:
    df = pd.read_parquet(path)
    df["sale_date"] = pd.to_datetime(df["sale_date"])
    df = df.sort_values([*GROUP, "sale_date", "receipt_id"]).reset_index(drop=True)
    y = df.groupby(GROUP)["net_sales"]
    holidays = [
        pd.Timestamp(year, month, day) for year in range(1995, 2002)
        for month, day in ((1, 1), (2, 23), (5, 9), (1, 7), (8, 28), (12, 31))
    ]
    spent: dict[str, float] = {}

    def rolling():
        for n in (3, 7, 14, 30, 90):
            for stat in ("mean", "median", "max", "min", "std"):
                y.transform(lambda x, n=n, stat=stat: getattr(x.rolling(n, min_periods=1), stat)())

    def lags():
        for n in (1, 2, 3, 7, 14, 21, 30, 60, 90):
            y.shift(n).fillna(df.groupby("sku")["net_sales"].transform("median"))

    def nearest():
        for day in df["sale_date"]:
            min([(h - day).days for h in holidays if h >= day] + [999])

    def slope():
        fit = lambda v: np.polyfit(np.arange(len(v)), v, 1)[0]
        y.transform(lambda x: x.rolling(7, min_periods=3).apply(fit, raw=True))

    def promos():
        by_day = df.set_index("sale_date").groupby(GROUP)["promo_id"]
        by_day.transform(lambda s: s.rolling("30D").apply(lambda v: len(np.unique(v)), raw=True))

    timed(spent, "lags", lags)
    timed(spent, "rolling_stats", rolling)
    timed(spent, "holiday_distance (one direction)", nearest)
    timed(spent, "trend_slope", slope)
    timed(spent, "distinct_promos_30d", promos)
    timed(spent, "price_dev_store_day", lambda: df.groupby(["store_id", "sale_date"])["price"].transform("mean"))
    print(json.dumps(spent))


if __name__ == "__main__":
    main(sys.argv[1])
