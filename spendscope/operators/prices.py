"""Effective price table (contract prices override list prices)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRICE_COLUMNS = ["cloud", "sku_name", "price_start_time", "price_end_time", "price_usd"]
PRICE_KEY = ["cloud", "sku_name", "price_start_time"]


def effective_prices(account_prices: DataFrame, list_prices: DataFrame) -> DataFrame:
    """All contract rows, plus the list rows that have no contract row for
    the same (cloud, sku_name, price_start_time).

    ``NOT EXISTS`` on equality keys is a left anti join (a list row with a
    NULL key is kept, as NOT EXISTS keeps it).  Both inputs are price lists
    (one row per SKU and price change), so the anti join's right side is
    broadcast by the planner on its own statistics.
    """
    acct = account_prices.select(*PRICE_COLUMNS)
    lst = list_prices.select(*PRICE_COLUMNS)
    fallback = lst.join(acct.select(*PRICE_KEY), PRICE_KEY, "left_anti")
    return acct.unionByName(fallback)


def overlapping_prices(prices: DataFrame) -> DataFrame:
    """Pairs of effective price rows of one (cloud, sku) whose validity
    intervals overlap; every such pair double-counts usage in the hourly
    cost (a list and a contract price with different start times both
    survive the override rule).

    Price lists are tiny, but the self join is still written as an
    interval join on the SKU key with a range residual, never as an
    all-pairs product.
    """
    a = prices.alias("a")
    b = prices.alias("b")
    far_future = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    cond = (
        (F.col("a.cloud") == F.col("b.cloud"))
        & (F.col("a.sku_name") == F.col("b.sku_name"))
        & (F.col("a.price_start_time") < F.col("b.price_start_time"))
        & (F.col("b.price_start_time") < F.coalesce(F.col("a.price_end_time"), far_future))
    )
    return a.join(b, cond, "inner").select(
        F.col("a.cloud").alias("cloud"),
        F.col("a.sku_name").alias("sku_name"),
        F.col("a.price_start_time").alias("first_start_time"),
        F.col("a.price_end_time").alias("first_end_time"),
        F.col("b.price_start_time").alias("second_start_time"),
        F.col("b.price_end_time").alias("second_end_time"),
    )
