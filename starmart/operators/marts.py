"""Star-schema builders (M1-M5) over ``stg_transactions``."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession

from starmart.constants import CALENDAR_END, CALENDAR_START
from starmart.functions import (
    calendar_columns,
    card_brand,
    card_masked,
    covering_bounds,
    customer_age,
    date_key,
    date_spine,
    full_name,
    merchant_clean,
    spine_from_bounds,
    surrogate_key,
)
from starmart.operators.dedupe import dedupe_first

#: Natural keys of the dimensions, in hashing order.
CUSTOMER_NK = ("first_name", "last_name", "date_of_birth", "street", "city", "state",
               "postal_code")
ACCOUNT_NK = ("card_number",)
MERCHANT_NK = ("merchant_name", "merchant_category")
_ORDER = ("transaction_ts", "transaction_id")


def dim_customer(stg: DataFrame, as_of: str | dt.date | Column | None = None) -> DataFrame:
    """One row per person (natural key of 7 columns); attributes of the
    person's earliest transaction.  ``age`` counts year boundaries to
    ``as_of`` (default today)."""
    cols = [*CUSTOMER_NK, "gender", "home_lat", "home_long", "city_population", "job"]
    first = dedupe_first(stg.select(*cols, *_ORDER), CUSTOMER_NK)
    return first.select(
        surrogate_key(*CUSTOMER_NK).alias("customer_key"),
        "first_name",
        "last_name",
        full_name("first_name", "last_name").alias("full_name"),
        "gender",
        "date_of_birth",
        customer_age("date_of_birth", as_of).alias("age"),
        "street", "city", "state", "postal_code",
        "home_lat", "home_long", "city_population", "job",
    )


def dim_account(stg: DataFrame) -> DataFrame:
    """One row per card: key, number, masked number, brand.

    Every column is a function of the card number, so "the earliest row per
    card" is just the distinct card numbers: a partial+final hash aggregate
    (no sort, no timestamp parsing), hot cards collapsing map-side.
    """
    first = stg.select(*ACCOUNT_NK).distinct()
    return first.select(
        surrogate_key(*ACCOUNT_NK).alias("account_key"),
        "card_number",
        card_masked("card_number").alias("card_masked"),
        card_brand("card_number").alias("card_brand"),
    )


def dim_merchant(stg: DataFrame) -> DataFrame:
    """One row per (merchant, category) pair, plus the display name.

    All columns derive from the pair, so distinct pairs equal the earliest
    row per pair (hash aggregate, no sort).
    """
    first = stg.select(*MERCHANT_NK).distinct()
    return first.select(
        surrogate_key(*MERCHANT_NK).alias("merchant_key"),
        "merchant_name",
        "merchant_category",
        merchant_clean("merchant_name").alias("merchant_name_clean"),
    )


def dim_date(
    spark: SparkSession,
    start: str | dt.date = CALENDAR_START,
    end: str | dt.date = CALENDAR_END,
) -> DataFrame:
    """Calendar dimension for ``[start, end)`` (not data driven)."""
    return date_spine(spark, start, end).select(*calendar_columns("date_day"))


def dim_date_covering(stg: DataFrame, column: str = "transaction_ts") -> DataFrame:
    """Calendar dimension over whole years covering ``column`` of ``stg``."""
    return spine_from_bounds(covering_bounds(stg, column)).select(
        *calendar_columns("date_day"))


def fact_transactions(stg: DataFrame) -> DataFrame:
    """One row per transaction with four foreign keys.

    No join: every key is recomputed with the dimension's own hash, so this
    is a map-only stage (no shuffle) however large the input.
    """
    return stg.select(
        "transaction_id",
        date_key("transaction_ts").alias("date_key"),
        surrogate_key(*CUSTOMER_NK).alias("customer_key"),
        surrogate_key(*ACCOUNT_NK).alias("account_key"),
        surrogate_key(*MERCHANT_NK).alias("merchant_key"),
        "transaction_ts",
        "amount",
        "is_fraud",
        "merch_lat",
        "merch_long",
    )
