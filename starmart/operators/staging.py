"""Staging (T1-T9): one typed row per RAW row, 22 columns, no filter."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.schemas import AMOUNT, RAW_REQUIRED


def _missing(raw: DataFrame) -> list[str]:
    have = {c.lower() for c in raw.columns}
    return [c for c in RAW_REQUIRED if c not in have]


def stage_transactions(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Cast and rename RAW text into ``stg_transactions``.

    ``strict`` (default) raises on text that does not parse, as the source
    warehouse does, whatever the session's ANSI setting; ``strict=False``
    turns it into NULL so the quality tests report it instead.  A single projection: Catalyst prunes
    unused RAW columns at the scan.
    """
    missing = _missing(raw)
    if missing:
        raise ValueError(f"RAW table lacks required columns: {missing}")

    def cast(name: str, to) -> Column:
        c = F.col(name)
        value = c.try_cast(to)
        if not strict:
            return value
        refuse = F.raise_error(F.concat(F.lit(f"{name} does not parse: "), c)).cast(to)
        return F.coalesce(value, F.when(c.isNotNull(), refuse))

    return raw.select(
        F.col("trans_num").alias("transaction_id"),
        cast("trans_date_trans_time", "timestamp_ntz").alias("transaction_ts"),
        F.col("cc_num").cast("string").alias("card_number"),
        F.col("merchant").alias("merchant_name"),
        F.col("category").alias("merchant_category"),
        cast("amt", AMOUNT).alias("amount"),
        F.col("cust_first").alias("first_name"),
        F.col("cust_last").alias("last_name"),
        F.col("gender"),
        F.col("street"),
        F.col("city"),
        F.col("state"),
        F.col("zip").cast("string").alias("postal_code"),
        cast("lat", "double").alias("home_lat"),
        cast("home_lon", "double").alias("home_long"),
        cast("city_pop", "long").alias("city_population"),
        F.col("job"),
        cast("dob", "date").alias("date_of_birth"),
        cast("unix_time", "long").alias("unix_time"),
        cast("merch_lat", "double").alias("merch_lat"),
        cast("merch_long", "double").alias("merch_long"),
        # A number in text; one means fraud.
        (cast("is_fraud", "int") == 1).alias("is_fraud"),
    )
