"""Schema of every layer (StructType constants)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
DATE, NTZ = T.DateType(), T.TimestampNTZType()
AMOUNT = T.DecimalType(12, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


#: RAW: every column text, names after normalisation.
RAW_COLUMNS = (
    "trans_index", "trans_date_trans_time", "cc_num", "merchant", "category",
    "amt", "cust_first", "cust_last", "gender", "street", "city", "state",
    "zip", "lat", "home_lon", "city_pop", "job", "dob", "trans_num",
    "unix_time", "merch_lat", "merch_long", "is_fraud",
)
#: RAW columns staging needs (all but the index).
RAW_REQUIRED = tuple(c for c in RAW_COLUMNS if c != "trans_index")
RAW = _struct(*[(c, S) for c in RAW_COLUMNS])

STG_TRANSACTIONS = _struct(
    ("transaction_id", S), ("transaction_ts", NTZ), ("card_number", S),
    ("merchant_name", S), ("merchant_category", S), ("amount", AMOUNT),
    ("first_name", S), ("last_name", S), ("gender", S), ("street", S),
    ("city", S), ("state", S), ("postal_code", S), ("home_lat", D),
    ("home_long", D), ("city_population", L), ("job", S),
    ("date_of_birth", DATE), ("unix_time", L), ("merch_lat", D),
    ("merch_long", D), ("is_fraud", B),
)

DIM_CUSTOMER = _struct(
    ("customer_key", S), ("first_name", S), ("last_name", S), ("full_name", S),
    ("gender", S), ("date_of_birth", DATE), ("age", I), ("street", S),
    ("city", S), ("state", S), ("postal_code", S), ("home_lat", D),
    ("home_long", D), ("city_population", L), ("job", S),
)

DIM_ACCOUNT = _struct(
    ("account_key", S), ("card_number", S), ("card_masked", S), ("card_brand", S),
)

DIM_MERCHANT = _struct(
    ("merchant_key", S), ("merchant_name", S), ("merchant_category", S),
    ("merchant_name_clean", S),
)

DIM_DATE = _struct(
    ("date_key", I), ("full_date", DATE), ("year", I), ("quarter", I),
    ("month", I), ("month_name", S), ("day_of_month", I), ("day_of_week", I),
    ("day_name", S), ("is_weekend", B),
)

FACT_TRANSACTIONS = _struct(
    ("transaction_id", S), ("date_key", I), ("customer_key", S),
    ("account_key", S), ("merchant_key", S), ("transaction_ts", NTZ),
    ("amount", AMOUNT), ("is_fraud", B), ("merch_lat", D), ("merch_long", D),
)

QUALITY_REPORT = _struct(
    ("test_id", I), ("model", S), ("column_name", S), ("test", S),
    ("failures", L), ("passed", B),
)

MART_SCHEMAS = {
    "dim_customer": DIM_CUSTOMER,
    "dim_account": DIM_ACCOUNT,
    "dim_merchant": DIM_MERCHANT,
    "dim_date": DIM_DATE,
    "fact_transactions": FACT_TRANSACTIONS,
}


def conform(df: DataFrame, expected: T.StructType, name: str) -> DataFrame:
    """``df`` if it has the layer's columns and types, in order; else an error."""
    if not same_columns(df.schema, expected):
        raise TypeError(f"{name} has {df.schema.simpleString()}, the layer declares {expected.simpleString()}")
    return df


def same_columns(actual: T.StructType, expected: T.StructType) -> bool:
    """Names and types equal, in order (nullability ignored)."""
    return [(f.name, f.dataType) for f in actual.fields] == [
        (f.name, f.dataType) for f in expected.fields
    ]
