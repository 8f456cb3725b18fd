"""Fixed values that must equal the reference's for identical results.

Everything here is stated plainly, in the reference's natural order.
"""
from __future__ import annotations

# --- Fixed values ---------------------------------------------------------
# Text that stands in for a NULL key part before hashing (public surrogate
# key macro of the reference's model tool, locked at version 1.4.0).
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
# Separator between key parts before hashing.
SURROGATE_SEPARATOR = "-"

# Card brand by first digit of the card number; anything else is "Other".
CARD_BRANDS = {
    "4": "Visa",
    "5": "Mastercard",
    "3": "American Express",
    "6": "Discover",
}
CARD_BRAND_OTHER = "Other"
# Masked card: this prefix, then the last four digits.
CARD_MASK_PREFIX = "XXXX-XXXX-XXXX-"

# Prefix the source data puts on every merchant name (removed everywhere
# it occurs for the display name).
MERCHANT_PREFIX = "fraud_"

# Calendar bounds of the reference's date dimension: [start, end).
CALENDAR_START = "2019-01-01"
CALENDAR_END = "2022-01-01"
# ISO day numbers (Mon=1 .. Sun=7) that count as weekend.
WEEKEND_ISO_DAYS = (6, 7)

# RAW column renames applied after lower-casing (names that are SQL words).
RESERVED_RENAMES = {"first": "cust_first", "last": "cust_last", "long": "home_lon"}
# Names the unnamed leading index column may carry: Spark's blank header,
# pandas' blank header, and the synthetic file's own name.
INDEX_ALIASES = ("_c0", "unnamed: 0")
INDEX_COLUMN = "trans_index"

# Partition column of the written fact: the month of the timestamp as yyyymm.
# Only the stored table has it, no public schema.
FACT_MONTH = "_month"
#: The fact's keys that are digests as a rule.
DIGESTS = ("transaction_id", "customer_key", "account_key", "merchant_key")

# Seed for the repeatable sample of RAW rows.
SAMPLE_SEED = 42

# Ad-hoc SELECT guard: whole words refused anywhere in the text.
FORBIDDEN_WORDS = (
    "insert", "update", "delete", "drop", "alter", "create", "truncate",
    "merge", "grant", "revoke", "call", "copy", "put", "remove", "use",
    "comment", "begin", "commit", "rollback",
)
# Spark-only: functions that call JVM methods, refused anywhere.
SPARK_CALL_WORDS = ("reflect", "java_method", "try_reflect")
# Row cap of an ad-hoc SELECT without an outer LIMIT.
ADHOC_MAX_ROWS = 1000
