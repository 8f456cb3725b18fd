"""Property tests: Spark column functions against plain-Python statements
of the same rules, over generated values (NULLs and unicode included).
All generated rows are checked in one Spark job per property."""
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmart.constants import (
    CARD_BRAND_OTHER,
    CARD_BRANDS,
    CARD_MASK_PREFIX,
    MERCHANT_PREFIX,
    SURROGATE_NULL_TOKEN,
)
from starmart.functions import card_brand, card_masked, merchant_clean, surrogate_key

text = st.one_of(st.none(), st.text(max_size=12),
                 st.sampled_from(["", "-", "fraud_", "fraud_fraud_x", "4", "5123", "x-y"]))
SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_key(*parts):
    joined = "-".join(SURROGATE_NULL_TOKEN if p is None else p for p in parts)
    return hashlib.md5(joined.encode("utf-8")).hexdigest()


def py_brand(card):
    return CARD_BRANDS.get(card[:1], CARD_BRAND_OTHER) if card is not None else CARD_BRAND_OTHER


def py_mask(card):
    return None if card is None else CARD_MASK_PREFIX + card[-4:] if card else CARD_MASK_PREFIX


@SETTINGS
@given(st.lists(st.tuples(text, text, text), min_size=1, max_size=40))
def test_surrogate_key_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r.k for r in df.select(surrogate_key("a", "b", "c").alias("k")).collect()]
    assert got == [py_key(*r) for r in rows]


@SETTINGS
@given(st.lists(text, min_size=1, max_size=40))
def test_card_and_merchant_functions_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(card_brand("v").alias("b"), card_masked("v").alias("m"),
                    merchant_clean("v").alias("c")).collect()
    for v, r in zip(values, got):
        assert r.b == py_brand(v)
        assert r.m == py_mask(v)
        assert r.c == (None if v is None else v.replace(MERCHANT_PREFIX, ""))
