"""Scalar functions of the marts."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.constants import CARD_BRAND_OTHER, CARD_BRANDS, CARD_MASK_PREFIX, MERCHANT_PREFIX


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date(value: str | dt.date | Column | None) -> Column:
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return F.to_date(value)
    return F.lit(str(value)).cast("date")


def customer_age(dob: str | Column, as_of: str | dt.date | Column | None = None) -> Column:
    """Year boundaries crossed between birth and ``as_of`` (default today).

    ``2020-12-31`` to ``2021-01-01`` is 1: a boundary count, not completed
    years.  Pin ``as_of`` for repeatable results.
    """
    return (F.year(_date(as_of)) - F.year(_col(dob))).cast("int")


def card_masked(card: str | Column) -> Column:
    """``XXXX-XXXX-XXXX-`` and the last four characters; NULL stays NULL."""
    return F.concat(F.lit(CARD_MASK_PREFIX), F.right(_col(card), F.lit(4)))


def card_brand(card: str | Column) -> Column:
    """Brand from the first digit; anything else, NULL included, is Other."""
    first = F.left(_col(card), F.lit(1))
    expr = None
    for digit, brand in CARD_BRANDS.items():
        expr = (F.when(first == digit, brand) if expr is None
                else expr.when(first == digit, brand))
    return expr.otherwise(CARD_BRAND_OTHER)


def merchant_clean(name: str | Column) -> Column:
    """Merchant name with every occurrence of the source prefix removed."""
    return F.replace(_col(name), F.lit(MERCHANT_PREFIX), F.lit(""))


def full_name(first: str | Column, last: str | Column) -> Column:
    """``first || ' ' || last``: NULL when either part is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))
