"""Surrogate keys (M7) and the YYYYMMDD date key."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.constants import SURROGATE_NULL_TOKEN, SURROGATE_SEPARATOR


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """128-bit md5 hex digest of the key parts, in the given order.

    Each part is cast to text and a NULL part becomes a fixed token, so the key
    is never NULL, ``(a, NULL)`` and ``(NULL, a)`` differ, and fact and
    dimension compute the same key without a join.  ``concat_ws`` is not used:
    it would silently drop NULL parts.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(SURROGATE_SEPARATOR))
        parts.append(F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)))
    return F.md5(F.concat(*parts))


def packed(c: str | Column) -> Column:
    """A text as bytes, for exchanges: the 16 bytes that 32 lower-case hex
    digits stand for; any other text with 17 zero bytes behind it, so that no
    two texts become one (NULL stays NULL)."""
    c = _col(c)
    return F.when(c.rlike(r"^[0-9a-f]{32}\z"), F.unhex(c)).otherwise(F.concat(c.cast("binary"), F.lit(bytes(17))))


def unpacked(c: str | Column) -> Column:
    """The text of :func:`packed` bytes."""
    c = _col(c)
    other = F.substring(c, F.lit(1), F.octet_length(c) - 17).cast("string")
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(other)


def date_key(c: str | Column) -> Column:
    """Integer ``YYYYMMDD`` of a date or timestamp (NULL stays NULL).

    Integer arithmetic on the date fields: the same value as formatting the
    date as text and parsing it back, without a string per row.
    """
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
