"""The one broadcast rule: a side is broadcast explicitly only when its rows
and bytes were measured and are within the bounds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest side broadcast to every executor, in rows and in bytes of its
#: values as text plus a fixed cost for each.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 << 20
VALUE_BYTES = 16


def fits_broadcast(rows: int | None, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True only for a checked count (``None`` = unknown) within the bound."""
    return rows is not None and rows <= max_rows


def checked_rows(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> int | None:
    """The row count of ``df`` if its measured bytes allow a broadcast, else
    ``None`` (to every plan: unknown).  A session that switched broadcasts
    off (a negative ``spark.sql.autoBroadcastJoinThreshold``) gets none."""
    if df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "0").startswith("-"):
        return None
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + VALUE_BYTES
                 for c in df.columns), F.lit(0).cast("long"))
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return size["rows"] if size["bytes"] <= max_bytes else None
