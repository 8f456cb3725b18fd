"""Column expressions (all built-in Spark functions, codegen'd JVM-side)."""
from starmart.functions.keys import date_key, surrogate_key
from starmart.functions.scalars import (
    card_brand,
    card_masked,
    customer_age,
    full_name,
    merchant_clean,
)
from starmart.functions.calendar import (
    calendar_columns,
    covering_bounds,
    date_spine,
    spine_from_bounds,
)

__all__ = [
    "surrogate_key", "date_key", "card_brand", "card_masked", "customer_age",
    "full_name", "merchant_clean", "calendar_columns", "date_spine", "covering_bounds",
    "spine_from_bounds",
]
