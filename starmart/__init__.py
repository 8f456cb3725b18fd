"""starmart: a card-transactions star schema built with Spark DataFrames.

Layers (see README): RAW text table -> typed staging -> star marts
(fact + customer/account/merchant/date dimensions) -> quality tests,
BI reports, named star-join questions and a guarded ad-hoc SELECT.
"""

__all__ = ["session"]
