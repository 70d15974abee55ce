"""Currency helpers: amounts are integer cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents_to_amount(c, digits: int | None = None) -> Column:
    """cents / 100 as DOUBLE (Spark would otherwise give a DECIMAL(27,6))."""
    c = F.col(c) if isinstance(c, str) else c
    amount = (c / F.lit(100.0)).cast("double")
    return F.round(amount, digits) if digits is not None else amount
