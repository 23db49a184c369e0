"""Station and bike conditions as column expressions.

A station is *full* here when its bikes fill its capacity. The daily figures use
another rule, no free docks (see ``operators.daily``): docks may be out of order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEARLY_FULL_MARGIN = 3


def full_flag(bikes: str = "num_bikes_available", capacity: str = "capacity") -> Column:
    """1 if bikes equal capacity, 0 if not, null where capacity is zero or unknown."""
    return F.when(F.col(capacity) != 0, F.col(bikes) == F.col(capacity)).cast("int")


def saturation_flag(
    bikes: str = "num_bikes_available",
    capacity: str = "capacity",
    margin: int = NEARLY_FULL_MARGIN,
) -> Column:
    """1 if at most ``margin`` places are free; full stations count as well."""
    return (F.col(bikes) >= F.col(capacity) - F.lit(margin)).cast("int")


def empty_flag(bikes: str = "num_bikes_available") -> Column:
    """1 if there is no bike."""
    return (F.col(bikes) == 0).cast("int")


def situation(reserved: str = "is_reserved", disabled: str = "is_disabled") -> Column:
    """BOTH, RESERVED or DISABLED; null for a bike that is neither."""
    is_reserved, is_disabled = F.col(reserved), F.col(disabled)
    return (
        F.when(is_reserved & is_disabled, "BOTH")
        .when(is_reserved, "RESERVED")
        .when(is_disabled, "DISABLED")
    )
