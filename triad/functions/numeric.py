"""Numeric and casting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_even(col, digits: int) -> Column:
    """Document-store ``$round``: ties go to the even digit."""
    return F.bround(_c(col), digits)


def round_half_up(col, digits: int = 2) -> Column:
    """Graph-query ``round(x * 10^d) / 10^d``: ties go up."""
    scale = float(10 ** digits)
    return F.floor(_c(col) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def lenient_double(col) -> Column:
    """Text to double; bad or missing values become 0.0."""
    return F.coalesce(_c(col).try_cast("double"), F.lit(0.0))


def lenient_int(col, type_name: str = "int") -> Column:
    """Text to integer through double (so '12.9' -> 12, truncated); bad -> 0."""
    return F.coalesce(lenient_double(col).try_cast(type_name), F.lit(0).cast(type_name))


def to_integer(col, type_name: str = "int") -> Column:
    """Graph-query ``toInteger``: a fraction is cut off ('12.7' gives 12), bad text gives null."""
    return F.coalesce(_c(col).try_cast(type_name), _c(col).try_cast("double").try_cast(type_name))


def lenient_bool(col, null_as: bool = True) -> Column:
    """'true'/'1' (any case, blanks around) -> true; other text false; missing -> null_as."""
    v = F.lower(F.trim(_c(col).cast("string")))
    return F.when(_c(col).isNull(), F.lit(null_as)).otherwise(v.isin("true", "1"))
