"""Tolerances, bands and printed precision."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = 0.02


def comparable(lo: Column, hi: Column) -> Column:
    """Whether a ratio is defined: neither is zero and both have one sign."""
    return (lo != 0) & (hi != 0) & ((lo > 0) == (hi > 0))


def ratio(lo: Column, hi: Column) -> Column:
    """Larger by smaller magnitude of the extremes; 1 where equal, null where undefined."""
    a, b = F.abs(lo), F.abs(hi)
    return F.when(lo == hi, 1.0).when(comparable(lo, hi), F.try_divide(F.greatest(a, b), F.least(a, b)))


def agrees(lo: Column, hi: Column, tolerance: float = TOLERANCE) -> Column:
    return F.coalesce(ratio(lo, hi) - 1 <= tolerance, F.lit(False))


def band(lo: Column, hi: Column) -> Column:
    """One of seven ordered classes of difference between the extremes."""
    r = ratio(lo, hi)
    return F.when(lo == hi, "identical").when(r.isNull(), "incomparable").when(r - 1 <= TOLERANCE, "within-tolerance").when(r <= 2, "2x").when(r <= 10, "10x").when(r <= 100, "100x").otherwise("over-100x")


def to_significant(c: Column, digits: int) -> Column:
    """A number rounded half away from zero to some figures, in floating point."""
    places = digits - 1 - F.floor(F.log10(F.abs(c).cast("double")))
    scale = F.pow(F.lit(10.0), places.cast("double"))
    return F.when(c == 0, 0.0).otherwise(F.signum(c.cast("double")) * F.floor(F.abs(c).cast("double") * scale + 0.5) / scale)


def printed_digits(x: float) -> int:
    """Significant digits of the shortest decimal that reads back as the number."""
    mantissa = repr(abs(x)).split("e")[0].replace(".", "").lstrip("0")
    return len(mantissa.rstrip("0")) if mantissa.strip("0") else 0


def significant_digits(c: Column) -> Column:
    """Digits of a double's shortest text. Spark prints some doubles with more digits than they
    need, so this is Python's ``repr``, in Arrow batches."""

    def count(x: pd.Series) -> pd.Series:
        return x.map(printed_digits, na_action="ignore").astype("Int32")

    return F.pandas_udf(count, "int")(c)


def more_precise(a: float, b: float, tolerance: float = TOLERANCE) -> float | None:
    """The one of two numbers that is the other printed to more digits, else None."""
    from decimal import ROUND_HALF_UP, Decimal

    if a == b or a == 0 or b == 0 or (a > 0) != (b > 0) or max(abs(a), abs(b)) / min(abs(a), abs(b)) - 1 > tolerance:
        return None
    m, n = printed_digits(a), printed_digits(b)
    if m == n:
        return None
    fine, coarse, digits = (a, b, n) if m > n else (b, a, m)
    exact = Decimal(repr(fine))
    step = Decimal(1).scaleb(exact.adjusted() - digits + 1)
    return fine if exact.quantize(step, rounding=ROUND_HALF_UP) == Decimal(repr(coarse)) else None
