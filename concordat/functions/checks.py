"""Check digits of registry numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _weighted(digits: Column, weight) -> Column:
    """Sum of digit times weight(index from 0)."""
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda k: F.substring(digits, k, F.lit(1)).cast("int") * weight(k - 1))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def cas_digit(c: Column) -> Column:
    """Check digit that the body of a CAS number calls for; null for other shapes."""
    body = F.reverse(F.replace(F.regexp_extract(c, r"^([0-9]{2,7}-[0-9]{2})-[0-9]$", 1), F.lit("-"), F.lit("")))
    return F.when(F.length(body) > 0, _weighted(body, lambda k: k + 1) % 10)


def cas_valid(c: Column) -> Column:
    return F.coalesce(cas_digit(c) == F.substring(c, -1, 1).try_cast("int"), F.lit(False))


def correct_cas(c: Column) -> Column:
    """The number with the digit that its body calls for."""
    return F.concat(F.regexp_extract(c, r"^(.*-)[0-9]$", 1), cas_digit(c).cast("string"))


def normalize_cas(c: Column) -> Column:
    """Without leading zeros of the first part."""
    return F.regexp_replace(c, r"^0+([0-9])", "$1")


def ec_digit(c: Column) -> Column:
    """Check digit of an EC number; remainder 10 exists for numbers in 4 only, as digit 1."""
    body = F.replace(F.regexp_extract(c, r"^([0-9]{3}-[0-9]{3})-[0-9]$", 1), F.lit("-"), F.lit(""))
    r = _weighted(body, lambda k: k + 1) % 11
    return F.when(F.length(body) > 0, F.when(r < 10, r).when(body.startswith("4"), 1))


def ec_valid(c: Column) -> Column:
    return F.coalesce(ec_digit(c) == F.substring(c, -1, 1).try_cast("int"), F.lit(False))


def correct_ec(c: Column) -> Column:
    return F.concat(F.regexp_extract(c, r"^(.*-)[0-9]$", 1), ec_digit(c).cast("string"))
