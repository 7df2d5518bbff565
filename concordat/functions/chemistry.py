"""Compositions, ions, land-use keys and typed properties."""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import names
from .text import canonical_label

#: How many of an element a multiplicative prefix states, and the elements by their stem.
PREFIXES = {"mono": 1, "di": 2, "tri": 3, "tetra": 4, "penta": 5, "hexa": 6, "hepta": 7, "octa": 8}
STEMS = {"oxide": "O", "chloride": "Cl", "fluoride": "F", "bromide": "Br", "iodide": "I", "sulfide": "S", "nitride": "N"}


def composition(text: str | None) -> dict[str, float] | None:
    """Element counts of a formula with brackets, hydrates and fractional parts (``.1/2 Ni``); charges at the
    end are left out, and None is for anything that isn't a formula."""
    if not text or not text.strip():
        return None
    total: Counter = Counter()
    for part in re.split(r"[.·*]", re.sub(r"(?: [0-9]+)?[+-]+$", "", text.strip()).replace(" ", "")):
        m = re.match(r"([0-9]+(?:/[0-9]+)?)?(.+)$", part)
        if m is None or (counts := _counted(m[2])) is None:
            return None
        for e, n in counts.items():
            total[e] += n * Fraction(m[1] or 1)
    return {e: float(n) for e, n in sorted(total.items())}


def _counted(text: str) -> Counter | None:
    stack: list[Counter] = [Counter()]
    at = 0
    while at < len(text):
        if text[at] in "([":
            stack.append(Counter())
            at += 1
        elif text[at] in ")]":
            n = re.match("[0-9]*", text[at + 1 :])[0]
            inner = stack.pop()
            if not stack:
                return None
            for e, k in inner.items():
                stack[-1][e] += k * int(n or 1)
            at += 1 + len(n)
        elif m := re.match(r"([A-Z][a-z]?)([0-9]*)", text[at:]):
            stack[-1][m[1]] += int(m[2] or 1)
            at += m.end()
        else:
            return None
    return stack[0] if len(stack) == 1 and stack[0] else None


def compositions(formula: Column) -> Column:
    """Element to count of any formula, by ``composition``. Nesting has no native form, so this is an Arrow
    function; flat formulas have ``names.element_counts``."""

    def count(x: pd.Series) -> pd.Series:
        known = {t: composition(t) for t in x.dropna().unique()}  # each formula of a batch once
        return x.map(known.get, na_action="ignore").astype(object).where(x.notna(), None)

    return F.pandas_udf(count, T.MapType(T.StringType(), T.DoubleType()))(formula)


def heavy_atoms(counts: Column) -> Column:
    """Element counts without hydrogen, as sorted text."""
    rest = F.map_filter(counts, lambda k, _: ~k.isin("H", "D", "T"))
    return F.array_join(F.transform(F.array_sort(F.map_entries(rest)), lambda e: F.concat(e["key"], e["value"].cast("string"))), ",")


def stated_counts(name: Column) -> Column:
    """Element to count that a name's multiplicative prefixes state; a stem without a prefix states none."""
    low = F.lower(name)
    found = [F.when(low.rlike(rf"\b({'|'.join(PREFIXES)}){stem}\b"), F.struct(F.lit(symbol).alias("k"), sum_of(low, stem).alias("v"))) for stem, symbol in STEMS.items()]
    return F.map_from_entries(F.array_compact(F.array(*found)))


def sum_of(low: Column, stem: str) -> Column:
    word = F.regexp_extract(low, rf"\b({'|'.join(PREFIXES)}){stem}\b", 1)
    out = F.lit(None).cast("double")
    for p, n in PREFIXES.items():
        out = F.when(word == p, float(n)).otherwise(out)
    return out


def corroborates(counts: Column, name: Column) -> Column:
    """Whether a formula has every count that its name states, and the name states one."""
    stated = stated_counts(name)
    return (F.size(stated) > 0) & F.forall(F.map_entries(stated), lambda e: F.try_element_at(counts, e["key"]).eqNullSafe(e["value"]))


def contradicts(counts: Column, name: Column) -> Column:
    """Whether a formula has another count of an element than its name states."""
    return F.exists(F.map_entries(stated_counts(name)), lambda e: ~F.try_element_at(counts, e["key"]).eqNullSafe(e["value"]))


def ion_synonyms(base: Column, charge: Column) -> Column:
    """Spellings that every ion carries: with the numeral, with the sign, as an ion."""
    size, sign = F.abs(charge).cast("string"), F.when(charge < 0, "-").otherwise("+")
    low = canonical_label(base)
    return F.array(F.concat(low, F.lit("("), F.upper(names.roman(F.abs(charge))), F.lit(")")), F.concat(low, F.lit(" "), size, sign), F.concat(low, F.lit(", ion")))


def species(name: Column) -> Column:
    """Family and state of an element's or ion's name: charged, generic ion, or bare."""
    ion = names.ion_parts(name)
    state = F.when(ion.isNull(), "bare").when(ion["charge"].isNull(), "ion").otherwise("charged")
    return F.struct(canonical_label(F.coalesce(ion["base"], name)).alias("family"), state.alias("state"), ion["charge"].alias("charge"))


def land_key(*axes: Column) -> Column:
    """Canonical key of a land use: its stated axes, from the broadest on."""
    return F.array_join(F.filter(F.array(*axes), lambda x: x.isNotNull() & (x != "")), "/")


def broader(key: Column) -> Column:
    """The key without its most specific axis; null for the broadest."""
    parts = F.split(key, "/")
    return F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))


def broader_chain(key: Column) -> Column:
    """All broader keys, nearest first."""
    parts = F.split(key, "/")
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.size(parts) - 1, F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).otherwise(F.array().cast("array<string>"))


def typed_number(value: Column) -> Column:
    """A property's text as a number, null where it is none."""
    return F.trim(value).try_cast("double")


def non_zero(amounts: Column) -> Column:
    """How many of an array of factors aren't zero."""
    return F.size(F.filter(amounts, lambda x: x != 0))
