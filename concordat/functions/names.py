"""Names and identifiers of substances: keys, formulas, nuclides, ions and vendors' spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import canonical_label

INCHIKEY = r"^([A-Z]{14})-([A-Z]{8})([A-Z])([A-Z])-([A-Z])$"
ROMAN = ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii")


def inchikey(c: Column) -> Column:
    """Parts of a structure key; null for other text."""
    part = lambda k: F.regexp_extract(c, INCHIKEY, k)
    return F.when(c.rlike(INCHIKEY), F.struct(part(1).alias("skeleton"), part(2).alias("stereo"), part(3).alias("standard"), part(4).alias("version"), part(5).alias("protonation")))


def compare_structures(a: Column, b: Column) -> Column:
    """How two keys relate: same, flat-vs-stereo, stereo, protonation, different, unknown."""
    x, y = inchikey(a), inchikey(b)
    flat = F.lit("UHFFFAOY")
    return F.when(x.isNull() | y.isNull(), "unknown").when(x.skeleton != y.skeleton, "different").when(x.protonation != y.protonation, "protonation").when(x.stereo == y.stereo, "same").when((x.stereo == flat) | (y.stereo == flat), "flat-vs-stereo").otherwise("stereo")


def without_flat_keys(keys: Column) -> Column:
    """Keys without those flat ones that a specific key of the same skeleton covers."""
    flat = lambda k: F.substring(k, 16, 8) == "UHFFFAOY"
    return F.filter(keys, lambda k: ~(flat(k) & F.exists(keys, lambda o: ~flat(o) & (F.substring(o, 1, 14) == F.substring(k, 1, 14)))))


def element_counts(formula: Column) -> Column:
    """Element to count of a plain formula; null where anything else is in it."""
    plain = formula.rlike(r"^([A-Z][a-z]?[0-9]*)+$")
    symbols = F.regexp_extract_all(formula, F.lit(r"([A-Z][a-z]?)([0-9]*)"), 1)
    counts = F.transform(F.regexp_extract_all(formula, F.lit(r"([A-Z][a-z]?)([0-9]*)"), 2), lambda n: F.when(n == "", 1).otherwise(n.try_cast("int")))
    names = F.array_sort(F.array_distinct(symbols))
    total = lambda s: F.aggregate(F.zip_with(symbols, counts, lambda a, n: F.when(a == s, n).otherwise(0)), F.lit(0), lambda x, n: x + n)
    return F.when(plain, F.map_from_arrays(names, F.transform(names, total)))


def formula_similarity(a: Column, b: Column) -> Column:
    """1 less half the distance of the element fractions."""
    x, y = element_counts(a), element_counts(b)
    size = lambda m: F.aggregate(F.map_values(m), F.lit(0), lambda s, n: s + n)
    part = lambda m, k: F.coalesce(F.try_element_at(m, k), F.lit(0)) / size(m)
    keys = F.array_union(F.map_keys(x), F.map_keys(y))
    return 1 - F.aggregate(F.transform(keys, lambda k: F.abs(part(x, k) - part(y, k))), F.lit(0.0), lambda s, d: s + d) / 2


def nuclide(c: Column) -> Column:
    """Element, mass and state of a label such as Cobalt-60m; null for others."""
    p = r"^([A-Za-z]+)-([0-9]{1,3})(m[0-9]?)?$"
    return F.when(c.rlike(p), F.struct(F.lower(F.regexp_extract(c, p, 1)).alias("element"), F.regexp_extract(c, p, 2).cast("int").alias("mass"), F.regexp_extract(c, p, 3).alias("state")))


def half_life_seconds(c: Column) -> Column:
    """Seconds of a text such as ``4.5(1) d``; null where number or unit is missing."""
    p = r"^\s*([0-9.]+(?:[eE][+-]?[0-9]+)?)\s*(?:\([0-9]+\))?\s*(s|m|h|d|y)\s*$"
    unit = F.regexp_extract(c, p, 2)
    scale = F.when(unit == "s", 1.0).when(unit == "m", 60.0).when(unit == "h", 3600.0).when(unit == "d", 86400.0).when(unit == "y", 31557600.0)
    return F.regexp_extract(c, p, 1).try_cast("double") * scale


def roman(n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ROMAN)), n + 1)


def ion_label(base: Column, charge: Column) -> Column:
    """House spelling of an ion."""
    return F.concat(canonical_label(base), F.lit(" ("), F.when(charge < 0, "-").otherwise(""), roman(F.abs(charge)), F.lit(")"))


def ion_parts(c: Column) -> Column:
    """Base and charge of names such as ``Cobalt(II)``, ``Cobalt, ion`` and ``Co 2+``."""
    upper = F.array(*(F.lit(r.upper()) for r in ROMAN))
    p, q = r"^(.+?) ?\(([IVX]+)\)$", r"^(.+?),? (?:ion )?([0-9])\+$"
    return F.when(c.rlike(p), F.struct(F.regexp_extract(c, p, 1).alias("base"), (F.array_position(upper, F.regexp_extract(c, p, 2)) - 1).cast("int").alias("charge"))).when(c.rlike(q), F.struct(F.regexp_extract(c, q, 1).alias("base"), F.regexp_extract(c, q, 2).cast("int").alias("charge"))).when(c.rlike(r", ion$"), F.struct(F.regexp_replace(c, ", ion$", "").alias("base"), F.lit(None).cast("int").alias("charge")))


def deinvert_index_name(c: Column) -> Column:
    """``Toluene, bromo-`` to ``bromotoluene``; null for names of another shape."""
    p = r"^([A-Za-z]+), ([A-Za-z0-9,()-]+)-$"
    return F.when(c.rlike(p), F.concat(F.regexp_extract(c, p, 2), F.lower(F.regexp_extract(c, p, 1))))


def deinvert_phrase(c: Column) -> Column:
    """``Timber, sawn`` to ``sawn timber``; null where the tail isn't a plain qualifier."""
    p = r"^([A-Za-z][a-z ]+), ([a-z][a-z -]*[a-z])$"
    plain = c.rlike(p) & ~c.rlike(r"/|, ions?$|, (in|from|to|of|as|for|with) ")
    return F.when(plain, F.concat(F.regexp_extract(c, p, 2), F.lit(" "), F.lower(F.regexp_extract(c, p, 1))))


def valence_in_parentheses(c: Column) -> Column:
    """``Cobalt II`` to ``cobalt (ii)``."""
    p = r"^([A-Za-z]+) (II|III|IV|V|VI|VII|VIII)$"
    return F.when(c.rlike(p), F.concat(F.lower(F.regexp_extract(c, p, 1)), F.lit(" ("), F.lower(F.regexp_extract(c, p, 2)), F.lit(")")))


def fused_locants(c: Column) -> Column:
    """``Dibenzo(a,h)pyrene`` to ``dibenzo[a,h]pyrene``."""
    p = r"([a-z])\(([a-z](?:,[a-z])*|[0-9](?:,[0-9])*(?:-[a-z]+)?)\)([a-z])"
    return F.when(c.rlike(p), F.lower(F.regexp_replace(c, p, "$1[$2]$3")))


def without_unit_suffix(c: Column, unit: Column) -> Column:
    """``Steam/kg`` with unit kg to ``Steam``."""
    tail = F.concat(F.lit("/"), unit)
    return F.when(F.lower(c).endswith(F.lower(tail)), F.substring(c, F.lit(1), F.length(c) - F.length(tail)))


def geography_suffix(c: Column) -> Column:
    """Base label and code of ``Steam, PT``; whether both are known is for a join to say."""
    p = r"^(.+), ([A-Z]{2}(?:-[A-Z]{2,3})?|GLO|RoW|RER)$"
    return F.when(c.rlike(p), F.struct(F.regexp_extract(c, p, 1).alias("base"), F.regexp_extract(c, p, 2).alias("code")))


def aliases(c: Column) -> Column:
    """All derived spellings of a vendor's name, without nulls and repeats."""
    made = F.array(deinvert_index_name(c), deinvert_phrase(c), valence_in_parentheses(c), fused_locants(c))
    return F.array_distinct(F.filter(made, lambda x: x.isNotNull()))


def stable_id(prefix: str, *parts: Column) -> Column:
    """Deterministic id of what identifies a substance."""
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, 16))


def minted_flow_id(object_id: Column, context: Column, prefix: str = "flow") -> Column:
    """Deterministic id of a substance in a context."""
    return F.sha1(F.concat_ws(":", F.lit(prefix), object_id, context).cast("binary"))
