"""Folding, casing and shape classes of labels. Patterns keep to what RE2 and Java share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize(c: Column) -> Column:
    """Lower case without any white space."""
    return F.lower(F.regexp_replace(c, r"\s+", ""))


def canonical_label(c: Column) -> Column:
    """Comparison key of a label: lower case, single spaces, trimmed."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def title_case(c: Column) -> Column:
    """Each word with a capital, unless it has an inner capital or doesn't start with a letter."""
    word = lambda w: F.when(F.substring(w, 2, 1 << 20).rlike("[A-Z]") | ~w.rlike("^[A-Za-z]"), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20))))
    return F.array_join(F.transform(F.split(c, " ", -1), word), " ")


def strip_markup(c: Column) -> Column:
    """Text without tags; the five predefined character references are resolved, &amp; last."""
    out = F.regexp_replace(c, r"<[^>]*>", " ")
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(ref), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def first_rule(rules: list[tuple[Column, str]]) -> Column:
    """Value of the first rule that holds, null if none does."""
    out = F.lit(None).cast("string")
    for holds, value in reversed(rules):
        out = F.when(holds, F.lit(value)).otherwise(out)
    return out


def catalogue_kind(c: Column) -> Column:
    """Shape of a label, else of what stands before its last bracket: registry number, grade code, trade
    name; null for ordinary names."""
    stem = F.regexp_replace(c, r"\s*\([^()]*\)$", "")
    return F.coalesce(_catalogue_kind(c), F.when(stem != c, _catalogue_kind(stem)))


def _catalogue_kind(c: Column) -> Column:
    return first_rule([(c.rlike(r"^[0-9]{2,7}-[0-9]{2}-[0-9]$"), "registry-code"), (c.rlike(r"^[A-Z]{1,5}[ -]?[0-9]{2,6}[A-Z]?$"), "grade-code"), (c.rlike(r"^[A-Z][a-z]+ (\(R\)|\(TM\)|[A-Z]?[0-9]+)$"), "trade-name")])


def qualifier(c: Column) -> Column:
    """Origin that a name states, by ordered patterns."""
    low = F.lower(c)
    return first_rule([(low.rlike(r"\bnon-fossil\b"), "non-fossil"), (low.rlike(r"\bfossil\b"), "fossil"), (low.rlike(r"\bbiogenic\b"), "biogenic"), (low.rlike(r"\bfrom soil\b|\bland transformation\b"), "land"), (low.rlike(r"\bpeat\b"), "peat")])


def has_stereo(c: Column) -> Column:
    """Whether a name holds a stereo descriptor."""
    return c.rlike(r"(^|[^A-Za-z])(\([RSEZ+-]\)|cis|trans|[RSEZ]-)")


#: What binds digits into a chemical name, and the shape of a grade at the end of a trade name.
LOCANT = r"[0-9],[0-9]|[0-9]-[a-z]|[a-z]-[0-9]|[0-9]['\u2019]|[\u03b1\u03b2\u03b3\u03b4]"
GRADE = r"^[A-Za-z]{0,4}-?[0-9][0-9A-Za-z]*([.:/-][0-9A-Za-z]+)*$"


def family_token(c: Column) -> Column:
    """Leading word in lower case, without marks at its ends."""
    return F.lower(F.regexp_replace(F.element_at(F.split(F.trim(c), r"\s+"), 1), r"^[,;:.()\[\]]+|[,;:.()\[\]]+$", ""))


def is_product_designation(c: Column) -> Column:
    """Two words or more of which the last is a short grade with a digit, and no locant anywhere."""
    words = F.split(F.trim(c), r"\s+")
    last = F.regexp_replace(F.element_at(words, -1), r"^[,;.]+|[,;.]+$", "")
    return (F.size(words) >= 2) & (F.length(last) <= 14) & last.rlike(GRADE) & ~c.rlike(LOCANT)


def is_becquerel(c: Column) -> Column:
    """Whether a unit counts decays, whatever its spelling."""
    return F.coalesce(F.lower(F.trim(c)).rlike(r"^(k|m|g|t|kilo|mega|giga)?[ -]?(bq|becquerels?)$"), F.lit(False))


def qualifier_losses(current: Column, replacement: Column) -> Column:
    """Words that a rename loses: an origin, a state of charge, brackets' contents, in this order."""
    charge = lambda c: F.regexp_extract(c, r"\(([IVX]+)\)", 1)
    inner = lambda c: F.regexp_extract(F.regexp_replace(c, r"\([IVX]+\)", ""), r"\(([A-Za-z][^)]*)\)", 1)
    lost = [F.when(qualifier(current).isNotNull() & ~qualifier(current).eqNullSafe(qualifier(replacement)), F.concat(F.lit("origin:"), qualifier(current)))]
    lost += [F.when((f(current) != "") & (f(current) != f(replacement)), F.concat(F.lit(n), f(current))) for n, f in (("charge:", charge), ("bracket:", inner))]
    return F.array_compact(F.array(*lost))


def tokens(c: Column) -> Column:
    """Lower-case search words, each once."""
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: w != ""))


def dedupe_labels(c: Column) -> Column:
    """First occurrence of every folded label of an array, in order."""
    seen = F.transform(c, canonical_label)
    return F.filter(c, lambda x, i: F.array_position(seen, canonical_label(x)) == i + 1)
