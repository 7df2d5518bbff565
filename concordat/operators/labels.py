"""Passes over labels, numbers and properties of whole sets: normalise, fill, strip, withhold, propagate.

Rows are (uuid, object_id, pref, alts, cas, unit) and what a pass names beside them. A pass returns what it
changes, so that a chain can log it; set-wide passes explode, aggregate and collect again in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import checks, names, text
from ..functions.text import canonical_label


def _none() -> Column:
    return F.array().cast("array<string>")


def bootstrap(flows: DataFrame) -> DataFrame:
    """Name and synonyms become a preferred label and other labels, trimmed, without the preferred one."""
    pref = F.trim("name")
    alts = F.filter(F.transform(F.coalesce("synonyms", _none()), lambda x: F.trim(x)), lambda x: (F.length(x) > 0) & (canonical_label(x) != canonical_label(pref)))
    return flows.select("uuid", pref.alias("pref"), text.dedupe_labels(alts).alias("alts"))


def normalized_units(flows: DataFrame, aliases: DataFrame) -> DataFrame:
    """(uuid, unit, notation): canonical notation of each unit's spelling; unknown ones keep theirs."""
    a = aliases.select(F.lower("alias").alias("__a"), "notation")
    return flows.join(a, F.lower(F.trim("unit")) == F.col("__a"), "left").select("uuid", "unit", F.coalesce("notation", F.trim("unit")).alias("notation"))


def numbers_from_names(flows: DataFrame, source: str = "source") -> DataFrame:
    """(uuid, cas): for rows without a number, the one that the list's own rows give their name, where the
    name has exactly one number and the number exactly one name."""
    claims = flows.where(F.size(F.coalesce("cas", _none())) > 0).select(source, canonical_label(F.col("name")).alias("n"), F.explode("cas").alias("k")).distinct()
    one_number = claims.groupBy(source, "n").agg(F.count_distinct("k").alias("ks"), F.min("k").alias("k")).where("ks = 1")
    one_name = claims.groupBy(source, "k").agg(F.count_distinct("n").alias("ns")).where("ns = 1").select(source, "k")
    known = one_number.join(one_name, [source, "k"]).select(source, "n", "k")
    open_ = flows.where(F.size(F.coalesce("cas", _none())) == 0).select("uuid", source, canonical_label(F.col("name")).alias("n"))
    return open_.join(known, [source, "n"]).select("uuid", F.col("k").alias("cas"))


def registry_review(flows: DataFrame, registry: DataFrame, ontology: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A registry's number for an exact name fills a missing one, and never overrules: (uuid, cas, verdict).
    Names without such a hit that several ontology entries carry, sharing no number: (source, name, entries, rows)."""
    f = flows.select("uuid", "source", canonical_label(F.col("name")).alias("n"), F.coalesce("cas", _none()).alias("cas"))
    r = registry.select(canonical_label(F.col("name")).alias("n"), F.col("cas").alias("k"))
    hit = f.join(r, "n").select("uuid", F.col("k").alias("cas"), F.when(F.size("cas") == 0, "filled").when(F.array_contains("cas", F.col("k")), "agrees").otherwise("disagrees").alias("verdict"))
    o = ontology.select(canonical_label(F.col("name")).alias("n"), "entry", F.explode_outer("cas").alias("k"))
    entries = o.groupBy("n").agg(F.count_distinct("entry").alias("entries"))
    shared = o.where("k is not null").groupBy("n", "k").agg(F.count_distinct("entry").alias("e")).where("e > 1").select("n").distinct()
    several = entries.where("entries > 1").join(shared, "n", "left_anti")
    rest = f.join(r.select("n").distinct(), "n", "left_anti").join(several, "n")
    return hit, rest.groupBy("source", F.col("n").alias("name"), "entries").agg(F.count(F.lit(1)).alias("rows"))


def checked_numbers(flows: DataFrame) -> DataFrame:
    """(uuid, number, verdict, corrected): every registry number of a row, right, correctable or malformed."""
    one = flows.select("uuid", F.explode("cas").alias("number"))
    fixed = checks.correct_cas(F.col("number"))
    verdict = F.when(checks.cas_valid(F.col("number")), "valid").when(fixed.isNull(), "malformed").otherwise("corrected")
    return one.select("uuid", "number", verdict.alias("verdict"), F.when(verdict == "corrected", fixed).alias("corrected"))


def cross_checked(flows: DataFrame, inventory: DataFrame) -> DataFrame:
    """(uuid, cas, ec, mismatch): pairs of numbers of a row that an inventory of (cas, ec) pairs denies, by
    what it says of either."""
    pairs = flows.select("uuid", F.explode("cas").alias("cas"), "ec").select("uuid", "cas", F.explode("ec").alias("ec"))
    by_cas = inventory.groupBy("cas").agg(F.collect_set("ec").alias("__e"))
    by_ec = inventory.groupBy("ec").agg(F.collect_set("cas").alias("__c"))
    j = pairs.join(by_cas, "cas", "left").join(by_ec, "ec", "left")
    wrong_ec, wrong_cas = F.col("__e").isNotNull() & ~F.array_contains("__e", F.col("ec")), F.col("__c").isNotNull() & ~F.array_contains("__c", F.col("cas"))
    mismatch = F.when(wrong_ec & wrong_cas, "both").when(wrong_ec, "cas-has-other-ec").when(wrong_cas, "ec-has-other-cas")
    return j.select("uuid", "cas", "ec", mismatch.alias("mismatch")).where("mismatch is not null")


def attested_only(candidates: DataFrame) -> DataFrame:
    """Candidates (cas, candidate, attested): of several for a number with one attested, those contradicted
    go; a null, which nobody has looked at, stays."""
    w = Window.partitionBy("cas")
    c = candidates.withColumns({"__n": F.count(F.lit(1)).over(w), "__any": F.bool_or(F.coalesce("attested", F.lit(False))).over(w)})
    return c.where(~((F.col("__n") > 1) & F.col("__any") & F.coalesce(~F.col("attested"), F.lit(False)))).drop("__n", "__any")


def alike_formulas(candidates: DataFrame, least: float = 0.8, window: float = 0.05) -> DataFrame:
    """Candidates (cas, candidate, formula, expected) whose formula is like the expected one, and nearly as
    like as the best; if none is, all stay."""
    w = Window.partitionBy("cas")
    c = candidates.withColumn("score", names.formula_similarity(F.col("formula"), F.col("expected")))
    good = F.coalesce((F.col("score") >= least) & (F.col("score") >= F.max("score").over(w) - window), F.lit(False))
    c = c.withColumn("__good", good)
    c = c.withColumn("__some", F.bool_or("__good").over(w))
    return c.where(F.col("__good") | ~F.col("__some")).drop("__good", "__some")


def matched_compounds(candidates: DataFrame, aligned: DataFrame) -> DataFrame:
    """(uuid, candidate, cas): candidates of a row's numbers through the gates in order, each once, under
    the first number. Formula and ontology gates ask only where a number had several to begin with; where
    the ontology names none of those, all go.

    ``candidates`` has (uuid, ordinal, cas, candidate, attested, formula, expected), ``aligned`` (candidate).
    """
    w = Window.partitionBy("uuid", "cas")
    c = candidates.withColumns({"__raw": F.count(F.lit(1)).over(w), "__any": F.bool_or(F.coalesce("attested", F.lit(False))).over(w)})
    c = c.where(~((F.col("__raw") > 1) & F.col("__any") & F.coalesce(~F.col("attested"), F.lit(False))))
    c = c.withColumn("score", names.formula_similarity(F.col("formula"), F.col("expected")))
    c = c.withColumn("__good", F.coalesce((F.col("score") >= 0.8) & (F.col("score") >= F.max("score").over(w) - 0.05), F.lit(False)))
    c = c.withColumn("__some", F.bool_or("__good").over(w)).where((F.col("__raw") == 1) | F.col("__good") | ~F.col("__some"))
    c = c.join(aligned.select("candidate", F.lit(True).alias("__on")), "candidate", "left").where((F.col("__raw") == 1) | F.col("__on"))
    return c.groupBy("uuid", "candidate").agg(F.min_by("cas", "ordinal").alias("cas"))


def merged_property(rows: DataFrame, key: list[str]) -> DataFrame:
    """Values and where they come from, united under one predicate, in order."""
    return rows.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set("value")), ",").alias("vals"), F.array_join(F.array_sort(F.collect_set("provenance")), ",").alias("provenance"))


def with_ontology_labels(flows: DataFrame, links: DataFrame, ontology: DataFrame) -> DataFrame:
    """(uuid, alts): labels with the synonyms of the linked entries behind them, each folded label once."""
    new = links.join(ontology, "entry").groupBy("uuid").agg(F.array_sort(F.collect_set("label")).alias("__new"))
    out = flows.join(new, "uuid")
    return out.select("uuid", text.dedupe_labels(F.filter(F.concat(F.coalesce("alts", _none()), "__new"), lambda x: canonical_label(x) != canonical_label(F.col("pref")))).alias("alts"))


def _kept(rows: DataFrame, drop: DataFrame, key: str = "object_id") -> DataFrame:
    """(key, alts) of rows that lose a label, the others in order; ``drop`` has (key, label)."""
    each = rows.select(key, F.posexplode("alts").alias("at", "label"))
    left = each.join(drop.select(key, "label", F.lit(True).alias("__gone")).distinct(), [key, "label"], "left")
    changed = left.groupBy(key).agg(F.count_if(F.col("__gone")).alias("lost"), F.array_sort(F.collect_list(F.when(F.col("__gone").isNull(), F.struct("at", "label")))).alias("k"))
    return changed.where("lost > 0").select(key, F.transform("k", lambda x: x["label"]).alias("alts"), "lost")


def strip_others_labels(objects: DataFrame) -> DataFrame:
    """Other labels that are the preferred label of another object go."""
    pref = objects.select(canonical_label(F.col("pref")).alias("n"), F.col("object_id").alias("owner"))
    each = objects.select("object_id", F.explode("alts").alias("label")).withColumn("n", canonical_label(F.col("label")))
    return _kept(objects, each.join(pref, "n").where("owner <> object_id").select("object_id", "label"))


def strip_symbols(objects: DataFrame, elements: DataFrame) -> DataFrame:
    """Element symbols go from objects that aren't that element."""
    each = objects.select("object_id", "pref", F.explode("alts").alias("label"))
    hit = each.join(elements.select(F.col("symbol").alias("label"), F.col("name").alias("__e")), "label").where(canonical_label(F.col("pref")) != canonical_label(F.col("__e")))
    return _kept(objects, hit.select("object_id", "label"))


def strip_qualifiers(objects: DataFrame) -> DataFrame:
    """Labels that state another origin than the preferred label go."""
    same = lambda x: text.qualifier(x).eqNullSafe(text.qualifier(F.col("pref")))
    return objects.select("object_id", F.filter("alts", same).alias("alts"), (F.size("alts") - F.size(F.filter("alts", same))).alias("lost")).where("lost > 0")


def strip_catalogue(objects: DataFrame, keep: DataFrame) -> DataFrame:
    """Registry numbers, grades and trade names among the labels go, but for a list of those to keep."""
    each = objects.select("object_id", F.explode("alts").alias("label")).where(text.catalogue_kind(F.col("label")).isNotNull())
    return _kept(objects, each.join(keep.select("label"), "label", "left_anti"))


def strip_families(objects: DataFrame, corroborated: DataFrame, labels: int = 100, members: int = 5) -> DataFrame:
    """Of objects with very many labels, product designations of one family go where there are several of
    them and nothing corroborates the family: (object_id, alts, lost)."""
    large = objects.where(F.size("alts") >= labels)
    each = large.select("object_id", F.explode("alts").alias("label")).where(text.is_product_designation(F.col("label"))).withColumn("family", text.family_token(F.col("label")))
    many = each.groupBy("object_id", "family").agg(F.count_distinct("label").alias("n")).where(F.col("n") >= members).select("object_id", "family")
    return _kept(large, each.join(many, ["object_id", "family"]).join(corroborated.select("family"), "family", "left_anti").select("object_id", "label"))


def without_pref(alts: Column, pref: Column) -> Column:
    """Labels each once and without the preferred one."""
    return F.filter(text.dedupe_labels(alts), lambda x: canonical_label(x) != canonical_label(pref))


def authoritative(rows: DataFrame, computed: DataFrame) -> DataFrame:
    """(uuid, formula): computed properties replace stated ones where the structure key is nobody else's."""
    one = rows.groupBy("structure").agg(F.count_distinct("object_id").alias("n")).where("n = 1").select("structure")
    return rows.join(one, "structure").join(computed.select("structure", F.col("formula").alias("__f")), "structure").where(~F.col("formula").eqNullSafe(F.col("__f"))).select("uuid", F.col("__f").alias("formula"))


def supplied_structures(flows: DataFrame, registry: DataFrame) -> DataFrame:
    """(uuid, structure): for rows without one, the structure that a registry has under a number of theirs and
    this very name; isotopes, mixtures and ratios are refused."""
    plain = ~canonical_label(F.col("name")).rlike(r"-[0-9]{1,3}m?$|\bmixture\b|\breaction mass\b|[0-9]:[0-9]")
    f = flows.where(F.col("structure").isNull() & plain).select("uuid", canonical_label(F.col("name")).alias("n"), F.explode("cas").alias("cas"))
    hit = f.join(registry.select("cas", canonical_label(F.col("name")).alias("n"), F.col("structure").alias("s")), ["cas", "n"])
    return hit.groupBy("uuid").agg(F.count_distinct("s").alias("k"), F.min("s").alias("structure")).where("k = 1").select("uuid", "structure")


def corrected_structures(flows: DataFrame, curated: DataFrame) -> DataFrame:
    """Curated structures, by number, before stated ones; the smallest number that has one decides."""
    c = flows.select("uuid", F.explode("cas").alias("cas")).join(curated.select("cas", F.col("structure").alias("__s")), "cas").groupBy("uuid").agg(F.min_by("__s", "cas").alias("__s"))
    return flows.join(c, "uuid", "left").select("uuid", F.coalesce("__s", "structure").alias("structure"))


def contradicted_structures(rows: DataFrame) -> DataFrame:
    """(object_id, structure): structures to withdraw because the registered composition denies their formula,
    where it backs another one of the object. ``rows`` has (object_id, structure, formula, registered)."""
    w = Window.partitionBy("object_id")
    backs = names.element_counts(F.col("formula")).isNotNull() & (F.array_sort(F.map_entries(names.element_counts(F.col("formula")))) == F.array_sort(F.map_entries(names.element_counts(F.col("registered")))))
    r = rows.withColumn("__b", F.coalesce(backs, F.lit(False)))
    return r.withColumn("__any", F.bool_or("__b").over(w)).where("__any and not __b").select("object_id", "structure")


def withheld_mass(objects: DataFrame) -> DataFrame:
    """(object_id, mass): null where an object has several structures."""
    return objects.select("object_id", F.when(F.size(F.array_distinct(F.coalesce("structures", _none()))) <= 1, F.col("mass")).alias("mass"))


def manual_fixes(flows: DataFrame, fixes: DataFrame) -> DataFrame:
    """(uuid, field, value, ordinal): what ordered fixes set. A fix holds for rows whose ``match_field`` is its
    ``match_value`` and whose field still has the original value, or already the new one; the last one wins.

    ``fixes`` has (ordinal, match_field, match_value, field, original, value); fields are columns of text.
    """
    fields = [c for c in flows.columns if c != "uuid"]
    long = flows.select("uuid", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("now")) for c in fields])).alias("x")).select("uuid", "x.*")
    at = long.select("uuid", F.col("field").alias("match_field"), F.col("now").alias("match_value")).join(fixes, ["match_field", "match_value"])
    hit = at.join(long, ["uuid", "field"]).where(F.col("now").eqNullSafe(F.col("original")) | F.col("now").eqNullSafe(F.col("value")))
    return hit.groupBy("uuid", "field").agg(F.max_by("value", "ordinal").alias("value"), F.max("ordinal").alias("ordinal"))


def with_additions(flows: DataFrame, added: DataFrame, excluded: DataFrame) -> DataFrame:
    """A list with its added rows and without the excluded ones; an excluded row must be there."""
    from .changes import refuse

    refuse(excluded.join(flows, "uuid", "left_anti"), "excluded rows that the list doesn't have")
    return flows.join(excluded.select("uuid"), "uuid", "left_anti").unionByName(added.join(flows.select("uuid"), "uuid", "left_anti"), allowMissingColumns=True)


def carried_names(objects: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names of member flows carried to their object as labels: (object_id, label), and those refused with the
    first reason that holds: another object's preferred name, another origin, a name that several carry."""
    m = members.select("object_id", F.col("name").alias("label"), canonical_label(F.col("name")).alias("n")).distinct()
    pref = objects.select(canonical_label(F.col("pref")).alias("n"), F.col("object_id").alias("owner"))
    other = m.join(pref, "n").where("owner <> object_id").select("object_id", "n", F.lit(True).alias("__other")).distinct()
    shared = m.groupBy("n").agg(F.count_distinct("object_id").alias("k")).where("k > 1").select("n", F.lit(True).alias("__shared"))
    own = objects.select("object_id", "pref", canonical_label(F.col("pref")).alias("__p"), F.transform(F.coalesce("alts", _none()), canonical_label).alias("__a"))
    j = m.join(own, "object_id").where((F.col("n") != F.col("__p")) & ~F.array_contains("__a", F.col("n"))).join(other, ["object_id", "n"], "left").join(shared, "n", "left")
    reason = F.when(F.col("__other"), "names-another").when(~text.qualifier(F.col("label")).eqNullSafe(text.qualifier(F.col("pref"))), "other-origin").when(F.col("__shared"), "shared")
    j = j.select("object_id", "label", reason.alias("reason"))
    return j.where("reason is null").select("object_id", "label"), j.where("reason is not null")


def pushed_labels(objects: DataFrame, flows: DataFrame, rulings: DataFrame) -> DataFrame:
    """(uuid, verdict, pref, alts): what becomes of each flow's label under its object's name. Equal agrees;
    an empty one is labelled; one that folds alike is respelt; a name that no other object has is taken, and
    the old one kept as another label; a claimed one waits for a ruling of (old, new, verdict)."""
    o = objects.select("object_id", F.col("pref").alias("__to"), canonical_label(F.col("pref")).alias("__n"))
    claims = objects.groupBy(canonical_label(F.col("pref")).alias("__n")).agg(F.count_distinct("object_id").alias("__claims"))
    r = rulings.select(F.col("old").alias("__old"), F.col("new").alias("__new"), F.col("verdict").alias("__v"))
    j = flows.join(o, "object_id").join(claims, "__n").join(r, (F.col("pref") == F.col("__old")) & (F.col("__to") == F.col("__new")), "left")
    verdict = F.when(F.col("pref") == F.col("__to"), "agree").when(F.coalesce(F.length("pref"), F.lit(0)) == 0, "label").when(canonical_label(F.col("pref")) == F.col("__n"), "respell").when(F.col("__v") == "keep", "keep").when((F.col("__claims") == 1) | (F.col("__v") == "rename"), "rename").otherwise("defer")
    j = j.withColumn("verdict", verdict).withColumnRenamed("pref", "__was")
    alts = F.when(F.col("verdict") == "rename", without_pref(F.concat(F.coalesce("alts", _none()), F.array("__was")), F.col("__to"))).otherwise(F.col("alts"))
    moves = F.col("verdict").isin("label", "respell", "rename")
    return j.select("uuid", "verdict", F.when(moves, F.col("__to")).otherwise(F.col("__was")).alias("pref"), alts.alias("alts"))


def typed(objects: DataFrame, members: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """(object_id, type): the first of ordered rules that holds over an object and the set of dimensions and
    media that its flows are in."""
    slots = members.groupBy("object_id").agg(F.array_sort(F.collect_set("slot")).alias("slots"))
    o = objects.join(slots, "object_id", "left").withColumn("slots", F.coalesce("slots", _none()))
    kind = reduce(lambda rest, r: F.when(r[1], r[0]).otherwise(rest), reversed(rules), F.lit("unclassified"))
    return o.select("object_id", kind.alias("type"))


def without_properties(rows: DataFrame, types: DataFrame, single: list[str]) -> DataFrame:
    """(object_id, properties): of objects of a class, the properties that only a single substance has go."""
    p = rows.join(types.where(F.col("type").isin("mixture", "group")), "object_id")
    return p.select("object_id", F.array_join(F.array_sort(F.map_keys(F.map_filter("properties", lambda k, _: ~k.isin(*single)))), ",").alias("properties"))
