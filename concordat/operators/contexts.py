"""Contexts: where a flow comes from or goes to, as a record of eight axes.

An axis states a value, says ``Unknown`` (no value, but the axis is there) or is null. Vocabularies
and rule tables are dimensions of some hundred rows; Catalyst broadcasts them by their size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_label

#: The axes, in the order in which they are read out.
AXES = ("dimension", "media", "geography", "land_use", "strata", "population_density", "water_body", "indoor")
UNSTATED = "Unknown"
NATURAL = ("Environmental", "Resource")
GROUNDED = ("Ground level", "Low stack", "Medium stack", "High stack")
NEVER_WITHDRAWN = ("Wastewater treatment", "Secondary treatment", "Long-term")


def stated(c: Column) -> Column:
    return c.isNotNull() & (c != UNSTATED)


def rules(x: dict[str, Column]) -> dict[str, Column]:
    """What a context must not be, by the name of the rule; each condition holds where it is broken."""
    natural, air, water, ground = x["dimension"].isin(*NATURAL), x["media"].eqNullSafe("Air"), x["media"].eqNullSafe("Water"), x["media"].eqNullSafe("Ground")
    release, land = x["dimension"] == "Environmental", x["dimension"] == "Land Use"
    there = {a: x[a].isNotNull() for a in AXES}
    return {
        "media": natural != there["media"],
        "strata": (there["strata"] & (~air | ~release | there["indoor"])) | (air & release & ~there["strata"] & ~there["indoor"]),
        "indoor": there["indoor"] & (~air | ~release),
        "population_density": (there["population_density"] & (~air | ~release | ~F.coalesce(x["strata"].isin(*GROUNDED), F.lit(False)))) | (F.coalesce(x["strata"].isin(*GROUNDED), F.lit(False)) & ~there["population_density"]),
        "water_body": (there["water_body"] != (water & natural)) | ((x["dimension"] == "Resource") & F.coalesce(x["water_body"].isin(*NEVER_WITHDRAWN), F.lit(False))),
        "geography": there["geography"] != (ground & release),
        "land_use": there["land_use"] != land,
    }


def broken_rules(x: dict[str, Column]) -> Column:
    """Names of the rules that a context breaks, comma-joined."""
    return F.array_join(F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in rules(x).items()])), ",")


def display(x: dict[str, Column]) -> Column:
    """Stated values in reading order; ``Indoor`` stands before its class, or alone."""
    parts = [F.when(stated(x[a]), x[a]) for a in AXES[:-1]]
    return F.array_compact(F.array(*parts, F.when(x["indoor"].isNotNull(), "Indoor"), F.when(stated(x["indoor"]), x["indoor"])))


def axes(prefix: str = "") -> dict[str, Column]:
    return {a: F.col(f"{prefix}{a}") for a in AXES}


def contradicts(source: dict[str, Column], target: dict[str, Column]) -> Column:
    """Whether the target names a value on an axis on which the source doesn't name the same."""
    return reduce(lambda a, b: a | b, [stated(target[a]) & ~target[a].eqNullSafe(source[a]) for a in AXES])


def beside(rows: DataFrame, vocabulary: DataFrame, iri: str, prefix: str) -> DataFrame:
    """Rows with the axes of a context beside them, under a prefix; unknown contexts have nulls."""
    v = vocabulary.select(F.col("iri").alias(f"{prefix}iri"), *[F.col(a).alias(f"{prefix}{a}") for a in AXES])
    return rows.join(v, rows[iri] == F.col(f"{prefix}iri"), "left")


def contradictions(rows: DataFrame, vocabulary: DataFrame, allowed: DataFrame, source: str, target: str) -> DataFrame:
    """Adds ``contradicts``: the target denies what the source says, unless the pair is allowed. Equal,
    missing and unknown contexts contradict nothing."""
    both = beside(beside(rows, vocabulary, source, "s_"), vocabulary, target, "t_")
    ok = allowed.select(F.col("source").alias("__s"), F.col("target").alias("__t"), F.lit(True).alias("__ok")).distinct()
    both = both.join(ok, (F.col(source) == F.col("__s")) & (F.col(target) == F.col("__t")), "left")
    known = F.col("s_iri").isNotNull() & F.col("t_iri").isNotNull() & (F.col(source) != F.col(target)) & F.col("__ok").isNull()
    return both.select(*rows.columns, (F.coalesce(known, F.lit(False)) & contradicts(axes("s_"), axes("t_"))).alias("contradicts"))


def compartment(c: Column) -> Column:
    """Key of a vendor's compartment: its folded words."""
    return F.array_join(F.transform(c, canonical_label), " / ")


def conflicting_rules(rules_: DataFrame) -> DataFrame:
    """Compartments for which two lists' rules name different contexts."""
    return rules_.groupBy("compartment").agg(F.count_distinct("iri").alias("iris"), F.array_join(F.array_sort(F.collect_set("iri")), ",").alias("named")).where("iris > 1")


def by_name(rows: DataFrame, prefixes: DataFrame, key: str, on: list[str], name: str) -> DataFrame:
    """(key, iri) by the longest rule prefix that the folded name starts with, inside the compartment."""
    hit = rows.select(key, *on, canonical_label(F.col(name)).alias("__n")).join(prefixes, on).where(F.col("__n").startswith(F.col("prefix")))
    return hit.groupBy(key).agg(F.max_by("iri", F.length("prefix")).alias("iri"))


def resolve(rows: DataFrame, own: DataFrame, prefixes: DataFrame, compartments: DataFrame, key: str = "uuid") -> DataFrame:
    """(key, iri, rule): a row's own rule, else its name's, else its compartment's.

    ``rows`` has the key, list, name and context words; ``own`` (list, key, iri), ``prefixes`` (list,
    compartment, prefix, iri), ``compartments`` (list, compartment, iri).
    """
    r = rows.withColumn("compartment", compartment(F.col("context")))
    a = own.select("list", key, F.col("iri").alias("__a"))
    b = by_name(r, prefixes, key, ["list", "compartment"], "name").withColumnRenamed("iri", "__b")
    c = compartments.select("list", "compartment", F.col("iri").alias("__c"))
    out = r.join(a, ["list", key], "left").join(b, key, "left").join(c, ["list", "compartment"], "left")
    rule = F.when(F.col("__a").isNotNull(), "row").when(F.col("__b").isNotNull(), "name").when(F.col("__c").isNotNull(), "compartment").otherwise("none")
    return out.select(key, F.coalesce("__a", "__b", "__c").alias("iri"), rule.alias("rule"))


def resolve_any(questions: DataFrame, prefixes: DataFrame, compartments: DataFrame, dialect: DataFrame, vocabulary: DataFrame, key: str = "id") -> DataFrame:
    """(key, iri, how) of questions that may name no list: the context given, the named list's rules, the
    rules of all lists that agree, a dialect's spellings, our own words read backwards, unresolved."""
    q = questions.withColumn("compartment", compartment(F.col("context")))
    named = resolve(q.select(F.col(key), "list", "name", "context"), q.select("list", key, F.lit(None).cast("string").alias("iri")).limit(0), prefixes, compartments, key)
    agreed = compartments.groupBy("compartment").agg(F.min("iri").alias("lo"), F.max("iri").alias("hi")).where("lo = hi").select("compartment", F.col("lo").alias("__any"))
    any_name = by_name(q, prefixes.select("compartment", "prefix", "iri").distinct(), key, ["compartment"], "name").withColumnRenamed("iri", "__any_name")
    words = vocabulary.select(F.lower(F.array_join(display(axes()), " / ")).alias("compartment"), F.col("iri").alias("__words"))
    out = q.join(named.select(key, F.col("iri").alias("__named")), key, "left").join(any_name, key, "left").join(agreed, "compartment", "left")
    out = out.join(dialect.select("compartment", F.col("iri").alias("__dialect")), "compartment", "left").join(words, "compartment", "left")
    any_ = F.coalesce("__any_name", "__any")
    steps = [("given", F.col("iri")), ("named-list", F.col("__named")), ("any-list", any_), ("dialect", F.col("__dialect")), ("own-words", F.col("__words"))]
    how = F.lit("unresolved")
    for name, c in reversed(steps):
        how = F.when(c.isNotNull(), name).otherwise(how)
    return out.select(key, F.coalesce(*[c for _, c in steps]).alias("iri"), how.alias("how"))


def refined_by_material(rows: DataFrame, vocabulary: DataFrame, bodies: DataFrame, iri: str, material: str) -> DataFrame:
    """Adds ``refined``: for a withdrawal of water from no stated body, the context of the body that the
    material names; all other rows keep theirs."""
    r = beside(rows, vocabulary, iri, "__c_").join(bodies.select(F.col("material").alias(material), F.col("water_body").alias("__body")), material, "left")
    same = [a for a in AXES if a != "water_body"]
    v = vocabulary.select(F.col("iri").alias("__to"), F.col("water_body").alias("__body"), *[F.col(a).alias(f"__v_{a}") for a in same]).where("__body is not null")
    r = r.join(v, (r["__body"] == v["__body"]) & reduce(lambda a, b: a & b, [F.col(f"__c_{a}").eqNullSafe(F.col(f"__v_{a}")) for a in same]), "left")
    open_ = (F.col("__c_dimension") == "Resource") & (F.col("__c_media") == "Water") & (F.col("__c_water_body") == UNSTATED)
    return r.select(*[rows[c] for c in rows.columns], F.coalesce(F.when(open_, F.col("__to")), F.col(iri)).alias("refined"))


def word_distance(a: Column, b: Column) -> Column:
    """Steps from one taxonomy path up to the common part and down to the other."""
    same = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size(a), F.size(b)))), lambda n: F.slice(a, 1, n) == F.slice(b, 1, n))
    return F.size(a) + F.size(b) - 2 * F.size(same)


def nearest(rows: DataFrame, candidates: DataFrame, key: str, on: str, most: int = 8) -> DataFrame:
    """(key, target, distance, rank): the nearest contexts of the candidates that share ``on`` and don't
    cross dimension or media; the ``most`` nearest are the report.

    All candidates of one path are equally far, so that the ``most`` smallest of each path can be in a report
    and no others; paths are compared once, not once for each row that has them."""
    place = F.row_number().over(Window.partitionBy(on, "__c").orderBy("target"))
    paths = candidates.select(on, "target", F.col("words").alias("__c")).withColumn("__n", place).where(F.col("__n") <= most)
    paths = paths.groupBy(on, "__c").agg(F.collect_list(F.struct("target")).alias("__targets"))
    first = lambda c, k: F.get(F.col(c), k)
    j = rows.select(on, F.col("words").alias("__w")).distinct().join(paths, on)
    j = j.where((first("__w", 0) == first("__c", 0)) & F.coalesce(first("__w", 1) == first("__c", 1), F.lit(True)))
    j = j.select(on, "__w", F.explode("__targets.target").alias("target"), word_distance(F.col("__w"), F.col("__c")).alias("distance"))
    place = F.row_number().over(Window.partitionBy(on, "__w").orderBy("distance", "target"))
    j = j.withColumn("__n", place).where(F.col("__n") <= most).drop("__n")
    # several rows of one key are ranked together
    j = rows.select(key, on, F.col("words").alias("__w")).join(j, [on, "__w"]).select(key, "target", "distance")
    rank = F.row_number().over(Window.partitionBy(key).orderBy("distance", "target"))
    return j.withColumn("rank", rank).where(F.col("rank") <= most)


def split_places(flows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(substance, iri): created contexts of a substance that are another place than each of its others.

    ``flows`` has (substance, iri, created). Two contexts are two places where each denies the other.
    """
    f = beside(flows.distinct(), vocabulary, "iri", "s_").where("s_iri is not null")
    g = f.select("substance", F.col("iri").alias("other"), *[F.col(f"s_{a}").alias(f"t_{a}") for a in AXES])
    pairs = f.where("created").join(g, "substance").where("iri <> other")
    apart = contradicts(axes("s_"), axes("t_")) & contradicts(axes("t_"), axes("s_"))
    return pairs.groupBy("substance", "iri").agg(F.count(F.lit(1)).alias("others"), F.count_if(~apart).alias("alike")).where("alike = 0").select("substance", "iri", "others")
