"""Layers: which substance each flow is of, and what whole groups of flows say about a substance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from ..functions.text import canonical_label
from ..session import cut
from .groups import closure


def _none() -> Column:
    return F.array().cast("array<string>")


def layered(rows: DataFrame) -> DataFrame:
    """(ord, owner, how): the object of every row, named by the row that founded it, in the order of ``ord``.

    ``rows`` has (ord, exclusive, name, cas). Rows of one exclusive key, such as a nuclide or land class, are
    one object. All others meet under their name, each number and their set of numbers; a key belongs to the
    object of the first row that has it, and objects never merge. One object found is joined, unless only the
    name found it and both have numbers; of several the only one that a number found; else the row founds one.

    A row waits for the first holders of its keys alone, so that all rows whose holders are settled are
    settled at once: as many rounds as the longest such chain, not as many as rows.
    """
    cas, name = F.array_sort(F.coalesce("cas", _none())), canonical_label(F.col("name"))
    base = rows.select("ord", "exclusive", cas.alias("cas"), name.alias("n"))
    shut = base.where("exclusive is not null")
    first = shut.groupBy("exclusive").agg(F.min("ord").alias("owner"))
    fixed = shut.join(first, "exclusive").select("ord", "owner", F.lit("exclusive").alias("how"))
    free = base.where("exclusive is null")
    whole = F.array(F.struct(F.lit("set").alias("kind"), F.concat_ws("|", "cas").alias("k")))
    each = F.transform("cas", lambda x: F.struct(F.lit("number").alias("kind"), x.alias("k")))
    by_name = F.array(F.struct(F.lit("name").alias("kind"), F.col("n").alias("k")))
    keys = free.select("ord", F.explode(F.when(F.size("cas") > 0, F.concat(whole, each, by_name)).otherwise(by_name)).alias("x")).select("ord", "x.*")
    holder = keys.groupBy("kind", "k").agg(F.min("ord").alias("holder"))
    refs = cut(keys.join(holder, ["kind", "k"]).where("holder < ord").groupBy("ord", "holder").agg(F.bool_or(F.col("kind") != "name").alias("numbered")))
    numbers = free.select("ord", (F.size("cas") > 0).alias("has"))
    done = cut(free.join(refs.select("ord").distinct(), "ord", "left_anti").select("ord", F.col("ord").alias("owner"), F.lit("founded").alias("how")))
    while not refs.isEmpty():
        known = done.select(F.col("ord").alias("holder"), "owner")
        j = refs.join(known, "holder", "left")
        ready = j.groupBy("ord").agg(F.bool_and(F.col("owner").isNotNull()).alias("ok")).where("ok").select("ord")
        found = j.join(ready, "ord").groupBy("ord", "owner").agg(F.bool_or("numbered").alias("numbered"), F.min("holder").alias("holder"))
        found = found.join(numbers.select(F.col("ord").alias("holder"), F.col("has").alias("__its")), "holder").join(numbers.select("ord", F.col("has").alias("__own")), "ord")
        g = found.groupBy("ord").agg(F.count(F.lit(1)).alias("n"), F.count_if("numbered").alias("by_number"), F.min("owner").alias("one"), F.min(F.when(F.col("numbered"), F.col("owner"))).alias("num"), F.bool_and(~F.col("numbered") & F.col("__its") & F.col("__own")).alias("apart"))
        how = F.when((F.col("n") == 1) & ~F.col("apart"), "joined").when((F.col("n") > 1) & (F.col("by_number") == 1), "by-number").otherwise("founded")
        new = cut(g.select("ord", F.when(how == "joined", F.col("one")).when(how == "by-number", F.col("num")).otherwise(F.col("ord")).alias("owner"), how.alias("how")))
        done, refs = cut(done.unionAll(new)), cut(refs.join(new.select("ord"), "ord", "left_anti"))
    return done.unionAll(fixed)


def described(members: DataFrame) -> DataFrame:
    """(owner, label, cas, alts): an object's label is its longest name, the shortest where it has an origin;
    its numbers are all of its rows', its other labels their other names. ``members`` has (owner, ord, name,
    cas, qualified)."""
    size = F.length("name")
    g = members.groupBy("owner").agg(F.bool_or("qualified").alias("q"), F.min_by("name", F.struct((-size).alias("s"), F.col("ord"))).alias("long"), F.min_by("name", F.struct(size.alias("s"), F.col("ord"))).alias("short"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("cas", _none()))))).alias("cas"), F.array_sort(F.collect_set("name")).alias("all"))
    label = F.when(F.col("q"), F.col("short")).otherwise(F.col("long"))
    return g.select("owner", label.alias("label"), F.array_join("cas", ",").alias("cas"), F.array_join(F.filter("all", lambda x: canonical_label(x) != canonical_label(label)), ",").alias("alts"))


def contested_verdicts(claims: DataFrame, rulings: DataFrame, supplied: DataFrame, factors: DataFrame, registry: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """(cas, names, verdict, why) of numbers that several folded names claim, by the first signal that speaks:
    a ruling, a fix of ours, factors that differ, a registry that knows all the names, nothing.

    ``claims`` has (cas, name), ``factors`` (cas, name, method, context, amount), ``registry`` (cas, name)."""
    c = claims.select("cas", canonical_label(F.col("name")).alias("n")).distinct()
    many = c.groupBy("cas").agg(F.count(F.lit(1)).alias("names")).where("names > 1")
    f = factors.where("amount > 0").select("cas", canonical_label(F.col("name")).alias("n"), "method", "context", "amount")
    f = f.groupBy("cas", "method", "context").agg(F.count_distinct("n").alias("sides"), F.min("amount").alias("lo"), F.max("amount").alias("hi")).where("sides > 1")
    f = f.groupBy("cas").agg(F.max(F.col("hi") / F.col("lo") - 1).alias("spread"))
    r = registry.select("cas", canonical_label(F.col("name")).alias("n"), F.lit(True).alias("known")).distinct()
    k = c.join(r, ["cas", "n"], "left").groupBy("cas").agg(F.bool_and(F.coalesce("known", F.lit(False))).alias("known"))
    j = many.join(rulings.select("cas", F.col("verdict").alias("__v")), "cas", "left").join(supplied.select("cas", F.lit(True).alias("__s")), "cas", "left").join(f, "cas", "left").join(k, "cas", "left")
    why = F.when(F.col("__v").isNotNull(), "ruling").when(F.col("__s"), "supplied").when(F.col("spread") > tolerance, "factors").when(F.col("known"), "registry").otherwise("none")
    verdict = F.when(why == "ruling", F.col("__v")).when(why.isin("supplied", "registry"), "merge").when(why == "factors", "separate").otherwise("undecided")
    return j.select("cas", "names", verdict.alias("verdict"), why.alias("why"))


def pair_relation(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """How two numbered substances relate, by structure key, name and formula; the first rule that holds."""
    mixed = lambda x: F.coalesce(F.lower(x["name"]).rlike(r"\b(mixture|mix|blend)\b"), F.lit(False))
    locant = lambda x: F.regexp_extract(x["name"], r"([0-9]+(?:,[0-9]+)*)-", 1)
    return (
        F.when(a["structure"] == b["structure"], "exact").when(F.substring(a["structure"], 1, 14) == F.substring(b["structure"], 1, 14), "class").when(mixed(a) | mixed(b), "mixture")
        .when((locant(a) != "") & (locant(b) != "") & (locant(a) != locant(b)), "class").when(a["formula"] != b["formula"], "class").otherwise("unresolved")
    )


def group_evidence(members: DataFrame, profiles: DataFrame) -> DataFrame:
    """(grp, numbers, pairs, conflict): a group's numbers, and whether any two of them are not one substance."""
    m = members.select("grp", F.explode("cas").alias("cas")).distinct()
    p = profiles.select("cas", "name", "structure", "formula")
    left = m.join(p, "cas").select("grp", F.col("cas").alias("a"), F.struct("name", "structure", "formula").alias("x"))
    right = m.join(p, "cas").select("grp", F.col("cas").alias("b"), F.struct("name", "structure", "formula").alias("y"))
    pairs = left.join(right, "grp").where("a < b").select("grp", pair_relation({k: F.col(f"x.{k}") for k in ("name", "structure", "formula")}, {k: F.col(f"y.{k}") for k in ("name", "structure", "formula")}).alias("r"))
    n = m.groupBy("grp").agg(F.count(F.lit(1)).alias("numbers"))
    return n.join(pairs.groupBy("grp").agg(F.count(F.lit(1)).alias("pairs"), F.bool_or(F.col("r") != "exact").alias("conflict")), "grp", "left").select("grp", "numbers", F.coalesce("pairs", F.lit(0)).alias("pairs"), F.coalesce("conflict", F.lit(False)).alias("conflict"))


def ballots(votes: DataFrame, key: str, candidate: str) -> DataFrame:
    """(key, winner, spelling): the folded candidate of most sources, two at least and untied, in the spelling
    of the first source that has it. ``votes`` has (key, candidate, source, source_rank)."""
    v = votes.select(key, canonical_label(F.col(candidate)).alias("c"), F.col(candidate).alias("spelt"), "source", "source_rank")
    g = v.groupBy(key, "c").agg(F.count_distinct("source").alias("n"), F.min_by("spelt", F.struct("source_rank", "spelt")).alias("spelling"))
    top = g.groupBy(key).agg(F.max("n").alias("most"))
    best = g.join(top, key).where("n = most").groupBy(key, "most").agg(F.count(F.lit(1)).alias("ties"), F.min("c").alias("c"), F.min("spelling").alias("s"))
    won = (F.col("most") >= 2) & (F.col("ties") == 1)
    return best.select(key, F.when(won, F.col("c")).alias("winner"), F.when(won, F.col("s")).alias("spelling"))


def consensus_numbers(groups: DataFrame, ballots_: DataFrame, conflicts: DataFrame, alt_numbers: DataFrame) -> DataFrame:
    """(grp, cas, verdict): groups without a number take the ballot's, unless their numbers conflict or the
    data has another number under one of their labels. ``alt_numbers`` has (label, cas)."""
    g = groups.where(F.size(F.coalesce("cas", _none())) == 0).select("grp", canonical_label(F.col("name")).alias("n")).join(ballots_.select(F.col("name").alias("n"), F.col("winner").alias("k")), "n")
    alt = alt_numbers.groupBy(F.col("label").alias("n")).agg(F.collect_set("cas").alias("__alt"))
    j = g.join(conflicts.select("grp", "conflict"), "grp", "left").join(alt, "n", "left")
    verdict = F.when(F.col("k").isNull(), "no-winner").when(F.coalesce("conflict", F.lit(False)), "group-conflict").when(F.col("__alt").isNotNull() & ~F.array_contains("__alt", F.col("k")), "label-conflict").otherwise("filled")
    return j.select("grp", F.when(verdict == "filled", F.col("k")).alias("cas"), verdict.alias("verdict"))


def gated_renames(members: DataFrame, ballots_: DataFrame, rulings: DataFrame) -> DataFrame:
    """(uuid, verdict, name): members that the ballot on their number calls otherwise are renamed with an
    approving ruling, kept with a refusing one, and reviewed without. ``rulings`` has (current, replacement, ok)."""
    j = members.join(ballots_.select("cas", "winner", "spelling"), "cas").where(F.col("winner").isNotNull() & (canonical_label(F.col("name")) != F.col("winner")))
    r = rulings.select(canonical_label(F.col("current")).alias("__c"), canonical_label(F.col("replacement")).alias("__r"), "ok")
    j = j.join(r, (canonical_label(F.col("name")) == F.col("__c")) & (F.col("winner") == F.col("__r")), "left")
    verdict = F.when(F.col("ok"), "renamed").when(~F.col("ok"), "kept").otherwise("review")
    return j.select("uuid", verdict.alias("verdict"), F.when(verdict == "renamed", F.col("spelling")).otherwise(F.col("name")).alias("name"))


def ruled_collisions(groups_: DataFrame, rulings: DataFrame) -> DataFrame:
    """(flow_id, survivor, verdict): flows of one object, context and unit, where a ruling merges them; a ruling
    of other flows than those that collide now is stale. ``groups_`` has (key, flow_id), ``rulings`` (key,
    members, survivor)."""
    now = groups_.groupBy("key").agg(F.array_sort(F.collect_set("flow_id")).alias("__now"))
    j = groups_.join(now, "key").join(rulings.select("key", F.array_sort("members").alias("__then"), "survivor"), "key", "left")
    verdict = F.when(F.col("__then").isNull(), "open").when(F.col("__then") != F.col("__now"), "stale").when(F.col("flow_id") == F.col("survivor"), "survives").otherwise("merged")
    return j.select("flow_id", F.when(verdict.isin("survives", "merged"), F.col("survivor")).alias("survivor"), verdict.alias("verdict"))


def element_objects(objects: DataFrame, elements: DataFrame) -> DataFrame:
    """(symbol, object_id, how): each element's object by its folded preferred name, else its symbol, else a
    label that only one object has; elements without one are to be minted."""
    label = objects.select("object_id", F.explode(F.coalesce("alts", _none())).alias("x")).select("object_id", canonical_label(F.col("x")).alias("n"))
    alone = label.groupBy("n").agg(F.count_distinct("object_id").alias("k"), F.min("object_id").alias("o")).where("k = 1")
    pref = objects.groupBy(canonical_label(F.col("pref")).alias("n")).agg(F.min("object_id").alias("o"))
    e = elements.select("symbol", canonical_label(F.col("name")).alias("n"), F.lower("symbol").alias("s"))
    j = e.join(pref.select("n", F.col("o").alias("a")), "n", "left").join(pref.select(F.col("n").alias("s"), F.col("o").alias("b")), "s", "left").join(alone.select("n", F.col("o").alias("c")), "n", "left")
    how = F.when(F.col("a").isNotNull(), "name").when(F.col("b").isNotNull(), "symbol").when(F.col("c").isNotNull(), "label").otherwise("mint")
    return j.select("symbol", F.coalesce("a", "b", "c").alias("object_id"), how.alias("how"))


def isotope_shares(candidates: DataFrame) -> DataFrame:
    """(object_id, nuclide, share): each candidate isotope's part of the abundances of its object's candidates."""
    whole = F.sum("abundance").over(Window.partitionBy("object_id"))
    return candidates.select("object_id", "nuclide", F.try_divide(F.col("abundance"), whole).alias("share"))


def ions(objects: DataFrame, elements: DataFrame) -> DataFrame:
    """(object_id, symbol, charge, label): objects whose name is an element's ion, with the house spelling."""
    p = objects.select("object_id", names.ion_parts(F.col("pref")).alias("p")).where("p is not null").select("object_id", canonical_label(F.col("p.base")).alias("n"), "p.charge")
    return p.join(elements.select("symbol", canonical_label(F.col("name")).alias("n")), "n").select("object_id", "symbol", "charge", F.when(F.col("charge").isNotNull(), names.ion_label(F.col("n"), F.col("charge"))).alias("label"))


def nearest_ancestors(keys: DataFrame) -> DataFrame:
    """(key, parent): the nearest broader key that is there itself; a key is its axes joined by /, and broader
    without its last one."""
    parts = F.split("key", "/")
    up = keys.select("key", F.explode(F.filter(F.sequence(F.lit(1), F.size(parts)), lambda n: n < F.size(parts))).alias("n"), parts.alias("p")).select("key", "n", F.array_join(F.slice("p", 1, F.col("n")), "/").alias("parent"))
    have = keys.select(F.col("key").alias("parent")).distinct()
    best = up.join(have, "parent").groupBy("key").agg(F.max_by("parent", "n").alias("parent"))
    return keys.join(best, "key", "left")


def family_parents(objects: DataFrame, rules: DataFrame) -> DataFrame:
    """(object_id, family, parent): objects under the family that the first rule whose prefix their name starts
    with declares, and the id of its parent."""
    hit = objects.join(rules, F.lower("pref").startswith(F.col("prefix"))).groupBy("object_id").agg(F.min_by("family", "ordinal").alias("family"))
    return hit.withColumn("parent", names.stable_id("family", F.col("family")))


def classification_blocks(objects: DataFrame) -> DataFrame:
    """(object_id, scheme, value): numbers of either scheme as rows, in order."""
    one = lambda c, s: objects.select("object_id", F.lit(s).alias("scheme"), F.explode(c).alias("value"))
    return one("cas", "cas").unionAll(one("ec", "ec")).distinct()


def correspondences(associations: DataFrame) -> DataFrame:
    """(source_list, target_list, iri, pairs, kinds): associations regrouped by pair of lists, under stable ids."""
    g = associations.groupBy("source_list", "target_list").agg(F.count_distinct("source", "target").alias("pairs"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))
    return g.withColumn("iri", names.stable_id("correspondence", F.col("source_list"), F.col("target_list")))


def redirect_reasons(redirects: DataFrame, contexts: DataFrame, published: DataFrame) -> DataFrame:
    """(id, terminal, reason): ends of replacement chains, compared by the contexts that each list gave both
    flows: no shared list is unclassified, any that differs a context collapse, else an identity merge; a cycle
    or an unpublished end is no target. ``contexts`` has (flow, list, context)."""
    ends = closure(redirects, "id", "replaced_by").join(published.select(F.col("flow").alias("terminal"), F.lit(True).alias("__pub")), "terminal", "left")
    c = contexts.groupBy("flow", "list").agg(F.array_sort(F.collect_set("context")).alias("c"))
    a = ends.join(c.select(F.col("flow").alias("id"), "list", F.col("c").alias("ca")), "id").join(c.select(F.col("flow").alias("terminal"), "list", F.col("c").alias("cb")), ["terminal", "list"])
    cmp = a.groupBy("id").agg(F.bool_or(F.col("ca") != F.col("cb")).alias("differs"))
    j = ends.join(cmp, "id", "left")
    reason = F.when(F.col("status") == "cycle", "cycle").when(F.col("__pub").isNull(), "unpublished").when(F.col("differs").isNull(), "unclassified").when(F.col("differs"), "context-collapse").otherwise("identity-merge")
    return j.select("id", F.when(F.col("__pub"), F.col("terminal")).alias("terminal"), reason.alias("reason"))


def formula_mismatches(citations: DataFrame, threshold: float = 0.55) -> DataFrame:
    """(object_id, a, b, score): pairs of an object's cited formulas that are hardly alike."""
    c = citations.select("object_id", F.col("source").alias("a"), F.col("formula").alias("fa"))
    d = citations.select("object_id", F.col("source").alias("b"), F.col("formula").alias("fb"))
    j = c.join(d, "object_id").where("a < b").withColumn("score", names.formula_similarity(F.col("fa"), F.col("fb")))
    return j.where(F.col("score") < threshold).select("object_id", "a", "b", F.round("score", 6).alias("score"))


def element_coverage(elements: DataFrame, objects: DataFrame) -> DataFrame:
    """(symbol, state): whether an element's object is linked, there without a link, or missing."""
    o = objects.groupBy(canonical_label(F.col("pref")).alias("n")).agg(F.bool_or("linked").alias("l"))
    j = elements.select("symbol", canonical_label(F.col("name")).alias("n")).join(o, "n", "left")
    return j.select("symbol", F.when(F.col("l").isNull(), "missing").when(F.col("l"), "linked").otherwise("not-linked").alias("state"))
