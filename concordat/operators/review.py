"""What a build leaves behind for its reviewers: samples, evidence, queues, roles, sinks that only add."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chemistry, names
from ..functions.numbers import band
from ..functions.text import canonical_label
from .changes import refuse


def bounded_sample(flows: DataFrame, limit: int, keep: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The first rows of a list and those named; a named row that isn't there is an error. The bound is what
    the caller asks for."""
    refuse(keep.join(flows, "uuid", "left_anti"), "named rows that the list doesn't have")
    return flows.join(keep.select("uuid", F.lit(True).alias("__keep")), "uuid", "left").where((F.col(ordinal) < limit) | F.col("__keep")).drop("__keep")


def supplied_compositions(flows: DataFrame, registry: DataFrame) -> DataFrame:
    """(uuid, formula): for rows without a formula, a registry's under one of their numbers, if the name states
    a count and the formula agrees with it; several such formulas are none."""
    f = flows.where("formula is null").select("uuid", "name", F.explode("cas").alias("cas")).join(registry.select("cas", F.col("formula").alias("f")), "cas")
    f = f.withColumn("__c", chemistry.compositions(F.col("f"))).where(chemistry.corroborates(F.col("__c"), F.col("name")))
    return f.groupBy("uuid").agg(F.count_distinct("f").alias("n"), F.min("f").alias("formula")).where("n = 1").select("uuid", "formula")


def external_names(*registries: DataFrame) -> DataFrame:
    """(cas, names): the names that registries of (cas, name) have for a number, each folded name once."""
    out = registries[0]
    for r in registries[1:]:
        out = out.unionByName(r)
    one = out.groupBy("cas", canonical_label(F.col("name")).alias("n")).agg(F.min("name").alias("name"))
    return one.groupBy("cas").agg(F.array_join(F.array_sort(F.collect_list("name")), "; ").alias("names"))


def name_relation(own: Column, other: Column) -> Column:
    """How two names relate: exact, a mixture, a class of substances, one inside the other, or unresolved."""
    a, b = canonical_label(own), canonical_label(other)
    return F.when(a == b, "exact").when(a.rlike(r"\b(mixture|mix|blend)\b") | b.rlike(r"\b(mixture|mix|blend)\b"), "mixture").when(a.rlike(r"\b(compounds|salts|unspecified)\b") | b.rlike(r"\b(compounds|salts|unspecified)\b"), "class").when(a.contains(b) | b.contains(a), "class").otherwise("unresolved")


def entailed_roles(numbers: DataFrame, edges: DataFrame, allowed: DataFrame, depth: int = 64) -> DataFrame:
    """(entry, role): allowed roles that an entry has, or that any broader entry has. ``edges`` has (entry, kind,
    to) of kind is-a and has-role. Each round climbs one level, until nothing new is reached."""
    up = edges.where("kind = 'is-a'").select("entry", F.col("to").alias("up"))
    reach = numbers.select("entry", F.col("entry").alias("at")).distinct()
    seen, front = reach, reach
    for _ in range(depth):
        front = front.join(up.select(F.col("entry").alias("at"), "up"), "at").select("entry", F.col("up").alias("at")).distinct().join(seen, ["entry", "at"], "left_anti")
        if front.isEmpty():
            break
        seen = seen.unionAll(front)
    roles = edges.where("kind = 'has-role'").select(F.col("entry").alias("at"), F.col("to").alias("role"))
    return seen.join(roles, "at").join(allowed.select("role"), "role").select("entry", "role").distinct()


def with_curated_roles(objects: DataFrame, found: DataFrame, curated: DataFrame) -> DataFrame:
    """(object_id, roles): roles found and roles asserted by hand, each once."""
    both = found.select("object_id", "role").unionByName(curated.select("object_id", "role")).groupBy("object_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))
    return objects.select("object_id").join(both, "object_id", "left").select("object_id", F.coalesce("roles", F.lit("")).alias("roles"))


def associations(flows: DataFrame, concepts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(flow, concept, how): concepts of the sources of a flow, directly or by way of a correspondence."""
    direct = flows.join(concepts, "source_uuid").select("flow", "concept", F.lit("source").alias("how"))
    paired = flows.join(pairs.select(F.col("source").alias("source_uuid"), F.col("target").alias("__t")), "source_uuid").join(concepts.select(F.col("source_uuid").alias("__t"), "concept"), "__t").select("flow", "concept", F.lit("correspondence").alias("how"))
    return direct.unionAll(paired).groupBy("flow", "concept").agg(F.max("how").alias("how"))


def numbered_changes(changes: DataFrame, objects: DataFrame) -> DataFrame:
    """(change_index, uuid, object_id): changes in total order, with the object that each flow is of. Steps are
    numbered apart and offset by the counts before, so that no window holds all changes."""
    size = changes.groupBy("step").agg(F.count(F.lit(1)).alias("n"))
    before = size.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row for each step
    own = F.row_number().over(Window.partitionBy("step").orderBy("ordinal"))
    return changes.withColumn("__k", own).join(before.select("step", "before"), "step").join(objects, "uuid", "left").select((F.col("before") + F.col("__k")).cast("long").alias("change_index"), "uuid", "object_id")


def queue(items: list[DataFrame]) -> DataFrame:
    """(queue, item_index, subject, severity): items of all steps, numbered within their queue."""
    out = items[0]
    for x in items[1:]:
        out = out.unionByName(x)
    return out.withColumn("item_index", F.row_number().over(Window.partitionBy("queue").orderBy("severity", "subject"))).select("queue", "item_index", "subject", "severity")


def collision_items(flows: DataFrame, amounts: DataFrame) -> DataFrame:
    """(queue, subject, severity, spread): one item for each live group of an object, context and unit, blocking
    where its flows state numbers over 2 % apart."""
    g = flows.groupBy("object_id", "context", "unit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    f = flows.join(g, ["object_id", "context", "unit"]).join(amounts.where("amount > 0"), "flow", "left")
    s = f.groupBy("object_id", "context", "unit", "category").agg((F.max("amount") / F.min("amount") - 1).alias("s")).groupBy("object_id", "context", "unit").agg(F.max("s").alias("spread"))
    subject = F.concat_ws("|", "object_id", "context", "unit")
    return s.select(F.lit("collisions").alias("queue"), subject.alias("subject"), F.when(F.col("spread") > 0.02, "blocking").otherwise("review").alias("severity"), F.round("spread", 6).alias("spread"))


def only_moved(before: DataFrame, after: DataFrame, key: str, field: str) -> DataFrame:
    """(key, before, after) of rows whose field really changed."""
    j = before.select(key, F.col(field).alias("before")).join(after.select(key, F.col(field).alias("after")), key)
    return j.where(~F.col("before").eqNullSafe(F.col("after")))


def united(existing: DataFrame, arriving: DataFrame, key: str, column: str) -> DataFrame:
    """(key, column, changed): arrays of existing rows with the arriving entries behind them, each once."""
    new = arriving.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias("__new"))
    j = existing.select(key, column).join(new, key, "left")
    out = F.array_union(column, F.coalesce("__new", F.array().cast(existing.schema[column].dataType)))
    return j.select(key, out.alias(column), (F.size(out) > F.size(column)).alias("changed"))


def compared_release(inventory: DataFrame, theirs: DataFrame, ours: DataFrame, floor: float = 1e-3) -> DataFrame:
    """(process, theirs, ours, ratio, band, unmapped, kept): a vendor's scores against ours, the share of theirs
    on flows that we don't have, and how many lines are worth keeping: those that differ, or hold ``floor``."""
    x = inventory.join(theirs, "flow", "left").join(ours.select("flow", F.col("factor").alias("g")), "flow", "left")
    x = x.withColumns({"a": F.coalesce(F.col("amount") * F.col("factor"), F.lit(0.0)), "b": F.coalesce(F.col("amount") * F.col("g"), F.lit(0.0))})
    s = x.groupBy("process").agg(F.sum("a").alias("theirs"), F.sum("b").alias("ours"), F.sum(F.abs("a")).alias("__whole"), F.sum(F.when(F.col("g").isNull(), F.abs("a")).otherwise(0.0)).alias("__lost"))
    big = F.greatest(F.abs("theirs"), F.abs("ours"))
    kept = x.join(s.select("process", (floor * big).alias("__floor")), "process").groupBy("process").agg(F.count_if((F.abs(F.col("a") - F.col("b")) > 0.02 * F.greatest(F.abs("a"), F.abs("b"))) | (F.abs("a") >= F.col("__floor"))).alias("kept"))
    return s.join(kept, "process").select("process", "theirs", "ours", F.try_divide(F.col("ours"), F.col("theirs")).alias("ratio"), band(F.least("theirs", "ours"), F.greatest("theirs", "ours")).alias("band"), F.try_divide(F.col("__lost"), F.col("__whole")).alias("unmapped"), "kept")


def smallest_windows(classes: DataFrame) -> DataFrame:
    """(id, parent): the smallest window that holds each size window, and is another one. Windows are some dozen."""
    c, p = classes.alias("c"), classes.alias("p")
    j = c.join(p, (F.col("p.lo") <= F.col("c.lo")) & (F.col("p.hi") >= F.col("c.hi")) & (F.col("p.id") != F.col("c.id")) & ((F.col("p.hi") - F.col("p.lo")) > (F.col("c.hi") - F.col("c.lo"))), "left")
    return j.groupBy(F.col("c.id").alias("id")).agg(F.min_by("p.id", F.struct((F.col("p.hi") - F.col("p.lo")).alias("w"), F.col("p.id"))).alias("parent"))


def legal_combinations(directions: DataFrame, classes: DataFrame, intensities: DataFrame) -> DataFrame:
    """(key): land uses that there may be: a direction, a class, and an intensity where the class takes one.
    The axes are closed vocabularies of some dozen values, multiplied by a constant key."""
    one = F.lit(1).alias("__k")
    d, c, i = directions.select("direction", one), classes.select("class", "takes", one), intensities.select("intensity", one)
    base = d.join(c, "__k")
    with_ = base.where("takes").join(i, "__k")
    return base.select(chemistry.land_key(F.col("direction"), F.col("class")).alias("key")).unionAll(with_.select(chemistry.land_key(F.col("direction"), F.col("class"), F.col("intensity")).alias("key")))


def stage_timings(events: DataFrame) -> DataFrame:
    """(stage, runs, seconds, share): how long each stage of a run took."""
    g = events.groupBy("stage").agg(F.count(F.lit(1)).alias("runs"), F.sum("seconds").alias("seconds"))
    return g.withColumn("share", F.col("seconds") / F.sum("seconds").over(Window.partitionBy()))  # a row for each stage


def minted_context_flows(objects: DataFrame, places: DataFrame) -> DataFrame:
    """(flow_id, object_id, iri): the ids of an object's flows in some contexts."""
    return objects.select("object_id").join(places, "object_id").select(names.minted_flow_id(F.col("object_id"), F.col("iri")).alias("flow_id"), "object_id", "iri")
