"""Two releases side by side: fates of objects and categories, factor diffs, provenance and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from ..functions.text import canonical_label


def object_fates(gone: DataFrame, flows: DataFrame, fates: DataFrame, objects_of: DataFrame) -> DataFrame:
    """(object_id, fate, target): objects follow their flows. All flows deleted deletes; flows that go to one
    object replace; to several, or any unresolved, is unresolved.

    ``flows`` has (object_id, flow) before, ``fates`` (flow, fate, target), ``objects_of`` (target, object)."""
    f = gone.join(flows, "object_id", "left").join(fates, "flow", "left").join(objects_of.select("target", F.col("object").alias("__o")), "target", "left")
    g = f.groupBy("object_id").agg(F.count("flow").alias("n"), F.count_if(F.col("fate") == "deleted").alias("dead"), F.count_if(F.col("fate") == "replaced").alias("moved"), F.count_distinct("__o").alias("to"), F.min("__o").alias("target"))
    fate = F.when(F.col("n") == 0, "unresolved").when(F.col("dead") == F.col("n"), "deleted").when((F.col("to") == 1) & (F.col("dead") + F.col("moved") == F.col("n")), "replaced").otherwise("unresolved")
    return g.select("object_id", fate.alias("fate"), F.when(fate == "replaced", F.col("target")).alias("target"))


def category_fates(gone: DataFrame, after: DataFrame, retired: DataFrame, rulings: DataFrame) -> DataFrame:
    """(category, fate, target): a retired category is deleted, one whose name lives on under one id is that,
    and a ruling may answer what is still unresolved."""
    live = after.groupBy(canonical_label(F.col("name")).alias("__n")).agg(F.min("category").alias("lo"), F.max("category").alias("hi")).where("lo = hi").select("__n", F.col("lo").alias("__t"))
    j = gone.withColumn("__n", canonical_label(F.col("name"))).join(live, "__n", "left").join(retired.select("category", F.lit(True).alias("__r")), "category", "left").join(rulings.select("category", F.col("target").alias("__ruled")), "category", "left")
    fate = F.when(F.col("__r"), "deleted").when(F.coalesce("__t", "__ruled").isNotNull(), "replaced").otherwise("unresolved")
    return j.select("category", fate.alias("fate"), F.when(fate == "replaced", F.coalesce("__t", "__ruled")).alias("target"))


def broken_ids(flows: DataFrame) -> DataFrame:
    """Minted flow ids that the hash of their object and context doesn't give again."""
    return flows.where("minted").where(F.col("flow_id") != names.minted_flow_id(F.col("object_id"), F.col("iri"))).select("flow_id")


def factor_diff(before: DataFrame, after: DataFrame, flow_fates: DataFrame, category_fates_: DataFrame) -> DataFrame:
    """(flow, category, geo, delta): the factors before, under the ids that their flow and category have now,
    against those after. Of several that land on one key the one that was there stays, else the first; the
    others, and those whose flow or category is gone, are deleted under their old key."""
    f = flow_fates.select("flow", F.col("fate").alias("__ff"), F.col("target").alias("__ft"))
    c = category_fates_.select("category", F.col("fate").alias("__cf"), F.col("target").alias("__ct"))
    b = before.join(f, "flow", "left").join(c, "category", "left")
    b = b.select(F.col("flow").alias("__of"), F.col("category").alias("__oc"), "geo", "amount", F.when(F.col("__ff").isNull(), F.col("flow")).otherwise(F.col("__ft")).alias("flow"), F.when(F.col("__cf").isNull(), F.col("category")).otherwise(F.col("__ct")).alias("category"), (F.col("__ff").isNotNull() | F.col("__cf").isNotNull()).alias("__moved"))
    lost = b.where("flow is null or category is null").select(F.col("__of").alias("flow"), F.col("__oc").alias("category"), "geo", F.lit("deleted").alias("delta"))
    rank = F.row_number().over(Window.partitionBy("flow", "category", "geo").orderBy("__moved", "__of", "__oc"))
    b = b.where("flow is not null and category is not null").withColumn("__k", rank)
    over = b.where("__k > 1").select(F.col("__of").alias("flow"), F.col("__oc").alias("category"), "geo", F.lit("deleted").alias("delta"))
    key = ["flow", "category", "geo"]
    j = b.where("__k = 1").select(*key, F.col("amount").alias("__was")).join(after.select(*key, F.col("amount").alias("__is")), key, "full")
    delta = F.when(F.col("__was").isNull(), "created").when(F.col("__is").isNull(), "deleted").when(F.col("__was") != F.col("__is"), "updated")
    return lost.unionAll(over).unionAll(j.select(*key, delta.alias("delta")).where("delta is not null"))


def provenance(changes: DataFrame) -> DataFrame:
    """(uuid, version, step, entity): every logged change as a version of its flow, numbered as it came."""
    n = F.row_number().over(Window.partitionBy("uuid").orderBy("change_index"))
    return changes.select("uuid", "step", n.alias("version")).withColumn("entity", F.concat_ws("#", "uuid", F.col("version").cast("string")))


def applied_pairs(changes: DataFrame) -> DataFrame:
    """(before, after, flows): renames folded to pairs."""
    return changes.where("field = 'pref'").groupBy("before", "after").agg(F.count_distinct("uuid").alias("flows"))


def unreachable_names(rows: DataFrame, objects: DataFrame) -> DataFrame:
    """(name, reaches, names): names of matched rows that reach one object while another is called so."""
    called = objects.select(canonical_label(F.col("pref")).alias("n"), F.col("object_id").alias("names"))
    j = rows.select("name", canonical_label(F.col("name")).alias("n"), F.col("object_id").alias("reaches")).join(called, "n").where("reaches <> names")
    return j.select("name", "reaches", "names").distinct()


def label_verdicts(pairs: DataFrame, registry: DataFrame) -> DataFrame:
    """(current, replacement, verdict): whether a registry knows the new name, the old one, both or neither."""
    known = registry.select(canonical_label(F.col("name")).alias("__k")).distinct()
    a, b = known.select(F.col("__k").alias("__a"), F.lit(True).alias("__ina")), known.select(F.col("__k").alias("__b"), F.lit(True).alias("__inb"))
    j = pairs.join(a, canonical_label(F.col("current")) == F.col("__a"), "left").join(b, canonical_label(F.col("replacement")) == F.col("__b"), "left")
    verdict = F.when(F.col("__ina") & F.col("__inb"), "both-known").when(F.col("__inb"), "better").when(F.col("__ina"), "worse").otherwise("neither")
    return j.select("current", "replacement", verdict.alias("verdict"))


def outcome_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(change, outcome_before, outcome_after, rows): what two builds decided about the same rows."""
    a = before.select("list", "uuid", F.col("outcome").alias("oa"), F.col("target").alias("ta"))
    b = after.select("list", "uuid", F.col("outcome").alias("ob"), F.col("target").alias("tb"))
    j = a.join(b, ["list", "uuid"], "full")
    change = F.when(F.col("oa").isNull(), "new").when(F.col("ob").isNull(), "gone").when(F.col("oa") != F.col("ob"), "outcome").when(~F.col("ta").eqNullSafe(F.col("tb")), "target").otherwise("same")
    return j.groupBy(change.alias("change"), F.coalesce("oa", F.lit("-")).alias("outcome_before"), F.coalesce("ob", F.lit("-")).alias("outcome_after")).agg(F.count(F.lit(1)).alias("rows"))


def list_differences(lists: DataFrame, key: str = "uuid", name: str = "list") -> DataFrame:
    """(lists, rows): how many rows each combination of lists has in common, and no other list has."""
    g = lists.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(name)), "+").alias("lists"))
    return g.groupBy("lists").agg(F.count(F.lit(1)).alias("rows"))


def identity_crossings(stated: DataFrame, facts: DataFrame) -> DataFrame:
    """(category, substances, numbers): numbers that several substances share within a category and context."""
    j = stated.where("amount <> 0").join(facts.select("flow", "substance", "context"), "flow")
    g = j.groupBy("category", "context", "amount").agg(F.count_distinct("substance").alias("substances")).where("substances > 1")
    return g.groupBy("category").agg(F.max("substances").alias("substances"), F.count(F.lit(1)).alias("numbers"))


def correspondence_audit(pairs: DataFrame, numbers: DataFrame) -> DataFrame:
    """(source, target): pairs of a correspondence whose ends both have registry numbers, none in common.
    ``numbers`` has (id, cas)."""
    a, b = numbers.select(F.col("id").alias("source"), F.col("cas").alias("__a")), numbers.select(F.col("id").alias("target"), F.col("cas").alias("__b"))
    j = pairs.join(a, "source").join(b, "target")
    return j.groupBy("source", "target").agg(F.count_if(F.col("__a") == F.col("__b")).alias("n")).where("n = 0").select("source", "target")


def case_survey(shipped: DataFrame, published: DataFrame) -> DataFrame:
    """(difference, rows): published against shipped names that fold alike."""
    j = shipped.join(published, "uuid").where(canonical_label(F.col("shipped")) == canonical_label(F.col("published")))
    kind = F.when(F.col("shipped") == F.col("published"), "same").when(F.lower("shipped") == F.lower("published"), "case").otherwise("spacing")
    return j.groupBy(kind.alias("difference")).agg(F.count(F.lit(1)).alias("rows"))


def source_rows(rows: DataFrame, selector: dict[str, str], links: DataFrame | None = None) -> DataFrame:
    """Rows that an expectation's selector is about: equal columns, and a link where it asks for one."""
    out = rows
    for column, value in selector.items():
        if column == "linked":
            out = out.join(links, "uuid", "left_semi" if value == "yes" else "left_anti")
        else:
            out = out.where(F.col(column) == value)
    return out


def agrees_as_stated(expected: Column, actual: Column) -> Column:
    """Whether a number agrees with a claim, written as a decimal, at the claim's own last figure."""
    places = F.length(F.regexp_extract(expected, r"^-?[0-9]+[.]?([0-9]*)$", 1))
    return F.coalesce(F.abs(actual - expected.try_cast("double")) <= 0.5 * F.pow(F.lit(10.0), -places.cast("double")) + 1e-12, F.lit(False))
