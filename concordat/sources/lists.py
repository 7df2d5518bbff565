"""Lists as publishers write them: base lists, process exports, registries, published documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks, names
from ..functions.text import canonical_label
from .formats import xml_rows

PROPERTY = "flowPropertiesInformation struct<dataSetInformation:struct<UUID:string,name:string>,quantitativeReference:struct<referenceToReferenceUnitGroup:struct<_refObjectId:string>>>"
UNIT_GROUP = "unitGroupInformation struct<dataSetInformation:struct<UUID:string>,quantitativeReference:struct<referenceToReferenceUnit:string>>, units struct<unit:array<struct<_dataSetInternalID:string,name:string,meanValue:double>>>"
FLOW = "flowInformation struct<dataSetInformation:struct<UUID:string,name:struct<baseName:string>,synonyms:string,CASNumber:string,generalComment:string>,quantitativeReference:struct<referenceToReferenceFlowProperty:string>>, flowProperties struct<flowProperty:array<struct<_dataSetInternalID:string,referenceToFlowPropertyDataSet:struct<_refObjectId:string>,meanValue:double>>>"


def reference_units(spark: SparkSession, properties: str, groups: str) -> DataFrame:
    """(property, name, unit): each flow property's reference unit, by way of its unit group."""
    p = xml_rows(spark, properties, "flowPropertyDataSet", PROPERTY).select(F.col("flowPropertiesInformation.dataSetInformation.UUID").alias("property"), F.col("flowPropertiesInformation.dataSetInformation.name").alias("name"), F.col("flowPropertiesInformation.quantitativeReference.referenceToReferenceUnitGroup._refObjectId").alias("grp"))
    g = xml_rows(spark, groups, "unitGroupDataSet", UNIT_GROUP).select(F.col("unitGroupInformation.dataSetInformation.UUID").alias("grp"), F.col("unitGroupInformation.quantitativeReference.referenceToReferenceUnit").alias("ref"), F.explode("units.unit").alias("u"))
    return p.join(g.where("u._dataSetInternalID = ref").select("grp", F.col("u.name").alias("unit")), "grp", "left").select("property", "name", "unit")


def comment_or_none(c: Column) -> Column:
    """A general comment, null where it only names a version."""
    return F.when(~F.coalesce(F.trim(c).rlike(r"(?i)^(data ?set )?version:? ?[0-9.]+$"), F.lit(False)) & (F.length(F.trim(c)) > 0), F.trim(c))


def base_flows(spark: SparkSession, flows: str) -> DataFrame:
    """(uuid, name, synonyms, cas, comment, properties): the flows of a base list; synonyms are split at ;"""
    i = "flowInformation.dataSetInformation"
    x = xml_rows(spark, flows, "flowDataSet", FLOW)
    cas = checks.normalize_cas(F.trim(F.col(f"{i}.CASNumber")))
    synonyms = F.filter(F.transform(F.split(F.coalesce(F.col(f"{i}.synonyms"), F.lit("")), ";"), lambda x: F.trim(x)), lambda s: s != "")
    return x.select(F.col(f"{i}.UUID").alias("uuid"), F.trim(F.col(f"{i}.name.baseName")).alias("name"), synonyms.alias("synonyms"), F.when(F.length(cas) > 0, cas).alias("cas"), comment_or_none(F.col(f"{i}.generalComment")).alias("comment"), F.col("flowInformation.quantitativeReference.referenceToReferenceFlowProperty").alias("reference"), F.col("flowProperties.flowProperty").alias("properties"))


def flow_units(flows: DataFrame, units: DataFrame) -> DataFrame:
    """(uuid, unit): flow to reference property to unit group to reference unit."""
    p = flows.select("uuid", "reference", F.explode("properties").alias("p")).where("p._dataSetInternalID = reference")
    return flows.select("uuid").join(p.select("uuid", F.col("p.referenceToFlowPropertyDataSet._refObjectId").alias("property")).join(units, "property").select("uuid", "unit"), "uuid", "left")


def property_values(flows: DataFrame, units: DataFrame) -> DataFrame:
    """(uuid, property, value, unit) of every property that a flow has a number of."""
    p = flows.select("uuid", F.explode("properties").alias("p")).select("uuid", F.col("p.referenceToFlowPropertyDataSet._refObjectId").alias("id"), F.col("p.meanValue").alias("value"))
    return p.join(units.select(F.col("property").alias("id"), F.col("name").alias("property"), "unit"), "id").where("value is not null").select("uuid", "property", "value", "unit")


def without_conflicting_synonyms(flows: DataFrame, category: str = "category") -> DataFrame:
    """(uuid, synonyms): synonyms in order, without those that are another flow's name in the same category."""
    each = flows.select("uuid", category, F.posexplode("synonyms").alias("at", "s")).withColumn("n", canonical_label(F.col("s")))
    own = flows.select(F.col("uuid").alias("other"), category, canonical_label(F.col("name")).alias("n"))
    bad = each.join(own, [category, "n"]).where("other <> uuid").select("uuid", "at").distinct()
    kept = each.join(bad, ["uuid", "at"], "left_anti").groupBy("uuid").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "s"))), lambda x: x["s"]).alias("synonyms"))
    return flows.select("uuid").join(kept, "uuid", "left").select("uuid", F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"))


def exchanged_flows(exchanges: DataFrame) -> DataFrame:
    """(uuid, name, context, unit, cas): the distinct flows of process exchanges, with minted ids and all numbers
    that any exchange gives them."""
    g = exchanges.groupBy("name", "compartment", "subcompartment", "unit").agg(F.array_sort(F.collect_set("cas")).alias("cas"))
    basis = (canonical_label(F.col("name")), F.coalesce("compartment", F.lit("")), F.coalesce("subcompartment", F.lit("")), F.coalesce("unit", F.lit("")))
    return g.select(names.stable_id("flow", *basis).alias("uuid"), "name", F.array_compact(F.array("compartment", "subcompartment")).alias("context"), "unit", "cas")


def substance_comment(c: Column) -> Column:
    """Synonyms and the rest of a free-text comment: what follows ``Synonyms:`` up to the line's end, split at ;"""
    found = F.regexp_extract(c, r"(?im)^\s*synonyms?\s*:\s*(.*)$", 1)
    rest = F.regexp_replace(F.regexp_replace(c, r"(?im)^\s*synonyms?\s*:.*$", ""), r"^\s+|\s+$", "")
    return F.struct(F.filter(F.transform(F.split(found, ";"), lambda x: F.trim(x)), lambda s: s != "").alias("synonyms"), F.when(F.length(rest) > 0, rest).alias("rest"))


def with_geography(flows: DataFrame, codes: DataFrame) -> DataFrame:
    """(uuid, base, code): names split from a place, where both the code and the name without it are known."""
    p = flows.select("uuid", "name", names.geography_suffix(F.col("name")).alias("p"))
    known = flows.select(canonical_label(F.col("name")).alias("__n")).distinct()
    hit = p.where("p is not null").select("uuid", F.col("p.base").alias("base"), F.col("p.code").alias("code")).join(codes.select("code"), "code").join(known, canonical_label(F.col("base")) == F.col("__n"), "left_semi")
    return flows.select("uuid", "name").join(hit, "uuid", "left").select("uuid", F.coalesce("base", "name").alias("base"), "code")


def registry_index(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Inverted indexes of a registry: (cas, entry) and (folded name, entry), from entries with their numbers,
    label and synonyms."""
    by_cas = entries.select("entry", F.explode("cas").alias("cas")).distinct()
    label = F.concat(F.array("label"), F.coalesce("synonyms", F.array().cast("array<string>")))
    return by_cas, entries.select("entry", F.explode(F.transform(label, canonical_label)).alias("n")).distinct()


def best_attested(identifiers: DataFrame, weak: str) -> DataFrame:
    """Identifiers (id, value, source) without those that only the weak source has, where the id has others."""
    g = identifiers.groupBy("id", "value").agg(F.bool_and(F.col("source") == weak).alias("w"))
    some = g.groupBy("id").agg(F.bool_or(~F.col("w")).alias("strong"))
    return g.join(some, "id").where("not w or not strong").select("id", "value")


def identifier_sections(pages: DataFrame) -> DataFrame:
    """(id, heading, value): identifiers in the nested sections of a registry's page, whatever their depth."""
    kind = "struct<Section:array<struct<TOCHeading:string,Section:array<struct<TOCHeading:string,Information:array<struct<Value:string>>>>>>>"
    x = pages.select("id", F.explode(F.from_json("page", kind)["Section"]).alias("s")).select("id", F.explode("s.Section").alias("t"))
    return x.select("id", F.col("t.TOCHeading").alias("heading"), F.explode("t.Information.Value").alias("value"))


def merge_order(lists: DataFrame) -> DataFrame:
    """(list, version, place): lists by priority, then version, whose parts compare as numbers."""
    parts = F.transform(F.split("version", r"[.]"), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    from pyspark.sql import Window

    return lists.select("list", "version", F.row_number().over(Window.orderBy("priority", parts, "list")).alias("place"))  # some dozen lists


def coerced(records: DataFrame, singular: dict[str, str]) -> DataFrame:
    """Records whose singular fields became the arrays that they should be."""
    out = records
    for one, many in singular.items():
        out = out.withColumn(many, F.when(F.size(F.coalesce(many, F.array().cast("array<string>"))) > 0, F.col(many)).when(F.length(F.trim(one)) > 0, F.array(F.trim(one))).otherwise(F.array().cast("array<string>"))).drop(one)
    return out


def with_shared(flows: DataFrame, shared: DataFrame) -> DataFrame:
    """Flow payloads with what their object holds for all of its flows; a flow's own value wins."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    j = flows.join(shared.select("object_id", F.col("payload").alias("__s")), "object_id", "left")
    own = F.coalesce("payload", empty)
    rest = F.map_filter(F.coalesce("__s", empty), lambda k, _: ~F.map_contains_key(own, k))
    return j.withColumn("payload", F.map_concat(rest, own)).drop("__s")


def source_contexts(links: DataFrame) -> DataFrame:
    """(flow, list, contexts): the context paths that each list gave a flow."""
    return links.groupBy("flow", "list").agg(F.array_sort(F.collect_set(F.array_join("context", " / "))).alias("contexts"))


def simple_export(flows: DataFrame, objects: DataFrame) -> DataFrame:
    """(flow, document): published flows as JSON, null fields left out."""
    j = flows.join(objects.select("object_id", "pref", "cas"), "object_id")
    return j.select("flow", F.to_json(F.struct("flow", F.col("pref").alias("name"), "cas", "iri", "unit"), {"ignoreNullFields": "true"}).alias("document"))


def migration_package(diff: DataFrame, delta: str) -> DataFrame:
    """(verb, entry): one package of a migration, as JSON entries."""
    verb = {"created": "create", "updated": "update", "replaced": "replace", "deleted": "delete"}[delta]
    return diff.where(F.col("delta") == delta).select(F.lit(verb).alias("verb"), F.to_json(F.struct(*[c for c in diff.columns if c != "delta"])).alias("entry"))
