"""The tables behind review pages: filters, search, sorted pages, reports and overviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import canonical_label

PAGE = 50


def resolve_page(number: int, total: int, size: int = PAGE) -> int:
    """A page number that there is: at least the first, at most the last."""
    return min(max(1, number), max(1, -(-total // size)))


def order_by(sort: str, columns: dict[str, Column], default: str, last: Column) -> list[Column]:
    """The sort that a request names, with - for descending; one that isn't on the list is the default."""
    name = sort.removeprefix("-")
    c = columns.get(name, columns[default])
    return [c.desc_nulls_last() if sort.startswith("-") and name in columns else c.asc_nulls_first(), last]


def search_terms(query: str) -> list[tuple[str, bool]]:
    """Words of a query, lower-cased, and whether each is a prefix; signs that a search engine would read as
    its own language mean nothing."""
    words = "".join(c if c.isalnum() or c in " *" else " " for c in query.lower()).split()
    return [(w.strip("*"), w.endswith("*")) for w in words if w.strip("*")]


def search(tokens: DataFrame, key: str, query: str) -> DataFrame:
    """(key): rows whose tokens hold every term of a query. ``tokens`` has (key, token); each term is one
    filter of it, which a table sorted by token prunes, and the terms meet by key."""
    terms = search_terms(query)
    one = lambda t, prefix: tokens.where(F.col("token").startswith(t) if prefix else F.col("token") == t).select(key).distinct()
    return reduce(lambda a, b: a.join(b, key, "left_semi"), [one(*t) for t in terms]) if terms else tokens.select(key).distinct()


def token_table(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, token) of the words of some columns, each once."""
    whole = F.concat_ws(" ", *columns)
    return rows.select(key, F.explode(text.tokens(whole)).alias("token"))


def filtered(rows: DataFrame, filters: dict[str, str | list[str]]) -> DataFrame:
    """Rows that agree with all facets asked for; an empty one asks nothing."""
    for column, value in filters.items():
        wanted = [value] if isinstance(value, str) else list(value)
        if wanted and wanted != [""]:
            rows = rows.where(F.col(column).isin(*wanted))
    return rows


def exact_match(query: str, keys: DataFrame) -> DataFrame:
    """(object_id, by): objects that a whole query names by number, structure key or folded label. ``keys`` has
    (object_id, by, k)."""
    return keys.where((F.col("k") == query.strip()) | (F.col("k") == " ".join(query.lower().split()))).select("object_id", "by").distinct()


def duplicate_contexts(flows: DataFrame) -> DataFrame:
    """(object_id, context, flows): contexts that an object has several live flows in."""
    return flows.groupBy("object_id", "context").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("flow")), ",").alias("flows")).where("n > 1")


def self_duplicates(objects: DataFrame) -> DataFrame:
    """(object_id, numbers, labels, as_label): numbers and folded labels that an object has twice, and numbers
    that it has as a label; objects with none are left out."""
    fold = F.transform("alts", canonical_label)
    twice = lambda c: F.size(c) - F.size(F.array_distinct(c))
    both = F.size(F.array_intersect(F.transform("cas", F.lower), fold))
    return objects.select("object_id", twice(F.col("cas")).alias("numbers"), twice(fold).alias("labels"), both.alias("as_label")).where("numbers + labels + as_label > 0")


def activity_gaps(flows: DataFrame) -> DataFrame:
    """Flows in becquerel units whose object names no isotope."""
    unit = F.lower(F.trim("unit")).rlike(r"^(k|m|g|t)?(bq|becquerels?)$")
    return flows.where(unit & (F.coalesce(F.get_json_object("details", "$.isotope"), F.lit("")) == "")).select("flow", "unit")


def candidate_summaries(rows: DataFrame, top: int = 3) -> DataFrame:
    """(uuid, candidates, best, score): of the scored candidates that a row's JSON holds, how many there are and
    the best ones, in order."""
    kind = "array<struct<target:string,score:double>>"
    c = F.from_json("candidates", kind)
    best = F.slice(F.array_sort(F.transform(c, lambda x: F.struct((-x["score"]).alias("s"), x["target"].alias("t")))), 1, top)
    return rows.select("uuid", F.size(c).alias("candidates"), F.array_join(F.transform(best, lambda x: x["t"]), ",").alias("best"), F.array_max(F.transform(c, lambda x: x["score"])).alias("score"))


def distinct_json(rows: DataFrame, path: str, by: str) -> DataFrame:
    """(by, sources, rows): rows by how many different values their JSON list has under a path."""
    values = F.from_json(F.get_json_object("details", path), "array<string>")
    return rows.groupBy(by, F.size(F.array_distinct(values)).alias("sources")).agg(F.count(F.lit(1)).alias("rows"))


def forest(nodes: DataFrame, edges: DataFrame, counts: DataFrame) -> DataFrame:
    """(family, node, parent, n, place): nodes of a family under their parents in it, siblings by count and
    label; a node whose parent is of another family is a root."""
    from pyspark.sql import Window

    inside = edges.join(nodes.select(F.col("node").alias("parent"), F.col("family").alias("__pf")), "parent")
    n = nodes.join(inside, "node", "left").withColumn("parent", F.when(F.col("__pf") == F.col("family"), F.col("parent")))
    n = n.groupBy("family", "node", "label").agg(F.min("parent").alias("parent")).join(counts.select("node", "n"), "node", "left")
    place = F.row_number().over(Window.partitionBy("family", "parent").orderBy(F.desc(F.coalesce("n", F.lit(0))), "label", "node"))
    return n.select("family", "node", "parent", F.coalesce("n", F.lit(0)).alias("n"), place.alias("place"))


def rolled_up(nodes: DataFrame, flows: DataFrame) -> DataFrame:
    """(key, own, whole): flows of each class, and with those of its narrower classes; keys are paths."""
    own = flows.groupBy("key").agg(F.count(F.lit(1)).alias("own"))
    parts = F.split("key", "/")
    up = own.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("key"), "own").groupBy("key").agg(F.sum("own").alias("whole"))
    return nodes.join(own, "key", "left").join(up, "key", "left").select("key", F.coalesce("own", F.lit(0)).alias("own"), F.coalesce("whole", F.lit(0)).alias("whole"))


def compared_pair(rows: DataFrame, key: list[str], impl: str, amount: str, left: str, right: str) -> DataFrame:
    """(state, band, rows): two implementations side by side: shared keys by band, and keys of one alone."""
    from ..functions.numbers import band

    g = rows.where(F.col(impl).isin(left, right)).groupBy(*key).agg(F.max(F.when(F.col(impl) == left, F.col(amount))).alias("l"), F.max(F.when(F.col(impl) == right, F.col(amount))).alias("r"))
    state = F.when(F.col("r").isNull(), "left-only").when(F.col("l").isNull(), "right-only").when(F.col("l") == F.col("r"), "identical").otherwise("shared")
    both = band(F.least("l", "r"), F.greatest("l", "r"))
    return g.select(state.alias("state"), F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), both).alias("band")).groupBy("state", "band").agg(F.count(F.lit(1)).alias("rows"))


def tallies(parts: dict[str, DataFrame]) -> DataFrame:
    """(name, n): how many rows each of some tables has."""
    return reduce(DataFrame.unionAll, [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("name"), "n") for k, d in parts.items()])
