"""Grouping: survivors, collisions, contested keys, redirects, facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, shuffle_parts


def survivors(rows: DataFrame, signature: list[str], rank: list[Column], row: str) -> DataFrame:
    """(row, survivor, members): of rows with one signature the first by rank survives.

    ``rank`` is a list of columns of which smaller is better. The least struct is an aggregate, so a
    signature of any number of rows needs no sort in one task.
    """
    best = rows.groupBy(*signature).agg(F.min(F.struct(*[c.alias(f"r{n}") for n, c in enumerate(rank)], F.col(row).alias("s"))).alias("b"), F.count(F.lit(1)).alias("members"))
    # dealt anew, so that adaptive execution may split a signature that a large part of the rows has
    best = best.select(*signature, F.col("b.s").alias("survivor"), "members").repartition(shuffle_parts(rows))
    return rows.join(best, signature).select(F.col(row), "survivor", "members")


def collisions(rows: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Keys that several rows hold, with the fields on which these differ."""
    differ = [F.when(F.count_distinct(F.coalesce(F.col(f).cast("string"), F.lit("\0"))) > 1, F.lit(f)) for f in fields]
    g = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("members"), F.array_join(F.array_compact(F.array(*differ)), ",").alias("differing"))
    return g.where("members > 1")


def contested(claims: DataFrame, key: str, name: str) -> DataFrame:
    """Keys that more than one folded name claims."""
    return claims.groupBy(key).agg(F.count_distinct(name).alias("names"), F.min(name).alias("first_name"), F.max(name).alias("last_name")).where("names > 1")


def spread(rows: DataFrame, key: list[str], side: str, amount: str) -> DataFrame:
    """Relative spread of the positive amounts of keys that two sides or more state."""
    g = rows.where(F.col(amount) > 0).groupBy(*key).agg(F.count_distinct(side).alias("sides"), F.min(amount).alias("lo"), F.max(amount).alias("hi"))
    return g.where("sides > 1").withColumn("spread", F.col("hi") / F.col("lo") - 1)


def closure(edges: DataFrame, node: str, target: str) -> DataFrame:
    """(node, terminal, hops, status) of every chain of redirects, of any length.

    Pointers are doubled: after k rounds each row has walked 2 ** k steps, so that a chain of n needs
    log2(n) joins and no row carries a path. What still walks after more steps than there are edges goes
    round a cycle, and has no terminal.
    """
    step = cut(edges.select(F.col(node).alias("n"), F.col(target).alias("at"), F.lit(1).cast("long").alias("hops"), F.lit(True).alias("open")))
    rounds = step.count().bit_length() + 1
    for _ in range(rounds):
        on = step.select(F.col("n").alias("at"), F.col("at").alias("__at"), F.col("hops").alias("__hops"), F.col("open").alias("__open"))
        walked = step.where("open").join(on, "at", "left").select("n", F.coalesce("__at", "at").alias("at"), (F.col("hops") + F.coalesce("__hops", F.lit(0))).alias("hops"), F.coalesce("__open", F.lit(False)).alias("open"))
        step = cut(walked.unionAll(step.where("not open")))
        if step.where("open").isEmpty():
            break
    done = ~F.col("open")
    return step.select(F.col("n").alias(node), F.when(done, F.col("at")).alias("terminal"), F.when(done, F.col("hops")).alias("hops"), F.when(done, "resolved").otherwise("cycle").alias("status"))


def chosen_unit(rows: DataFrame, key: str, unit: str, published: DataFrame, reference: Column, order: Column) -> DataFrame:
    """Unit of a group: its only one, else the published one, else its sole reference unit, else the first."""
    g = rows.groupBy(key).agg(F.count_distinct(unit).alias("n"), F.min(unit).alias("one"), F.min_by(unit, order).alias("first"), F.count_distinct(F.when(reference, F.col(unit))).alias("refs"), F.min(F.when(reference, F.col(unit))).alias("ref"))
    g = g.join(published.select(key, F.col(unit).alias("pub")), key, "left")
    how = F.when(F.col("n") == 1, "single").when(F.col("pub").isNotNull(), "published").when(F.col("refs") == 1, "reference").otherwise("undecided")
    return g.select(key, F.when(F.col("n") == 1, F.col("one")).otherwise(F.coalesce("pub", F.when(F.col("refs") == 1, F.col("ref")), "first")).alias("unit"), how.alias("how"))


def facets(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n) of several columns in one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")
    return rows.select(pairs).select("p.*").groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def shared_labels(labels: DataFrame, label: str, owner: str) -> DataFrame:
    """Labels that more than one object carries."""
    return labels.groupBy(label).agg(F.count_distinct(owner).alias("owners"), F.count(F.lit(1)).alias("uses")).where("owners > 1")


def hoist(rows: DataFrame, owner: str, field: str, value: str) -> DataFrame:
    """(owner, field, value): what all rows of an owner agree on, so that it is stored once."""
    each = rows.groupBy(owner).agg(F.count_distinct("row").alias("rows"))
    g = rows.groupBy(owner, field).agg(F.count_distinct(value).alias("values"), F.count(F.lit(1)).alias("n"), F.min(value).alias(value))
    return g.join(each, owner).where("values = 1 AND n = rows").select(owner, field, value)


def page(rows: DataFrame, order: list[Column], number: int, size: int = 50) -> DataFrame:
    """One page of a totally ordered result."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def numbered(rows: DataFrame, by: list[str], order: list[Column], name: str = "version") -> DataFrame:
    """Running number within groups."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
