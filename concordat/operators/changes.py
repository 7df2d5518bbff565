"""Change data: rule chains with a log, release diffs and their replay, fates, assessment."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_chain(rows: DataFrame, steps: list[tuple[str, dict[str, Column]]], key: str) -> tuple[DataFrame, DataFrame]:
    """Ordered steps of field updates; rows marked ``finished`` are visible but not writable.

    Returns the rows after all steps and the log (key, step_no, step, field, before, after). All
    steps are projections of one scan; the log is unpivoted from values kept beside each other.
    """
    logs = []
    finished = F.coalesce(F.col("finished"), F.lit(False)) if "finished" in rows.columns else F.lit(False)
    df = rows
    for n, (step, updates) in enumerate(steps):
        for field, value in updates.items():
            mark = f"__{n}_{field}"
            df = df.withColumn(mark, F.col(field)).withColumn(field, F.when(finished, F.col(field)).otherwise(value))
            after = f"__{n}_{field}_after"
            df = df.withColumn(after, F.col(field))
            logs.append(F.struct(F.lit(n).alias("step_no"), F.lit(step).alias("step"), F.lit(field).alias("field"), F.col(mark).cast("string").alias("before"), F.col(after).cast("string").alias("after")))
    log = df.select(key, F.explode(F.array(*logs)).alias("c")).select(key, "c.*").where(~F.col("before").eqNullSafe(F.col("after")))
    return df.select(*rows.columns), log


def diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, delta, fields): created, updated with the changed fields, deleted."""
    a = before.select(key, F.struct(*fields).alias("a"))
    b = after.select(key, F.struct(*fields).alias("b"))
    changed = F.array_compact(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]))
    j = a.join(b, key, "full")
    delta = F.when(F.col("a").isNull(), "created").when(F.col("b").isNull(), "deleted").when(F.size(changed) > 0, "updated")
    return j.select(key, delta.alias("delta"), F.when(delta == "updated", F.array_join(changed, ",")).otherwise("").alias("fields"), F.col("b").alias("new")).where("delta IS NOT NULL")


def replay(before: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The release that a diff makes of the one before."""
    j = before.select(key, F.struct(*fields).alias("old")).join(changes.select(key, "delta", "new"), key, "full").where("delta IS NULL OR delta <> 'deleted'")
    return j.withColumn("row", F.coalesce("new", "old")).select(key, *[F.col(f"row.{f}").alias(f) for f in fields])


def fates(vanished: DataFrame, redirects: DataFrame, links: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """(key, fate, target): replaced, deleted or unresolved, by redirect or else by source rows.

    ``vanished`` has (key, unit), ``redirects`` (key, target), ``links`` (key, source_row, target),
    ``live`` (target, target_unit).
    """
    r = redirects.join(live, "target").select(key, F.col("target").alias("r_target"), F.col("target_unit").alias("r_unit"))
    s = links.join(live, "target", "left").groupBy(key).agg(F.count_distinct(F.when(F.col("target_unit").isNotNull(), F.col("target"))).alias("n"), F.min(F.when(F.col("target_unit").isNotNull(), F.col("target"))).alias("s_target"), F.min("target_unit").alias("s_unit"))
    j = vanished.join(r, key, "left").join(s, key, "left")
    n, same = F.col("n"), F.col("s_unit") == F.col("unit")
    fate = F.when(F.col("r_target").isNotNull(), "replaced").when(n.isNull(), "unresolved").when(n == 0, "deleted").when((n > 1) | ~same, "unresolved").otherwise("replaced")
    return j.select(key, fate.alias("fate"), F.when(fate == "replaced", F.coalesce("r_target", "s_target")).alias("target"))


def assess(measures: DataFrame, expectations: list[tuple[str, str, str, float]]) -> DataFrame:
    """(id, measure, value, verdict): bounds over named measures; an unknown bound or measure is unresolved."""
    e = measures.sparkSession.createDataFrame(expectations, "id string, measure string, bound string, wanted double")
    j = e.join(measures, "measure", "left")
    held = F.when(F.col("bound") == "equals", F.col("value") == F.col("wanted")).when(F.col("bound") == "at_most", F.col("value") <= F.col("wanted")).when(F.col("bound") == "at_least", F.col("value") >= F.col("wanted"))
    return j.select("id", "measure", "value", F.when(held.isNull(), "unresolved").when(held, "met").otherwise("unmet").alias("verdict"))


def drift(baseline: DataFrame, now: DataFrame, better: dict[str, str] | None = None) -> DataFrame:
    """(measure, change): improved, regressed, moved, same, new, gone."""
    j = baseline.select("measure", F.col("value").alias("was")).join(now.select("measure", F.col("value").alias("is")), "measure", "full")
    up = F.col("measure").isin([m for m, d in (better or {}).items() if d == "up"])
    down = F.col("measure").isin([m for m, d in (better or {}).items() if d == "down"])
    rise = F.col("is") > F.col("was")
    change = F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "gone").when(F.col("was") == F.col("is"), "same").when((up & rise) | (down & ~rise), "improved").when(up | down, "regressed").otherwise("moved")
    return j.select("measure", "was", "is", change.alias("change"))


def orphans(child: DataFrame, parent: DataFrame, pairs: list[tuple[str, str]], name: str) -> DataFrame:
    """(gate, orphans): rows of the child without a parent, as one row."""
    on = [child[a] == parent[b] for a, b in pairs]
    return child.join(parent, on, "left_anti").agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("gate"), "orphans")


def refuse(rows: DataFrame, message: str) -> None:
    """Gate: raises if any row is there."""
    if found := rows.limit(5).collect():
        raise ValueError(f"{message}: {[tuple(r) for r in found]}")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, rows) of what either of two tables has alone, repeats counted."""
    one = lambda x, y, s: x.exceptAll(y).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(s).alias("side"), "rows")
    return one(a, b, "only-left").unionAll(one(b, a, "only-right"))


