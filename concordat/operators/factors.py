"""Numbers that several publishers state: settle, derive, carry, compare, score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import TOLERANCE, agrees, band, ratio


MOST_PLACES = 1_000


def settle(rows: DataFrame, key: list[str], amount: str) -> DataFrame:
    """One row for each key: equal, within tolerance, or a conflict that publishes nothing."""
    g = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("stated"), F.min(amount).alias("lo"), F.max(amount).alias("hi"))
    verdict = F.when(F.col("lo") == F.col("hi"), "equal").when(agrees(F.col("lo"), F.col("hi")), "within-tolerance").otherwise("conflict")
    return g.withColumn("verdict", verdict)


def settle_precise(rows: DataFrame, key: list[str], amount: str, order: list[str]) -> DataFrame:
    """(key, amount, superseded): the most precise of numbers that agree, by a left fold in order.

    The fold needs shortest decimal texts and isn't associative, so each group is folded in Python;
    a group holds the distinct statements about one key, and equal numbers meet before the shuffle.
    """
    from ..functions.numbers import more_precise

    few = rows.groupBy(*key, amount).agg(F.min(F.struct(*order)).alias("__o"))
    g = few.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("__o", F.col(amount).alias("x")))).alias("xs"))
    g = g.select(*key, F.transform("xs", lambda e: e["x"]).alias("xs"))

    def fold(it):
        for pdf in it:
            kept, lost = [], []
            for xs in pdf["xs"]:
                xs = [float(x) for x in xs]
                at = xs[0]
                for x in xs[1:]:
                    if at is None or (abs(max(at, x, key=abs)) / abs(min(at, x, key=abs)) - 1 > TOLERANCE if at and x and (at > 0) == (x > 0) else at != x):
                        at = None
                    else:
                        at = more_precise(at, x) or at
                kept.append(at)
                lost.append(len(xs) - 1)
            yield pdf.drop(columns="xs").assign(amount=kept, superseded=lost)

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in g.schema.fields[:-1])
    return g.mapInPandas(fold, f"{names}, amount double, superseded long")


def derive(rows: DataFrame, key: list[str], impl: str, amount: str, reference: str) -> DataFrame:
    """Consensus of several implementations: sole, agreed, or the question that stays."""
    g = rows.groupBy(*key).agg(F.count_distinct(impl).alias("speakers"), F.min(impl).alias("speaker"), F.min(amount).alias("lo"), F.max(amount).alias("hi"), F.max(F.when(F.col(impl) == reference, F.col(amount))).alias("ref"))
    two = F.col("speakers") >= 2
    how = F.when(~two & (F.col("speaker") == reference), "sole").when(~two, "proposed").when(agrees(F.col("lo"), F.col("hi")), "agreed").otherwise("contested")
    return g.select(*key, "speakers", "lo", "hi", how.alias("derivation"), F.when(how.isin("sole", "agreed"), F.coalesce("ref", "lo")).alias("amount"))


def restated(questions: DataFrame, published: DataFrame, group: list[str], place: str, amount: str) -> DataFrame:
    """Questions whose number the same substance publishes elsewhere within tolerance.

    The range condition becomes an equi-join on logarithmic buckets of the tolerance's width: twins
    are in the same bucket or in a neighbouring one.
    """
    import math

    width = math.log1p(TOLERANCE)
    bucket = lambda c: F.floor(F.log(F.abs(c)) / width)
    q = questions.where(F.col(amount) != 0).withColumn("__b", F.explode(F.array(*[bucket(F.col(amount)) + k for k in (-1, 0, 1)])))
    p = published.where(F.col(amount) != 0).select(*group, F.col(place).alias("__place"), F.col(amount).alias("__amount"), bucket(F.col(amount)).alias("__b"))
    twin = q.join(p, [*group, "__b"]).where((F.col(place) != F.col("__place")) & (ratio(F.col(amount), F.col("__amount")) - 1 <= TOLERANCE))
    return twin.groupBy(*group, place).agg(F.min("__place").alias("twin_place"), F.count(F.lit(1)).alias("twins"))


def differences(rows: DataFrame, key: list[str], impl: str, amount: str) -> DataFrame:
    """Long rows of keys that two implementations or more state, with their band."""
    g = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("impls"), F.min(amount).alias("lo"), F.max(amount).alias("hi")).where("impls > 1")
    g = g.withColumn("band", band(F.col("lo"), F.col("hi")))
    return rows.join(g, key).select(*key, impl, amount, "impls", "band")


def coverage_gaps(universe: DataFrame, covered: DataFrame, key: list[str]) -> DataFrame:
    """Keys that should be covered and aren't."""
    return universe.join(covered.select(*key).distinct(), key, "left_anti")


def census(rows: DataFrame, group: str, place: str, amount: str) -> DataFrame:
    """Ordered pairs of places within groups: both, agree; and blanks of the recipient."""
    one = rows.groupBy(group, place).agg(F.min(amount).alias("lo"), F.max(amount).alias("hi"))
    names = [r[0] for r in rows.select(place).where(F.col(place).isNotNull()).distinct().limit(MOST_PLACES + 1).collect()]
    if len(names) > MOST_PLACES:
        raise ValueError(f"more than {MOST_PLACES} places: a census is over a closed vocabulary")
    donors = one.select(group, F.col(place).alias("donor"), F.col("lo").alias("dl"), F.col("hi").alias("dh"))
    pairs = donors.withColumn("recipient", F.explode(F.array(*map(F.lit, sorted(names))))).where("donor <> recipient")
    out = pairs.join(one.select(group, F.col(place).alias("recipient"), F.col("lo").alias("rl"), F.col("hi").alias("rh")), [group, "recipient"], "left")
    both = F.col("rl").isNotNull()
    return out.groupBy("donor", "recipient").agg(F.count_if(~both).alias("blanks"), F.count_if(both).alias("both"), F.count_if(both & agrees(F.least("dl", "rl"), F.greatest("dh", "rh"))).alias("agree"))


def carry(published: DataFrame, blanks: DataFrame, rules: DataFrame, group: str, place: str, amount: str) -> DataFrame:
    """Blanks filled from the first donor of their rules that published a number; carried numbers
    are read from the state before, so that they never chain."""
    d = blanks.join(rules.select(F.col("recipient").alias(place), "donor", "ordinal"), place)
    hit = d.join(published.select(group, F.col(place).alias("donor"), amount), [group, "donor"])
    return hit.groupBy(group, place).agg(F.min_by(F.struct("donor", amount), "ordinal").alias("b")).select(group, place, "b.*")


def score(inventory: DataFrame, theirs: DataFrame, ours: DataFrame, process: str, flow: str, amount: str) -> DataFrame:
    """Contribution lines of both factor sets, with one of six reasons; lines with neither are dropped."""
    x = inventory.join(theirs.select(flow, F.col("factor").alias("f1")), flow, "left").join(ours.select(flow, F.col("factor").alias("f2"), F.col("mapped"), F.col("convertible")), flow, "left")
    a, b = F.col(amount) * F.col("f1"), F.col(amount) * F.col("f2")
    has1, has2 = F.col("f1").isNotNull(), F.col("f2").isNotNull()
    reason = F.when(~F.coalesce("mapped", F.lit(False)), "unmapped-flow").when(~F.coalesce("convertible", F.lit(True)), "unit-crossing-unconverted").when(~has1, "only-ours").when(~has2, "no-consensus").when(agrees(F.least(a, b), F.greatest(a, b)), "agree").otherwise("differs")
    return x.where(has1 | has2).select(process, flow, F.coalesce(a, F.lit(0.0)).alias("theirs"), F.coalesce(F.when(reason.isin("unmapped-flow", "unit-crossing-unconverted"), 0.0).otherwise(b), F.lit(0.0)).alias("ours"), reason.alias("reason"))


def contradictions(rows: DataFrame, model: DataFrame, group: str, place: str, amount: str, least: int = 4, far: float = 100.0) -> DataFrame:
    """Groups of which every one of ``least`` comparable places or more is over ``far`` off the model."""
    j = rows.select(group, place, amount).join(model.select(group, place, F.col(amount).alias("__m")), [group, place])
    r = ratio(F.least(F.col(amount), F.col("__m")), F.greatest(F.col(amount), F.col("__m")))
    g = j.withColumn("r", r).where("r IS NOT NULL").groupBy(group).agg(F.count(F.lit(1)).alias("places"), F.min("r").alias("least_ratio"))
    return g.where((F.col("places") >= least) & (F.col("least_ratio") > far))
