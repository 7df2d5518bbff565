"""Resolution: tiers, votes, rules and scored selection. A tie is never an answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def cascade(rows: DataFrame, key: str, tiers: list[tuple[str, DataFrame]]) -> DataFrame:
    """(key, target, basis, candidates): the first tier with a candidate decides; several ⇒ no target.

    Each tier is (basis, relation of (key, target)). Tiers are read together, so that a row needs
    one shuffle, not one for each tier.
    """
    found = None
    for n, (basis, pairs) in enumerate(tiers):
        part = pairs.select(F.col(key), F.col("target"), F.lit(n).alias("tier"), F.lit(basis).alias("basis"))
        found = part if found is None else found.unionAll(part)
    each = found.distinct().groupBy(key, "tier", "basis").agg(F.min("target").alias("target"), F.count(F.lit(1)).alias("candidates"))
    best = each.groupBy(key).agg(F.min(F.struct("tier", "basis", "candidates", "target")).alias("b")).select(key, "b.*")
    out = rows.select(key).join(best, key, "left")
    one = F.col("candidates") == 1
    return out.select(key, F.when(one, F.col("target")).alias("target"), F.coalesce(F.when(one, F.col("basis")), F.when(F.col("candidates") > 1, F.concat("basis", F.lit("-ambiguous"))), F.lit("none")).alias("basis"), F.coalesce("candidates", F.lit(0)).alias("candidates"))


def cascade_by_keys(rows: DataFrame, key: str, tiers: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """The result of ``cascade`` for tiers that are equal keys: (basis, (keys, target), key columns).

    Each tier's targets are first reduced to a count and the smallest for each key, so that no tier makes
    pairs: a key that many rows and many targets share costs their sum, not their product.
    """
    out, hits = rows, []
    for n, (_, targets, on) in enumerate(tiers):
        each = targets.groupBy(*on).agg(F.count_distinct("target").alias(f"__k{n}"), F.min("target").alias(f"__t{n}"))
        out = out.join(each, on, "left")
    for n, (basis, _, _) in enumerate(tiers):
        hits.append(F.when(F.col(f"__k{n}").isNotNull(), F.struct(F.col(f"__k{n}").alias("k"), F.col(f"__t{n}").alias("t"), F.lit(basis).alias("b"))))
    out = out.withColumn("__h", F.coalesce(*hits))
    one, many = F.col("__h.k") == 1, F.col("__h.k") > 1
    return out.select(key, F.when(one, F.col("__h.t")).alias("target"), F.when(one, F.col("__h.b")).when(many, F.concat("__h.b", F.lit("-ambiguous"))).otherwise("none").alias("basis"), F.coalesce("__h.k", F.lit(0)).alias("candidates"))


def quorum(votes: DataFrame, key: str, candidate: str, source: str, least: int = 2) -> DataFrame:
    """(key, winner, votes): the candidate of most distinct sources, at least ``least``, untied."""
    n = votes.groupBy(key, candidate).agg(F.count_distinct(source).alias("n"))
    top = n.groupBy(key).agg(F.max("n").alias("most"), F.max_by(candidate, "n").alias("first"))
    tied = n.join(top.select(F.col(key), F.col("most").alias("n")), [key, "n"]).groupBy(key).agg(F.count(F.lit(1)).alias("ties"))
    return top.join(tied, key).select(key, F.when((F.col("most") >= least) & (F.col("ties") == 1), F.col("first")).alias("winner"), F.col("most").alias("votes"))


def longest_prefix(rows: DataFrame, value: str, rules: DataFrame, prefix: str, answer: str, key: list[str]) -> DataFrame:
    """The answer of the longest rule prefix of each value; rules of equal length can't both match.

    Prefixes become an equi-join: each row tries the lengths that occur among the rules.
    """
    lengths = sorted(r[0] for r in rules.select(F.length(prefix)).distinct().collect())
    tries = rows.select(*key, value, F.explode(F.filter(F.transform(F.array(*map(F.lit, lengths)), lambda n: F.substring(F.col(value), F.lit(1), n)), lambda p: F.length(p) > 0)).alias("__p")).distinct()
    hit = tries.join(rules.select(F.col(prefix).alias("__p"), F.col(answer)), "__p").groupBy(*key).agg(F.max_by(answer, F.length("__p")).alias(answer), F.max(F.length("__p")).alias("prefix_length"))
    return rows.select(*key, value).join(hit, key, "left")


def overlay(base: DataFrame, override: DataFrame, key: list[str], value: str) -> DataFrame:
    """Curated rows over a table: an override replaces, a null override declines, new keys are added."""
    b, o = base.select(*key, F.col(value).alias("__b")), override.select(*key, F.col(value).alias("__o"), F.lit(True).alias("__has"))
    out = b.join(o, key, "full")
    origin = F.when(F.col("__has") & F.col("__b").isNull(), "added").when(F.col("__has") & F.col("__o").isNull(), "declined").when(F.col("__has"), "replaced").otherwise("kept")
    return out.select(*key, F.when(F.col("__has"), F.col("__o")).otherwise(F.col("__b")).alias(value), origin.alias("origin"))


def select_scored(candidates: DataFrame, key: str, target: str, score: Column, members: str | None = None) -> DataFrame:
    """(key, target, reason, score): the best candidate; a score of 0 or less or a tie is none.

    Candidates that no term of the score tells apart may come as one row, with their number in ``members``
    and the smallest of them as target.
    """
    c = candidates.select(key, target, score.alias("score"), (F.col(members) if members else F.lit(1)).alias("__m"))
    best = c.groupBy(key).agg(F.max("score").alias("top"))
    top = c.join(best, key).where("score = top").groupBy(key, "top").agg(F.min(target).alias("t"), F.sum("__m").alias("n"))
    reason = F.when(F.col("top") <= 0, "no-signal").when(F.col("n") > 1, "tied").otherwise("best-score")
    return top.select(key, F.when(reason == "best-score", F.col("t")).alias("target"), reason.alias("reason"), F.col("top").alias("score"))


def overlap_score(unit_equal: Column, words: Column, candidate_words: Column, same_context: Column) -> Column:
    """2 for the unit, 1 for each shared word, -1 for each word too many, 1 for the same context."""
    return 2 * unit_equal.cast("int") + F.size(F.array_intersect(words, candidate_words)) - F.size(F.array_except(candidate_words, words)) + same_context.cast("int")


def one_outcome(branches: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Union of branches; the first branch that holds a row gives its outcome."""
    out = None
    for n, (name, rows) in enumerate(branches):
        part = rows.select(key, F.lit(n).alias("__n"), F.lit(name).alias("outcome"))
        out = part if out is None else out.unionAll(part)
    return out.groupBy(key).agg(F.min(F.struct("__n", "outcome")).alias("o"), F.count(F.lit(1)).alias("branches")).select(key, "o.outcome", "branches")


def match_strength(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Strength of each distinct pair by how many partners its two ends have."""
    p = pairs.select(left, right).distinct()
    many = lambda c: F.count(F.lit(1)).over(Window.partitionBy(c)) > 1
    p = p.select(left, right, many(left).alias("__l"), many(right).alias("__r"))
    name = F.when(F.col("__l") & F.col("__r"), "related").when(F.col("__l"), "narrow").when(F.col("__r"), "broad").otherwise("exact")
    return p.select(left, right, name.alias("strength"))


def owners(keys: DataFrame, row: str, key: str) -> DataFrame:
    """(row, owner): the earliest row that holds a key of the row owns it; pointers are followed.

    Keys belong to their first holder. A row points to the smallest owner of its keys, and pointers,
    which always go to smaller rows, are doubled until none moves.
    """
    own = keys.groupBy(key).agg(F.min(row).alias("o"))
    step = keys.join(own, key).groupBy(row).agg(F.min("o").alias("owner"))
    while True:
        nxt = step.alias("a").join(step.select(F.col(row).alias("owner"), F.col("owner").alias("further")), "owner").select(row, F.col("further").alias("owner"))
        nxt = cut(nxt)
        moved = nxt.join(step.withColumnRenamed("owner", "was"), row).where("owner <> was").limit(1).count()
        step = nxt
        if not moved:
            return step
