"""One query for each operator family over the star schema, and DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import checks, names, numbers, text, units
from ..operators import changes, factors, groups, match
from ..session import shared_folder
from ..sources.tables import table
from ..streaming import incremental
from .registry import query

BAND = """CASE WHEN lo = hi THEN 'identical' WHEN lo = 0 OR hi = 0 OR (lo > 0) <> (hi > 0) THEN 'incomparable'
    WHEN greatest(abs(lo), abs(hi)) / least(abs(lo), abs(hi)) - 1 <= 0.02 THEN 'within-tolerance'
    WHEN greatest(abs(lo), abs(hi)) / least(abs(lo), abs(hi)) <= 2 THEN '2x'
    WHEN greatest(abs(lo), abs(hi)) / least(abs(lo), abs(hi)) <= 10 THEN '10x'
    WHEN greatest(abs(lo), abs(hi)) / least(abs(lo), abs(hi)) <= 100 THEN '100x' ELSE 'over-100x' END"""
AGREE = "(CASE WHEN lo = hi THEN true WHEN lo = 0 OR hi = 0 OR (lo > 0) <> (hi > 0) THEN false ELSE greatest(abs(lo), abs(hi)) / least(abs(lo), abs(hi)) - 1 <= 0.02 END)"


def money(c: str):
    """Exact sums of amounts with two decimals."""
    return F.col(c).cast("decimal(18,2)")


# --- scoring and comparison ------------------------------------------------------------------


def _order_scores(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    j = lines.join(parts, lines.l_partkey == parts.p_partkey)
    theirs = F.sum(F.col("l_quantity").cast("decimal(12,2)") * F.col("p_retailprice").cast("decimal(12,2)"))
    return j.groupBy("l_orderkey").agg(theirs.cast("double").alias("theirs"), F.sum(money("l_extendedprice")).cast("double").alias("ours"))


@query(f"""
    WITH s AS (SELECT l_orderkey, sum(l_quantity::DECIMAL(12,2) * p_retailprice::DECIMAL(12,2))::DOUBLE AS theirs, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS ours
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
         b AS (SELECT *, least(theirs, ours) AS lo, greatest(theirs, ours) AS hi FROM s)
    SELECT l_orderkey, round(theirs, 2) AS theirs, round(ours, 2) AS ours, round(ours / theirs, 6) AS ratio, {BAND} AS band FROM b
""")
def score_compare(spark, sf):
    """Two scores of each order, their ratio and band."""
    s = _order_scores(spark, sf)
    lo, hi = F.least("theirs", "ours"), F.greatest("theirs", "ours")
    return s.select("l_orderkey", F.round("theirs", 2).alias("theirs"), F.round("ours", 2).alias("ours"), F.round(F.col("ours") / F.col("theirs"), 6).alias("ratio"), numbers.band(lo, hi).alias("band"))


@query("""
    WITH d AS (SELECT l_partkey, sum(abs(l_quantity::DECIMAL(12,2) * p_retailprice::DECIMAL(12,2) - l_extendedprice::DECIMAL(18,2))) AS delta, count(DISTINCT l_orderkey) AS datasets
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
    SELECT l_partkey, delta::DOUBLE AS delta, datasets, round(delta::DOUBLE / (SELECT sum(delta) FROM d)::DOUBLE, 9) AS share
    FROM d ORDER BY delta DESC, l_partkey LIMIT 50
""")
def flow_priorities(spark, sf):
    """The 50 parts that hold most of the difference between both scores: a top-k report."""
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    gap = F.abs(F.col("l_quantity").cast("decimal(12,2)") * F.col("p_retailprice").cast("decimal(12,2)") - money("l_extendedprice"))
    d = lines.join(parts, lines.l_partkey == parts.p_partkey).groupBy("l_partkey").agg(F.sum(gap).alias("delta"), F.count_distinct("l_orderkey").alias("datasets"))
    whole = d.agg(F.sum("delta").alias("whole"))
    d = d.crossJoin(whole)  # one row
    return d.select("l_partkey", F.col("delta").cast("double").alias("delta"), "datasets", F.round(F.col("delta").cast("double") / F.col("whole").cast("double"), 9).alias("share")).orderBy(F.desc("delta"), "l_partkey").limit(50)


CONTRIB = f"""
    WITH t AS (SELECT p_partkey AS part, p_retailprice AS f1 FROM part WHERE p_size <= 40),
         o AS (SELECT p_partkey AS part, CASE WHEN p_size % 5 <> 0 THEN p_retailprice * (1 + (p_size % 3) * 0.015) END AS f2, p_size % 7 <> 0 AS mapped, p_size % 11 <> 0 AS convertible FROM part WHERE p_size >= 3),
         x AS (SELECT l_orderkey, l_partkey AS part, l_quantity * f1 AS a, l_quantity * f2 AS b, f1, f2, mapped, convertible
               FROM lineitem LEFT JOIN t ON l_partkey = t.part LEFT JOIN o ON l_partkey = o.part WHERE f1 IS NOT NULL OR f2 IS NOT NULL),
         r AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM x),
         y AS (SELECT *, CASE WHEN NOT coalesce(mapped, false) THEN 'unmapped-flow' WHEN NOT coalesce(convertible, true) THEN 'unit-crossing-unconverted'
                    WHEN f1 IS NULL THEN 'only-ours' WHEN f2 IS NULL THEN 'no-consensus' WHEN {AGREE} THEN 'agree' ELSE 'differs' END AS reason FROM r)
"""


@query(CONTRIB + "SELECT reason, count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders, round(sum(coalesce(a, 0)) / 1000, 2) AS theirs_k FROM y GROUP BY reason")
def contributions(spark, sf):
    """Inventory by two factor sets: lines by reason."""
    part = table(spark, sf, "part")
    theirs = part.where("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("factor"))
    ours = part.where("p_size >= 3").select(F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice") * (1 + (F.col("p_size") % 3) * F.lit(0.015))).alias("factor"), (F.col("p_size") % 7 != 0).alias("mapped"), (F.col("p_size") % 11 != 0).alias("convertible"))
    s = factors.score(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), theirs, ours, "l_orderkey", "l_partkey", "l_quantity")
    return s.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_orderkey").alias("n_orders"), F.round(F.sum("theirs") / 1000, 2).alias("theirs_k"))


def _impl_prices(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey", "l_returnflag", "l_linestatus").agg((F.sum(money("l_extendedprice")).cast("double") / F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double")).alias("amount"))


PRICES = "p AS (SELECT l_partkey, l_returnflag, l_linestatus, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / sum(l_quantity::DECIMAL(12,2))::DOUBLE AS amount FROM lineitem GROUP BY 1, 2, 3)"
DERIVED = f"""d AS (SELECT l_partkey, l_returnflag, count(DISTINCT l_linestatus) AS speakers, min(l_linestatus) AS speaker, min(amount) AS lo, max(amount) AS hi, max(CASE WHEN l_linestatus = 'O' THEN amount END) AS ref FROM p GROUP BY 1, 2),
    e AS (SELECT l_partkey, l_returnflag, speakers, lo, hi, ref, CASE WHEN speakers < 2 AND speaker = 'O' THEN 'sole' WHEN speakers < 2 THEN 'proposed' WHEN {AGREE} THEN 'agreed' ELSE 'contested' END AS derivation FROM d)"""


@query(f"WITH {PRICES}, {DERIVED} SELECT l_partkey, l_returnflag, speakers, lo, hi, derivation, CASE WHEN derivation IN ('sole', 'agreed') THEN coalesce(ref, lo) END AS amount FROM e")
def consensus_derive(spark, sf):
    """Consensus of two line states over the unit price of each part and return flag."""
    return factors.derive(_impl_prices(spark, sf), ["l_partkey", "l_returnflag"], "l_linestatus", "amount", "O")


@query(f"""WITH {PRICES}, {DERIVED}, q AS (SELECT l_partkey, l_returnflag, lo AS amount FROM e WHERE derivation IN ('contested', 'proposed') AND lo <> 0),
    b AS (SELECT l_partkey, l_returnflag, coalesce(ref, lo) AS amount FROM e WHERE derivation IN ('sole', 'agreed') AND lo <> 0)
    SELECT q.l_partkey, q.l_returnflag, min(b.l_returnflag) AS twin_place, count(*) AS twins FROM q JOIN b ON q.l_partkey = b.l_partkey AND q.l_returnflag <> b.l_returnflag
    AND greatest(q.amount, b.amount) / least(q.amount, b.amount) - 1 <= 0.02 GROUP BY 1, 2""")
def restated(spark, sf):
    """Open questions whose number the same part publishes under another flag."""
    d = consensus_derive(spark, sf)
    open_ = d.where(F.col("derivation").isin("contested", "proposed")).select("l_partkey", "l_returnflag", F.col("lo").alias("amount"))
    return factors.restated(open_, d.where(F.col("derivation").isin("sole", "agreed")).select("l_partkey", "l_returnflag", "amount"), ["l_partkey"], "l_returnflag", "amount")


@query(f"WITH {PRICES}, g AS (SELECT l_partkey, l_returnflag, count(*) AS impls, min(amount) AS lo, max(amount) AS hi FROM p GROUP BY 1, 2 HAVING count(*) > 1) SELECT l_partkey, l_returnflag, l_linestatus, amount, impls, {BAND} AS band FROM p JOIN g USING (l_partkey, l_returnflag)")
def differences_long(spark, sf):
    """Long rows of keys with two implementations, with the band of their extremes."""
    return factors.differences(_impl_prices(spark, sf), ["l_partkey", "l_returnflag"], "l_linestatus", "amount")


@query("""WITH u AS (SELECT c_custkey, c_mktsegment, p FROM customer, (SELECT DISTINCT o_orderpriority AS p FROM orders)),
    g AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = p))
    SELECT c_mktsegment AS segment, p AS priority, count(*) AS missing FROM g GROUP BY 1, 2""")
def coverage_gaps(spark, sf):
    """Customer and priority pairs without an order, by segment and priority."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    priorities = [r[0] for r in orders.select("o_orderpriority").distinct().collect()]  # a closed vocabulary
    universe = customers.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.explode(F.array(*map(F.lit, sorted(priorities)))).alias("o_orderpriority"))
    gaps = factors.coverage_gaps(universe, orders, ["o_custkey", "o_orderpriority"])
    return gaps.groupBy(F.col("c_mktsegment").alias("segment"), F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("missing"))


@query("""WITH o AS (SELECT o_custkey AS c, o_orderpriority AS p, min(o_totalprice) AS l, max(o_totalprice) AS h FROM orders GROUP BY 1, 2),
    d AS (SELECT o.c, o.p AS donor, q.p AS recipient, o.l AS dl, o.h AS dh FROM o, (SELECT DISTINCT p FROM o) q WHERE o.p <> q.p),
    j AS (SELECT d.*, r.l AS rl, least(dl, r.l) AS lo, greatest(dh, r.h) AS hi FROM d LEFT JOIN o r ON d.c = r.c AND d.recipient = r.p)
    SELECT donor, recipient, count(*) FILTER (rl IS NULL) AS blanks, count(*) FILTER (rl IS NOT NULL) AS "both", count(*) FILTER (rl IS NOT NULL AND """ + AGREE + ") AS agree FROM j GROUP BY 1, 2")
def census_pairs(spark, sf):
    """Ordered pairs of priorities within customers: blanks, both, agreement."""
    return factors.census(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_totalprice")


RULES = [("3-MEDIUM", "2-HIGH", 0), ("3-MEDIUM", "4-NOT SPECIFIED", 1), ("2-HIGH", "1-URGENT", 0), ("5-LOW", "4-NOT SPECIFIED", 0), ("5-LOW", "3-MEDIUM", 1)]


@query("""WITH r(place, donor, ord) AS (VALUES ('3-MEDIUM', '2-HIGH', 0), ('3-MEDIUM', '4-NOT SPECIFIED', 1), ('2-HIGH', '1-URGENT', 0), ('5-LOW', '4-NOT SPECIFIED', 0), ('5-LOW', '3-MEDIUM', 1)),
    p AS (SELECT o_custkey, o_orderpriority, max(o_totalprice) AS amount FROM orders GROUP BY 1, 2),
    b AS (SELECT DISTINCT o_custkey, place FROM p, (SELECT DISTINCT place FROM r) WHERE NOT EXISTS (SELECT 1 FROM p x WHERE x.o_custkey = p.o_custkey AND x.o_orderpriority = place)),
    h AS (SELECT b.o_custkey, b.place, r.donor, amount, row_number() OVER (PARTITION BY b.o_custkey, b.place ORDER BY ord) AS k FROM b JOIN r USING (place) JOIN p ON p.o_custkey = b.o_custkey AND p.o_orderpriority = r.donor)
    SELECT o_custkey, place AS o_orderpriority, donor, amount FROM h WHERE k = 1""")
def carry_down(spark, sf):
    """Blank priorities of a customer filled from the first donor of ordered rules."""
    p = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.max("o_totalprice").alias("amount"))
    places = sorted({r[0] for r in RULES})
    want = p.select("o_custkey").distinct().select("o_custkey", F.explode(F.array(*map(F.lit, places))).alias("o_orderpriority"))
    blanks = want.join(p, ["o_custkey", "o_orderpriority"], "left_anti")
    return factors.carry(p, blanks, spark.createDataFrame(RULES, "recipient string, donor string, ordinal int"), "o_custkey", "o_orderpriority", "amount")


@query(f"WITH g AS (SELECT l_orderkey, l_partkey, count(*) AS stated, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, l_partkey, stated, lo, hi, CASE WHEN lo = hi THEN 'equal' WHEN {AGREE} THEN 'within-tolerance' ELSE 'conflict' END AS verdict FROM g")
def collision_settle(spark, sf):
    """Lines of one order and part: equal, within tolerance or in conflict."""
    return factors.settle(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"], "l_extendedprice")


@query(f"""WITH s AS (SELECT s_nationkey AS n, unnest([min(s_acctbal), max(s_acctbal)]) AS b FROM supplier GROUP BY 1), x AS (SELECT n, least(c_acctbal, b) AS lo, greatest(c_acctbal, b) AS hi FROM customer JOIN s ON c_nationkey = n)
    SELECT n AS nation, {BAND} AS band, count(*) AS pairs FROM x GROUP BY 1, 2""")
def signed_bands(spark, sf):
    """Bands of customer balances against the extremes of their nation's suppliers, across zero and sign."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    ends = s.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.explode(F.array(F.min("s_acctbal"), F.max("s_acctbal"))).alias("b"))
    j = c.join(ends, "c_nationkey")
    return j.groupBy(F.col("c_nationkey").alias("nation"), numbers.band(F.least("c_acctbal", "b"), F.greatest("c_acctbal", "b")).alias("band")).agg(F.count(F.lit(1)).alias("pairs"))


@query("""WITH s AS (SELECT p_brand, l_orderkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / sum(l_quantity::DECIMAL(12,2) * p_retailprice::DECIMAL(12,2))::DOUBLE AS r FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
    SELECT p_brand, count(*) FILTER (r BETWEEN 0.98 AND 1.02) AS agree, count(*) FILTER (r < 0.5 OR r > 2) AS far, round(median(r), 6) AS median_ratio FROM s GROUP BY 1""")
def release_medians(spark, sf):
    """Agreement counts and the exact median ratio of each brand."""
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    r = F.sum(money("l_extendedprice")).cast("double") / F.sum(F.col("l_quantity").cast("decimal(12,2)") * F.col("p_retailprice").cast("decimal(12,2)")).cast("double")
    s = lines.join(parts, lines.l_partkey == parts.p_partkey).groupBy("p_brand", "l_orderkey").agg(r.alias("r"))
    return s.groupBy("p_brand").agg(F.count_if(F.col("r").between(0.98, 1.02)).alias("agree"), F.count_if((F.col("r") < 0.5) | (F.col("r") > 2)).alias("far"), F.round(F.median("r"), 6).alias("median_ratio"))


@query("""WITH m AS (SELECT s_nationkey AS n, c_mktsegment AS p, avg(s_acctbal) AS m FROM supplier, (SELECT DISTINCT c_mktsegment FROM customer) GROUP BY 1, 2),
    a AS (SELECT c_nationkey AS n, c_mktsegment AS p, min(abs(c_acctbal)) AS v FROM customer GROUP BY 1, 2),
    r AS (SELECT a.n, greatest(v, m) / least(v, m) AS r FROM a JOIN m ON a.n = m.n AND a.p = m.p WHERE v > 0 AND m > 0)
    SELECT n AS nation, count(*) AS places, round(min(r), 6) AS least_ratio FROM r GROUP BY 1 HAVING count(*) >= 4 AND min(r) > 5""")
def contradictions(spark, sf):
    """Nations whose every segment is far off a model of it."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    segments = c.select(F.col("c_mktsegment").alias("p")).distinct()
    model = s.groupBy(F.col("s_nationkey").alias("n")).agg(F.avg("s_acctbal").alias("v")).crossJoin(F.broadcast(segments))  # nations by segments
    stated = c.groupBy(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("p")).agg(F.min(F.abs("c_acctbal")).alias("v"))
    return factors.contradictions(stated, model, "n", "p", "v", least=4, far=5.0).select(F.col("n").alias("nation"), "places", F.round("least_ratio", 6).alias("least_ratio"))


# --- matching ----------------------------------------------------------------------------------


@query("""WITH c AS (SELECT c_custkey, regexp_replace(c_name, '^[^0-9]*0*', '') AS stem, c_nationkey AS n, floor(c_acctbal / 500) AS b FROM customer),
    s AS (SELECT s_suppkey, regexp_replace(s_name, '^[^0-9]*0*', '') AS stem, s_nationkey AS n, floor(s_acctbal / 500) AS b FROM supplier),
    f AS (SELECT c_custkey, s_suppkey AS t, 0 AS tier, 'stem' AS basis FROM c JOIN s USING (stem) UNION ALL SELECT c_custkey, s_suppkey, 1, 'nation+balance' FROM c JOIN s USING (n, b) UNION ALL SELECT c_custkey, s_suppkey, 2, 'nation' FROM c JOIN s USING (n)),
    g AS (SELECT c_custkey, tier, basis, count(DISTINCT t) AS k, min(t) AS t FROM f GROUP BY 1, 2, 3), m AS (SELECT c_custkey, min(tier) AS tier FROM g GROUP BY 1)
    SELECT c.c_custkey, CASE WHEN k = 1 THEN t END AS target, CASE WHEN k = 1 THEN basis WHEN k > 1 THEN basis || '-ambiguous' ELSE 'none' END AS basis, coalesce(k, 0) AS candidates FROM c LEFT JOIN m USING (c_custkey) LEFT JOIN g USING (c_custkey, tier)""")
def alias_cascade(spark, sf):
    """Customers to suppliers: equal name stem, else nation and balance class, else nation."""
    stem = lambda c: F.regexp_replace(c, "^[^0-9]*0*", "")
    c = table(spark, sf, "customer").select("c_custkey", stem("c_name").alias("stem"), F.col("c_nationkey").alias("n"), F.floor(F.col("c_acctbal") / 500).alias("b"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("target"), stem("s_name").alias("stem"), F.col("s_nationkey").alias("n"), F.floor(F.col("s_acctbal") / 500).alias("b"))
    return match.cascade_by_keys(c, "c_custkey", [("stem", s, ["stem"]), ("nation+balance", s, ["n", "b"]), ("nation", s, ["n"])])


@query("""WITH x AS (SELECT p_partkey, s_suppkey, 2 * (p_size % 5 = s_suppkey % 5)::INT + (p_size % 3 = s_nationkey % 3)::INT - (s_acctbal < 0)::INT + (p_size = s_nationkey)::INT AS score FROM part JOIN supplier ON p_size % 25 = s_nationkey),
    t AS (SELECT p_partkey, max(score) AS top FROM x GROUP BY 1), n AS (SELECT p_partkey, top, min(s_suppkey) AS s, count(*) AS k FROM x JOIN t USING (p_partkey) WHERE score = top GROUP BY 1, 2)
    SELECT p_partkey, CASE WHEN top > 0 AND k = 1 THEN s END AS target, CASE WHEN top <= 0 THEN 'no-signal' WHEN k > 1 THEN 'tied' ELSE 'best-score' END AS reason, top AS score FROM n""")
def scored_select(spark, sf):
    """Suppliers of a part scored by signals and penalties; ties give none."""
    p, s = table(spark, sf, "part"), table(spark, sf, "supplier")
    # both sides by what the score reads: a size has few groups of suppliers, however many there are
    own = s.groupBy("s_nationkey", (F.col("s_suppkey") % 5).alias("fifth"), (F.col("s_acctbal") < 0).alias("owes")).agg(F.min("s_suppkey").alias("s_suppkey"), F.count(F.lit(1)).alias("members"))
    j = p.select("p_size").distinct().join(own, F.col("p_size") % 25 == F.col("s_nationkey"))
    one = lambda c: c.cast("int")
    score = 2 * one(F.col("p_size") % 5 == F.col("fifth")) + one(F.col("p_size") % 3 == F.col("s_nationkey") % 3) - one(F.col("owes")) + one(F.col("p_size") == F.col("s_nationkey"))
    return p.select("p_partkey", "p_size").join(match.select_scored(j, "p_size", "s_suppkey", score, "members").withColumnRenamed("s_suppkey", "target"), "p_size").drop("p_size")


PREFIXES = [("Brand#", "any"), ("Brand#1", "ones"), ("Brand#13", "thirteen"), ("Brand#2", "twos"), ("Brand#25", "twenty-five")]


@query("""WITH r(prefix, cls) AS (VALUES ('Brand#', 'any'), ('Brand#1', 'ones'), ('Brand#13', 'thirteen'), ('Brand#2', 'twos'), ('Brand#25', 'twenty-five')),
    h AS (SELECT p_partkey, p_brand, cls, length(prefix) AS n, row_number() OVER (PARTITION BY p_partkey ORDER BY length(prefix) DESC) AS k FROM part LEFT JOIN r ON starts_with(p_brand, prefix))
    SELECT p_partkey, p_brand, cls, n::INT AS prefix_length FROM h WHERE k = 1""")
def prefix_rules(spark, sf):
    """The rule of the longest matching prefix."""
    rules = spark.createDataFrame(PREFIXES, "prefix string, cls string")
    return match.longest_prefix(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", rules, "prefix", "cls", ["p_partkey"])


@query("""WITH b AS (SELECT p_partkey AS k, p_type AS v FROM part WHERE p_size <= 30), o AS (SELECT p_partkey AS k, CASE WHEN p_size % 4 = 0 THEN NULL ELSE upper(p_brand) END AS v FROM part WHERE p_size >= 25)
    SELECT k, CASE WHEN o.k2 IS NOT NULL THEN o.v2 ELSE b.v END AS v, CASE WHEN o.k2 IS NULL THEN 'kept' WHEN b.v IS NULL THEN 'added' WHEN o.v2 IS NULL THEN 'declined' ELSE 'replaced' END AS origin
    FROM b FULL JOIN (SELECT k, k AS k2, v AS v2 FROM o) o USING (k)""")
def rule_overlay(spark, sf):
    """Curated rows over a correspondence: replace, decline, append."""
    p = table(spark, sf, "part")
    base = p.where("p_size <= 30").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("v"))
    over = p.where("p_size >= 25").select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") % 4 == 0, None).otherwise(F.upper("p_brand")).alias("v"))
    return match.overlay(base, over, ["k"], "v")


@query("""WITH v AS (SELECT user_id, event_type AS c, count(DISTINCT ts::DATE) AS n FROM events GROUP BY 1, 2), t AS (SELECT user_id, max(n) AS most FROM v GROUP BY 1), w AS (SELECT user_id, most, count(*) AS k, min(c) AS c FROM v JOIN t USING (user_id) WHERE n = most GROUP BY 1, 2)
    SELECT user_id, CASE WHEN most >= 2 AND k = 1 THEN c END AS winner, most AS votes FROM w""")
def quorum_vote(spark, sf):
    """Per user the event type of most distinct days, two at least and untied."""
    return match.quorum(table(spark, sf, "events").withColumn("day", F.to_date("ts")), "user_id", "event_type", "day")


@query("""WITH o AS (SELECT DISTINCT l_orderkey AS a, l_partkey AS b FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R'), x AS (SELECT a, b, count(*) OVER (PARTITION BY a) AS na, count(*) OVER (PARTITION BY b) AS nb FROM o)
    SELECT a AS l_orderkey, b AS l_partkey, CASE WHEN na > 1 AND nb > 1 THEN 'related' WHEN na > 1 THEN 'narrow' WHEN nb > 1 THEN 'broad' ELSE 'exact' END AS strength FROM x""")
def match_strength(spark, sf):
    """Strength of order and part pairs by the cardinality of both ends."""
    return match.match_strength(table(spark, sf, "lineitem").where("l_quantity = 50 AND l_returnflag = 'R'"), "l_orderkey", "l_partkey")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'prepared' WHEN o_orderstatus = 'F' THEN 'algorithm' WHEN o_orderpriority = '1-URGENT' THEN 'manual-addition' WHEN o_custkey % 2 = 0 THEN 'created' ELSE 'unmatched' END AS outcome,
    (o_totalprice > 400000)::BIGINT + (o_orderstatus = 'F')::BIGINT + (o_orderpriority = '1-URGENT')::BIGINT + (o_custkey % 2 = 0)::BIGINT + 1 AS branches FROM orders""")
def one_outcome(spark, sf):
    """Exactly one outcome for each row out of overlapping branches."""
    o = table(spark, sf, "orders")
    return match.one_outcome([("prepared", o.where("o_totalprice > 400000")), ("algorithm", o.where("o_orderstatus = 'F'")), ("manual-addition", o.where("o_orderpriority = '1-URGENT'")), ("created", o.where("o_custkey % 2 = 0")), ("unmatched", o)], "o_orderkey")


@query("""WITH x AS (SELECT l_partkey, CASE WHEN l_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS list, l_suppkey FROM lineitem)
    SELECT l_partkey, count(DISTINCT l_suppkey) AS targets, count(DISTINCT list) AS lists FROM x GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1 AND count(DISTINCT list) > 1""")
def conflicts(spark, sf):
    """Parts for which two lists name several suppliers."""
    x = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", F.when(F.col("l_orderkey") % 2 == 0, "even").otherwise("odd").alias("list"))
    return x.groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("targets"), F.count_distinct("list").alias("lists")).where("targets > 1 AND lists > 1")


# --- grouping ------------------------------------------------------------------------------------

FOLD = "lower(trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g')))"


@query(f"""WITH d AS (SELECT doc_id, {FOLD} AS k, length(text) AS n FROM documents), r AS (SELECT doc_id, k, row_number() OVER (PARTITION BY k ORDER BY n DESC, doc_id) AS i, count(*) OVER (PARTITION BY k) AS members FROM d)
    SELECT a.doc_id, b.doc_id AS survivor, a.members FROM r a JOIN r b ON a.k = b.k AND b.i = 1""")
def dedupe_survivor(spark, sf):
    """Documents of one folded text: the longest, then the smallest id, survives."""
    d = table(spark, sf, "documents").select("doc_id", F.xxhash64(k := F.lower(F.trim(F.regexp_replace("text", "[ \t\n\r]+", " ")))).alias("h"), F.md5(k.cast("binary")).alias("k"), F.length("text").alias("n"))
    return groups.survivors(d, ["h", "k"], [-F.col("n"), F.col("doc_id")], "doc_id")


@query(f"""SELECT md5({FOLD}) AS k, count(*) AS members, concat_ws(',', CASE WHEN count(DISTINCT lang) > 1 THEN 'lang' END, CASE WHEN count(DISTINCT source) > 1 THEN 'source' END) AS differing FROM documents GROUP BY 1 HAVING count(*) > 1""")
def collisions(spark, sf):
    """Folded texts that several documents hold, and the fields on which these differ."""
    d = table(spark, sf, "documents").select(F.md5(F.lower(F.trim(F.regexp_replace("text", "[ \t\n\r]+", " "))).cast("binary")).alias("k"), "lang", "source")
    return groups.collisions(d, ["k"], ["lang", "source"])


@query("SELECT c_nationkey AS nation, count(DISTINCT c_mktsegment) AS names, min(c_mktsegment) AS first_name, max(c_mktsegment) AS last_name FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1")
def contested_keys(spark, sf):
    """Nations that more than one segment claims."""
    return groups.contested(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment").withColumnRenamed("c_nationkey", "nation")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS sides, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, round(max(l_extendedprice) / min(l_extendedprice) - 1, 6) AS spread FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def worst_disagreement(spark, sf):
    """Relative spread of prices of parts that several suppliers state."""
    return groups.spread(table(spark, sf, "lineitem"), ["l_partkey"], "l_suppkey", "l_extendedprice").withColumn("spread", F.round("spread", 6))


@query("""WITH g AS (SELECT o_custkey AS k, count(DISTINCT o_orderpriority) AS n, min(o_orderpriority) AS one, arg_min(o_orderpriority, o_orderkey) AS first, count(DISTINCT CASE WHEN o_totalprice > 300000 THEN o_orderpriority END) AS refs, min(CASE WHEN o_totalprice > 300000 THEN o_orderpriority END) AS ref FROM orders GROUP BY 1),
    p AS (SELECT c_custkey AS k, '3-MEDIUM' AS pub FROM customer WHERE c_custkey % 4 = 0)
    SELECT k AS o_custkey, CASE WHEN n = 1 THEN one ELSE coalesce(pub, CASE WHEN refs = 1 THEN ref END, first) END AS unit, CASE WHEN n = 1 THEN 'single' WHEN pub IS NOT NULL THEN 'published' WHEN refs = 1 THEN 'reference' ELSE 'undecided' END AS how FROM g LEFT JOIN p USING (k)""")
def created_unit(spark, sf):
    """One value for each group by precedence: single, published, reference, first."""
    pub = table(spark, sf, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("o_custkey"), F.lit("3-MEDIUM").alias("o_orderpriority"))
    return groups.chosen_unit(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", pub, F.col("o_totalprice") > 300000, F.col("o_orderkey"))


@query("""WITH l AS (SELECT regexp_replace(lower(s_name), '[^0-9]', '', 'g') AS label, 's' || s_suppkey AS o FROM supplier UNION ALL SELECT regexp_replace(lower(c_name), '[^0-9]', '', 'g'), 'c' || c_custkey FROM customer)
    SELECT label, count(DISTINCT o) AS owners, count(*) AS uses FROM l GROUP BY 1 HAVING count(DISTINCT o) > 1""")
def shared_labels(spark, sf):
    """Labels that a supplier and a customer share."""
    part = lambda t, n, k, p: table(spark, sf, t).select(F.regexp_replace(F.lower(n), "[^0-9]", "").alias("label"), F.concat(F.lit(p), F.col(k).cast("string")).alias("o"))
    return groups.shared_labels(part("supplier", "s_name", "s_suppkey", "s").unionAll(part("customer", "c_name", "c_custkey", "c")), "label", "o")


@query("""SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2
    UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def facets(spark, sf):
    """Facet counts of two tables, each in one scan."""
    return groups.facets(table(spark, sf, "documents"), ["lang", "source"]).unionAll(groups.facets(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"]))


@query("""WITH RECURSIVE e AS (SELECT o_orderkey AS n, max(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS t FROM orders), g AS (SELECT n, t FROM e WHERE t IS NOT NULL),
    w(n, place, hops) AS (SELECT n, t, 1 FROM g UNION ALL SELECT w.n, g.t, hops + 1 FROM w JOIN g ON g.n = w.place)
    SELECT n AS o_orderkey, arg_max(place, hops) AS terminal, max(hops) AS hops, 'resolved' AS status FROM w GROUP BY 1""")
def redirect_closure(spark, sf):
    """Every order redirected to the customer's order before it: terminal and number of hops."""
    o = table(spark, sf, "orders").select("o_orderkey", F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("t"))
    return groups.closure(o.where("t IS NOT NULL"), "o_orderkey", "t")


@query("""WITH k AS (SELECT doc_id, split_part(text, chr(10), 1) AS line, lang FROM documents) SELECT doc_id, min(doc_id) OVER (PARTITION BY line, lang) AS owner FROM k""")
def entity_owner(spark, sf):
    """Documents of one first line and language belong to the earliest of them."""
    d = table(spark, sf, "documents").select("doc_id", F.md5(F.concat_ws("\0", "lang", F.split("text", "\n", 2)[0]).cast("binary")).alias("key"))
    return match.owners(d, "doc_id", "key")


# --- changes -------------------------------------------------------------------------------------


@query("""SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS version FROM events""")
def changelog_versions(spark, sf):
    """Version number of every event of a user."""
    return groups.numbered(table(spark, sf, "events"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("event_id", "user_id", "event_type", "version")


@query("SELECT user_id, event_type AS field, count(*) AS n_changes, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1, 2")
def field_history(spark, sf):
    """Changes of each field of a user."""
    return table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("field")).agg(F.count(F.lit(1)).alias("n_changes"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def _releases(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey")
    after = o.where(k % 17 != 0).withColumns({"o_orderstatus": F.when(k % 5 == 0, "X").otherwise(F.col("o_orderstatus")), "o_totalprice": F.when(k % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))})
    return o.where(k % 13 != 0), after


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 13 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 17 <> 0),
    j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS k, a.o_orderkey AS ka, b.o_orderkey AS kb, concat_ws(',', CASE WHEN a.o_orderstatus <> b.o_orderstatus THEN 'o_orderstatus' END, CASE WHEN a.o_totalprice <> b.o_totalprice THEN 'o_totalprice' END) AS f FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
    SELECT k AS o_orderkey, CASE WHEN ka IS NULL THEN 'created' WHEN kb IS NULL THEN 'deleted' ELSE 'updated' END AS delta, CASE WHEN ka IS NULL OR kb IS NULL THEN '' ELSE f END AS fields FROM j WHERE ka IS NULL OR kb IS NULL OR f <> ''""")
def release_diff(spark, sf):
    """Created, updated with their fields, and deleted rows of two releases."""
    return changes.diff(*_releases(spark, sf), "o_orderkey", ["o_orderstatus", "o_totalprice", "o_orderpriority"]).drop("new")


@query("SELECT 'only-left' AS side, 0::BIGINT AS rows UNION ALL SELECT 'only-right', 0")
def release_apply(spark, sf):
    """A diff replayed on the release before gives the one after."""
    before, after = _releases(spark, sf)
    fields = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
    return changes.same_rows(changes.replay(before, changes.diff(before, after, "o_orderkey", fields), "o_orderkey", fields), after)


@query("""WITH v AS (SELECT o_orderkey AS k, o_orderstatus AS u FROM orders WHERE o_orderkey % 10 = 0), live AS (SELECT o_orderkey AS t, o_orderstatus AS tu FROM orders WHERE o_orderkey % 10 <> 0),
    r AS (SELECT k, t, tu FROM v JOIN live ON t = k + 1 WHERE k % 30 = 0), l AS (SELECT o_orderkey AS k, l_linenumber, o_orderkey + l_linenumber % 3 AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 20 = 0),
    s AS (SELECT l.k, count(DISTINCT live.t) AS n, min(live.t) AS t, min(tu) AS tu FROM l LEFT JOIN live USING (t) GROUP BY 1),
    f AS (SELECT v.k, r.t AS rt, s.t AS st, CASE WHEN r.t IS NOT NULL THEN 'replaced' WHEN n IS NULL THEN 'unresolved' WHEN n = 0 THEN 'deleted' WHEN n > 1 OR s.tu <> u THEN 'unresolved' ELSE 'replaced' END AS fate FROM v LEFT JOIN r ON v.k = r.k LEFT JOIN s ON v.k = s.k)
    SELECT k, fate, CASE WHEN fate = 'replaced' THEN coalesce(rt, st) END AS target FROM f""")
def release_fates(spark, sf):
    """What became of rows that a release dropped: by redirect, else by their source rows."""
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    gone = o.where("o_orderkey % 10 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("unit"))
    live = o.where("o_orderkey % 10 <> 0").select(F.col("o_orderkey").alias("target"), F.col("o_orderstatus").alias("target_unit"))
    redirects = gone.where("k % 30 = 0").select("k", (F.col("k") + 1).alias("target"))
    links = l.join(o, l.l_orderkey == o.o_orderkey).where("o_orderkey % 20 = 0").select(F.col("o_orderkey").alias("k"), F.col("l_linenumber").alias("source_row"), (F.col("o_orderkey") + F.col("l_linenumber") % 3).alias("target"))
    return changes.fates(gone, redirects, links, live, "k")


@query("""WITH p AS (SELECT p_partkey, p_name, p_type FROM part WHERE p_size % 10 <> 0)
    SELECT p_partkey, 0 AS step_no, 'fold' AS step, 'p_name' AS field, p_name AS "before", upper(p_name) AS "after" FROM p WHERE p_name <> upper(p_name)
    UNION ALL SELECT p_partkey, 1, 'cut', 'p_name', upper(p_name), left(upper(p_name), 10) FROM p WHERE upper(p_name) <> left(upper(p_name), 10)
    UNION ALL SELECT p_partkey, 1, 'cut', 'p_type', p_type, lower(p_type) FROM p WHERE p_type <> lower(p_type)""")
def rule_chain(spark, sf):
    """Change log of ordered steps; finished rows are visible but not writable."""
    p = table(spark, sf, "part").withColumn("finished", F.col("p_size") % 10 == 0)
    return changes.run_chain(p, [("fold", {"p_name": F.upper("p_name")}), ("cut", {"p_name": F.substring("p_name", 1, 10), "p_type": F.lower("p_type")})], "p_partkey")[1]


def _measures(spark, sf):
    one = lambda t, m, e: table(spark, sf, t).agg(e.cast("double").alias("value")).select(F.lit(m).alias("measure"), "value")
    return one("orders", "orders", F.count(F.lit(1))).unionAll(one("lineitem", "max_qty", F.max("l_quantity"))).unionAll(one("customer", "min_balance", F.min("c_acctbal")))


@query("""WITH m AS (SELECT 'orders' AS measure, count(*)::DOUBLE AS value FROM orders UNION ALL SELECT 'max_qty', max(l_quantity) FROM lineitem UNION ALL SELECT 'min_balance', min(c_acctbal) FROM customer),
    e(id, measure, bound, wanted) AS (VALUES ('e1', 'orders', 'at_least', 10.0), ('e2', 'max_qty', 'at_most', 50.0), ('e3', 'min_balance', 'at_least', 0.0), ('e4', 'nothing', 'equals', 1.0), ('e5', 'orders', 'about', 1.0))
    SELECT id, measure, value, CASE WHEN value IS NULL OR bound = 'about' THEN 'unresolved' WHEN (bound = 'equals' AND value = wanted) OR (bound = 'at_most' AND value <= wanted) OR (bound = 'at_least' AND value >= wanted) THEN 'met' ELSE 'unmet' END AS verdict FROM e LEFT JOIN m USING (measure)""")
def assess(spark, sf):
    """Expectations as bounds over measures; unknown ones fail closed."""
    return changes.assess(_measures(spark, sf), [("e1", "orders", "at_least", 10.0), ("e2", "max_qty", "at_most", 50.0), ("e3", "min_balance", "at_least", 0.0), ("e4", "nothing", "equals", 1.0), ("e5", "orders", "about", 1.0)])


@query("""SELECT 'line-order' AS gate, count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'line-part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'line-small-part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45) UNION ALL SELECT 'order-customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def integrity_gates(spark, sf):
    """Rows without a parent, by reference."""
    l, o, p, c = (table(spark, sf, t) for t in ("lineitem", "orders", "part", "customer"))
    gates = [changes.orphans(l, o, [("l_orderkey", "o_orderkey")], "line-order"), changes.orphans(l, p, [("l_partkey", "p_partkey")], "line-part"), changes.orphans(l, p.where("p_size <= 45"), [("l_partkey", "p_partkey")], "line-small-part"), changes.orphans(o, c, [("o_custkey", "c_custkey")], "order-customer")]
    out = gates[0]
    for g in gates[1:]:
        out = out.unionAll(g)
    return out


@query("""WITH b AS (SELECT lang AS measure, count(*)::DOUBLE AS v FROM documents WHERE doc_id % 2 = 0 GROUP BY 1), n AS (SELECT lang AS measure, count(*)::DOUBLE AS v FROM documents WHERE doc_id % 2 = 1 AND lang <> 'es' GROUP BY 1)
    SELECT measure, b.v AS was, n.v AS "is", CASE WHEN b.v IS NULL THEN 'new' WHEN n.v IS NULL THEN 'gone' WHEN b.v = n.v THEN 'same' WHEN measure = 'en' THEN CASE WHEN n.v > b.v THEN 'improved' ELSE 'regressed' END ELSE 'moved' END AS change FROM b FULL JOIN n USING (measure)""")
def baseline_drift(spark, sf):
    """Metrics against a baseline."""
    d = table(spark, sf, "documents")
    one = lambda x: x.groupBy(F.col("lang").alias("measure")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return changes.drift(one(d.where("doc_id % 2 = 0")), one(d.where("doc_id % 2 = 1 AND lang <> 'es'")), {"en": "up"})


# --- analytic pages ------------------------------------------------------------------------------


@query("""SELECT l_partkey, sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice::DECIMAL(18,2) END)::DOUBLE AS a, sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice::DECIMAL(18,2) END)::DOUBLE AS n, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice::DECIMAL(18,2) END)::DOUBLE AS r FROM lineitem GROUP BY 1""")
def pivot_wide(spark, sf):
    """Amounts of each part by return flag, wide."""
    p = table(spark, sf, "lineitem").groupBy("l_partkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum(money("l_extendedprice")))
    return p.select("l_partkey", *[F.col(f).cast("double").alias(f.lower()) for f in "ANR"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 50")
def paged_top(spark, sf):
    """Second page of orders by price: the page is the feature."""
    return groups.page(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 2)


@query("SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^a-z0-9]+'), 'the') AND list_contains(regexp_split_to_array(lower(text), '[^a-z0-9]+'), 'license')")
def token_search(spark, sf):
    """Documents that hold all search words."""
    words = text.tokens(F.col("text"))
    return table(spark, sf, "documents").where(F.array_contains(words, "the") & F.array_contains(words, "license")).select("doc_id")


@query("SELECT event_type, (props->>'$.k')::BIGINT % 10 AS bucket, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def json_facets(spark, sf):
    """Facets of a JSON column."""
    return table(spark, sf, "events").groupBy("event_type", (F.get_json_object("props", "$.k").cast("long") % 10).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT coalesce(o_orderstatus, 'all') AS outcome, count(*) AS n, count(DISTINCT o_custkey) AS customers, count(DISTINCT nullif(o_orderpriority, '5-LOW')) AS priorities FROM orders GROUP BY ROLLUP (o_orderstatus)")
def outcome_rollup(spark, sf):
    """Counts by outcome and over all rows; distinct counts are not sums of parts."""
    return table(spark, sf, "orders").rollup("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"), F.count_distinct(F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("priorities")).select(F.coalesce("o_orderstatus", F.lit("all")).alias("outcome"), "n", "customers", "priorities")


@query("SELECT event_type AS queue, count(*) AS items, count(*) FILTER (value > 90) AS blocking FROM events GROUP BY 1")
def queue_counts(spark, sf):
    """Queue sizes with their blocking items."""
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("queue")).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("value") > 90).alias("blocking"))


# --- scalar layer ----------------------------------------------------------------------------------


@query("""WITH c AS (SELECT p_partkey, (1000 + p_partkey)::VARCHAR || '-' || lpad((p_size % 100)::VARCHAR, 2, '0') AS body, (p_partkey % 10)::VARCHAR AS d FROM part),
    w AS (SELECT p_partkey, body || '-' || d AS cas, body, d, reverse(replace(body, '-', '')) AS r FROM c), x AS (SELECT *, (list_sum(list_transform(range(1, length(r) + 1), lambda k: substr(r, k, 1)::INT * k)) % 10)::INT AS digit FROM w)
    SELECT p_partkey, cas, digit = d::INT AS valid, body || '-' || digit AS corrected FROM x""")
def identifier_check(spark, sf):
    """Registry numbers with their check digits validated and corrected."""
    cas = F.concat((F.col("p_partkey") + 1000).cast("string"), F.lit("-"), F.lpad((F.col("p_size") % 100).cast("string"), 2, "0"), F.lit("-"), (F.col("p_partkey") % 10).cast("string"))
    p = table(spark, sf, "part").select("p_partkey", cas.alias("cas"))
    return p.select("p_partkey", "cas", checks.cas_valid(F.col("cas")).alias("valid"), checks.correct_cas(F.col("cas")).alias("corrected"))


@query("SELECT p_partkey, lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS label, lower(regexp_replace(p_type, '\\s+', '', 'g')) AS norm FROM part")
def label_fold(spark, sf):
    """Comparison keys of labels."""
    return table(spark, sf, "part").select("p_partkey", text.canonical_label(F.col("p_name")).alias("label"), text.normalize(F.col("p_type")).alias("norm"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: CASE WHEN regexp_matches(substr(w, 2), '[A-Z]') OR NOT regexp_matches(w, '^[A-Za-z]') THEN w ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), ' ') AS title FROM part""")
def title_case(spark, sf):
    """Capitals at word starts where no inner capital stands."""
    return table(spark, sf, "part").select("p_partkey", text.title_case(F.col("p_name")).alias("title"))


@query("""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) AS plain FROM pages""")
def strip_markup(spark, sf):
    """Pages without tags, as digests."""
    return table(spark, sf, "pages").select("page_id", F.md5(text.strip_markup(F.col("html")).cast("binary")).alias("plain"))


@query("""WITH s AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN (1000 + p_partkey)::VARCHAR || '-11-1' WHEN 1 THEN 'AB ' || (100 + p_size)::VARCHAR WHEN 2 THEN 'Solvent (TM)' ELSE p_name END AS label FROM part)
    SELECT p_partkey, label, CASE WHEN regexp_matches(label, '^[0-9]{2,7}-[0-9]{2}-[0-9]$') THEN 'registry-code' WHEN regexp_matches(label, '^[A-Z]{1,5}[ -]?[0-9]{2,6}[A-Z]?$') THEN 'grade-code' WHEN regexp_matches(label, '^[A-Z][a-z]+ (\\(R\\)|\\(TM\\)|[A-Z]?[0-9]+)$') THEN 'trade-name' END AS shape FROM s""")
def shape_class(spark, sf):
    """Catalogue shapes of labels."""
    size = F.col("p_size") % 4
    label = F.when(size == 0, F.concat((F.col("p_partkey") + 1000).cast("string"), F.lit("-11-1"))).when(size == 1, F.concat(F.lit("AB "), (F.col("p_size") + 100).cast("string"))).when(size == 2, "Solvent (TM)").otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", label.alias("label")).select("p_partkey", "label", text.catalogue_kind(F.col("label")).alias("shape"))


@query("""WITH u(unit, kind, ref, m) AS (VALUES ('kg', 'mass', 'kg', 1.0::DOUBLE), ('g', 'mass', 'kg', 0.001), ('t', 'mass', 'kg', 1000.0), ('m3', 'volume', 'm3', 1.0), ('l', 'volume', 'm3', 0.001), ('MJ', 'energy', 'MJ', 1.0), ('kWh', 'energy', 'MJ', 3.6)),
    x AS (SELECT p_partkey, ['kg', 'g', 't', 'm3', 'l', 'kWh', '?'][1 + p_size % 7] AS a, ['kg', 'g', 'MJ', 'l', '?'][1 + p_partkey % 5] AS b FROM part)
    SELECT p_partkey, a, b, round(CASE WHEN a = b THEN 1.0 WHEN ua.kind = ub.kind AND ua.ref = ub.ref THEN ua.m / ub.m END, 9) AS factor FROM x LEFT JOIN u ua ON a = ua.unit LEFT JOIN u ub ON b = ub.unit""")
def unit_convert(spark, sf):
    """Conversion factors between units: same unit, unit table, none."""
    pick = lambda xs, k: F.element_at(F.array(*map(F.lit, xs)), (k + 1).cast("int"))
    x = table(spark, sf, "part").select("p_partkey", pick(["kg", "g", "t", "m3", "l", "kWh", "?"], F.col("p_size") % 7).alias("a"), pick(["kg", "g", "MJ", "l", "?"], F.col("p_partkey") % 5).alias("b"))
    return units.quantity_factor(x, units.unit_table(spark), "a", "b").withColumn("factor", F.round("factor", 9))


@query("SELECT s_suppkey, 'obj-' || substr(sha1(lower(s_name) || '|' || s_nationkey::VARCHAR), 1, 16) AS object_id, sha1('flow:' || s_name || ':' || s_nationkey::VARCHAR) AS flow_id FROM supplier")
def minted_ids(spark, sf):
    """Deterministic ids of substances and of their occurrences."""
    s = table(spark, sf, "supplier")
    return s.select("s_suppkey", names.stable_id("obj", F.lower("s_name"), F.col("s_nationkey").cast("string")).alias("object_id"), names.minted_flow_id(F.col("s_name"), F.col("s_nationkey").cast("string")).alias("flow_id"))


# --- streaming -------------------------------------------------------------------------------------


@query("""SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_windows(spark, sf):
    """Daily counts by a stream with a watermark, complete once the source has ended."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out")

    counts = incremental.windowed_counts(incremental.parquet_stream(spark, sf, "events"), "ts", "event_type")
    q = counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def entry(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship query: how two scores of every order differ, by band."""
    return score_compare(spark, sf).groupBy("band").agg(F.count(F.lit(1)).alias("orders"), F.round(F.avg("ratio"), 4).alias("mean_ratio")).orderBy("band")
