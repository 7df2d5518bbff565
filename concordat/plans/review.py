"""What reviewers read, over the star schema and small authored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import review
from ..sources.tables import table
from .characterisation import frames
from .queries import BAND
from .registry import Fixture, having, query


@query("SELECT c_custkey AS uuid, c_custkey AS ordinal FROM customer WHERE c_custkey < 40 OR c_custkey IN (77, 99)")
def bounded_samples(spark, sf):
    """The first rows of a list and those named: the bound is what is asked for."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("uuid"), F.col("c_custkey").alias("ordinal"))
    return review.bounded_sample(c, 40, c.where("uuid IN (77, 99)").select("uuid"))


BARE = Fixture("bare", "uuid string, name string, cas array<string>, formula string", [("1", "silicon tetrachloride", ["a"], None), ("2", "carbon dioxide", ["b"], None), ("3", "salt", ["c"], None), ("4", "boron trifluoride", ["d", "e"], None), ("5", "silicon tetrachloride", ["a"], "SiCl4")])
REGISTERED = Fixture("registered_", "cas string, formula string", [("a", "SiCl4"), ("b", "CO"), ("c", "NaCl"), ("d", "BF3"), ("e", "F3B")])


@query("SELECT '1' AS uuid, 'SiCl4' AS formula")
def supplied_compositions(spark, sf):
    """Formulas that a registry has and the name agrees with."""
    return review.supplied_compositions(*frames(spark, BARE, REGISTERED))


@query("""WITH a AS (SELECT s_nationkey AS cas, 'N' || s_suppkey % 5 AS name FROM supplier UNION ALL SELECT c_nationkey, 'n' || c_custkey % 7 FROM customer), b AS (SELECT cas, lower(name) AS n, min(name) AS name FROM a GROUP BY 1, 2) SELECT cas, string_agg(name, '; ' ORDER BY name) AS names FROM b GROUP BY 1""")
def external_names(spark, sf):
    """The names that two registries have for a number."""
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("cas"), F.concat(F.lit("N"), (F.col("s_suppkey") % 5).cast("string")).alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("cas"), F.concat(F.lit("n"), (F.col("c_custkey") % 7).cast("string")).alias("name"))
    return review.external_names(s, c)


COUPLES = Fixture("couples", "a string, b string", [("Lead", "lead "), ("Xylene", "Xylene mixture"), ("Lead compounds", "Zinc"), ("Xylene", "p-Xylene"), ("Lead", "Zinc")])


@query("SELECT * FROM (VALUES ('Lead', 'lead ', 'exact'), ('Xylene', 'Xylene mixture', 'mixture'), ('Lead compounds', 'Zinc', 'class'), ('Xylene', 'p-Xylene', 'class'), ('Lead', 'Zinc', 'unresolved')) t(a, b, relation)")
def name_relations(spark, sf):
    """How two names relate."""
    return COUPLES.df(spark).select("a", "b", review.name_relation(F.col("a"), F.col("b")).alias("relation"))


EDGES = Fixture("role_edges", 'entry string, kind string, to string', [("e1", "is-a", "e2"), ("e2", "is-a", "e3"), ("e3", "is-a", "e1"), ("e3", "has-role", "r1"), ("e1", "has-role", "r2"), ("e4", "has-role", "r3"), ("e5", "is-a", "e4"), ("e4", "has-role", "r9")])
ENTRIES = Fixture("role_entries", "entry string", [("e1",), ("e2",), ("e5",), ("e6",)])
ALLOWED = Fixture("role_allowed", "role string", [("r1",), ("r2",), ("r3",)])


@query("SELECT * FROM (VALUES ('e1', 'r1'), ('e1', 'r2'), ('e2', 'r1'), ('e2', 'r2'), ('e5', 'r3')) t(entry, role)")
def entailed_roles(spark, sf):
    """Allowed roles of entries and of all that they are a kind of."""
    return review.entailed_roles(*frames(spark, ENTRIES, EDGES, ALLOWED))


@query("""WITH r AS (SELECT l_suppkey AS o, l_returnflag AS role FROM lineitem WHERE l_quantity = 50 UNION SELECT s_suppkey, 'debtor' FROM supplier WHERE s_acctbal < 0) SELECT s_suppkey AS object_id, coalesce(string_agg(DISTINCT role, ',' ORDER BY role), '') AS roles FROM supplier LEFT JOIN r ON o = s_suppkey GROUP BY 1""")
def curated_roles(spark, sf):
    """Roles found and roles asserted by hand."""
    s = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "object_id")
    found = table(spark, sf, "lineitem").where("l_quantity = 50").select(F.col("l_suppkey").alias("object_id"), F.col("l_returnflag").alias("role"))
    return review.with_curated_roles(s, found, s.where("s_acctbal < 0").select("object_id", F.lit("debtor").alias("role")))


OWN = Fixture("own_", "flow string, source_uuid string", [("f1", "u1"), ("f2", "u2"), ("f3", "u3")])
CONCEPTS = Fixture("concepts", "source_uuid string, concept string", [("u1", "c1"), ("u2", "c2"), ("u9", "c9"), ("u1", "c9")])
PAIRS = Fixture("pairs_", "source string, target string", [("u3", "u9"), ("u1", "u9")])


@query("SELECT * FROM (VALUES ('f1', 'c1', 'source'), ('f1', 'c9', 'source'), ('f2', 'c2', 'source'), ('f3', 'c9', 'correspondence')) t(flow, concept, how)")
def concept_associations(spark, sf):
    """Concepts of a flow's sources, directly or by a correspondence."""
    return review.associations(*frames(spark, OWN, CONCEPTS, PAIRS))


@query("SELECT row_number() OVER (ORDER BY event_type, event_id) AS change_index, user_id::VARCHAR AS uuid, CASE WHEN user_id % 2 = 0 THEN 'o' || user_id % 10 END AS object_id FROM events")
def numbered_changes(spark, sf):
    """Changes in total order, with their objects."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("step"), F.col("event_id").alias("ordinal"), F.col("user_id").cast("string").alias("uuid"))
    o = e.select("uuid").distinct().where(F.col("uuid").cast("long") % 2 == 0).select("uuid", F.concat(F.lit("o"), (F.col("uuid").cast("long") % 10).cast("string")).alias("object_id"))
    return review.numbered_changes(e, o)


@query("""WITH q AS (SELECT 'late' AS queue, o_orderkey::VARCHAR AS subject, 'review' AS severity FROM orders WHERE o_orderkey % 100 = 0 UNION ALL SELECT 'late', o_orderkey::VARCHAR, 'blocking' FROM orders WHERE o_orderkey % 100 = 1 UNION ALL SELECT 'urgent', o_orderkey::VARCHAR, 'info' FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey < 500)
    SELECT queue, row_number() OVER (PARTITION BY queue ORDER BY severity, subject)::INT AS item_index, subject, severity FROM q""")
def review_queue(spark, sf):
    """Items of several steps, numbered within their queue."""
    o = table(spark, sf, "orders")
    one = lambda rows, q, s: rows.select(F.lit(q).alias("queue"), F.col("o_orderkey").cast("string").alias("subject"), F.lit(s).alias("severity"))
    return review.queue([one(o.where("o_orderkey % 100 = 0"), "late", "review"), one(o.where("o_orderkey % 100 = 1"), "late", "blocking"), one(o.where("o_orderpriority = '1-URGENT' AND o_orderkey < 500"), "urgent", "info")])


@query("""WITH f AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS flow, l_suppkey, l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_quantity >= 49), g AS (SELECT l_suppkey, l_returnflag, l_linestatus, max(l_quantity) / min(l_quantity) - 1 AS s FROM f GROUP BY 1, 2, 3 HAVING count(*) > 1)
    SELECT 'collisions' AS queue, l_suppkey || '|' || l_returnflag || '|' || l_linestatus AS subject, CASE WHEN s > 0.02 THEN 'blocking' ELSE 'review' END AS severity, round(s, 6) AS spread FROM g""")
def collision_queue(spark, sf):
    """Colliding flows as items, blocking where their numbers are apart."""
    l = table(spark, sf, "lineitem").where("l_quantity >= 49").withColumn("flow", F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]))
    flows = l.select("flow", F.col("l_suppkey").alias("object_id"), F.col("l_returnflag").alias("context"), F.col("l_linestatus").alias("unit"))
    return review.collision_items(flows, l.select("flow", F.lit("c").alias("category"), F.col("l_quantity").alias("amount")).distinct())


@query("SELECT o_orderkey, o_orderstatus AS before, CASE WHEN o_orderkey % 4 = 0 THEN 'F' ELSE o_orderstatus END AS after FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus <> 'F'")
def moved_writes(spark, sf):
    """Writes that really moved a value."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return review.only_moved(o, o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, "F").otherwise(F.col("o_orderstatus"))), "o_orderkey", "o_orderstatus")


HELD = Fixture("held", "flow string, refs array<string>", [("f1", ["a"]), ("f2", ["b"]), ("f3", [])])
ARRIVING = Fixture("arriving", "flow string, refs array<string>", [("f1", ["c", "a"]), ("f1", ["b"]), ("f2", ["b"]), ("f9", ["z"])])


@query("SELECT * FROM (VALUES ('f1', 'a,b,c', true), ('f2', 'b', false), ('f3', '', false)) t(flow, refs, changed)")
def united_links(spark, sf):
    """Links of existing flows with those that arrive."""
    return review.united(*frames(spark, HELD, ARRIVING), "flow", "refs").select("flow", F.array_join("refs", ",").alias("refs"), "changed")


@query(f"""WITH x AS (SELECT l_orderkey AS process, coalesce(l_quantity * t.f, 0) AS a, coalesce(l_quantity * o.f, 0) AS b, o.f IS NULL AS lost FROM lineitem LEFT JOIN (SELECT p_partkey AS k, p_retailprice AS f FROM part WHERE p_size <= 40) t ON t.k = l_partkey LEFT JOIN (SELECT p_partkey AS k, p_retailprice * (1 + (p_size % 3) * 0.015) AS f FROM part WHERE p_size >= 3) o ON o.k = l_partkey),
    s AS (SELECT process, sum(a) AS theirs, sum(b) AS ours, sum(abs(a)) AS whole, sum(CASE WHEN lost THEN abs(a) ELSE 0 END) AS gone FROM x GROUP BY 1), k AS (SELECT x.process, count(*) FILTER (abs(a - b) > 0.02 * greatest(abs(a), abs(b)) OR abs(a) >= 0.001 * greatest(abs(theirs), abs(ours))) AS kept FROM x JOIN s USING (process) GROUP BY 1),
    z AS (SELECT *, least(theirs, ours) AS lo, greatest(theirs, ours) AS hi FROM s JOIN k USING (process))
    SELECT process, round(theirs, 6) AS theirs, round(ours, 6) AS ours, round(CASE WHEN theirs <> 0 THEN ours / theirs END, 6) AS ratio, {BAND} AS band, round(CASE WHEN whole <> 0 THEN gone / whole END, 6) AS unmapped, kept FROM z WHERE abs(theirs - ours) > 1""")
def release_scores(spark, sf):
    """A vendor's scores against ours, what of theirs we lack, and the lines worth keeping."""
    l, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    theirs = p.where("p_size <= 40").select(F.col("p_partkey").alias("flow"), F.col("p_retailprice").alias("factor"))
    ours = p.where("p_size >= 3").select(F.col("p_partkey").alias("flow"), (F.col("p_retailprice") * (1 + (F.col("p_size") % 3) * F.lit(0.015))).alias("factor"))
    r = review.compared_release(l.select(F.col("l_orderkey").alias("process"), F.col("l_partkey").alias("flow"), F.col("l_quantity").alias("amount")), theirs, ours)
    r = r.where(F.abs(F.col("theirs") - F.col("ours")) > 1)
    return r.select("process", *[F.round(c, n).alias(c) for c, n in (("theirs", 6), ("ours", 6), ("ratio", 6))], "band", F.round("unmapped", 6).alias("unmapped"), "kept")


WINDOWS = Fixture("windows", "id string, lo double, hi double", [("all", 0.0, 100.0), ("pm10", 0.0, 10.0), ("pm2.5", 0.0, 2.5), ("coarse", 2.5, 10.0), ("large", 10.0, 100.0)])


@query(having(WINDOWS) + " SELECT c.id, arg_min(p.id, (p.hi - p.lo, p.id)) AS parent FROM windows c LEFT JOIN windows p ON p.lo <= c.lo AND p.hi >= c.hi AND p.id <> c.id AND p.hi - p.lo > c.hi - c.lo GROUP BY 1")
def size_nesting(spark, sf):
    """The smallest window that holds each size window."""
    return review.smallest_windows(WINDOWS.df(spark))


DIRECTIONS = Fixture("directions", "direction string", [("occupation",), ("transformation",)])
CLASSES = Fixture("classes_", "class string, takes boolean", [("forest", True), ("sea", False)])
INTENSITIES = Fixture("intensities", "intensity string", [("intensive",), ("extensive",)])


@query(having(DIRECTIONS, CLASSES, INTENSITIES) + " SELECT direction || '/' || class AS key FROM directions, classes_ UNION ALL SELECT direction || '/' || class || '/' || intensity FROM directions, classes_, intensities WHERE takes")
def land_uses(spark, sf):
    """Land uses that there may be."""
    return review.legal_combinations(*frames(spark, DIRECTIONS, CLASSES, INTENSITIES))


@query("SELECT event_type AS stage, count(*) AS runs, round(sum(value), 2) AS seconds, round(sum(value) / (SELECT sum(value) FROM events), 9) AS share FROM events GROUP BY 1")
def stage_timings(spark, sf):
    """How long each stage of a run took."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("stage"), F.col("value").alias("seconds"))
    return review.stage_timings(e).select("stage", "runs", F.round("seconds", 2).alias("seconds"), F.round("share", 9).alias("share"))


@query("SELECT sha1('flow:' || c_mktsegment || ':' || n_name) AS flow_id, c_mktsegment AS object_id, n_name AS iri FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer) JOIN nation ON n_nationkey = c_nationkey")
def minted_context_flows(spark, sf):
    """Ids of an object's flows in its contexts."""
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("object_id"), F.col("c_nationkey").alias("n_nationkey")).distinct().join(table(spark, sf, "nation"), "n_nationkey")
    return review.minted_context_flows(c.select("object_id").distinct(), c.select("object_id", F.col("n_name").alias("iri")))
