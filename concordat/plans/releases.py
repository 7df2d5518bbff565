"""Releases, audits and review pages over small authored tables and over the star schema."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import names
from ..operators import groups, pages, releases
from ..sources.tables import table
from .characterisation import frames
from .queries import BAND
from .registry import Fixture, having, query

GONE = Fixture("gone", "object_id string", [("o1",), ("o2",), ("o3",), ("o4",), ("o5",)])
OWNED = Fixture("owned", "object_id string, flow string", [("o1", "f1"), ("o1", "f2"), ("o2", "f3"), ("o3", "f4"), ("o3", "f5"), ("o4", "f6"), ("o4", "f7")])
FATES = Fixture("fates", "flow string, fate string, target string", [("f1", "replaced", "n1"), ("f2", "replaced", "n2"), ("f3", "deleted", None), ("f4", "replaced", "n1"), ("f5", "replaced", "n3"), ("f6", "replaced", "n1"), ("f7", "unresolved", None)])
OBJECTS_OF = Fixture("objects_of", "target string, object string", [("n1", "p1"), ("n2", "p1"), ("n3", "p2")])


@query("SELECT * FROM (VALUES ('o1', 'replaced', 'p1'), ('o2', 'deleted', NULL), ('o3', 'unresolved', NULL), ('o4', 'unresolved', NULL), ('o5', 'unresolved', NULL)) t(object_id, fate, target)")
def object_fates(spark, sf):
    """What became of objects, by what became of their flows."""
    return releases.object_fates(*frames(spark, GONE, OWNED, FATES, OBJECTS_OF))


OLD_CATEGORIES = Fixture("old_categories", "category string, name string", [("c1", "Climate"), ("c2", "Acid"), ("c3", "Toxic"), ("c4", "Noise")])
NEW_CATEGORIES = Fixture("new_categories", "category string, name string", [("d1", "climate"), ("d3", "Toxic"), ("d4", "toxic"), ("d5", "x")])
DROPPED = Fixture("dropped", "category string", [("c2",)])
CATEGORY_RULES = Fixture("category_rules", "category string, target string", [("c3", "d3")])


@query("SELECT * FROM (VALUES ('c1', 'replaced', 'd1'), ('c2', 'deleted', NULL), ('c3', 'replaced', 'd3'), ('c4', 'unresolved', NULL)) t(category, fate, target)")
def category_fates(spark, sf):
    """What became of impact categories."""
    return releases.category_fates(*frames(spark, OLD_CATEGORIES, NEW_CATEGORIES, DROPPED, CATEGORY_RULES))


@query("SELECT sha1('flow:' || s_name || ':x') || 'z' AS flow_id FROM supplier WHERE s_suppkey % 10 = 0")
def broken_ids(spark, sf):
    """Minted ids that their hash doesn't give again."""
    s = table(spark, sf, "supplier")
    made = names.minted_flow_id(F.col("s_name"), F.lit("x"))
    return releases.broken_ids(s.select(F.when(F.col("s_suppkey") % 10 == 0, F.concat(made, F.lit("z"))).otherwise(made).alias("flow_id"), F.col("s_name").alias("object_id"), F.lit("x").alias("iri"), (F.col("s_suppkey") % 2 == 0).alias("minted")))


BEFORE = Fixture("before_", "flow string, category string, geo string, amount double", [("f1", "c1", "", 1.0), ("f2", "c1", "", 2.0), ("f3", "c1", "", 3.0), ("n1", "c1", "", 4.0), ("f6", "c9", "", 5.0), ("f9", "c9", "DE", 6.0), ("f8", "c2", "", 7.0), ("f9", "c9", "", 8.0)])
AFTER = Fixture("after_", BEFORE.schema, [("n1", "d1", "", 1.0), ("n2", "d1", "", 2.0), ("f9", "c9", "DE", 6.5), ("f9", "c9", "FR", 1.0), ("f9", "c9", "", 8.0)])
FLOW_FATES = Fixture("flow_fates", "flow string, fate string, target string", [("f1", "replaced", "n1"), ("f2", "replaced", "n2"), ("f3", "deleted", None), ("f6", "replaced", "n1")])
CATEGORY_FATES = Fixture("category_fates_", "category string, fate string, target string", [("c1", "replaced", "d1"), ("c2", "deleted", None)])


@query("SELECT * FROM (VALUES ('f3', 'c1', '', 'deleted'), ('f8', 'c2', '', 'deleted'), ('n1', 'c1', '', 'deleted'), ('n1', 'c9', '', 'deleted'), ('f9', 'c9', 'DE', 'updated'), ('f9', 'c9', 'FR', 'created')) t(flow, category, geo, delta)")
def factor_diff(spark, sf):
    """Factors of two releases, compared under the ids that flows and categories have now."""
    return releases.factor_diff(*frames(spark, BEFORE, AFTER, FLOW_FATES, CATEGORY_FATES))


@query("SELECT user_id::VARCHAR AS uuid, event_type AS step, row_number() OVER (PARTITION BY user_id ORDER BY event_id)::INT AS version, user_id || '#' || row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS entity FROM events")
def provenance(spark, sf):
    """Every change as a numbered version of what it changed."""
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("uuid"), F.col("event_type").alias("step"), F.col("event_id").alias("change_index"))
    return releases.provenance(e)


@query("SELECT event_type AS before, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS after, count(DISTINCT user_id) AS flows FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2")
def applied_renames(spark, sf):
    """Renames folded to pairs, with the flows that they changed."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("uuid"), F.col("event_type").alias("before"), F.when(F.col("value") > 50, "high").otherwise("low").alias("after"), F.when(F.col("event_id") % 2 == 0, "pref").otherwise("unit").alias("field"))
    return releases.applied_pairs(e)


REACHED = Fixture("reached", "name string, object_id string", [("Lead", "o1"), ("zinc", "o1"), ("ZINC ", "o3"), ("Tin", "o9")])
CALLED = Fixture("called", "object_id string, pref string", [("o1", "Lead"), ("o2", "Zinc"), ("o3", "Iron"), ("o4", "zinc")])


@query("SELECT * FROM (VALUES ('zinc', 'o1', 'o2'), ('zinc', 'o1', 'o4'), ('ZINC ', 'o3', 'o2'), ('ZINC ', 'o3', 'o4')) t(name, reaches, names)")
def unreachable_names(spark, sf):
    """Names that reach one object while another is called so."""
    return releases.unreachable_names(*frames(spark, REACHED, CALLED))


RENAMES = Fixture("renames", "current string, replacement string", [("Plumbum", "Lead"), ("Lead", "Plumbum"), ("Lead", "Zinc"), ("x", "y")])
KNOWN = Fixture("known", "name string", [("lead",), ("Zinc",)])


@query("SELECT * FROM (VALUES ('Plumbum', 'Lead', 'better'), ('Lead', 'Plumbum', 'worse'), ('Lead', 'Zinc', 'both-known'), ('x', 'y', 'neither')) t(current, replacement, verdict)")
def label_verdicts(spark, sf):
    """Whether a registry knows the new name, the old one, both or neither."""
    return releases.label_verdicts(*frames(spark, RENAMES, KNOWN))


@query("""WITH a AS (SELECT o_custkey % 3 AS list, o_orderkey AS uuid, o_orderstatus AS o, o_orderpriority AS t FROM orders WHERE o_orderkey % 11 <> 0), b AS (SELECT o_custkey % 3 AS list, o_orderkey AS uuid, CASE WHEN o_orderkey % 5 = 0 THEN 'P' ELSE o_orderstatus END AS o, CASE WHEN o_orderkey % 7 = 0 THEN 'moved' ELSE o_orderpriority END AS t FROM orders WHERE o_orderkey % 13 <> 0)
    SELECT CASE WHEN a.o IS NULL THEN 'new' WHEN b.o IS NULL THEN 'gone' WHEN a.o <> b.o THEN 'outcome' WHEN a.t <> b.t THEN 'target' ELSE 'same' END AS change, coalesce(a.o, '-') AS outcome_before, coalesce(b.o, '-') AS outcome_after, count(*) AS rows FROM a FULL JOIN b USING (list, uuid) GROUP BY 1, 2, 3""")
def outcome_changes(spark, sf):
    """What two builds decided differently about the same rows."""
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 3).alias("list"), F.col("o_orderkey").alias("uuid"), F.col("o_orderstatus").alias("outcome"), F.col("o_orderpriority").alias("target"))
    after = o.where("uuid % 13 <> 0").withColumns({"outcome": F.when(F.col("uuid") % 5 == 0, "P").otherwise(F.col("outcome")), "target": F.when(F.col("uuid") % 7 == 0, "moved").otherwise(F.col("target"))})
    return releases.outcome_changes(o.where("uuid % 11 <> 0"), after)


@query("SELECT lists, count(*) AS rows FROM (SELECT l_partkey, string_agg(DISTINCT l_returnflag, '+' ORDER BY l_returnflag) AS lists FROM lineitem WHERE l_quantity > 45 GROUP BY 1) GROUP BY 1")
def list_differences(spark, sf):
    """What each combination of lists has in common and no other."""
    return releases.list_differences(table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("uuid"), F.col("l_returnflag").alias("list")))


@query("""WITH g AS (SELECT l_returnflag AS category, l_linestatus AS context, l_quantity AS amount, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1, 2, 3 HAVING count(DISTINCT l_suppkey) > 1) SELECT category, max(n) AS substances, count(*) AS numbers FROM g GROUP BY 1""")
def identity_crossings(spark, sf):
    """Numbers that several substances share."""
    l = table(spark, sf, "lineitem").withColumn("flow", F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]))
    return releases.identity_crossings(l.select("flow", F.col("l_returnflag").alias("category"), F.col("l_quantity").alias("amount")), l.select("flow", F.col("l_suppkey").alias("substance"), F.col("l_linestatus").alias("context")))


PAIRED = Fixture("paired", "source string, target string", [("a", "x"), ("b", "y"), ("c", "z"), ("d", "x")])
REGISTERED = Fixture("registered", "id string, cas string", [("a", "1"), ("a", "2"), ("x", "2"), ("b", "3"), ("y", "4"), ("y", "5"), ("z", "6"), ("d", "9")])


@query("SELECT * FROM (VALUES ('b', 'y'), ('d', 'x')) t(source, target)")
def correspondence_audit(spark, sf):
    """Pairs whose ends both have numbers, none in common."""
    return releases.correspondence_audit(*frames(spark, PAIRED, REGISTERED))


@query("SELECT CASE WHEN p_partkey % 3 = 0 THEN 'same' WHEN p_partkey % 3 = 1 THEN 'case' ELSE 'spacing' END AS difference, count(*) AS rows FROM part GROUP BY 1")
def case_survey(spark, sf):
    """How published names differ from shipped ones that fold alike."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("uuid"), F.lower("p_type").alias("shipped"))
    k = F.col("uuid") % 3
    return releases.case_survey(p, p.select("uuid", F.when(k == 0, F.col("shipped")).when(k == 1, F.upper("shipped")).otherwise(F.concat(F.lit(" "), "shipped")).alias("published")))


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def selected_rows(spark, sf):
    """Rows that an expectation's selector is about."""
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "uuid")
    links = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("uuid"))
    return releases.source_rows(o, {"o_orderstatus": "F", "o_orderpriority": "2-HIGH", "linked": "no"}, links).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, abs(p_retailprice - 1000.5) <= 0.05 + 1e-12 AS tenth, abs(p_retailprice - 1000) <= 0.5 + 1e-12 AS whole FROM part")
def stated_precision(spark, sf):
    """Whether numbers agree with a claim at the claim's own last figure."""
    return table(spark, sf, "part").select("p_partkey", releases.agrees_as_stated(F.lit("1000.5"), F.col("p_retailprice")).alias("tenth"), releases.agrees_as_stated(F.lit("1000"), F.col("p_retailprice")).alias("whole"))


# --- review pages ----------------------------------------------------------------------------------


@query("""SELECT o_orderkey, o_totalprice, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT' ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50 OFFSET 50""")
def flow_page(spark, sf):
    """A filtered, sorted page with its joined labels: the page is the feature."""
    o = pages.filtered(table(spark, sf, "orders"), {"o_orderstatus": ["F", "O"], "o_orderpriority": "1-URGENT", "o_custkey": ""})
    order = pages.order_by("-price", {"price": F.col("o_totalprice"), "key": F.col("o_orderkey")}, "key", F.col("o_orderkey"))
    page = groups.page(o.select("o_orderkey", "o_totalprice", "o_custkey"), order, pages.resolve_page(2, 10_000))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return page.join(c, "o_custkey", "left").select("o_orderkey", "o_totalprice", "c_name")


@query("""WITH t AS (SELECT DISTINCT page_id, unnest(regexp_split_to_array(lower(concat_ws(' ', url, html)), '[^a-z0-9]+')) AS w FROM pages) SELECT DISTINCT a.page_id FROM t a JOIN t b USING (page_id) WHERE a.w = 'html' AND b.w LIKE 'ht%'""")
def token_pages(spark, sf):
    """Pages that hold all terms of a query, one of them a prefix."""
    return pages.search(pages.token_table(table(spark, sf, "pages"), "page_id", ["url", "html"]), "page_id", 'HTML "ht*"')


KEYS = Fixture("keys_", "object_id string, by string, k string", [("o1", "cas", "7439-92-1"), ("o2", "label", "lead"), ("o3", "label", "white lead"), ("o4", "structure", "ABC-D")])


@query("SELECT 'o2' AS object_id, 'label' AS by")
def exact_hits(spark, sf):
    """Objects that a whole query names."""
    return pages.exact_match("  LEAD ", KEYS.df(spark))


@query("""SELECT l_orderkey AS object_id, l_partkey AS context, count(*) AS n, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) AS flows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_contexts(spark, sf):
    """Contexts in which an object has several flows."""
    return pages.duplicate_contexts(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("object_id"), F.col("l_partkey").alias("context"), F.col("l_linenumber").cast("string").alias("flow")))


TWICE = Fixture("twice", "object_id string, cas array<string>, alts array<string>", [("o1", ["1-1", "1-1"], ["Lead", "lead "]), ("o2", ["2-2"], ["2-2", "x"]), ("o3", ["3"], ["y"]), ("o4", [], [])])


@query("SELECT * FROM (VALUES ('o1', 1, 1, 0), ('o2', 0, 0, 1)) t(object_id, numbers, labels, as_label)")
def self_duplicates(spark, sf):
    """Objects that collide with themselves."""
    return pages.self_duplicates(TWICE.df(spark))


ACTIVE = Fixture("active", "flow string, unit string, details string", [("f1", "kBq", '{"isotope": "U-238"}'), ("f2", "Bq", "{}"), ("f3", " kbq ", None), ("f4", "kg", "{}"), ("f5", "becquerel", '{"isotope": ""}')])


@query("SELECT * FROM (VALUES ('f2', 'Bq'), ('f3', ' kbq '), ('f5', 'becquerel')) t(flow, unit)")
def activity_gaps(spark, sf):
    """Flows of radioactivity whose object names no isotope."""
    return pages.activity_gaps(ACTIVE.df(spark))


SCORED = Fixture("scored", "uuid string, candidates string", [("1", '[{"target": "a", "score": 1.0}, {"target": "b", "score": 3.0}, {"target": "c", "score": 2.0}, {"target": "d", "score": 0.5}]'), ("2", "[]"), ("3", '[{"target": "z", "score": 1.0}]')])


@query("SELECT * FROM (VALUES ('1', 4, 'b,c,a', 3.0::DOUBLE), ('2', 0, '', NULL), ('3', 1, 'z', 1.0)) t(uuid, candidates, best, score)")
def candidate_summaries(spark, sf):
    """The best of the scored candidates that a row's JSON holds."""
    return pages.candidate_summaries(SCORED.df(spark))


FOUND = Fixture("found", "kind string, details string", [("x", '{"rows": ["a", "b", "a"]}'), ("x", '{"rows": ["a", "b"]}'), ("x", '{"rows": ["c"]}'), ("y", '{"rows": []}')])


@query("SELECT * FROM (VALUES ('x', 2, 2::BIGINT), ('x', 1, 1), ('y', 0, 1)) t(kind, sources, rows)")
def finding_sources(spark, sf):
    """Findings by how many different sources their JSON names."""
    return pages.distinct_json(FOUND.df(spark), "$.rows", "kind")


@query("""WITH c AS (SELECT c_nationkey AS node, count(*) AS n FROM customer GROUP BY 1), n AS (SELECT n_nationkey AS node, n_regionkey AS family, n_name AS label, CASE WHEN n_nationkey % 5 <> 0 AND p.r = n_regionkey THEN n_nationkey - 1 END AS parent FROM nation LEFT JOIN (SELECT n_nationkey AS k, n_regionkey AS r FROM nation) p ON p.k = n_nationkey - 1)
    SELECT family, n.node, parent, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY family, parent ORDER BY coalesce(n, 0) DESC, label, n.node)::INT AS place FROM n LEFT JOIN c USING (node)""")
def role_forest(spark, sf):
    """A forest within families, siblings by count."""
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    nodes = n.select(F.col("n_nationkey").alias("node"), F.col("n_regionkey").alias("family"), F.col("n_name").alias("label"))
    edges = n.where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("node"), (F.col("n_nationkey") - 1).alias("parent"))
    return pages.forest(nodes, edges, c.groupBy(F.col("c_nationkey").alias("node")).agg(F.count(F.lit(1)).alias("n")))


@query("""WITH f AS (SELECT p_brand || '/' || p_size % 3 AS key FROM part), o AS (SELECT key, count(*) AS own FROM f GROUP BY 1), n AS (SELECT DISTINCT key FROM f UNION SELECT DISTINCT p_brand FROM part)
    SELECT n.key, coalesce(o.own, 0) AS own, (SELECT sum(x.own) FROM o x WHERE x.key = n.key OR starts_with(x.key, n.key || '/'))::BIGINT AS whole FROM n LEFT JOIN o USING (key)""")
def taxonomy_rollup(spark, sf):
    """Flows of each class, alone and with its narrower ones."""
    p = table(spark, sf, "part")
    flows = p.select(F.concat_ws("/", "p_brand", (F.col("p_size") % 3).cast("string")).alias("key"))
    return pages.rolled_up(flows.unionAll(p.select("p_brand")).distinct(), flows)


@query(f"""WITH p AS (SELECT l_partkey, max(CASE WHEN l_returnflag = 'A' THEN l_extendedprice / l_quantity END) AS l, max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice / l_quantity END) AS r FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_quantity > 40 GROUP BY 1), x AS (SELECT l, r, least(l, r) AS lo, greatest(l, r) AS hi FROM p)
    SELECT CASE WHEN r IS NULL THEN 'left-only' WHEN l IS NULL THEN 'right-only' WHEN l = r THEN 'identical' ELSE 'shared' END AS state, CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN {BAND} END AS band, count(*) AS rows FROM x GROUP BY 1, 2""")
def pair_differences(spark, sf):
    """Two implementations side by side."""
    l = table(spark, sf, "lineitem").where("l_quantity > 40").withColumn("amount", F.col("l_extendedprice") / F.col("l_quantity"))
    return pages.compared_pair(l, ["l_partkey"], "l_returnflag", "amount", "A", "R")


@query("SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'open', count(*) FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'customers', count(*) FROM customer")
def overview_tallies(spark, sf):
    """Headline counts of a build."""
    o = table(spark, sf, "orders")
    return pages.tallies({"orders": o, "open": o.where("o_orderstatus = 'O'"), "customers": table(spark, sf, "customer")})


@query("SELECT o_orderpriority AS reason, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority)::INT AS place FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def reason_breakdown(spark, sf):
    """Reasons of unmatched rows, most frequent first."""
    g = table(spark, sf, "orders").where("o_orderstatus = 'O'").groupBy(F.col("o_orderpriority").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "reason")))  # a closed vocabulary, already counted


@query("SELECT o_orderstatus AS list, year(o_orderdate)::INT AS version, count(*) AS n, count(DISTINCT o_custkey) AS names, count(DISTINCT nullif(o_orderpriority, '5-LOW')) AS targets FROM orders GROUP BY 1, 2")
def input_counts(spark, sf):
    """Rows, names and targets of every list and version."""
    return table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("list"), F.year("o_orderdate").alias("version")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("names"), F.count_distinct(F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("targets"))


@query("SELECT p_partkey, p_name, s_suppkey, sum(l_quantity)::DOUBLE AS amount FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE p_partkey = 7 GROUP BY 1, 2, 3")
def flow_detail(spark, sf):
    """One flow with what it is joined to; the filter reaches the scan."""
    p, l, s = table(spark, sf, "part").where("p_partkey = 7"), table(spark, sf, "lineitem").where("l_partkey = 7"), table(spark, sf, "supplier")
    j = p.join(l, p.p_partkey == l.l_partkey).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.groupBy("p_partkey", "p_name", "s_suppkey").agg(F.sum("l_quantity").alias("amount"))


@query("SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderstatus = 'F', o_orderkey)::BIGINT AS place FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey <= 400")
def unit_disagreements(spark, sf):
    """Flagged rows, undecided first, in a stable order."""
    o = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderkey <= 400").select("o_orderkey", "o_orderstatus")
    return groups.numbered(o, [], [F.col("o_orderstatus") == "F", F.col("o_orderkey")], "place").withColumn("place", F.col("place").cast("long"))
