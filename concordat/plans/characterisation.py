"""Factor passes over small authored tables and over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import characterise, factors
from ..sources.tables import table
from .registry import Fixture, having, query

FACTS = Fixture(
    "facts",
    "flow string, substance string, context string, unit string, live boolean",
    [
        ("f1", "lead", "air", "kg", True), ("f2", "lead", "water", "kg", True), ("f3", "lead", "soil", "kg", True), ("f4", "zinc", "air", "kg", True), ("f5", "zinc", "water", "kg", True), ("f6", "zinc", "sea", "kg", True),
        ("f7", "lead ion", "air", "kg", True), ("f8", "lead ion", "water", "g", True), ("f9", "lead ion", "soil", "kg", False), ("f10", "tin", "air", "kg", True), ("f11", "tin", "water", "kg", True), ("f12", "tin", "soil", "kg", True),
    ],
)
PUBLISHED = Fixture("published", "flow string, category string, geo string, amount double", [("f1", "tox", "", 10.0), ("f2", "tox", "", 12.0), ("f4", "tox", "", 3.0), ("f5", "tox", "", 3.0), ("f1", "gwp", "", 1.25), ("f10", "gwp", "", 0.5), ("f11", "gwp", "", 0.5), ("f4", "acid", "DE", 2.0)])
STATED = Fixture("stated", "impl string, flow string, category string, geo string, amount double", [("A", "f1", "tox", "", 10.0), ("B", "f1", "tox", "", 10.0), ("A", "f2", "tox", "", 12.0), ("A", "f4", "tox", "", 3.0), ("A", "f5", "tox", "", 3.0), ("B", "f5", "tox", "", 3.1), ("A", "f1", "gwp", "", 1.25), ("A", "f6", "tox", "", 99.0), ("A", "f8", "gwp", "", 7.0), ("A", "f10", "gwp", "", 0.5), ("A", "f11", "gwp", "", 0.5), ("A", "f4", "acid", "DE", 2.0)])


def frames(spark, *fixtures):
    return [f.df(spark) for f in fixtures]


RECORDED = Fixture("recorded", "flow string, category string, geo string, impl string, amount double", [("f1", "tox", "", "A", 10.0), ("f1", "tox", "", "B", 10.0), ("f5", "tox", "", "A", 3.0), ("f4", "tox", "", "A", 3.0), ("f2", "tox", "", "A", 11.0)])


@query(
    having(RECORDED, STATED)
    + """, r AS (SELECT flow, category, geo, list(impl || '=' || amount ORDER BY impl, amount) AS l FROM recorded GROUP BY ALL), s AS (SELECT flow, category, geo, list(impl || '=' || amount ORDER BY impl, amount) AS l FROM stated GROUP BY ALL)
    SELECT flow, category, geo FROM r JOIN s USING (flow, category, geo, l)"""
)
def recorded_holds(spark, sf):
    """Keys of which the publishers still say exactly what was recorded."""
    return characterise.recorded_holds(*frames(spark, RECORDED, STATED), ["flow", "category", "geo"])


OPEN = Fixture("open", "flow string, category string, geo string", [("f1", "tox", ""), ("f5", "tox", ""), ("f4", "tox", ""), ("f2", "tox", ""), ("f6", "tox", "")])
RULINGS = Fixture("rulings", "flow string, category string, geo string, amount double", [("f1", "tox", "", 10.0), ("f5", "tox", "", 3.0), ("f4", "tox", "", None)])


@query("SELECT * FROM (VALUES ('f1', 'tox', '', 10.0::DOUBLE, 'ruled'), ('f5', 'tox', '', NULL, 'stale'), ('f4', 'tox', '', NULL, 'declined'), ('f2', 'tox', '', NULL, 'question'), ('f6', 'tox', '', NULL, 'question')) t(flow, category, geo, amount, verdict)")
def factor_rulings(spark, sf):
    """Open questions that a ruling answers, as long as its numbers hold."""
    return characterise.ruled(*frames(spark, OPEN, RULINGS, RECORDED, STATED))


MOVES = Fixture("moves", "source string, category string, target string", [("lead", "tox", "lead ion"), ("zinc", "tox", "tin")])
MOVE_RECORDED = Fixture("recorded", RECORDED.schema, [("f1", "tox", "", "A", 10.0), ("f1", "tox", "", "B", 10.0), ("f2", "tox", "", "A", 12.0), ("f4", "tox", "", "A", 3.0)])
ARGS = (MOVES, MOVE_RECORDED, STATED, FACTS)


@query("SELECT * FROM (VALUES ('f7', 'tox', '', 10.0::DOUBLE), ('f8', 'tox', '', 12.0), ('f10', 'tox', '', 3.0), ('f5', 'tox', '', 3.0), ('f1', 'gwp', '', 1.25), ('f10', 'gwp', '', 0.5), ('f11', 'gwp', '', 0.5), ('f4', 'acid', 'DE', 2.0)) t(flow, category, geo, amount)")
def factor_moves(spark, sf):
    """A category's factors moved to another substance in the same contexts."""
    return characterise.moved(PUBLISHED.df(spark), *frames(spark, *ARGS))[0]


@query("SELECT * FROM (VALUES ('moved', 3::BIGINT), ('stale', 1), ('untouched', 4)) t(verdict, rows)")
def factor_move_counts(spark, sf):
    """How many rows moved, stayed because their numbers changed, or weren't meant."""
    return characterise.moved(PUBLISHED.df(spark), *frames(spark, *ARGS))[1]


PRINTINGS = Fixture("printings", "impl string, flow string, category string, geo string, rounded double, precise double", [("A", "f1", "gwp", "", 1.25, 1.2483), ("A", "f2", "tox", "", 11.9, 11.92), ("B", "f1", "tox", "", 9.9, 9.87)])


@query(having(PUBLISHED) + " SELECT flow, category, geo, CASE WHEN flow = 'f1' AND category = 'gwp' THEN 1.2483 ELSE amount END AS amount, flow = 'f1' AND category = 'gwp' AS refined FROM published")
def factor_refinements(spark, sf):
    """Rounded numbers replaced by precise ones where the printing still holds."""
    return characterise.refined(*frames(spark, PUBLISHED, PRINTINGS, STATED))


ADOPTIONS = Fixture("adoptions", "donor string, recipient string, category string", [("lead", "lead ion", "tox"), ("lead", "lead ion", "gwp"), ("zinc", "tin", "tox"), ("tin", "zinc", "gwp")])


@query("SELECT * FROM (VALUES ('f7', 'tox', '', 10.0::DOUBLE, 'adopted'), ('f8', 'tox', '', NULL, 'unit'), ('f7', 'gwp', '', NULL, 'spoken'), ('f10', 'tox', '', 3.0, 'adopted'), ('f11', 'tox', '', 3.0, 'adopted'), ('f4', 'gwp', '', 0.5, 'adopted'), ('f5', 'gwp', '', 0.5, 'adopted')) t(flow, category, geo, amount, verdict)")
def factor_adoptions(spark, sf):
    """A donor's numbers for a recipient that nobody speaks of."""
    return characterise.adopted(*frames(spark, PUBLISHED, ADOPTIONS, STATED, FACTS))


CARRY = Fixture("carry", "ordinal int, direction string, recipient string, donors array<string>", [(0, "down", "soil", ["sea", "water"]), (1, "up", "sea", ["air", "water"]), (2, "down", "water", ["soil"]), (3, "up", "soil", ["air", "water"])])


@query("SELECT * FROM (VALUES ('f3', 'tox', '', 12.0::DOUBLE, 0), ('f12', 'gwp', '', 0.5, 0), ('f3', 'gwp', '', 1.25, 3), ('f6', 'acid', 'DE', 2.0, 1)) t(flow, category, geo, amount, rule)")
def factor_carries(spark, sf):
    """Blanks filled from other contexts by ordered rules; what is spoken of isn't blank."""
    return characterise.carried(*frames(spark, PUBLISHED, CARRY, STATED, FACTS))


SIZES = Fixture("sizes", "flow string, substance string, size string, context string, unit string, live boolean", [("p1", "dust", "pm10", "air", "kg", True), ("p2", "dust", "pm2.5", "air", "kg", True), ("p3", "dust", "all", "air", "kg", True), ("p4", "dust", "pm10", "indoor", "kg", True), ("p5", "dust", "all", "indoor", "kg", True), ("p6", "soot", "pm10", "air", "kg", True), ("p7", "soot", "pm2.5", "air", "kg", True), ("p8", "soot", "all", "air", "kg", True)])
SIZE_PUBLISHED = Fixture("published", PUBLISHED.schema, [("p1", "pm", "", 4.0), ("p2", "pm", "", 4.0), ("p4", "pm", "", 9.0), ("p6", "pm", "", 1.0), ("p7", "pm", "", 2.0)])
SIZE_RULES = Fixture("carry", CARRY.schema, [(0, "up", "all", ["pm10", "pm2.5"])])
NOBODY = Fixture("stated", STATED.schema, [("A", "x", "pm", "", 1.0)])


@query("SELECT 'p3' AS flow, 'pm' AS category, '' AS geo, 4.0::DOUBLE AS amount, 0 AS rule")
def size_class_carries(spark, sf):
    """Over size classes within a context: every donor must be there, and all agree."""
    return characterise.carried(*frames(spark, SIZE_PUBLISHED, SIZE_RULES, NOBODY, SIZES), place="size")


RELATIVES = Fixture("relatives", "substance string, relative string", [("lead ion", "lead"), ("zinc", "tin"), ("tin", "zinc")])


@query(
    having(FACTS, PUBLISHED, STATED, RELATIVES)
    + """, h AS (SELECT DISTINCT substance AS relative, context, category, geo FROM published JOIN facts USING (flow)), s AS (SELECT flow, category, geo FROM published UNION SELECT flow, category, geo FROM stated)
    SELECT f.substance, r.relative, h.category, count(*) AS blanks FROM facts f JOIN relatives r USING (substance) JOIN h ON h.relative = r.relative AND h.context = f.context WHERE live AND NOT EXISTS (SELECT 1 FROM s WHERE s.flow = f.flow AND s.category = h.category AND s.geo = h.geo) GROUP BY ALL"""
)
def identity_blanks(spark, sf):
    """Blanks beside a related substance that is published there."""
    return characterise.identity_blanks(*frames(spark, PUBLISHED, STATED, RELATIVES, FACTS))


QUESTIONS = Fixture("questions", "queue string, flow string, category string", [("contested", "f1", "tox"), ("contested", "f2", "tox"), ("proposed", "f4", "tox"), ("proposed", "f5", "gwp")])


@query(having(QUESTIONS, FACTS) + " SELECT queue, substance, category, count(*) AS items, string_agg(flow, ',' ORDER BY flow) AS flows FROM questions JOIN facts USING (flow) GROUP BY ALL")
def factor_queue(spark, sf):
    """Open questions as one item for each substance and category."""
    return characterise.queued(*frames(spark, QUESTIONS, FACTS))


SOURCE = Fixture("source", "uuid string, name string, cas array<string>, context string", [("a", "Lead", ["7439-92-1"], "air"), ("b", "Zinc oxide", ["1314-13-2"], "air"), ("c", "Zinc", [], "air"), ("d", "Mix", ["7439-92-1", "7440-66-6"], "air"), ("e", "Tin", [], "soil"), ("f", "Any", [], "air"), ("g", "Gone", [], "air"), ("h", "zinc", ["7440-66-6", "7440-31-5"], "water")])
NUMBERS = Fixture("numbers", "context string, cas string, target string", [("air", "7439-92-1", "f1"), ("air", "7440-66-6", "f4"), ("water", "7440-66-6", "f5"), ("water", "7440-31-5", "f11"), ("air", "1314-13-2", "f4")])
LABELS = Fixture("labels_", "context string, label string, target string", [("air", "zinc", "f4"), ("water", "zinc", "f5"), ("soil", "tin", "f12"), ("soil", "tin", "f13"), ("air", "lead", "f1")])
DECIDED = Fixture("decided", "uuid string, target string", [("f", "f7")])
ASIDE = Fixture("aside", "uuid string", [("g",)])
SUBSTANCE = (SOURCE, NUMBERS, LABELS, DECIDED, ASIDE)


@query("SELECT * FROM (VALUES ('a', 'f1', 'number'), ('b', 'f4', 'number'), ('c', 'f4', 'name'), ('f', 'f7', 'decision'), ('h', 'f5', 'number+name')) t(uuid, target, basis)")
def substance_targets(spark, sf):
    """Publishers' flows by decision, number, number and name, and name."""
    return characterise.substance_targets(*frames(spark, *SUBSTANCE))[0]


@query("SELECT * FROM (VALUES ('d', 'number', 2::BIGINT), ('e', 'name', 2)) t(uuid, basis, targets)")
def substance_findings(spark, sf):
    """Flows that several targets suit."""
    return characterise.substance_targets(*frames(spark, *SUBSTANCE))[1]


REGIONAL = Fixture("regional", "uuid string, context string, stem string, place string", [("1", "air", "Water", "DE"), ("2", "air", "water", None), ("3", "sea", "Water", "DE"), ("4", "sea", "Water", "GLO"), ("5", "soil", "Water", "DE"), ("6", "soil", "Water", "FR"), ("7", "soil", "Lead", None)])


@query("SELECT * FROM (VALUES ('1', 'site-generic sibling'), ('3', 'not the global member'), ('5', 'no global member'), ('6', 'no global member')) t(uuid, why)")
def places_aside(spark, sf):
    """Rows with a place in their name that go."""
    return characterise.places_aside(REGIONAL.df(spark))


ROWS = Fixture("rows_", "impl string, uuid string, category string, geo string, amount double, unit string", [("A", "a", "tox", "", 10.0, "kg"), ("A", "b", "tox", "", 10.1, "kg"), ("A", "c", "tox", "", 5.0, "g"), ("A", "d", "tox", "", 5.0, "lb"), ("A", "e", "tox", "", 1.0, "kg"), ("A", "f", "tox", "", 2.0, "kg"), ("A", "z", "tox", "", 2.0, "kg"), ("B", "a", "tox", "", 1.0, "kg"), ("B", "b", "tox", "", 2.0, "kg"), ("A", "g", "tox", "", 3.0, "kg")])
TO = Fixture("to_", "uuid string, flow string", [("a", "f1"), ("b", "f1"), ("c", "f2"), ("d", "f2"), ("e", "old1"), ("f", "old2"), ("g", "ring1")])
RETIRED = Fixture("redirects", "id string, replaced_by string", [("old1", "mid"), ("mid", "f4"), ("old2", "dead"), ("ring1", "ring2"), ("ring2", "ring1")])
CONVERSIONS = Fixture("conv", "flow string, source string, target string, factor double", [("f2", "g", "kg", 0.001)])
LIVE = Fixture("live", "flow string, unit string", [("f1", "kg"), ("f2", "kg"), ("f4", "kg")])
MATCH = (ROWS, TO, RETIRED, CONVERSIONS, LIVE)


@query("SELECT * FROM (VALUES ('A', 'f1', 'tox', '', 10.1::DOUBLE), ('A', 'f2', 'tox', '', 5000.0), ('A', 'f4', 'tox', '', 1.0)) t(impl, flow, category, geo, amount)")
def factors_matched(spark, sf):
    """A publisher's factors on our flows: redirects followed, units converted, collisions settled."""
    return characterise.matched(*frames(spark, *MATCH))[0]


@query("SELECT * FROM (VALUES ('unit', 1::BIGINT), ('retired', 2), ('unmatched', 1), ('collision', 2)) t(kind, rows)")
def factors_lost(spark, sf):
    """What is lost on the way, by kind."""
    return characterise.matched(*frames(spark, *MATCH))[1]


@query("SELECT * FROM (VALUES ('old1', 'f4', 'replaced'), ('mid', 'f4', 'replaced'), ('old2', NULL, 'dead-end'), ('ring1', NULL, 'cycle'), ('ring2', NULL, 'cycle')) t(id, terminal, why)")
def retired_flows(spark, sf):
    """Where retired flows' factors go."""
    return characterise.retired(*frames(spark, RETIRED, LIVE))


@query("""WITH l AS (SELECT l_partkey AS uuid, arg_min(l_suppkey, (CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END) * 10000000::BIGINT + l_orderkey * 10 + l_linenumber) AS target, min(CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END) AS o FROM lineitem GROUP BY 1)
    SELECT p_partkey AS uuid, target, ['R', 'A', 'N'][o + 1] AS list FROM part LEFT JOIN l ON uuid = p_partkey""")
def chained_targets(spark, sf):
    """The first list of a chain that knows a part, and its answer."""
    l = table(spark, sf, "lineitem")
    place = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    ordinal = place.cast("long") * 10_000_000 + F.col("l_orderkey") * 10 + F.col("l_linenumber")  # of order keys from a million on, lists overlap in it
    links = l.select(F.col("l_partkey").alias("uuid"), F.col("l_suppkey").alias("target"), F.get(F.array(*map(F.lit, "RAN")), place).alias("list"), place.alias("place"), ordinal.alias("ordinal"))
    return characterise.chained_targets(table(spark, sf, "part").select(F.col("p_partkey").alias("uuid")), links)


@query("""SELECT l_partkey AS flow, l_returnflag AS source, l_linestatus AS target, min(l_tax) AS factor FROM lineitem GROUP BY 1, 2, 3 HAVING min(l_tax) = max(l_tax)""")
def unanimous_conversions(spark, sf):
    """Conversions on which all records agree."""
    return characterise.unanimous_conversions(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("flow"), F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("target"), F.col("l_tax").alias("factor")))


CROSSWALK = Fixture("crosswalk", "impl string, identifier string, name string, slug string", [("A", "id1", "Climate change", "gwp"), ("A", None, "Acidification", "acid"), ("B", "id1", "Toxicity", "tox")])
CATEGORIES = Fixture("cats", "key int, impl string, identifier string, name string", [(1, "A", "id1", "whatever"), (2, "A", "zz", "acidification"), (3, "B", "id1", "Climate change"), (4, "B", "zz", "Acidification")])


@query("SELECT * FROM (VALUES (1, 'gwp', 'identifier'), (2, 'acid', 'name'), (3, 'tox', 'identifier'), (4, NULL, 'none')) t(key, slug, how)")
def category_crosswalk(spark, sf):
    """Our category by the publisher's identifier, then by its name."""
    return characterise.category_of(*frames(spark, CATEGORIES, CROSSWALK))


@query("SELECT * FROM (VALUES ('B', 'sheet'), ('C', 'crosswalk')) t(category, side)")
def crosswalk_gaps(spark, sf):
    """Categories that only one of two tables has."""
    return characterise.crosswalk_gaps(spark.createDataFrame([("A",), ("B",)], "category string"), spark.createDataFrame([("A",), ("C",)], "category string"))


@query("""SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_factors(spark, sf):
    """Keys that a sheet has more than once."""
    return characterise.unique_factors(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@query("""WITH t AS (SELECT o_orderkey AS k, o_totalprice AS a, o_orderpriority = '5-LOW' AS d FROM orders WHERE o_orderkey % 50 <> 0), s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS a FROM orders WHERE (o_orderpriority <> '5-LOW' OR o_orderkey % 20 = 0) AND o_orderkey % 30 <> 0),
    j AS (SELECT CASE WHEN t.k IS NULL THEN 'only-in-sibling' WHEN s.k IS NULL AND NOT d THEN 'missing' WHEN s.k IS NOT NULL AND d THEN 'kept' WHEN s.k IS NOT NULL AND t.a <> s.a THEN 'number' END AS fault FROM t FULL JOIN s ON t.k = s.k) SELECT fault, count(*) AS rows FROM j WHERE fault IS NOT NULL GROUP BY 1""")
def sibling_check(spark, sf):
    """A table against the sibling that should be it without some rows."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    s = o.where(((F.col("o_orderpriority") != "5-LOW") | (k % 20 == 0)) & (k % 30 != 0)).select("o_orderkey", F.when(k % 9 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return characterise.sibling_check(o.where(k % 50 != 0), s, ["o_orderkey"], "o_totalprice", F.col("o_orderpriority") == "5-LOW")


@query("""WITH i AS (SELECT c_mktsegment, c_nationkey, min(c_custkey)::VARCHAR AS lo, max(c_custkey)::VARCHAR AS hi FROM customer WHERE c_custkey % 20 = 0 GROUP BY 1, 2) SELECT c_custkey, CASE WHEN lo = hi THEN lo END AS flow FROM customer LEFT JOIN i USING (c_mktsegment, c_nationkey)""")
def factor_flows(spark, sf):
    """Rows with the flow that their key is of, if it is one flow's."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    i = c.where("c_custkey % 20 = 0").withColumn("uuid", F.col("c_custkey").cast("string"))
    return characterise.resolved(c, i, ["c_mktsegment", "c_nationkey"]).select("c_custkey", "flow")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice END AS amount FROM orders""")
def signed_factors(spark, sf):
    """Numbers with the sign that category and direction call for."""
    flips = spark.createDataFrame([("F", "1-URGENT")], "category string, direction string")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("category"), F.col("o_orderpriority").alias("direction"), F.col("o_totalprice").alias("amount"))
    return characterise.signed(o, flips).select("o_orderkey", "amount")


@query("""WITH s AS (SELECT l_orderkey AS process, l_returnflag AS category, sum(l_quantity * p_retailprice) AS computed FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2), v AS (SELECT o_orderkey AS process, 'R' AS category, coalesce(computed, 0) + CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE 0 END AS stated, coalesce(computed, 0) AS computed FROM orders LEFT JOIN s ON process = o_orderkey AND category = 'R')
    SELECT process, category, round(stated, 2) AS stated, round(computed, 2) AS computed, abs(computed - stated) <= 1e-6 * greatest(1, abs(stated)) AS agrees FROM v""")
def scores_recomputed(spark, sf):
    """Stated scores against those of their own inventory and factors."""
    l, p, o = (table(spark, sf, t) for t in ("lineitem", "part", "orders"))
    inventory = l.select(F.col("l_orderkey").alias("process"), F.col("l_returnflag").alias("category"), F.col("l_partkey").alias("flow"), F.col("l_quantity").alias("amount"))
    factor = p.select(F.col("p_partkey").alias("flow"), F.col("p_retailprice").alias("factor"))
    own = inventory.join(factor, "flow").where("category = 'R'").groupBy("process").agg(F.sum(F.col("amount") * F.col("factor")).alias("s"))
    stated = o.select(F.col("o_orderkey").alias("process"), F.lit("R").alias("category")).join(own, "process", "left").select("process", "category", (F.coalesce("s", F.lit(0.0)) + F.when(F.col("process") % 3 == 0, 5).otherwise(0)).alias("score"))
    return characterise.recomputed(inventory, factor, stated).select("process", "category", F.round("stated", 2).alias("stated"), F.round("computed", 2).alias("computed"), "agrees")


@query("""SELECT 'line-part' AS reference, count(*) AS rows FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2) UNION ALL SELECT 'order-customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def artifact_references(spark, sf):
    """Rows of a list whose key another list lacks."""
    l, p = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k")), table(spark, sf, "part").where("p_size > 2").select(F.col("p_partkey").alias("k"))
    o, c = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return characterise.dangling({"line-part": (l, p, "k"), "order-customer": (o, c, "k")})


@query("""SELECT k AS key, CASE WHEN k = 'b' THEN NULL WHEN k = 'a' THEN 4.416 ELSE 2.0 END AS amount, CASE WHEN k = 'c' THEN 0 ELSE 1 END::BIGINT AS superseded FROM (VALUES ('a'), ('b'), ('c')) t(k)""")
def settled_precisely(spark, sf):
    """Numbers that agree settle on the one that is printed to more digits."""
    rows = spark.createDataFrame([("a", 1, 4.42), ("a", 2, 4.416), ("b", 1, 1.0), ("b", 2, 5.0), ("c", 1, 2.0)], "key string, o int, x double")
    return factors.settle_precise(rows, ["key"], "x", ["o"]).select("key", F.when(~F.isnan("amount"), F.col("amount")).alias("amount"), "superseded")


DOCS = Fixture("docs_", "category string, name string", [("tox", "Toxicity"), ("land", "Land use")])


@query("""SELECT 'tox' AS category, 'Toxicity' AS name, '{"category":"tox","name":"Toxicity","factors":[{"flow":"f1","geo":"","amount":10.0},{"flow":"f2","geo":"","amount":12.0},{"flow":"f4","geo":"","amount":3.0},{"flow":"f5","geo":"","amount":3.0}]}' AS document UNION ALL SELECT 'land', 'Land use', '{"category":"land","name":"Land use","factors":[]}'""")
def factor_document(spark, sf):
    """Factors nested under their category, as published."""
    return characterise.factor_document(*frames(spark, PUBLISHED, DOCS))
