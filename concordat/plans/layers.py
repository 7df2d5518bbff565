"""Layers and label passes over small authored tables and over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels, layers
from ..sources.tables import table
from .characterisation import frames
from .registry import Fixture, having, query

ENTITIES = Fixture(
    "entities",
    "ord long, exclusive string, name string, cas array<string>",
    [
        (1, None, "Alpha", ["1-1-1"]), (2, None, "alpha", []), (3, None, "Beta", ["1-1-1"]), (4, None, "Alpha", ["9-9-9"]), (5, "land:forest", "Alpha", []), (6, "land:forest", "Other", ["1-1-1"]),
        (7, None, "Gamma", ["2-2-2", "3-3-3"]), (8, None, "Delta", ["3-3-3"]), (9, None, "Delta", ["4-4-4"]), (10, None, "Beta", ["2-2-2"]), (11, None, "Epsilon", []), (12, None, "EPSILON", ["5-5-5"]), (13, None, "Zeta", ["5-5-5"]), (14, None, "Eta", ["9-9-9", "1-1-1"]),
    ],
)


@query("""SELECT * FROM (VALUES (1, 1, 'founded'), (2, 1, 'joined'), (3, 1, 'joined'), (4, 4, 'founded'), (5, 5, 'exclusive'), (6, 5, 'exclusive'), (7, 7, 'founded'), (8, 7, 'joined'), (9, 9, 'founded'), (10, 7, 'by-number'),
    (11, 11, 'founded'), (12, 11, 'joined'), (13, 11, 'joined'), (14, 14, 'founded')) t(ord, owner, how)""")
def flow_layers(spark, sf):
    """The object of every row: first registrants of names, numbers and sets of numbers, in order."""
    return layers.layered(ENTITIES.df(spark)).select(F.col("ord").cast("int").alias("ord"), F.col("owner").cast("int").alias("owner"), "how")


@query("""WITH d AS (SELECT doc_id, source || '-' || lang || '-' || (n_chars % 50)::VARCHAR AS name FROM documents) SELECT doc_id AS ord, min(doc_id) OVER (PARTITION BY name) AS owner, CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY name) THEN 'founded' ELSE 'joined' END AS how FROM d""")
def flow_layers_by_name(spark, sf):
    """The same over a table, where names alone decide."""
    name = F.concat_ws("-", "source", "lang", (F.col("n_chars") % 50).cast("string"))
    return layers.layered(table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), F.lit(None).cast("string").alias("exclusive"), name.alias("name"), F.array().cast("array<string>").alias("cas")))


MEMBERS = Fixture("members", "owner int, ord int, name string, cas array<string>, qualified boolean", [(1, 1, "Zinc", ["b", "a"], False), (1, 2, "Zinc metal", ["a"], False), (1, 3, "zinc", [], False), (2, 4, "Carbon dioxide, fossil", ["c"], True), (2, 5, "CO2, fossil", [], True)])


@query("SELECT * FROM (VALUES (1, 'Zinc metal', 'a,b', 'Zinc,zinc'), (2, 'CO2, fossil', 'c', 'Carbon dioxide, fossil')) t(owner, label, cas, alts)")
def object_labels(spark, sf):
    """Label, numbers and other labels of each object."""
    return layers.described(MEMBERS.df(spark))


CLAIMS = Fixture("claims", "cas string, name string", [("1", "A"), ("1", "B"), ("2", "A"), ("2", "C"), ("3", "D"), ("3", "E"), ("4", "F"), ("4", "G"), ("5", "H"), ("5", "h "), ("6", "I"), ("6", "J")])
CLAIM_RULES = Fixture("claim_rules", "cas string, verdict string", [("1", "separate")])
SUPPLIED = Fixture("supplied", "cas string", [("1",), ("2",)])
CLAIM_FACTORS = Fixture("claim_factors", "cas string, name string, method string, context string, amount double", [("2", "A", "m", "air", 1.0), ("2", "C", "m", "air", 9.0), ("3", "D", "m", "air", 1.0), ("3", "E", "m", "air", 1.05), ("4", "F", "m", "air", 1.0), ("4", "G", "m", "air", 1.01), ("6", "I", "m", "air", 1.0), ("6", "J", "m", "soil", 5.0)])
REGISTRY = Fixture("registry", "cas string, name string", [("3", "D"), ("3", "E"), ("4", "F"), ("4", "G"), ("6", "I")])


@query("SELECT * FROM (VALUES ('1', 2::BIGINT, 'separate', 'ruling'), ('2', 2, 'merge', 'supplied'), ('3', 2, 'separate', 'factors'), ('4', 2, 'merge', 'registry'), ('6', 2, 'undecided', 'none')) t(cas, names, verdict, why)")
def contested_verdicts(spark, sf):
    """Numbers that several names claim, by the first signal that speaks."""
    return layers.contested_verdicts(*frames(spark, CLAIMS, CLAIM_RULES, SUPPLIED, CLAIM_FACTORS, REGISTRY))


PROFILES = Fixture("profiles", "cas string, name string, structure string, formula string", [("1", "Xylene", "AAAAAAAAAAAAAA-B", "C8H10"), ("2", "o-Xylene", "AAAAAAAAAAAAAA-B", "C8H10"), ("3", "p-Xylene", "AAAAAAAAAAAAAA-C", "C8H10"), ("4", "Xylene mixture", None, None), ("5", "1,2-Thing", None, "C2"), ("6", "1,3-Thing", None, "C2"), ("7", "Thing", None, "C3")])
GROUPED = Fixture("grouped", "grp string, cas array<string>", [("same", ["1", "2"]), ("class", ["1", "3"]), ("mix", ["1", "4"]), ("locant", ["5", "6"]), ("one", ["7"]), ("one", ["7"]), ("open", ["5", "7"])])


@query("SELECT * FROM (VALUES ('same', 2::BIGINT, 1::BIGINT, false), ('class', 2, 1, true), ('mix', 2, 1, true), ('locant', 2, 1, true), ('one', 1, 0, false), ('open', 2, 1, true)) t(grp, numbers, pairs, conflict)")
def group_evidence(spark, sf):
    """Whether any two numbers of a group are not one substance."""
    return layers.group_evidence(*frames(spark, GROUPED, PROFILES))


VOTES = Fixture("votes", "name string, cas string, source string, source_rank int", [("n1", "1-1", "s1", 1), ("n1", "1-1", "s2", 2), ("n1", "2-2", "s3", 3), ("n2", "1-1", "s1", 1), ("n3", "1-1", "s1", 1), ("n3", "2-2", "s2", 2), ("n4", "X y", "s2", 2), ("n4", "x  Y", "s1", 1)])


@query("SELECT * FROM (VALUES ('n1', '1-1', '1-1'), ('n2', NULL, NULL), ('n3', NULL, NULL), ('n4', 'x y', 'x  Y')) t(name, winner, spelling)")
def source_ballots(spark, sf):
    """Ballots over sources, in the spelling of the first source of the winner."""
    return layers.ballots(VOTES.df(spark), "name", "cas")


NAMELESS = Fixture("nameless", "grp string, name string, cas array<string>", [("g1", "n1", []), ("g2", "n2", []), ("g3", "N1", []), ("g4", "n1", ["7"]), ("g5", "n1", [])])
CONFLICTS = Fixture("conflicts_", "grp string, conflict boolean", [("g3", True)])
ALT_NUMBERS = Fixture("alt_numbers", "label string, cas string", [("n9", "1-1")])


@query("SELECT * FROM (VALUES ('g1', '1-1', 'filled'), ('g2', NULL, 'no-winner'), ('g3', NULL, 'group-conflict'), ('g5', '1-1', 'filled')) t(grp, cas, verdict)")
def consensus_numbers(spark, sf):
    """Groups without a number that take the ballot's."""
    return layers.consensus_numbers(NAMELESS.df(spark), layers.ballots(VOTES.df(spark), "name", "cas"), *frames(spark, CONFLICTS, ALT_NUMBERS))


RENAMED = Fixture("renamed", "uuid string, name string, cas string", [("a", "Old one", "1"), ("b", "New One", "1"), ("c", "Old two", "2"), ("d", "Other", "1")])
NAME_BALLOT = Fixture("name_ballot", "cas string, winner string, spelling string", [("1", "new one", "New one"), ("2", "new two", "New two")])
RENAME_RULES = Fixture("rename_rules", "current string, replacement string, ok boolean", [("old one", "New One", True), ("other", "new one", False)])


@query("SELECT * FROM (VALUES ('a', 'renamed', 'New one'), ('c', 'review', 'Old two'), ('d', 'kept', 'Other')) t(uuid, verdict, name)")
def gated_renames(spark, sf):
    """Renames that a ruling lets through, refuses, or leaves to a review."""
    return layers.gated_renames(*frames(spark, RENAMED, NAME_BALLOT, RENAME_RULES))


COLLIDING = Fixture("colliding", "key string, flow_id string", [("k1", "a"), ("k1", "b"), ("k2", "c"), ("k2", "d"), ("k2", "e"), ("k3", "f"), ("k3", "g")])
COLLISION_RULES = Fixture("collision_rules", "key string, members array<string>, survivor string", [("k1", ["b", "a"], "b"), ("k2", ["c", "d"], "c")])


@query("SELECT * FROM (VALUES ('a', 'b', 'merged'), ('b', 'b', 'survives'), ('c', NULL, 'stale'), ('d', NULL, 'stale'), ('e', NULL, 'stale'), ('f', NULL, 'open'), ('g', NULL, 'open')) t(flow_id, survivor, verdict)")
def ruled_collisions(spark, sf):
    """Colliding flows that a ruling merges while the same flows collide."""
    return layers.ruled_collisions(*frames(spark, COLLIDING, COLLISION_RULES))


ELEMENTS = Fixture("elements", "symbol string, name string", [("Fe", "Iron"), ("Pb", "Lead"), ("Zn", "Zinc"), ("Sn", "Tin"), ("Hg", "Mercury")])
ELEMENT_OBJECTS = Fixture("element_objects_", "object_id string, pref string, alts array<string>, linked boolean", [("o1", "iron", [], True), ("o2", "PB", ["x"], False), ("o3", "Spelter", ["Zinc"], False), ("o4", "Cassiterite", ["Tin"], False), ("o5", "Pewter", ["tin"], False), ("o6", "Iron(III)", [], False), ("o7", "Zinc, ion", [], False), ("o8", "Lead 2+", [], False)])


@query("SELECT * FROM (VALUES ('Fe', 'o1', 'name'), ('Pb', 'o2', 'symbol'), ('Zn', 'o3', 'label'), ('Sn', NULL, 'mint'), ('Hg', NULL, 'mint')) t(symbol, object_id, how)")
def element_objects(spark, sf):
    """Each element's object by name, symbol or a label of its own."""
    return layers.element_objects(*frames(spark, ELEMENT_OBJECTS, ELEMENTS))


@query("SELECT * FROM (VALUES ('o6', 'Fe', 3, 'iron (iii)'), ('o7', 'Zn', NULL, NULL), ('o8', 'Pb', 2, 'lead (ii)')) t(object_id, symbol, charge, label)")
def element_ions(spark, sf):
    """Objects that are an element's ion, in the house spelling."""
    return layers.ions(*frames(spark, ELEMENT_OBJECTS, ELEMENTS))


@query("SELECT * FROM (VALUES ('Fe', 'linked'), ('Pb', 'missing'), ('Zn', 'missing'), ('Sn', 'missing'), ('Hg', 'missing')) t(symbol, state)")
def element_coverage(spark, sf):
    """Which elements have an object, and a linked one."""
    return layers.element_coverage(*frames(spark, ELEMENTS, ELEMENT_OBJECTS))


@query("""SELECT l_orderkey AS object_id, l_partkey::VARCHAR || '-' || l_linenumber AS nuclide, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 9) AS share FROM lineitem""")
def isotope_shares(spark, sf):
    """Each candidate's part of the whole of its object."""
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("object_id"), F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string")).alias("nuclide"), F.col("l_quantity").alias("abundance"))
    return layers.isotope_shares(l).withColumn("share", F.round("share", 9))


LAND = Fixture("land", "key string", [("occupation",), ("occupation/forest/primary/x",), ("occupation/forest",), ("occupation/urban/dense",), ("transformation/forest",), ("transformation/forest/primary",)])


@query("SELECT * FROM (VALUES ('occupation', NULL), ('occupation/forest/primary/x', 'occupation/forest'), ('occupation/forest', 'occupation'), ('occupation/urban/dense', 'occupation'), ('transformation/forest', NULL), ('transformation/forest/primary', 'transformation/forest')) t(key, parent)")
def nearest_ancestors(spark, sf):
    """The nearest broader class that is there itself."""
    return layers.nearest_ancestors(LAND.df(spark))


FAMILY = Fixture("family", "ordinal int, prefix string, family string", [(1, "noise", "Noise"), (2, "noise, road", "Traffic"), (3, "odour", "Odour")])
IMMATERIAL = Fixture("immaterial", "object_id string, pref string", [("a", "Noise, road"), ("b", "Odour of pigs"), ("c", "Water")])


@query("SELECT o AS object_id, f AS family, 'family-' || substr(sha1(f), 1, 16) AS parent FROM (VALUES ('a', 'Noise'), ('b', 'Odour')) t(o, f)")
def family_parents(spark, sf):
    """Objects under their declared family."""
    return layers.family_parents(*frames(spark, IMMATERIAL, FAMILY))


@query("""WITH x AS (SELECT l_returnflag AS a, l_linestatus AS b, count(DISTINCT (l_orderkey, l_partkey)) AS pairs, string_agg(DISTINCT l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) AS kinds FROM lineitem GROUP BY 1, 2) SELECT a AS source_list, b AS target_list, pairs, kinds, 'correspondence-' || substr(sha1(a || '|' || b), 1, 16) AS iri FROM x""")
def correspondences(spark, sf):
    """Associations regrouped by pair of lists, under stable ids."""
    l = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("source_list"), F.col("l_linestatus").alias("target_list"), F.col("l_orderkey").alias("source"), F.col("l_partkey").alias("target"), F.col("l_linenumber").cast("string").alias("kind"))
    return layers.correspondences(l)


REPLACED = Fixture("replaced", "id string, replaced_by string", [("a", "b"), ("b", "c"), ("d", "e"), ("f", "g"), ("h", "i"), ("x", "y"), ("y", "x")])
SEEN = Fixture("seen", "flow string, list string, context string", [("a", "L", "air"), ("c", "L", "air"), ("b", "L", "soil"), ("d", "L", "air"), ("e", "L", "water"), ("f", "L", "air"), ("g", "M", "air"), ("h", "L", "air")])
PUBLIC = Fixture("public", "flow string", [("c",), ("e",), ("g",)])


@query("SELECT * FROM (VALUES ('a', 'c', 'identity-merge'), ('b', 'c', 'context-collapse'), ('d', 'e', 'context-collapse'), ('f', 'g', 'unclassified'), ('h', NULL, 'unpublished'), ('x', NULL, 'cycle'), ('y', NULL, 'cycle')) t(id, terminal, reason)")
def redirect_reasons(spark, sf):
    """Why flows are redirected, by the contexts that lists gave both ends."""
    return layers.redirect_reasons(*frames(spark, REPLACED, SEEN, PUBLIC))


CITED = Fixture("cited", "object_id string, source string, formula string", [("o1", "a", "H2O"), ("o1", "b", "H2O2"), ("o2", "a", "NaCl"), ("o2", "b", "C6H12O6"), ("o3", "a", "CO2"), ("o3", "b", "not")])


@query("SELECT 'o2' AS object_id, 'a' AS a, 'b' AS b, 0.0::DOUBLE AS score")
def formula_mismatches(spark, sf):
    """Cited formulas of one object that are hardly alike."""
    return layers.formula_mismatches(CITED.df(spark))


NUMBERED = Fixture("numbered", "object_id string, cas array<string>, ec array<string>", [("a", ["1", "2", "1"], ["9"]), ("b", [], ["8"])])


@query(having(NUMBERED) + " SELECT DISTINCT object_id, 'cas' AS scheme, unnest(cas) AS value FROM numbered UNION SELECT DISTINCT object_id, 'ec', unnest(ec) FROM numbered")
def classification_blocks(spark, sf):
    """Numbers of either scheme as rows."""
    return layers.classification_blocks(NUMBERED.df(spark))


# --- labels --------------------------------------------------------------------------------------

NAMED = Fixture("named", "uuid string, source string, name string, synonyms array<string>, unit string, cas array<string>, ec array<string>", [("1", "A", " Lead ", ["Plumbum", "lead", "plumbum "], "KG", ["7439-92-1"], ["231-100-4"]), ("2", "A", "lead", [], "kilogram", [], []), ("3", "A", "Zinc", None, "m3", ["7440-66-6", "7440-66-7"], ["231-175-3"]), ("4", "B", "Lead", ["x"], "?", [], []), ("5", "A", "Zinc ", [], "kg", ["bad"], []), ("6", "A", "zinc", [], "kg", [], ["231-100-4"])])


@query("SELECT * FROM (VALUES ('1', 'Lead', 'Plumbum'), ('2', 'lead', ''), ('3', 'Zinc', ''), ('4', 'Lead', 'x'), ('5', 'Zinc', ''), ('6', 'zinc', '')) t(uuid, pref, alts)")
def label_bootstrap(spark, sf):
    """Names and synonyms as preferred and other labels."""
    return labels.bootstrap(NAMED.df(spark)).select("uuid", "pref", F.array_join("alts", ",").alias("alts"))


UNIT_NAMES = Fixture("unit_names", "alias string, notation string", [("kg", "kg"), ("kilogram", "kg"), ("m3", "m3")])


@query(having(NAMED, UNIT_NAMES) + " SELECT uuid, unit, coalesce(notation, trim(unit)) AS notation FROM named LEFT JOIN unit_names ON lower(trim(unit)) = lower(alias)")
def unit_notations(spark, sf):
    """Canonical notation of unit spellings."""
    return labels.normalized_units(*frames(spark, NAMED, UNIT_NAMES))


@query("SELECT '2' AS uuid, '7439-92-1' AS cas")
def numbers_from_names(spark, sf):
    """Numbers that a list's own rows give a name, one to one."""
    return labels.numbers_from_names(NAMED.df(spark))


HITS = Fixture("hits", "name string, cas string", [("Lead", "7439-92-1"), ("lead ", "7439-92-1"), ("Zinc", "1-1-1")])
ONTOLOGY = Fixture("ontology", "entry string, name string, cas array<string>", [("e1", "Tin", ["1"]), ("e2", "tin", ["2"]), ("e3", "Iron", ["3"]), ("e4", "iron", ["3"]), ("e5", "Gold", [])])


@query("SELECT * FROM (VALUES ('1', '7439-92-1', 'agrees'), ('2', '7439-92-1', 'filled'), ('4', '7439-92-1', 'filled'), ('3', '1-1-1', 'disagrees'), ('5', '1-1-1', 'disagrees'), ('6', '1-1-1', 'filled')) t(uuid, cas, verdict)")
def registry_review(spark, sf):
    """A registry's number for an exact name: it fills, agrees, or is reported."""
    return labels.registry_review(*frames(spark, NAMED, HITS, ONTOLOGY))[0].distinct()


ORES = Fixture("ores", NAMED.schema, [("1", "A", "tin", [], "kg", [], []), ("2", "A", "Tin", [], "kg", [], []), ("3", "A", "Iron", [], "kg", [], []), ("4", "B", "Tin", [], "kg", [], [])])


@query("SELECT * FROM (VALUES ('A', 'tin', 2::BIGINT, 2::BIGINT), ('B', 'tin', 2, 1)) t(source, name, entries, rows)")
def ambiguous_names(spark, sf):
    """Names that several ontology entries carry without a number in common."""
    return labels.registry_review(*frames(spark, ORES, HITS, ONTOLOGY))[1]


@query("SELECT * FROM (VALUES ('1', '7439-92-1', 'valid', NULL), ('3', '7440-66-6', 'valid', NULL), ('3', '7440-66-7', 'corrected', '7440-66-6'), ('5', 'bad', 'malformed', NULL)) t(uuid, number, verdict, corrected)")
def checked_numbers(spark, sf):
    """Registry numbers: right, correctable, malformed."""
    return labels.checked_numbers(NAMED.df(spark))


INVENTORY = Fixture("inventory", "cas string, ec string", [("7439-92-1", "231-100-4"), ("7440-66-6", "231-999-9")])


@query("SELECT '3' AS uuid, '7440-66-6' AS cas, '231-175-3' AS ec, 'cas-has-other-ec' AS mismatch")
def cross_checked_numbers(spark, sf):
    """Pairs of numbers that an inventory denies."""
    return labels.cross_checked(*frames(spark, NAMED, INVENTORY))


COMPOUNDS = Fixture("compounds", "uuid string, ordinal int, cas string, candidate string, attested boolean, formula string, expected string", [("1", 0, "a", "c1", True, "H2O", "H2O"), ("1", 0, "a", "c2", False, "H2O", "H2O"), ("1", 0, "a", "c3", None, "C6H6", "H2O"), ("1", 1, "b", "c1", None, "CO2", "CO2"), ("2", 0, "d", "c4", False, "CO2", "CO2"), ("3", 0, "e", "c5", None, "NaCl", "H2O"), ("3", 0, "e", "c6", None, "KBr", "H2O")])
ALIGNED = Fixture("aligned", "candidate string", [("c1",), ("c6",)])


@query(having(COMPOUNDS) + " , x AS (SELECT *, count(*) OVER (PARTITION BY cas) AS n, bool_or(coalesce(attested, false)) OVER (PARTITION BY cas) AS any_one FROM compounds) SELECT uuid, cas, candidate FROM x WHERE NOT (n > 1 AND any_one AND attested IS NOT NULL AND NOT attested)")
def attested_compounds(spark, sf):
    """Of several candidates with one attested, the contradicted ones go."""
    return labels.attested_only(COMPOUNDS.df(spark)).select("uuid", "cas", "candidate")


@query("SELECT * FROM (VALUES ('a', 'c1'), ('a', 'c2'), ('b', 'c1'), ('d', 'c4'), ('e', 'c5'), ('e', 'c6')) t(cas, candidate)")
def formula_gate(spark, sf):
    """Candidates whose formula is nearly as like as the best; all, if none is."""
    return labels.alike_formulas(COMPOUNDS.df(spark)).select("cas", "candidate")


@query("SELECT * FROM (VALUES ('1', 'c1', 'a'), ('2', 'c4', 'd'), ('3', 'c6', 'e')) t(uuid, candidate, cas)")
def matched_compounds(spark, sf):
    """Candidates of a row's numbers through all gates in order."""
    return labels.matched_compounds(*frames(spark, COMPOUNDS, ALIGNED))


@query("SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) AS vals, string_agg(DISTINCT (n_chars % 3)::VARCHAR, ',' ORDER BY (n_chars % 3)::VARCHAR) AS provenance FROM documents GROUP BY 1")
def merged_properties(spark, sf):
    """Values and where they come from, united."""
    d = table(spark, sf, "documents").select("lang", F.col("source").alias("value"), (F.col("n_chars") % 3).cast("string").alias("provenance"))
    return labels.merged_property(d, ["lang"])


LABELLED = Fixture("labelled", "object_id string, pref string, alts array<string>", [("o1", "Lead", ["Plumbum", "Pb", "Zinc", "RA 12", "lead, fossil"]), ("o2", "Zinc", ["Zn", "Spelter", "PLUMBUM"]), ("o3", "Carbon, fossil", ["Coal, fossil", "Charcoal, biogenic", "Carbon"]), ("o4", "Tin", [])])


@query("SELECT * FROM (VALUES ('o1', 'Plumbum,Pb,RA 12,lead, fossil', 1::BIGINT)) t(object_id, alts, lost)")
def others_labels(spark, sf):
    """Labels that are another object's preferred one go."""
    return labels.strip_others_labels(LABELLED.df(spark)).select("object_id", F.array_join("alts", ",").alias("alts"), "lost")


SYMBOLS = Fixture("symbols", "symbol string, name string", [("Pb", "Lead"), ("Zn", "Zinc"), ("Zinc", "Nothing")])


@query("SELECT 'o1' AS object_id, 'Plumbum,Pb,RA 12,lead, fossil' AS alts, 1::BIGINT AS lost")
def symbol_labels(spark, sf):
    """Element symbols go from what isn't that element."""
    return labels.strip_symbols(*frames(spark, LABELLED, SYMBOLS)).select("object_id", F.array_join("alts", ",").alias("alts"), "lost")


@query("SELECT * FROM (VALUES ('o1', 'Plumbum,Pb,Zinc,RA 12', 1), ('o3', 'Coal, fossil', 2)) t(object_id, alts, lost)")
def qualified_labels(spark, sf):
    """Labels of another origin go."""
    return labels.strip_qualifiers(LABELLED.df(spark)).select("object_id", F.array_join("alts", ",").alias("alts"), "lost")


@query("SELECT 'o1' AS object_id, 'Plumbum,Pb,Zinc,lead, fossil' AS alts, 1::BIGINT AS lost")
def catalogue_labels(spark, sf):
    """Catalogue shapes go, but for those to keep."""
    return labels.strip_catalogue(LABELLED.df(spark), spark.createDataFrame([("RA 13",)], "label string")).select("object_id", F.array_join("alts", ",").alias("alts"), "lost")


@query("SELECT 'o1' AS object_id, 'Wax 9,Resin base' AS alts, 5::BIGINT AS lost")
def label_families(spark, sf):
    """Product families go from objects with very many labels."""
    o = spark.createDataFrame([("o1", ["Dye 1", "Dye 2", "Wax 9", "Dye 3", "Dye 4", "Dye 5", "Resin base"]), ("o2", ["Dye 1"])], "object_id string, alts array<string>")
    return labels.strip_families(o, spark.createDataFrame([("wax",)], "family string"), labels=5, members=5).select("object_id", F.array_join("alts", ",").alias("alts"), "lost")


LINKS = Fixture("links", "uuid string, entry string", [("o1", "e1"), ("o2", "e2")])
ENTRIES = Fixture("entries", "entry string, label string", [("e1", "plumbum"), ("e1", "Blei"), ("e1", "LEAD"), ("e2", "Zink")])


@query("SELECT * FROM (VALUES ('o1', 'Plumbum,Pb,Zinc,RA 12,lead, fossil,Blei'), ('o2', 'Zn,Spelter,PLUMBUM,Zink')) t(uuid, alts)")
def ontology_labels(spark, sf):
    """Labels with the synonyms of linked entries behind them."""
    return labels.with_ontology_labels(LABELLED.df(spark).withColumnRenamed("object_id", "uuid"), *frames(spark, LINKS, ENTRIES)).select("uuid", F.array_join("alts", ",").alias("alts"))


STRUCTURED = Fixture("structured", "uuid string, object_id string, name string, cas array<string>, structure string, formula string", [("1", "o1", "Lead", ["a"], "K1", "Pb"), ("2", "o2", "Zinc", ["b"], "K2", "Zn"), ("3", "o3", "Zinc", ["b"], "K2", "Zn2"), ("4", "o4", "Tin", ["c", "d"], None, None), ("5", "o5", "Lead-210", ["a"], None, None), ("6", "o6", "Iron", ["e"], None, None)])
COMPUTED = Fixture("computed", "structure string, formula string", [("K1", "Pb1"), ("K2", "Zn1")])


@query("SELECT '1' AS uuid, 'Pb1' AS formula")
def authoritative_formulas(spark, sf):
    """Computed properties replace stated ones where the structure is nobody else's."""
    return labels.authoritative(*frames(spark, STRUCTURED, COMPUTED))


STRUCTURES = Fixture("structures", "cas string, name string, structure string", [("c", "tin", "K9"), ("d", "Tin ", "K9"), ("a", "Lead-210", "K7"), ("e", "Iron", "K3"), ("e", "iron", "K4")])


@query("SELECT '4' AS uuid, 'K9' AS structure")
def supplied_structures(spark, sf):
    """Structures that a registry has under a row's number and name."""
    return labels.supplied_structures(*frames(spark, STRUCTURED, STRUCTURES))


CURATED = Fixture("curated", "cas string, structure string", [("a", "K0"), ("d", "K8"), ("c", "K6")])


@query("SELECT * FROM (VALUES ('1', 'K0'), ('2', 'K2'), ('3', 'K2'), ('4', 'K6'), ('5', 'K0'), ('6', NULL)) t(uuid, structure)")
def corrected_structures(spark, sf):
    """Curated structures before stated ones."""
    return labels.corrected_structures(*frames(spark, STRUCTURED, CURATED))


BACKED = Fixture("backed", "object_id string, structure string, formula string, registered string", [("o1", "K1", "H2O", "OH2"), ("o1", "K2", "H2O2", "OH2"), ("o2", "K3", "CO", "CO2"), ("o3", "K4", "NaCl", "NaCl")])


@query("SELECT 'o1' AS object_id, 'K2' AS structure")
def contradicted_structures(spark, sf):
    """Structures whose formula the registered composition denies, while it backs another."""
    return labels.contradicted_structures(BACKED.df(spark))


@query("""SELECT l_orderkey AS object_id, CASE WHEN count(DISTINCT l_returnflag) <= 1 THEN max(l_quantity) END AS mass FROM lineitem GROUP BY 1""")
def withheld_masses(spark, sf):
    """Masses, null where an object has several structures."""
    o = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("object_id")).agg(F.collect_list("l_returnflag").alias("structures"), F.max("l_quantity").alias("mass"))
    return labels.withheld_mass(o)


FIXABLE = Fixture("fixable", "uuid string, name string, unit string", [("1", "Lead", "kg"), ("2", "Lead", "g"), ("3", "Zinc", "kg")])
FIXES = Fixture("fixes", "ordinal int, match_field string, match_value string, field string, original string, value string", [(1, "name", "Lead", "unit", "kg", "t"), (2, "uuid", "3", "unit", "kg", "x"), (3, "unit", "kg", "name", "Zinc", "Zinc metal"), (4, "name", "Lead", "unit", "g", "mg"), (5, "name", "Lead", "unit", "kg", "Mg")])


@query("SELECT * FROM (VALUES ('1', 'unit', 'Mg', 5), ('2', 'unit', 'mg', 4), ('3', 'name', 'Zinc metal', 3)) t(uuid, field, value, ordinal)")
def manual_fixes(spark, sf):
    """Ordered fixes, each guarded by the value that it replaces."""
    return labels.manual_fixes(*frames(spark, FIXABLE, FIXES))


@query("SELECT c_custkey AS uuid, c_name AS name FROM customer WHERE c_custkey % 7 <> 0 UNION ALL SELECT -1, 'added'")
def list_additions(spark, sf):
    """A list with its added rows and without the excluded ones."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("uuid"), F.col("c_name").alias("name"))
    return labels.with_additions(c, spark.createDataFrame([(-1, "added"), (1, "there already")], "uuid long, name string"), c.where("uuid % 7 = 0").select("uuid"))


CARRIED = Fixture("carried_", "object_id string, name string", [("o1", "Plumbum"), ("o1", "Blei"), ("o1", "Zinc"), ("o1", "Lead, fossil"), ("o1", "Metal"), ("o2", "Metal"), ("o4", "Stannum"), ("o4", "Lead")])


@query("SELECT * FROM (VALUES ('o1', 'Blei'), ('o4', 'Stannum')) t(object_id, label)")
def carried_names(spark, sf):
    """Names of members that their object takes as labels."""
    return labels.carried_names(*frames(spark, LABELLED, CARRIED))[0]


@query("SELECT * FROM (VALUES ('o4', 'Lead', 'names-another'), ('o1', 'Metal', 'shared'), ('o2', 'Metal', 'shared')) t(object_id, label, reason)")
def refused_names(spark, sf):
    """Names of members that their object doesn't take, and why."""
    return labels.carried_names(*frames(spark, LABELLED, CARRIED))[1]


PUSHED = Fixture("pushed", "uuid string, object_id string, pref string, alts array<string>", [("1", "o1", "Lead", []), ("2", "o1", "", []), ("3", "o1", "LEAD", []), ("4", "o1", "Plumbum", ["x"]), ("5", "o2", "Spelter", []), ("6", "o4", "Can", [])])
PUSH_OBJECTS = Fixture("push_objects", "object_id string, pref string", [("o1", "Lead"), ("o2", "Zinc"), ("o3", "zinc"), ("o4", "Tin"), ("o5", "tin")])
PUSH_RULES = Fixture("push_rules", "old string, new string, verdict string", [("Can", "Tin", "rename")])


@query("SELECT * FROM (VALUES ('1', 'agree', 'Lead', ''), ('2', 'label', 'Lead', ''), ('3', 'respell', 'Lead', ''), ('4', 'rename', 'Lead', 'x,Plumbum'), ('5', 'defer', 'Spelter', ''), ('6', 'rename', 'Tin', 'Can')) t(uuid, verdict, pref, alts)")
def pushed_labels(spark, sf):
    """What becomes of flows' labels under their object's name."""
    return labels.pushed_labels(*frames(spark, PUSH_OBJECTS, PUSHED, PUSH_RULES)).select("uuid", "verdict", "pref", F.array_join("alts", ",").alias("alts"))


@query("""WITH s AS (SELECT l_suppkey AS object_id, list_sort(list(DISTINCT l_returnflag)) AS slots FROM lineitem WHERE l_quantity = 50 GROUP BY 1), o AS (SELECT s_suppkey AS object_id, s_acctbal, coalesce(slots, []) AS slots FROM supplier LEFT JOIN s ON s_suppkey = object_id)
    SELECT object_id, CASE WHEN s_acctbal < 0 THEN 'debtor' WHEN list_contains(slots, 'A') AND list_contains(slots, 'R') THEN 'mixture' WHEN len(slots) = 1 THEN 'single' ELSE 'unclassified' END AS type FROM o""")
def semantic_types(spark, sf):
    """The first of ordered rules over an object and the slots of its flows."""
    s, l = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("object_id"), "s_acctbal"), table(spark, sf, "lineitem").where("l_quantity = 50")
    rules = [("debtor", F.col("s_acctbal") < 0), ("mixture", F.array_contains("slots", "A") & F.array_contains("slots", "R")), ("single", F.size("slots") == 1)]
    return labels.typed(s, l.select(F.col("l_suppkey").alias("object_id"), F.col("l_returnflag").alias("slot")), rules)


@query("SELECT * FROM (VALUES ('o1', 'mass'), ('o2', 'formula,mass')) t(object_id, properties)")
def withdrawn_properties(spark, sf):
    """Properties of a single substance go from mixtures and groups."""
    p = spark.createDataFrame([("o1", {"formula": "x", "mass": "1"}), ("o2", {"formula": "x", "mass": "1"})], "object_id string, properties map<string,string>")
    t = spark.createDataFrame([("o1", "mixture"), ("o2", "single")], "object_id string, type string")
    kept = p.join(t.where("type = 'single'"), "object_id").select("object_id", F.array_join(F.array_sort(F.map_keys("properties")), ",").alias("properties"))
    return labels.without_properties(p, t, ["formula"]).unionAll(kept)
