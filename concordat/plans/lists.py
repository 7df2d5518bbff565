"""Scalar functions and list sources over small authored tables and over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chemistry, names, text
from ..operators import groups, match
from ..sources import lists
from ..sources.tables import table
from .characterisation import frames
from .registry import Fixture, having, query

FORMULAS = Fixture("formulas", "formula string, name string", [("H2O", "water"), ("Ca(OH)2", "lime"), ("CuSO4.5H2O", "blue vitriol"), ("Fe2(SO4)3", "salt"), ("[Co(NH3)6]Cl3", "cobalt trichloride"), ("SiCl4", "silicon tetrachloride"), ("CO2", "carbon monoxide"), ("NH4+", "ammonium"), ("K2O.1/2SiO2", "glass"), ("not a formula", "x"), (None, "y"), ("C(", "z")])


@query("""SELECT * FROM (VALUES ('H2O', 'H=2.0,O=1.0', 'O1.0'), ('Ca(OH)2', 'Ca=1.0,H=2.0,O=2.0', 'Ca1.0,O2.0'), ('CuSO4.5H2O', 'Cu=1.0,H=10.0,O=9.0,S=1.0', 'Cu1.0,O9.0,S1.0'), ('Fe2(SO4)3', 'Fe=2.0,O=12.0,S=3.0', 'Fe2.0,O12.0,S3.0'), ('[Co(NH3)6]Cl3', 'Cl=3.0,Co=1.0,H=18.0,N=6.0', 'Cl3.0,Co1.0,N6.0'),
    ('SiCl4', 'Cl=4.0,Si=1.0', 'Cl4.0,Si1.0'), ('CO2', 'C=1.0,O=2.0', 'C1.0,O2.0'), ('NH4+', 'H=4.0,N=1.0', 'N1.0'), ('K2O.1/2SiO2', 'K=2.0,O=2.0,Si=0.5', 'K2.0,O2.0,Si0.5'), ('not a formula', NULL, NULL), (NULL, NULL, NULL), ('C(', NULL, NULL)) t(formula, counts, heavy)""")
def compositions(spark, sf):
    """Element counts of formulas with brackets, hydrates and parts."""
    c = chemistry.compositions(F.col("formula"))
    d = FORMULAS.df(spark).select("formula", c.alias("c"))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("c")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return d.select("formula", shown.alias("counts"), chemistry.heavy_atoms(F.col("c")).alias("heavy"))


@query("""SELECT * FROM (VALUES ('[Co(NH3)6]Cl3', true, false), ('SiCl4', true, false), ('CO2', false, true), ('H2O', false, false)) t(formula, corroborates, contradicts)""")
def stated_compositions(spark, sf):
    """Whether formulas agree with, or deny, the counts that names state."""
    d = FORMULAS.df(spark).withColumn("name", F.when(F.col("formula") == "CO2", "carbon trioxide").otherwise(F.col("name")))
    d = d.where(F.col("formula").isin("[Co(NH3)6]Cl3", "SiCl4", "CO2", "H2O")).select("formula", "name", chemistry.compositions(F.col("formula")).alias("c"))
    return d.select("formula", chemistry.corroborates(F.col("c"), F.col("name")).alias("corroborates"), chemistry.contradicts(F.col("c"), F.col("name")).alias("contradicts"))


IONS = Fixture("ions_", "name string", [("Cobalt(II)",), ("Cobalt, ion",), ("Cobalt",), ("Tin 4+",)])


@query("""SELECT * FROM (VALUES ('Cobalt(II)', 'cobalt', 'charged', 2, 'cobalt(II)|cobalt 2+|cobalt, ion'), ('Cobalt, ion', 'cobalt', 'ion', NULL, NULL), ('Cobalt', 'cobalt', 'bare', NULL, NULL), ('Tin 4+', 'tin', 'charged', 4, 'tin(IV)|tin 4+|tin, ion')) t(name, family, state, charge, synonyms)""")
def ion_species(spark, sf):
    """Family, state and charge of names, and the spellings that an ion carries."""
    d = IONS.df(spark).select("name", chemistry.species(F.col("name")).alias("s"))
    syn = F.when(F.col("s.charge").isNotNull(), F.array_join(chemistry.ion_synonyms(F.col("s.family"), F.col("s.charge")), "|"))
    return d.select("name", "s.family", "s.state", "s.charge", syn.alias("synonyms"))


@query("""SELECT DISTINCT p_brand || '/' || p_size || '/' || p_type AS key, p_brand || '/' || p_size AS broader, p_brand || '/' || p_size || ',' || p_brand AS chain FROM part""")
def land_keys(spark, sf):
    """Keys of stated axes and all their broader ones."""
    p = table(spark, sf, "part").select(chemistry.land_key(F.col("p_brand"), F.lit(None).cast("string"), F.col("p_size").cast("string"), F.lit(""), F.col("p_type")).alias("key")).distinct()
    return p.select("key", chemistry.broader(F.col("key")).alias("broader"), F.array_join(chemistry.broader_chain(F.col("key")), ",").alias("chain"))


@query("""SELECT event_type, count(TRY_CAST(trim(CASE WHEN event_id % 3 = 0 THEN 'n/a' ELSE ' ' || (event_id % 100)::VARCHAR END) AS DOUBLE)) AS numbers, count(*) FILTER (event_id % 3 = 0) AS failures FROM events GROUP BY 1""")
def typed_properties(spark, sf):
    """Texts of properties as numbers, and how many are none."""
    v = F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(F.concat(F.lit(" "), (F.col("event_id") % 100).cast("string")))
    return table(spark, sf, "events").select("event_type", chemistry.typed_number(v).alias("x")).groupBy("event_type").agg(F.count("x").alias("numbers"), F.count_if(F.col("x").isNull()).alias("failures"))


@query("SELECT l_orderkey, count(*) FILTER (l_discount <> 0)::INT AS n FROM lineitem GROUP BY 1")
def non_zero_counts(spark, sf):
    """How many factors of an object aren't zero."""
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_discount").alias("a")).select("l_orderkey", chemistry.non_zero(F.col("a")).alias("n"))


SPELT = Fixture("spelt", "name string, unit string", [("Toluene, bromo-", "kg"), ("Timber, sawn", "m3"), ("Cobalt II", "kg"), ("Dibenzo(a,h)pyrene", "kg"), ("Steam/kg", "KG"), ("Steam, PT", "kg"), ("Velox HS-40", "kg"), ("Cobalt-60m", "kBq"), ("Propane, fossil", "kg")])


@query("""SELECT * FROM (VALUES ('Toluene, bromo-', 'bromotoluene', NULL, false, false, NULL), ('Timber, sawn', 'sawn timber', NULL, false, false, NULL), ('Cobalt II', 'cobalt (ii)', NULL, false, false, NULL), ('Dibenzo(a,h)pyrene', 'dibenzo[a,h]pyrene', NULL, false, false, NULL),
    ('Steam/kg', '', 'Steam', false, false, NULL), ('Steam, PT', '', NULL, false, false, NULL), ('Velox HS-40', '', NULL, true, false, NULL), ('Cobalt-60m', '', NULL, false, true, 'cobalt-60'), ('Propane, fossil', 'fossil propane', NULL, false, false, NULL)) t(name, aliases, unsuffixed, product, active, nuclide)""")
def vendor_names(spark, sf):
    """Derived spellings, units in names, product designations, units of activity and nuclides."""
    n = F.col("name")
    nuclide = names.nuclide(n)
    return SPELT.df(spark).select("name", F.array_join(names.aliases(n), "|").alias("aliases"), names.without_unit_suffix(n, F.col("unit")).alias("unsuffixed"), text.is_product_designation(n).alias("product"), text.is_becquerel(F.col("unit")).alias("active"), F.concat_ws("-", nuclide["element"], nuclide["mass"].cast("string")).alias("nuclide")).withColumn("nuclide", F.nullif("nuclide", F.lit("")))


KEYS = Fixture("keypairs", "a string, b string", [("QWERTYUIOPASDF-UHFFFAOYSA-N", "QWERTYUIOPASDF-ZXCVBNMASA-N"), ("QWERTYUIOPASDF-UHFFFAOYSA-N", "GHJKLZXCVBNMQW-UHFFFAOYSA-N"), ("QWERTYUIOPASDF-UHFFFAOYSA-N", "QWERTYUIOPASDF-UHFFFAOYSA-M"), ("x", "QWERTYUIOPASDF-UHFFFAOYSA-N")])


@query("""SELECT * FROM (VALUES ('QWERTYUIOPASDF-ZXCVBNMASA-N', 'flat-vs-stereo', 1), ('GHJKLZXCVBNMQW-UHFFFAOYSA-N', 'different', 2), ('QWERTYUIOPASDF-UHFFFAOYSA-M', 'protonation', 2), ('QWERTYUIOPASDF-UHFFFAOYSA-N', 'unknown', 2)) t(b, relation, kept)""")
def structure_keys(spark, sf):
    """How two structure keys relate, and how many of them aren't covered by the other."""
    return KEYS.df(spark).select("b", names.compare_structures(F.col("a"), F.col("b")).alias("relation"), F.size(names.without_flat_keys(F.array("a", "b"))).alias("kept"))


RENAMED = Fixture("renamed_", "current string, replacement string", [("Propane, fossil", "Propane"), ("Cobalt (II)", "Cobalt"), ("Steam (wet)", "Steam"), ("Steam", "Vapour")])


@query("SELECT * FROM (VALUES ('Propane, fossil', 'origin:fossil'), ('Cobalt (II)', 'charge:II'), ('Steam (wet)', 'bracket:wet'), ('Steam', '')) t(current, losses)")
def rename_losses(spark, sf):
    """Words that a rename loses."""
    return RENAMED.df(spark).select("current", F.array_join(text.qualifier_losses(F.col("current"), F.col("replacement")), ",").alias("losses"))


SYNONYMS = Fixture("synonyms_", "uuid string, name string, category string, synonyms array<string>", [("1", "Lead", "air", ["Plumbum", "zinc", "Lead"]), ("2", "Zinc", "air", ["Spelter"]), ("3", "Tin", "water", ["Zinc"])])


@query("SELECT * FROM (VALUES ('1', 'Plumbum,Lead'), ('2', 'Spelter'), ('3', 'Zinc')) t(uuid, synonyms)")
def conflicting_synonyms(spark, sf):
    """Synonyms without those that are another flow's name in the category."""
    return lists.without_conflicting_synonyms(SYNONYMS.df(spark)).select("uuid", F.array_join("synonyms", ",").alias("synonyms"))


@query("""SELECT 'flow-' || substr(sha1(lower(p_type) || '|' || p_brand || '||' || (p_size % 3)::VARCHAR), 1, 16) AS uuid, p_type AS name, p_brand AS context, (p_size % 3)::VARCHAR AS unit, string_agg(DISTINCT (p_partkey % 2)::VARCHAR, ',' ORDER BY (p_partkey % 2)::VARCHAR) AS cas FROM part GROUP BY p_type, p_brand, p_size % 3""")
def exchanged_flows(spark, sf):
    """Distinct flows of exchanges, with minted ids and all their numbers."""
    p = table(spark, sf, "part").select(F.col("p_type").alias("name"), F.col("p_brand").alias("compartment"), F.lit(None).cast("string").alias("subcompartment"), (F.col("p_size") % 3).cast("string").alias("unit"), (F.col("p_partkey") % 2).cast("string").alias("cas"))
    return lists.exchanged_flows(p).select("uuid", "name", F.array_join("context", ",").alias("context"), "unit", F.array_join("cas", ",").alias("cas"))


COMMENTS = Fixture("comments", "id int, comment string", [(1, "Synonyms: a; b ;; c\nMore text"), (2, "Only text"), (3, "synonym: x"), (4, "Version 1.2")])


@query("SELECT * FROM (VALUES (1, 'a,b,c', 'More text', 'Synonyms: a; b ;; c\nMore text'), (2, '', 'Only text', 'Only text'), (3, 'x', NULL, 'synonym: x'), (4, '', 'Version 1.2', NULL)) t(id, synonyms, rest, comment)")
def substance_comments(spark, sf):
    """Free-text comments split to synonyms and rest; a version is no comment."""
    s = lists.substance_comment(F.col("comment"))
    return COMMENTS.df(spark).select("id", F.array_join(s["synonyms"], ",").alias("synonyms"), s["rest"].alias("rest"), lists.comment_or_none(F.col("comment")).alias("comment"))


PLACES = Fixture("placed_", "uuid string, name string", [("1", "Steam, PT"), ("2", "Steam"), ("3", "Steam, XX"), ("4", "Mist, PT"), ("5", "Timber, sawn")])


@query("SELECT * FROM (VALUES ('1', 'Steam', 'PT'), ('2', 'Steam', NULL), ('3', 'Steam, XX', NULL), ('4', 'Mist, PT', NULL), ('5', 'Timber, sawn', NULL)) t(uuid, base, code)")
def geography_splits(spark, sf):
    """Names split from a place, where code and base are both known."""
    return lists.with_geography(PLACES.df(spark), spark.createDataFrame([("PT",), ("DE",)], "code string"))


ENTRIES = Fixture("entries_", "entry string, label string, synonyms array<string>, cas array<string>", [("e1", "Lead", ["Plumbum", "LEAD"], ["1"]), ("e2", "Zinc", None, ["2", "1"])])


@query("SELECT * FROM (VALUES ('cas', '1', 'e1'), ('cas', '1', 'e2'), ('cas', '2', 'e2'), ('name', 'lead', 'e1'), ('name', 'plumbum', 'e1'), ('name', 'zinc', 'e2')) t(kind, k, entry)")
def registry_indexes(spark, sf):
    """Inverted indexes of a registry."""
    a, b = lists.registry_index(ENTRIES.df(spark))
    return a.select(F.lit("cas").alias("kind"), F.col("cas").alias("k"), "entry").unionAll(b.select(F.lit("name").alias("kind"), F.col("n").alias("k"), "entry"))


ATTESTED = Fixture("attested_", "id string, value string, source string", [("1", "a", "weak"), ("1", "b", "strong"), ("1", "b", "weak"), ("2", "c", "weak")])


@query("SELECT * FROM (VALUES ('1', 'b'), ('2', 'c')) t(id, value)")
def attested_identifiers(spark, sf):
    """Identifiers without those that only a weak source has, where there are others."""
    return lists.best_attested(ATTESTED.df(spark), "weak")


PAGES = Fixture("pages_", "id string, page string", [("1", '{"Section": [{"TOCHeading": "Names", "Section": [{"TOCHeading": "CAS", "Information": [{"Value": "1-1"}, {"Value": "2-2"}]}, {"TOCHeading": "EC", "Information": [{"Value": "9"}]}]}]}'), ("2", "{}")])


@query("SELECT * FROM (VALUES ('1', 'CAS', '1-1'), ('1', 'CAS', '2-2'), ('1', 'EC', '9')) t(id, heading, value)")
def identifier_sections(spark, sf):
    """Identifiers in nested sections of a registry's pages."""
    return lists.identifier_sections(PAGES.df(spark))


LISTS = Fixture("lists_", "list string, version string, priority int", [("B", "3.10", 1), ("A", "1.0", 2), ("B", "3.9", 1), ("C", "x", 1)])


@query("SELECT * FROM (VALUES ('C', 'x', 1), ('B', '3.9', 2), ('B', '3.10', 3), ('A', '1.0', 4)) t(list, version, place)")
def merge_order(spark, sf):
    """Lists by priority, then version as numbers."""
    return lists.merge_order(LISTS.df(spark))


SINGLE = Fixture("single", "uuid string, cas_number string, cas array<string>", [("1", "7-7", None), ("2", " ", []), ("3", "1-1", ["2-2"])])


@query("SELECT * FROM (VALUES ('1', '7-7'), ('2', ''), ('3', '2-2')) t(uuid, cas)")
def coerced_records(spark, sf):
    """Singular fields as the arrays that they should be."""
    return lists.coerced(SINGLE.df(spark), {"cas_number": "cas"}).select("uuid", F.array_join("cas", ",").alias("cas"))


@query("""WITH d AS (SELECT doc_id, source, lang, n_chars % 2 AS p FROM documents), g AS (SELECT source, count(DISTINCT lang) AS l, min(lang) AS lang, count(DISTINCT p) AS q, min(p) AS p FROM d GROUP BY 1)
    SELECT source AS owner, 'lang' AS field, lang AS value FROM g WHERE l = 1 UNION ALL SELECT source, 'parity', p::VARCHAR FROM g WHERE q = 1 UNION ALL SELECT source, 'source', source FROM g""")
def hoisted_fields(spark, sf):
    """What all rows of an owner agree on."""
    d = table(spark, sf, "documents")
    f = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), c.alias("value")) for n, c in (("lang", F.col("lang")), ("parity", (F.col("n_chars") % 2).cast("string")), ("source", F.col("source")))]))
    rows = d.select(F.col("source").alias("owner"), F.col("doc_id").alias("row"), f.alias("x")).select("owner", "row", "x.*")
    return groups.hoist(rows, "owner", "field", "value")


@query("SELECT * FROM (VALUES ('f1', 'a=own,b=shared'), ('f2', 'a=shared,b=shared'), ('f3', 'c=own')) t(flow, payload)")
def shared_payloads(spark, sf):
    """Payloads with what their object holds for all; a flow's own value wins."""
    flows = spark.createDataFrame([("f1", "o1", {"a": "own"}), ("f2", "o1", None), ("f3", "o2", {"c": "own"})], "flow string, object_id string, payload map<string,string>")
    shared = spark.createDataFrame([("o1", {"a": "shared", "b": "shared"})], "object_id string, payload map<string,string>")
    out = lists.with_shared(flows, shared)
    return out.select("flow", F.array_join(F.transform(F.array_sort(F.map_entries("payload")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("payload"))


@query("""SELECT l_partkey AS flow, l_returnflag AS list, string_agg(DISTINCT l_linestatus || ' / ' || l_linenumber, ';' ORDER BY l_linestatus || ' / ' || l_linenumber) AS contexts FROM lineitem GROUP BY 1, 2""")
def source_contexts(spark, sf):
    """The context paths that each list gave a flow."""
    l = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("flow"), F.col("l_returnflag").alias("list"), F.array("l_linestatus", F.col("l_linenumber").cast("string")).alias("context"))
    return lists.source_contexts(l).select("flow", "list", F.array_join("contexts", ";").alias("contexts"))


EXPORTED = Fixture("exported", "flow string, object_id string, iri string, unit string", [("f1", "o1", "c:air", "kg"), ("f2", "o1", None, "kg")])
EXPORT_OBJECTS = Fixture("export_objects", "object_id string, pref string, cas array<string>", [("o1", "Lead", ["1"])])


@query("""SELECT 'f1' AS flow, '{"flow":"f1","name":"Lead","cas":["1"],"iri":"c:air","unit":"kg"}' AS document UNION ALL SELECT 'f2', '{"flow":"f2","name":"Lead","cas":["1"],"unit":"kg"}'""")
def simple_export(spark, sf):
    """Published flows as JSON, null fields left out."""
    return lists.simple_export(*frames(spark, EXPORTED, EXPORT_OBJECTS))


MIGRATED = Fixture("migrated", "id string, target string, delta string", [("a", "b", "replaced"), ("c", None, "deleted"), ("d", "e", "replaced")])


@query("""SELECT 'replace' AS verb, '{"id":"a","target":"b"}' AS entry UNION ALL SELECT 'replace', '{"id":"d","target":"e"}'""")
def migration_packages(spark, sf):
    """One package of a migration."""
    return lists.migration_package(MIGRATED.df(spark), "replaced")


@query("""SELECT p_partkey, 2 * (p_brand = 'Brand#13')::INT + len(list_intersect(string_split(p_type, ' '), ['STANDARD', 'SMALL', 'TIN'])) - len(list_filter(['STANDARD', 'SMALL', 'TIN'], lambda x: NOT list_contains(string_split(p_type, ' '), x))) + (p_size = 1)::INT AS score FROM part""")
def overlap_scores(spark, sf):
    """Points for unit, shared words and context, less those for words too many."""
    words = F.split("p_type", " ")
    score = match.overlap_score(F.col("p_brand") == "Brand#13", words, F.array(*map(F.lit, ("STANDARD", "SMALL", "TIN"))), F.col("p_size") == 1)
    return table(spark, sf, "part").select("p_partkey", score.alias("score"))
