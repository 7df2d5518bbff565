"""Contexts and the merge, over small authored tables; the SQL restates each rule or the expected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import units
from ..operators import contexts, merging
from .registry import Fixture, having, query

VOCABULARY = Fixture(
    "vocab",
    "iri string, dimension string, media string, geography string, land_use string, strata string, population_density string, water_body string, indoor string",
    [
        ("c:air", "Environmental", "Air", None, None, "Unknown", None, None, None),
        ("c:air-low", "Environmental", "Air", None, None, "Low stack", "Urban", None, None),
        ("c:air-high", "Environmental", "Air", None, None, "High stack", "Rural", None, None),
        ("c:indoor", "Environmental", "Air", None, None, None, None, None, "Unknown"),
        ("c:kitchen", "Environmental", "Air", None, None, None, None, None, "Kitchen"),
        ("c:water", "Environmental", "Water", None, None, None, None, "Unknown", None),
        ("c:lake", "Environmental", "Water", None, None, None, None, "Lake", None),
        ("c:aquifer", "Environmental", "Water", None, None, None, None, "Groundwater", None),
        ("c:soil", "Environmental", "Ground", "Agricultural", None, None, None, None, None),
        ("c:take-water", "Resource", "Water", None, None, None, None, "Unknown", None),
        ("c:take-lake", "Resource", "Water", None, None, None, None, "Lake", None),
        ("c:occupation", "Land Use", None, None, "Occupation", None, None, None, None),
        ("c:transformation", "Land Use", None, None, "Transformation", None, None, None, None),
    ],
)
BROKEN = Fixture(
    "broken",
    VOCABULARY.schema,
    [
        ("x:no-media", "Environmental", None, None, None, None, None, None, None),
        ("x:social-water", "Social", "Water", None, None, None, None, "Lake", None),
        ("x:no-strata", "Environmental", "Air", None, None, None, None, None, None),
        ("x:stack-alone", "Environmental", "Air", None, None, "Low stack", None, None, None),
        ("x:indoor-stack", "Environmental", "Air", None, None, "High stack", "Urban", None, "Kitchen"),
        ("x:take-sewage", "Resource", "Water", None, None, None, None, "Wastewater treatment", None),
        ("x:take-soil", "Resource", "Ground", "Forest", None, None, None, None, None),
        ("x:ground", "Environmental", "Ground", None, None, None, None, None, None),
        ("x:land", "Land Use", None, None, None, None, None, None, None),
        ("x:water-land", "Environmental", "Water", None, "Occupation", None, None, "Lake", None),
    ],
)
ALLOWED = Fixture("allowed", "source string, target string", [("c:aquifer", "c:lake")])
PAIRS = Fixture("pairs", "id int, source string, target string", [(1, "c:lake", "c:water"), (2, "c:lake", "c:aquifer"), (3, "c:aquifer", "c:lake"), (4, "c:water", "c:lake"), (5, "c:air-low", "c:air"), (6, "c:air-low", "c:air-high"), (7, "c:soil", "c:lake"), (8, "c:lake", "c:lake"), (9, "c:lake", "c:nowhere"), (10, None, "c:lake"), (11, "c:kitchen", "c:indoor"), (12, "c:take-lake", "c:lake")])

NOT_STATED = "({0} IS NULL OR {0} = 'Unknown')"
AXES = [c for c, _ in VOCABULARY.columns[1:]]


@query(
    having(VOCABULARY, BROKEN)
    + """, a AS (SELECT * FROM vocab UNION ALL SELECT * FROM broken), f AS (SELECT *, coalesce(strata IN ('Ground level', 'Low stack', 'Medium stack', 'High stack'), false) AS grounded FROM a),
    r AS (SELECT iri, unnest([
        CASE WHEN (dimension IN ('Environmental', 'Resource')) <> (media IS NOT NULL) THEN 'media' END,
        CASE WHEN strata IS NOT NULL AND (media IS DISTINCT FROM 'Air' OR dimension <> 'Environmental' OR indoor IS NOT NULL) OR media = 'Air' AND dimension = 'Environmental' AND strata IS NULL AND indoor IS NULL THEN 'strata' END,
        CASE WHEN indoor IS NOT NULL AND (media IS DISTINCT FROM 'Air' OR dimension <> 'Environmental') THEN 'indoor' END,
        CASE WHEN (population_density IS NOT NULL) <> (grounded AND media IS NOT DISTINCT FROM 'Air' AND dimension = 'Environmental') AND (population_density IS NOT NULL OR grounded) THEN 'population_density' END,
        CASE WHEN (water_body IS NOT NULL) <> (media IS NOT DISTINCT FROM 'Water' AND dimension IN ('Environmental', 'Resource')) OR dimension = 'Resource' AND water_body IN ('Wastewater treatment', 'Secondary treatment', 'Long-term') THEN 'water_body' END,
        CASE WHEN (geography IS NOT NULL) <> (media IS NOT DISTINCT FROM 'Ground' AND dimension = 'Environmental') THEN 'geography' END,
        CASE WHEN (land_use IS NOT NULL) <> (dimension = 'Land Use') THEN 'land_use' END]) AS rule, generate_subscripts([1, 2, 3, 4, 5, 6, 7], 1) AS k FROM f)
    SELECT iri, coalesce(string_agg(rule, ',' ORDER BY k) FILTER (rule IS NOT NULL), '') AS broken FROM r GROUP BY 1"""
)
def context_rules(spark, sf):
    """Which rules a context breaks."""
    return VOCABULARY.df(spark).unionAll(BROKEN.df(spark)).select("iri", contexts.broken_rules(contexts.axes()).alias("broken"))


@query(having(VOCABULARY) + """ SELECT iri, array_to_string(list_filter([dimension, media, geography, land_use, strata, population_density, water_body, CASE WHEN indoor IS NOT NULL THEN 'Indoor' END, indoor], lambda x: x IS NOT NULL AND x <> 'Unknown'), ' / ') AS shown FROM vocab""")
def context_display(spark, sf):
    """Display words of contexts, in reading order."""
    return VOCABULARY.df(spark).select("iri", F.array_join(contexts.display(contexts.axes()), " / ").alias("shown"))


@query(
    having(VOCABULARY, ALLOWED, PAIRS)
    + """ SELECT id, coalesce(p.source <> p.target, false) AND s.iri IS NOT NULL AND t.iri IS NOT NULL AND NOT EXISTS (SELECT 1 FROM allowed a WHERE a.source = p.source AND a.target = p.target) AND ("""
    + " OR ".join(f"NOT {NOT_STATED.format('t.' + a)} AND t.{a} IS DISTINCT FROM s.{a}" for a in AXES)
    + ") AS contradicts FROM pairs p LEFT JOIN vocab s ON s.iri = p.source LEFT JOIN vocab t ON t.iri = p.target"
)
def context_contradictions(spark, sf):
    """Targets that deny what their source says; a vaguer target doesn't."""
    return contexts.contradictions(PAIRS.df(spark), VOCABULARY.df(spark), ALLOWED.df(spark), "source", "target").select("id", "contradicts")


LISTED = Fixture("listed", "uuid string, list string, name string, context array<string>", [("r1", "A", "Occupation, forest", ["Resources", "land"]), ("r2", "A", "Transformation, from forest", ["resources", " Land"]), ("r3", "A", "Lead", ["Air", "low"]), ("r4", "A", "Special", ["air", "low"]), ("r5", "B", "Lead", ["air", "low"]), ("r6", "B", "Lead", ["nowhere"])])
OWN = Fixture("own", "list string, uuid string, iri string", [("A", "r4", "c:indoor")])
PREFIXES = Fixture("prefixes", "list string, compartment string, prefix string, iri string", [("A", "resources / land", "occupation", "c:occupation"), ("A", "resources / land", "transformation", "c:transformation"), ("A", "resources / land", "transformation, from", "c:transformation")])
COMPARTMENTS = Fixture("compartments", "list string, compartment string, iri string", [("A", "resources / land", "c:occupation"), ("A", "air / low", "c:air-low"), ("B", "air / low", "c:air-high"), ("B", "water / lake", "c:lake"), ("A", "water / lake", "c:lake")])


@query(
    having(LISTED, OWN, PREFIXES, COMPARTMENTS)
    + r""", l AS (SELECT *, array_to_string(list_transform(context, lambda x: lower(trim(regexp_replace(x, '\s+', ' ', 'g')))), ' / ') AS comp FROM listed),
    n AS (SELECT l.uuid, arg_max(p.iri, length(prefix)) AS iri FROM l JOIN prefixes p ON p.list = l.list AND p.compartment = l.comp AND starts_with(lower(name), prefix) GROUP BY 1)
    SELECT l.uuid, coalesce(o.iri, n.iri, c.iri) AS iri, CASE WHEN o.iri IS NOT NULL THEN 'row' WHEN n.iri IS NOT NULL THEN 'name' WHEN c.iri IS NOT NULL THEN 'compartment' ELSE 'none' END AS rule
    FROM l LEFT JOIN own o ON o.list = l.list AND o.uuid = l.uuid LEFT JOIN n ON n.uuid = l.uuid LEFT JOIN compartments c ON c.list = l.list AND c.compartment = l.comp"""
)
def context_resolution(spark, sf):
    """The context of list rows: their own rule, their name's, their compartment's."""
    return contexts.resolve(LISTED.df(spark), OWN.df(spark), PREFIXES.df(spark), COMPARTMENTS.df(spark))


ASKED = Fixture("asked", "id string, iri string, list string, name string, context array<string>", [("q1", "c:soil", None, "Lead", ["air"]), ("q2", None, "A", "Transformation, to x", ["resources", "land"]), ("q3", None, None, "Lead", ["Water", "lake"]), ("q4", None, None, "Lead", ["air", "low"]), ("q5", None, None, "Lead", ["Raw", "in water"]), ("q6", None, None, "Lead", ["Environmental", "Water", "Groundwater"]), ("q7", None, None, "Occupation, sea", ["resources", "land"]), ("q8", None, None, "Lead", ["elsewhere"])])
DIALECT = Fixture("dialect", "compartment string, iri string", [("raw / in water", "c:take-water")])


@query("SELECT * FROM (VALUES ('q1', 'c:soil', 'given'), ('q2', 'c:transformation', 'named-list'), ('q3', 'c:lake', 'any-list'), ('q4', NULL, 'unresolved'), ('q5', 'c:take-water', 'dialect'), ('q6', 'c:aquifer', 'own-words'), ('q7', 'c:occupation', 'any-list'), ('q8', NULL, 'unresolved')) t(id, iri, how)")
def context_lookup(spark, sf):
    """The context of questions that may name no list, and which of five steps gave it."""
    return contexts.resolve_any(ASKED.df(spark), PREFIXES.df(spark), COMPARTMENTS.df(spark), DIALECT.df(spark), VOCABULARY.df(spark))


@query(having(COMPARTMENTS) + " SELECT compartment, count(DISTINCT iri) AS iris, string_agg(DISTINCT iri, ',' ORDER BY iri) AS named FROM compartments GROUP BY 1 HAVING count(DISTINCT iri) > 1")
def context_rule_conflicts(spark, sf):
    """Compartments that two lists' rules place differently."""
    return contexts.conflicting_rules(COMPARTMENTS.df(spark))


TAKEN = Fixture("taken", "uuid string, iri string, material string", [("t1", "c:take-water", "lake water"), ("t2", "c:take-lake", "lake water"), ("t3", "c:water", "lake water"), ("t4", "c:take-water", "plain water"), ("t5", None, "lake water")])
BODIES = Fixture("bodies", "material string, water_body string", [("lake water", "Lake"), ("river water", "River")])


@query(having(TAKEN) + " SELECT uuid, iri, material, CASE WHEN iri = 'c:take-water' AND material = 'lake water' THEN 'c:take-lake' ELSE iri END AS refined FROM taken")
def context_by_material(spark, sf):
    """Withdrawals from no stated body of water, whose material names one."""
    return contexts.refined_by_material(TAKEN.df(spark), VOCABULARY.df(spark), BODIES.df(spark), "iri", "material")


@query(
    """WITH d AS (SELECT doc_id, source, [lang, source, (n_chars % 7)::VARCHAR] AS w, doc_id % 40 = 0 AS asked FROM documents),
    j AS (SELECT a.doc_id AS id, b.doc_id AS target, (a.w[3] <> b.w[3])::INT * 2 AS distance FROM d a JOIN d b ON a.asked AND a.source = b.source AND a.w[1] = b.w[1]), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, target)::INT AS rank FROM j)
    SELECT id, target, distance, rank FROM r WHERE rank <= 8"""
)
def context_nearest(spark, sf):
    """For some documents the eight nearest of their source in a three-level taxonomy."""
    from ..sources.tables import table

    words = F.array("lang", "source", (F.col("n_chars") % 7).cast("string")).alias("words")
    d = table(spark, sf, "documents")
    return contexts.nearest(d.where("doc_id % 40 = 0").select(F.col("doc_id").alias("id"), "source", words), d.select(F.col("doc_id").alias("target"), "source", words), "id", "source")


PLACED = Fixture("placed", "substance string, iri string, created boolean", [("s1", "c:lake", True), ("s1", "c:aquifer", False), ("s2", "c:lake", True), ("s2", "c:water", False), ("s3", "c:lake", True), ("s4", "c:soil", True), ("s4", "c:lake", False), ("s4", "c:water", False)])


@query("SELECT * FROM (VALUES ('s1', 'c:lake', 1::BIGINT), ('s4', 'c:soil', 2)) t(substance, iri, others)")
def split_places(spark, sf):
    """Created contexts that are another place than all others of the substance."""
    return contexts.split_places(PLACED.df(spark), VOCABULARY.df(spark))


# --- the merge ---------------------------------------------------------------------------------

OBJECTS = Fixture(
    "objects",
    "object_id string, pref string, alts array<string>, cas array<string>, ec array<string>, qualifier string",
    [
        ("o1", "Carbon dioxide", ["CO2"], ["124-38-9"], [], None),
        ("o2", "Carbon dioxide, fossil", [], ["124-38-9"], [], "fossil"),
        ("o3", "Carbon dioxide, biogenic", [], ["124-38-9"], [], "biogenic"),
        ("o4", "Iron", ["Ferrum"], ["7439-89-6"], ["231-096-4"], None),
        ("o5", "Iron (III)", ["Iron ion"], ["20074-52-6"], [], None),
        ("o6", "Water", ["Aqua", "Ferrum"], [], ["231-791-2"], None),
        ("o7", "Xylene", ["Solvent X"], ["95-47-6"], [], None),
        ("o8", "p-Xylene", ["Solvent X"], ["106-42-3"], [], None),
        ("o9", "Noise", ["Sound"], [], [], None),
        ("o10", "waste heat", [], [], [], None),
        ("o11", "Sound", [], [], [], None),
    ],
)
ROWS = Fixture(
    "rows",
    "uuid string, name string, cas array<string>, ec array<string>, words array<string>, iri string, unit string, dialect boolean",
    [
        ("u01", "Carbon dioxide, fossil", ["124-38-9"], [], ["Environmental", "Air"], "c:air", "kg", False),
        ("u02", "Carbon dioxide, from peat", ["124-38-9"], [], ["Environmental", "Air"], "c:air", "kg", False),
        ("u03", "CO2", ["124-38-9"], [], ["Environmental", "Air"], "c:air", "kg", False),
        ("u04", "Ferric ion", ["20074-52-6"], [], ["Environmental", "Water", "Lake"], "c:lake", "kg", False),
        ("u05", "Iron, ion", [], [], ["Environmental", "Water"], "c:water", "kg", False),
        ("u06", "Wet stuff", [], ["231-791-2"], ["Environmental", "Water"], "c:water", "m3", False),
        ("u07", "ferrum", [], [], ["Environmental", "Water"], "c:water", "kg", False),
        ("u08", "Solvent X", [], [], ["Environmental", "Air"], "c:air", "kg", False),
        ("u09", "sound", [], [], ["Environmental", "Air"], "c:air", "dB", False),
        ("u10", "Heat, waste", [], [], ["Environmental", "Air"], "c:air", "MJ", True),
        ("u11", "Heat, waste", [], [], ["Environmental", "Air"], "c:air", "MJ", False),
        ("u12", "Old xylene", [], [], ["Environmental", "Air"], "c:air", "kg", False),
        ("u13", "Occupation, x", [], [], ["Land Use", "Occupation"], "c:occupation", "m2*a", False),
        ("u14", "Unknown thing", ["1-11-1"], [], ["Environmental", "Soil"], "c:soil", "kg", False),
    ],
)
CURATED = Fixture("curated", "uuid string, object_id string", [("u13", "o-land")])
HISTORICAL = Fixture("historical", "name string, now string", [("Old Xylene", "Xylene")])


@query(
    having(OBJECTS, ROWS)
    + """, k AS (SELECT object_id, 'cas' AS b, unnest(cas) AS k FROM objects UNION ALL SELECT object_id, 'ec', unnest(ec) FROM objects UNION ALL SELECT object_id, 'label', lower(unnest(list_append(alts, pref))) FROM objects),
    r AS (SELECT uuid, 'cas' AS b, unnest(cas) AS k FROM rows UNION ALL SELECT uuid, 'ec', unnest(ec) FROM rows UNION ALL SELECT uuid, 'label', lower(name) FROM rows)
    SELECT uuid, object_id, string_agg(DISTINCT b, ',' ORDER BY b) AS bases FROM r JOIN k USING (b, k) GROUP BY 1, 2"""
)
def merge_evidence(spark, sf):
    """Which objects a row's numbers and name reach, and by what."""
    return merging.evidence(ROWS.df(spark), OBJECTS.df(spark))


@query(
    having(ROWS)
    + """, e(uuid, object_id, basis, reason) AS (VALUES ('u01', 'o2', 'cas+qualifier', NULL), ('u02', NULL, NULL, 'no-candidate-with-qualifier'), ('u03', 'o1', 'cas+label', NULL), ('u04', 'o5', 'cas', NULL), ('u05', NULL, NULL, 'no-flow-object-candidate'),
    ('u06', 'o6', 'ec', NULL), ('u07', 'o6', 'label', NULL), ('u08', NULL, NULL, 'no-flow-object-candidate'), ('u09', 'o11', 'label+preferred-name', NULL), ('u10', 'o10', 'dialect', NULL), ('u11', NULL, NULL, 'no-flow-object-candidate'),
    ('u12', 'o7', 'historical-name', NULL), ('u13', NULL, NULL, 'no-flow-object-candidate'), ('u14', NULL, NULL, 'no-flow-object-candidate'))
    SELECT e.* FROM rows JOIN e USING (uuid)"""
)
def object_cascade(spark, sf):
    """Rows to objects by the ordered rungs, narrowed until one is left."""
    return merging.resolve_objects(ROWS.df(spark), OBJECTS.df(spark), CURATED.df(spark), HISTORICAL.df(spark))


FLOWS = Fixture(
    "flows",
    "flow_id string, object_id string, iri string, words array<string>, unit string",
    [
        ("f01", "o2", "c:air", ["Environmental", "Air"], "kg"),
        ("f02", "o2", "c:air-low", ["Environmental", "Air", "Low stack", "Urban"], "kg"),
        ("f03", "o1", "c:air-low", ["Environmental", "Air", "Low stack", "Urban"], "kg"),
        ("f04", "o5", "c:aquifer", ["Environmental", "Water", "Groundwater"], "kg"),
        ("f05", "o5", "c:water", ["Environmental", "Water"], "kg"),
        ("f06", "o6", "c:take-water", ["Resource", "Water"], "m3"),
        ("f07", "o11", "c:air-low", ["Environmental", "Air", "Low stack", "Urban"], "dB"),
        ("f08", "o11", "c:air-high", ["Environmental", "Air", "High stack", "Rural"], "dB"),
        ("f09", "o10", "c:air", ["Environmental", "Air"], "MJ"),
    ],
)
SELECT_ROWS = Fixture(
    "picked",
    "uuid string, object_id string, words array<string>, iri string, unit string",
    [
        ("u01", "o2", ["Environmental", "Air"], "c:air", "kg"),
        ("u03", "o1", ["Environmental", "Air"], "c:air", "kg"),
        ("u04", "o5", ["Environmental", "Water", "Lake"], "c:lake", "kg"),
        ("u06", "o6", ["Environmental", "Water"], "c:water", "m3"),
        ("u07", "o12", ["Environmental", "Water"], "c:water", "m3"),
        ("u09", "o11", ["Environmental", "Air"], "c:air", "dB"),
        ("u20", "o11", ["Environmental", "Air"], None, "dB"),
        ("u21", "o5", ["Environmental", "Water", "Lake"], None, "kg"),
        ("u22", "o10", ["Environmental", "Air"], None, "kWh"),
        ("u23", "o10", [], None, "kWh"),
    ],
)


@query("""SELECT * FROM (VALUES ('u01', 'f01', 'exact-context-iri-match', 5), ('u03', NULL, 'context-contradiction', NULL), ('u04', NULL, 'no-candidate-in-stated-context', NULL), ('u06', NULL, 'no-candidates-same-dimension-media', NULL),
    ('u07', NULL, 'no-elementary-candidates', NULL), ('u09', NULL, 'tied-elementary-candidates', NULL), ('u20', NULL, 'tied-elementary-candidates', NULL), ('u21', 'f05', 'best-score', 4), ('u22', 'f09', 'best-score', 2), ('u23', NULL, 'no-context-or-unit-signal', NULL)) t(uuid, target, reason, score)""")
def flow_selection(spark, sf):
    """The flow of an object that a row is, by context and unit, or why there is none."""
    return merging.select_flow(SELECT_ROWS.df(spark), FLOWS.df(spark), VOCABULARY.df(spark), ALLOWED.df(spark))


PREPARED = Fixture("prepared", "uuid string, target string, guard string", [("u05", "f05", None), ("u07", "f04", "Ferrum"), ("u08", "f01", "Other name"), ("u11", "old", None), ("u12", "f01", None), ("u12", "f09", None), ("u14", "dead", None), ("u04", "f04", None)])
REDIRECTS = Fixture("redirects", "id string, replaced_by string", [("old", "older"), ("older", "f09"), ("dead", "gone"), ("ring1", "ring2"), ("ring2", "ring1")])


@query("SELECT * FROM (VALUES ('u05', 'f05', 'prepared'), ('u07', NULL, 'context'), ('u11', 'f09', 'prepared'), ('u12', NULL, 'ambiguous'), ('u14', NULL, 'gone'), ('u04', NULL, 'context')) t(uuid, target, verdict)")
def prepared_matches(spark, sf):
    """Curated targets, followed through replacements and held against the row's context."""
    return merging.prepared_decisions(ROWS.df(spark), PREPARED.df(spark), REDIRECTS.df(spark), FLOWS.df(spark), VOCABULARY.df(spark), ALLOWED.df(spark))


def _merged(spark) -> DataFrame:
    return merging.merged(ROWS.df(spark), OBJECTS.df(spark), FLOWS.df(spark), VOCABULARY.df(spark), ALLOWED.df(spark), CURATED.df(spark), HISTORICAL.df(spark), PREPARED.df(spark), REDIRECTS.df(spark))


def _minted(obj: str, iri: str) -> str:
    return f"sha1('flow:' || {obj} || ':{iri}')"


def _object(basis: str) -> str:
    return f"'obj-' || substr(sha1('{basis}'), 1, 16)"


MERGED = f"""WITH m(uuid, outcome, target, basis, reason) AS (VALUES
    ('u01', 'algorithm', 'f01', 'cas+qualifier', 'exact-context-iri-match'), ('u02', 'unmatched', NULL, NULL, 'no-candidate-with-qualifier'), ('u03', 'created', {_minted("'o1'", "c:air")}, 'cas+label', 'context-contradiction'),
    ('u04', 'created', {_minted("'o5'", "c:lake")}, 'cas', 'no-candidate-in-stated-context'), ('u05', 'prepared', 'f05', 'prepared', NULL), ('u06', 'created', {_minted("'o6'", "c:water")}, 'ec', 'no-candidates-same-dimension-media'),
    ('u07', 'created', {_minted("'o6'", "c:water")}, 'label', 'no-candidates-same-dimension-media'), ('u08', 'created', {_minted(_object("solvent x"), "c:air")}, NULL, 'no-flow-object-candidate'),
    ('u09', 'created', {_minted("'o11'", "c:air")}, 'label+preferred-name', 'tied-elementary-candidates'), ('u10', 'algorithm', 'f09', 'dialect', 'exact-context-iri-match'), ('u11', 'prepared', 'f09', 'prepared', NULL),
    ('u12', 'unmatched', NULL, 'historical-name', 'no-elementary-candidates'), ('u13', 'created', {_minted(_object("occupation, x"), "c:occupation")}, NULL, 'no-flow-object-candidate'), ('u14', 'created', {_minted(_object("1-11-1"), "c:soil")}, NULL, 'no-flow-object-candidate'))"""


@query(MERGED + " SELECT * FROM m")
def merge_outcomes(spark, sf):
    """Exactly one outcome of every row: prepared, by the algorithm, created or unmatched."""
    return _merged(spark)


OUTCOMES = Fixture("outcomes", "uuid string, outcome string, target string", [("u01", "algorithm", "f01"), ("u02", "algorithm", "f03"), ("u05", "prepared", "f04"), ("u10", "unmatched", None), ("u12", "unmatched", None)])


@query("SELECT * FROM (VALUES ('algorithm', 'same', 1::BIGINT), ('algorithm', 'lost', 1), ('prepared', 'other', 1), ('unmatched', 'found', 1), ('unmatched', 'same', 1)) t(outcome, verdict, rows)")
def merge_replay(spark, sf):
    """Recorded outcomes against what the merge decides today."""
    return merging.replayed(OUTCOMES.df(spark), _merged(spark))


DECISIONS = Fixture("decisions", "uuid string, name string, iri string, target string", [("u01", "Carbon dioxide, fossil", "c:air", "f02"), ("z1", "Heat, Waste", "c:air", "f09"), ("z2", "heat, waste", "c:air", "f09"), ("z3", "CO2", "c:air", "f01"), ("z4", "co2", "c:air", "f03"), ("u04", "Ferric ion", "c:lake", "f04"), ("u04", "Ferric ion", "c:lake", "f05")])


@query("""SELECT * FROM (VALUES ('u01', 'f02', 'identifier', NULL), ('u10', 'f09', 'name', NULL), ('u11', 'f09', 'name', NULL), ('u02', NULL, 'algorithm', 'no-candidate-with-qualifier'), ('u03', NULL, 'algorithm', 'context-contradiction'),
    ('u04', NULL, 'algorithm', 'no-candidate-in-stated-context'), ('u05', NULL, 'algorithm', 'no-flow-object-candidate'), ('u06', NULL, 'algorithm', 'no-candidates-same-dimension-media'), ('u07', NULL, 'algorithm', 'no-candidates-same-dimension-media'),
    ('u08', NULL, 'algorithm', 'no-flow-object-candidate'), ('u09', NULL, 'algorithm', 'tied-elementary-candidates'), ('u12', NULL, 'algorithm', 'no-elementary-candidates'), ('u13', NULL, 'algorithm', 'no-flow-object-candidate'), ('u14', NULL, 'algorithm', 'no-flow-object-candidate')) t(uuid, target, tier, reason)""")
def lookup_batch(spark, sf):
    """A batch of questions: recorded by identifier, recorded by name in context, then the algorithm."""
    return merging.lookup(ROWS.df(spark), DECISIONS.df(spark), OBJECTS.df(spark), FLOWS.df(spark), VOCABULARY.df(spark), ALLOWED.df(spark), CURATED.df(spark), HISTORICAL.df(spark))


@query(MERGED + f""" SELECT 'o1' AS object_id, {_minted("'o1'", "c:air")} AS flow_id, 'c:air' AS iri, 'kg' AS unit, 1::BIGINT AS rows UNION ALL SELECT 'o5', {_minted("'o5'", "c:lake")}, 'c:lake', 'kg', 1
    UNION ALL SELECT 'o6', {_minted("'o6'", "c:water")}, 'c:water', 'm3', 2 UNION ALL SELECT 'o11', {_minted("'o11'", "c:air")}, 'c:air', 'dB', 1""")
def added_contexts(spark, sf):
    """Flows to create where an object isn't in its rows' context yet, each once."""
    rows, args = ROWS.df(spark), (CURATED.df(spark), HISTORICAL.df(spark))
    r = rows.join(merging.resolve_objects(rows, OBJECTS.df(spark), *args).select("uuid", "object_id"), "uuid").where("object_id is not null")
    s = merging.select_flow(r, FLOWS.df(spark), VOCABULARY.df(spark), ALLOWED.df(spark)).select("uuid", "reason")
    return merging.added_contexts(r.join(s, "uuid"), FLOWS.df(spark))


@query(f"SELECT 'u05' AS uuid, {_object('iron, ion')} AS object_id, false AS blocked UNION ALL SELECT 'u08', {_object('solvent x')}, false UNION ALL SELECT 'u11', {_object('heat, waste')}, false UNION ALL SELECT 'u13', {_object('occupation, x')}, false UNION ALL SELECT 'u14', {_object('1-11-1')}, false")
def created_objects(spark, sf):
    """Objects to create for rows that reach none."""
    rows = ROWS.df(spark)
    r = merging.resolve_objects(rows, OBJECTS.df(spark), CURATED.df(spark), HISTORICAL.df(spark))
    return merging.created_objects(rows.join(r.select("uuid", "reason"), "uuid"), OBJECTS.df(spark))


@query(
    having(OBJECTS, ROWS)
    + """, k AS (SELECT object_id, 'cas' AS b, unnest(cas) AS k FROM objects UNION ALL SELECT object_id, 'ec', unnest(ec) FROM objects UNION ALL SELECT object_id, 'label', lower(unnest(list_append(alts, pref))) FROM objects),
    r AS (SELECT uuid, 'cas' AS b, unnest(cas) AS k FROM rows UNION ALL SELECT uuid, 'ec', unnest(ec) FROM rows UNION ALL SELECT uuid, 'label', lower(name) FROM rows),
    e AS (SELECT uuid, count(DISTINCT object_id) AS objects, string_agg(DISTINCT b, ',' ORDER BY b) AS bases FROM r JOIN k USING (b, k) GROUP BY 1)
    SELECT uuid, coalesce(objects, 0) AS objects, coalesce(bases, '') AS bases FROM rows LEFT JOIN e USING (uuid)"""
)
def unmatched_evidence(spark, sf):
    """Rows with the number of objects that any evidence reaches."""
    return merging.enriched(ROWS.df(spark), OBJECTS.df(spark)).select("uuid", "objects", "bases")


IDENTITIES = Fixture("identities", "uuid string, version int, name string, cas array<string>", [("u11", 1, "Warm", ["1-1-1"]), ("u11", 3, "Newest heat", ["3-3-3"]), ("u11", 2, "Heat", ["2-2-2"])])


@query(having(ROWS) + " SELECT uuid, CASE WHEN uuid = 'u11' THEN 'Newest heat' ELSE name END AS name, CASE WHEN uuid = 'u11' THEN '3-3-3' ELSE array_to_string(cas, ',') END AS cas FROM rows")
def newest_identities(spark, sf):
    """Rows under the newest name and numbers that their uuid has had."""
    return merging.canonicalized(ROWS.df(spark), IDENTITIES.df(spark)).select("uuid", "name", F.array_join("cas", ",").alias("cas"))


@query(
    """WITH u(unit, kind, ref, m) AS (VALUES ('kg', 'mass', 'kg', 1.0::DOUBLE), ('g', 'mass', 'kg', 0.001), ('m2', 'area', 'm2', 1.0), ('m2*a', 'area-time', 'm2*a', 1.0), ('l', 'volume', 'm3', 0.001), ('m3', 'volume', 'm3', 1.0), ('?', NULL, NULL, NULL)),
    x AS (SELECT p_partkey::VARCHAR AS uuid, ['kg', 'g', 'm2', 'l', '?'][1 + p_size % 5] AS a, ['kg', 'm2*a', 'm3', 'm2'][1 + p_partkey % 4] AS b, p_partkey % 11 = 0 AS said, p_partkey % 13 = 0 AS moved FROM part),
    j AS (SELECT x.*, CASE WHEN said AND NOT moved THEN 7.5 END AS s, CASE WHEN a = 'l' AND b = 'kg' THEN 0.9 END AS c, CASE WHEN ua.kind = ub.kind AND ua.ref = ub.ref THEN ua.m / ub.m END AS t, ua.kind AS ka, ub.kind AS kb FROM x LEFT JOIN u ua ON a = ua.unit LEFT JOIN u ub ON b = ub.unit)
    SELECT uuid, round(coalesce(s, CASE WHEN a = b THEN 1.0 END, c, t), 9) AS factor, CASE WHEN s IS NOT NULL THEN 'stated' WHEN a = b THEN 'none-needed' WHEN c IS NOT NULL THEN 'curated' WHEN t IS NOT NULL THEN 'unit-table' ELSE 'unknown' END AS origin,
    coalesce(ka <> kb, false) AS crosses_kinds, a <> b AND (a || '*a' = b OR b || '*a' = a) AS crosses_time FROM j"""
)
def conversions(spark, sf):
    """Which conversion a match publishes, and whether it crosses kinds or a time dimension."""
    from ..sources.tables import table

    pick = lambda xs, k: F.element_at(F.array(*map(F.lit, xs)), (k + 1).cast("int"))
    p = table(spark, sf, "part")
    m = p.select(F.col("p_partkey").cast("string").alias("uuid"), pick(["kg", "g", "m2", "l", "?"], F.col("p_size") % 5).alias("source_unit"), pick(["kg", "m2*a", "m3", "m2"], F.col("p_partkey") % 4).alias("target_unit"), (F.col("p_partkey") % 11 == 0).alias("said"), (F.col("p_partkey") % 13 == 0).alias("moved"))
    stated = m.where("said").select("uuid", F.when(F.col("moved"), "t").otherwise(F.col("source_unit")).alias("source_unit"), "target_unit", F.lit(7.5).alias("factor"))
    curated = spark.createDataFrame([("l", "kg", 0.9)], "source_unit string, target_unit string, factor double")
    out = merging.published_conversion(m.select("uuid", "source_unit", "target_unit"), stated, curated, units.unit_table(spark))
    return out.select("uuid", F.round("factor", 9).alias("factor"), "origin", F.coalesce("crosses_kinds", F.lit(False)).alias("crosses_kinds"), "crosses_time")


@query("SELECT l_orderkey, l_linenumber, l_returnflag AS source_unit, l_linestatus AS target_unit FROM lineitem WHERE l_returnflag <> l_linestatus AND NOT (l_returnflag = 'N' AND l_linestatus = 'O') AND l_quantity = 50")
def unit_mismatches(spark, sf):
    """Pairs whose units differ, without those that are allowed to."""
    from ..sources.tables import table

    m = table(spark, sf, "lineitem").where("l_quantity = 50").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("source_unit"), F.col("l_linestatus").alias("target_unit"))
    return merging.unit_mismatches(m, spark.createDataFrame([("N", "O")], "source_unit string, target_unit string")).select("l_orderkey", "l_linenumber", "source_unit", "target_unit")


@query("""WITH m AS (SELECT DISTINCT c_custkey::VARCHAR AS uuid, 'n' || c_nationkey || '-' || floor(c_acctbal / 250)::BIGINT AS target FROM customer) SELECT target, string_agg(uuid, ',' ORDER BY uuid) AS sources FROM m WHERE NOT starts_with(target, 'n1-') GROUP BY 1 HAVING count(*) > 1""")
def unrecorded_groupings(spark, sf):
    """Targets that several rows were folded into, without a record of it."""
    from ..sources.tables import table

    target = F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit("-"), F.floor(F.col("c_acctbal") / 250).cast("string"))
    m = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("uuid"), target.alias("target"))
    return merging.unrecorded_groupings(m, m.where(F.col("target").startswith("n1-")).select("target").distinct()).select("target", "sources")
