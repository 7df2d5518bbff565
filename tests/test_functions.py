"""Scalar functions and operators that no query of the driver's tables covers."""

import pytest
from pyspark.sql import functions as F

from concordat.functions import checks, names, numbers, text, units
from concordat.operators import changes, factors, groups, match
from concordat.sources import formats
from concordat.streaming import incremental


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_check_digits(spark):
    assert one(spark, checks.cas_valid(F.lit("7732-18-5")), checks.cas_valid(F.lit("7732-18-4")), checks.correct_cas(F.lit("7732-18-4")), checks.cas_valid(F.lit("water"))) == (True, False, "7732-18-5", False)
    assert one(spark, checks.ec_valid(F.lit("231-791-2")), checks.correct_ec(F.lit("231-791-3")), checks.normalize_cas(F.lit("0050-00-0"))) == (True, "231-791-2", "50-00-0")


def test_names(spark):
    lit = F.lit
    assert one(spark, names.deinvert_index_name(lit("Toluene, bromo-")), names.deinvert_phrase(lit("Timber, sawn")), names.valence_in_parentheses(lit("Cobalt II")), names.fused_locants(lit("Dibenzo(a,h)pyrene")), names.without_unit_suffix(lit("Steam/kg"), lit("kg"))) == ("bromotoluene", "sawn timber", "cobalt (ii)", "dibenzo[a,h]pyrene", "Steam")
    assert one(spark, names.deinvert_phrase(lit("Cobalt, ion")), names.without_unit_suffix(lit("Steam/kg"), lit("m3"))) == (None, None)
    assert tuple(one(spark, names.nuclide(lit("Cobalt-60m")))[0]) == ("cobalt", 60, "m")
    assert tuple(one(spark, names.ion_parts(lit("Cobalt(II)")))[0]) == ("Cobalt", 2)
    assert one(spark, names.ion_label(lit("Cobalt"), lit(2)), names.half_life_seconds(lit("2.5(3) h"))) == ("cobalt (ii)", 9000.0)
    a, b, c = "QWERTYUIOPASDF-UHFFFAOYSA-N", "QWERTYUIOPASDF-ZXCVBNMASA-N", "GHJKLZXCVBNMQW-UHFFFAOYSA-N"
    assert one(spark, names.compare_structures(lit(a), lit(b)), names.compare_structures(lit(a), lit(c)), names.compare_structures(lit(a), lit("x"))) == ("flat-vs-stereo", "different", "unknown")
    assert one(spark, names.without_flat_keys(F.array(lit(a), lit(b), lit(c))))[0] == [b, c]
    assert one(spark, names.element_counts(lit("C3H7OH")))[0] == {"C": 3, "H": 8, "O": 1}
    assert one(spark, names.formula_similarity(lit("NH3"), lit("NH3")), names.element_counts(lit("x")))[0] == 1.0


def test_text(spark):
    lit = F.lit
    assert one(spark, text.qualifier(lit("Ethanol, non-fossil")), text.qualifier(lit("Propane, fossil")), text.qualifier(lit("Steam"))) == ("non-fossil", "fossil", None)
    assert one(spark, text.dedupe_labels(F.array(lit("A b"), lit("a  B"), lit("c"))))[0] == ["A b", "c"]
    assert one(spark, text.family_token(lit("(Vel-o) 7")), text.is_product_designation(lit("Velox HS-40.")), text.is_product_designation(lit("2-velane 7")), text.is_product_designation(lit("Velox plain")), text.is_product_designation(lit("7"))) == ("vel-o", True, False, False, False)
    assert one(spark, text.is_becquerel(lit(" kBq")), text.is_becquerel(lit("kg")), text.catalogue_kind(lit("Velox 12 (dry)")), text.qualifier_losses(lit("Propane (wet), fossil"), lit("Propane"))) == (True, False, "trade-name", ["origin:fossil", "bracket:wet"])


def test_numbers(spark):
    assert numbers.more_precise(4.416e-05, 4.42e-05) == 4.416e-05
    assert numbers.more_precise(1.0, 2.0) is None
    assert numbers.more_precise(4.44e-05, 4.416e-05) is None
    assert [numbers.printed_digits(x) for x in (1e23, 0.1, 120.0, 0.0)] == [1, 1, 2, 0]
    df = spark.createDataFrame([(1e23,), (0.125,), (None,)], "x double")
    assert [r[0] for r in df.select(numbers.significant_digits(F.col("x"))).collect()] == [1, 3, None]
    lo, hi = F.col("lo"), F.col("hi")
    rows = [(1.0, 1.0), (1.0, 1.01), (1.0, 2.0), (-1.0, 1.0), (0.0, 1.0), (1.0, 1000.0), (None, 1.0)]
    assert [r[0] for r in spark.createDataFrame(rows, "lo double, hi double").select(numbers.band(lo, hi)).collect()] == ["identical", "within-tolerance", "2x", "incomparable", "incomparable", "over-100x", "incomparable"]
    assert one(spark, numbers.to_significant(F.lit(123456.0), 3), numbers.to_significant(F.lit(-0.0125), 2)) == (123000.0, -0.013)


def test_settle_precise(spark):
    rows = spark.createDataFrame([("a", 1, 4.42), ("a", 2, 4.416), ("b", 1, 1.0), ("b", 2, 5.0), ("c", 1, 2.0)], "k string, o int, x double")
    got = {r.k: (r.amount, r.superseded) for r in factors.settle_precise(rows, ["k"], "x", ["o"]).collect()}
    assert got["a"] == (4.416, 1) and got["c"] == (2.0, 0) and got["b"][0] is None or got["b"][0] != got["b"][0]


def test_closure_cycle_and_dead_end(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x")], "id string, replaced_by string")
    got = {r.id: (r.terminal, r.status) for r in groups.closure(e, "id", "replaced_by").collect()}
    assert got["a"] == ("d", "resolved") and got["c"] == ("d", "resolved") and got["x"] == (None, "cycle")


def test_owners_first_registrant(spark):
    keys = spark.createDataFrame([(1, "p"), (2, "p"), (2, "q"), (3, "q"), (4, "r")], "row long, key string")
    for n in (1, 3, 8):
        assert {tuple(r) for r in match.owners(keys.repartition(n), "row", "key").collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_vote_ties_and_assess(spark):
    v = spark.createDataFrame([("k", "a", "s1"), ("k", "a", "s1"), ("k", "b", "s2"), ("w", "a", "s1"), ("w", "a", "s2"), ("s", "a", "s1")], "key string, c string, src string")
    assert {tuple(r) for r in match.quorum(v, "key", "c", "src").collect()} == {("k", None, 1), ("w", "a", 2), ("s", None, 1)}
    with pytest.raises(ValueError):
        changes.refuse(v, "rows")


def test_units(spark):
    rows = spark.createDataFrame([("kg", "g", None), ("kg", "m3", None), ("x", "x", None), ("kg", "m3", 0.5)], "a string, b string, s double")
    got = [r.factor for r in units.quantity_factor(rows, units.unit_table(spark), "a", "b", "s").collect()]
    assert sorted(got, key=str) == sorted([1000.0, None, 1.0, 0.5], key=str)


def test_formats(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Impact category\nClimate;kg\n\nSubstances\nair;low;Ethane;74-84-0;1,5;kg\n\n")
    assert [tuple(r) for r in formats.simapro_substances(spark, str(tmp_path / "m.csv")).collect()] == [("Climate", "kg", "air", "low", "Ethane", "74-84-0", 1.5, "kg")]
    (tmp_path / "f.json").write_text('{"uuid": "1", "name": "Water", "odd": "x"}\n')
    r = formats.json_flows(spark, str(tmp_path / "f.json")).first()
    assert (r.uuid, r.name, r.extra) == ("1", "Water", {"odd": "x"})
    (tmp_path / "e.xml").write_text('<r><elementaryExchange id="u1" casNumber="0074-84-0"><name> Ethane </name><unitName>kg</unitName><compartment><compartment>air</compartment><subcompartment>low</subcompartment></compartment><synonym>bimethyl</synonym></elementaryExchange></r>')
    r = formats.ecospold_flows(spark, str(tmp_path / "e.xml")).first()
    assert (r.uuid, r.name, r.cas, r.context, r.synonyms) == ("u1", "Ethane", ["74-84-0"], ["air", "low"], ["bimethyl"])
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    formats.write_snapshot(df, str(tmp_path / "s"), "1.0")
    formats.write_snapshot(df, str(tmp_path / "s"), "1.1")
    assert formats.load_snapshot(spark, str(tmp_path / "s"), "1.0").count() == 1
    assert formats.upsert(df, spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "k int, v string"), ["k"]).count() == 2


def test_stream_append(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(str(tmp_path / "t.parquet"))
    seen = []
    incremental.each_batch(incremental.parquet_stream(spark, str(tmp_path), "t"), str(tmp_path / "ck"), lambda df, n: seen.append(df.count()))
    assert sum(seen) == 2
    out = incremental.to_table(incremental.parquet_stream(spark, str(tmp_path), "t"), str(tmp_path / "o"), str(tmp_path / "ck2"))
    assert out.count() == 2


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
