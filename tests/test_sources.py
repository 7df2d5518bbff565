"""Readers of publishers' files and writers of documents, over small files written here."""

import gzip

from pyspark.sql import functions as F

from concordat.sources import formats, lists

FLOWS = """<x><flowDataSet><flowInformation><dataSetInformation><UUID>u1</UUID><name><baseName> Velane </baseName></name><synonyms>velin; vel ;;vélane</synonyms><CASNumber>0000100-41-4</CASNumber><generalComment>Version 01.00.000</generalComment></dataSetInformation>
<quantitativeReference><referenceToReferenceFlowProperty>0</referenceToReferenceFlowProperty></quantitativeReference></flowInformation><flowProperties><flowProperty dataSetInternalID="0"><referenceToFlowPropertyDataSet refObjectId="p1"/><meanValue>1.0</meanValue></flowProperty>
<flowProperty dataSetInternalID="1"><referenceToFlowPropertyDataSet refObjectId="p2"/><meanValue>42.5</meanValue></flowProperty></flowProperties></flowDataSet>
<flowDataSet><flowInformation><dataSetInformation><UUID>u2</UUID><name><baseName>Timber</baseName></name><generalComment>Sawn on site</generalComment></dataSetInformation></flowInformation></flowDataSet></x>"""
PROPERTIES = """<x><flowPropertyDataSet><flowPropertiesInformation><dataSetInformation><UUID>p1</UUID><name>Mass</name></dataSetInformation><quantitativeReference><referenceToReferenceUnitGroup refObjectId="g1"/></quantitativeReference></flowPropertiesInformation></flowPropertyDataSet>
<flowPropertyDataSet><flowPropertiesInformation><dataSetInformation><UUID>p2</UUID><name>Energy</name></dataSetInformation><quantitativeReference><referenceToReferenceUnitGroup refObjectId="g2"/></quantitativeReference></flowPropertiesInformation></flowPropertyDataSet></x>"""
GROUPS = """<x><unitGroupDataSet><unitGroupInformation><dataSetInformation><UUID>g1</UUID></dataSetInformation><quantitativeReference><referenceToReferenceUnit>1</referenceToReferenceUnit></quantitativeReference></unitGroupInformation>
<units><unit dataSetInternalID="0"><name>g</name><meanValue>0.001</meanValue></unit><unit dataSetInternalID="1"><name>kg</name><meanValue>1</meanValue></unit></units></unitGroupDataSet>
<unitGroupDataSet><unitGroupInformation><dataSetInformation><UUID>g2</UUID></dataSetInformation><quantitativeReference><referenceToReferenceUnit>0</referenceToReferenceUnit></quantitativeReference></unitGroupInformation>
<units><unit dataSetInternalID="0"><name>MJ</name><meanValue>1</meanValue></unit></units></unitGroupDataSet></x>"""
METHOD = """<x><LCIAMethodDataSet><LCIAMethodInformation><dataSetInformation><UUID>m1</UUID></dataSetInformation></LCIAMethodInformation><characterisationFactors><factor><referenceToFlowDataSet refObjectId="u1"/><location>PT</location><meanValue>0</meanValue></factor>
<factor><referenceToFlowDataSet refObjectId="u2"/><meanValue>2.5</meanValue></factor></characterisationFactors></LCIAMethodDataSet></x>"""


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.xml").write_text(f'<?xml version="1.0" encoding="UTF-8"?>\n{text}')
    return {name: str(folder / f"{name}.xml") for name in files}


def test_base_list(spark, tmp_path):
    at = write(tmp_path, flows=FLOWS, properties=PROPERTIES, groups=GROUPS, method=METHOD)
    flows = lists.base_flows(spark, at["flows"]).cache()
    got = {r.uuid: r for r in flows.collect()}
    assert (got["u1"].name, got["u1"].synonyms, got["u1"].cas, got["u1"].comment) == ("Velane", ["velin", "vel", "vélane"], "100-41-4", None)
    assert (got["u2"].cas, got["u2"].comment, got["u2"].synonyms) == (None, "Sawn on site", [])
    units = lists.reference_units(spark, at["properties"], at["groups"])
    assert {tuple(r) for r in units.collect()} == {("p1", "Mass", "kg"), ("p2", "Energy", "MJ")}
    assert {r.property: (r.value, r.unit) for r in lists.property_values(flows, units).collect()} == {"Mass": (1.0, "kg"), "Energy": (42.5, "MJ")}
    assert {tuple(r) for r in formats.ilcd_factors(spark, at["method"]).collect()} == {("m1", "u1", "PT", 0.0), ("m1", "u2", "", 2.5)}


def test_flow_units(spark):
    flows = spark.createDataFrame([("u1", "0", [("0", ("p1",), 1.0), ("1", ("p2",), 2.0)]), ("u2", None, None)], "uuid string, reference string, properties array<struct<_dataSetInternalID:string,referenceToFlowPropertyDataSet:struct<_refObjectId:string>,meanValue:double>>")
    units = spark.createDataFrame([("p1", "Mass", "kg"), ("p2", "Energy", "MJ")], "property string, name string, unit string")
    assert {tuple(r) for r in lists.flow_units(flows, units).collect()} == {("u1", "kg"), ("u2", None)}


def test_json_sink(spark, tmp_path):
    formats.write_json(spark.createDataFrame([(1, None), (2, "b")], "k int, v string").coalesce(1), str(tmp_path / "out"))
    lines = [x for p in (tmp_path / "out").glob("*.json.gz") for x in gzip.open(p, "rt").read().splitlines()]
    assert sorted(lines) == ['{"k":1}', '{"k":2,"v":"b"}']


def test_outcomes_replace_only_their_partition(spark, tmp_path):
    rows = spark.createDataFrame([("r1", "A", 1), ("r1", "B", 2)], "run string, list string, n int")
    formats.write_partition(rows, str(tmp_path / "o"), ["run", "list"])
    formats.write_partition(rows.where("list = 'B'").withColumn("n", F.lit(9)), str(tmp_path / "o"), ["run", "list"])
    assert {(r.list, r.n) for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {("A", 1), ("B", 9)}
