"""File formats: flow lists in XML, JSON and block text, and the engine's sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FLOW

#: The blocks of a SimaPro method export that hold substances, and other openers.
CATEGORY, SUBSTANCES = "Impact category", "Substances"


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema) -> DataFrame:
    """Rows of XML files by tag, with a declared schema."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def ecospold_flows(spark: SparkSession, path: str) -> DataFrame:
    """uuid, name, cas, context and unit of the elementary exchanges of an ecoSpold 2 master file."""
    schema = "_id string, _casNumber string, name string, unitName string, compartment struct<compartment:string, subcompartment:string>, synonym array<string>"
    x = xml_rows(spark, path, "elementaryExchange", schema)
    cas = F.regexp_replace("_casNumber", r"^0+([0-9])", "$1")
    return x.select(F.col("_id").alias("uuid"), F.trim("name").alias("name"), F.when(F.length(cas) > 0, F.array(cas)).otherwise(F.array().cast("array<string>")).alias("cas"), F.array("compartment.compartment", "compartment.subcompartment").alias("context"), F.col("unitName").alias("unit"), F.coalesce("synonym", F.array().cast("array<string>")).alias("synonyms"))


def ilcd_factors(spark: SparkSession, path: str) -> DataFrame:
    """method, flow, location and amount of ILCD method files; stated zeros stay."""
    schema = "LCIAMethodInformation struct<dataSetInformation:struct<UUID:string>>, characterisationFactors struct<factor:array<struct<referenceToFlowDataSet:struct<_refObjectId:string>, location:string, meanValue:double>>>"
    x = xml_rows(spark, path, "LCIAMethodDataSet", schema)
    x = x.select(F.col("LCIAMethodInformation.dataSetInformation.UUID").alias("method"), F.explode("characterisationFactors.factor").alias("f"))
    return x.select("method", F.col("f.referenceToFlowDataSet._refObjectId").alias("flow"), F.coalesce("f.location", F.lit("")).alias("geo"), F.col("f.meanValue").alias("amount"))


def json_flows(spark: SparkSession, path: str) -> DataFrame:
    """Flow records of JSON lines; unknown keys are kept in ``extra``."""
    known = {f.name for f in FLOW.fields} - {"extra"}
    raw = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    typed = raw.select(F.from_json("value", FLOW).alias("r"), F.from_json("value", "map<string,string>").alias("m"))
    extra = F.map_filter("m", lambda k, v: ~k.isin(*sorted(known)))
    return typed.select(*[F.col(f"r.{n}") for n in FLOW.fieldNames() if n != "extra"], extra.alias("extra"))


def simapro_substances(spark: SparkSession, path: str) -> DataFrame:
    """Factor rows of SimaPro method exports: method category, unit, context, substance, cas, amount.

    A block spans lines, so each file is one record; ``;`` separates, blank lines end a block.
    """

    def parse(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for text in pdf["value"]:
                block, category, unit = None, None, None
                for line in text.splitlines():
                    cell = [c.strip() for c in line.split(";")]
                    if not line.strip():
                        block = None if block != CATEGORY else block
                    elif cell[0] in (CATEGORY, SUBSTANCES):
                        block = cell[0]
                    elif block == CATEGORY and len(cell) >= 2:
                        category, unit, block = cell[0], cell[1], None
                    elif block == SUBSTANCES and len(cell) >= 6:
                        rows.append((category, unit, cell[0], cell[1], cell[2], cell[3], float(cell[4].replace(",", ".")), cell[5]))
            yield pd.DataFrame(rows, columns=["category", "category_unit", "compartment", "subcompartment", "substance", "cas", "amount", "unit"])

    schema = "category string, category_unit string, compartment string, subcompartment string, substance string, cas string, amount double, unit string"
    return spark.read.text(path, wholetext=True).mapInPandas(parse, schema)


def write_partition(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace only the partitions that the rows belong to."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Gzipped JSON lines without null fields."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path, compression="gzip")


def write_snapshot(df: DataFrame, path: str, version: str, schema_version: int = 1) -> None:
    write_partition(df.withColumn("version", F.lit(version)).withColumn("schema_version", F.lit(schema_version)), path, ["version"])


def load_snapshot(spark: SparkSession, path: str, version: str, schema_version: int = 1) -> DataFrame:
    """A release as written; one of another schema version is refused."""
    df = spark.read.parquet(path).where(F.col("version") == version)
    other = df.where(F.col("schema_version") != schema_version).select("schema_version").limit(1).collect()
    if other:
        raise ValueError(f"schema version {other[0][0]} is not {schema_version}")
    return df.drop("version", "schema_version")


def upsert(existing: DataFrame, arriving: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows, and arriving ones whose key is new; of equal new keys one stays."""
    return existing.unionByName(arriving.dropDuplicates(key).join(existing.select(*key), key, "left_anti"))
