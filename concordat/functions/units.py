"""Unit conversion: stated pair, same unit, unit table, in this order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unit, quantity kind, reference unit, multiplier to the reference.
UNITS = (("kg", "mass", "kg", 1.0), ("g", "mass", "kg", 0.001), ("t", "mass", "kg", 1000.0), ("m3", "volume", "m3", 1.0), ("l", "volume", "m3", 0.001), ("MJ", "energy", "MJ", 1.0), ("kWh", "energy", "MJ", 3.6), ("kBq", "activity", "kBq", 1.0), ("Bq", "activity", "kBq", 0.001), ("m2*a", "area-time", "m2*a", 1.0), ("m2", "area", "m2", 1.0))


def unit_table(spark) -> DataFrame:
    return spark.createDataFrame(UNITS, "unit string, kind string, reference string, multiplier double")


def quantity_factor(rows: DataFrame, units: DataFrame, source: str, target: str, stated: str | None = None) -> DataFrame:
    """Adds ``factor`` from source to target unit; null where nothing states one.

    The unit table is a dimension of some hundred rows; Catalyst broadcasts it by its size.
    """
    a, b = (units.select(F.col("unit").alias(f"__{s}u"), F.col("kind").alias(f"__{s}k"), F.col("reference").alias(f"__{s}r"), F.col("multiplier").alias(f"__{s}m")) for s in "ab")
    out = rows.join(a, rows[source] == F.col("__au"), "left").join(b, rows[target] == F.col("__bu"), "left")
    table = F.when((F.col("__ak") == F.col("__bk")) & (F.col("__ar") == F.col("__br")), F.col("__am") / F.col("__bm"))
    first = [rows[stated]] if stated else []
    return out.withColumn("factor", F.coalesce(*first, F.when(rows[source] == rows[target], 1.0), table)).drop(*(f"__{s}{k}" for s in "ab" for k in "ukrm"))
