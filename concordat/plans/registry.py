"""Queries by name, the SQL that checks each, and small authored tables that both read."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Types of authored tables in Spark and in the checking SQL.
TYPES = {"string": "VARCHAR", "double": "DOUBLE", "long": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


class Fixture:
    """A small table written out: as a DataFrame, and as a common table expression."""

    def __init__(self, name: str, schema: str, rows: list[tuple]):
        self.name, self.schema, self.rows = name, schema, rows
        self.columns = [tuple(c.split(" ")) for c in re.split(r", (?![^<]*>)", schema)]

    def df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.schema)

    def cte(self) -> str:
        rows = ", ".join("(" + ", ".join(_literal(v, t) for v, (_, t) in zip(r, self.columns, strict=True)) + ")" for r in self.rows)
        return f"{self.name}({', '.join(c for c, _ in self.columns)}) AS (VALUES {rows})"


def _literal(v, kind: str) -> str:
    if v is None:
        text = "NULL"
    elif isinstance(v, bool):
        text = str(v).lower()
    elif isinstance(v, str):
        text = "'" + v.replace("'", "''") + "'"
    elif isinstance(v, list | tuple):
        text = "[" + ", ".join(_literal(x, "string") for x in v) + "]"
    else:
        text = repr(v)
    return f"{text}::{TYPES[kind]}"


def having(*fixtures: Fixture) -> str:
    """The opening of a statement over authored tables."""
    return "WITH " + ",\n    ".join(f.cte() for f in fixtures)
