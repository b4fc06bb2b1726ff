"""Registered queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of one folder, read on use: ``t.events``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, name, root=self.root)


def _plain(df: DataFrame, as_text: Sequence[str]) -> DataFrame:
    """Dates and integers that can be missing compare as text: client libraries disagree on
    how they show them."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("string").alias(f.name)
        if f.dataType.typeName() == "date" or f.name in as_text else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(sql: str, name: str | None = None, as_text: Sequence[str] = ()):
    """Register a function of the tables under ``name`` (its own if not given); the columns
    ``as_text`` are shown as text on both sides."""
    if as_text:
        shown = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in as_text)
        sql = f"SELECT * REPLACE ({shown}) FROM ({sql})"

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: _plain(fn(Tables(spark, sf_dir)), as_text)
        ORACLE[key] = sql
        return fn

    return register


def with_tables(parts: list[str], final: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + final
