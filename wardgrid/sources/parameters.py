"""Fitted parameters kept as tables, so that a later build scales as an earlier one did."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.sources import sinks

SUMMARY = "fit.json"


def save_fit(spark: SparkSession, tables: Mapping[str, DataFrame], path: str, notes: Mapping | None = None) -> None:
    """Each table of parameters as Parquet under its name, and a summary of names, columns and notes."""
    for name, table in tables.items():
        sinks.replace(table, f"{path.rstrip('/')}/{name}")
    sinks.write_json(spark, {"tables": {n: dict(t.dtypes) for n, t in tables.items()}, "notes": dict(notes or {})}, f"{path.rstrip('/')}/{SUMMARY}")


def load_fit(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that save_fit wrote; one whose columns aren't those of the summary is an error."""
    text = spark.read.text(f"{path.rstrip('/')}/{SUMMARY}", wholetext=True).first()[0]
    out = {}
    for name, columns in json.loads(text)["tables"].items():
        table = spark.read.parquet(f"{path.rstrip('/')}/{name}")
        if dict(table.dtypes) != columns:
            raise ValueError(f"{path}/{name} holds {dict(table.dtypes)}, not {columns}")
        out[name] = table
    return out


def drawn_from_knots(knots: DataFrame, key: str, many: int, out: str = "value") -> DataFrame:
    """(key, out): `many` values a key, evenly spaced along the inverse of an earlier fit's rank transform, so
    that it may be pooled with values at hand. A key without knots gives none."""
    last = F.size("knots") - 1
    at = F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda i: (i + F.lit(0.5)) / F.lit(float(many)) * last)
    low = lambda x: F.get("knots", F.floor(x).cast("int"))
    high = lambda x: F.get("knots", F.least(F.floor(x).cast("int") + 1, last))
    values = F.transform(at, lambda x: low(x) + (high(x) - low(x)) * (x - F.floor(x)))
    return knots.filter("knots is not null and size(knots) > 0").select(key, F.explode(values).alias(out))
