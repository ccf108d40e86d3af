"""What a reader of a grid must know about its columns: schema, categories and targets, as small files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from wardgrid.functions.columns import sanitized
from wardgrid.sources import sinks


def feature_schema(columns: Sequence[str], features: Mapping[str, Mapping[str, str | None]], categories: Mapping[str, Sequence[str]] | None = None) -> dict[str, dict]:
    """Each feature's kind and unit, its physical columns, and its mask if the grid has one. A categorical
    feature's columns are its one-hots. A feature without any column in the grid is left out."""
    out = {}
    for name, about in features.items():
        mine = [name] if name in columns else []
        mine += [r["column"] for r in categorical_encoding({name: (categories or {}).get(name, ())}) if r["column"] in columns]
        if mine:
            mask = {"mask": f"{name}__observed"} if f"{name}__observed" in columns else {}
            out[name] = {**about, "columns": mine, **mask}
    return out


def categorical_encoding(categories: Mapping[str, Sequence[str]], missing: str = "missing") -> list[dict[str, str | None]]:
    """(feature, category, column) of every one-hot column; the one for what is missing has no category."""
    return [{"feature": f, "category": v, "column": f"{f}_{sanitized(v) if v is not None else missing}"} for f, values in categories.items() if values for v in (*values, None)]


def targets(wanted: Sequence[str], schema: Mapping[str, Mapping]) -> dict[str, list[str]]:
    """Which of the wanted targets the grid has, in their order, and which it lacks."""
    return {"targets": [t for t in wanted if t in schema], "missing": [t for t in wanted if t not in schema]}


def write_sidecars(spark: SparkSession, path: str, columns: Sequence[str], features: Mapping[str, Mapping], categories: Mapping[str, Sequence[str]], wanted: Sequence[str] = ()) -> None:
    """feature_schema.json, targets.json and categorical_encoding (CSV)."""
    path, schema = path.rstrip("/"), feature_schema(columns, features, categories)
    sinks.write_json(spark, schema, f"{path}/feature_schema.json")
    sinks.write_json(spark, targets(wanted, schema), f"{path}/targets.json")
    sinks.write_csv(spark.createDataFrame(categorical_encoding(categories), "feature string, category string, column string"), f"{path}/categorical_encoding")
