"""Several cohorts as one: names, schemas, vocabularies and tables brought together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import c


def namespaced(df: DataFrame, cohort: str, ids: Sequence[str]) -> DataFrame:
    """ids as cohort_id texts, the native ones beside them, and the cohort's name."""
    native = {f"native_{i}": c(i) for i in ids}
    return df.withColumns(native).withColumns({i: F.when(F.col(f"native_{i}").isNotNull(), F.concat_ws("_", F.lit(cohort), F.col(f"native_{i}").cast("string"))) for i in ids}).withColumn("cohort", F.lit(cohort))


def stacked(parts: Mapping[str, DataFrame], ids: Sequence[str]) -> DataFrame:
    """All cohorts' rows, ids namespaced, columns that a cohort lacks empty."""
    out = None
    for name, part in parts.items():
        one = namespaced(part, name, ids)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def united_registry(registries: Mapping[str, Mapping[str, tuple]]) -> dict[str, tuple]:
    """All cohorts' features; one that two cohorts define differently is an error that names all such."""
    out: dict[str, tuple] = {}
    bad = []
    for cohort, features in registries.items():
        for name, definition in features.items():
            if name in out and out[name] != definition:
                bad.append(f"{name}: {out[name]} and {definition} ({cohort})")
            out.setdefault(name, definition)
    if bad:
        raise ValueError("features defined differently: " + "; ".join(bad))
    return out


def united_categories(vocabularies: Mapping[str, Mapping[str, Sequence[str]]]) -> dict[str, list[str]]:
    """Each feature's categories over all cohorts, sorted."""
    names = {f for v in vocabularies.values() for f in v}
    return {f: sorted({x for v in vocabularies.values() for x in v.get(f, ())}) for f in sorted(names)}


def padded(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """df with exactly these columns and types, in this order; those it lacks are null."""
    return df.select(*[(c(n).try_cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n) for n, t in columns.items()])
