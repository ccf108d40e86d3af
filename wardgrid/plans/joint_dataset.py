"""Several cohorts' finished grids as one dataset: named apart, brought to one schema, sharded anew, with
their side tables and fitted parameters beside them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import c
from wardgrid.operators import audits, joint, splits
from wardgrid.sources import parameters, sinks


class CohortsDontFit(ValueError):
    """Cohorts can't be one dataset; the message names every reason."""


def joint_grid(cohorts: Mapping[str, DataFrame], key: str, split: str = "split", fill: Mapping[str, float] | None = None) -> DataFrame:
    """All cohorts' rows with ids as cohort_id, native ids and the cohort's name beside them.

    Columns that a cohort lacks are `fill`, else null. A column of different types in two cohorts is an
    error; so is a cohort whose split is null anywhere. Column order is that of the first cohort, then
    what others add.
    """
    kinds: dict[str, dict[str, str]] = {}
    for name, df in cohorts.items():
        for column, kind in df.dtypes:
            kinds.setdefault(column, {})[name] = kind
    bad = [f"{column} is " + ", ".join(f"{k} in {n}" for n, k in by.items()) for column, by in kinds.items() if len(set(by.values())) > 1]
    bad += [f"{name} lacks {needed}" for name, df in cohorts.items() for needed in (key, split) if needed not in df.columns]
    if bad:
        raise CohortsDontFit("; ".join(bad))
    fill = dict(fill or {})
    parts = {}
    for name, df in cohorts.items():
        lacking = {column: F.lit(fill.get(column)).cast(next(iter(by.values()))) for column, by in kinds.items() if name not in by}
        known = F.when(c(split).isNull(), F.raise_error(F.lit(f"a row of {name} has no split"))).otherwise(c(split))
        parts[name] = df.withColumns(lacking).withColumn(split, known).select(*kinds)
    return joint.stacked(parts, [key])


def joint_shards(grid: DataFrame, key: str, per_shard: int, split: str = "split") -> DataFrame:
    """(key, split, shard) of the joint dataset; a key in several splits or cohorts is an error that names some."""
    units = grid.select(key, split, "cohort").distinct()
    torn = units.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").limit(5).collect()
    if torn:
        raise CohortsDontFit("in several splits or cohorts: " + ", ".join(str(r[key]) for r in torn))
    return splits.sharded(units.drop("cohort"), key, per_shard, split)


def write_joint(cohorts: Mapping[str, DataFrame], path: str, key: str, hour: str, per_shard: int = 1000, fits: Mapping[str, Mapping[str, DataFrame]] | None = None, sides: Mapping[str, Mapping[str, DataFrame]] | None = None, split: str = "split", fill: Mapping[str, float] | None = None) -> None:
    """Writes data (by split and shard), index, each cohort's fitted parameters, and side tables stacked.

    fits: cohort -> its tables of parameters; sides: name -> cohort -> table with the key. A joint audit is
    kept beside them: rows, keys and shards by cohort and split.
    """
    path = path.rstrip("/")
    grid = joint_grid(cohorts, key, split, fill)
    shards = joint_shards(grid, key, per_shard, split)
    spark = grid.sparkSession
    sinks.write_shards(grid.join(shards.drop(split), key), f"{path}/data", split, order=[key, hour])
    written = spark.read.parquet(f"{path}/data")
    sinks.replace(shards, f"{path}/index")
    for cohort, tables in (fits or {}).items():
        parameters.save_fit(spark, tables, f"{path}/fit/{cohort}", {"cohort": cohort})
    for name, parts in (sides or {}).items():
        sinks.replace(joint.stacked(parts, [key]), f"{path}/{name}")
    sinks.write_csv(joint_audit(written, key, split), f"{path}/audit")


def joint_audit(grid: DataFrame, key: str, split: str = "split") -> DataFrame:
    """(cohort, split, n_rows, n_keys, n_shards)."""
    return grid.groupBy("cohort", split).agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys"), F.countDistinct("shard").alias("n_shards"))


def shared_keys(cohorts: Sequence[DataFrame], key: str) -> DataFrame:
    """Native keys that several cohorts have, which only their names keep apart."""
    return audits.collisions(cohorts, key)
