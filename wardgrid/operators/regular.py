"""Irregular readings onto a regular grid: one row per series and step, missing steps filled.

Readings are averaged per step before anything is shuffled by series. Each series is fitted by
harmonics of the day and a trend, from normal equations summed by an ordinary aggregation; a missing
step gets the prediction plus the residual bridged linearly between the observed steps on its sides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_MS = 3_600_000


def _basis(step: Column, per_day: float, harmonics: int) -> list[Column]:
    angle = step * F.lit(2 * math.pi / per_day)
    waves = [f(angle * F.lit(float(j))) for j in range(1, harmonics + 1) for f in (F.cos, F.sin)]
    return [F.lit(1.0), step / F.lit(100.0), *waves]


def _solve(batches: Iterator[pd.DataFrame], p: int, ridge: float) -> Iterator[pd.DataFrame]:
    """Solves the normal equations of many series at once; a small ridge keeps short series at their mean."""
    at = np.triu_indices(p)
    for pdf in batches:
        if pdf.empty:
            continue
        sums = np.stack(pdf["s"].to_numpy()).astype(float)
        m = np.zeros((len(pdf), p, p))
        m[:, at[0], at[1]] = sums[:, : len(at[0])]
        m = m + np.transpose(np.triu(m, 1), (0, 2, 1))
        m[:, np.arange(1, p), np.arange(1, p)] += ridge
        y = sums[:, len(at[0]) :]
        bad = ~np.isfinite(sums).all(axis=1)
        m[bad], y[bad] = np.eye(p), 0.0
        coef = np.linalg.solve(m, y[:, :, None])[:, :, 0]
        coef[bad] = np.nan
        out = pdf.drop(columns="s")
        out["coef"] = list(coef)
        yield out


def regular_grid(
    df: DataFrame, stays: DataFrame, entity: str, series: Sequence[str], offset: str, value: str, length: str, step: int = HOUR_MS, day: int = 24 * HOUR_MS, harmonics: int = 2, ridge: float = 1.0,
    out: tuple[str, str, str, str] = ("hournr", "value", "n_readings", "status"), counted: str | None = None,
) -> DataFrame:
    """Rows (entity, *series, step number, value, n_readings, status) for every step of each series.

    df has entity, series, offset (whole units since the entity's beginning) and value; stays has
    entity and length, how long it lasts. An entity has the steps 0, 1, ... that begin before its
    length; each series with a reading in them gets all of them. status is `observed` (value: the mean
    of the step's readings), `filled` (value: harmonic regression with trend, plus bridged residual)
    or `marked` (missing and not to be predicted, as from infinite values).

    `counted` is the column whose numbers make a row a reading, if it isn't `value`: a step whose readings
    have no value is observed with a null value, and doesn't weigh in filling.

    Readings with a null or NaN value, a null offset or key, or an offset outside the steps don't
    count. Entities that stays lacks, or whose length is null or not above 0, give no row; of several
    lengths the largest holds. Repeated rows weigh in the mean only. Other columns are ignored,
    whatever their names. Empty tables give no row.
    """
    c = lambda name: F.col(f"`{name}`")
    names = [f"__k{i}" for i in range(len(series))]
    keys = ["__id", *names]
    rows = df.select(c(entity).alias("__id"), *[c(s).alias(n) for s, n in zip(series, names)], F.floor(c(offset) / F.lit(step)).cast("long").alias("__h"), c(value).cast("double").alias("__v"), c(counted or value).cast("double").alias("__c"))
    rows = rows.filter(" and ".join([f"{k} is not null" for k in keys] + ["__h >= 0", "__c is not null", "not isnan(__c)"]))
    rows = rows.withColumn("__v", F.when(~F.isnan("__v"), F.col("__v")))
    hourly = rows.groupBy(*keys, "__h").agg(F.avg("__v").alias("__v"), F.count("*").alias("__n"))
    lasting = stays.groupBy(c(entity).alias("__id")).agg(F.ceil(F.max(c(length)) / F.lit(step)).cast("long").alias("__len")).filter("__id is not null and __len > 0")
    hourly = hourly.join(lasting, "__id").filter("__h < __len").repartition(*keys)

    terms = 2 + 2 * harmonics
    basis = _basis(F.col("__h").cast("double"), day / step, harmonics)
    products = [F.sum(basis[i] * basis[j]) for i in range(terms) for j in range(i, terms)] + [F.sum(b * F.col("__v")) for b in basis]
    normal = hourly.filter("__v is not null").groupBy(*keys).agg(F.array(*products).alias("s"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in normal.schema.fields if f.name != "s") + ", coef array<double>"
    fitted = normal.mapInPandas(lambda it: _solve(it, terms, ridge), schema).repartition(*keys)

    def predict(at: Column) -> Column:
        parts = _basis(at.cast("double"), day / step, harmonics)
        return sum((F.col("coef")[i] * b for i, b in enumerate(parts[1:], 1)), F.col("coef")[0])

    w = Window.partitionBy(*keys).orderBy("__h")
    seen = hourly.join(fitted, keys, "left").withColumn("__r", F.col("__v") - predict(F.col("__h")))
    # Residuals are bridged between steps with a value, the last up to a step and the next after it.
    seen = seen.withColumn("__hr", F.when(F.col("__r").isNotNull(), F.struct(F.col("__h").alias("h"), F.col("__r").alias("r"))))
    following = F.expr(f"lead(__hr) ignore nulls over (partition by {', '.join(keys)} order by __h)")
    seen = seen.withColumns({"__nh": F.lead("__h").over(w), "__p": F.last("__hr", ignorenulls=True).over(w), "__q": following, "__first": F.row_number().over(w) == 1})
    # From each observed step: itself, the missing ones after it, and before the first the leading ones.
    after = F.coalesce("__nh", "__len") - 1
    steps = F.sequence(F.when(F.col("__first"), F.lit(0).cast("long")).otherwise(F.col("__h")), after)
    grid = seen.withColumn("__at", F.explode(steps))
    p, q = F.col("__p"), F.col("__q")
    share = (F.col("__at") - p["h"]) / (q["h"] - p["h"])
    bridge = F.when((F.col("__at") < F.col("__h")) | q.isNull() | p.isNull(), F.coalesce(p["r"], q["r"])).otherwise(p["r"] + share * (q["r"] - p["r"]))
    observed = F.col("__at") == F.col("__h")
    fill = predict(F.col("__at")) + bridge
    usable = fill.isNotNull() & ~F.isnan(fill)
    return grid.select(
        F.col("__id").alias(entity), *[F.col(n).alias(s) for n, s in zip(names, series)], F.col("__at").alias(out[0]),
        F.when(observed, F.col("__v")).when(usable, fill).alias(out[1]),
        F.when(observed, F.col("__n")).otherwise(F.lit(0)).cast("long").alias(out[2]),
        F.when(observed, "observed").when(usable, "filled").otherwise("marked").alias(out[3]),
    )
