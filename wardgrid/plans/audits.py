"""Audits of finished datasets: every rule with the number of rows that break it, never stopping at the first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c
from wardgrid.operators import audits, events


class AuditFailed(ValueError):
    """A dataset breaks rules; the message names all."""


def _counted(parts: dict[str, DataFrame]) -> DataFrame:
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n") for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def audit_grid(grid: DataFrame, features: Sequence[str], one_hots: Sequence[Sequence[str]] = (), key: str = "admissionid", hour: str = "hour", split: str = "split") -> DataFrame:
    """(rule, n) of a grid: repeated keys, stays in several splits, holes in hours, masks that aren't 0 or 1,
    one-hots that aren't exclusive, features that aren't finite."""
    rules = {"no split": c(split).isNull()}
    for f in features:
        rules[f"{f} not finite"] = c(f).isNotNull() & (F.isnan(f) | (F.abs(c(f)) == F.lit(float("inf"))))
        if f"{f}__observed" in grid.columns:
            rules[f"{f} mask"] = F.coalesce(~c(f"{f}__observed").isin(0, 1), F.lit(True))
    for group in one_hots:
        rules[f"{group[0]} ... not exclusive"] = sum((F.coalesce(c(x), F.lit(0)) for x in group), F.lit(0)) != 1
    tables = {"repeated keys": audits.duplicate_keys(grid, [key, hour]), "several splits": audits.leaking(grid, key, split), "holes in hours": audits.gaps_in_hours(grid, key, hour)}
    return events.violations(grid, rules).unionByName(_counted(tables))


def audit_tokens(tokens: DataFrame, n_vocabulary: int, group: Sequence[str] = ("admissionid",), end: str = "TIMELINE_END") -> DataFrame:
    """(rule, n) of token timelines: ids out of range, places that aren't 0, 1, ..., times that go back,
    quantiles that don't follow a code, ends that are missing or not last."""
    w = Window.partitionBy(*group).orderBy("seq")
    rows = tokens.withColumns({"__before": F.lag("token").over(w), "__t": F.lag("time").over(w), "__next": F.lead("token").over(w), "__n": F.row_number().over(w) - 1})
    quantile = F.col("token").rlike(r"^Q([1-9]|10)$")
    rules = {
        "id out of range": F.col("id").isNull() | (F.col("id") < 0) | (F.col("id") >= n_vocabulary), "place": F.col("seq") != F.col("__n"), "time goes back": F.col("time") < F.col("__t"),
        "quantile without code": quantile & (F.col("__before").isNull() | F.col("__before").rlike(r"^Q([1-9]|10)$")), "end not last": (F.col("token") == end) & F.col("__next").isNotNull(), "no end": F.col("__next").isNull() & (F.col("token") != end),
    }
    return events.violations(rows, rules)


def audit_preserved(before: DataFrame, after: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Groups whose rows changed: keys, counts before and after, and whether the contents differ."""
    a = audits.fingerprint(before, columns, keys).withColumnsRenamed({"n_rows": "n_before", "h0": "__a0", "h1": "__a1"})
    b = audits.fingerprint(after, columns, keys).withColumnsRenamed({"n_rows": "n_after", "h0": "__b0", "h1": "__b1"})
    same = (F.col("n_before") == F.col("n_after")) & (F.col("__a0") == F.col("__b0")) & (F.col("__a1") == F.col("__b1"))
    return a.join(b, list(keys), "full_outer").filter(~F.coalesce(same, F.lit(False))).select(*keys, "n_before", "n_after")


def check(audit: DataFrame) -> None:
    """Raises AuditFailed with every broken rule."""
    bad = audit.filter("n > 0").orderBy("rule").collect()
    if bad:
        raise AuditFailed("; ".join(f"{r['rule']}: {r['n']}" for r in bad))
