"""Tables and a Markdown file by which people review what feeds each feature; parse_manifest reads the file back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c
from wardgrid.sources import sinks


def examples(candidates: DataFrame, feature: str, count: str, order: Sequence[str], many: int = 20) -> DataFrame:
    """Each feature's `many` candidates with the highest count, with their `place` from 1; ties by order."""
    w = Window.partitionBy(feature).orderBy(F.desc(count), *[F.asc_nulls_last(o) for o in order])
    return candidates.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= many)


def review_text(features: Sequence[Mapping], found: Mapping[str, Sequence[Mapping]], item: str = "itemid") -> str:
    """Markdown: a heading a feature, its fields, the items proposed to keep, and its candidates in a table."""
    out = ["# Review", ""]
    for f in features:
        mine = list(found.get(f["tag"], ()))
        kept = ", ".join(str(m[item]) for m in mine) or "none"
        out += [f"### {f['tag']}", *[f"- {k}: {'' if v is None else v}" for k, v in f.items() if k != "tag"], f"- keep: {kept}", ""]
        if mine:
            names = list(mine[0])
            cell = lambda v: "" if v is None else str(v).replace("|", "/").replace("\n", " ")
            out += ["| " + " | ".join(names) + " |", "|" + "-|" * len(names), *["| " + " | ".join(cell(m[n]) for n in names) + " |" for m in mine], ""]
    return "\n".join(out)


def write_review(spark: SparkSession, features: Sequence[Mapping], candidates: DataFrame, path: str, feature: str = "tag", count: str = "n", order: Sequence[str] = ("itemid",), many: int = 20) -> None:
    """manifest and candidates as CSV folders and review.md. Features are a catalogue's; of each, `many`
    candidates at most reach the driver."""
    path = path.rstrip("/")
    best = examples(candidates, feature, count, order, many)
    sinks.write_csv(best, f"{path}/candidates")
    sinks.write_csv(spark.createDataFrame([{k: None if v is None else str(v) for k, v in f.items()} for f in features], ", ".join(f"`{k}` string" for k in features[0])), f"{path}/manifest")
    found: dict[str, list] = {}
    for r in best.filter(c(feature).isin([f["tag"] for f in features])).orderBy(feature, "place").collect():
        found.setdefault(r[feature], []).append({k: v for k, v in r.asDict().items() if k not in (feature, "place")})
    sinks.write_text(spark, review_text(features, found), f"{path}/review.md")
