"""Queries of the language-model problems over the dataset's tables, and their SQL."""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm.leakage import LeakRules, find_leaks
from wardgrid.llm.packing import count_tokens, pack
from wardgrid.llm.sketch import ERROR, combine, percentiles, sketch
from wardgrid.llm.spam import find_spam
from wardgrid.llm.splits import disagreeing, linked_records, stratified_splits
from wardgrid.sources.tables import table

DAY_MS = 86_400_000
AT = {"p01": 0.01, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
TOKENIZER = os.environ.get("WARDGRID_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
# Spellings of the splits.
SPLITS = {"train": ("training",), "val": ("valid", "validation"), "test": ("held-out",)}
SHARES = {"train": 0.7, "val": 0.15, "test": 0.15}
LINKS = ["subject_id", "patientid", "admissionid"]


def _daily(spark: SparkSession, d: str) -> DataFrame:
    day = F.when(F.col("registeredat") != -1899, F.floor(F.col("registeredat") / F.lit(DAY_MS))).cast("long").alias("day")
    return sketch(table(spark, d, "numericitems"), ["itemid", day], "value")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({k: F.round(k, 6) for k in AT})


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of each item, by day of registration and (day -1) over all days, the latter from the days' sketches."""
    days = _daily(spark, d).withColumn("day", F.coalesce("day", F.lit(-2).cast("long")))
    both = days.unionByName(combine(days, ["itemid"]).withColumn("day", F.lit(-1).cast("long")))
    return _rounded(percentiles(both, ["itemid", "day"], AT))


def p2_by_item(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of each item."""
    return _rounded(percentiles(combine(_daily(spark, d), ["itemid"]), ["itemid"], AT))


def p2_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of each day of registration, over all items."""
    return _rounded(percentiles(combine(_daily(spark, d), ["day"]), ["day"], AT))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Subjects of persons whose stays carry more than one split."""
    return disagreeing(table(spark, d, "admissions"), LINKS, "split", SPLITS).select("subject_id").filter("subject_id is not null").distinct()


def p4_splits(spark: SparkSession, d: str) -> DataFrame:
    """A split for each stay, a person's stays together, with sex, age, urgency and origin in proportion."""
    rows = table(spark, d, "admissions")
    linked = linked_records(rows, LINKS).filter("admissionid is not null").groupBy("admissionid").agg(F.min("__component").alias("person"))
    stays = rows.groupBy("admissionid").agg(*[F.max(c).alias(c) for c in ("gender", "agegroup", "urgency", "origin")]).join(linked, "admissionid")
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    labels = {
        "female": F.col("gender") == "Vrouw", "male": F.col("gender") == "Man", "urgent": F.col("urgency") == 1, "planned": F.col("urgency") == 0,
        **{f"age{i}": F.col("agegroup") == a for i, a in enumerate(("18-39", "40-49", "50-59", "60-69", "70-79", "80+"))},
        "emergency": F.col("origin").startswith("Spoed"), "theatre": F.col("origin").startswith("Operatie"), "ward": F.col("origin").startswith("Verpleeg"),
    }
    persons = stays.groupBy("person").agg(F.count("*").alias("size"), *[count(cond).alias(k) for k, cond in labels.items()])
    placed = stratified_splits(persons, "person", "size", list(labels), SHARES)
    return stays.select("admissionid", "person").join(placed, "person").select("admissionid", "person", "split")


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """Every text in sequences of 2,048 tokens."""
    tokens = count_tokens(table(spark, d, "documents"), "doc_id", "text", TOKENIZER)
    return pack(tokens, "doc_id", "n_tokens", 2048).select("doc_id", "piece", F.col("first").alias("first_token"), F.col("size").alias("n_tokens"), F.col("bin").alias("sequence"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the test items that leaked into them."""
    rules = LeakRules()
    found = find_leaks(table(spark, d, "documents"), table(spark, d, "evalitems"), rules=rules)
    return found.filter(F.col("ordered_words") >= rules.words).select("doc_id", "item_id")


def p9_reordered(spark: SparkSession, d: str) -> DataFrame:
    """Documents and test items of which they hold enough words in tiles, but not in order."""
    rules = LeakRules()
    return find_leaks(table(spark, d, "documents"), table(spark, d, "evalitems"), rules=rules).filter(F.col("ordered_words") < rules.words).select("doc_id", "item_id", "covered_words")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are spam of keywords, links or tags."""
    return find_spam(table(spark, d, "documents")).select("doc_id")


QUERIES = {f.__name__: f for f in (p2_percentiles, p2_by_item, p2_by_day, p4_found, p4_splits, p8_packed, p9_found, p9_reordered, p10_found)}

_GAMMA = (1 + ERROR) / (1 - ERROR)
_SKETCH = f"""v as (select itemid, case when registeredat <> -1899 then cast(floor(registeredat / {DAY_MS}.0) as bigint) end as day, value from numericitems where value is not null and not isnan(value)),
b as (select itemid, day, case when value = 0 then 0 else sign(value) * (ceil(ln(abs(value)) / {math.log(_GAMMA)!r}) + 4000000) end as k from v)"""


def _picked(groups: str, source: str) -> str:
    """SQL of the percentiles of the values' buckets by group."""
    size = f"pow({_GAMMA!r}, abs({{p}}) - 4000001) * {2 * _GAMMA / (_GAMMA + 1)!r}"
    cols = []
    for name, q in AT.items():
        k = f"list_extract(ks, cast(floor({q} * (n - 1)) as bigint) + 1)"
        cols.append(f"round(case when {k} = 0 then 0 else sign({k}) * {size.format(p=k)} end, 6) as {name}")
    return f"select {groups}, n, {', '.join(cols)} from (select {groups}, count(*) as n, list(k order by k) as ks from {source} group by {groups})"


ORACLES = {
    "p2_percentiles": f"with {_SKETCH}, a as (select itemid, coalesce(day, -2) as day, k from b union all select itemid, cast(-1 as bigint), k from b) {_picked('itemid, day', 'a')}",
    "p2_by_item": f"with {_SKETCH} {_picked('itemid', 'b')}",
    "p2_by_day": f"with {_SKETCH} {_picked('day', 'b')}",
    "p4_found": """with recursive a as (select distinct subject_id s, patientid p, admissionid d from admissions),
n as (select distinct 's' || s as x, 'd' || d as y from a where s is not null union select distinct 'p' || p, 'd' || d from a where p is not null),
e as (select x, y from n union select y, x from n),
r as (select distinct x as root, x as node from e union select r.root, e.y from r join e on e.x = r.node),
m as (select 'd' || admissionid as d, case lower(trim(split)) when 'training' then 'train' when 'valid' then 'val' when 'validation' then 'val' when 'held-out' then 'test' else lower(trim(split)) end as split from admissions),
g as (select r.root from r join m on m.d = r.node and m.split in ('train', 'val', 'test') group by r.root having count(distinct m.split) > 1)
select distinct subject_id from admissions join g on g.root = 's' || subject_id""",
}
