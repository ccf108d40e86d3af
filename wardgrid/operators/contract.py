"""What a finished vocabulary must keep to. All broken rules are counted; none hides another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import c, truthy
from wardgrid.operators import events


def contract(
    source: DataFrame, final: DataFrame, key: str, emit: str, target: str, role: str, identity: Sequence[str] = (), concepts: DataFrame | None = None, concept: str | None = None,
    never: Column | None = None, legacy: Sequence[str] = (), roles: Mapping[str, str] | None = None, always: Column | None = None,
) -> DataFrame:
    """(rule, n): rows that break each rule.

    lost and added: tokens of the source that the vocabulary lacks, and the other way; repeated: keys that
    occur again; empty: no key; changed <column>: identity columns that differ from the source's; emitted
    rows without a target or a role, with concept 0, in a legacy namespace, of a kind that is `never`
    emitted, or with a concept that `concepts` (a column of that name) doesn't have; roles: prefix -> the
    role that emitted tokens of the prefix have and no others; withheld: rows that `always` says are emitted
    and aren't. Null and empty texts are alike; null conditions don't hold.
    """
    text = lambda name: F.coalesce(F.trim(c(name).cast("string")), F.lit(""))
    emitted = truthy(c(emit))
    rules = {"empty token": text(key) == "", "emitted without target": emitted & (text(target) == ""), "emitted without role": emitted & (text(role) == "")}
    if legacy:
        rules["emitted in a legacy namespace"] = emitted & reduce(lambda a, b: a | b, [text(target).startswith(p) for p in legacy])
    if never is not None:
        rules["emitted of a kind that never is"] = emitted & never
    for prefix, name in (roles or {}).items():
        rules[f"{prefix} without {name}"] = emitted & text(key).startswith(prefix) & (text(role) != name)
        rules[f"{name} without {prefix}"] = (text(role) == name) & ~text(key).startswith(prefix)
    if always is not None:
        rules["withheld"] = always & ~emitted
    rows = final
    if concept is not None:
        number = F.regexp_replace(text(concept), r"\.0$", "")
        rules["emitted with concept 0"] = emitted & (number == "0")
        if concepts is not None:
            known = concepts.select(F.regexp_replace(c(concept).cast("string"), r"\.0$", "").alias("__k")).distinct().withColumn("__known", F.lit(True))
            rows = rows.withColumn("__k", number).join(known, "__k", "left")
            rules["emitted with an unknown concept"] = emitted & number.rlike(r"^\d+$") & F.col("__known").isNull()
    found = events.violations(rows, rules)

    # Against the source: one full join of the keys' counts and identities.
    mine = final.groupBy(c(key)).agg(F.count("*").alias("__f"), *[F.min(text(i)).alias(f"__f_{i}") for i in identity])
    theirs = source.groupBy(c(key)).agg(F.count("*").alias("__s"), *[F.min(text(i)).alias(f"__s_{i}") for i in identity])
    both = mine.join(theirs, key, "full_outer")
    against = {"lost": F.col("__f").isNull(), "added": F.col("__s").isNull()} | {f"changed {i}": F.col(f"__f_{i}") != F.col(f"__s_{i}") for i in identity}
    repeated = mine.agg(F.coalesce(F.sum(F.col("__f") - 1), F.lit(0)).alias("n")).select(F.lit("repeated token").alias("rule"), "n")
    return found.unionByName(events.violations(both, against)).unionByName(repeated)
