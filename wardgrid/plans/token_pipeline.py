"""Event timelines of stays as tokens, from raw tables to ids, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.config import TokenConfig
from wardgrid.functions.columns import UNKNOWN_TIME, known_time, phase_absolute, source_token, truncated_code
from wardgrid.functions.columns import number as value
from wardgrid.operators import anchors, events, fit, splits, tokens
from wardgrid.sources import sinks


def classified_events(numeric: DataFrame, listed: DataFrame, drugs: DataFrame, admissions: DataFrame, config: TokenConfig | None = None) -> DataFrame:
    """(admissionid, split, time, code, source, phase, excluded): every event that the tables could give.

    `excluded` says why one isn't kept, the first reason that holds: no value, unknown time, reversed
    interval, no bounds (a number whose item and unit training stays don't have), no stay, out of phase.
    Numbers become CODE//Qn by quantiles of training stays' values per item and unit; intervals give two.
    """
    config = config or TokenConfig()
    stays = anchors.stays(admissions)
    split = splits.rounded_split(stays, "admissionid", config.shares, config.seed)
    number = numeric.select("admissionid", "itemid", "unit", "measuredat", value(F.col("value")).alias("value"))
    train = number.filter("value is not null").join(split.filter(F.col("split") == list(config.shares)[0]).select("admissionid"), "admissionid", "left_semi")
    bounds = fit.fit_quantiles(train, ["itemid", "unit"], "value", config.bins)
    coded = fit.coded(number, bounds, ["itemid", "unit"], "value", "bin", config.bins, "left")
    none = F.lit(None).cast("string")
    numbers = coded.select(
        "admissionid", known_time(F.col("measuredat")).alias("time"), F.concat(source_token("NUM", F.col("itemid"), F.col("unit")), F.lit("//Q"), F.col("bin").cast("string")).alias("code"), F.lit("numericitems").alias("source"),
        F.when(F.col("value").isNull(), "no value").when(F.col("measuredat").isNull() | (F.col("measuredat") == UNKNOWN_TIME), "unknown time").when(F.col("bin").isNull(), "no bounds").alias("excluded"),
    )
    observed = listed.select("admissionid", known_time(F.col("measuredat")).alias("time"), source_token("LIST", F.col("itemid"), F.col("valueid")).alias("code"), F.lit("listitems").alias("source"))
    observed = observed.withColumn("excluded", F.when(F.col("time").isNull(), "unknown time"))
    drug = truncated_code(source_token("DRUG", F.col("itemid"), F.col("ordercategoryid")), "DRUG", config.depth)
    start, stop = known_time(F.col("start")), known_time(F.col("stop"))
    reason = F.when(start.isNull() | stop.isNull(), "unknown time").when(stop < start, "reversed interval")
    pair = F.array(*[F.struct(t.alias("time"), F.concat(drug, F.lit(end)).alias("code")) for t, end in ((start, "//START"), (stop, "//END"))])
    given = drugs.select("admissionid", F.explode(pair).alias("e"), F.lit("drugitems").alias("source"), reason.alias("excluded")).select("admissionid", "e.time", "e.code", "source", "excluded")
    context = events.facts(stays, ["admissionid"], [(F.col("admittedat"), F.lit("ADMISSION"), none), (F.col("dischargedat"), F.lit("DISCHARGE"), none)]).drop("text_value").withColumns({"source": F.lit("admissions"), "excluded": none})
    all_ = numbers.unionByName(observed).unionByName(given).unionByName(context)
    placed = all_.join(stays.select("admissionid", "admittedat", "dischargedat", F.lit(True).alias("__stay")), "admissionid", "left")
    placed = placed.withColumn("phase", phase_absolute(F.col("time"), F.col("admittedat"), F.col("dischargedat")))
    late = F.when(F.col("__stay").isNull(), "no stay").when(~F.col("phase").isin(list(config.phases)), "out of phase")
    return placed.withColumn("excluded", F.coalesce("excluded", late)).drop("admittedat", "dischargedat", "__stay").join(split, "admissionid", "left")


def build_events(numeric: DataFrame, listed: DataFrame, drugs: DataFrame, admissions: DataFrame, config: TokenConfig | None = None) -> DataFrame:
    """(admissionid, split, time, code): the events of classified_events that are kept."""
    return classified_events(numeric, listed, drugs, admissions, config).filter("excluded is null").select("admissionid", "split", "time", "code")


def event_audits(classified: DataFrame, top: int = 100, sample: int = 250) -> dict[str, DataFrame]:
    """Tables that tell what became of the events: exclusions and phases by source, rows by code (the `top`
    most frequent), lengths of timelines, and the first `sample` events in order."""
    kept = classified.filter("excluded is null")
    return {
        "exclusions": classified.groupBy("source", "excluded").agg(F.count("*").alias("n")),
        "phases": classified.groupBy("source", "phase").agg(F.count("*").alias("n")),
        "intervals": classified.filter("source = 'drugitems'").groupBy("excluded").agg((F.count("*") / 2).cast("long").alias("n")),
        "top_codes": kept.groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code").limit(top),
        "lengths": kept.groupBy("admissionid").agg(F.count("*").alias("n")),
        "sample": kept.orderBy("admissionid", "time", "code").limit(sample),
    }


def write_events(classified: DataFrame, path: str, config: TokenConfig | None = None, debug: bool = True) -> None:
    """events by split, the classified rows beside them if `debug`, each audit as CSV, and summary.json."""
    path, spark = path.rstrip("/"), classified.sparkSession
    sinks.replace(classified, f"{path}/classified", ["split"])
    written = spark.read.parquet(f"{path}/classified")
    kept = written.filter("excluded is null").select("admissionid", "split", "time", "code")
    sinks.replace(kept, f"{path}/events", ["split"])
    for name, table in event_audits(written).items():
        sinks.write_csv(table, f"{path}/audit/{name}")
    total = kept.agg(F.count("*").alias("n"), F.countDistinct("code").alias("codes"), F.countDistinct("admissionid").alias("stays")).first()
    counts = {f"{r['source']}: {r['excluded'] or 'kept'}": r["n"] for r in event_audits(written)["exclusions"].collect()}
    sinks.write_json(spark, {"events": total["n"], "codes": total["codes"], "stays": total["stays"], "counts": counts, "config": str(config or TokenConfig())}, f"{path}/summary.json")
    if not debug:
        sinks.remove(spark, f"{path}/classified")


def build_tokens(timeline: DataFrame, config: TokenConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """(tokens with ids, vocabulary). The vocabulary is that of the training timelines; other tokens are UNK."""
    config = config or TokenConfig()
    expanded = tokens.expanded(timeline, ["admissionid", "split"], "time", "code")
    vocabulary = tokens.vocabulary(expanded.filter(F.col("split") == list(config.shares)[0]))
    return tokens.numbered(expanded, vocabulary), vocabulary
