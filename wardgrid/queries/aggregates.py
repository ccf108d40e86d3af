"""Aggregates, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardgrid.config import CATALOGUE
from wardgrid.functions import columns as x
from wardgrid.operators import audits, cohort, events, fit, grid, quality
from wardgrid.operators.quantiles import percentiles
from wardgrid.queries.registry import query
from wardgrid.queries.scans import NUMBERS, STAYS, numbers, stays, training
from wardgrid.sources.tables import table

HOUR = "cast(floor(admission_relative_ms / 3600000.0) as bigint)"


@query(f"with {NUMBERS} select admissionid, itemid, {HOUR} as hour, median(value) as value from numbers where admission_relative_ms >= 0 group by all")
def op_81_median_per_hour(s, d):
    return grid.hourly(numbers(s, d), ["admissionid", "itemid"], "admission_relative_ms", {"value": F.median("value")})


@query("""with e as (select l.admissionid, itemid, cast(floor((l.measuredat - s.admittedat) / 3600000.0 / 24) as bigint) as hour, value from listitems l join (select admissionid, max(admittedat) admittedat from admissions group by 1) s using (admissionid) where measuredat <> -1899 and measuredat >= s.admittedat and value is not null),
k as (select admissionid, itemid, hour, value, count(*) c from e group by all) select admissionid, itemid, hour, (list(value order by c desc, value))[1] as label from k group by all""")
def op_82_mode_with_ties(s, d):
    e = table(s, d, "listitems").join(stays(s, d), "admissionid").filter("measuredat <> -1899").withColumn("ms", F.col("measuredat") - F.col("admittedat")).filter("value is not null")
    return grid.hourly(e, ["admissionid", "itemid"], "ms", {"label": F.mode("value", True)}, width=24 * x.HOUR_MS)


@query(f"with {NUMBERS} select admissionid, itemid, {HOUR} as hour, round(avg(value), 6) as value, count(*) as n from numbers where admission_relative_ms >= 0 group by all")
def op_83_mean_per_hour(s, d):
    return grid.hourly(numbers(s, d), ["admissionid", "itemid"], "admission_relative_ms", {"value": F.round(F.avg("value"), 6), "n": F.count("*")})


_DRUG_MS = f"e as (select g.admissionid, g.itemid, g.rate, g.start - s.admittedat a, g.stop - s.admittedat b, s.dischargedat - s.admittedat z from drugitems g join stays s using (admissionid) where start <> -1899 and stop <> -1899)"


def _drug_ms(s, d):
    g = table(s, d, "drugitems").filter("start <> -1899 and stop <> -1899").join(stays(s, d), "admissionid")
    return g.select("admissionid", "itemid", "rate", (F.col("start") - F.col("admittedat")).alias("a"), (F.col("stop") - F.col("admittedat")).alias("b"), (F.col("dischargedat") - F.col("admittedat")).alias("z"))


_HOURS = """h as (select *, greatest(a, 0) a0, {end} b0 from e where b >= 0),
r as (select *, cast(floor(a0 / 3600000.0) as bigint) f, case when b0 <= a0 then cast(floor(a0 / 3600000.0) as bigint) else cast(ceil(b0 / 3600000.0) as bigint) - 1 end l from h)"""


@query(f"with {STAYS}, {_DRUG_MS}, {_HOURS.format(end='b')} select distinct admissionid, itemid, unnest(range(f, greatest(f, l) + 1)) as hour from r")
def op_84_hours_on_treatment(s, d):
    return grid.covered_hours(_drug_ms(s, d), ["admissionid", "itemid"], "a", "b").distinct()


@query(f"with {STAYS}, {_DRUG_MS}, {_HOURS.format(end='b')}, u as (select admissionid, itemid, unnest(range(f, greatest(f, l) + 1)) as hour from r) select admissionid, itemid, hour, count(*) as n from u group by all")
def op_100_interval_hours(s, d):
    return grid.covered_hours(_drug_ms(s, d), ["admissionid", "itemid"], "a", "b").groupBy("admissionid", "itemid", "hour").agg(F.count("*").alias("n"))


@query(f"""with {STAYS}, {_DRUG_MS}, r as (select *, greatest(cast(floor(a / 3600000.0) as bigint), 0) f, cast(ceil(b / 3600000.0) as bigint) - 1 l from e where b >= 0),
u as (select admissionid, itemid, rate, unnest(range(f, greatest(f, l) + 1)) as hour from r) select admissionid, itemid, hour, round(avg(rate), 6) as mean from u group by all""")
def op_101_interval_mean_rate(s, d):
    return grid.covered_hours_mean(_drug_ms(s, d), ["admissionid", "itemid"], "a", "b", "rate").withColumn("mean", F.round("mean", 6))


@query(f"""with {STAYS}, {_DRUG_MS}, {_HOURS.format(end='b')} select distinct admissionid, itemid, unnest(range(f, (case when itemid = 51001 then f else greatest(f, l) end) + 1)) as hour from r""")
def op_102_points_and_intervals(s, d):
    return grid.covered_hours(_drug_ms(s, d), ["admissionid", "itemid"], "a", "b", point=F.col("itemid") == 51001).distinct()


@query(f"with {STAYS}, {_DRUG_MS}, {_HOURS.format(end='least(b, z)')} select distinct admissionid, itemid, unnest(range(f, greatest(f, l) + 1)) as hour from r")
def op_103_hours_within_stay(s, d):
    return grid.covered_hours(_drug_ms(s, d), ["admissionid", "itemid"], "a", "b", clip="z").distinct()


@query("""with e as (select admissionid, itemid, value, cast(floor(admission_relative_ms / 3600000.0) as bigint) w, admission_relative_ms ms, unit from numericitems where admission_relative_ms is not null and value is not null and not isnan(value))
select admissionid, itemid, (w + 1) * 3600000 as admission_relative_ms, round(avg(value), 6) as value, count(*) as raw_rows_in_bin, (list(unit order by ms, unit) filter (unit is not null))[1] as unit, 'causal_mean' as binning_method from e group by admissionid, itemid, w""")
def op_85_causal_means(s, d):
    return grid.causal_means(numbers(s, d), ["admissionid", "itemid"], "admission_relative_ms", "value", first=["unit"]).withColumn("value", F.round("value", 6))


_FREQ = "f as (select admissionid, itemid, 1.0 / avg(g) as frequency from (select admissionid, itemid, t - lag(t) over (partition by admissionid, itemid order by t) g from (select admissionid, itemid, admission_relative_ms t from numericitems where admission_relative_ms is not null)) where g > 0 group by all)"


@query(f"with {_FREQ} select admissionid, itemid, round(frequency * 3600000, 6) as per_hour from f")
def op_86_adjacent_frequency(s, d):
    return fit.frequencies(table(s, d, "numericitems"), ["admissionid", "itemid"], "admission_relative_ms").select("admissionid", "itemid", F.round(F.col("frequency") * 3_600_000, 6).alias("per_hour"))


@query(f"with {_FREQ}, h as (select itemid, frequency * 3600000 v from f) select itemid, count(v) as n, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as sd, round(avg(v) - 1.96 * stddev_samp(v) / sqrt(count(v)), 6) as low, round(avg(v) + 1.96 * stddev_samp(v) / sqrt(count(v)), 6) as high from h group by 1")
def op_87_normal_interval(s, d):
    f = fit.frequencies(table(s, d, "numericitems"), ["admissionid", "itemid"], "admission_relative_ms").withColumn("v", F.col("frequency") * 3_600_000)
    return fit.confidence(f, "itemid", "v", 1.96).select("itemid", "n", *[F.round(k, 6).alias(k) for k in ("mean", "sd", "low", "high")])


_TRAIN = f"{NUMBERS}, t as (select itemid, unit, value + 0.0 as value from numbers where admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training')))"
_Q = ", ".join(f"list_extract(v, ((len(v) - 1) * {2 * i} + 10) // 20 + 1) as q{i}" for i in range(1, 10))


def _train(s, d):
    return training(numbers(s, d), s, d).select("itemid", "unit", "value")


@query(f"with {_TRAIN}, l as (select itemid, unit, list(value order by value) v from t group by all) select itemid, unit, len(v) as n, {_Q} from l")
def op_88_nearest_rank_quantiles(s, d):
    return fit.fit_quantiles(_train(s, d), ["itemid", "unit"], "value")


@query("select count(*) as n_rows, count(*) filter (value is null) as n_null, count(*) filter (isnan(value)) as n_nan, count(*) filter (measuredat = -1899) as n_unknown_time, count(*) filter (admission_relative_ms < 0) as n_before from numericitems")
def op_89_row_accounting(s, d):
    return table(s, d, "numericitems").agg(F.count("*").alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_null"), F.count_if(F.isnan("value")).alias("n_nan"), F.count_if(F.col("measuredat") == -1899).alias("n_unknown_time"), F.count_if(F.col("admission_relative_ms") < 0).alias("n_before"))


_PRINT = """concat_ws('|', '0=' || coalesce(cast(numericid as varchar), '\\N'), '1=' || coalesce(cast(measuredat as varchar), '\\N'), '2=' || coalesce(unit, '\\N'))"""


@query(f"select itemid, count(*) as n_rows, cast(sum(cast(('0x' || substr(md5('0:' || {_PRINT}), 1, 12)) as bigint)) as varchar) as h0, cast(sum(cast(('0x' || substr(md5('1:' || {_PRINT}), 1, 12)) as bigint)) as varchar) as h1 from numericitems group by 1")
def op_90_fingerprint(s, d):
    return audits.fingerprint(table(s, d, "numericitems"), ["numericid", "measuredat", "unit"], ["itemid"]).withColumns({h: F.col(h).cast("string") for h in ("h0", "h1")})


@query("select 'NUM//' || itemid || '//' || coalesce(nullif(trim(unit), ''), 'NONE') as token, count(*) as n from numericitems group by 1")
def op_91a_token_counts(s, d):
    return table(s, d, "numericitems").select(x.source_token("NUM", F.col("itemid"), F.col("unit")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


@query("select min(duration) as low, min(duration) as least, (list(duration order by duration))[((count(duration) - 1) * 2 + 4) // 8 + 1] as q1, median(duration) as middle, round(avg(duration), 6) as mean, max(duration) as high, itemid from drugitems where duration is not null group by itemid")
def op_91c_duration_statistics(s, d):
    g = table(s, d, "drugitems").filter("duration is not null")
    q = fit.fit_quantiles(g.withColumn("v", F.col("duration").cast("double")), ["itemid"], "v", bins=4).select("itemid", F.col("q1").cast("long").alias("q1"))
    return g.groupBy("itemid").agg(F.min("duration").alias("low"), F.min("duration").alias("least"), F.round(F.avg("duration"), 6).alias("mean"), F.max("duration").alias("high")).join(q, "itemid").join(percentiles(g, ["itemid"], "duration", [0.5]).select("itemid", F.col("p")[0].alias("middle")), "itemid")


@query("""select subject_id, count(distinct admissionid) as n_stays, min(admittedat) as first_start, max(dischargedat) as last_stop, array_to_string(list_transform(list_sort(list(distinct {'t': coalesce(admittedat, 0), 'id': admissionid})), lambda e: cast(e.id as varchar)), ';') as stay_ids from admissions group by 1""")
def op_91d_person_rollup(s, d):
    return cohort.rollup(table(s, d, "admissions"), "subject_id", "admissionid", "admittedat", "dischargedat")


@query("select itemid, count(distinct admissionid) as n_stays, count(distinct unit) as n_units, count(distinct registeredby) as n_people from numericitems group by 1")
def op_91e_distinct_counts(s, d):
    return table(s, d, "numericitems").groupBy("itemid").agg(F.countDistinct("admissionid").alias("n_stays"), F.countDistinct("unit").alias("n_units"), F.countDistinct("registeredby").alias("n_people"))


@query(f"with {NUMBERS}, m as (select admissionid, itemid, median(value) v from numbers where itemid in (46091, 46092) group by all) select admissionid, max(v) filter (itemid = 46091) as weight, max(v) filter (itemid = 46092) as length from m group by 1")
def op_91g_median_pivot(s, d):
    m = numbers(s, d).filter("itemid in (46091, 46092)").groupBy("admissionid", "itemid").agg(F.median("value").alias("v"))
    return grid.wide(m.withColumn("tag", F.when(F.col("itemid") == 46091, "weight").otherwise("length")), ["admissionid"], "tag", "v", ["weight", "length"])


@query(f"with {_TRAIN} select itemid, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std, count(*) as n from t group by 1")
def op_91h_train_moments(s, d):
    return fit.fit_moments(_train(s, d), "itemid", "value").select("itemid", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")


@query("""select itemid, count(*) as n_rows, avg(case when rate is null then 1.0 else 0.0 end) as rate_missing, round(avg(rate), 6) as rate_mean,
round(avg(pow(rate - m, 3)) / nullif(pow(stddev_pop(rate), 3), 0), 6) as rate_skewness from (select *, avg(rate) over (partition by itemid) m from drugitems) group by 1""")
def op_91i_profile(s, d):
    return quality.profile(table(s, d, "drugitems"), "itemid", ["rate"]).withColumns({k: F.round(k, 6) for k in ("rate_mean", "rate_skewness")})


@query(f"""with {NUMBERS}, q as (select itemid, count(value) n, quantile_cont(value, [0.25, 0.5, 0.75, 0.01, 0.99]) q from numbers group by 1), m as (select itemid, median(abs(value - q[2])) m from numbers join q using (itemid) group by 1)
select itemid, n, round(q[1] - 3 * (q[3] - q[1]), 6) as iqr_low, round(q[3] + 3 * (q[3] - q[1]), 6) as iqr_high, round(q[2] - 3.5 * 1.4826 * m, 6) as mad_low, round(q[2] + 3.5 * 1.4826 * m, 6) as mad_high, round(q[4], 6) as p01, round(q[5], 6) as p99 from q join m using (itemid)""")
def op_91j_outlier_bounds(s, d):
    b = quality.outlier_bounds(numbers(s, d).select("itemid", "value"), "itemid", "value")
    return b.select("itemid", "n", *[F.round(k, 6).alias(k) for k in ("iqr_low", "iqr_high", "mad_low", "mad_high", "p01", "p99")])


@query(f"with {NUMBERS}, p as (select itemid, value + 0.0 as value, count(*) n from numbers group by all), t as (select itemid, sum(n) a from p group by 1) select itemid, value, n, round(n / a, 6) as share from p join t using (itemid) where n >= 10 and n / a >= 0.05")
def op_91j_spiky_values(s, d):
    return quality.spiky_values(numbers(s, d).select("itemid", "value"), "itemid", "value").withColumn("share", F.round("share", 6))


@query("select itemid, value, count(*) as n from listitems group by all")
def op_91k_value_counts(s, d):
    return table(s, d, "listitems").groupBy("itemid", "value").agg(F.count("*").alias("n"))


TAGS = CATALOGUE | {41011: "pulse", 41015: "pressure", 42021: "warmth"}
_GRID_SQL = f"""{STAYS}, {NUMBERS}, sk as (select admissionid, unnest(range(cast(ceil((dischargedat - admittedat) / 3600000.0) as bigint))) as hour from stays where dischargedat > admittedat),
hv as (select admissionid, {HOUR} as hour, itemid, median(value) v from numbers where admission_relative_ms >= 0 group by all),
w as (select admissionid, hour, {', '.join(f'max(v) filter (itemid = {i}) as {t}' for i, t in TAGS.items())} from hv group by all),
g as (select sk.admissionid, sk.hour, {', '.join(TAGS.values())} from sk left join w using (admissionid, hour))"""


def hour_grid(s, d):
    """The dense grid of all items that several queries start from."""
    rows = numbers(s, d).filter(F.col("itemid").isin(list(TAGS)))
    long = grid.hourly(rows, ["admissionid", "itemid"], "admission_relative_ms", {"v": F.median("value")}).withColumn("tag", x.lookup(F.col("itemid"), TAGS))
    return grid.assembled(grid.skeleton(stays(s, d), "admissionid", "los_hours"), [grid.wide(long, ["admissionid", "hour"], "tag", "v", list(TAGS.values()))], ["admissionid", "hour"])


@query(f"with {_GRID_SQL} select * from g")
def op_73_dense_grid(s, d):
    return hour_grid(s, d)


@query(f"with {STAYS} select admissionid, unnest(range(cast(ceil((dischargedat - admittedat) / 3600000.0) as bigint))) as hour from stays where dischargedat > admittedat")
def op_99_skeleton(s, d):
    return grid.skeleton(stays(s, d), "admissionid", "los_hours")


@query(f"with {_GRID_SQL} select admissionid, hour, {', '.join(f'last_value({t} ignore nulls) over (partition by admissionid order by hour rows unbounded preceding) as {t}' for t in TAGS.values() if t != 'warmth')}, coalesce(last_value(warmth ignore nulls) over (partition by admissionid order by hour rows unbounded preceding), 0) as warmth from g")
def op_92_forward_fill(s, d):
    return grid.forward_filled(hour_grid(s, d), "admissionid", "hour", list(TAGS.values()), zero=["warmth"])


_SORTED = "partition by admissionid, itemid order by measuredat nulls last, registeredat nulls last, valueid nulls last, registeredby nulls last, updatedat nulls last"


@query(f"select admissionid, itemid, valueid, measuredat, registeredat from (select *, row_number() over ({_SORTED}) n, lag(valueid) over ({_SORTED}) p from listitems) where itemid not in (61001, 61002) or n = 1 or p is distinct from valueid")
def op_93_state_changes(s, d):
    rows = table(s, d, "listitems")
    return grid.state_changes(rows, ["admissionid", "itemid"], "valueid", ["measuredat", "registeredat", "valueid", "registeredby", "updatedat"], [61001, 61002], "itemid").select("admissionid", "itemid", "valueid", "measuredat", "registeredat")


@query("select admissionid, itemid, max(measuredat) as last_time, arg_max(valueid, (measuredat, registeredat, valueid)) as last_value from listitems where measuredat is not null and registeredat is not null and valueid is not null group by all")
def op_95_last_row(s, d):
    rows = table(s, d, "listitems").filter("measuredat is not null and registeredat is not null and valueid is not null")
    return rows.groupBy("admissionid", "itemid").agg(F.max("measuredat").alias("last_time"), F.max_by("valueid", F.struct("measuredat", "registeredat", "valueid")).alias("last_value"))


@query(f"with {NUMBERS}, h as (select distinct admissionid, {HOUR} h from numbers where admission_relative_ms is not null) select admissionid, count(*) as n_hours, cast(coalesce(max(d), 0) as bigint) as max_gap from (select admissionid, h - lag(h) over (partition by admissionid order by h) d from h) group by 1")
def op_98_longest_gap(s, d):
    return cohort.longest_gaps(numbers(s, d).filter("admission_relative_ms is not null").withColumn("hour", x.bucket(F.col("admission_relative_ms"))), "admissionid", "hour")


@query(f"with {_GRID_SQL} select admissionid, hour, pulse, " + ", ".join(f"{'round(' if f in ('avg', 'stddev_samp') else ''}{f}(pulse) over w{', 6)' if f in ('avg', 'stddev_samp') else ''} as pulse_{n}_8h" for f, n in (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max"), ("count", "n"))) + " from g window w as (partition by admissionid order by hour rows between 7 preceding and current row)")
def op_98_rolling_features(s, d):
    r = grid.rolling(hour_grid(s, d).select("admissionid", "hour", "pulse"), "admissionid", "hour", "pulse", 8)
    return r.withColumns({k: F.round(k, 6) for k in ("pulse_mean_8h", "pulse_std_8h")})


@query("select distinct admissionid, itemid, cast(floor(admission_relative_ms / 3600000.0) as bigint) as hour from numericitems where value = 1 and itemid in (45084, 45085, 46094) and admission_relative_ms >= 0")
def op_104_points_to_hours(s, d):
    rows = table(s, d, "numericitems").filter("value = 1 and itemid in (45084, 45085, 46094) and admission_relative_ms >= 0")
    return rows.select("admissionid", "itemid", x.bucket(F.col("admission_relative_ms")).alias("hour")).distinct()


@query("""with p as (select admissionid, itemid, count(*) as n from numericitems group by all)
select admissionid, """ + ", ".join(f"max(n) filter (itemid = {i}) as item_{i}" for i in CATALOGUE) + " from p group by 1")
def op_105_pivot(s, d):
    p = table(s, d, "numericitems").groupBy("admissionid", "itemid").agg(F.count("*").alias("n")).withColumn("tag", F.concat(F.lit("item_"), F.col("itemid").cast("string")))
    # Entities without any listed tag have a row too.
    ids = p.select("admissionid").distinct()
    return ids.join(grid.wide(p, ["admissionid"], "tag", "n", [f"item_{i}" for i in CATALOGUE]), "admissionid", "left")


@query("""select admissionid, t as time, 'DRUG//' || itemid || '//' || k as code from (select admissionid, itemid, unnest([{'t': start, 'k': 'START'}, {'t': stop, 'k': 'END'}], recursive := true) from drugitems where stop >= start and start <> -1899)""")
def op_106_boundary_events(s, d):
    g = table(s, d, "drugitems").filter("start <> -1899")
    return events.boundary_events(g, ["admissionid"], F.concat(F.lit("DRUG//"), F.col("itemid").cast("string")), "start", "stop")


@query("""with a as (select distinct admissionid, subject_id, admittedat, dischargedat, gender, agegroup from admissions)
select * from (select admissionid, admittedat as time, 'ADMISSION' as code, cast(null as varchar) as text_value from a union all select admissionid, dischargedat, 'DISCHARGE', null from a
union all select admissionid, admittedat, 'GENDER//' || gender, gender from a union all select admissionid, admittedat, 'AGE//' || agegroup, agegroup from a) where time is not null and code is not null""")
def op_107_context_events(s, d):
    a = table(s, d, "admissions").select("admissionid", "subject_id", "admittedat", "dischargedat", "gender", "agegroup").distinct()
    none = F.lit(None).cast("string")
    made = [(F.col("admittedat"), F.lit("ADMISSION"), none), (F.col("dischargedat"), F.lit("DISCHARGE"), none), (F.col("admittedat"), F.concat(F.lit("GENDER//"), "gender"), F.col("gender")), (F.col("admittedat"), F.concat(F.lit("AGE//"), "agegroup"), F.col("agegroup"))]
    return events.facts(a, ["admissionid"], made)


@query(f"with {_GRID_SQL} select *, {', '.join(f'case when {t} is null then 0 else 1 end as {t}__observed' for t in TAGS.values())} from g")
def op_115_presence_mask(s, d):
    return grid.masked(hour_grid(s, d), list(TAGS.values()))


@query("select admissionid, 0 as dialysis_on, 0.0 as infusion_rate, cast(null as double) as score, cast(null as varchar) as rhythm from (select distinct admissionid from admissions)")
def op_114_structural_zeros(s, d):
    return grid.structural_zeros(table(s, d, "admissions").select("admissionid").distinct(), {"dialysis_on": "indicator", "infusion_rate": "rate", "score": "numeric", "rhythm": "category"})


_GROUPS = {"gender": ("Man", "Vrouw"), "agegroup": ("18-39", "40-49", "50-59", "60-69", "70-79", "80+")}


@query("select admissionid, " + ", ".join(f"max({k}) as {k}, " + ", ".join(f"cast(coalesce(max({k}) = '{g}', false) as integer) as {k}_{fit.sanitized(g)}" for g in v) + f", cast(not coalesce(max({k}) in ({', '.join(repr(g) for g in v)}), false) as integer) as {k}_missing" for k, v in _GROUPS.items()) + " from admissions group by 1")
def op_112_one_hot(s, d):
    a = table(s, d, "admissions").groupBy("admissionid").agg(*[F.max(k).alias(k) for k in _GROUPS])
    for k, groups in _GROUPS.items():
        a = fit.one_hot(a, k, groups, k)
    return a


@query("select admissionid, case when value in (3, 4) then 2 else value + 0.0 end as score, count(*) as n from numericitems where itemid = 45082 and value is not null and not isnan(value) group by all")
def op_113_collapse(s, d):
    rows = numbers(s, d).filter("itemid = 45082").withColumn("score", F.when(F.col("value").isin(3, 4), 2.0).otherwise(F.col("value")))
    return rows.groupBy("admissionid", "score").agg(F.count("*").alias("n"))


@query(f"with {NUMBERS}, p as (select itemid, quantile_cont(value, [0.01, 0.99]) q from numbers group by 1) select admissionid, itemid, hour, round(avg(least(greatest(value, q[1]), q[2])), 6) as v from (select *, {HOUR} as hour from numbers where admission_relative_ms >= 0) join p using (itemid) group by all")
def op_116_clipped_matrix(s, d):
    rows = numbers(s, d)
    p = percentiles(rows, ["itemid"], "value", [0.01, 0.99]).select("itemid", F.col("p").alias("q"))
    clipped = rows.join(p, "itemid").withColumn("value", F.least(F.greatest("value", F.col("q")[0]), F.col("q")[1]))
    return grid.hourly(clipped, ["admissionid", "itemid"], "admission_relative_ms", {"v": F.round(F.avg("value"), 6)})
