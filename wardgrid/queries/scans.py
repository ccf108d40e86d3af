"""Scans, casts, anchors, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions import columns as x
from wardgrid.operators import anchors, lookups, quality
from wardgrid.queries.registry import query
from wardgrid.sources.tables import table

# SQL pieces that several oracles share.
STAYS = "stays as (select admissionid, max(admittedat) admittedat, max(dischargedat) dischargedat from admissions where admissionid is not null group by 1)"
#: A value that may be NaN, which is no value.
NUMBER = "case when not isnan(value) then value end"
NUMBERS = "numbers as (select * from numericitems where value is not null and not isnan(value))"


def stays(s: SparkSession, d: str) -> DataFrame:
    return anchors.stays(table(s, d, "admissions"))


def numbers(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "numericitems").filter("value is not null and not isnan(value)")


def training(df: DataFrame, s: SparkSession, d: str) -> DataFrame:
    """df's rows of stays that the table of stays puts into training."""
    return lookups.only(df, table(s, d, "admissions").filter(F.lower(F.trim("split")).isin("train", "training")), ["admissionid"])


@query("""select admissionid, itemid, try_cast(weightgroup as bigint) as weight_number, try_cast(substr(agegroup, 1, 2) as bigint) as age_low, try_cast(cast(urgency as varchar) as double) as urgency_number
from (select a.*, 0 as itemid from admissions a)""")
def op_03_permissive_cast(s, d):
    from wardgrid.sources.raw import cast_columns

    rows = table(s, d, "admissions").select("admissionid", F.lit(0).alias("itemid"), F.col("weightgroup").alias("weight_number"), F.substring("agegroup", 1, 2).alias("age_low"), F.col("urgency").cast("string").alias("urgency_number"))
    return cast_columns(rows, {"weight_number": "bigint", "age_low": "bigint", "urgency_number": "double"})


@query("""select admissionid, try_cast(cast(admittedattime as varchar) as timestamp) as admitted, try_cast(agegroup as timestamp) as nothing from admissions""")
def op_04_iso_datetime_cast(s, d):
    from wardgrid.sources.raw import cast_columns

    rows = table(s, d, "admissions").select("admissionid", F.col("admittedattime").cast("string").alias("admitted"), F.col("agegroup").alias("nothing"))
    return cast_columns(rows, {"admitted": "timestamp_ntz", "nothing": "timestamp_ntz"})


@query(f"select numericid, admissionid, itemid, {NUMBER} as value from numericitems where admissionid in (select admissionid from admissions where urgency = 1)")
def op_06_scoped_read(s, d):
    wanted = table(s, d, "admissions").filter("urgency = 1")
    return lookups.only(table(s, d, "numericitems").select("numericid", "admissionid", "itemid", x.number(F.col("value")).alias("value")), wanted, ["admissionid"])


@query("select itemid, unitid, count(*) as n from numericitems group by all")
def op_07_grouped_counts(s, d):
    return table(s, d, "numericitems").groupBy("itemid", "unitid").agg(F.count("*").alias("n"))


@query(f"with {STAYS} select admissionid, admittedat, dischargedat, (dischargedat - admittedat) / 3600000.0 as los_hours from stays")
def op_09_stay_load(s, d):
    return stays(s, d)


@query("""with p as (select patientid, min(dateofdeath) first_death, count(distinct admissionid) n_stays from admissions group by 1),
q as (select subject_id, max(gender) gender from admissions group by 1)
select a.admissionid, a.patientid, a.subject_id, p.first_death, p.n_stays, q.gender as subject_gender from (select distinct admissionid, patientid, subject_id from admissions) a left join p using (patientid) left join q using (subject_id)""")
def op_10_three_table_stays(s, d):
    a = table(s, d, "admissions")
    people = a.groupBy("patientid").agg(F.min("dateofdeath").alias("first_death"), F.countDistinct("admissionid").alias("n_stays"))
    subjects = a.groupBy("subject_id").agg(F.max("gender").alias("subject_gender"))
    return a.select("admissionid", "patientid", "subject_id").distinct().join(people, "patientid", "left").join(subjects, "subject_id", "left").select("admissionid", "patientid", "subject_id", "first_death", "n_stays", "subject_gender")


@query(f"""with {STAYS} select numericid, admissionid, itemid, case when measuredat <> -1899 then measuredat - admittedat end as relative_ms, case when registeredat <> -1899 then registeredat - admittedat end as registered_ms
from numericitems join stays using (admissionid) where measuredat is null or measuredat <> -1899""")
def op_11_anchored_scan(s, d):
    rows = table(s, d, "numericitems").filter("measuredat is null or measuredat <> -1899")
    return anchors.anchored(rows, stays(s, d), ["admissionid"], {"measuredat": "relative_ms", "registeredat": "registered_ms"}).select("numericid", "admissionid", "itemid", "relative_ms", "registered_ms")


@query("""with e as (select distinct l.itemid, l.valueid, a.subject_id, a.patientid from listitems l join (select distinct admissionid, subject_id, patientid from admissions) a using (admissionid)),
k as (select distinct admissionid, subject_id, patientid from admissions)
select k.admissionid, e.itemid, count(*) as n from e join k using (subject_id, patientid) group by all""")
def op_12_two_key_fan_out(s, d):
    k = table(s, d, "admissions").select("admissionid", "subject_id", "patientid").distinct()
    e = table(s, d, "listitems").join(k, "admissionid").select("itemid", "valueid", "subject_id", "patientid").distinct()
    return e.join(k, ["subject_id", "patientid"]).groupBy("admissionid", "itemid").agg(F.count("*").alias("n"))


@query(f"""with {STAYS} select admissionid, orderid, itemid, start - admittedat as start_ms, stop - admittedat as stop_ms, dischargedat - admittedat as los_ms
from drugitems join stays using (admissionid) where itemid in (51001, 51025, 51026) and start <> -1899 and stop <> -1899""")
def op_14_interval_source(s, d):
    rows = table(s, d, "drugitems").filter("itemid in (51001, 51025, 51026) and start <> -1899 and stop <> -1899")
    return anchors.anchored(rows, stays(s, d), ["admissionid"], {"start": "start_ms", "stop": "stop_ms"}).select("admissionid", "orderid", "itemid", "start_ms", "stop_ms", (F.col("dischargedat") - F.col("admittedat")).alias("los_ms"))


@query("""select itemid, item, tag, 'numeric' as source from items union all select distinct itemid, item, null, 'drug' from drugitems union all select distinct itemid, item, null, 'list' from listitems""")
def op_15_catalogue_union(s, d):
    parts = {"numeric": table(s, d, "items").select("itemid", "item", "tag"), "drug": table(s, d, "drugitems").select("itemid", "item").distinct(), "list": table(s, d, "listitems").select("itemid", "item").distinct()}
    return anchors.catalogue(parts)


@query("""select l.admissionid, l.itemid, l.measuredat, case when measuredat <> -1899 then (case when a.urgency = 1 then timestamp '2010-01-01' else timestamp '2003-01-01' end) + to_microseconds(l.measuredat * 1000) end as at
from listitems l join (select admissionid, max(urgency) urgency from admissions group by 1) a using (admissionid)""")
def op_16_synthetic_time(s, d):
    epoch = table(s, d, "admissions").groupBy("admissionid").agg(F.max("urgency").alias("urgency"))
    base = F.when(F.col("urgency") == 1, F.lit("2010-01-01")).otherwise(F.lit("2003-01-01")).cast("timestamp_ntz")
    return anchors.synthetic_time(table(s, d, "listitems").join(epoch, "admissionid"), "measuredat", base, "at").select("admissionid", "itemid", "measuredat", "at")


@query("""select patientid, admissionid, admissioncount, admittedat from admissions qualify row_number() over (partition by patientid order by admissioncount nulls last, admittedat nulls last, admissionid nulls last, gender nulls last, agegroup nulls last, weightgroup nulls last) = 1""")
def op_18_first_stay_of_patient(s, d):
    return anchors.first_stay(table(s, d, "admissions"), "patientid", ["admissioncount", "admittedat", "admissionid", "gender", "agegroup", "weightgroup"]).select("patientid", "admissionid", "admissioncount", "admittedat")


@query("""select agegroup, count(*) as n, case when agegroup similar to '[0-9]+-[0-9]+' then (cast(split_part(agegroup, '-', 1) as double) + cast(split_part(agegroup, '-', 2) as double)) / 2 when agegroup similar to '[0-9]+\\+' then cast(replace(agegroup, '+', '') as double) end as years
from admissions group by agegroup""")
def op_19_age_years(s, d):
    return table(s, d, "admissions").groupBy("agegroup").agg(F.count("*").alias("n")).withColumn("years", x.age_years(F.col("agegroup")))


@query("select numericid, value from numericitems where value is not null and not isnan(value) and (measuredat is null or measuredat <> -1899)")
def op_43_known_times(s, d):
    return numbers(s, d).filter(F.col("measuredat").isNull() | x.known_time(F.col("measuredat")).isNotNull()).select("numericid", "value")


@query(f"select numericid, itemid, {NUMBER} as value, admission_relative_ms from numericitems where itemid in (41011, 41013, 42021) and admission_relative_ms >= 0")
def op_44_items_from_admission(s, d):
    return table(s, d, "numericitems").filter("itemid in (41011, 41013, 42021) and admission_relative_ms >= 0").select("numericid", "itemid", x.number(F.col("value")).alias("value"), "admission_relative_ms")


@query("select numericid, itemid, value from numericitems n where value is not null and not isnan(value) and not ((itemid = 41011 and value in (0, 999)) or (itemid = 42021 and value = 0) or (itemid = 44062 and value = 999))")
def op_45_sentinel_values(s, d):
    listed = s.createDataFrame([(41011, 0.0), (41011, 999.0), (42021, 0.0), (44062, 999.0)], "itemid long, value double")
    return lookups.without(numbers(s, d).select("numericid", "itemid", "value"), listed, ["itemid", "value"])


@query(f"with {NUMBERS} select numericid, itemid, value from numbers left join items using (itemid) where (physmin is null and physmax is null) or value between physmin and physmax")
def op_46_plausible(s, d):
    return quality.bounded(numbers(s, d).select("numericid", "itemid", "value"), table(s, d, "items"), "itemid", "value", "physmin", "physmax")


@query("""select admissionid, orderid, itemid, start, rate from drugitems left join (values (51001, 20.0), (51026, 15.0)) c(itemid, ceiling) using (itemid) where rate >= 0 and (ceiling is null or rate <= ceiling)""")
def op_47_rate_ceiling(s, d):
    ceilings = s.createDataFrame([(51001, 20.0), (51026, 15.0)], "itemid long, ceiling double")
    return quality.below_ceiling(table(s, d, "drugitems").select("admissionid", "orderid", "itemid", "start", "rate"), ceilings, "itemid", "rate")


@query("""select admissionid, orderid, itemid, start, duration from drugitems left join (values (51001, 10), (51026, 60)) c(itemid, minimum) using (itemid) where duration > coalesce(minimum, 0)""")
def op_48_least_duration(s, d):
    least = s.createDataFrame([(51001, 10), (51026, 60)], "itemid long, minimum long")
    return quality.longer_than(table(s, d, "drugitems").select("admissionid", "orderid", "itemid", "start", "duration"), least, "itemid", "duration")


@query("select numericid, itemid, value from numericitems where value >= 0 and not isnan(value)")
def op_49_negative_floor(s, d):
    return numbers(s, d).filter("value >= 0").select("numericid", "itemid", "value")


@query("select numericid, itemid from numericitems where itemid not in (46094, 46095, 46096)")
def op_50_excluded_items(s, d):
    return lookups.without(table(s, d, "numericitems").select("numericid", "itemid"), s.createDataFrame([(46094,), (46095,), (46096,)], "itemid long"), ["itemid"])


@query("select numericid, itemid, value from numericitems where (itemid = 46091 and value between 20 and 300) or (itemid = 46092 and value between 100 and 230)")
def op_51_item_rules(s, d):
    return table(s, d, "numericitems").filter("(itemid = 46091 and value between 20 and 300) or (itemid = 46092 and value between 100 and 230)").select("numericid", "itemid", "value")


@query(f"""with {STAYS}, e as (select n.numericid, case when measuredat <> -1899 then measuredat end t, s.admittedat a, s.dischargedat z, admission_relative_ms r from numericitems n left join stays s using (admissionid))
select case when t is null or a is null then 'unknown' when t < a then 'preadmission' when z is not null and t > z then 'postadmission' else 'admission' end as by_time,
 case when r is null then 'unknown' when r < 0 then 'preadmission' when z - a is not null and r > z - a then 'postadmission' else 'admission' end as by_offset, count(*) as n from e group by all""")
def op_52_phases(s, d):
    e = table(s, d, "numericitems").join(stays(s, d), "admissionid", "left")
    a, z = F.col("admittedat"), F.col("dischargedat")
    return e.select(x.phase_absolute(x.known_time(F.col("measuredat")), a, z).alias("by_time"), x.phase_relative(F.col("admission_relative_ms"), z - a).alias("by_offset")).groupBy("by_time", "by_offset").agg(F.count("*").alias("n"))


@query(f"""with {STAYS} select itemid, count(*) as n from listitems l join stays s using (admissionid) where l.measuredat <> -1899 and (s.dischargedat is null or l.measuredat <= s.dischargedat) group by 1""")
def op_53_phase_filter(s, d):
    e = table(s, d, "listitems").join(stays(s, d), "admissionid")
    return e.filter(x.phase_absolute(x.known_time(F.col("measuredat")), F.col("admittedat"), F.col("dischargedat")).isin("preadmission", "admission")).groupBy("itemid").agg(F.count("*").alias("n"))


@query("select itemid, lower(trim(cast(measured as varchar))) in ('true', '1', 'yes') as emitted from items")
def op_54_string_boolean(s, d):
    return table(s, d, "items").select("itemid", x.truthy(F.col("measured")).alias("emitted"))


@query("select numericid, value from numericitems where value is not null and not isnan(value) and not isinf(value)")
def op_55_finite(s, d):
    return table(s, d, "numericitems").filter(x.finite(F.col("value"))).select("numericid", "value")


@query(f"""with {STAYS}, h as (select distinct admissionid, cast(floor(admission_relative_ms / 3600000.0) as bigint) h from numericitems where value is not null and not isnan(value) and admission_relative_ms >= 0),
g as (select admissionid, count(*) n, coalesce(max(d), 0) g from (select *, h - lag(h) over (partition by admissionid order by h) d from h) group by 1)
select s.admissionid, (dischargedat - admittedat) / 3600000.0 as los_hours, n as n_hours, g as max_gap from stays s join g using (admissionid) where (dischargedat - admittedat) / 3600000.0 >= 4 and n >= 4 and g <= 48""")
def op_56_coverage_criteria(s, d):
    from wardgrid.operators.cohort import covered_stays

    events = numbers(s, d).filter("admission_relative_ms >= 0").withColumn("hour", x.bucket(F.col("admission_relative_ms")))
    return covered_stays(stays(s, d), events, "admissionid", "hour", 4.0, 4, 48)


@query(f"with {STAYS} select admissionid from stays where dischargedat > admittedat")
def op_57_valid_stays(s, d):
    return anchors.valid_stays(stays(s, d)).select("admissionid")


@query(f"""with {STAYS} select admissionid, orderid, itemid, start, stop from drugitems join stays using (admissionid) where start <> -1899 and (stop is null or stop <> -1899)
and (stop is null or stop >= start) and coalesce(stop, start) >= admittedat and (dischargedat is null or start <= dischargedat)""")
def op_58_valid_intervals(s, d):
    e = table(s, d, "drugitems").join(stays(s, d), "admissionid").filter("start <> -1899 and (stop is null or stop <> -1899)")
    return e.filter("(stop is null or stop >= start) and coalesce(stop, start) >= admittedat and (dischargedat is null or start <= dischargedat)").select("admissionid", "orderid", "itemid", "start", "stop")


@query("select admissionid, orderid, item from drugitems where ordercategory like 'Infuus%' or contains(lower(item), 'zolin') or regexp_matches(lower(item), '(gapine|meril)$')")
def op_59_text_policies(s, d):
    item = F.lower("item")
    return table(s, d, "drugitems").filter(F.col("ordercategory").startswith("Infuus") | item.contains("zolin") | item.rlike("(gapine|meril)$")).select("admissionid", "orderid", "item")


@query(f"select admissionid, cast(itemid as varchar) as code, {NUMBER} as numeric_value, cast(null as bigint) as stay_id from numericitems")
def op_61_coerced(s, d):
    from wardgrid.operators.joint import padded

    rows = table(s, d, "numericitems").withColumn("value", x.number(F.col("value"))).withColumnsRenamed({"itemid": "code", "value": "numeric_value"})
    return padded(rows, {"admissionid": "bigint", "code": "string", "numeric_value": "double", "stay_id": "bigint"})


@query("with k as (select distinct admissionid from admissions) select n.admissionid, count(*) as n, count(*) filter (k.admissionid is null) as n_missing from numericitems n left join k using (admissionid) group by 1")
def op_63_left_anchor_with_missing(s, d):
    k = table(s, d, "admissions").select("admissionid", F.lit(True).alias("there")).distinct()
    return table(s, d, "numericitems").join(k, "admissionid", "left").groupBy("admissionid").agg(F.count("*").alias("n"), F.count_if(F.col("there").isNull()).alias("n_missing"))


FEATURES = [(41011, "pulse"), (41011, "monitor"), (41015, "pressure"), (41012, "pressure"), (42021, "warmth"), (43041, "monitor")]
FEATURES_SQL = "(values " + ", ".join(f"({i}, '{t}')" for i, t in FEATURES) + ") f(itemid, feature)"


def features(s: SparkSession) -> DataFrame:
    return s.createDataFrame(FEATURES, "itemid long, feature string")


@query(f"select feature, n.itemid, count(*) as n from numericitems n join {FEATURES_SQL} using (itemid) group by all")
def op_64_fan_out(s, d):
    return lookups.fan_out(table(s, d, "numericitems").select("itemid", "value"), features(s), ["itemid"]).groupBy("feature", "itemid").agg(F.count("*").alias("n"))


LABELS = [(61001, 1, "rhythm", "a"), (61001, 3, "rhythm", "b"), (61001, 3, "nodal", "yes"), (61003, 1, "pupil", "fast")]
LABELS_SQL = "(values " + ", ".join(f"({i}, {v}, '{t}', '{m}')" for i, v, t, m in LABELS) + ") f(itemid, valueid, feature, label)"


@query(f"select admissionid, feature, label, count(*) as n from listitems join {LABELS_SQL} using (itemid, valueid) group by all")
def op_65_two_key_fan_out(s, d):
    t = s.createDataFrame(LABELS, "itemid long, valueid long, feature string, label string")
    return lookups.fan_out(table(s, d, "listitems"), t, ["itemid", "valueid"]).groupBy("admissionid", "feature", "label").agg(F.count("*").alias("n"))


@query("select l.admissionid, l.itemid, l.measuredat, c.constant as value from listitems l join (values (1, 15.0), (2, 12.0), (3, 9.0)) c(valueid, constant) using (valueid) where itemid = 61005")
def op_66_constant_by_category(s, d):
    t = s.createDataFrame([(1, 15.0), (2, 12.0), (3, 9.0)], "valueid long, value double")
    return table(s, d, "listitems").filter("itemid = 61005").drop("value").join(F.broadcast(t), "valueid").select("admissionid", "itemid", "measuredat", "value")


@query(f"""with {NUMBERS}, m as (select admissionid, measuredat, itemid, median(value) v from numbers where itemid in (42028, 41011) group by all)
select a.admissionid, a.measuredat, round(a.v / b.v * 1000, 6) as per_beat from m a join m b on a.admissionid = b.admissionid and a.measuredat = b.measuredat and a.itemid = 42028 and b.itemid = 41011 where b.v > 0""")
def op_67_same_time_product(s, d):
    m = numbers(s, d).filter("itemid in (42028, 41011)").groupBy("admissionid", "measuredat", "itemid").agg(F.median("value").alias("v"))
    a, b = m.filter("itemid = 42028").select("admissionid", "measuredat", F.col("v").alias("flow")), m.filter("itemid = 41011").select("admissionid", "measuredat", F.col("v").alias("beats"))
    return a.join(b, ["admissionid", "measuredat"]).filter("beats > 0").select("admissionid", "measuredat", F.round(F.col("flow") / F.col("beats") * 1000, 6).alias("per_beat"))


@query("select l.admissionid, l.itemid, coalesce(t.label, l.value) as label, count(*) as n from listitems l left join (values ('Vlot', 'brisk'), ('Traag', 'slow')) t(value, label) using (value) group by all")
def op_68_relabel(s, d):
    t = s.createDataFrame([("Vlot", "brisk"), ("Traag", "slow")], "value string, word string")
    return lookups.relabelled(table(s, d, "listitems"), t, "value", "word", "label").groupBy("admissionid", "itemid", "label").agg(F.count("*").alias("n"))


@query("""with v as (select itemid, measured as emit from items where itemid <> 41011), j as (select n.*, v.itemid is not null as there, coalesce(v.emit, false) as emit, coalesce(n.admission_relative_ms >= 0, false) as kept from numericitems n left join v using (itemid))
select count(*) as n_rows, count(*) filter (there) as n_matched, count(*) filter (not there) as n_unmatched, count(*) filter (there and not emit) as n_not_emitted, count(*) filter (there and emit and not kept) as n_out_of_phase, count(*) filter (there and emit and kept) as n_left from j""")
def op_69_accounted_join(s, d):
    vocab = table(s, d, "items").filter("itemid <> 41011").select("itemid", F.col("measured").alias("emit"))
    return lookups.accounted(table(s, d, "numericitems"), vocab, ["itemid"], "emit", F.col("admission_relative_ms") >= 0)


@query("with k as (select itemid, unit, count(*) as n_known from numericitems group by all) select k.itemid, k.unit, k.n_known, j.n_other from k join (select itemid, unit, count(distinct admissionid) as n_other from numericitems group by all) j on k.itemid = j.itemid and k.unit is not distinct from j.unit")
def op_70_null_safe_join(s, d):
    n = table(s, d, "numericitems")
    return lookups.null_safe(n.groupBy("itemid", "unit").agg(F.count("*").alias("n_known")), n.groupBy("itemid", "unit").agg(F.countDistinct("admissionid").alias("n_other")), ["itemid", "unit"]).select("itemid", "unit", "n_known", "n_other")


@query("select distinct subject_id from admissions a where not exists (select 1 from drugitems g where g.admissionid = a.admissionid) and subject_id is not null")
def op_72_anti_join(s, d):
    return lookups.without(table(s, d, "admissions"), table(s, d, "drugitems"), ["admissionid"]).filter("subject_id is not null").select("subject_id").distinct()


@query("select a.admissionid, b.n_rows, gender, agegroup from (select admissionid, max(gender) gender, max(agegroup) agegroup from admissions group by 1) a join (select admissionid, count(*) n_rows from listitems group by 1) b using (admissionid)")
def op_74_static_attributes(s, d):
    a = table(s, d, "admissions").groupBy("admissionid").agg(F.max("gender").alias("gender"), F.max("agegroup").alias("agegroup"))
    return table(s, d, "listitems").groupBy("admissionid").agg(F.count("*").alias("n_rows")).join(a, "admissionid").select("admissionid", "n_rows", "gender", "agegroup")


@query("""with m as (select admissionid, max(case when urgency = 1 then 'train' when urgency = 0 then 'val' else 'test' end) split from admissions group by 1)
select admissionid, m.split, count(*) as n from admissions join m using (admissionid) group by all""")
def op_75_split_manifest(s, d):
    from wardgrid.operators.splits import attached

    a = table(s, d, "admissions")
    u = F.col("urgency")
    manifest = a.groupBy("admissionid").agg(F.max(F.when(u == 1, "train").when(u == 0, "val").otherwise("test")).alias("split"))
    return attached(a, manifest, "admissionid").groupBy("admissionid", "split").agg(F.count("*").alias("n"))


@query("""with a as (select admissionid, max(gender) gender, max(urgency) urgency from admissions where urgency = 0 or gender = 'Man' group by 1), b as (select admissionid, min(gender) gender, max(urgency) urgency from admissions where urgency = 1 or gender = 'Man' group by 1)
select admissionid, case when a.admissionid is not null and b.admissionid is not null then 'both' when b.admissionid is null then 'left_only' else 'right_only' end as side, a.gender is distinct from b.gender as gender_differs, a.urgency is distinct from b.urgency as urgency_differs from a full join b using (admissionid)""")
def op_76_full_outer_diff(s, d):
    t = table(s, d, "admissions")
    a = t.filter("urgency = 0 or gender = 'Man'").groupBy("admissionid").agg(F.max("gender").alias("gender"), F.max("urgency").alias("urgency"))
    b = t.filter("urgency = 1 or gender = 'Man'").groupBy("admissionid").agg(F.min("gender").alias("gender"), F.max("urgency").alias("urgency"))
    return lookups.compared(a, b, ["admissionid"], ["gender", "urgency"])


@query("""with s as (select distinct itemid, item, unit from numericitems), t as (select itemid, item, tag as target, target_unit from items)
select itemid, target, method, max(specificity) as specificity, count(*) as n from (
 select s.itemid, t.target, 'id' as method, 100 as specificity from s join t on s.itemid = t.itemid
 union all select s.itemid, t.target, 'label', 70 from s join t on s.item = t.item
 union all select s.itemid, t.target, 'unit', 20 from s join (select distinct target, target_unit from t) t on s.unit = t.target_unit) group by all""")
def op_77_candidate_targets(s, d):
    src = table(s, d, "numericitems").select("itemid", "item", "unit").distinct()
    t = table(s, d, "items").withColumn("target", F.col("tag"))
    rules = [({"itemid": "itemid"}, t, "id", 100), ({"item": "item"}, t, "label", 70), ({"unit": "target_unit"}, t, "unit", 20)]
    return lookups.candidates(src, rules, "itemid").groupBy("itemid", "target", "method").agg(F.max("specificity").alias("specificity"), F.count("*").alias("n"))


@query("with u as (select distinct itemid from numericitems where itemid not in (select itemid from items where measured)) select itemid, true as uncovered from u")
def op_78_uncovered(s, d):
    return lookups.without(table(s, d, "numericitems").select("itemid").distinct(), table(s, d, "items").filter("measured"), ["itemid"]).withColumn("uncovered", F.lit(True))


@query("""select itemid, case when itemid in (41011, 44062) then case itemid when 41011 then 'beat' end else tag end as tag, case when itemid = 41011 then 'bpm' when itemid = 44062 then 'mM' else target_unit end as target_unit, physmin from items""")
def op_79_overwrite(s, d):
    changes = s.createDataFrame([(41011, "beat", "bpm"), (44062, None, "mM")], "itemid long, tag string, target_unit string")
    return lookups.overwritten(table(s, d, "items").select("itemid", "tag", "target_unit", "physmin"), changes, "itemid", ["tag", "target_unit"])


_PAIRS = "a as (select admissionid, start t from drugitems where itemid in (51001, 51026) and start <> -1899), b as (select admissionid, measuredat u from listitems where itemid = 61005 and measuredat <> -1899)"


@query(f"with {_PAIRS}, x as (select admissionid, min(t) first_left from a group by 1), y as (select admissionid, min(u) first_right from b group by 1) select * from x join y using (admissionid) where first_right - first_left between -259200000 and 86400000")
def op_80_first_events_near(s, d):
    a, b = _pair(s, d)
    return lookups.paired_within(a, b, "admissionid", "t", "u", 259_200_000, 86_400_000)


@query(f"with {_PAIRS} select distinct admissionid from a join b using (admissionid) where u - t between -1800000 and 600000")
def op_80_any_events_near(s, d):
    a, b = _pair(s, d)
    return lookups.any_pair_within(a, b, "admissionid", "t", "u", 1_800_000, 600_000)


def _pair(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    a = table(s, d, "drugitems").filter("itemid in (51001, 51026) and start <> -1899").select("admissionid", F.col("start").alias("t"))
    return a, table(s, d, "listitems").filter("itemid = 61005 and measuredat <> -1899").select("admissionid", F.col("measuredat").alias("u"))
