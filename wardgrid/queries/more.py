"""The remaining operators of the survey, each as a query with SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wardgrid.functions import columns as x
from wardgrid.operators import fit, lookups, splits
from wardgrid.queries.aggregates import _GRID_SQL, hour_grid
from wardgrid.queries.registry import query
from wardgrid.queries.scans import NUMBERS, STAYS, numbers, stays, training
from wardgrid.queries.timelines import _CODES, _EXPANDED, coded_events
from wardgrid.operators import tokens
from wardgrid.sources import evidence
from wardgrid.sources.tables import table


@query("""select distinct source, code, label, target, confidence from (select 'catalogue' as source, cast(itemid as varchar) as code, item as label, tag as target, null as confidence from items
union all select 'rows', cast(itemid as varchar), item, tag, null from numericitems union all select 'lists', cast(itemid as varchar), null, value, '0.5' from listitems) where target is not null""")
def op_23_evidence_in_one_form(s, d):
    fields = {"code": "itemid", "label": "item", "target": "tag"}
    lists = table(s, d, "listitems").select("itemid", "value", F.lit(0.5).alias("sure"))
    return evidence.evidence({"catalogue": (table(s, d, "items"), fields), "rows": (table(s, d, "numericitems"), fields), "lists": (lists, {"code": "itemid", "target": "value", "confidence": "sure"})})


@query(f"with {STAYS} select itemid, count(*) as n from drugitems join stays using (admissionid) group by 1")
def op_62_inner_anchor(s, d):
    return table(s, d, "drugitems").join(stays(s, d), "admissionid").groupBy("itemid").agg(F.count("*").alias("n"))


@query("select itemid, count(*) as n from numericitems where admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training')) group by 1")
def op_71_training_scope(s, d):
    train = table(s, d, "admissions").filter(F.lower(F.trim("split")).isin("train", "training"))
    return lookups.only(table(s, d, "numericitems"), train, ["admissionid"]).groupBy("itemid").agg(F.count("*").alias("n"))


@query(f"with {_CODES} select code, count(*) as n, count(*) filter (admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training'))) as n_train from e group by 1")
def op_91b_code_counts(s, d):
    train = training(coded_events(s, d), s, d).groupBy("code").agg(F.count("*").alias("t"))
    return coded_events(s, d).groupBy("code").agg(F.count("*").alias("n")).join(train, "code", "left").select("code", "n", F.coalesce("t", F.lit(0)).alias("n_train"))


@query("""with m as (select distinct n.itemid, i.tag as target, 'id' as method from numericitems n join items i using (itemid) union select distinct n.itemid, i.tag, 'label' from numericitems n join items i using (item))
select method, count(distinct itemid) as n_items, count(distinct target) as n_targets, count(*) as n_pairs from m group by 1""")
def op_91f_candidate_summary(s, d):
    t = table(s, d, "items").withColumn("target", F.col("tag"))
    found = lookups.candidates(table(s, d, "numericitems").select("itemid", "item").distinct(), [({"itemid": "itemid"}, t, "id", 100), ({"item": "item"}, t, "label", 70)], "itemid").select("itemid", "target", "method").distinct()
    return found.groupBy("method").agg(F.countDistinct("itemid").alias("n_items"), F.countDistinct("target").alias("n_targets"), F.count("*").alias("n_pairs"))


@query("select admissionid, itemid, measuredat, measuredat - lag(measuredat) over (partition by admissionid, itemid order by measuredat, valueid, registeredat, updatedat, registeredby) as gap from listitems where measuredat <> -1899")
def op_94_adjacent_interval(s, d):
    w = Window.partitionBy("admissionid", "itemid").orderBy(*[F.asc_nulls_last(o) for o in ("measuredat", "valueid", "registeredat", "updatedat", "registeredby")])
    return table(s, d, "listitems").filter("measuredat <> -1899").select("admissionid", "itemid", "measuredat", (F.col("measuredat") - F.lag("measuredat").over(w)).alias("gap"))


@query(f"with {_EXPANDED} select admissionid, max(seq) as last_place, count(*) as n, count(distinct seq) as n_places from x group by 1")
def op_97_places_in_timelines(s, d):
    t = tokens.expanded(coded_events(s, d), ["admissionid"], "t", "code")
    return t.groupBy("admissionid").agg(F.max("seq").alias("last_place"), F.count("*").alias("n"), F.countDistinct("seq").alias("n_places"))


_AB = "(values (42025, 18.0, cast(null as double)), (42021, 1.8, 32.0), (41012, cast(null as double), 1.5)) c(itemid, a, b)"


@query(f"with {NUMBERS} select numericid, round(value * coalesce(a, 1.0) + coalesce(b, 0.0), 6) as value from numbers left join {_AB} using (itemid)")
def op_136_affine_and_factor(s, d):
    t = s.createDataFrame([(42025, 18.0, None), (42021, 1.8, 32.0), (41012, None, 1.5)], "itemid long, a double, b double")
    return numbers(s, d).join(F.broadcast(t), "itemid", "left").select("numericid", F.round(x.affine(F.col("value"), F.col("a"), F.col("b")), 6).alias("value"))


@query(f"with {_GRID_SQL} select * replace (coalesce(pulse, 0) as pulse, coalesce(warmth, 37) as warmth) from g")
def op_144_zero_and_default_fill(s, d):
    return hour_grid(s, d).fillna(0.0, ["pulse"]).fillna(37.0, ["warmth"])


@query("""select admissionid, case when starts_with(o, 'Spoed') then 'emergency' when starts_with(o, 'Operatie') then 'theatre' when starts_with(o, 'Verpleeg') then 'ward' when o is null or trim(o) = '' or o = 'Onbekend' then 'unknown' else 'other' end as origin_group, year - 40 as base from (select admissionid, max(origin) o, max(year(admittedattime)) as year from admissions group by 1)""")
def op_146_grouped_categories(s, d):
    a = table(s, d, "admissions").groupBy("admissionid").agg(F.max("origin").alias("o"), F.max(F.year("admittedattime")).alias("y"))
    o = F.col("o")
    group = F.when(o.startswith("Spoed"), "emergency").when(o.startswith("Operatie"), "theatre").when(o.startswith("Verpleeg"), "ward").when(o.isNull() | (F.trim(o) == "") | (o == "Onbekend"), "unknown").otherwise("other")
    return a.select("admissionid", group.alias("origin_group"), (F.col("y") - 40).cast("long").alias("base"))


@query("select 'LIST//' || itemid || '//' || coalesce(nullif(trim(value), ''), 'NONE') as token, count(*) as n from listitems group by 1 union all select 'DRUG//' || itemid || '//' || coalesce(nullif(trim(doseunit), ''), 'NONE'), count(*) from drugitems group by 1")
def op_147_source_tokens(s, d):
    a = table(s, d, "listitems").select(x.source_token("LIST", F.col("itemid"), F.col("value")).alias("token"))
    b = table(s, d, "drugitems").select(x.source_token("DRUG", F.col("itemid"), F.col("doseunit")).alias("token"))
    return a.unionByName(b).groupBy("token").agg(F.count("*").alias("n"))


@query("select itemid, item, case when contains(l, 'arterieel') or contains(l, 'art.') then 'arterial' when contains(l, 'bloed') or contains(l, 'plasma') then 'blood' when contains(l, 'ingesteld') then 'setting' else 'other' end as compartment from (select itemid, item, lower(item) l from items)")
def op_152_compartments(s, d):
    item = F.lower("item")
    made = F.when(item.contains("arterieel") | item.contains("art."), "arterial").when(item.contains("bloed") | item.contains("plasma"), "blood").when(item.contains("ingesteld"), "setting").otherwise("other")
    return table(s, d, "items").select("itemid", "item", made.alias("compartment"))


@query("select numericid from numericitems where value between 60 and 100 and itemid in (41011, 41013) and coalesce(unit = '/min', false)")
def op_155_between_and_in(s, d):
    return table(s, d, "numericitems").filter(F.col("value").between(60, 100) & F.col("itemid").isin(41011, 41013) & F.coalesce(F.col("unit") == "/min", F.lit(False))).select("numericid")


@query(f"with {NUMBERS} select numericid, cast(1 + cast(value > 60 as integer) + cast(value > 80 as integer) + cast(value > 100 as integer) as integer) as bin from numbers")
def op_157_bin_number(s, d):
    return numbers(s, d).select("numericid", x.quantile_bin(F.col("value"), F.array(F.lit(60.0), F.lit(80.0), F.lit(100.0))).alias("bin"))


@query("select admissionid, len(l) as n, l[1] as first, l[len(l)] as last from (select admissionid, list(distinct itemid order by itemid) l from listitems group by 1)")
def op_159_sorted_arrays(s, d):
    # A stay's different items are as many as the catalogue's.
    items = table(s, d, "listitems").groupBy("admissionid").agg(F.array_sort(F.collect_set("itemid")).alias("l"))
    return items.select("admissionid", F.size("l").cast("long").alias("n"), F.element_at("l", 1).alias("first"), F.element_at("l", -1).alias("last"))


@query(f"""with {STAYS}, m as (select avg(los) mean, stddev_pop(los) std, count(*) n from (select (dischargedat - admittedat) / 3600000.0 los from stays where admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training'))) where los is not null)
select admissionid, round(case when n >= 10 then (los - mean) / case when std > 0 then std else 1.0 end else los end, 6) as los_scaled from (select admissionid, (dischargedat - admittedat) / 3600000.0 los from stays), m""")
def op_163_static_scaling(s, d):
    a = stays(s, d).withColumn("k", F.lit("los"))
    m = fit.fit_moments(training(a, s, d), "k", "los_hours")
    return fit.scaled(a, m, "k", "los_hours", "z").select("admissionid", F.round("z", 6).alias("los_scaled"))


@query(f"""with {NUMBERS}, a as (select itemid, avg(value) mean, stddev_pop(value) std, sqrt(count(distinct admissionid)) w from numbers group by 1),
p as (select * from a union all select * from (values (41011, 80.0, 15.0, 4.0), (42021, 37.0, 0.7, 4.0)) b(itemid, mean, std, w)), q as (select itemid, sum(w * mean) / sum(w) mean, sum(w * (std * std + mean * mean)) / sum(w) s from p group by 1)
select itemid, round(mean, 4) as mean, round(sqrt(greatest(s - mean * mean, 0)), 3) as std from q""")
def op_167_pooled_with_earlier_fit(s, d):
    rows = numbers(s, d)
    now = rows.groupBy("itemid").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.sqrt(F.countDistinct("admissionid")).alias("w"))
    earlier = s.createDataFrame([(41011, 80.0, 15.0, 4.0), (42021, 37.0, 0.7, 4.0)], "itemid long, mean double, std double, w double")
    return fit.pooled_moments(now.unionByName(earlier), "itemid", "w").select("itemid", F.round("mean", 4).alias("mean"), F.round("std", 3).alias("std"))


@query("""with a as (select distinct subject_id, admissionid, admittedat, dischargedat, dateofdeath from admissions), l as (select *, row_number() over (partition by subject_id order by admittedat desc nulls last, admissionid desc) r, min(dateofdeath) over (partition by subject_id) d from a)
select subject_id, admissionid, coalesce(d <= dischargedat + 86400000, false) as died_this_admission from l where r = 1""")
def op_173_death_on_last_stay(s, d):
    a = table(s, d, "admissions").select("subject_id", "admissionid", "admittedat", "dischargedat", "dateofdeath").distinct()
    last = a.groupBy("subject_id").agg(F.max(F.struct("admittedat", "admissionid", "dischargedat")).alias("l"), F.min("dateofdeath").alias("d"))
    return last.select("subject_id", "l.admissionid", F.coalesce(F.col("d") <= F.col("l.dischargedat") + 86_400_000, F.lit(False)).alias("died_this_admission"))


@query("""select kind, count(distinct token) as n_tokens, count(*) as n_rows from (select 'numeric' as kind, 'N' || itemid || coalesce(unit, '') as token from numericitems union all select 'list', 'L' || itemid || coalesce(cast(valueid as varchar), '') from listitems union all select 'drug', 'D' || itemid from drugitems) group by 1""")
def op_178_inventory_without_events(s, d):
    a = table(s, d, "numericitems").select(F.lit("numeric").alias("kind"), F.concat(F.lit("N"), F.col("itemid").cast("string"), F.coalesce("unit", F.lit(""))).alias("token"))
    b = table(s, d, "listitems").select(F.lit("list").alias("kind"), F.concat(F.lit("L"), F.col("itemid").cast("string"), F.coalesce(F.col("valueid").cast("string"), F.lit(""))).alias("token"))
    e = table(s, d, "drugitems").select(F.lit("drug").alias("kind"), F.concat(F.lit("D"), F.col("itemid").cast("string")).alias("token"))
    return a.unionByName(b).unionByName(e).groupBy("kind").agg(F.countDistinct("token").alias("n_tokens"), F.count("*").alias("n_rows"))


@query("""with t as (select itemid, tag, item, lower(item) l from items) select itemid, tag, (cast(contains(l, 'druk') as integer) + cast(contains(l, 'bloed') as integer) + cast(contains(l, 'freq') as integer)) / 3.0 as score, coalesce(n, 0) as n_rows from t left join (select itemid, count(*) n from numericitems group by 1) using (itemid)""")
def op_185_manifest_candidates(s, d):
    score = x.matched_share(F.lower("item"), ["druk", "bloed", "freq"])
    n = table(s, d, "numericitems").groupBy("itemid").agg(F.count("*").alias("n"))
    return table(s, d, "items").select("itemid", "tag", score.alias("score")).join(n, "itemid", "left").select("itemid", "tag", "score", F.coalesce("n", F.lit(0)).alias("n_rows"))


@query("with i as (select distinct admissionid from admissions where admissionid is not null) select admissionid, cast((row_number() over (order by md5('3:' || admissionid), admissionid) - 1) // 16 as bigint) as batch from i")
def op_124_seeded_batches(s, d):
    ranked, _ = splits._ranked(table(s, d, "admissions"), "admissionid", 3)
    return ranked.select("admissionid", F.floor(F.col("rank") / 16).cast("long").alias("batch"))


@query("with k as (select distinct case when lower(trim(split)) in ('train', 'training') then 'train' else 'test' end as split, admissionid from admissions where admissionid is not null) select split, admissionid from k qualify row_number() over (partition by split order by md5('5:' || admissionid), admissionid) <= 3")
def op_125_samples_of_each_split(s, d):
    k = table(s, d, "admissions").filter("admissionid is not null").select(F.when(F.lower(F.trim("split")).isin("train", "training"), "train").otherwise("test").alias("split"), "admissionid").distinct()
    parts = [k.filter(F.col("split") == name).select("split", "admissionid").orderBy(splits.hash_order(F.col("admissionid"), 5), "admissionid").limit(3) for name in ("train", "test")]
    return parts[0].unionByName(parts[1])
