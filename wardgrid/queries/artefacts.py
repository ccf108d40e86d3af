"""Written datasets, audits of planted faults, policy layers and joint cohorts, each as a query with SQL.

Queries that write do so in the shared checkpoint folder and give what is read back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from wardgrid.operators import anchors, cohort, events, fit, grid, lookups, splits, tokens
from wardgrid.operators.contract import contract
from wardgrid.operators.policies import Manifest, Rule, account, applied
from wardgrid.plans import audits as audit_plans
from wardgrid.plans import joint_dataset, token_pipeline
from wardgrid.queries.aggregates import _GRID_SQL, HOUR, hour_grid
from wardgrid.queries.registry import query
from wardgrid.queries.scans import NUMBER, NUMBERS, STAYS, numbers, stays, training
from wardgrid.queries.timelines import _CODES, _EXPANDED, _IDS, _VOCAB, coded_events
from wardgrid.session import ensure_checkpoint_dir
from wardgrid.sources import evidence, parameters, review, sinks, tensors
from wardgrid.sources.tables import table


def _folder(s) -> str:
    ensure_checkpoint_dir(s)
    return f"{s.sparkContext.getCheckpointDir()}/wardgrid-{uuid.uuid4().hex}"


# Sinks


@query("select cast(coalesce(admissionid % 64, -1) as integer) as part, count(*) as n, count(distinct admissionid) as n_stays from drugitems group by 1")
def op_30_written_by_key(s, d):
    path = _folder(s)
    sinks.write_by_key(table(s, d, "drugitems").select("admissionid", "itemid"), path, "admissionid", 64)
    return s.read.parquet(path).groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("admissionid").alias("n_stays"))


@query("select itemid, count(*) as n from listitems where valueid is not null group by 1")
def op_31_rewritten_from_itself(s, d):
    path = _folder(s)
    sinks.replace(table(s, d, "listitems").select("itemid", "valueid"), path)
    sinks.replace(s.read.parquet(path).filter("valueid is not null"), path)
    return s.read.parquet(path).groupBy("itemid").agg(F.count("*").alias("n"))


_TRAIN = "case when lower(trim(split)) in ('train', 'training') then 'train' else 'test' end"


@query(f"""with {STAYS}, k as (select distinct admissionid, {_TRAIN} as split from admissions where admissionid is not null), sh as (select admissionid, split, (dense_rank() over (partition by split order by admissionid) - 1) // 10 as shard from k),
p as (select distinct subject_id, admissionid from admissions), m as (select subject_id, admissionid, split, shard, (dischargedat - admittedat) / 3600000.0 as hours from p join stays using (admissionid) join sh using (admissionid))
select subject_id, split, count(distinct admissionid) as n_stays, array_to_string(list_sort(list(distinct admissionid)), ';') as stay_ids, array_to_string(list_sort(list(distinct shard)), ';') as shards, round(sum(hours), 6) as hours from m group by all""")
def op_33_metadata_by_person(s, d):
    rows = table(s, d, "admissions").filter("admissionid is not null")
    units = rows.select("admissionid", F.when(F.lower(F.trim("split")).isin("train", "training"), "train").otherwise("test").alias("split"))
    shards = splits.sharded(units, "admissionid", 10)
    people = rows.select("subject_id", "admissionid").distinct().join(stays(s, d), "admissionid")
    return cohort.person_metadata(cohort.stay_metadata(people, shards, "subject_id", "admissionid"), "subject_id", "admissionid").withColumn("hours", F.round("hours", 6))


@query(f"""with {NUMBERS}, m as (select itemid, avg(value) mean, stddev_pop(value) std, count(*) n from numbers where admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training')) and not isinf(value) group by 1)
select numericid, round(case when n is null or n < 10 then value else (value - mean) / case when std > 0 then std else 1.0 end end, 6) as z from numbers left join m using (itemid)""")
def op_35_saved_scalers(s, d):
    path, rows = _folder(s), numbers(s, d)
    parameters.save_fit(s, {"moments": fit.fit_moments(training(rows, s, d), "itemid", "value")}, path, {"least": 10})
    return fit.scaled(rows.select("numericid", "itemid", "value"), parameters.load_fit(s, path)["moments"], "itemid", "value", "z").select("numericid", F.round("z", 6).alias("z"))


@query("""with k as (select itemid, quantile_cont(rate, [0.0, 0.25, 0.5, 0.75, 1.0]) k from drugitems where rate > 0 and not isinf(rate) group by 1), a as (select itemid, k, (unnest(range(8)) + 0.5) / 8 * 4 as x from k)
select itemid, round(k[cast(floor(x) as integer) + 1] + (k[least(cast(floor(x) as integer) + 2, 5)] - k[cast(floor(x) as integer) + 1]) * (x - floor(x)), 6) as value from a""")
def op_167_drawn_from_an_earlier_fit(s, d):
    path = _folder(s)
    parameters.save_fit(s, {"ranks": fit.fit_ranks(table(s, d, "drugitems"), "itemid", "rate", 5)}, path)
    return parameters.drawn_from_knots(parameters.load_fit(s, path)["ranks"], "itemid", 8).withColumn("value", F.round("value", 6))


# Evidence

_N = "cast(null as varchar)"


@query(f"""with c as (select distinct itemid, unitid, item, unit from numericitems where itemid is not null), v as (select distinct itemid, valueid, value from listitems where itemid is not null), o as (select distinct itemid, ordercategoryid, item from drugitems where itemid is not null)
select distinct * from (select 'usagi' as source, 'numericitems' as source_table, cast(itemid as varchar) as itemid, {_N} as valueid, cast(unitid as varchar) as unitid, {_N} as ordercategoryid, itemid || coalesce('-' || unitid, '') as code, nullif(trim(item), '') as label, {_N} as value, case when unitid is null then 'itemid' else 'itemid_unitid' end as keyed_by from c
union all select 'value_map', 'listitems', cast(itemid as varchar), cast(valueid as varchar), null, null, itemid || coalesce('-' || valueid, ''), null, nullif(trim(value), ''), case when valueid is null then 'itemid' else 'itemid_valueid' end from v
union all select 'dictionary', 'drugitems', cast(itemid as varchar), null, null, cast(ordercategoryid as varchar), itemid || coalesce('-' || ordercategoryid, ''), nullif(trim(item), ''), null, case when ordercategoryid is null then 'itemid' else 'itemid_ordercategoryid' end from o
union all select 'old_dictionary', 'numericitems', cast(itemid as varchar), null, cast(unitid as varchar), null, cast(itemid as varchar), nullif(trim(item), ''), null, 'columns' from c
union all select 'context', null, null, null, null, null, null, tag, null, 'label' from items)""")
def op_23_evidence_adapters(s, d):
    number, lists, drugs = (table(s, d, t) for t in ("numericitems", "listitems", "drugitems"))
    code = lambda *ids: F.concat_ws("-", *[F.col(i).cast("string") for i in ids])
    some = lambda df: df.filter("itemid is not null").distinct()
    parts = [
        ("usagi", some(number.select("itemid", "unitid", "item")).select(code("itemid", "unitid").alias("sourceCode"), F.col("item").alias("sourceName")), "x/numericitems_unit.usagi.csv"),
        ("value_map", some(lists.select("itemid", "valueid", "value")).select(code("itemid", "valueid").alias("SOURCE_CODE"), F.lit("XX listitems").alias("SOURCE_VOCABULARY_ID"), F.col("value").alias("VALUE")), ""),
        ("dictionary", some(drugs.select("itemid", "ordercategoryid", "item")).select(code("itemid", "ordercategoryid").alias("source_code"), F.lit("XX drugitems").alias("source_vocabulary_id"), F.col("item").alias("source_code_description")), ""),
        ("old_dictionary", some(number.select("itemid", "unitid", "item")).withColumn("table", F.lit("numericitems")), ""),
        ("context", table(s, d, "items").select(F.col("tag").alias("label")), ""),
    ]
    return evidence.all_evidence(parts).select("source", "source_table", "itemid", "valueid", "unitid", "ordercategoryid", "code", "label", "value", "keyed_by").distinct()


# Events and tokens over all tables

_EVENTS = f"""{STAYS}, rr as (select admissionid, row_number() over (order by md5('0:' || admissionid), admissionid) - 1 as rank, count(*) over () n from stays),
sp as (select admissionid, case when rank < round_even(n * 0.7, 0) then 'train' when rank < round_even(n * 0.7, 0) + round_even(n * 0.15, 0) then 'val' else 'test' end as split from rr),
nv as (select admissionid, itemid, unit, measuredat, {NUMBER} as value from numericitems),
tl as (select itemid, unit, list(value order by value) v from nv where value is not null and not isinf(value) and admissionid in (select admissionid from sp where split = 'train') group by all),
tb as (select itemid, unit, list_transform(range(1, 10), lambda i: v[((len(v) - 1) * 2 * i + 10) // 20 + 1]) q from tl),
al as (select nv.admissionid, nullif(measuredat, -1899) as time, 'NUM//' || nv.itemid || '//' || coalesce(nullif(trim(nv.unit), ''), 'NONE') || '//Q' || (1 + len(list_filter(q, lambda e: value > e))) as code, 'numericitems' as source,
    case when value is null then 'no value' when measuredat is null or measuredat = -1899 then 'unknown time' when q is null then 'no bounds' end as excluded from nv left join tb on nv.itemid = tb.itemid and nv.unit is not distinct from tb.unit
  union all select admissionid, nullif(measuredat, -1899), 'LIST//' || itemid || '//' || coalesce(cast(valueid as varchar), 'NONE'), 'listitems', case when measuredat is null or measuredat = -1899 then 'unknown time' end from listitems
  union all select admissionid, nullif(case e when '//START' then start else stop end, -1899), 'DRUG//' || itemid || e, 'drugitems', case when start is null or stop is null or start = -1899 or stop = -1899 then 'unknown time' when stop < start then 'reversed interval' end from drugitems, (values ('//START'), ('//END')) v(e)
  union all select admissionid, admittedat, 'ADMISSION', 'admissions', null from stays where admittedat is not null union all select admissionid, dischargedat, 'DISCHARGE', 'admissions', null from stays where dischargedat is not null),
cl as (select al.admissionid, time, code, source, coalesce(excluded, case when st.admissionid is null then 'no stay' when time < admittedat or (time <= dischargedat or dischargedat is null) and admittedat is not null then null else 'out of phase' end) as excluded from al left join stays st on st.admissionid = al.admissionid)"""


def _classified(s, d):
    return token_pipeline.classified_events(table(s, d, "numericitems"), table(s, d, "listitems"), table(s, d, "drugitems"), table(s, d, "admissions"))


@query(f"with {_EVENTS} select source, excluded, count(*) as n from cl group by all")
def op_36_exclusions(s, d):
    return token_pipeline.event_audits(_classified(s, d))["exclusions"]


@query(f"with {_EVENTS} select admissionid, count(*) as n from cl where excluded is null group by 1")
def op_36_written_events(s, d):
    path = _folder(s)
    token_pipeline.write_events(_classified(s, d), path, debug=False)
    return s.read.parquet(f"{path}/events").groupBy("admissionid").agg(F.count("*").alias("n"))


@query(f"with {_EVENTS} select code, count(*) as n from cl where excluded is null group by 1 order by n desc, code limit 100")
def op_36_top_codes(s, d):
    return token_pipeline.event_audits(_classified(s, d))["top_codes"]


_PIPELINE_CODES = "e as (select admissionid, time as t, code from cl where excluded is null)"
_PIPELINE_VOCAB = _VOCAB.replace("(select admissionid from admissions where lower(trim(split)) in ('train', 'training'))", "(select admissionid from sp where split = 'train')")


@query(f"with {_EVENTS}, {_EXPANDED.replace(_CODES, _PIPELINE_CODES)}, {_PIPELINE_VOCAB} select split, x.token, coalesce(v.id, (select id from v where token = 'UNK')) as id, count(*) as n from x join sp using (admissionid) left join v using (token) group by all")
def token_pipeline_counts(s, d):
    """Tokens of all timelines by split, with their ids."""
    ids, _ = token_pipeline.build_tokens(_classified(s, d).filter("excluded is null").select("admissionid", "split", "time", "code"))
    return ids.groupBy("split", "token", "id").agg(F.count("*").alias("n"))


@query(f"""with {_EXPANDED}, {_VOCAB}, tk as (select admissionid, admissionid % 4 as shard, seq, time, coalesce(v.id, (select id from v where token = 'UNK')) as id from x left join v using (token)),
tp as (select *, row_number() over (partition by shard order by admissionid, seq) - 1 as place from tk), tf as (select *, row_number() over (partition by shard order by admissionid) - 1 as nth from tp where seq = 0)
select shard, 'tokens' as tensor, place, id as value from tp union all select shard, 'times', place, time from tp union all select shard, 'timelines', nth, admissionid from tf union all select shard, 'offsets', nth, place from tf""")
def op_37_tensor_files(s, d):
    t = tokens.expanded(coded_events(s, d), ["admissionid"], "t", "code")
    ids = tokens.numbered(t, tokens.vocabulary(training(t, s, d))).withColumn("shard", F.col("admissionid") % 4)
    path = _folder(s)
    # The write is an action of its own; what it tells is counted and put aside.
    tensors.write_tensors(ids, path, ["admissionid"], {"tokens": "id", "times": "time"}, per_timeline={"timelines": "admissionid"}).write.parquet(f"{path}-files")
    return tensors.read_tensors(s, path)


@query("""select case when lower(trim(split)) in ('train', 'training') then 'train' else 'rest' end as split, count(*) as n, count(distinct numericid) as n_ids from numericitems join (select admissionid, max(split) split from admissions where admissionid is not null group by 1) using (admissionid) group by 1""")
def op_28_written_by_split(s, d):
    path = _folder(s)
    of = table(s, d, "admissions").filter("admissionid is not null").groupBy("admissionid").agg(F.max("split").alias("split"))
    of = of.select("admissionid", F.when(F.lower(F.trim("split")).isin("train", "training"), "train").otherwise("rest").alias("split"))
    sinks.write_by_split(table(s, d, "numericitems").select("numericid", "admissionid").join(of, "admissionid"), path, rows_per_file=5000)
    return s.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("numericid").alias("n_ids"))


@query("select tag, itemid, unit, n, place from (select tag, itemid, unit, n, cast(row_number() over (partition by tag order by n desc, itemid nulls last, unit nulls last) as integer) as place from (select tag, itemid, unit, count(*) as n from numericitems group by all)) where place <= 20")
def op_41_candidate_examples(s, d):
    found = table(s, d, "numericitems").groupBy("tag", "itemid", "unit").agg(F.count("*").alias("n"))
    return review.examples(found, "tag", "n", ["itemid", "unit"])


# Stays

_EPOCHS = {"0": datetime(2003, 1, 1), "1": datetime(2010, 1, 1)}


@query("""select patientid as subject_id, admissionid as hadm_id, admissionid as stay_id, 'own' as source_dataset, case urgency when 0 then timestamp '2003-01-01' when 1 then timestamp '2010-01-01' end + to_microseconds(nullif(admittedat, -1899) * 1000) as admitted,
case urgency when 0 then timestamp '2003-01-01' when 1 then timestamp '2010-01-01' end + to_microseconds(nullif(dischargedat, -1899) * 1000) as discharged, (dischargedat - admittedat) / 3600000.0 as los_hours from admissions""")
def op_17_admission_table(s, d):
    out = anchors.admission_table(table(s, d, "admissions"), "patientid", "admissionid", "urgency", _EPOCHS, {"admittedat": "admitted", "dischargedat": "discharged"}, "own")
    return out.select("subject_id", "hadm_id", "stay_id", "source_dataset", "admitted", "discharged", "los_hours")


@query(f"with {STAYS}, o as (select admissionid, row_number() over (order by (dischargedat - admittedat), admissionid) - 1 as r, count(*) over () as n from stays where dischargedat is not null and admittedat is not null) select admissionid from o where n <= 12 or r = floor((floor(r * 12 / n) + 0.5) * n / 12)")
def op_116_stays_of_all_lengths(s, d):
    return anchors.spread_sample(stays(s, d), "admissionid", "los_hours", 12).select("admissionid")


@query(f"with {NUMBERS} select itemid, round(avg(case when value = 1 then 1.0 else 0.0 end), 6) as on_rate, count(distinct admissionid) as n_stays from numbers join items using (itemid) where valuetype = 'flag' group by 1")
def op_91k_on_rate(s, d):
    flags = table(s, d, "items").filter("valuetype = 'flag'").select("itemid")
    return numbers(s, d).join(flags, "itemid", "left_semi").groupBy("itemid").agg(F.round(F.avg((F.col("value") == 1).cast("double")), 6).alias("on_rate"), F.countDistinct("admissionid").alias("n_stays"))


@query("with n as (select coalesce(origin, '') as cohort, count(distinct admissionid) as n from admissions group by 1) select cohort, n, round(sqrt(n) / sum(sqrt(n)) over (), 9) as weight from n")
def op_164_cohort_weights(s, d):
    sizes = table(s, d, "admissions").groupBy(F.coalesce("origin", F.lit("")).alias("cohort")).agg(F.countDistinct("admissionid").alias("n"))
    return fit.cohort_weight_table(sizes).withColumn("weight", F.round("weight", 9))


# Order


@query("select itemid, valueid, measuredat, admissionid, row_number() over (order by measuredat nulls last, admissionid nulls last, itemid nulls last, valueid nulls last) - 1 as row from listitems")
def op_96_row_index(s, d):
    return events.row_index(table(s, d, "listitems").select("itemid", "valueid", "measuredat", "admissionid"), ["measuredat", "admissionid", "itemid", "valueid"], 16).withColumn("row", F.col("row").cast("long"))


@query("select itemid, tag, item, valuetype, target_unit, target_unitid, physmin, physmax, measured, cadence_ms from items")
def op_60_columns_in_order(s, d):
    return grid.in_order(table(s, d, "items"), ["itemid", "tag", "item", "valuetype", "target_unit", "target_unitid", "physmin", "physmax", "measured", "cadence_ms"])


# Joint cohorts

_COHORTS = f"""{_IDS.replace("'7:'", "'0:'")}, sp as (select admissionid, case when rank < round_even(n * 0.7, 0) then 'train' when rank < round_even(n * 0.7, 0) + round_even(n * 0.15, 0) then 'val' else 'test' end as split from r), {NUMBERS},
g as (select admissionid, {HOUR} as hour, count(*) as n, max(value) as top from numbers where admission_relative_ms >= 0 group by all), ur as (select admissionid, max(urgency) u from admissions where admissionid is not null group by 1),
j as (select case when u = 1 then 'urgent' else 'planned' end as cohort, case when u = 1 then 'urgent' else 'planned' end || '_' || g.admissionid as admissionid, g.admissionid as native_admissionid, split, hour, g.n, case when u = 1 then top else -1.0 end as top from g join sp using (admissionid) join ur using (admissionid)),
sh as (select admissionid, (dense_rank() over (partition by split order by admissionid) - 1) // 5 as shard from (select distinct split, admissionid from j))"""


def _joint(s, d):
    rows = numbers(s, d).filter("admission_relative_ms >= 0").groupBy("admissionid", F.floor(F.col("admission_relative_ms") / 3_600_000).cast("long").alias("hour")).agg(F.count("*").alias("n"), F.max("value").alias("top"))
    rows = rows.join(splits.rounded_split(table(s, d, "admissions"), "admissionid", {"train": 0.7, "val": 0.15, "test": 0.15}, 0), "admissionid")
    kind = table(s, d, "admissions").groupBy("admissionid").agg(F.max("urgency").alias("u"))
    of = lambda cond: rows.join(kind.filter(cond), "admissionid", "left_semi")
    return {"urgent": of("u = 1"), "planned": of("u is null or u <> 1").drop("top")}


@query(f"with {_COHORTS} select j.*, shard from j join sh using (admissionid)")
def op_184_joint_grid(s, d):
    both = joint_dataset.joint_grid(_joint(s, d), "admissionid", fill={"top": -1.0})
    return both.join(joint_dataset.joint_shards(both, "admissionid", 5).drop("split"), "admissionid")


@query(f"with {_COHORTS} select cohort, split, count(*) as n_rows, count(distinct j.admissionid) as n_keys, count(distinct shard) as n_shards from j join sh using (admissionid) group by all")
def op_40_joint_dataset(s, d):
    path = _folder(s)
    joint_dataset.write_joint(_joint(s, d), path, "admissionid", "hour", 5, fill={"top": -1.0})
    return joint_dataset.joint_audit(s.read.parquet(f"{path}/data"), "admissionid")


# Policy layers and the contract

# What the layers decide on: (name, divisor, remainder of the item's number, field, SQL of its value).
_DECISIONS = (
    ("curated", 3, 0, "target", "'curated//' || tag"), ("keep_drop", 5, 1, "emit", "'no'"), ("contaminated", 7, 2, "target", "null"), ("targeted", 4, 3, "target", "'OMOP//' || itemid"), ("device", 9, 4, "role", "'device'"),
    ("admission", 11, 5, "emit", "'YES'"), ("medication", 6, 2, "target", "'0'"), ("listed", 8, 7, "role", "'listed'"), ("laboratory", 10, 6, "target", "'LAB//' || tag"),
)
_RULES = (
    ("zero_sentinel", "target = '0'", {"target": "''", "emit": "'false'"}),
    ("namespace", "starts_with(target, 'OMOP//')", {"target": "'CONCEPT//' || substr(target, 7)"}),
    ("lab_role", "starts_with(target, 'LAB//')", {"role": "'dynamic_event/lab'"}),
    ("components", "tag in ('coma', 'sed')", {"role": "'dynamic_event/score_component'", "emit": "'true'"}),
    ("scores", "tag = 'kwets'", {"emit": "'false'", "role": "'score'"}),
)
_BASE = "b as (select 'NUM//' || itemid as token, itemid, tag, n, tag as target, case when measured then 'true' else 'false' end as emit, cast(null as varchar) as role from (select itemid, count(*) n from numericitems group by 1) join items using (itemid))"


def _layers_sql() -> str:
    """s0, s1, ...: the state after each layer, and what it changed."""
    steps, fields = [f"{_BASE}, s0 as (select *, cast([] as varchar[]) as changed from b)"], ("target", "emit", "role")
    layers = [(name, f"itemid % {k} = {r}", {f: v}) for name, k, r, f, v in _DECISIONS[:8]] + [_RULES[0]] + [(name, f"itemid % {k} = {r}", {f: v}) for name, k, r, f, v in _DECISIONS[8:]] + list(_RULES[1:])
    for i, (name, where, sets) in enumerate(layers):
        new = {f: f"case when coalesce({where}, false) then {sets[f]} else {f} end" if f in sets else f for f in fields}
        differs = " or ".join(f"{f} is distinct from ({new[f]})" for f in sets)
        steps.append(f"s{i + 1} as (select token, itemid, tag, n, {', '.join(f'{v} as {f}' for f, v in new.items())}, case when {differs} then list_append(changed, '{name}') else changed end as changed from s{i})")
    return ", ".join(steps)


_N_LAYERS = len(_DECISIONS) + len(_RULES)


def _policies(s, d):
    items = table(s, d, "items")
    state = table(s, d, "numericitems").groupBy("itemid").agg(F.count("*").alias("n")).join(items.select("itemid", "tag", "measured"), "itemid")
    state = state.select(F.concat(F.lit("NUM//"), F.col("itemid").cast("string")).alias("token"), "itemid", "tag", "n", F.col("tag").alias("target"), F.when(F.col("measured"), "true").otherwise("false").alias("emit"), F.lit(None).cast("string").alias("role"))
    decided = {
        "curated": F.concat(F.lit("curated//"), "tag"), "keep_drop": F.lit("no"), "contaminated": F.lit(None).cast("string"), "targeted": F.concat(F.lit("OMOP//"), F.col("itemid").cast("string")), "device": F.lit("device"),
        "admission": F.lit("YES"), "medication": F.lit("0"), "listed": F.lit("listed"), "laboratory": F.concat(F.lit("LAB//"), "tag"),
    }
    manifests = [Manifest(name, items.filter(F.col("itemid") % k == r).select(F.concat(F.lit("NUM//"), F.col("itemid").cast("string")).alias("token"), decided[name].alias(f)), (f,)) for name, k, r, f, _ in _DECISIONS]
    target, tag = F.col("target"), F.col("tag")
    rules = [
        Rule("zero_sentinel", target == "0", {"target": F.lit(""), "emit": F.lit("false")}),
        Rule("namespace", target.startswith("OMOP//"), {"target": F.concat(F.lit("CONCEPT//"), F.substring(target, 7, 1000))}),
        Rule("lab_role", target.startswith("LAB//"), {"role": F.lit("dynamic_event/lab")}),
        Rule("components", tag.isin("coma", "sed"), {"role": F.lit("dynamic_event/score_component"), "emit": F.lit("true")}),
        Rule("scores", tag == "kwets", {"emit": F.lit("false"), "role": F.lit("score")}),
    ]
    layers = [*manifests[:8], rules[0], manifests[8], *rules[1:]]
    return applied(state, layers, "token"), layers


@query(f"with {_layers_sql()} select token, n, target, emit, role, array_to_string(changed, ',') as changed from s{_N_LAYERS}")
def op_176_policy_layers(s, d):
    state, _ = _policies(s, d)
    return state.select("token", "n", "target", "emit", "role", F.array_join("changed", ",").alias("changed"))


@query(f"with {_layers_sql()}, u as (select unnest(changed) as layer from s{_N_LAYERS}), l(place, layer) as (values {', '.join(f'({i}, {chr(39)}{name}{chr(39)})' for i, name in enumerate([*(x[0] for x in _DECISIONS[:8]), _RULES[0][0], _DECISIONS[8][0], *(x[0] for x in _RULES[1:])]))}) select place, layer, count(u.layer) as n from l left join u using (layer) group by all")
def op_176_policy_account(s, d):
    return account(*_policies(s, d))


# Faults planted into a vocabulary of the items: field -> (SQL of the condition, SQL of the value).
_FAULTS = """f as (select 'NUM//' || itemid as token, cast(itemid as varchar) as itemid, case when itemid = 42021 then ' ' when itemid = 44062 then 'OMOP//9' else tag end as target, case when itemid = 42022 then null when itemid = 44063 then 'lab' else 'signal' end as role,
  case when itemid = 45082 then 'no' else 'Yes' end as emit, case when itemid = 44065 then '0.0' when itemid = 44066 then '999' else cast(target_unitid as varchar) end as concept, case when itemid = 44067 then 'other' else item end as label from items where itemid <> 45084
  union all select 'NUM//' || itemid, cast(itemid as varchar), tag, 'signal', 'true', '305', item from items where itemid = 41011 union all select '', '1', 'x', 'signal', 'true', '305', 'x' union all select 'LAB//1', '2', 'x', 'signal', '1', '305', 'x'),
s as (select 'NUM//' || itemid as token, cast(itemid as varchar) as itemid, item as label from items), e as (select *, lower(trim(coalesce(emit, ''))) in ('true', '1', 'yes') as em from f),
m as (select token, count(*) c, min(itemid) i, min(label) l from f group by 1), j as (select m.c fc, s.c sc, m.i <> s.i as di, m.l <> s.l as dl from m full join (select token, count(*) c, min(itemid) i, min(label) l from s group by 1) s using (token))"""
_BROKEN = {
    "empty token": "token = ''", "emitted without target": "em and trim(coalesce(target, '')) = ''", "emitted without role": "em and trim(coalesce(role, '')) = ''", "emitted in a legacy namespace": "em and starts_with(target, 'OMOP//')", "emitted of a kind that never is": "em and target = 'prone'",
    "LAB// without lab": "em and starts_with(token, 'LAB//') and coalesce(role, '') <> 'lab'", "lab without LAB//": "role = 'lab' and not starts_with(token, 'LAB//')", "withheld": "target = 'sed' and not em", "emitted with concept 0": "em and concept in ('0', '0.0')", "emitted with an unknown concept": r"em and regexp_full_match(regexp_replace(concept, '\.0$', ''), '[0-9]+') and regexp_replace(concept, '\.0$', '') not in (select cast(unitid as varchar) from units)",
}


@query(
    f"with {_FAULTS} "
    + " union all ".join(f"select '{rule}' as rule, count(*) filter ({cond}) as n from e" for rule, cond in _BROKEN.items())
    + " union all select 'lost', count(*) filter (fc is null) from j union all select 'added', count(*) filter (sc is null) from j union all select 'changed itemid', count(*) filter (di) from j union all select 'changed label', count(*) filter (dl) from j union all select 'repeated token', cast(sum(c - 1) as bigint) from m"
)
def op_177_vocabulary_contract(s, d):
    items = table(s, d, "items")
    token = F.concat(F.lit("NUM//"), F.col("itemid").cast("string"))
    is_ = lambda i: F.col("itemid") == i
    good = items.select(
        token.alias("token"), F.col("itemid").cast("string").alias("itemid"), F.when(is_(42021), " ").when(is_(44062), "OMOP//9").otherwise(F.col("tag")).alias("target"), F.when(is_(42022), None).when(is_(44063), "lab").otherwise("signal").alias("role"),
        F.when(is_(45082), "no").otherwise("Yes").alias("emit"), F.when(is_(44065), "0.0").when(is_(44066), "999").otherwise(F.col("target_unitid").cast("string")).alias("concept"), F.when(is_(44067), "other").otherwise(F.col("item")).alias("label"),
    ).filter("itemid <> '45084'")
    more = items.filter(is_(41011)).select(token, F.col("itemid").cast("string"), "tag", F.lit("signal"), F.lit("true"), F.lit("305"), "item").toDF(*good.columns)
    odd = s.createDataFrame([("", "1", "x", "signal", "true", "305", "x"), ("LAB//1", "2", "x", "signal", "1", "305", "x")], good.schema)
    source = items.select(token.alias("token"), F.col("itemid").cast("string").alias("itemid"), F.col("item").alias("label"))
    concepts = table(s, d, "units").select(F.col("unitid").alias("concept"))
    return contract(source, good.unionByName(more).unionByName(odd), "token", "emit", "target", "role", ["itemid", "label"], concepts, "concept", F.col("target") == "prone", ["OMOP//"], {"LAB//": "lab"}, F.col("target") == "sed")


# Audits that are shown broken rows

_PLANTED = f"""{_GRID_SQL}, h as (select admissionid, hour, case when hour = 1 and admissionid % 5 = 0 then null when hour = 2 and admissionid % 11 = 0 then 'test' else 'train' end as split,
  case when hour = 4 and admissionid % 3 = 0 then 'nan'::double when hour = 4 and admissionid % 3 = 1 then 'inf'::double else pulse end as pulse, case when hour = 5 and admissionid % 2 = 0 then 2 when hour = 5 and admissionid % 7 = 0 then null else cast(pulse is not null as integer) end as mask,
  cast(hour % 2 = 0 as integer) as a, cast(hour % 2 = 1 or hour % 10 = 6 as integer) as b from g where not (hour = 3 and admissionid % 13 = 0)),
q as (select * from h union all select * from h where hour = 0 and admissionid % 7 = 0)"""


@query(f"""with {_PLANTED}, k as (select admissionid, hour, count(*) c from q group by all), l as (select admissionid, count(*) n, count(distinct hour) u, min(hour) lo, max(hour) hi, count(distinct split) s from q group by 1)
select 'no split' as rule, count(*) filter (split is null) as n from q union all select 'pulse not finite', count(*) filter (pulse is not null and (isnan(pulse) or isinf(pulse))) from q union all select 'pulse mask', count(*) filter (coalesce(mask not in (0, 1), true)) from q
union all select 'a ... not exclusive', count(*) filter (a + b <> 1) from q union all select 'repeated keys', count(*) filter (c > 1) from k union all select 'several splits', count(*) filter (s > 1) from l union all select 'holes in hours', count(*) filter (n <> u or lo <> 0 or hi <> n - 1) from l""")
def op_179_grid_audit(s, d):
    a, h = F.col("admissionid"), F.col("hour")
    g = hour_grid(s, d).filter(~((h == 3) & (a % 13 == 0))).select(
        "admissionid", "hour", F.when((h == 1) & (a % 5 == 0), None).when((h == 2) & (a % 11 == 0), "test").otherwise("train").alias("split"),
        F.when((h == 4) & (a % 3 == 0), float("nan")).when((h == 4) & (a % 3 == 1), float("inf")).otherwise(F.col("pulse")).alias("pulse"),
        F.when((h == 5) & (a % 2 == 0), 2).when((h == 5) & (a % 7 == 0), None).otherwise(F.col("pulse").isNotNull().cast("int")).alias("pulse__observed"),
        (h % 2 == 0).cast("int").alias("a"), ((h % 2 == 1) | (h % 10 == 6)).cast("int").alias("b"),
    )
    return audit_plans.audit_grid(g.unionByName(g.filter((h == 0) & (a % 7 == 0))), ["pulse"], [["a", "b"]])


_QUANTILE = "regexp_full_match({}, 'Q([1-9]|10)')"


@query(f"""with {_EXPANDED}, {_VOCAB}, y as (select admissionid, seq, token, time, id, count(*) over (partition by admissionid) as len from x left join v using (token)),
z as (select admissionid, case when seq = len - 1 and admissionid % 7 = 0 then seq + 1000 else seq end as seq, case when seq = 1 and admissionid % 4 = 0 then 'Q3' when seq = 2 and admissionid % 6 = 0 then 'Q4' when seq = 0 and admissionid % 9 = 0 then 'TIMELINE_END' else token end as token,
  case when seq = 3 and admissionid % 3 = 0 then time - 1000000000000 else time end as time, case when seq = 2 and admissionid % 5 = 0 then null when seq = 3 and admissionid % 5 = 1 then 1000000 else coalesce(id, 0) end as id, seq as at, len from y where not (seq = len - 1 and admissionid % 11 = 0)),
w as (select *, lag(token) over o b, lag(time) over o t, lead(token) over o nx, row_number() over o - 1 as nth from z window o as (partition by admissionid order by seq))
select 'id out of range' as rule, count(*) filter (id is null or id < 0 or id >= (select count(*) from v)) as n from w union all select 'place', count(*) filter (seq <> nth) from w union all select 'time goes back', count(*) filter (time < t) from w
union all select 'quantile without code', count(*) filter ({_QUANTILE.format('token')} and (b is null or {_QUANTILE.format('b')})) from w union all select 'end not last', count(*) filter (token = 'TIMELINE_END' and nx is not null) from w union all select 'no end', count(*) filter (nx is null and token <> 'TIMELINE_END') from w""")
def op_181_token_audit(s, d):
    t = tokens.expanded(coded_events(s, d), ["admissionid"], "t", "code")
    vocabulary = tokens.vocabulary(training(t, s, d))
    a, q, n = F.col("admissionid"), F.col("seq"), F.count("*").over(Window.partitionBy("admissionid"))
    rows = lookups.null_safe(t, vocabulary.select("token", "id"), ["token"], "left").withColumn("len", n)
    last = q == F.col("len") - 1
    planted = rows.filter(~(last & (a % 11 == 0))).select(
        "admissionid", F.when(last & (a % 7 == 0), q + 1000).otherwise(q).alias("seq"), F.when((q == 1) & (a % 4 == 0), "Q3").when((q == 2) & (a % 6 == 0), "Q4").when((q == 0) & (a % 9 == 0), "TIMELINE_END").otherwise(F.col("token")).alias("token"),
        F.when((q == 3) & (a % 3 == 0), F.col("time") - 1_000_000_000_000).otherwise(F.col("time")).alias("time"), F.when((q == 2) & (a % 5 == 0), None).when((q == 3) & (a % 5 == 1), 1_000_000).otherwise(F.coalesce("id", F.lit(0))).alias("id"),
    )
    return audit_plans.audit_tokens(planted, vocabulary.count())
