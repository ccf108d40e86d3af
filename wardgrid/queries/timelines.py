"""Splits, sets, scalar functions, token timelines, fitted parameters, audits and cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardgrid.functions import columns as x
from wardgrid.operators import audits, events, fit, grid, joint, lookups, quality, splits, tokens
from wardgrid.queries.aggregates import _GRID_SQL, HOUR, TAGS, hour_grid
from wardgrid.queries.registry import query
from wardgrid.queries.scans import NUMBERS, STAYS, numbers, stays, training
from wardgrid.sources.tables import table

# Splits and samples

_IDS = "i as (select distinct admissionid from admissions where admissionid is not null), r as (select admissionid, row_number() over (order by md5('7:' || admissionid), admissionid) - 1 as rank, count(*) over () n from i)"


@query(f"with {_IDS} select admissionid from r where rank < 20")
def op_119_seeded_sample(s, d):
    return splits.sample(table(s, d, "admissions"), "admissionid", 20, 7)


@query("select distinct admissionid from admissions where admissionid is not null order by admissionid limit 25")
def op_120_first_ids(s, d):
    return splits.first_ids(table(s, d, "admissions"), "admissionid", 25)


@query(f"with {_IDS} select admissionid, case when rank < round_even(n * 0.7, 0) then 'train' when rank < round_even(n * 0.7, 0) + round_even(n * 0.15, 0) then 'val' else 'test' end as split from r")
def op_122_rounded_split(s, d):
    return splits.rounded_split(table(s, d, "admissions"), "admissionid", {"train": 0.7, "val": 0.15, "test": 0.15}, 7)


@query(f"""with {_IDS}, f as (select max(n) n, floor(max(n) * 0.7) a, floor(max(n) * 0.15) b from r), m as (select n - a - 2 * b as over, n * 0.7 - a ra, n * 0.15 - b rb, a, b from f),
k as (select a + case when ra >= rb then least(over, 1) when over > 2 then 1 else 0 end a, b + case when ra >= rb then case when over >= 2 then 1 else 0 end else case when over >= 1 then 1 else 0 end end b from m)
select admissionid, case when rank < k.a then 'train' when rank < k.a + k.b then 'val' else 'test' end as split from r, k""")
def op_123_largest_remainder_split(s, d):
    return splits.largest_remainder_split(table(s, d, "admissions"), "admissionid", {"train": 0.7, "val": 0.15, "test": 0.15}, 7)


@query("select admissionid, split, cast((dense_rank() over (partition by split order by admissionid) - 1) // 10 as bigint) as shard from (select distinct admissionid, case when lower(trim(split)) in ('train', 'training') then 'train' else 'test' end as split from admissions)")
def op_27_shards(s, d):
    units = table(s, d, "admissions").select("admissionid", F.when(F.lower(F.trim("split")).isin("train", "training"), "train").otherwise("test").alias("split"))
    return splits.sharded(units, "admissionid", 10)


# Orders, limits and sets


@query("select itemid, count(*) as n from numericitems group by 1 order by n desc, itemid limit 15")
def op_118_top_items(s, d):
    return table(s, d, "numericitems").groupBy("itemid").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "itemid").limit(15)


@query("select admissionid, itemid, valueid, measuredat, cast(row_number() over (partition by admissionid order by measuredat nulls last, itemid nulls last, valueid nulls last, registeredat nulls last, registeredby nulls last, updatedat nulls last, updatedby nulls last) - 1 as bigint) as seq from listitems")
def op_117_event_order(s, d):
    return events.ordered(table(s, d, "listitems"), ["admissionid"], ["measuredat", "itemid", "valueid", "registeredat", "registeredby", "updatedat", "updatedby"]).select("admissionid", "itemid", "valueid", "measuredat", "seq")


@query("select admissionid, itemid, 'n' as source from numericitems union all select admissionid, itemid, 'l' from listitems")
def op_126_union_all(s, d):
    a = table(s, d, "numericitems").select("admissionid", "itemid", F.lit("n").alias("source"))
    return a.unionByName(table(s, d, "listitems").select("admissionid", "itemid", F.lit("l").alias("source")))


@query("select admissionid, itemid, value, valueid from listitems union all select admissionid, itemid, null, null from drugitems")
def op_127_union_by_name(s, d):
    return table(s, d, "listitems").select("admissionid", "itemid", "value", "valueid").unionByName(table(s, d, "drugitems").select("admissionid", "itemid"), allowMissingColumns=True)


@query("select distinct itemid, unit, unitid from numericitems")
def op_128_distinct(s, d):
    return table(s, d, "numericitems").select("itemid", "unit", "unitid").distinct()


@query("select admissionid, count(*) as n_tables from (select distinct admissionid, 0 from numericitems union all select distinct admissionid, 1 from listitems union all select distinct admissionid, 2 from drugitems) group by 1 having count(*) > 1")
def op_129_shared_ids(s, d):
    return audits.collisions([table(s, d, t) for t in ("numericitems", "listitems", "drugitems")], "admissionid")


@query("select admissionid from numericitems where admissionid is not null except select admissionid from drugitems")
def op_130_difference(s, d):
    return table(s, d, "numericitems").select("admissionid").filter("admissionid is not null").distinct().join(table(s, d, "drugitems").select("admissionid").distinct(), "admissionid", "left_anti")


@query("select distinct code from (select 'N//' || itemid as code from numericitems union select 'L//' || itemid from listitems union select 'D//' || itemid from drugitems)")
def op_131_code_union(s, d):
    parts = [table(s, d, t).select(F.concat(F.lit(p), F.col("itemid").cast("string")).alias("code")) for p, t in (("N//", "numericitems"), ("L//", "listitems"), ("D//", "drugitems"))]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


# Scalar functions


@query("select numericid, cast(floor(admission_relative_ms / 3600000.0) as bigint) as hour, cast(floor(admission_relative_ms / 86400000.0) as bigint) as day from numericitems")
def op_134_floor_bucket(s, d):
    ms = F.col("admission_relative_ms")
    return table(s, d, "numericitems").select("numericid", x.bucket(ms).alias("hour"), x.bucket(ms, 24 * x.HOUR_MS).alias("day"))


@query("select numericid, cast(ceil(value) as bigint) as up, cast(floor(value) as bigint) as down, cast(round(value) as bigint) as near from numericitems where abs(value) < 9e18 and not isnan(value)")
def op_135_rounding(s, d):
    v = F.col("value")
    return numbers(s, d).filter("abs(value) < 9e18").select("numericid", F.ceil(v).cast("long").alias("up"), F.floor(v).cast("long").alias("down"), F.round(v).cast("long").alias("near"))


_RULES = [(42025, False, 999.0, False, 18.0, None, 20.0, 600.0), (43041, False, None, True, None, None, 20.0, 100.0), (42021, False, 0.0, False, 1.8, 32.0, None, None), (46096, True, None, False, None, None, None, None), (41011, False, None, False, None, None, 20.0, 250.0)]
_RULES_SQL = "(values " + ", ".join("(" + ", ".join("null" if v is None else str(v).lower() for v in r) + ")" for r in _RULES) + ") c(itemid, exclude, sentinel, percent, a, b, low, high)"


@query(f"""with {NUMBERS}, k as (select n.*, c.* exclude (itemid), c.itemid is not null as has from numbers n left join {_RULES_SQL} on n.itemid = c.itemid),
m as (select numericid, itemid, (case when coalesce(percent, false) and value >= 0 and value <= 1.5 then value * 100 else value end) * coalesce(a, 1.0) + coalesce(b, 0.0) as value, low, high from k where not coalesce(exclude, false) and not coalesce(value = sentinel, false))
select numericid, itemid, round(value, 6) as value from m where (low is null and high is null) or (value >= coalesce(low, value) and value <= coalesce(high, value))""")
def op_169_corrections(s, d):
    rules = s.createDataFrame(_RULES, "itemid long, exclude boolean, sentinel double, percent boolean, a double, b double, low double, high double")
    return quality.corrected(numbers(s, d).select("numericid", "itemid", "value"), rules, "itemid", "value").withColumn("value", F.round("value", 6))


@query("select numericid, case when value >= 0 and value <= 1.5 then value * 100 else value end as percent from numericitems where itemid = 43041 and value is not null and not isnan(value)")
def op_137_fraction_percent(s, d):
    return numbers(s, d).filter("itemid = 43041").select("numericid", x.fraction_to_percent(F.col("value")).alias("percent"))


@query("""select admissionid, orderid, itemid, start, round(case when iscontinuous = 1 and isadditive = 0 then rate when duration > 0 then dose / duration * case when iscontinuous = 1 then 1 when isadditive = 0 then 60 else 1000 end end * case when isconditional = 1 then 0.5 else 1.0 end, 6) as rate from drugitems""")
def op_138_rate_formulas(s, d):
    steady, added = F.col("iscontinuous") == 1, F.col("isadditive") == 0
    rows = table(s, d, "drugitems").withColumns({"formula": F.when(steady & added, "raw").when(steady, "per_minute").when(added, "per_hour").otherwise("milli_per_minute"), "factor": F.when(F.col("isconditional") == 1, 0.5).otherwise(F.lit(None))})
    out = quality.rated(rows, "rate", "dose", "duration", "formula", "factor", "made")
    return out.select("admissionid", "orderid", "itemid", "start", F.round("made", 6).alias("rate"))


@query(f"""with {NUMBERS}, w as (select admissionid, median(value) kg from numbers where itemid = 46091 and value between 20 and 300 group by 1)
select g.admissionid, orderid, start, round(rate * case when rateunit = 'ml/uur' then 1 / 60.0 when rateunit = 'ml/min' then 1.0 end / kg, 6) as per_kg from drugitems g join w using (admissionid) where doserateperkg = 0""")
def op_139_per_kg_rates(s, d):
    w = numbers(s, d).filter("itemid = 46091 and value between 20 and 300").groupBy("admissionid").agg(F.median("value").alias("kg"))
    scale = s.createDataFrame([("ml/uur", 1 / 60.0), ("ml/min", 1.0)], "rateunit string, scale double")
    rows = table(s, d, "drugitems").filter("doserateperkg = 0").join(w, "admissionid").join(F.broadcast(scale), "rateunit", "left")
    return rows.select("admissionid", "orderid", "start", F.round(F.col("rate") * F.col("scale") / F.col("kg"), 6).alias("per_kg"))


@query(f"with {_GRID_SQL} select admissionid, hour, case when pressure > 0 then round(pulse / pressure, 6) end as shock_index from g")
def op_140_guarded_ratio(s, d):
    return hour_grid(s, d).select("admissionid", "hour", F.round(x.ratio(F.col("pulse"), F.col("pressure")), 6).alias("shock_index"))


@query("select numericid, round(ln(1 + value), 6) as log_value, round(sign(value) * ln(1 + abs(value)), 6) as signed_log from numericitems where value is not null and not isnan(value) and value >= 0")
def op_141_logs(s, d):
    v = F.col("value")
    return numbers(s, d).filter("value >= 0").select("numericid", F.round(F.log1p(v), 6).alias("log_value"), F.round(x.signed_log1p(v), 6).alias("signed_log"))


@query(f"""with {NUMBERS}, m as (select itemid, avg(value) mean, stddev_pop(value) std, count(*) n from numbers where admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training')) and not isinf(value) group by 1)
select numericid, round(case when n is null or n < 10 then value else (value - mean) / case when std > 0 then std else 1.0 end end, 6) as z from numbers left join m using (itemid)""")
def op_142_zscores(s, d):
    rows = numbers(s, d)
    m = fit.fit_moments(training(rows, s, d), "itemid", "value")
    return fit.scaled(rows.select("numericid", "itemid", "value"), m, "itemid", "value", "z").select("numericid", F.round("z", 6).alias("z"))


_KNOTS = 11


@query(f"""with t as (select itemid, quantile_cont(rate, [{', '.join(str(i / (_KNOTS - 1)) for i in range(_KNOTS))}]) k from drugitems where rate > 0 and admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training')) group by 1),
j as (select admissionid, orderid, start, rate, k, len(list_filter(k, lambda e: e <= rate)) as n from drugitems join t using (itemid))
select admissionid, orderid, start, round(case when rate is null then null when rate <= 0 or n = 0 then 0.0 when n > {_KNOTS - 1} then 1.0 else (n - 1 + case when k[n + 1] > k[n] then (rate - k[n]) / (k[n + 1] - k[n]) else 0.0 end) / {_KNOTS - 1} end + 1e-9, 6) as place from j""")
def op_143_rank_transform(s, d):
    g = table(s, d, "drugitems")
    ranks = fit.fit_ranks(training(g, s, d), "itemid", "rate", _KNOTS)
    return fit.ranked(g, ranks, "itemid", "rate", "place").join(ranks.select("itemid"), "itemid", "left_semi").select("admissionid", "orderid", "start", F.round(F.col("place") + 1e-9, 6).alias("place"))


@query("select admissionid, case max(agegroup) when '18-39' then 30 when '40-49' then 45 when '50-59' then 55 when '60-69' then 65 when '70-79' then 75 when '80+' then 85 end as age, case max(gender) when 'Man' then 1 when 'Vrouw' then 0 end as male from admissions group by 1")
def op_145_dictionaries(s, d):
    a = table(s, d, "admissions").groupBy("admissionid").agg(F.max("agegroup").alias("a"), F.max("gender").alias("g"))
    ages = {"18-39": 30, "40-49": 45, "50-59": 55, "60-69": 65, "70-79": 75, "80+": 85}
    return a.select("admissionid", x.lookup(F.col("a"), ages).alias("age"), x.lookup(F.col("g"), {"Man": 1, "Vrouw": 0}).alias("male"))


@query("select distinct itemid, lower(trim(regexp_replace(coalesce(item, ''), '\\s+', ' ', 'g'))) as label, trim(regexp_replace(lower(coalesce(item, '')), '[^a-z0-9]+', ' ', 'g')) as searched, case when unit is null or lower(trim(unit)) in ('none', 'nan', 'null', 'na', '<na>') then '' else regexp_replace(trim(unit), '^(-?[0-9]+)\\.0+$', '\\1') end as unit_key from numericitems")
def op_148_keys_and_labels(s, d):
    return table(s, d, "numericitems").select("itemid", x.label_key(F.col("item")).alias("label"), x.search_text(F.col("item")).alias("searched"), x.norm_key(F.col("unit")).alias("unit_key")).distinct()


@query("select code, case when regexp_matches(code, '^[0-9]+(-.*)?$') then cast(regexp_extract(code, '^([0-9]+)', 1) as bigint) end as item, case when regexp_matches(code, '^[0-9]+-') then regexp_extract(code, '^[0-9]+-(.*)$', 1) else '' end as suffix from (select distinct itemid || case when valueid = 1 then '' else '-' || valueid end as code from listitems union select distinct value from listitems) where code is not null")
def op_149_composite_codes(s, d):
    t = table(s, d, "listitems")
    codes = t.select(F.concat(F.col("itemid").cast("string"), F.when(F.col("valueid") == 1, "").otherwise(F.concat(F.lit("-"), F.col("valueid").cast("string")))).alias("code")).union(t.select("value")).filter("code is not null").distinct()
    item, suffix = x.parse_code(F.col("code"))
    return codes.select("code", item.alias("item"), suffix.alias("suffix"))


@query("select itemid, case when fluidout <> 0 then 'fluid' when islabresult <> 0 then 'lab' else 'bedside' end as category, count(*) as n from numericitems group by all")
def op_150_categories(s, d):
    cat = F.when(F.col("fluidout") != 0, "fluid").when(F.col("islabresult") != 0, "lab").otherwise("bedside")
    return table(s, d, "numericitems").groupBy("itemid", cat.alias("category")).agg(F.count("*").alias("n"))


@query("select itemid, item, (cast(contains(l, 'druk') as integer) + cast(contains(l, 'gemiddeld') as integer) + cast(contains(l, 'art') as integer)) / 3.0 as share from (select itemid, item, lower(item) l from items)")
def op_151_matched_terms(s, d):
    return table(s, d, "items").select("itemid", "item", x.matched_share(x.search_text(F.col("item")), ["druk", "gemiddeld", "art"]).alias("share"))


@query("select orderid, start, stop, greatest(start, stop) as later, least(start, stop) as earlier, coalesce(solutionitemid, itemid) as what from drugitems")
def op_154_row_wise(s, d):
    return table(s, d, "drugitems").select("orderid", "start", "stop", F.greatest("start", "stop").alias("later"), F.least("start", "stop").alias("earlier"), F.coalesce("solutionitemid", "itemid").alias("what"))


@query("select admissionid, year(admittedattime) as year, cast(date_diff('millisecond', admittedattime, dischargedattime) as bigint) as ms, admittedattime + to_microseconds(5400000000) as later from (select distinct admissionid, admittedattime, dischargedattime from admissions)")
def op_156_times(s, d):
    a = table(s, d, "admissions").select("admissionid", "admittedattime", "dischargedattime").distinct()
    return a.select("admissionid", F.year("admittedattime").cast("long").alias("year"), x.ms_between(F.col("admittedattime"), F.col("dischargedattime")).alias("ms"), x.add_ms(F.col("admittedattime"), F.lit(5_400_000).cast("long")).alias("later"))


@query("select event_id, json_extract_string(props, '$.k') as k, event_type from events")
def op_160_json_fields(s, d):
    return table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), "event_type")


# Tokens

_CODES = """e as (select admissionid, measuredat as t, 'LIST//' || itemid || '//Q' || valueid as code from listitems where measuredat is not null and measuredat <> -1899 and valueid is not null)"""


def coded_events(s, d):
    return table(s, d, "listitems").filter("measuredat <> -1899 and valueid is not null").select("admissionid", F.col("measuredat").alias("t"), F.concat(F.lit("LIST//"), F.col("itemid").cast("string"), F.lit("//Q"), F.col("valueid").cast("string")).alias("code"))


_GAP = "case " + " ".join(
    [f"when m >= {x.GAP_LABELS[-1][1]} then list_transform(range(greatest(1, cast(round_even(m / {x.GAP_LABELS[-1][1]}.0, 0) as bigint))), lambda i: '{x.GAP_LABELS[-1][0]}')"] + [f"when m >= {least} then ['{label}']" for label, least in reversed(x.GAP_LABELS[:-1])]
) + " else [] end"
_EXPANDED = f"""{_CODES}, o as (select *, row_number() over w n, (t - lag(t) over w) / 60000.0 m, lead(code) over w is null as z from e window w as (partition by admissionid order by t, code)),
l as (select admissionid, t, n, list_concat(coalesce({_GAP}, []), case when regexp_matches(code, '^.+//Q([1-9]|10)$') then [regexp_extract(code, '^(.+)//(Q([1-9]|10))$', 1), regexp_extract(code, '^(.+)//(Q([1-9]|10))$', 2)] else [code] end, case when z then ['TIMELINE_END'] else [] end) k from o),
p as (select admissionid, t, n, unnest(k) token, generate_subscripts(k, 1) i from l),
x as (select admissionid, cast(row_number() over (partition by admissionid order by n, i) - 1 as bigint) as seq, token, t as time from p)"""


@query(f"with {_EXPANDED} select * from x")
def op_108_token_expansion(s, d):
    return tokens.expanded(coded_events(s, d), ["admissionid"], "t", "code")


@query(f"with {_CODES} select code, count(*) as n, regexp_extract(code, '^(.+)//(Q([1-9]|10))$', 1) as base, regexp_extract(code, '^(.+)//(Q([1-9]|10))$', 2) as quantile from e group by all")
def op_109_fused_codes(s, d):
    parts = x.split_quantile(F.col("code"))
    return coded_events(s, d).groupBy("code").agg(F.count("*").alias("n")).select("code", "n", F.when(F.size(parts) == 2, parts[0]).otherwise("").alias("base"), F.when(F.size(parts) == 2, F.try_element_at(parts, F.lit(2))).otherwise("").alias("quantile"))


@query(f"with {_CODES}, g as (select admissionid, t, (t - lag(t) over (partition by admissionid order by t)) / 60000.0 m from (select distinct admissionid, t from e)) select admissionid, t, array_to_string(coalesce({_GAP}, []), ' ') as gap from g")
def op_110_gap_tokens(s, d):
    from pyspark.sql import Window

    rows = coded_events(s, d).select("admissionid", "t").distinct()
    m = (F.col("t") - F.lag("t").over(Window.partitionBy("admissionid").orderBy("t"))) / F.lit(60_000.0)
    return rows.withColumn("m", m).select("admissionid", "t", F.array_join(x.gap_tokens(F.col("m")), " ").alias("gap"))


@query("select distinct 'DRUG//' || itemid || '//' || coalesce(action, 'NONE') || '//' || ordercategoryid as code, 'DRUG//' || itemid as cut from drugitems")
def op_111_truncated_codes(s, d):
    code = F.concat_ws("//", F.lit("DRUG"), F.col("itemid").cast("string"), F.coalesce("action", F.lit("NONE")), F.col("ordercategoryid").cast("string"))
    return table(s, d, "drugitems").select(code.alias("code")).distinct().withColumn("cut", x.truncated_code(F.col("code"), "DRUG", 1))


@query("""select code, array_to_string(case when len(p) > 2 then list_transform(range(2, len(p)), lambda k: array_to_string(p[1:k], '//')) else [] end, ' ') as parents from (select code, string_split(code, '//') p from (select distinct 'DRUG//' || itemid || '//' || coalesce(action, 'NONE') as code from drugitems union select 'LIST//' || itemid from listitems))""")
def op_39_parent_codes(s, d):
    drugs = table(s, d, "drugitems").select(F.concat_ws("//", F.lit("DRUG"), F.col("itemid").cast("string"), F.coalesce("action", F.lit("NONE"))).alias("code"))
    both = drugs.union(table(s, d, "listitems").select(F.concat(F.lit("LIST//"), F.col("itemid").cast("string")))).distinct()
    return both.select("code", F.array_join(x.parent_codes(F.col("code")), " ").alias("parents"))


_VOCAB = "v as (select token, cast(row_number() over (order by token) - 1 as bigint) as id, n from (select token, sum(n)::bigint n from (select token, count(*) n from x where admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training')) group by 1 union all select 'UNK', 0) group by 1))"


@query(f"with {_EXPANDED}, {_VOCAB} select token, id, n from v")
def op_38_vocabulary(s, d):
    return tokens.vocabulary(training(tokens.expanded(coded_events(s, d), ["admissionid"], "t", "code"), s, d))


@query(f"with {_EXPANDED}, {_VOCAB} select admissionid, seq, x.token, coalesce(v.id, (select id from v where token = 'UNK')) as id, v.id is null as is_unknown from x left join v using (token)")
def op_186_token_ids(s, d):
    t = tokens.expanded(coded_events(s, d), ["admissionid"], "t", "code")
    return tokens.numbered(t, tokens.vocabulary(training(t, s, d))).select("admissionid", "seq", "token", "id", "is_unknown")


@query(f"with {_EXPANDED}, z as (select admissionid, count(*) n, admissionid % 4 as shard from x group by 1) select admissionid, shard, n, cast(sum(n) over (partition by shard order by admissionid rows unbounded preceding) - n as bigint) as first from z")
def op_37_timeline_index(s, d):
    t = tokens.expanded(coded_events(s, d), ["admissionid"], "t", "code")
    return tokens.timeline_index(t, ["admissionid"], F.col("admissionid") % 4)


# Fitted and applied


@query(f"""with {NUMBERS}, l as (select itemid, unit, list(value order by value) v from numbers where admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training')) group by all),
b as (select itemid, unit, list_transform(range(1, 10), lambda i: v[((len(v) - 1) * 2 * i + 10) // 20 + 1]) q from l)
select numericid, n.itemid, cast(1 + len(list_filter(q, lambda e: value > e)) as integer) as bin from numbers n join b on n.itemid = b.itemid and n.unit is not distinct from b.unit""")
def op_168_quantile_codes(s, d):
    rows = numbers(s, d).select("numericid", "itemid", "unit", "value", "admissionid")
    bounds = fit.fit_quantiles(training(rows, s, d), ["itemid", "unit"], "value")
    return fit.coded(rows, bounds, ["itemid", "unit"], "value", "bin").select("numericid", "itemid", "bin")


@query(f"""with {_GRID_SQL}, u as (unpivot g on {', '.join(TAGS.values())} into name tag value v), m as (select tag, avg(v) mean, stddev_pop(v) std, count(*) n from u where admissionid in (select admissionid from admissions where lower(trim(split)) in ('train', 'training')) group by 1)
select admissionid, hour, tag, round(case when n >= 10 then (v - mean) / case when std > 0 then std else 1.0 end else v end, 6) as z from u left join m using (tag)""")
def op_162_scaled_grid(s, d):
    g = hour_grid(s, d)
    long = g.unpivot(["admissionid", "hour"], list(TAGS.values()), "tag", "v").filter("v is not null")
    m = fit.fit_moments(training(long, s, d), "tag", "v")
    return fit.scaled(long, m, "tag", "v", "z").select("admissionid", "hour", "tag", F.round("z", 6).alias("z"))


@query(f"""with {NUMBERS}, a as (select case when admissionid in (select admissionid from admissions where urgency = 1) then 'x' else 'y' end c, itemid, avg(value) mean, stddev_pop(value) std from numbers group by all),
k as (select case when admissionid in (select admissionid from admissions where urgency = 1) then 'x' else 'y' end c, sqrt(count(distinct admissionid)) w from numbers group by 1), p as (select itemid, sum(w * mean) / sum(w) mean, sum(w * (std * std + mean * mean)) / sum(w) q from a join k using (c) group by 1)
select itemid, round(mean, 4) as mean, round(sqrt(greatest(q - mean * mean, 0)), 3) as std from p""")
def op_165_pooled_moments(s, d):
    rows = numbers(s, d).join(table(s, d, "admissions").filter("urgency = 1").select("admissionid", F.lit("x").alias("c")).distinct(), "admissionid", "left").fillna("y", ["c"])
    n = rows.groupBy("c").agg(F.sqrt(F.countDistinct("admissionid")).alias("w"))
    parts = rows.groupBy("c", "itemid").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")).join(n, "c")
    return fit.pooled_moments(parts, "itemid", "w").select("itemid", F.round("mean", 4).alias("mean"), F.round("std", 3).alias("std"))


@query("with r as (select itemid, rate, case when isadditive = 1 then 3 else 1 end as copies from drugitems where rate is not null), u as (select itemid, rate, unnest(range(copies)) from r) select itemid, round(quantile_cont(rate, 0.1), 6) as p10, round(quantile_cont(rate, 0.5), 6) as p50, round(quantile_cont(rate, 0.9), 6) as p90 from u group by 1")
def op_166_weighted_percentiles(s, d):
    rows = table(s, d, "drugitems").filter("rate is not null").withColumn("copies", F.when(F.col("isadditive") == 1, 3).otherwise(1))
    return fit.pooled_percentiles(rows, "itemid", "rate", "copies", [0.1, 0.5, 0.9]).select("itemid", *[F.round(k, 6).alias(k) for k in ("p10", "p50", "p90")])


_DENSE = """f as (select admissionid, itemid, 1.0 / avg(g) as v from (select admissionid, itemid, t - lag(t) over (partition by admissionid, itemid order by t) g from (select admissionid, itemid, admission_relative_ms t from numericitems where admission_relative_ms is not null)) where g > 0 group by all),
c as (select itemid, count(v) n, avg(v) mean, stddev_samp(v) sd from f group by 1), r as (select itemid, count(*) n_rows from numericitems group by 1), k as (select r.itemid, n_rows, n, mean, mean - 1.96 * sd / sqrt(n) low, mean + 1.96 * sd / sqrt(n) high from r left join c using (itemid))"""


@query(f"""with {_DENSE}
select itemid, n_rows, case when coalesce(low > 1.0 / 2700000, false) then 'dense' when coalesce(n <= 2 and n_rows >= 500000 and mean > 1.0 / 2700000, false) then 'rare_dense' when coalesce(high < 1.0 / 2700000, false) then 'sparse' else 'unsettled' end as status from k""")
def op_170_dense_signals(s, d):
    return fit.dense_signals(table(s, d, "numericitems"), "admissionid", "itemid", "admission_relative_ms", 2_700_000).select("itemid", "n_rows", "status")


@query(f"""with {_DENSE}, ds as (select itemid from k where coalesce(low > 1.0 / 2700000, false) or coalesce(n <= 2 and n_rows >= 500000 and mean > 1.0 / 2700000, false)), e as (select admissionid, itemid, admission_relative_ms ms, value from numericitems where admission_relative_ms is not null and value is not null and not isnan(value))
select admissionid, itemid, (cast(floor(ms / 3600000.0) as bigint) + 1) * 3600000 as admission_relative_ms, round(avg(value), 6) as value, count(*) as raw_rows_in_bin, 'causal_mean' as binning_method from e where itemid in (select itemid from ds) group by admissionid, itemid, floor(ms / 3600000.0)
union all select admissionid, itemid, ms, round(value + 0.0, 6), 1, 'raw_passthrough' from e where itemid not in (select itemid from ds)""")
def op_171_causal_binning(s, d):
    rows = numbers(s, d).filter("admission_relative_ms is not null")
    # Which signals are dense is the inventory's result.
    dense = fit.dense_signals(table(s, d, "numericitems"), "admissionid", "itemid", "admission_relative_ms", 2_700_000).filter("is_dense").select("itemid")
    out = grid.binned(rows, dense, "itemid", ["admissionid", "itemid"], "admission_relative_ms", "value")
    return out.withColumn("value", F.round(F.col("value") + 0.0, 6))


@query("""with s as (select distinct subject_id, admissionid, admittedat a, dischargedat b, dateofdeath from admissions), q as (select subject_id, min(dateofdeath) d from s group by 1),
r as (select s.*, d, coalesce(d >= a - 86400000 and d <= b, false) as during from s join q using (subject_id) where d is not null and b is not null),
o as (select * from r where during or d > b qualify row_number() over (partition by subject_id order by during desc, case when during then a else b end desc, admissionid desc) = 1)
select subject_id, admissionid, case when during then 'during_stay' when d - b <= 86400000 then 'within_grace' else 'later' end as relation, (d - b) / 3600000.0 as hours_after, during or d - b <= 86400000 as emitted, case when during then b when d - b <= 86400000 then d end as event_time from o""")
def op_172_assigned_deaths(s, d):
    a = table(s, d, "admissions").select("subject_id", "admissionid", "admittedat", "dischargedat", "dateofdeath").distinct()
    return events.assigned_deaths(a, "subject_id", "admissionid", "admittedat", "dischargedat", "dateofdeath")


@query("""with e as (select admissionid, itemid, value, measuredat, registeredat from listitems where measuredat <> -1899), o as (select * from e qualify row_number() over (partition by admissionid, itemid, value order by measuredat nulls last, registeredat nulls last) = 1)
select admissionid, itemid, value, measuredat, case when measuredat is not distinct from min(measuredat) over (partition by admissionid, itemid) then 'static' else 'dynamic' end as role from o""")
def op_175_earliest_facts(s, d):
    rows = table(s, d, "listitems").filter("measuredat <> -1899").select("admissionid", "itemid", "value", "measuredat", "registeredat")
    return events.earliest_facts(rows, ["admissionid", "itemid"], "value", "measuredat", "registeredat").select("admissionid", "itemid", "value", "measuredat", "role")


@query("""select rule, n from (select unnest([{'rule': 'no time', 'n': count(*) filter (measuredat = -1899)}, {'rule': 'late', 'n': count(*) filter (registeredat - measuredat > 86400000 and measuredat <> -1899)}, {'rule': 'no value', 'n': count(*) filter (value is null or isnan(value))}, {'rule': 'no unit', 'n': count(*) filter (unit is null)}], recursive := true) from numericitems)""")
def op_182_invariants(s, d):
    v = F.col("value")
    rules = {"no time": F.col("measuredat") == -1899, "late": (F.col("registeredat") - F.col("measuredat") > 86_400_000) & (F.col("measuredat") != -1899), "no value": v.isNull() | F.isnan(v), "no unit": F.col("unit").isNull()}
    return events.violations(table(s, d, "numericitems"), rules)


# Audits and cohorts


@query("select numericid, count(*) as n from numericitems group by 1 having count(*) > 1")
def op_179_duplicate_keys(s, d):
    return audits.duplicate_keys(table(s, d, "numericitems"), ["numericid"])


@query("select patientid, count(distinct lower(trim(split))) as n_splits from admissions where trim(split) <> '' group by 1 having count(distinct lower(trim(split))) > 1")
def op_179_split_leakage(s, d):
    rows = table(s, d, "admissions").withColumn("split", F.lower(F.trim("split"))).filter("split <> ''")
    return audits.leaking(rows, "patientid", "split")


@query(f"with {NUMBERS}, h as (select distinct admissionid, {HOUR} h from numbers where admission_relative_ms >= 0), g as (select admissionid, count(*) n, min(h) lo, max(h) hi from h group by 1) select admissionid, n, hi as last from g where lo <> 0 or hi <> n - 1")
def op_179_holes_in_hours(s, d):
    h = numbers(s, d).filter("admission_relative_ms >= 0").select("admissionid", x.bucket(F.col("admission_relative_ms")).alias("h")).distinct()
    return audits.gaps_in_hours(h, "admissionid", "h")


@query("select itemid, n_before, n_after, h0_before = h0_after and n_before = n_after as same from (select itemid, count(*) n_before, sum(hash_a)::varchar h0_before from (select itemid, cast(('0x' || substr(md5('0:' || concat_ws('|', '0=' || coalesce(cast(numericid as varchar), '\\N'))), 1, 12)) as bigint) hash_a from numericitems) group by 1) a join (select itemid, count(*) n_after, sum(hash_a)::varchar h0_after from (select itemid, cast(('0x' || substr(md5('0:' || concat_ws('|', '0=' || coalesce(cast(numericid as varchar), '\\N'))), 1, 12)) as bigint) hash_a from numericitems where unit is not null) group by 1) b using (itemid)")
def op_180_preserved(s, d):
    n = table(s, d, "numericitems")
    a = audits.fingerprint(n, ["numericid"], ["itemid"]).select("itemid", F.col("n_rows").alias("n_before"), F.col("h0").alias("x"))
    b = audits.fingerprint(n.filter("unit is not null"), ["numericid"], ["itemid"]).select("itemid", F.col("n_rows").alias("n_after"), F.col("h0").alias("y"))
    return a.join(b, "itemid").select("itemid", "n_before", "n_after", ((F.col("x") == F.col("y")) & (F.col("n_before") == F.col("n_after"))).alias("same"))


@query("select admissionid, itemid, registeredat, measuredat from (select *, lag(measuredat) over (partition by admissionid, itemid order by registeredat, valueid, measuredat) b from listitems where measuredat <> -1899) where measuredat < b")
def op_181_out_of_order(s, d):
    from pyspark.sql import Window

    rows = table(s, d, "listitems").filter("measuredat <> -1899").withColumn("seq", F.row_number().over(Window.partitionBy("admissionid", "itemid").orderBy("registeredat", "valueid", "measuredat")))
    return audits.out_of_order(rows, ["admissionid", "itemid"], "seq", "measuredat").select("admissionid", "itemid", "registeredat", "measuredat")


@query("select admissionid, a + b + c as total from (select admissionid, cast(coalesce(max(gender) = 'Man', false) as integer) a, cast(coalesce(max(gender) = 'Vrouw', false) as integer) b, cast(coalesce(max(urgency) = 1, false) as integer) c from admissions group by 1) where a + b + c <> 1")
def op_183_one_hot_audit(s, d):
    a = table(s, d, "admissions").groupBy("admissionid").agg(F.max("gender").alias("g"), F.max("urgency").alias("u"))
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("int")
    rows = a.select("admissionid", flag(F.col("g") == "Man").alias("a"), flag(F.col("g") == "Vrouw").alias("b"), flag(F.col("u") == 1).alias("c"))
    return audits.not_exclusive(rows, ["a", "b", "c"]).select("admissionid", (F.col("a") + F.col("b") + F.col("c")).alias("total"))


@query("""select 'west_' || admissionid as admissionid, admissionid as native_admissionid, 'west' as cohort, gender, cast(null as bigint) as urgency from (select distinct admissionid, gender from admissions)
union all select 'east_' || admissionid, admissionid, 'east', null, urgency from (select distinct admissionid, urgency from admissions)""")
def op_158_namespaced_cohorts(s, d):
    a = table(s, d, "admissions")
    out = joint.stacked({"west": a.select("admissionid", "gender").distinct(), "east": a.select("admissionid", "urgency").distinct()}, ["admissionid"])
    return out.select("admissionid", "native_admissionid", "cohort", "gender", "urgency")


@query(f"""with {STAYS}, k as (select distinct patientid, subject_id, admissionid from admissions), r as (select subject_id, count(distinct admissionid) n_stays, sum((dischargedat - admittedat) / 3600000.0) los from k join stays using (admissionid) group by 1)
select subject_id, n_stays, round(los, 6) as total_hours from r""")
def op_174_subject_metadata(s, d):
    k = table(s, d, "admissions").select("subject_id", "admissionid").distinct().join(stays(s, d), "admissionid")
    return k.groupBy("subject_id").agg(F.countDistinct("admissionid").alias("n_stays"), F.round(F.sum("los_hours"), 6).alias("total_hours"))
