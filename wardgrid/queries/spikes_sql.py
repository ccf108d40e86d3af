"""SQL of the faulty readings: the stated rules, with the tail's likelihood taken on the same grid of shapes
and scales, over the same buckets of residual sizes."""

from __future__ import annotations

from wardgrid.operators.plausibility import SCALES, SHAPES, SpikeRules
from wardgrid.queries.units_sql import CONVERTED

_R = SpikeRules()
_G = 1 + _R.width
_SHAPES = ", ".join(f"({1e-9 if abs(x) < 1e-9 else float(x)!r})" for x in SHAPES)
_SCALES = ", ".join(f"({float(x)!r})" for x in SCALES)

_NEAR = "[p1, p2, p3, n1, n2, n3]"
_OUTER = "[p1, p2, p3, n2, n3, n4]"
_W = "partition by admissionid, itemid order by t"


def _round(i: int) -> str:
    """b{i+1}: the counted sizes of b{i} up to the cutoff of the tail fitted to them."""
    at = "1 + shape * ({} - low) / (rel * unit)"
    log = f"case when {at} > 0 then ln({at}) end"
    return f"""up{i} as (select *, sum(n) over (partition by itemid order by size) as upto, sum(n) over (partition by itemid) as total from b{i}),
q0{i} as (select itemid, max(total) total, min(case when upto > {_R.threshold} * (total - 1) then size end) low, min(case when upto > {_R.censor} * (total - 1) then size end) high from up{i} group by 1),
q1{i} as (select q.itemid, any_value(total) total, any_value(low) low, case when any_value(high) = any_value(low) then coalesce(min(case when size > low then size end), any_value(high)) else any_value(high) end high from q0{i} q join b{i} using (itemid) group by 1),
q2{i} as (select q.itemid, any_value(total) total, any_value(high) high, (any_value(low) + min(case when size > low and size <= high then size end)) / 2 low, sum(case when size > high then n else 0 end) beyond, sum(case when size > low and size <= high then n else 0 end) peaks from q1{i} q join b{i} using (itemid) group by 1),
q3{i} as (select q.itemid, any_value(total) total, any_value(high) high, any_value(low) low, any_value(beyond) beyond, any_value(peaks) peaks, (sum((size - low) * n) + any_value((high - low) * beyond)) / any_value(peaks + beyond) unit from q2{i} q join b{i} using (itemid) where peaks > 0 and size > low and size <= high group by 1),
li{i} as (select itemid, shape, rel * unit as scale, -(any_value(peaks) * ln(rel * unit) + sum((1 + 1 / shape) * n * {log.format('size', 'size')})) - any_value(beyond * {log.format('high', 'high')} / shape) as l, any_value({at.format('high')}) as inside
  from q3{i} join b{i} using (itemid) cross join gr where size > low and size <= high group by itemid, shape, rel, unit),
fi{i} as (select itemid, arg_max(struct_pack(a := shape, b := scale), l) as f from li{i} where inside > 0 group by 1),
cu{i} as (select q.itemid, low + f.b * (pow((peaks + beyond) / total / {_R.risk!r}, f.a) - 1) / f.a as cutoff from q3{i} q join fi{i} using (itemid)),
b{i + 1} as (select b.itemid, size, n from b{i} b left join cu{i} using (itemid) where cutoff is null or size <= cutoff),
"""


_ROUNDS = "".join(_round(i) for i in range(_R.rounds))

P3_FOUND = f"""with {CONVERTED},
rows_ as (select numericid, z.admissionid, z.itemid, measuredat t, target_value v, coalesce(target_value < physmin or target_value > physmax, false) as beyond, coalesce(measured, false) m, coalesce(islabresult <> 0, false) lab
  from z left join items on items.itemid = z.itemid where z.target_value is not null and not isnan(z.target_value) and measuredat is not null and measuredat <> -1899 and z.admissionid is not null and z.itemid is not null and numericid is not null),
ph as (select itemid, ((t % 86400000 + 86400000) % 86400000) // 3600000 as p, avg(v) m, count(*) n from rows_ where not beyond group by all),
se as (select itemid, p, m - sum(m * n) over (partition by itemid) / sum(n) over (partition by itemid) as season from ph),
rd as (select admissionid, itemid, t, arg_min(v, numericid) v, bool_or(beyond) beyond, bool_or(m) m, bool_or(lab) lab from rows_ group by all),
rs as (select *, sum(case when prev is not null and abs(v - prev) <= 1e-9 * greatest(1, abs(v)) then 0 else 1 end) over ({_W} rows unbounded preceding) run from (select *, lag(v) over ({_W}) prev from rd)),
ru as (select *, count(*) over (partition by admissionid, itemid, run) as len from rs),
ju as (select ru.admissionid, ru.itemid, t, v - coalesce(season, 0) as x from ru left join se on se.itemid = ru.itemid and se.p = ((t % 86400000 + 86400000) % 86400000) // 3600000 where not beyond and m and not lab),
nb as (select *, lag(x, 1) over w p1, lag(x, 2) over w p2, lag(x, 3) over w p3, lead(x, 1) over w n1, lead(x, 2) over w n2, lead(x, 3) over w n3, lead(x, 4) over w n4 from ju window w as ({_W})),
rd_ as (select itemid, abs(x - list_aggregate({_NEAR}, 'median')) as size from nb where p3 is not null and n3 is not null),
b0 as (select itemid, case when size > 0 then 2 * pow({_G!r}, ceil(ln(size) / ln({_G!r}))) / {_G + 1!r} else 0 end as size, count(*)::double n from rd_ group by all),
gr as (select a.s as shape, b.s as rel from (values {_SHAPES}) a(s), (values {_SCALES}) b(s)),
{_ROUNDS}
sc as (select itemid, sqrt(sum(size * size * n) / sum(n)) as scatter from b{_R.rounds} group by 1),
so as (select *, list_aggregate({_NEAR}, 'median') as near, list_aggregate({_OUTER}, 'median') as far, least(x, n1) lo, greatest(x, n1) hi from nb),
st as (select admissionid, itemid, t,
  case when p1 is null or n1 is null then 0 else greatest(least(x - p1, x - n1, 2 * (x - near)), least(p1 - x, n1 - x, 2 * (near - x)), 0) end as alone,
  case when p1 is null or n1 is null or n2 is null then 0 else greatest(least(lo - greatest(p1, n2), 2 * (lo - far)), least(least(p1, n2) - hi, 2 * (far - hi)), 0) end as pair from so),
sf as (select *, greatest(alone, pair, coalesce(lag(pair) over ({_W}), 0)) as off from st),
bad as (select admissionid, itemid, t from ru where beyond or (m and len >= 6) union select admissionid, itemid, t from sf join sc using (itemid) where scatter > 0 and off >= {_R.scatters} * scatter)
select distinct numericid from rows_ join bad using (admissionid, itemid, t)"""
