"""The pipelines as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardgrid.config import GridConfig
from wardgrid.plans import grid_pipeline
from wardgrid.queries.registry import query
from wardgrid.queries.scans import NUMBERS, STAYS
from wardgrid.sources.tables import table

_C = GridConfig()
_ITEMS = ", ".join(map(str, _C.tags))
_CASE = "case itemid " + " ".join(f"when {i} then '{t}'" for i, t in _C.tags.items()) + " end"
_TAGS = list(_C.tags.values())

GRID_SQL = f"""with {STAYS}, {NUMBERS}, live as (select admissionid, cast(ceil((dischargedat - admittedat) / 3600000.0) as bigint) n from stays where dischargedat > admittedat),
long as (select n.admissionid, {_CASE} as tag, cast(floor(admission_relative_ms / 3600000.0) as bigint) as hour, median(value) v from numbers n join items using (itemid) where itemid in ({_ITEMS}) and admission_relative_ms >= 0 and value between physmin and physmax group by all),
inside as (select long.* from long join live using (admissionid) where hour < n),
person as (select admissionid, min(coalesce(subject_id, admissionid)) person, max(gender) gender from admissions group by 1),
ranked as (select person, row_number() over (order by md5('0:' || person), person) - 1 r, count(*) over () c from (select distinct person from person where admissionid is not null)),
static as (select admissionid, gender, case when r < round_even(c * 0.7, 0) then 'train' when r < round_even(c * 0.7, 0) + round_even(c * 0.15, 0) then 'val' else 'test' end as split from person join ranked using (person)),
m as (select tag, avg(v) mean, stddev_pop(v) std, count(*) k from inside where admissionid in (select admissionid from static where split = 'train') group by 1),
z as (select admissionid, hour, tag, case when k is null or k < 10 then v else (v - mean) / case when std > 0 then std else 1.0 end end as z from inside left join m using (tag)),
w as (select admissionid, hour, {', '.join(f"max(z) filter (tag = '{t}') as {t}" for t in _TAGS)} from z group by all),
sk as (select admissionid, unnest(range(n)) as hour from live)
select sk.admissionid, sk.hour, {', '.join(f"round(coalesce(last_value({t} ignore nulls) over (partition by sk.admissionid order by sk.hour rows unbounded preceding), 0.0), 6) as {t}" for t in _TAGS)},
{', '.join(f"case when {t} is null then 0 else 1 end as {t}__observed" for t in _TAGS)}, split, cast(coalesce(gender = 'Man', false) as integer) as gender_man, cast(coalesce(gender = 'Vrouw', false) as integer) as gender_vrouw, cast(not coalesce(gender in ('Man', 'Vrouw'), false) as integer) as gender_missing
from sk left join w using (admissionid, hour) join static using (admissionid)"""


@query(GRID_SQL)
def grid_pipeline_hours(s, d):
    """The whole grid of all stays: the flagship."""
    out = grid_pipeline.build_grid(table(s, d, "numericitems"), table(s, d, "admissions"), table(s, d, "items"))
    return out.withColumns({t: F.round(F.col(t), 6) for t in _TAGS})
