"""SQL oracles of the general problems' queries."""

from __future__ import annotations

from wardgrid.queries.units_sql import CONVERTED

_MEDICATION = "select admissionid, start s, stop e from drugitems where admissionid is not null and start <> -1899 and stop <> -1899 and stop > start"
_REACH = f"""with d as ({_MEDICATION}),
o as (select *, max(e) over (partition by admissionid order by s, e rows between unbounded preceding and 1 preceding) p from d)"""

# The catalogue's items by type.
INTEGER_ITEMS = (41011, 41012, 41013, 41014, 41015, 42024, 42026, 43041, 43042, 43043, 43044, 43045, 44061, 44063, 44065, 44069, 44071, 44072, 44075, 44077, 45081, 45082, 45083, 46092, 46093, 46095, 46096)
DECIMAL_ITEMS = (42021, 42022, 42023, 42025, 42027, 42028, 42029, 42030, 43046, 44062, 44064, 44066, 44067, 44068, 44070, 44073, 44074, 44076, 44078, 44079, 46091)
FLAG_ITEMS = (45084, 45085, 46094)


def _wide_column(item: int) -> str:
    v = f"max(v) filter (itemid = {item})"
    if item in INTEGER_ITEMS:
        v = f"cast(round(case when abs({v}) < 9.2e18 then {v} end) as bigint)"
    if item in FLAG_ITEMS:
        v = f"case {v} when 1 then true when 0 then false end"
    return f"{v} as item_{item}"


_WIDE = f"""with r as (
  select admissionid, itemid, value v, row_number() over (partition by admissionid, itemid
    order by measuredat desc nulls last, registeredat desc nulls last, numericid desc nulls last, value desc) k
  from numericitems where value is not null and not isnan(value)),
a as (select admissionid, itemid, v from r where k = 1 union all select distinct admissionid, null, null from admissions)
select admissionid, {", ".join(_wide_column(i) for i in sorted((*INTEGER_ITEMS, *DECIMAL_ITEMS, *FLAG_ITEMS)))} from a group by admissionid"""

# The same over converted values, decimals rounded to 6 places.
_WIDE_CONVERTED = _WIDE.replace("with r as", f"with {CONVERTED}, rw as").replace("value v, row_number", "target_value v, row_number").replace("numericid desc nulls last, value desc", "numericid desc nulls last, target_value desc")
_WIDE_CONVERTED = _WIDE_CONVERTED.replace("from numericitems where value is not null and not isnan(value)", "from z where target_value is not null and not isnan(target_value)").replace("a as (select admissionid, itemid, v from r", "aw as (select admissionid, itemid, v from rw").replace(" from a group by", " from aw group by")
for _i in DECIMAL_ITEMS:
    _WIDE_CONVERTED = _WIDE_CONVERTED.replace(f"max(v) filter (itemid = {_i}) as", f"round(max(v) filter (itemid = {_i}) + 0.0, 6) as")



def _solved(p: int) -> str:
    """s0 ... s{p}: elimination of the p x p systems in m0 (m_i_j, y_i), then so with the solutions c_i."""
    steps = []
    for k in range(p):
        cols = [f"m_{i}_{j} - m_{i}_{k} / m_{k}_{k} * m_{k}_{j} as m_{i}_{j}" if i > k and j > k else f"m_{i}_{j}" for i in range(p) for j in range(p) if (j >= i if i <= k else j > k)]
        ys = [f"y_{i} - m_{i}_{k} / m_{k}_{k} * y_{k} as y_{i}" if i > k else f"y_{i}" for i in range(p)]
        steps.append(f"m{k + 1} as (select admissionid, itemid, {', '.join(cols + ys)} from m{k})")
    for i in reversed(range(p)):
        rest = "".join(f" - m_{i}_{j} * c_{j}" for j in range(i + 1, p))
        source = f"m{p}" if i == p - 1 else f"k{i + 1}"
        steps.append(f"k{i} as (select *, (y_{i}{rest}) / m_{i}_{i} as c_{i} from {source})")
    return ", ".join(steps)


_WAVES = ["1.0", "h / 100.0", *(f"{f}({j} * 2 * pi() / 24 * h)" for j in (1, 2) for f in ("cos", "sin"))]
_P = len(_WAVES)
_SUMS = ", ".join(f"sum(({_WAVES[min(i, j)]}) * ({_WAVES[max(i, j)]})){' + 1.0' if i == j > 0 else ''} as m_{i}_{j}" for i in range(_P) for j in range(_P))
_PREDICTED = " + ".join(f"c_{i} * ({w})" for i, w in enumerate(_WAVES))
P5_GRID = f"""with {CONVERTED}, le as (select admissionid, cast(ceil(max(dischargedat - admittedat) / 3600000.0) as bigint) as len from admissions where admissionid is not null group by 1),
hr as (select z.admissionid, z.itemid, cast(floor(admission_relative_ms / 3600000.0) as bigint) as h, avg(case when not isnan(target_value) then target_value end) as v, count(*) as n from z join le using (admissionid)
  where z.itemid in (select itemid from items where cadence_ms is not null) and z.v is not null and admission_relative_ms >= 0 and admission_relative_ms < len * 3600000 group by all),
m0 as (select admissionid, itemid, {_SUMS}, {', '.join(f'sum(({w}) * v) as y_{i}' for i, w in enumerate(_WAVES))} from hr where v is not null group by 1, 2), {_solved(_P)},
fu as (select s.admissionid, s.itemid, x.h, hr.v, hr.n, {_PREDICTED.replace('h / 100', 'x.h / 100').replace('* h)', '* x.h)')} as pr from (select distinct admissionid, itemid from hr) s join le using (admissionid), lateral (select unnest(range(len)) as h) x
  left join hr on hr.admissionid = s.admissionid and hr.itemid = s.itemid and hr.h = x.h left join k0 on k0.admissionid = s.admissionid and k0.itemid = s.itemid),
re as (select *, case when v - pr is not null then {{'h': h, 'r': v - pr}} end as hr from fu),
pq as (select *, last_value(hr ignore nulls) over (partition by admissionid, itemid order by h rows unbounded preceding) as p, first_value(hr ignore nulls) over (partition by admissionid, itemid order by h rows between 1 following and unbounded following) as q from re),
fi as (select *, pr + case when p is null or q is null then coalesce(p.r, q.r) else p.r + (h - p.h) / (q.h - p.h) * (q.r - p.r) end as fill from pq)
select admissionid, itemid, h as hournr, round(case when n is not null then v else fill end + 0.0, 4) as value, coalesce(n, 0) as n_readings, case when n is not null then 'observed' when fill is not null then 'filled' else 'marked' end as status from fi"""

ORACLES = {
    "p5_grid": P5_GRID,
    "p7_wide_converted": _WIDE_CONVERTED,
    "p1_found": f"{_REACH} select admissionid, p as gapstart, s as gapstop from o where s > p",
    "p1_periods": f"""{_REACH}, k as (select *, sum(case when p is null or s > p then 1 else 0 end) over (partition by admissionid order by s, e rows unbounded preceding) g from o)
select admissionid, min(s) as periodstart, max(e) as periodstop from k group by admissionid, g""",
    "p5_found": """with l as (select admissionid, cast(ceil(max(dischargedat - admittedat) / 3600000.0) as bigint) n from admissions group by 1),
h as (select distinct admissionid, itemid, cast(floor(admission_relative_ms / 3600000.0) as bigint) h from numericitems
  where value is not null and not isnan(value) and admission_relative_ms is not null and itemid in (select itemid from items where cadence_ms is not null)),
o as (select h.* from h join l using (admissionid) where h.h >= 0 and h.h < l.n),
g as (select admissionid, itemid, unnest(range(n)) h from (select distinct admissionid, itemid from o) join l using (admissionid))
select g.admissionid, g.itemid, g.h as hournr from g anti join o on g.admissionid = o.admissionid and g.itemid = o.itemid and g.h = o.h""",
    "p7_wide": _WIDE,
}
