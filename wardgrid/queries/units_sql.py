"""SQL of the unit queries: spellings by the same fixed table, conversions written down on their own."""

from __future__ import annotations

from wardgrid.functions.unit_tables import NO_UNIT, SPELLINGS
from wardgrid.operators.units import SCATTERS, _spelt


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _spellings() -> str:
    rows = sorted({(_spelt(s), u) for u, ways in SPELLINGS.items() for s in (*ways, u)})
    return ", ".join(f"({_text(t)}, {_text(u)})" for t, u in rows)


# Written down apart from the operator's tables and graph: what a value in a unit is in the target unit, by
# the item's tag where it depends on the substance. Substances by their molar masses in g/mol.
_MASS = {"glucpoc": 180.156, "gluclab": 180.156, "ureum": 60.056, "lact": 90.08, "ca": 40.078, "mg": 24.305, "na": 22.99, "k": 39.098, "cl": 35.453, "hco3": 61.017}
_MICRO = {"kreat": 113.12, "bili": 584.66}
_ALIKE = {
    "mmHg": {"mmHg": "1, 0", "kPa": "7.500617, 0", "cmH2O": "0.735559, 0", "mbar": "1.019716 * 0.735559, 0"},
    "cmH2O": {"cmH2O": "1, 0", "mbar": "1.019716, 0", "mmHg": "1 / 0.735559, 0", "kPa": "10 * 1.019716, 0"},
    "%": {"%": "1, 0", "fraction": "100, 0"},
    "°C": {"°C": "1, 0", "°F": "1 / 1.8, -32 / 1.8"},
    "ml": {"ml": "1, 0", "l": "1000, 0"},
    "l/min": {"l/min": "1, 0", "ml/min": "0.001, 0"},
    "kg": {"kg": "1, 0", "g": "0.001, 0", "lb": "0.45359237, 0"},
    "cm": {"cm": "1, 0", "m": "100, 0", "inch": "2.54, 0"},
    "10^9/l": {"10^9/l": "1, 0", "K/µl": "1, 0", "/µl": "0.001, 0"},
    "mmol/l": {"mmol/l": "1, 0", "µmol/l": "0.001, 0"},
    "µmol/l": {"µmol/l": "1, 0", "mmol/l": "1000, 0"},
    "mg/l": {"mg/l": "1, 0", "mg/dl": "10, 0", "g/l": "1000, 0", "g/dl": "10000, 0"},
    "g/l": {"g/l": "1, 0", "g/dl": "10, 0", "mg/l": "0.001, 0", "mg/dl": "0.01, 0"},
    "g/dl": {"g/dl": "1, 0", "g/l": "0.1, 0", "mg/dl": "0.001, 0", "mg/l": "0.0001, 0"},
    "/min": {"/min": "1, 0"}, "pH": {"pH": "1, 0"},
}
_BY_TAG = {
    **{(t, "mmol/l"): {"mg/l": f"1 / {m}, 0", "mg/dl": f"10 / {m}, 0", "g/l": f"1000 / {m}, 0", "g/dl": f"10000 / {m}, 0"} for t, m in _MASS.items()},
    **{(t, "µmol/l"): {"mg/l": f"1000 / {m}, 0", "mg/dl": f"10000 / {m}, 0", "g/l": f"1000000 / {m}, 0", "g/dl": f"10000000 / {m}, 0"} for t, m in _MICRO.items()},
    ("hb", "g/dl"): {"mmol/l": "16114 / 10000, 0", "µmol/l": "16.114 / 10000, 0"},
}
for _t, _charge in {"na": 1, "k": 1, "cl": 1, "hco3": 1, "ca": 2, "mg": 2}.items():
    _BY_TAG[_t, "mmol/l"] |= {"mEq/l": f"1 / {_charge}.0, 0"}


def _conversions() -> str:
    """(tag, target, unit, a, b); tag * for what has no conversions of its own."""
    rows = [(tag, target, unit, ab) for target, known in _ALIKE.items() for tag in ("*", *_TAGGED) for unit, ab in known.items()]
    rows += [(tag, target, unit, ab) for (tag, target), known in _BY_TAG.items() for unit, ab in known.items()]
    return ", ".join(f"({_text(tag)}, {_text(target)}, {_text(unit)}, {', '.join(f'cast({x} as double)' for x in ab.split(', '))})" for tag, target, unit, ab in rows)


_TAGGED = sorted({tag for tag, _ in _BY_TAG})
_TAGS = ", ".join(map(_text, _TAGGED))
_NONE = ", ".join(_text(t) for t in NO_UNIT)
_PLAIN = "translate(lower({}), 'μµº .' || chr(160) || chr(9) || chr(10) || chr(13), 'uu°')"
_SAID = r"(?i)(?:\[([^\[\]]+)\]\s*$|\(([^()]+)\)\s*$|(?:units?\s*=|eenheid:|unit:|recorded as|waarde in|given in|set to|ingevoerd in|,)\s*([^;,=:]+?)\s*(?:;.*)?$)"
_LEAD = r"(?i)^(?:\[|\(|units?\s*=|eenheid:|unit:|recorded as|waarde in|given in|set to|ingevoerd in|,)\s*"
_COMMENT = _PLAIN.format(f"regexp_replace(regexp_replace(regexp_replace(regexp_extract(comment, '{_SAID}', 0), '{_LEAD}', ''), '\\s*;.*$', ''), '[\\])]\\s*$', '')")
_LABEL = _PLAIN.format(r"regexp_replace(regexp_extract(item, '(?:\(([^()]*)\)|, ([^,()]+))\s*$', 0), '^(?:\(|, )|\)\s*$', '', 'g')")

CONVERTED = f"""sp(t, u) as (select t, unitid from (values {_spellings()}) v(t, n) join units on units.unit = v.n),
cv as (select i.itemid, u.unitid as u, a, b from (values {_conversions()}) c(tag, target, unit, a, b) join items i on i.target_unit = c.target and c.tag = case when i.tag in ({_TAGS}) then i.tag else '*' end join units u on u.unit = c.unit),
r0 as (select n.*, case when not isnan(value) then value end as v, {_PLAIN.format('n.unit')} as tu, {_COMMENT} as tc, {_LABEL} as ti from numericitems n),
r1 as (select r0.*, coalesce(a.u, case when unitid in (select unitid from units where unit <> 'None') then unitid end, b.u, c.u) as named
  from r0 left join sp a on a.t = tu and tu not in ({_NONE}) left join sp b on b.t = tc and tc not in ({_NONE}) left join sp c on c.t = ti and ti not in ({_NONE})),
us as (select itemid, quantile_disc(case when named = target_unitid then v end, 0.01) as lo, quantile_disc(case when named = target_unitid then v end, 0.5) as mid, quantile_disc(case when named = target_unitid then v end, 0.99) as hi, list(distinct named) as used from r1 join items using (itemid) where v is not null group by 1),
g as (select r1.numericid, r1.itemid, r1.v, min(struct_pack(d := case when lo > 0 then abs(ln((v * a + b) / mid)) else abs(v * a + b - mid) end, u := cv.u)) as best from r1 join items i using (itemid) join us using (itemid) join cv on cv.itemid = r1.itemid join units su on su.unitid = cv.u join units tu on tu.unitid = i.target_unitid
  where named is null and (v < physmin or v > physmax) and cv.u <> i.target_unitid and su.quantity = tu.quantity and not (a = 1 and b = 0) and list_contains(used, cv.u) and v * a + b between physmin and physmax and (lo <= 0 or v * a + b > 0)
  and (lo = hi or case when lo > 0 then abs(ln((v * a + b) / mid)) else abs(v * a + b - mid) end <= {SCATTERS} * case when lo > 0 then ln(hi / lo) else hi - lo end / 4.652696) group by all),
k as (select r1.*, i.target_unitid as target, coalesce(named, g.best.u) as given from r1 left join items i using (itemid) left join g on g.numericid = r1.numericid and g.itemid = r1.itemid and g.v = r1.v),
z as (select k.*, case when target is null or given is null or given = target then v else v * a + b end as target_value, coalesce(target is not null and given <> target and v is not null and a is not null and not (a = 1 and b = 0), false) as changed from k left join cv on cv.itemid = k.itemid and cv.u = k.given)"""

ORACLES = {
    "p6_found": f"with {CONVERTED} select distinct numericid from z where changed",
    "p6_converted": f"with {CONVERTED} select numericid, admissionid, itemid, v as value, round(target_value + 0.0, 6) as target_value, changed as target_value_changed from z",
}
