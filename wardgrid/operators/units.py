"""Quantities recorded in different units, brought to one unit per item.

Conversions are edges of a graph with affine functions. The shortest composition from every unit to
an item's target is worked out once on the driver (the graph is the fixed table of units), every
cycle is checked for consistency, and the rows are equi-joined on (item, unit).
"""

from __future__ import annotations

import math
from collections import defaultdict, deque
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardgrid.functions.unit_tables import CHARGE, GENERAL_EDGES, MOLAR_MASS, NO_UNIT, SPELLINGS

Edge = tuple[str, str, float, float]
#: A target graph is built for at most this many item rows; the items table is a fixed one.
MAX_ITEMS = 100_000
#: Scatters from the usual values beyond which a value is a fault in any scale (as 999 for no reading), as
#: with problem 3; and how many scatters the central 98 % of values span.
SCATTERS, CENTRAL_98 = 6.0, 4.652696


class InconsistentConversions(ValueError):
    """Two ways between the same units give different values."""


def compose(edges: Iterable[Edge], target: str, tolerance: float = 1e-3) -> dict[str, tuple[float, float]]:
    """For each unit that reaches target, (a, b) with target = a * x + b, along the fewest edges.

    Raises InconsistentConversions if an edge disagrees with the composed functions of its ends by
    more than tolerance, that is, if some cycle isn't the identity.
    """
    to: dict[str, list[tuple[str, float, float]]] = defaultdict(list)
    edges = list(edges)
    for u, v, a, b in edges:
        if a == 0:
            raise ValueError(f"{u} to {v}: a conversion by 0 can't be undone")
        to[v].append((u, a, b))
        to[u].append((v, 1 / a, -b / a))
    found = {target: (1.0, 0.0)}
    queue = deque([target])
    while queue:
        v = queue.popleft()
        p, q = found[v]
        for u, a, b in to[v]:
            if u not in found:
                found[u] = (p * a, p * b + q)
                queue.append(u)
    for u, v, a, b in edges:
        if u in found and v in found:
            p, q = found[v]
            (x, y), scale = (p * a, p * b + q), abs(found[u][0])
            if abs(x - found[u][0]) > tolerance * scale or abs(y - found[u][1]) > tolerance * max(scale, abs(found[u][1])):
                raise InconsistentConversions(f"{u} to {target}: by {v} {x:g}, {y:g}; directly {found[u]}")
    return found


def substance_edges(tag: str | None) -> list[Edge]:
    """Edges that depend on what is measured: mass and amount of substance, charge and amount."""
    edges: list[Edge] = []
    if tag in MOLAR_MASS:
        edges.append(("mmol/l", "mg/l", MOLAR_MASS[tag], 0.0))
    if tag in CHARGE:
        edges.append(("mmol/l", "mEq/l", float(CHARGE[tag]), 0.0))
    return edges


def normal_text(text: Column) -> Column:
    """A unit's spelling without case, blanks, full stops and variant signs."""
    return F.translate(F.lower(text), "μµº .\u00a0\t\n\r", "uu°")


def _spelt(text: str) -> str:
    return text.lower().translate(str.maketrans("μµº", "uu°", " .\u00a0\t\n\r"))


def _label_unit(text: Column) -> Column:
    """The unit that ends an item's label, in brackets or after a comma."""
    return F.regexp_extract(text, r"(?:\(([^()]*)\)|, ([^,()]+))\s*$", 0)


def _strip(found: Column) -> Column:
    return F.regexp_replace(found, r"^(?:\(|, )|\)\s*$", "")


def _comment_unit(text: Column) -> Column:
    """The unit that a comment states: after = : in as to of, a comma, or in brackets, at a clause's end."""
    return F.regexp_extract(text, r"(?i)(?:\[([^\[\]]+)\]\s*$|\(([^()]+)\)\s*$|(?:units?\s*=|eenheid:|unit:|recorded as|waarde in|given in|set to|ingevoerd in|,)\s*([^;,=:]+?)\s*(?:;.*)?$)", 0)


def _strip_comment(found: Column) -> Column:
    inner = F.regexp_replace(found, r"(?i)^(?:\[|\(|units?\s*=|eenheid:|unit:|recorded as|waarde in|given in|set to|ingevoerd in|,)\s*", "")
    return F.regexp_replace(F.regexp_replace(inner, r"\s*;.*$", ""), r"[\])]\s*$", "")


def _said(text: Column, known: Sequence[str]) -> Column:
    """The known spelling that a comment names: after a phrase that leads to one, or else at the end of its
    first clause, the longest of one to three words. There, one right after a number is an amount, and one
    of a letter or two may be anything, so these are none."""
    clause = F.trim(F.regexp_replace(F.regexp_extract(text, r"^([^;]*)", 1), r"[)\]\s.]+$", ""))
    plain = [s for s in known if len(s) > 2 or not s.isalpha()]

    def last(ws: Column, k: int) -> Column:
        n = F.size(ws)
        amount = F.coalesce(F.get(ws, n - k - 1).rlike(r"^[\d.,]+$"), F.lit(False))
        return F.when((n >= k) & ~amount, F.array_join(F.slice(ws, n - k + 1, k), ""))

    def named(ws: Column) -> Column:
        ways = F.transform(F.array(_strip_comment(_comment_unit(text)), last(ws, 3), last(ws, 2), last(ws, 1)), normal_text)
        return F.get(F.filter(ways, lambda t, i: F.when(i == 0, t.isin(*known)).otherwise(t.isin(*plain) if plain else F.lit(False))), 0)

    # The words are bound once.
    words = F.split(F.regexp_replace(clause, r"[=:,(\[]", " "), r"\s+")
    return F.get(F.transform(F.array(words), named), 0)


def _alias_rows(units: Sequence[tuple[int, str]]) -> dict[str, int]:
    ids = {u: i for i, u in units}
    rows = {_spelt(s): ids[u] for u, all_ in SPELLINGS.items() if u in ids for s in (*all_, u)}
    return {_spelt(u): i for u, i in ids.items() if u not in (None, "None")} | rows


def _alias_frame(spark, units: Sequence[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame(sorted(_alias_rows(units).items()), "__t string, __u long")


def _conversions(items: Sequence, units: Sequence[tuple[int, str]], extra_edges: Iterable[Edge]) -> list[tuple]:
    """(itemid, unitid, a, b, same quantity) of every unit that reaches an item's target."""
    ids = {u: i for i, u in units}
    rows = []
    for item in items:
        known = compose([*GENERAL_EDGES, *substance_edges(item["tag"]), *extra_edges], item["target_unit"])
        for u, (a, b) in known.items():
            if u in ids:
                rows.append((item["itemid"], ids[u], float(a), float(b)))
    return rows


def recorded_unit(df: DataFrame, units: Sequence[tuple[int, str]]) -> DataFrame:
    """Adds __unit, the unitid that a row names: by unit, else unitid, else comment, else item; else null.

    A text names a unit if its normalised spelling is known. null, 0, the empty text, None, Geen,
    - and the unitid of None name none; a spelling or an id that isn't known names none either.
    """
    spark = df.sparkSession
    alias = _alias_frame(spark, units)
    valid = [i for i, u in units if u != "None"]
    # The list of spellings is a constant: a broadcast of fixed size.
    lookup = lambda k: F.broadcast(alias.select(F.col("__t").alias(k), F.col("__u").alias(f"{k}_id")))
    text = lambda c: F.when(~c.isin(*NO_UNIT), c)
    out = df.withColumn("__tu", text(normal_text(F.col("unit")))).join(lookup("__tu"), "__tu", "left")
    named_id = F.when(F.col("unitid").isin(*valid), F.col("unitid")) if valid else F.lit(None).cast("long")
    out = out.withColumn("__unit", F.coalesce("__tu_id", named_id)).drop("__tu", "__tu_id")
    # Only rows that name no unit so far have their comment and label searched.
    known = sorted(_alias_rows(units))
    said = _said(F.col("comment"), known) if known else F.lit(None).cast("string")
    for k, found in (("__tc", said), ("__ti", normal_text(_strip(_label_unit(F.col("item")))))):
        out = out.withColumn(k, F.when(F.col("__unit").isNull(), text(found))).join(lookup(k), k, "left")
        out = out.withColumn("__unit", F.coalesce("__unit", f"{k}_id")).drop(k, f"{k}_id")
    return out


#: Relative width of the buckets in which usual values are counted, and what keeps their numbers above 0.
WIDTH, OFFSET = 0.002, 400_000


def _bucket(v: Column) -> Column:
    """The signed logarithmic bucket of a value."""
    size = F.ceil(F.log(F.abs(v)) / F.lit(math.log1p(WIDTH))) + F.lit(OFFSET)
    return F.when(v == 0, 0).otherwise(F.signum(v) * size).cast("int")


def _middle(b: Column) -> Column:
    """The middle of a bucket."""
    return F.signum(b) * F.pow(F.lit(1 + WIDTH), F.abs(b) - F.lit(OFFSET)) * F.lit(2 / (2 + WIDTH)) * (b != 0).cast("double")


def convert_units(
    df: DataFrame, items: DataFrame, units: DataFrame, extra_edges: Iterable[Edge] = (), out: str = "target_value", bounds: bool = False
) -> DataFrame:
    """Adds `out`, the value in the item's target unit, and `out`_changed, whether conversion changes it.

    df has itemid, item, value, unitid, unit, comment, and may have more columns, which stay; items has
    itemid, tag, target_unit, target_unitid, physmin, physmax; units has unitid, unit, quantity. A row
    that names no unit is in the target unit, unless its value is outside physmin to physmax and
    another unit of the target's quantity, one that rows of this item name in any way, brings it within
    physmin to physmax and within SCATTERS scatters of the median of the item's values named as in the
    target unit; then it is in the unit that brings it nearest to their median. Distances are ratios,
    or differences where such values reach 0 or below; values without scatter leave it to the bounds.

    A null or NaN value gives a null and false. An unknown item, an item without a target, and a unit
    that can't reach the target keep their value, unchanged (`out` null for the last). Ties between
    units go to the lower unitid. Repeated rows are treated alike; an empty table gives none. `bounds`
    keeps the item's physmin, physmax and measured as __physmin, __physmax and __measured.
    """
    spark = df.sparkSession
    known_units = units.select("unitid", "unit", "quantity").filter("unitid is not null").limit(MAX_ITEMS + 1).collect()
    unit_rows = [(r["unitid"], r["unit"]) for r in known_units]
    quantity = {r["unitid"]: r["quantity"] for r in known_units}
    keep = ["itemid", "tag", "target_unit", "target_unitid", "physmin", "physmax"]
    item_rows = items.select(*keep, *(["measured"] if "measured" in items.columns else [])).limit(MAX_ITEMS + 1).collect()
    if max(len(item_rows), len(known_units)) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} items or units: the conversion graph is meant for a catalogue")
    known = list({r["itemid"]: r for r in item_rows if r["target_unit"] is not None and r["itemid"] is not None}.values())
    conv = _conversions(known, unit_rows, extra_edges)
    schema = "itemid long, __unit long, __a double, __b double"
    conversions = spark.createDataFrame(conv, schema)
    # Items as a constant of bounded size, with the units another scale may be taken from.
    target = {r["itemid"]: r for r in known}
    others = defaultdict(list)
    for itemid, unitid, a, b in sorted(conv):
        t = target[itemid]
        if unitid != t["target_unitid"] and quantity.get(unitid) == quantity.get(t["target_unitid"]) and not (a == 1 and b == 0):
            others[itemid].append((unitid, a, b))
    info_schema = T.StructType.fromDDL("itemid long, __target long, __physmin double, __physmax double, __measured boolean, __others array<struct<u:long,a:double,b:double>>")
    info = spark.createDataFrame([(r["itemid"], r["target_unitid"], r["physmin"], r["physmax"], r["measured"] if "measured" in r else None, others[r["itemid"]]) for r in known], info_schema)

    number = F.when(~F.isnan("value"), F.col("value"))
    named = recorded_unit(df, unit_rows)
    # Counts by item, unit and, of values named as in the target unit, bucket: added up, they are the same in any order.
    counts = (
        named.select("itemid", "__unit", number.alias("__v")).join(F.broadcast(info.select("itemid", "__target", "__others")), "itemid")
        .filter("__v is not null and size(__others) > 0")
        .groupBy("itemid", "__unit", F.when(F.col("__unit") == F.col("__target"), _bucket(F.col("__v"))).alias("__b")).agg(F.count("*").alias("__n"))
    )
    along = Window.partitionBy("itemid").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    here = F.when(F.col("__b").isNotNull(), F.col("__n")).otherwise(0)
    ranked = counts.withColumns({"__upto": F.sum(here).over(along), "__all": F.sum(here).over(Window.partitionBy("itemid"))})
    at = lambda q: _middle(F.min(F.when(F.col("__b").isNotNull() & (F.col("__upto") > F.lit(q) * (F.col("__all") - 1)), F.col("__b"))))
    usual = ranked.groupBy("itemid").agg(F.array(at(0.01), at(0.5), at(0.99)).alias("__usual"), F.collect_set("__unit").alias("__used"))
    # A row for each item of the catalogue, at most MAX_ITEMS.
    about = F.broadcast(info.join(usual, "itemid", "left"))
    rows = named.withColumn("__v", number).join(about, "itemid", "left")
    outside = F.col("__unit").isNull() & ((F.col("__v") < F.col("__physmin")) | (F.col("__v") > F.col("__physmax")))
    distance = "case when __usual[0] > 0 then abs(ln(o.y / __usual[1])) else abs(o.y - __usual[1]) end"
    scatter = f"case when __usual[0] > 0 then ln(__usual[2] / __usual[0]) else __usual[2] - __usual[0] end / {CENTRAL_98}"
    candidates = F.expr(
        f"filter(transform(transform(filter(__others, o -> array_contains(__used, o.u)), o -> struct(o.u as u, __v * o.a + o.b as y)), o -> struct({distance} as d, o.u as u, o.y as y)), "
        f"c -> c.d is not null and c.y >= coalesce(__physmin, c.y) and c.y <= coalesce(__physmax, c.y) and (__usual[0] = __usual[2] or c.d <= {SCATTERS} * {scatter}))"
    )
    guessed = F.when(outside, F.array_min(candidates)["u"])
    other = F.coalesce("__unit", guessed)
    rows = rows.withColumn("__unit", F.when(other != F.col("__target"), other)).join(F.broadcast(conversions), ["itemid", "__unit"], "left")
    untouched = F.col("__unit").isNull()
    value = F.when(untouched, F.col("__v")).otherwise(F.col("__v") * F.col("__a") + F.col("__b"))
    changed = F.coalesce(~untouched & F.col("__v").isNotNull() & F.col("__a").isNotNull() & ~((F.col("__a") == 1) & (F.col("__b") == 0)), F.lit(False))
    rows = rows.withColumns({out: value, f"{out}_changed": changed})
    extra = ["__physmin", "__physmax", "__measured"] if bounds else []
    return rows.select(*[F.col(f"`{c}`") for c in df.columns if c not in (out, f"{out}_changed")], out, f"{out}_changed", *extra)
