"""Splits that keep related records together: linked records by components, and grouped iterative stratification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.session import discard, stored

#: Edges of a node that meet its minimum in one task; a node with more is a hub, spread over several.
HUB = 10_000
#: Hubs at most: of n edges, few enough nodes have more than 2 n / MAX_HUBS.
MAX_HUBS = 500_000
#: Rounds of star contraction; each at least halves what is left of a path, so this covers any table.
MAX_ROUNDS = 60


def _contracted(edges: DataFrame, n: int) -> DataFrame:
    """One large-star and one small-star step on n edges (a, b), a > b."""
    hub = max(HUB, 2 * n // MAX_HUBS)
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Large star: link every larger neighbour to the least node around. The minimum is taken by an
    # aggregation (partial on the map side), and a hub's edges meet it in a salted join.
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n"))
    large = _meet(both.filter("b > a"), least, hub).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    # Small star: link a node and its smaller neighbours to the least of them.
    low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    met = _meet(large, low, hub)
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _meet(edges: DataFrame, of: DataFrame, hub: int) -> DataFrame:
    """edges (a, b) joined with of (a, m, n edges). A hub's edges are spread over as many salts as it has
    times `hub` edges; other nodes have one salt, and nothing of them is copied."""
    # At most MAX_HUBS rows, by the choice of `hub`.
    hubs = F.broadcast(of.filter(F.col("n") > hub).select("a", F.ceil(F.col("n") / F.lit(hub)).cast("int").alias("k")))
    salted = edges.join(hubs, "a", "left").withColumn("s", F.coalesce(F.pmod(F.xxhash64("b"), F.col("k")).cast("int"), F.lit(0))).drop("k")
    spread = of.select("a", "m", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / F.lit(hub)).cast("int") - 1)).alias("s"))
    return salted.join(spread, ["a", "s"]).drop("s")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b), whole numbers; component is its least node.

    Alternating large-star and small-star steps until nothing changes. Loops, repeated edges and either
    direction are allowed; edges with a null end are passed over. Each round is written to the shared
    folder, so no lineage grows and a lost executor costs at most the round; the round before is deleted.
    """
    clean = stored(edges.filter("a is not null and b is not null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = clean.select(F.col("a").alias("node")).unionByName(clean.select(F.col("b").alias("node"))).distinct()
    now = clean.filter("a <> b")
    mark = _fingerprint(now)
    for at in range(MAX_ROUNDS):
        after = stored(_contracted(now, mark[0]))
        seen = _fingerprint(after)
        if at:
            discard(now)
        now, stop, mark = after, seen == mark, seen
        if stop:
            break
    else:
        raise RuntimeError(f"components didn't settle in {MAX_ROUNDS} rounds")
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def linked_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df's distinct key tuples with `__component`: records share it if they share a value of any key,
    directly or through further records. A null links nothing; a record without any value is alone.

    Keys are whole numbers between -2^60 and 2^60 / number of keys (beyond, ANSI arithmetic raises).
    """
    c = lambda name: F.col(f"`{name}`")
    k = len(keys)
    nodes = [(c(name).cast("long") * F.lit(k) + F.lit(i)) for i, name in enumerate(keys)]
    rows = df.select(*[c(name) for name in keys], *[n.alias(f"__n{i}") for i, n in enumerate(nodes)]).distinct()
    rows = rows.withColumn("__anchor", F.coalesce(*[f"__n{i}" for i in range(k)]))
    pairs = F.explode(F.array(*[F.struct(F.col("__anchor").alias("a"), F.col(f"__n{i}").alias("b")) for i in range(k)]))
    edges = rows.select(pairs.alias("p")).select("p.a", "p.b").filter("a is not null and b is not null")
    found = connected_components(edges).select(F.col("node").alias("__anchor"), F.col("component").alias("__component"))
    return rows.join(found, "__anchor", "left").select(*[c(name) for name in keys], "__component")


def normal_split(text: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    """The split that a text names, without regard to case and outer blanks; else null."""
    said = F.lower(F.trim(F.regexp_replace(text, r"[\s ]+", " ")))
    out = F.lit(None).cast("string")
    for name, ways in spellings.items():
        out = F.when(said.isin(name, *ways), F.lit(name)).otherwise(out)
    return out


def disagreeing(df: DataFrame, keys: Sequence[str], split: str, spellings: Mapping[str, Sequence[str]]) -> DataFrame:
    """df's distinct key tuples in components whose records name more than one split.

    Texts outside the spellings, empty and null ones name none; all rows count, repeated ones once.
    """
    c = lambda name: F.col(f"`{name}`")
    linked = linked_records(df, keys)
    same = [linked[name].eqNullSafe(F.col(f"__r_{name}")) for name in keys]
    said = df.select(*[c(name).alias(f"__r_{name}") for name in keys], normal_split(c(split), spellings).alias("__split")).filter("__split is not null").distinct()
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    torn = linked.join(said, cond).groupBy("__component").agg(F.min("__split").alias("lo"), F.max("__split").alias("hi")).filter("lo <> hi").select("__component")
    return linked.join(torn, "__component", "left_semi").select(*[c(name) for name in keys])


def stratified_splits(groups: DataFrame, group: str, size: str, labels: Sequence[str], shares: Mapping[str, float], seed: int = 0) -> DataFrame:
    """(group, split): whole groups placed so that sizes and label counts come near their shares.

    groups has one row per group with its size and a number for each label. Grouped iterative
    stratification: the label with the fewest outstanding records comes first, and the groups that hold
    it go to the splits in proportion to what each still needs of it. They stand in a line, those with
    more of the label first (by powers of two) and then by a hash, and the line is cut into equal
    stretches twice as long as the largest group; in each stretch every split has a part as long as its
    need, and a group goes where its middle lies. So each split has its part of the large groups as of
    the small ones, and the next label makes good what whole groups left over. What holds no label
    follows by size. It is the same at every size; nothing but sums reaches the driver.

    Ties are broken by the label's place in the list, the split's place, and the group's hash. Null labels
    and sizes are 0, groups of size 0 are placed too, a null group is one group, shares must add up to 1.
    """
    names = list(shares)
    if not names or abs(sum(shares.values()) - 1) > 1e-9 or min(shares.values()) < 0:
        raise ValueError("shares must be at least 0 and add up to 1")
    c = lambda name: F.col(f"`{name}`")
    kinds = [f"l{i}" for i in range(len(labels))] + ["size"]
    rows = groups.select(c(group).alias("g"), *[F.coalesce(c(x).cast("double"), F.lit(0.0)).alias(k) for x, k in zip([*labels, size], kinds)])
    left = stored(rows.withColumn("h", F.xxhash64(F.lit(seed), "g")))
    totals = left.agg(*[F.sum(k).alias(k) for k in kinds]).first()
    need = {s: {k: shares[s] * float(totals[k] or 0) for k in kinds} for s in names}
    placed = None
    while kinds:
        sums = left.agg(*[F.sum(k).alias(k) for k in kinds], *[F.max(k).alias(f"max_{k}") for k in kinds]).first()
        live = [k for k in kinds if (sums[k] or 0) > 0]
        if not live:
            break
        rare = min(live, key=lambda k: (k == "size", sums[k], kinds.index(k)))
        done = stored(_placed(left.filter(F.col(rare) > 0), rare, sums[rare], sums[f"max_{rare}"], {s: max(need[s][rare], 0.0) for s in names}, shares).select("g", "split", *kinds))
        for r in done.groupBy("split").agg(*[F.sum(k).alias(k) for k in kinds]).collect():
            for k in kinds:
                need[r["split"]][k] -= r[k]
        placed = done.select("g", "split") if placed is None else placed.unionByName(done.select("g", "split"))
        left = left.filter(~(F.col(rare) > 0))
        kinds = [k for k in kinds if k != rare]
    rest = left.filter(" and ".join(["size = 0"] + [f"l{i} = 0" for i in range(len(labels))])).select("g", F.lit(max(names, key=lambda s: shares[s])).alias("split"))
    return (rest if placed is None else placed.unionByName(rest)).select(F.col("g").alias(group), "split")


#: Parts of the hash's range, of each power of two, in which a line of groups is summed up on its own.
PARTS = 256


def _placed(here: DataFrame, rare: str, total: float, most: float, wanted: Mapping[str, float], shares: Mapping[str, float]) -> DataFrame:
    """The groups that hold the label, with the split that each goes to."""
    if not sum(wanted.values()):
        wanted = shares
    here = here.withColumn("part", F.struct((-F.floor(F.log2(rare))).cast("int").alias("large"), F.pmod("h", F.lit(PARTS)).cast("int").alias("at")))
    # At most PARTS rows for each power of two.
    parts = here.groupBy("part").agg(F.sum(rare).alias("m"))
    before = parts.select("part", (F.sum("m").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")).alias("before"))
    along = Window.partitionBy("part").orderBy("h", "g").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.sum(rare).over(along) - F.col(rare) / 2 + F.col("before")
    stretch = total / max(1, int(total // (2 * most)))
    names, scale = list(wanted), stretch / sum(wanted.values())
    edges, upto = [], 0.0
    for s in names:
        upto += wanted[s] * scale
        edges.append((s, upto))
    put = F.lit(max(names, key=lambda s: wanted[s]))
    for s, edge in reversed(edges):
        put = F.when(F.col("mid") < F.lit(edge), F.lit(s)).otherwise(put)
    return here.join(before, "part").withColumn("mid", F.pmod(middle, F.lit(stretch))).withColumn("split", put)
