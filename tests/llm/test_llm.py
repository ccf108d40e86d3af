import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardgrid.llm import sketch as sk
from wardgrid.llm.leakage import KeyTable, LeakRules, covered_words, find_leaks, leaks_among, tiles
from wardgrid.llm.packing import count_tokens, pack, plan_bins, reduce_by_dominance
from wardgrid.llm.spam import find_spam
from wardgrid.llm.splits import connected_components, disagreeing, linked_records, stratified_splits
from wardgrid.llm.textnorm import letters, plain, words

# Percentiles


@pytest.mark.parametrize("seed", range(3))
def test_sketch_error_and_merging(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.lognormal(0, 5, 2000), -rng.lognormal(2, 3, 700), np.zeros(100)])
    df = spark.createDataFrame([(int(i % 3), int(i % 7), float(v)) for i, v in enumerate(values)], "g long, day long, v double")
    at = {"lo": 0.0, "q": 0.25, "m": 0.5, "h": 0.95, "hi": 1.0}
    whole = sk.percentiles(sk.sketch(df, ["g"], "v"), ["g"], at)
    merged = sk.percentiles(sk.combine(sk.sketch(df, ["g", "day"], "v"), ["g"]), ["g"], at)
    assert rows(whole) == rows(merged)
    for r in whole.collect():
        mine = np.sort(values[np.arange(len(values)) % 3 == r["g"]])
        assert r["n"] == len(mine)
        for name, q in at.items():
            exact = mine[math.floor(q * (len(mine) - 1))]
            assert abs(r[name] - exact) <= sk.ERROR * abs(exact) * (1 + 1e-9)


def test_sketch_of_odd_values(spark):
    df = spark.createDataFrame([(None, 1.0, 1), (None, None, 1), (1, math.nan, 1), (1, math.inf, 1), (1, -math.inf, 1), (1, 0.0, 1), (2, 5e-324, 1), (3, 1.7e308, 1), (4, -1.7e308, 1)], "g long, v double, bucket int")
    got = {r["g"]: (r["n"], r["p"]) for r in sk.percentiles(sk.sketch(df, ["g"], "v"), ["g"], {"p": 1.0}).collect()}
    assert got[None] == (1, pytest.approx(1, rel=sk.ERROR)) and got[1] == (3, math.inf)
    assert got[3][1] == pytest.approx(1.7e308, rel=0.0051) and got[4][1] == pytest.approx(-1.7e308, rel=0.0051) and got[2][0] == 1
    assert sk.percentiles(sk.sketch(df.filter("false"), ["g"], "v"), ["g"], {"p": 0.5}).count() == 0
    with pytest.raises(ValueError):
        sk.bucket(F.lit(1.0), 0.0)


# Splits


def union_find(edges):
    parent = {}

    def find(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in parent}


@pytest.mark.parametrize("kind", ["random", "path", "star", "loops"])
def test_components(spark, kind):
    rng = random.Random(kind)
    edges = {"random": [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(60)], "path": [(i, i + 1) for i in range(64)], "star": [(7, i) for i in range(100)] + [(200, 201)], "loops": [(1, 1), (2, 2), (2, 3), (3, 2), (2, 3)]}[kind]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, (None, 5000), (5001, None)], "a long, b long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == union_find(edges)
    assert connected_components(df.filter("false")).count() == 0


def test_components_with_hubs_spread(spark, monkeypatch):
    from wardgrid.llm import splits

    monkeypatch.setattr(splits, "HUB", 5)
    rng = random.Random(21)
    edges = [(3, i) for i in range(80)] + [(rng.randint(100, 140), rng.randint(100, 400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 530)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find(edges)


def test_rounds_leave_no_tables_behind(spark):
    import glob

    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = len(glob.glob(f"{folder}/wardgrid-*"))
    connected_components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
    # The cleaned edges and the last round.
    assert len(glob.glob(f"{folder}/wardgrid-*")) == before + 2


def test_persons_whose_splits_disagree(spark):
    data = [(1, 10, 100, "train "), (2, 10, 101, "TRAINING"), (2, 11, 102, "Test"), (3, 12, 103, "val"), (3, 12, 104, "valid"), (4, 13, 105, ""), (4, 13, 106, None), (4, 13, 107, "unassigned"), (5, 14, 108, "held-out"), (6, 15, 108, "train"), (None, None, 109, "train"), (None, 16, 110, "train"), (7, None, 111, "test"), (3, 12, 103, "val")]
    df = spark.createDataFrame(data, "s long, p long, d long, split string")
    spellings = {"train": ("training",), "val": ("valid", "validation"), "test": ("held-out",)}
    found = disagreeing(df, ["s", "p", "d"], "split", spellings)
    assert rows(found.filter("s is not null").select("s").distinct()) == [(1,), (2,), (5,), (6,)]
    linked = {(r["s"], r["p"], r["d"]): r["__component"] for r in linked_records(df, ["s", "p", "d"]).collect()}
    assert linked[1, 10, 100] == linked[2, 11, 102] != linked[3, 12, 103]
    assert linked[5, 14, 108] == linked[6, 15, 108]
    assert disagreeing(df.filter("false"), ["s", "p", "d"], "split", spellings).count() == 0


def test_stratified(spark):
    rng = random.Random(4)
    data = [(g, n := (400 if g == 0 else rng.choice([1, 1, 2, 5])), sum(rng.random() < 0.3 for _ in range(n)), int(rng.random() < 0.02), None) for g in range(3000)]
    df = spark.createDataFrame([*data, (None, 1, 0, 1, None), (5000, 0, 0, 0, None), (5001, None, None, None, None)], "g long, size long, common long, rare long, split string")
    shares = {"train": 0.7, "val": 0.15, "test": 0.15}
    got = stratified_splits(df, "g", "size", ["common", "rare"], shares, seed=1)
    assert got.count() == 3003 == got.select("g").distinct().count()
    where = {r["g"]: r["split"] for r in got.collect()}
    for at in (1, 2, 3):
        total = sum(r[at] or 0 for r in df.collect())
        for s, share in shares.items():
            mine = sum(r[at] or 0 for r in df.collect() if where[r["g"]] == s)
            assert abs(mine - share * total) <= max(6, 0.03 * total), (at, s, mine, share * total)
    assert stratified_splits(df.filter("false"), "g", "size", ["common"], shares).count() == 0


# Packing


@pytest.mark.parametrize("seed", range(4))
def test_plans_are_packings(seed):
    rng = random.Random(seed)
    for _ in range(60):
        capacity = rng.choice([7, 20, 64])
        counts = {}
        for _ in range(rng.randint(0, 50)):
            s = rng.randint(1, capacity)
            counts[s] = counts.get(s, 0) + rng.randint(1, 9)
        load, seen = {}, {}
        for slot in plan_bins(counts, capacity):
            for r in range(slot.first, slot.last):
                b = slot.bin + (r - slot.first) // slot.each
                load[b] = load.get(b, 0) + slot.size
                seen[slot.size, r] = seen.get((slot.size, r), 0) + 1
        assert max(load.values(), default=0) <= capacity
        assert seen == {(s, r): 1 for s, n in counts.items() for r in range(n)}
        first_fit = []
        for x in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
            at = next((i for i, b in enumerate(first_fit) if b + x <= capacity), None)
            first_fit.append(x) if at is None else first_fit.__setitem__(at, first_fit[at] + x)
        assert len(load) <= len(first_fit)


def best(items, capacity):
    """The least number of bins, by trying all ways."""
    if not items:
        return 0
    first, rest = items[0], items[1:]
    out = len(items)
    for mask in range(1 << len(rest)):
        mine = [x for i, x in enumerate(rest) if mask >> i & 1]
        if first + sum(mine) <= capacity:
            out = min(out, 1 + best([x for i, x in enumerate(rest) if not mask >> i & 1], capacity))
    return out


def test_reduction_keeps_the_optimum():
    rng = random.Random(5)
    for _ in range(60):
        items = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 7))), reverse=True)
        counts = {s: items.count(s) for s in items}
        fixed, left = reduce_by_dominance(counts, 12)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + best(rest, 12) == best(items, 12)


def test_sets_of_three_dominate():
    from wardgrid.llm.packing import _third

    # Beside 60, room is 40: 25 and 14 fit; no three others do, and no two above 14.
    assert reduce_by_dominance({60: 2, 25: 2, 14: 2}, 100) == ([((60, 25, 14), 2)], {})
    # 13 and 27 would fill the room and can't take the places of 28 and 12, both above 12.
    assert _third({28: 1, 27: 1, 13: 1, 12: 1}, 28, 40) is None
    # Three small ones fit.
    assert _third({25: 1, 14: 1, 5: 3}, 25, 40) is None


@pytest.mark.parametrize("seed", range(3))
def test_fixed_sets_of_any_number_keep_the_optimum(seed):
    rng, threes = random.Random(seed), 0
    for _ in range(400):
        items = [rng.randint(4, 22) for _ in range(rng.randint(3, 7))]
        counts = {s: items.count(s) for s in items}
        fixed, left = reduce_by_dominance(counts, 30)
        threes += any(len(f) == 3 for f, _ in fixed)
        assert all(sum(f) <= 30 for f, _ in fixed)
        assert sum(n for _, n in fixed) + best([s for s, n in left.items() for _ in range(n)], 30) == best(items, 30)
    assert threes > 20


def test_pack_of_many_full_pieces_and_of_one_size(spark, monkeypatch):
    from wardgrid.llm import packing

    monkeypatch.setattr(packing, "RANKED", 7)
    df = spark.createDataFrame([(i, 10) for i in range(200)] + [(i, 3) for i in range(100)] + [(500, 95)], "doc_id long, n long").repartition(5)
    got = pack(df, "doc_id", "n", 10).collect()
    load = {}
    for r in got:
        load[r["bin"]] = load.get(r["bin"], 0) + r["size"]
    assert len(got) == 310 and max(load.values()) == 10
    # 209 full ones, and three 3s in a bin but for one with the rest of 5.
    assert len(load) == 209 + 34


def test_pack_divides_only_what_is_longer(spark):
    df = spark.createDataFrame([(1, 25), (2, 10), (3, 7), (4, 3), (None, 4), (5, 0), (6, None), (7, -1), (3, 7), (8, 10)], "doc_id long, n long").withColumn("bin", F.lit("x"))
    got = pack(df, "doc_id", "n", 10).collect()
    assert sorted((r["piece"], r["first"], r["size"]) for r in got if r["doc_id"] == 1) == [(0, 0, 10), (1, 10, 10), (2, 20, 5)]
    assert sum(r["size"] for r in got) == 25 + 10 + 7 + 3 + 4 + 7 + 10 and len(got) == 9
    load = {}
    for r in got:
        load[r["bin"]] = load.get(r["bin"], 0) + r["size"]
    assert max(load.values()) <= 10 and len(load) == 7
    assert pack(df.filter("false"), "doc_id", "n", 10).count() == 0


def test_tokens_of_whole_texts(spark):
    from wardgrid.llm.queries import TOKENIZER

    long = "word " * 50_000
    df = spark.createDataFrame([(1, "hello world", "a"), (2, "", "a"), (3, None, "a"), (4, long, "a"), (5, "<|endoftext|>", "a")], "doc_id long, text string, n_tokens string")
    got = dict(rows(count_tokens(df, "doc_id", "text", TOKENIZER)))
    assert got[2] == got[3] == 0 and 2 <= got[1] <= 4 and got[4] >= 50_000 and got[5] > 1


# Leakage

PASSAGE = (
    "A retired organ tuner of sixty six collapses beside a muddy harbour after tasting amber broth because osteric antibodies from Harkenton bind the"
    " pulmifentor while scans outline a yellowed shadow under the third rib beside the salted notch and pressure swings follow every oblique manoeuvre"
)


def leaks(spark, texts, items=((1, PASSAGE),), **kw):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    found = find_leaks(docs, spark.createDataFrame(list(items), "item_id long, text string"), **kw).collect()
    return sorted((r["doc_id"], r["item_id"]) for r in found if r["ordered_words"] >= 24)


def test_quotations_and_their_disguises(spark):
    w = PASSAGE.split()
    part = w[4:29]
    changed = part.copy()
    changed[6], changed[15] = "zzzzz", "qqq"
    fewer = part[:8] + part[9:]
    more = part[:8] + ["extra"] + part[8:16] + ["word"] + part[16:]
    text = " ".join
    texts = [
        text(part), text(part).upper(), text(changed), text(fewer), text(more), "Note: " + ", ".join(part) + ".", text(part).replace("collapses", "col-\nlapses"), text(part).replace("a", "а").replace("o", "о"),
        "​".join(text(part)), "<p>" + text(f"<b>{x}</b>" if i % 3 == 0 else x for i, x in enumerate(part)) + "</p>", text(part).replace("e", "é"), text(part).replace(" ", "\n  "), "start " * 30_000 + text(part), text(part).replace("tasting", "tas­ting"), "**" + "** _".join(part),
    ]
    assert leaks(spark, texts) == [(i, 1) for i in range(len(texts))]


def test_what_is_no_leak(spark):
    w = PASSAGE.split()
    torn = w[4:29]
    for i in (3, 8, 13, 18, 22):
        torn[i] = "other"
    shuffled = w.copy()
    random.Random(1).shuffle(shuffled)
    texts = [" ".join(w[:20]), " ".join(torn), " ".join(shuffled), "", None, "x", " ".join(w[:12]) + " and then something else entirely happened to them all " + " ".join(w[20:32])]
    assert leaks(spark, texts) == []
    assert leaks(spark, [PASSAGE], [(1, " ".join(w[:20])), (2, None), (3, ""), (None, PASSAGE)]) == []
    assert leaks(spark, []) == [] == leaks(spark, [PASSAGE], [])


def test_items_in_blocks_and_reordered_tiles(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(12)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(200)) + " " + " ".join(items[i][1].split()[10:40]) for i in range(12)] + [items[3][1] + " " + items[5][1]]
    expected = sorted([(i, i) for i in range(12)] + [(12, 3), (12, 5)])
    assert leaks(spark, texts, items) == expected == leaks(spark, texts, items, rules=LeakRules(block=700))


def test_passages_in_another_order(spark):
    w = PASSAGE.split()
    pieces = [w[i : i + 10] for i in (30, 10, 20, 0)]
    texts = [" ".join(w[20:40] + w[:20]), " ".join(sum(pieces, [])), " and ".join(" ".join(p) for p in pieces), " ".join(w[20:31] + w[:12]), " ".join(x for i in range(0, 40, 3) for x in reversed(w[i : i + 3]))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["covered_words"], r["ordered_words"]) for r in find_leaks(docs, spark.createDataFrame([(1, " ".join(w[:40]))], "item_id long, text string")).collect()}
    assert sorted(got) == [0, 1, 2] and all(c >= 38 and o < 24 for c, o in got.values())


def brute_tiles(a, b, least):
    """Lengths of the tiles, the longest match first, by comparing everything."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        out.append((i, j, n))
        free_a[i : i + n] = [False] * n
        free_b[j : j + n] = [False] * n


def test_tiles_against_brute_force():
    rng = random.Random(13)
    as_array = lambda x: np.frombuffer(x.encode(), dtype=np.uint8)
    for at in range(60):
        letters_ = "ab" if at % 3 == 0 else "abcdefg"
        a = "".join(rng.choice(letters_) for _ in range(rng.randint(0, 60)))
        b = "".join(rng.choice(letters_) for _ in range(rng.randint(0, 30))) + a[10:40] + "zz" + a[:20]
        got = tiles(as_array(a), as_array(b), 4)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in got)
        assert len({x for i, _, n in got for x in range(i, i + n)}) == len({x for _, j, n in got for x in range(j, j + n)}) == sum(n for *_, n in got)
        assert got == brute_tiles(a, b, 4)
    assert sum(n for *_, n in tiles(as_array("a" * 3000), as_array("a" * 200_000), 12)) == 3000
    assert covered_words(np.array([0, 3, 5, 9]), [(0, 7, 4), (4, 0, 1)]) == 2


@pytest.mark.parametrize("longest", [1, 2, 3, 9])
def test_short_words_lose_nothing(longest):
    """Every passage of 24 words with three disturbed ones is found, however short its words."""
    rng = random.Random(longest)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, longest)))
    items = [[word() for _ in range(40)] for _ in range(30)]
    table = KeyTable(LeakRules(), list(range(30)), items)
    texts, want = [], []
    for k, item in enumerate(items * 8):
        at = rng.randint(0, 16)
        part = item[at : at + 24]
        for i in (6, 12, 18):
            i += rng.randint(-1, 1)
            kind = rng.randint(0, 2)
            part[i : i + 1] = [["9" + word()], [], [part[i], "9" + word()]][kind]
        texts.append(" ".join([word() for _ in range(20)] + part + [word() for _ in range(20)]))
        want.append(k % 30)
    found = {(d, k) for d, k, _, ordered in leaks_among(texts, table) if ordered >= 24}
    true = {(d, k) for d, k in enumerate(want) if brute_coverage(items[k], texts[d].split(), 3) >= 24}
    assert len(true) > 200 and true <= found
    assert all(brute_coverage(items[k], texts[d].split(), 3) >= 24 or longest <= 2 for d, k in found)


def test_markup_of_any_length_is_no_text(spark):
    w = PASSAGE.split()[4:30]
    href = "https://x.example.com/" + "long/" * 2000
    texts = [" ".join(w[:12]) + f' <a class="q" href="{href}">' + " ".join(w[12:]) + "</a>", " ".join(w[:12]) + " <!-- " + "aside " * 2000 + "--> " + " ".join(w[12:]), " ".join(w[:12]) + f" [url={href}]" + " ".join(w[12:]), " ".join(w[:12]) + " <p\nclass=" + "x" * 900 + ">" + " ".join(w[12:]), "if <two " + " ".join(w) + " is >3"]
    assert leaks(spark, texts) == [(i, 1) for i in range(len(texts))]


def test_quotations_of_compounds_parted_otherwise(spark):
    w = PASSAGE.split()
    item = " ".join(w[:3] + ["mcg/min/kg"] + w[3:8] + ["long-term"] + w[8:14] + ["patient's"] + w[14:40])
    ws = item.split()
    at = [i for i, x in enumerate(ws) if not x.isalpha()]
    texts = [" ".join(ws[i - k : i - k + 24]) for i in at[1:] for k in range(4)] + [" ".join(ws[at[0] : at[0] + 24])]
    texts += ["so it was: " + texts[-1].replace(" ", "-"), "seen: " + item.replace(" ", ""), " ".join("".join(c for c in item if c.isalnum())), item.replace("long-term", "lo ng te rm").replace("mcg/min/kg", "mcgminkg")]
    assert leaks(spark, texts, [(1, item)]) == [(i, 1) for i in range(len(texts))]
    assert leaks(spark, [" ".join(ws[at[0] : at[0] + 23])], [(1, item)]) == []


def brute_coverage(item, doc, places):
    best = 0
    states = {(i, j, 0): 0 for i in range(len(item)) for j in range(len(doc)) if item[i] == doc[j]}
    for (i, j, _), _ in list(states.items()):
        frontier, seen = [(i, j, 0)], set()
        while frontier:
            x, y, e = frontier.pop()
            if (x, y, e) in seen or e > places or x > len(item) or y > len(doc):
                continue
            seen.add((x, y, e))
            if x < len(item) and y < len(doc) and item[x] == doc[y]:
                best = max(best, x + 1 - i)
                frontier.append((x + 1, y + 1, e))
            frontier += [(x + 1, y + 1, e + 1), (x + 1, y, e + 1), (x, y + 1, e + 1)]
    return best


def test_coverage_against_brute_force():
    from wardgrid.llm.leakage import coverage

    rng = random.Random(3)
    for _ in range(200):
        item = [f"w{rng.randint(0, 40)}" for _ in range(30)]
        doc = [f"v{rng.randint(0, 9)}" for _ in range(4)] + item[5:25] + ["v1"]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(6, 20)
            doc = rng.choice([doc[:at] + ["z"] + doc[at:], doc[:at] + doc[at + 1 :], doc[:at] + ["z"] + doc[at + 1 :]])
        anchors = [(i, j) for j in range(len(doc)) for i in range(len(item)) if item[i] == doc[j]]
        assert coverage(item, doc, anchors, 3) == brute_coverage(item, doc, 3)


def test_plain_texts():
    assert words("Café—ŒUVRE Straße naïve") == ["cafe", "oeuvre", "strasse", "naive"]
    assert words("раtiёnt") == ["patient"]
    assert words("a&nbsp;b <br/>c ３７") == ["a", "b", "c", "37"]
    assert letters(plain("Ab-c 1\n2")) == b"abc12"
    for text in ("", "​", "½", "İ", "𝒳 x", "-\n", "<", "[[", "a" * 1_000_000):
        assert plain(text).isascii()


# Spam

SENTENCES = "The patient was calm during the night and the plan stays as written. We measured the pressure at the bedside and stored a value every hour. "
GOODS = ["infusion pump", "hospital bed", "pulse oximeter", "feeding tube", "patient monitor"]
DEEDS = ["for sale", "rental", "deals", "price", "wholesale"]


def phrases(rng, n):
    return [f"{rng.choice(GOODS)} {rng.choice(DEEDS)}" for _ in range(n)]


def test_spam_and_lists_that_are_none(spark):
    rng = random.Random(6)
    links = [" | ".join(f"https://www.x{i}.example.com/{p.replace(' ', '-')}" for p in phrases(rng, 20)) for i in range(30)]
    lists = [sep.join(phrases(rng, 30)) for sep in (", ", "\n", " » ", "; ", " ")]
    mixed = [SENTENCES + " ".join(phrases(rng, 60))]
    honest = [
        SENTENCES * 3, SENTENCES * 5 + "Tags: " + ", ".join(phrases(rng, 3)), "Medication:\n" + "\n".join(f"- epsixine {i} mg 2dd" for i in range(20)), "\n".join(f"0{i}:05 HR {60 + i} ABP 120/80 SpO2 96" for i in range(9)),
        "References\n" + "\n".join(f"{i}. Study group. On care in sepsis. J Crit Rec {1990 + i};3:4. https://doi.example.org/ab.{i}" for i in range(9)), "Contents\n" + "\n".join(f"1.{i} Cleaning the device ... {i}" for i in range(9)), "", "x", "​",
    ]
    texts = links + lists + mixed + honest + [SENTENCES] * 40
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate([*texts, None])] + [(None, texts[0], 1.0)], "doc_id long, text string, stuffed_share double")
    got = {r["doc_id"] for r in find_spam(df.repartition(3)).collect()}
    assert got == set(range(len(links) + len(lists) + len(mixed)))
    assert find_spam(df.filter("false")).count() == 0


def test_one_large_link_farm_hides_no_other_family(spark):
    rng = random.Random(8)
    coin = lambda: "".join(rng.choice("bcdfgklmnprstv") + rng.choice("aeiou") for _ in range(4))
    vocabulary = [coin() for _ in range(300)]
    farm = [" | ".join(f"https://www.y{i}.example.com/" + "-".join(rng.choice(vocabulary) for _ in range(6)) for _ in range(60)) for i in range(300)]
    links = [" | ".join(f"https://www.x{i}.example.com/{p.replace(' ', '-')}" for p in phrases(rng, 3)) for i in range(4)]
    lists = [sep.join(phrases(rng, 30)) for sep in (", ", "\n", "; ")]
    texts = farm + links + lists + [SENTENCES] * 600
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"] for r in find_spam(df).collect()}
    assert got == set(range(len(farm) + len(links) + len(lists)))


def test_without_links_shapes_decide(spark):
    rng = random.Random(9)
    rounds = "\n".join(["Cheap Pump", "Buy Pump", "Best Pump", "Pump Sale"] * 50)
    run = "cheap pump best pump buy pump sale pump deals pump online. " * 40
    lists = [sep.join(phrases(rng, 30)) for sep in ("\n", ", ", " | ", "; ", " ")]
    copied = "\n".join(f"Day {i}: Mouth care was given as agreed with the family." for i in range(30))
    honest = [SENTENCES, "a, b, c, d, e", copied, "Day shift", "n/a", "\n".join(f"epsixine {i}: calm and awake, no pain" for i in range(30))]
    texts = [rounds, run, *lists, *honest, *[SENTENCES + f"Bed {i} was moved to the other side of the room before noon." for i in range(40)]]
    got = find_spam(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert rows(got, "doc_id") == [(i,) for i in range(7)]
    assert all(r["stuffed_share"] > 0.5 for r in got.collect())


def test_shapes():
    from wardgrid.llm.spam import Lexicon, SpamRules, again, dominated, page_shapes, reduced

    lexicon = Lexicon(1 << 21)
    shape = lambda text: reduced(text.split(), 0, lexicon)[0]
    assert shape("Cheap Pump") == shape("Best Bed Sale") != shape("cheap pump")
    assert shape("https://a.example.com/x-y see").links == 2 and shape("an explanation stands beside https://a.nl").links == 1
    assert shape("HR 60 ABP 120").numerals == 2 and shape("term: what it means").term
    assert shape("pump bed pump bed pump bed pump bed").odd and not shape("the pump beside the bed stood still all night").odd
    assert reduced(["--", "**"], 0, lexicon) is None and reduced([], 0, lexicon) is None
    assert again([5] * 30, 24) == pytest.approx(23 / 24) and again(list(range(30)), 24) == 0 and again([5] * 7, 24) == 0
    rules = SpamRules()
    assert [(g[1], g[2]) for g in page_shapes("pump sale\n" * 20, rules)] == [(1, 40)]
    assert dominated(page_shapes("pump sale\n" * 20, rules), rules) and not dominated(page_shapes(SENTENCES, rules), rules) and not dominated([], rules)


def test_spam_does_not_depend_on_the_partitioning(spark):
    rng = random.Random(12)
    texts = [sep.join(phrases(rng, rng.randint(8, 60))) for sep in (", ", "\n", "; ", " ", ". ") for _ in range(6)] + [SENTENCES * rng.randint(1, 4) + " ".join(phrases(rng, rng.randint(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows(find_spam(df.repartition(1))) == rows(find_spam(df.repartition(7)))


# Queries


def test_queries_match_their_sql(spark, data):
    import duckdb

    from wardgrid.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("admissions", "numericitems"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, data)
        expected = con.execute(sql)
        names = [d[0] for d in expected.description]
        want = sorted((tuple(r) for r in expected.fetchall()), key=lambda r: [(v is not None, v) for v in r])
        assert rows(got, *names) == want, name


def test_found_queries_run(spark, data):
    from wardgrid.llm.queries import QUERIES

    packed = QUERIES["p8_packed"](spark, data).groupBy("sequence").agg(F.sum("n_tokens").alias("n")).agg(F.max("n")).first()[0]
    assert packed <= 2048
    assert QUERIES["p9_found"](spark, data).columns == ["doc_id", "item_id"]
    assert QUERIES["p10_found"](spark, data).columns == ["doc_id"]
    assert QUERIES["p4_splits"](spark, data).groupBy("person").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_long_odd_texts_take_no_long_time():
    import time

    from wardgrid.llm.spam import SpamRules, page_shapes

    table = KeyTable(LeakRules(), [1], [words(PASSAGE)])
    for text in ("a" * 1_000_000, "x.y/z :" + "a." * 100_000, "<" * 300_000, "[url=" * 100_000, "a-\n" * 200_000, "<!--" * 100_000, "<a " * 100_000, "<a b=" * 100_000, "x.com/" + "a-" * 200_000, "a, " * 300_000, PASSAGE * 500):
        began = time.process_time()
        list(leaks_among([text], table))
        page_shapes(text, SpamRules())
        assert time.process_time() - began < 10, text[:10]
