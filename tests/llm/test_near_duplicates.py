"""Near-duplicate components against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op4_oph
from tidemark.llm.components import components


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def brute(rows):
    sets = []
    for _, text in rows:
        w = words(text)
        n = min(5, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set())
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def mixed_rows():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(4))
    rows, texts = [], []
    passage = [word() for _ in range(60)]
    for _ in range(40):
        base = [word() for _ in range(r.randint(6, 200))]
        texts.append(base)
        for _ in range(r.randint(0, 4)):
            copy = list(base)
            for _ in range(r.randint(0, 6)):
                copy[r.randrange(len(copy))] = word()
            texts.append(copy)
    for _ in range(60):  # share a passage, and little else
        own = [word() for _ in range(r.randint(2, 40))]
        texts.append(own[:len(own) // 2] + passage + own[len(own) // 2:])
    chain = [word() for _ in range(120)]
    for i in range(12):  # each like the next, the ends not alike
        texts.append(chain[i * 5:i * 5 + 60])
    for t in texts:
        rows.append((r.randrange(10**6), r.choice([" ", "\n", "  "]).join(w.upper() if r.random() < 0.1 else w for w in t)))
    rows += [(-5, None), (-4, ""), (-3, " \n "), (-2, "one two"), (-1, "One\ttwo"), (0, "one"), (None, "one two"), (None, rows[0][1])]
    rows += [(10**7 + i, "exactly the same text of some words") for i in range(50)]
    rows += [(77, rows[1][1]), (77, rows[30][1])]  # an id that repeats joins what its rows are like
    return rows


def test_components_equal_brute_force(spark):
    rows = mixed_rows()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string").repartition(7)
    got = op4_oph.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(spark):
    assert op4_oph.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bins_agree_as_often_as_the_sets_are_alike():
    r = np.random.default_rng(1)
    for n, both in [(7, 6), (40, 34), (400, 350), (3000, 2600)]:
        agree = []
        for _ in range(200):
            common = r.integers(0, 2**64, both, np.uint64)
            a, b = (np.unique(np.concatenate([common, r.integers(0, 2**64, n - both, np.uint64)])) for _ in range(2))
            agree.append((op4_oph.bins_of(a) == op4_oph.bins_of(b)).mean())
        assert abs(np.mean(agree) - both / (2 * n - both)) < 0.03


def test_short_pairs_at_exactly_three_quarters(spark):
    r = random.Random(9)
    rows = []
    for i, (small, large) in enumerate([(3, 4), (6, 8), (12, 16), (24, 32)] * 1500):
        text = [f"w{r.randrange(10**12)}" for _ in range(large + 4)]
        rows += [(2 * i, " ".join(text[:small + 4])), (2 * i + 1, " ".join(text))]
    got = op4_oph.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert [tuple(x) for x in got.where("component_id <> doc_id - doc_id % 2").collect()] == []


def test_signatures_rule_out_no_link():
    r = np.random.default_rng(3)
    hashes = lambda n: r.integers(0, 2**64, n, np.uint64)
    for small, large, times in [(1, 1, 50), (3, 4, 2000), (12, 16, 2000), (75, 100, 500), (750, 1000, 300), (768, 1024, 300), (780, 1040, 300), (6000, 8000, 100)]:
        for _ in range(times):
            both, rest = hashes(small), hashes(large - small)
            at = r.integers(0, len(rest) + 1)
            sets = [np.sort(np.concatenate([both, x])) for x in (rest[:at], rest[at:])]
            u, v = (op4_oph._bins(pa.array([op4_oph.signature(s)])) for s in sets)
            assert op4_oph.may_link(u, v, *(np.array([len(s)]) for s in sets), 75)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 500), (500, 700), (7, 7), (700, 1000)]
    for one_task in (1000, 10):
        got = {r.v: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), one_task).collect()}
        assert got == {**dict.fromkeys(range(1, 101), 0), 700: 500, 1000: 500}


def test_bitmap_of_wanted_slots(spark):
    ids = spark.range(0, 5000, 7)
    bits = np.unpackbits(op4_oph.wanted_slots(ids), bitorder="little")
    slots = {r[0] for r in ids.select(op4_oph._slot()).collect()}
    assert set(np.flatnonzero(bits).tolist()) == slots


def bucket(spark, members, seed=5):
    """placed and classes of one bucket: (node, root, n) each, with signatures that rule nothing out among themselves."""
    r = np.random.default_rng(seed)
    placed = spark.createDataFrame([(7, 0, node, root, n) for node, root, n in members], "key long, band int, node long, root long, n int")
    bands = [int(x) for x in r.integers(1, 10**9, 32)]
    signature = op4_oph.signature(np.sort(r.integers(0, 2**64, 40, np.uint64)))
    classes = spark.createDataFrame([(node, bands, bytearray(signature)) for node, _, _ in members], "node long, bands array<long>, signature binary")
    return placed.repartition(8), classes.repartition(8)


def test_a_giant_component_meets_strays_only(spark):
    """A bucket of 50,000 members of one component and one stray: as many pairs of blocks as the component has, no block of it with another."""
    placed, classes = bucket(spark, [(i, 0, 40) for i in range(50_000)] + [(90_000, 90_000, 42), (90_001, 90_001, 400)])
    pairs = op4_oph.block_pairs(placed, classes, 75).select("same", *[F.transform(side, lambda m: m["root"]).alias(side) for side in ("left", "right")])
    found = [(r.same, set(r.left), set(r.right)) for r in pairs.collect()]
    crossing = [f for f in found if not f[0]]
    assert len(crossing) == -(-50_000 // op4_oph.BLOCK) and all(f[1:] == ({0}, {90_000}) for f in crossing)
    assert len(found) == len(crossing) + 2  # and the strays' blocks with themselves


@pytest.mark.parametrize("block", [3, 8, 256])
def test_pairs_across_components_of_a_bucket_are_all_found(spark, monkeypatch, block):
    """Against all pairs, one by one: different components and sizes that fit, whatever the blocks."""
    monkeypatch.setattr(op4_oph, "BLOCK", block)
    monkeypatch.setattr(op4_oph, "MET", 2)
    r = random.Random(block)
    members = [(i, r.choice([0, 0, 0, 500, 500, i]), r.choice([30, 31, 33, 39, 40, 41, 52, 53, 60])) for i in range(1, 90)]
    placed, classes = bucket(spark, members)
    got = op4_oph.block_pairs(placed, classes, 75).mapInArrow(op4_oph._compare(75), "u long, v long")
    want = sorted((a[0], b[0]) for i, a in enumerate(members) for b in members[i + 1:] if a[1] != b[1] and 100 * min(a[2], b[2]) >= 75 * max(a[2], b[2]))
    assert sorted(map(tuple, got.collect())) == want
