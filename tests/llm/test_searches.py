"""Window search, exact top-k and preference formatting against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import op1_preference, op8_wu_manber, op9_taat, queries


def brute_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c.isascii() and not (c.isdigit() or c.islower()):
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def brute_windows(docs, items):
    windows = []
    for name, text in items:
        w = brute_words(text)
        m = min(13, len(w))
        windows += [(name, w[i:i + m]) for i in range(len(w) - m + 1) if m]
    out = []
    for key, text in docs:
        w = brute_words(text)
        hit, found = set(), set()
        for name, p in windows:
            for i in range(len(w) - len(p) + 1):
                if w[i:i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    if name is not None:
                        found.add(str(name))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_chars", [1 << 20, 100])
def test_windows_equal_brute_force(spark, block_chars):
    r = random.Random(8)
    word = lambda: r.choice(["a", "b", "C", "dé", "7", "É"])
    items = [(i, r.choice([" ", "-", ", "]).join(word() for _ in range(r.choice([1, 3, 5, 12, 13, 14, 20])))) for i in range(30)]
    items += [(31, items[0][1]), (None, "b a b a dé"), (32, None), (33, ""), (34, "...")]
    docs = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 30)))]
        for _ in range(r.randint(0, 3)):
            parts += [r.choice(items)[1] or "", " ".join(word() for _ in range(r.randint(0, 20)))]
        docs.append((i, "\n".join(parts)))
    docs += [(100, None), (101, ""), (102, "!!"), (103, docs[0][1]), (103, docs[0][1]), (None, docs[1][1]), (104, "zz " * 3000 + (items[5][1]))]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, hits int").repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string")
    got = queries.contamination(op8_wu_manber.find_windows(df, it, block_chars=block_chars)).collect()
    assert sorted(map(tuple, got), key=str) == brute_windows(docs, items)


def test_many_blocks_of_test_strings(spark, monkeypatch):
    """More blocks than one plan chains: carried rows are written between them, and a worker holds the tables of one block."""
    r = random.Random(8)
    items = [(i, " ".join(f"b{i}w{j}" for j in range(r.randint(3, 20)))) for i in range(40)] + [(3, "b3w0 b3w1 b3w2")] * 5
    docs = [(i, " ".join(r.choice(items)[1] if r.random() < 0.3 else f"x{r.randint(0, 99)}" for _ in range(30))) for i in range(60)] + [(None, items[0][1]), (7, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string")
    collected = []
    plain = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (lambda out: collected.append(len(out)) or out)(plain(self)))
    found = op8_wu_manber.find_windows(df, it, block_chars=400, steps=2)
    assert len(collected) > 5 and max(collected) < 20  # a block at a time
    monkeypatch.undo()
    got = queries.contamination(found).collect()
    assert sorted(map(tuple, got), key=str) == brute_windows(docs, items)


def test_windows_of_empty_tables(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert op8_wu_manber.find_windows(none, items).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert tuple(op8_wu_manber.find_windows(one, items).first()) == (1, 2, [], [])


def brute_top(vectors, asked, k):
    usable = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in usable:
        if q in asked:
            best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q))[:k]  # noqa: B905
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block_rows, slots", [(4096, 3), (7, 2)])
def test_top_k_equals_brute_force(spark, block_rows, slots):
    r = np.random.default_rng(9)
    vectors = [(int(i), [float(np.float32(x)) for x in r.integers(-3, 4, 8) / 4]) for i in range(200)]  # many ties and zeros
    vectors += [(200, None), (None, vectors[0][1]), (202, [1.0, None]), (203, [float("nan")] * 8), (204, [float("inf")] * 8), (250, []), (205, [0.5, -0.5])]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, score int").repartition(4)
    got = op9_taat.top_k(df, df.where("vec_id % 50 = 0"), k=5, query_block=3, block_rows=block_rows, slots=slots).collect()
    assert sorted(map(tuple, got)) == brute_top(vectors, {0, 50, 100, 150, 200, 250}, 5)


def test_top_k_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in op9_taat.top_k(df, df.where("vec_id = 0"), slots=2).collect()] == [(0, 1, 1, 256 * 512)]
    assert op9_taat.top_k(df.limit(0), df, slots=2).count() == 0


def test_top_k_of_huge_components_is_exact(spark):
    """Components to 2**31 and beyond, sums near 2**63 that cancel or stay: no row is left out, nothing wraps."""
    r = np.random.default_rng(10)
    vectors = [(i, [float(x) for x in r.choice([0, 1, -1, 3.5, 2**21, -(2**21), 4.2e6, 5e6, 2**27 / 256], 8)]) for i in range(120)]
    vectors += [(150, [2.0**23 * (1 if j % 2 else -1) for j in range(8)]), (151, [2.0**23 / 8] * 8), (152, [2.0**31, 0.5] + [0.0] * 6), (153, [0.0, 2.0**60] + [0.0] * 6)]
    vectors += [(200, [2.0**23] * 7 + [-(2.0**23)]), (201, [2.0**45] + [0.0] * 7)]
    asked = {0, 50, 100, 150}
    small = [v for v in vectors if v[0] < 150]
    want = brute_top(small, asked, 5)
    assert max(abs(x[3]) for x in want) > 2**58
    df = spark.createDataFrame(small, "vec_id long, embedding array<double>").repartition(3)
    got = op9_taat.top_k(df, df.where("vec_id % 50 = 0"), query_block=2, block_rows=16, slots=4)
    assert sorted(map(tuple, got.collect())) == want
    # 64 products of 2**29 * 2**29 each: the sum is 2**64, far more than a 64-bit wrap to 0
    wide = spark.createDataFrame([(0, [2.0**21] * 64), (1, [2.0**21] * 64), (2, [1.0] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        op9_taat.top_k(wide, wide.where("vec_id = 0"), slots=2).collect()
    # sums that pass 2**63 on the way and come back are right
    mixed = [(0, [2.0**24] * 4), (1, [2.0**23, 2.0**23, -(2.0**23), -(2.0**23)]), (2, [2.0**23, -(2.0**23), 1.0, 0.0])]
    df = spark.createDataFrame(mixed, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, op9_taat.top_k(df, df.where("vec_id = 0"), slots=2).collect())) == brute_top(mixed, {0}, 5)
    # one of the best that has no place in 64 bits is an error, one that isn't among them is none
    far = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [-(2.0**50), 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in op9_taat.top_k(far, far.where("vec_id = 0"), k=1, slots=2).collect()] == [(0, 1, 1, 256 * 512)]
    with pytest.raises(Exception, match="64 bits"):
        op9_taat.top_k(far, far.where("vec_id = 0"), k=2, slots=2).collect()


def test_a_broken_row_does_not_hide_a_query(spark):
    rows = [(50, [1.0, 1.0]), (50, [None, 1.0]), (50, None), (50, [float("nan"), 0.0]), (7, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in op9_taat.top_k(df, df.where("vec_id = 50"), slots=2).collect()] == [(50, 1, 7, 256 * 512)]


def test_scoring_is_not_handed_every_pair_of_blocks(spark, monkeypatch):
    """What enters scoring follows the rows, not query blocks times candidate blocks (each pair as a row filled the heap)."""
    r = np.random.default_rng(11)
    vectors = [(i, [float(x) for x in r.integers(-8, 9, 32) / 8]) for i in range(600)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(2)
    made, entered = op9_taat.score_blocks, spark.sparkContext.accumulator(0)

    def counted(k):
        scored = made(k)

        def run(rows_in):
            def seen():
                for batch in rows_in:
                    entered.add(batch.nbytes)
                    yield batch
            return scored(seen())
        return run

    monkeypatch.setattr(op9_taat, "score_blocks", counted)
    got = op9_taat.top_k(df, df.where("vec_id % 5 = 0"), query_block=4, block_rows=20, slots=2).collect()
    assert sorted(map(tuple, got)) == brute_top(vectors, set(range(0, 600, 5)), 5)
    assert entered.value < 2 * 720 * 32 * 8, "more than two copies of all rows"


def test_top_k_of_vectors_of_many_shapes(spark):
    """Full and sparse blocks, wide and narrow ones, whole numbers beyond those of 32-bit floats, ties, and cells of several rows of the grid."""
    r = np.random.default_rng(12)
    vectors = [(i, [float(x) for x in r.integers(-3, 4, 6)]) for i in range(150)]
    vectors += [(i, [float(x) for x in r.integers(-2**15, 2**15, 9)]) for i in range(150, 250)]
    vectors += [(i, [0.0] * int(r.integers(0, 300)) + [float(r.integers(-4, 5))]) for i in range(250, 350)]
    vectors += [(i, [0.5, -1.0, 2.0, 1.0]) for i in range(350, 420)]
    vectors += [(i, [3.0, 0.0, 2.0**20]) for i in range(420, 430)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartitionByRange(5, "vec_id")
    asked = set(range(0, 430, 10))
    for slots, rows in ((3, 4096), (40, 16)):
        got = op9_taat.top_k(df, df.where("vec_id % 10 = 0"), k=7, query_block=8, block_rows=rows, slots=slots).collect()
        assert sorted(map(tuple, got)) == brute_top(vectors, asked, 7)


def test_a_cell_holds_no_more_queries_than_fit(spark, monkeypatch):
    assert op9_taat.grid(4, 100, 5000, held=9)[0] == 9
    r = np.random.default_rng(13)
    vectors = [(i, [float(x) for x in r.integers(-8, 9, 16) / 8]) for i in range(300)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    monkeypatch.setattr(op9_taat, "HELD_BYTES", 16 * op9_taat.COMPONENT_BYTES * 20)
    got = op9_taat.top_k(df, df.where("vec_id % 3 = 0"), query_block=4, slots=2)
    assert sorted(map(tuple, got.collect())) == brute_top(vectors, set(range(0, 300, 3)), 5)


@pytest.mark.parametrize("slots, queries, rows", [(2, 1, 100), (12, 20, 1000), (20_000, 2, 100), (64, 100, 100), (5, 0, 0)])
def test_grid_cells(slots, queries, rows):
    r, c = op9_taat.grid(slots, queries, rows)
    assert 1 <= r * c <= slots
    if slots == 20_000:
        assert r + queries / rows * c < 45  # copies of a row, against 400 if each query went to every cell


def rendered(turns):
    text, spans = "", []
    for role, said in turns:
        text += f"<|{role}|>\n"
        if role == "assistant":
            spans.append((len(text), len(text) + len(said) + 8))
        text += said + "<|end|>\n"
    return text, spans


def test_preference_pairs(spark):
    rows = []
    for pair, chosen, rejected in [
        (1, [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")], [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "🙂e")]),
        (2, [("user", "a")], [("user", "b"), ("assistant", "x")]),
        (3, [("user", "a"), ("assistant", "same")], [("user", "a"), ("assistant", "same")]),
        (4, [("user", "a"), ("assistant", "b"), ("user", "c")], [("user", "a")]),
        (5, [("system", ""), ("assistant", "long " * 5000)], []),
    ]:
        for side, turns in (("chosen", chosen), ("rejected", rejected)):
            rows += [(pair, side, n, role, text) for n, (role, text) in enumerate(turns)]
    rows += [(None, "chosen", 0, "user", "x"), (6, "other", 0, "user", "x"), (7, "chosen", None, None, None), (7, "chosen", 1, "user", "x"), (7, "chosen", 1, "user", "x")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, 0) for r in rows], "pair_id long, side string, turn int, role string, text string, n int").repartition(4)
    got = {r.pair_id: r for r in op1_preference.format_pairs(df).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 7}
    key = lambda r: (r[2] is not None, r[2] or 0, r[3] or "", r[4] or "")
    for pair, r in got.items():
        sides = [[(x[3] or "", x[4] or "") for x in sorted((x for x in rows if x[0] == pair and x[1] == side), key=key)] for side in ("chosen", "rejected")]
        n = 0
        while n < min(map(len, sides)) and sides[0][n] == sides[1][n]:
            n += 1
        assert (r.n_prefix, r.n_chosen, r.n_rejected) == (n, len(sides[0]) - n, len(sides[1]) - n)
        assert r.prompt == rendered(sides[0][:n])[0]
        assert (r.chosen, [tuple(s) for s in r.chosen_spans]) == rendered(sides[0][n:])
        assert (r.rejected, [tuple(s) for s in r.rejected_spans]) == rendered(sides[1][n:])
    assert op1_preference.format_pairs(df.limit(0)).count() == 0
