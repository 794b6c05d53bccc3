"""Fill-in-middle, Merkle manifest and quality model against brute force, exact round trips and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tidemark.llm import common, op11_fim, op12_merkle, op13_gam, queries
from tidemark.sources.tables import read_table

DOCS = "doc_id long, text string, source string, key string, n long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ------------------------------------------------------------------- fill in the middle

def fim(text, doc_id, spm=50, fim_percent=100):
    """The contract, over the list of units."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), sha(f"7:{'' if doc_id is None else doc_id}")
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def fim_rows():
    r = random.Random(11)
    texts = [None, "", "\n", "\n\n\n", "a", "a\n", "x<P>y\nz", "x\n<M>", "<\n<P\nP>", "ends with <", "<S", "é\n漢字\r\n\U0001f600", "one line " * 20_000, "l\n" * 50_000, ("w" * 70_000 + "\n") * 3]
    texts += ["".join(r.choice(["a", "<", "P>", "S>", "\n", "é", "<P", " "]) for _ in range(r.randint(0, 40))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, "no id\nat all\n"), (None, "no id\nat all\n"), (3, "\n\n\n"), (4, "other text\nof id 4"), *[(7, "many\ncopies\n")] * 60]
    return [(i, t, "src", "own key", 5) for i, t in rows]


def test_fim_equals_the_contract_and_restores(spark):
    rows = fim_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = op11_fim.transform(docs).collect()
    want = Counter()
    for i, t, *_ in rows:
        n, form, prefix, middle, out = fim(t or "", i)
        want[i, n, form, prefix, middle, out, sha(out), sha(t or "")] += 1
    assert Counter(tuple(g) for g in got) == want
    assert {g.form for g in got} == {"plain", "psm", "spm"}
    for g in got:
        assert sha(op11_fim.restore(g.output, g.form)) == g.restored_sha256
    short = op11_fim.transform(docs, with_text=False)
    assert Counter((g.doc_id, g.output_sha256) for g in short.collect()) == Counter((g.doc_id, g.output_sha256) for g in got)
    assert {g.output for g in short.collect()} == {None}


def test_fim_parameters_and_whole_rows_as_ids(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb\nc", "s", None, i) for i in range(200)], DOCS)
    assert {g.form for g in op11_fim.transform(docs, fim_percent=0).collect()} == {"plain"}
    assert {g.form for g in op11_fim.transform(docs, spm_percent=0).collect()} == {"psm"}
    some = Counter(g.form for g in op11_fim.transform(docs, fim_percent=50).collect())
    assert 60 < some["plain"] < 140
    as_rows = docs.select(F.struct("doc_id", "key").alias("row"), "text")
    assert {g.row.doc_id for g in op11_fim.transform(as_rows, id_col="row").collect()} == set(range(200))
    assert op11_fim.transform(docs.where("false")).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_fim_output_in_chunks_is_restored(size):
    r = random.Random(size)
    for _ in range(300):
        text = "".join(r.choice(["a", "<", "\n", "P", ">", "S"]) for _ in range(r.randint(1, 30)))
        n, form, prefix, middle, out = fim(text, r.randint(0, 99))
        pieces = list(op11_fim.pieces(text, form, prefix, None if middle is None else prefix + middle, size))
        assert "".join(pieces) == out
        restorer, found = op11_fim.Restorer(form), []
        for at in range(0, len(out), size):
            found += restorer.feed(out[at:at + size])
        found += restorer.end()
        assert "".join(s for _, s in sorted(found, key=lambda f: f[0])) == text


def test_fim_plan_has_one_shuffle(spark):
    plan = op11_fim.transform(spark.createDataFrame(fim_rows()[:5], DOCS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# ------------------------------------------------------------------- Merkle manifest

COLUMNS = queries.MANIFEST_COLUMNS


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(digests, fanout):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def way_up(tree, i, fanout):
    out = []
    for level in tree[:-1]:
        a = i // fanout * fanout
        run = level[a:a + fanout]
        out.append(("".join(run[:i - a]), "".join(run[i - a + 1:])))
        i //= fanout
    return out


def brute_manifest(rows, fanout=8):
    """(id, leaf, subroot, root, proof, folded root, verified) of each row."""
    leaf = lambda r, text: sha(*[encoded(text if c == "text" else r[c]) for c in COLUMNS])
    groups = {}
    for r in rows:
        text = r["text"]
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), leaf(r, text)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([x[2] for x in sorted(groups[g])], fanout) for g in names]
    over = levels([t[-1][0] for t in trees], fanout)
    out = []
    for k, (g, tree) in enumerate(zip(names, trees, strict=True)):
        for i, (has_id, doc_id, digest, shown) in enumerate(sorted(groups[g])):
            proof = way_up(tree, i, fanout) + way_up(over, k, fanout)
            for left, right in proof:
                shown = sha(left, shown, right)
            root = over[-1][0]
            out.append((doc_id if has_id else None, digest, tree[-1][0], root, sha(*[a + b for a, b in proof]), shown, shown == root))
    return Counter(out)


def manifest_rows(sizes, seed=12):
    r = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = r.choice([None, "", "Text With Capitals", "plain", "é 漢字\n"])
            rows.append((r.choice([None, *range(5000)]), r.choice([None, "", "src1"]), lang, r.choice([None, 0, 7]), text, 1))
    return rows + rows[:3]  # some repeat


@pytest.mark.parametrize("sizes", [{"en": 1}, {None: 8, "": 9}, {"en": 65, "fr": 1, "de": 7, None: 64, "é": 513}, {f"l{i}": 2 for i in range(70)} | {"hot": 300}])
def test_manifest_query_equals_brute_force(spark, tmp_path, sizes):
    rows = manifest_rows(sizes)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, tree int").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_merkle_manifest(spark, str(tmp_path)).collect()
    assert Counter(tuple(g) for g in got) == brute_manifest([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_hot_groups_cut_into_blocks_keep_the_tree(spark, fanout):
    rows = manifest_rows({"hot": 400, "b": 3})
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, tree int")
    m = op12_merkle.manifest(docs, COLUMNS, fanout=fanout, block_rows=16)
    got = Counter((r.id, r.digest, r.subroot, r.root) for r in m.proofs().collect())
    want = Counter()
    for row, n in brute_manifest([r.asDict() for r in docs.collect()], fanout).items():
        want[row[:4]] += n
    assert got == want
    nodes = m.within.nodes().collect()
    assert all(n.hi - n.lo <= fanout ** n.level for n in nodes) and m.root() == next(iter(got))[3]


def test_manifest_of_nothing_and_change_of_a_row(spark):
    ddl = "doc_id long, source string, lang string, n_chars long, text string"
    none = op12_merkle.manifest(spark.createDataFrame([], ddl), COLUMNS)
    assert none.root() is None and none.proofs().count() == 0
    rows = [(i, "s", "en", 3, f"t{i}") for i in range(20)]
    root = lambda rows: op12_merkle.manifest(spark.createDataFrame(rows, ddl), COLUMNS).root()
    assert root(rows) == root(rows[::-1]) != root([*rows[:-1], (19, "s", "en", 3, "")])
    assert root([*rows[:-1], (19, "s", "en", 3, None)]) != root([*rows[:-1], (19, "s", "en", 3, "")])


def test_manifest_joins_have_bounded_keys(spark):
    """Each leaf meets one parent: no join gives more rows than it has nodes."""
    docs = read_table(spark, SF01, "documents")
    m = op12_merkle.manifest(docs, COLUMNS)
    assert m.leaves.count() == m.proofs().count() == docs.count()
    for step in m.within.steps:
        assert step.where(F.size("children") > 8).isEmpty()


# ------------------------------------------------------------------- quality

def graded(r, n):
    """(text, label): ordinary sentences, or shouted, symbol-ridden or repeated ones."""
    words = ["the", "of", "river", "stone", "was", "and", "light", "in", "morning", "walked", "by", "house", "old", "they"]
    rows = []
    for i in range(n):
        say = [r.choice(words) + r.choice(["", "", "", ",", "."]) for _ in range(r.randint(20, 200))]
        bad = r.random() < 0.3
        if bad:
            say = r.choice([[w.upper() + "!!" for w in say], [w + r.choice(["%%%", "$$$", "###"]) for w in say], say[:4] * 30])
        rows.append((i, " ".join(say), None, "k", int(not bad)))
    return rows


def test_quality_on_held_out_rows(spark):
    rows = graded(random.Random(13), 600)
    docs = spark.createDataFrame([r[:4] + (1,) for r in rows], DOCS).repartition(4)
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows], "doc_id long, quality int")
    model = op13_gam.train(docs.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 0"))
    assert model.pairs and len(model.tables) == len(op13_gam.MEASURES)
    got = {g.doc_id: g for g in op13_gam.score(docs, model).collect()}
    held = [r for r in rows if r[0] % 2]
    assert np.mean([(got[r[0]].score >= 0.3) == bool(r[4]) for r in held]) > 0.97
    assert all(0 <= g.score <= 1 and len(g.reasons) <= 3 for g in got.values())


def test_quality_query_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.op13_quality_scores(spark, SF01).collect()}
    labels = read_table(spark, SF01, "labels").collect()
    held = [(got[x.doc_id].predicted, x.quality) for x in labels if zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())


def test_scores_are_the_sum_of_the_tables(spark):
    rows = graded(random.Random(14), 200)
    x = np.array([op13_gam.measures(r[1]) for r in rows])
    y = np.array([r[4] for r in rows], float)
    model = op13_gam.fit(x, y, np.ones(len(y)), rounds=20, pair_rounds=5)
    for i in range(0, 200, 17):
        odds = model.intercept
        bins = [int(np.searchsorted(e, x[i, k], "right")) for k, e in enumerate(model.edges)]
        odds += sum(t[b] for t, b in zip(model.tables, bins, strict=True))
        odds += sum(t[model.coarse[a][bins[a]], model.coarse[b][bins[b]]] for (a, b), t in zip(model.pairs, model.pair_tables, strict=True))
        assert model.chances(model.terms(x[i:i + 1]))[0] == pytest.approx(1 / (1 + np.exp(-odds)))
    docs = spark.createDataFrame([r[:4] + (1,) for r in rows], DOCS)
    got = {g.doc_id: g.score for g in op13_gam.score(docs, model).collect()}
    assert got == pytest.approx(dict(zip(range(200), model.chances(model.terms(x)), strict=True)))


def best_cut(g, h, rows, least):
    """The best step function with one cut, tried one by one."""
    gain = lambda a, b: a * a / (b + 1)
    found = [(gain(g[:c].sum(), h[:c].sum()) + gain(g[c:].sum(), h[c:].sum()), -c) for c in range(1, len(g)) if min(rows[:c].sum(), rows[c:].sum()) >= least]
    return -max(found)[1] if found else None


def test_trees_take_the_best_cuts():
    r = np.random.default_rng(15)
    for _ in range(50):
        n = int(r.integers(2, 12))
        g, h, rows = r.normal(size=n), r.random(n) + 0.1, r.integers(0, 6, n)
        step, cut = op13_gam.shallow_tree(g, h, rows, 1, 1.0, 3), best_cut(g, h, rows, 3)
        parts = [slice(None)] if cut is None or len(set(step)) == 1 else [slice(cut), slice(cut, None)]
        for p in parts:
            assert step[p] == pytest.approx(np.full(len(step[p]), -g[p].sum() / (h[p].sum() + 1)))
        a, b = int(r.integers(2, 6)), int(r.integers(2, 6))
        g, h, rows = r.normal(size=(a, b)), r.random((a, b)) + 0.1, r.integers(1, 9, (a, b))
        gain, step = op13_gam.cross_tree(g, h, rows, 1.0, 1)
        tried = [sum(x.sum() ** 2 / (y.sum() + 1) for x, y in ((g[:i, :j], h[:i, :j]), (g[:i, j:], h[:i, j:]), (g[i:, :j], h[i:, :j]), (g[i:, j:], h[i:, j:]))) - g.sum() ** 2 / (h.sum() + 1)
                 for i in range(1, a) for j in range(1, b)]
        assert gain == pytest.approx(max(0, *tried)) and step.shape == (a, b)


def test_an_interaction_needs_the_pairs():
    r = np.random.default_rng(16)
    x = r.random((2000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # neither alone tells anything
    alone = op13_gam.fit(x, y, np.ones(2000), n_pairs=0)
    both = op13_gam.fit(x, y, np.ones(2000))
    right = lambda m: np.mean((m.chances(m.terms(x)) > 0.5) == y)
    assert both.pairs == [(0, 1)] and right(both) > 0.97 > 0.8 > right(alone)


def test_quality_odd_rows_and_missing_labels(spark):
    odd = [(1, None, None, None, 1), (2, "", None, None, 1), (None, "no id", "s", "k", 1), (3, "word " * 100_000, "s", "k", 1), (4, "\n\n\n", "s", "k", 1), (4, "\n\n\n", "s", "k", 1), (5, "漢字퟿", "s", "k", 1)]
    docs = spark.createDataFrame(odd, DOCS)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, 1), (4, 0), (9, 2), (5, None)], "doc_id long, quality int")
    model = op13_gam.train(docs, labels)
    got = op13_gam.score(docs, model).collect()
    assert len(got) == len(odd) and all(0 <= g.score <= 1 for g in got)
    share = op13_gam.train(docs, labels.where("quality = 1"))
    assert {round(g.score, 5) for g in op13_gam.score(docs, share).collect()} == {round(1 - 1e-6, 5)}
    nothing = op13_gam.train(docs, labels.where("false"))
    assert {g.score for g in op13_gam.score(docs, nothing).collect()} == {0.5}
    assert op13_gam.score(docs.where("false"), model).count() == 0
    first, again = op13_gam.train(docs, labels), op13_gam.train(docs.repartition(3), labels)
    assert [list(t) for t in first.tables] == [list(t) for t in again.tables]


def test_measures_by_hand():
    m = dict(zip(op13_gam.MEASURES, op13_gam.measures("The THE the,\nthe## 12"), strict=True))
    n = len("The THE the,\nthe## 12")
    assert m["letters"] == 12 / n and m["upper_case"] == 4 / 12 and m["digits"] == 2 / n and m["white_space"] == 4 / n
    assert m["stops"] == 1 / n and m["symbols"] == 2 / n and m["words_with_symbols"] == 1 / 5 and m["capitalised"] == 2 / 5
    assert m["distinct_words"] == 1 and m["commonest_word"] == 1 / 5 and m["distinct_lines"] == 1
    assert op13_gam.measures("") == [0.0] * len(op13_gam.MEASURES)


def test_queries_keep_the_folds(spark):
    common.prepare(spark)
    got = queries.op13_quality_scores(spark, SF01).select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
