"""The pipeline's stages, each held against brute force on what the stage before it kept."""

import random

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from test_near_duplicates import brute
from test_searches import brute_windows
from test_text_models import plain_base, prose

from tidemark.llm import common, op6_ecoc
from tidemark.llm.tokens import load

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, row int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = random.Random(12)
    folder = str(tmp_path_factory.mktemp("tables"))
    benchmark = [(i, prose(r, "xx", r.randint(4, 30))) for i in range(6)]
    rows = []
    for i in range(80):
        lang = r.choice(["xx", "yy", "zz"])
        text = prose(r, lang, r.randint(10, 120))
        if i % 8 == 0:
            text += " " + r.choice(benchmark)[1]
        if i % 9 == 0:
            text += f" mail a{i}@b.example or 10.0.0.{i}"
        rows.append((i, text, lang))
        if i % 4 == 0:
            rows.append((1000 + i, text + " " + prose(r, lang, 1), lang))
        if i % 6 == 0:
            rows.append((2000 + i, text, lang))
    rows += [(3000, None, "xx"), (3001, "", "yy"), (3002, "12 34 !!", None), (None, prose(r, "xx", 40), "xx"), (5, rows[5][1], "xx"), (3003, "karo " * 8000, "xx")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), "extra", 1) for i, t, lang in rows], SCHEMA).repartition(3)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, benchmark


def stage_results(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(spark, stage(spark, docs, folder), f"test-{name}")
        out.append(docs)
    return out


def keyed(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_each_stage(spark, tables):
    folder, benchmark = tables
    before, language, alone, clean, private, packed = stage_results(spark, folder)
    for df in (language, alone, clean, private):
        assert df.columns == before.columns and df.dtypes == before.dtypes

    assert keyed(language) == sorted(((i, t) for i, t in keyed(before) if any(c.isalpha() for c in t or "")), key=str)

    rows = keyed(language)
    # each row is a vertex of its own; of a component the row with the smallest id stays
    component = {}
    for n, _, root, _ in brute([(n, t) for n, (_, t) in enumerate(rows)]):
        component.setdefault(root, []).append(rows[n])
    keep = [min(found, key=lambda x: (x[0] is None, x[0] or 0)) for found in component.values()]
    assert sorted((str(i) for i, _ in keyed(alone))) == sorted(str(i) for i, _ in keep)
    assert set(keyed(alone)) <= set(rows) and len(keyed(alone)) < len(rows)

    bad = {x[0] for x in brute_windows(keyed(alone), benchmark) if x[5]}
    assert bad and keyed(clean) == [x for x in keyed(alone) if x[0] not in bad]

    cleaned = dict(keyed(private))
    assert len(cleaned) == len(keyed(clean))
    for i, text in keyed(clean):
        want, at = "", 0
        for kind, a, b in sorted(plain_base(text), key=lambda s: s[1]):
            want += text[at:a] + f"[{kind.upper()}]"
            at = b
        assert cleaned[i] == want + text[at:] and not plain_base(cleaned[i])
    assert all(r.n_chars == len(r.text) for r in private.collect())

    tokenizer = load(public_tokenizers.path("word_bpe_49k.json"))
    total = {}
    for r in packed.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in keyed(private)}


def test_run_gives_the_last_stage(spark, tables):
    folder, _ = tables
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).select("doc_id", "doc_tokens").distinct().collect()), key=str)
    assert got == sorted(map(tuple, stage_results(spark, folder)[-1].select("doc_id", "doc_tokens").distinct().collect()), key=str)
    assert set(columns) <= set(corpus_pipeline.run(spark, folder).columns)
    assert np.all([len(s) == 2 for s in corpus_pipeline.STAGES])


def test_texts_without_any_language_label_stay(spark):
    rows = [(1, "some words"), (2, None), (3, "12 !!"), (4, "\n\u00e9t\u00e9"), (None, "more"), (4, "again \U00020000"), (5, "")]
    docs = spark.createDataFrame([(i, t, None, "s", 0, None, 1) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    assert keyed(kept) == sorted(((i, t) for i, t in rows if any(c.isalpha() for c in t or "")), key=str)


def test_texts_under_one_id_stay_apart(spark):
    """A repeated id is no link: both of its texts stay, unless one is a copy of another row's."""
    words = lambda a, n=12: " ".join(f"{a}{i}" for i in range(n))
    rows = [(1, words("a")), (1, words("b")), (0, words("b")), (None, words("c")), (None, words("c")), (None, words("d")), (7, words("d")), (8, ""), (8, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "xx", "s", len(t or ""), "k", 1) for i, t in rows], SCHEMA).repartition(4)
    alone = corpus_pipeline.near_duplicates(spark, docs, "")
    assert alone.columns == docs.columns
    assert keyed(alone) == sorted([(1, words("a")), (0, words("b")), (None, words("c")), (7, words("d")), (8, ""), (8, ""), (9, None)], key=str)


def test_language_decides_by_the_prediction(spark):
    r = random.Random(6)
    rows = [(i, prose(r, lang, 40), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 30)]
    mixed = prose(r, "xx", 300) + " " + prose(r, "yy", 300)
    rows += [(100, prose(r, "xx", 40), "yy"), (101, prose(r, "zz", 40), None), (102, "12 !!", "xx")]
    docs = spark.createDataFrame([(i, t, lang, "s", 1, "k", 1) for i, t, lang in rows], SCHEMA)
    kept = {x.doc_id: x for x in corpus_pipeline.language(spark, docs, "").collect()}
    assert set(range(90)) | {100, 101} == set(kept)
    assert all(kept[i].lang == lang and kept[i].text == t for i, t, lang in rows[:90])
    assert kept[100].lang == "xx" and kept[101].lang == "zz" and kept[100].spans == "k"
    # a text between two languages goes, unless its own label is what is predicted
    model = op6_ecoc.train(docs)
    cuts = [mixed[a:b] for a in range(0, len(mixed) - 400, 40) for b in range(a + 400, len(mixed), 40)]
    between = next(t for t in cuts if model.predict(t)[2])
    label = model.predict(between)[0]
    for lang, stays in ((label, True), (None, False), ("zz", False)):
        more = docs.unionByName(spark.createDataFrame([(200, between, lang, "s", 1, "k", 1)], SCHEMA))
        again = op6_ecoc.train(more)
        if again.predict(between)[2] and again.predict(between)[0] == label:
            assert ({200} <= {x.doc_id for x in corpus_pipeline.language(spark, more, "").collect()}) == stays


def test_pieces_give_the_texts_back(spark, tables):
    """The last stage is training data: its ids, put together, decode to the texts."""
    folder, _ = tables
    results = stage_results(spark, folder)
    tokenizer, ids = load(public_tokenizers.path("word_bpe_49k.json")), {}
    for r in sorted(results[-1].collect(), key=lambda r: r.start):
        found = np.frombuffer(r.ids, "<u4")
        assert len(found) == r.length
        ids.setdefault(r.doc_id, []).extend(found.tolist())
    for doc_id, text in keyed(results[-2]):
        assert ids[doc_id][-1] == 2 and ids[doc_id][:-1] == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_documents(spark, tables, tmp_path):
    folder, _ = tables
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
