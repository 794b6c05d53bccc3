"""Language codes, toxicity and sanitisation: held-out accuracy, brute force, odd rows."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from conftest import SF01
from tidemark.llm import op3_disclosure, op6_ecoc, op10_mil, queries

SYLLABLES = {"xx": ["ka", "ro", "mi", "tu"], "yy": ["shé", "wén", "lao", "ñi"], "zz": ["der", "ung", "sch", "ein"]}


def prose(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_languages_on_held_out_texts(spark):
    r = random.Random(6)
    rows = [(i, prose(r, lang, r.randint(5, 60)), lang, 0.5) for i, lang in enumerate(r.choices(sorted(SYLLABLES), k=400))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double").repartition(4)
    odd = spark.createDataFrame([(1000, None, "xx", 0.0), (1001, "123 !!", "xx", 0.0), (1002, "", None, 0.0), (None, "karo mitu", None, 0.0), (0, "karo", None, 0.0), (0, "karo", None, 0.0),
                                 (1003, "kami " * 30000, "xx", 0.0), (1004, "kato romi", None, 0.0)], df.schema)
    model = op6_ecoc.train(df.where("doc_id < 200").unionByName(odd))
    got = op6_ecoc.identify(df.where("doc_id >= 200").unionByName(odd), model).collect()
    want = {i: lang for i, _, lang, _ in rows}
    right = [x.lang_pred == want[x.doc_id] for x in got if x.doc_id is not None and 200 <= x.doc_id < 1000]
    assert np.mean(right) > 0.98 and len(got) == 200 + 8
    assert all(0 <= x.score <= 1 for x in got)
    assert {x.doc_id: x.lang_pred for x in got if x.doc_id in (1000, 1001, 1002)} == dict.fromkeys((1000, 1001, 1002), "und")
    assert [x.lang_pred for x in got if x.doc_id is None] == ["xx"]


def test_a_text_between_two_languages_is_ambiguous(spark):
    r = random.Random(7)
    rows = [(i, prose(r, lang, 50), lang) for i, lang in enumerate(["xx", "yy"] * 30)]
    model = op6_ecoc.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.predict("")[0] == "und"
    assert not model.predict(prose(r, "xx", 30))[2]
    assert model.predict("qqqq")[2]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 12])
def test_codewords_differ_and_bits_split(n):
    code = op6_ecoc.codewords(n)
    assert len(code) == n and len({tuple(c) for c in code}) == n
    if n > 1:
        assert (np.abs(code.sum(axis=0)) < n).all()
    if n > 5:
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 3


def test_empty_training_knows_no_language(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = op6_ecoc.train(none)
    assert model.predict("some words") == ("und", 0.0, True)
    assert op6_ecoc.identify(none, model).count() == 0


def toxic_rows(r, n):
    """Toxic documents have one bad sentence among harmless ones."""
    calm, bad, rows = [f"w{i}" for i in range(80)], ["rotten", "vile", "foul"], []
    for i in range(n):
        sentences = [" ".join(r.choices(calm, k=r.randint(2, 8))) for _ in range(r.randint(1, 12))]
        toxic = r.random() < 0.3
        if toxic:
            at = r.randrange(len(sentences))
            sentences[at] += " " + r.choice(bad).title()
        rows.append((i, ". ".join(sentences), int(toxic != (r.random() < 0.03))))  # some labels are wrong
    return rows


def test_toxicity_on_held_out_texts_and_its_sentences(spark):
    rows = toxic_rows(random.Random(10), 1500)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(5000, None, "x"), (5001, "", "x"), (5002, "...", "x"), (None, "w1 vile.", "x"), (0, rows[0][1], "x"), (5003, "w1 w2. " * 20000, "x")],
                                 "doc_id long, text string, score string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5000, 1), (5001, 0), (None, 1), (7000, 1), (5003, None)], "doc_id long, toxic int")
    model = op10_mil.train(docs.where("doc_id < 700 or doc_id >= 5000"), labels.where("doc_id < 700 or doc_id >= 5000"))
    got = op10_mil.score(docs, model).collect()
    assert len(got) == 1506 and all(0 <= x.score <= 1 for x in got)
    by_id = {x.doc_id: x for x in got}
    bad = re.compile("rotten|vile|foul", re.I)
    truth = [(bool(bad.search(t)), by_id[i]) for i, t, _ in rows if i >= 700]
    assert np.mean([t == (x.score >= 0.3) for t, x in truth]) > 0.98
    texts = {i: t for i, t, _ in rows}
    for t, x in truth:
        found = [texts[x.doc_id][s.start:s.end] for s in x.offending]
        assert all(bad.search(s) for s in found)
        if t and x.score >= 0.5:
            assert len(found) == 1
    assert by_id[None].score > 0.5 and by_id[5003].score < 0.3
    assert by_id[5000].score == by_id[5001].score == by_id[5002].score < 0.3


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = op10_mil.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [round(x.score, 6) for x in op10_mil.score(docs, model).collect()] == [0.5, 0.5]
    one = op10_mil.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert all(x.score > 0.99 for x in op10_mil.score(docs, one).collect())
    assert op10_mil.score(docs.limit(0), model).count() == 0


# The patterns as the contract words them, tried as they stand.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    s = 0
    for k, c in enumerate(digits[::-1]):
        d = int(c) * (2 if k % 2 else 1)
        s += d // 10 + d % 10
    return s % 10 == 0


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return ([("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
            + [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
            + [("card", m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
            + [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15])


def test_base_spans_are_those_of_the_plain_patterns():
    r = random.Random(3)
    parts = ["a", "b.c", "@", "@@", ".", "x@y.z", "a@b.c@d.ee", "1.2.3.4", "256.1.1.1", "0255.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "+49 (30) 123-456.78", "+1", "+12345678 ",
             " ", "-", "é", "9", "12", "..", "%", "+", "00", "1.2.3.4.5.6.7.8", "5500 0000 0000 0004", "\n", "٣", "a-b@c-d.e-f"]
    for _ in range(20000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert op3_disclosure.base_spans(text) == plain_base(text), text


def test_long_runs_take_linear_time():
    for unit in ("a", "1", "1.", "+1", "@a", "a@", "1 ", "-", "."):
        op3_disclosure.base_spans(unit * 200_000)


def test_terms_that_disclose(spark):
    rows = [(i, f"note {i} word{i * 7} from kingfisher desk mail bob@corp.example about item{i}", "x") for i in range(6)]
    rows += [(100 + i, "note from desk mail about " + " ".join(f"filler{j}" for j in range(i % 5 + 3)), "x") for i in range(300)]
    rows += [(500, "kingfisher flew by without an address", "x"), (501, None, "x"), (None, "card 4111111111111111", "x"), (502, "", "x"), (1, rows[1][1], "x")]
    rows += [(600 + i, "just the same singular words near ann@copy.example here", "x") for i in range(50)]  # copies prove nothing
    df = spark.createDataFrame(rows, "doc_id long, text string, clean string").repartition(5)
    got = op3_disclosure.sanitise(df, remove_at=0.99).select("rest.*", "clean", "base", "spans").toDF("doc_id", "other", "clean", "base", "spans").collect()
    assert len(got) == len(rows)
    for x in got:
        text = next(t or "" for i, t, _ in rows if i == x.doc_id)
        spans = [tuple(s) for s in x.spans]
        assert [tuple(s) for s in x.base] == plain_base(text) and spans[:len(x.base)] == plain_base(text)
        terms = [text[a:b] for k, a, b in spans if k == "term"]
        assert terms == (["kingfisher"] if x.doc_id is not None and x.doc_id < 6 else [])
        assert "@" not in x.clean and "4111" not in x.clean
        if not x.spans:
            assert x.clean == text
    assert next(x.clean for x in got if x.doc_id == 2) == "note 2 word14 from [WORD] desk mail [EMAIL] about item2"
    removed = op3_disclosure.sanitise(df).where("rest.doc_id = 2").first().clean
    assert removed == "note 2 word14 from  desk mail [EMAIL] about item2"
    assert op3_disclosure.sanitise(df.limit(0)).count() == 0


def test_disclosure_is_relative_mutual_information(spark):
    rows = [(i, f"alpha{i % 3} beta c{i}d{i} x@y.zz e{i}f", 0) for i in range(12)] + [(50 + i, "beta gamma " * (i % 2 + 1), 0) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    text_rows = df.selectExpr("struct(doc_id) as rest", "text")
    from pyspark.sql import functions as F
    from tidemark.llm import common
    scanned = text_rows.mapInArrow(op3_disclosure._scan, common.output(text_rows, "rest", f"text string, base {op3_disclosure.SPANS_DDL}"))
    hits = scanned.where(F.size("base") > 0).withColumn("row", F.monotonically_increasing_id())
    got = {r.term: r.disclosure for r in op3_disclosure._disclosing(text_rows, common.written(spark, hits, "t"), 0.0, -9.0, 1.0).collect()}
    n, entity = 52, 12
    for term, own, both in [("alpha0", 4, 4), ("beta", 52, 12)]:
        assert got[term] == pytest.approx(math.log(both * n / (own * entity)) / math.log(n / entity))


def brute_terms(rows, least_share=0.5, most_chance=0.05, threshold=0.8):
    """(text, word) pairs that disclose, by counting every word and entity of every text."""
    texts = sorted({t or "" for _, t in rows})
    copies = {t: sum((x or "") == t for _, x in rows) for t in texts}
    words, entities = {}, {}
    for t in texts:
        base = plain_base(t)
        inside = [range(a, b) for _, a, b in base]
        words[t] = ({m.group().lower() for m in re.finditer(r"\w+", t)},
                    {m.group().lower() for m in re.finditer(r"\w+", t) if not any(i in r for i in range(m.start(), m.end()) for r in inside)})
        entities[t] = {(k, t[a:b].lower()) for k, a, b in base}
    have, out = {}, set()
    for t in texts:
        for w in words[t][0]:
            have.setdefault(w, set()).add(t)
    holds = {}
    for t in texts:
        for e in entities[t]:
            holds.setdefault(e, set()).add(t)
    n = sum(copies.values())
    rows_of = lambda ts: sum(copies[t] for t in ts)
    for e, with_e in holds.items():
        p = len(with_e) / len(texts)
        for w in {w for t in with_e for w in words[t][1]}:
            both = {t for t in with_e if w in words[t][1]}
            q = len(both) / len(have[w])
            chance = math.exp(-len(have[w]) * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0))) if p < q else 1
            if rows_of(with_e) < n and len(both) >= least_share * (len(have[w]) + 1) and chance <= most_chance:
                strength = math.log(rows_of(both) * n / (rows_of(have[w]) * rows_of(with_e))) / math.log(n / rows_of(with_e))
                if strength >= threshold - 1e-12:
                    out |= {(t, w) for t in with_e if w in words[t][1]}
    return out


@pytest.mark.parametrize("share", [0.5, 0.6])
def test_terms_of_the_given_table_equal_brute_force(spark, share):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(10**6 + i, f"the desk of kingfisher number {i} mail bob@corp.example") for i in range(4)] * 2  # an entity of several texts, each twice
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = op3_disclosure.sanitise(df, least_share=share).collect()
    texts = {i: t or "" for i, t in rows}
    found = {(texts[g.rest.doc_id], texts[g.rest.doc_id][s.start:s.end].lower()) for g in got for s in g.spans if s.kind == "term"}
    want = brute_terms(rows, share)
    assert found == want and any(w == "kingfisher" for _, w in found)
    assert share > 0.5 or len({t for t, _ in found}) > 40
    for g in got:
        assert [tuple(s) for s in g.base] == plain_base(texts[g.rest.doc_id])


def test_digest_columns(spark, tmp_path):
    spark.createDataFrame([(1, "mail a@b.cd or 1.2.3.4", "en"), (2, None, "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op3_disclosure_sanitisation(spark, str(tmp_path)).collect()}
    assert got[1].spans == "email:5:11,ip:15:22" and got[1].base_sha256 == hashlib.sha256(got[1].spans.encode()).hexdigest()
    assert tuple(got[2]) == (2, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
