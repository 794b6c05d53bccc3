"""Language codes and toxicity against plain versions that loop over every n-gram, word and sentence of the given tables."""

import math
import re
import zlib
from collections import Counter
from itertools import product

import pytest

from conftest import SF001
from tidemark.llm import op6_ecoc, op10_mil, queries
from tidemark.sources.tables import read_table

M32 = 0xFFFFFFFF


def plain_ngrams(text):
    """Buckets of the 1- to 3-grams of a text's letters, one by one; runs of other characters are one mark, and so are the ends."""
    letters = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    if not any(letters):
        return None
    marks = [c for i, c in enumerate(letters) if i == 0 or c or letters[i - 1]]
    padded = [0, *marks, 0]
    found = [(c * 0xC2B2AE35 & M32) >> 18 for c in padded[1:-1]]
    two = [(a * 0x9E3779B1 + b) & M32 for a, b in zip(padded, padded[1:], strict=False)]
    three = [(a * 0x85EBCA6B + b) & M32 for a, b in zip(two, padded[2:], strict=False)]
    return found + [(x * 0x27D4EB2F & M32) >> 18 for x in two] + [(x * 0x165667B1 & M32) >> 18 for x in three]


def plain_languages(rows):
    """{text: (language, score)} for rows (text, lang), by counting each language's n-grams."""
    counts = {}
    for text, lang in rows:
        found = plain_ngrams(text or "")
        if lang is not None and found:
            counts.setdefault(lang, Counter()).update(found)
    langs = sorted(counts)
    share = {lang: {b: n / counts[lang].total() * 1e6 for b, n in counts[lang].items()} for lang in langs}
    bits = [bits for bits in product((1, -1), repeat=len(langs)) if bits[0] == 1 and -1 in bits]
    buckets = 1 << 14
    sides = []
    for code in bits:
        side = {s: [lang for lang, b in zip(langs, code, strict=True) if b == s] for s in (1, -1)}
        total = {s: sum(sum(share[lang].values()) for lang in side[s]) + 0.5 * buckets for s in side}
        sides.append((code, side, total))
    weights = {}

    def weight(b):
        if b not in weights:
            weights[b] = [math.log((sum(share[lang].get(b, 0) for lang in side[1]) + 0.5) / total[1]) - math.log((sum(share[lang].get(b, 0) for lang in side[-1]) + 0.5) / total[-1])
                          for _, side, total in sides]
        return weights[b]

    def predict(text):
        found = plain_ngrams(text or "")
        if not found:
            return "und", 0.0
        margins = [sum(column) / len(found) for column in zip(*(weight(b) for b in found), strict=True)]
        losses = [sum(math.exp(max(-30, min(30, -code[i] * m * 4))) for (code, _, _), m in zip(sides, margins, strict=True)) / len(sides) for i in range(len(langs))]
        odds = [math.exp(-4 * (x - min(losses))) for x in losses]
        best = losses.index(min(losses))
        return langs[best], odds[best] / sum(odds)
    return predict


def test_language_query_equals_plain_counting(spark):
    docs = read_table(spark, SF001, "documents").collect()
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    predict = plain_languages([(d.text, d.lang) for d in docs if fold(d.doc_id)])
    got = {r.doc_id: r for r in queries.op6_language_codes(spark, SF001).collect()}
    assert len(got) == len(docs)
    for d in docs:
        lang, score = predict(d.text)
        assert got[d.doc_id].lang_pred == lang and got[d.doc_id].score == pytest.approx(score, abs=1e-6)
        assert got[d.doc_id].held_out == (fold(d.doc_id) == 0)


@pytest.mark.parametrize("text", ["", "12 !!", "a", "A b", "é  É--x", "漢字 kana", "a" * 50, "İstanbul ǅ"])
def test_ngrams_equal_plain_ones(text):
    found = op6_ecoc.ngrams(text)
    assert (None if found is None else Counter(found.tolist())) == (None if plain_ngrams(text) is None else Counter(plain_ngrams(text)))


def plain_sentences(text):
    return [m.group() for m in re.finditer(r"[^.!?\n]+", text)]


def plain_features(word):
    return {word} | {word[:n] + "*" for n in (4, 5, 6) if len(word) >= n}


def test_toxicity_query_equals_a_plain_noisy_or(spark):
    """The registered query's scores, sentence by sentence: one minus the chance that nothing offends."""
    docs = read_table(spark, SF001, "documents")
    labels = read_table(spark, SF001, "labels")
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    keep = [r.doc_id for r in docs.select("doc_id").collect() if fold(r.doc_id) != 2]
    model = op10_mil.train(docs.where(docs["doc_id"].isin(keep)), labels.where(labels["doc_id"].isin(keep)).select("doc_id", "toxic"))
    got = {r.doc_id: r for r in queries.op10_toxic_sentences(spark, SF001).collect()}
    for d in docs.collect():
        clear = 1 / (1 + math.exp(model.leak))
        for s in plain_sentences((d.text or "").lower()):
            known = set().union(*[plain_features(w) for w in re.findall(r"\w+", s)], set()) & model.weights.keys()
            if known:
                clear *= 1 / (1 + math.exp(model.bias + sum(model.weights[f] for f in known)))
        assert got[d.doc_id].score == pytest.approx(1 - clear, abs=1e-9)
        assert got[d.doc_id].predicted == int(1 - clear >= 0.3) and got[d.doc_id].held_out == (fold(d.doc_id) == 2)


def test_vocabulary_is_that_of_the_plain_statistic(spark):
    docs, labels = read_table(spark, SF001, "documents").collect(), read_table(spark, SF001, "labels").collect()
    label = {x.doc_id: x.toxic for x in labels}
    rows = [(label[d.doc_id], d.text or "") for d in docs if d.doc_id in label]
    total, seen = Counter(y for y, _ in rows), {0: Counter(), 1: Counter()}
    for y, text in rows:
        seen[y].update(set().union(*[plain_features(w) for w in re.findall(r"\w+", text.lower())], set()))
    n = total[0] + total[1]

    def gain(f):
        out = 0.0
        have = seen[0][f] + seen[1][f]
        for y in (0, 1):
            for x, side in ((seen[y][f], have), (total[y] - seen[y][f], n - have)):
                if x:
                    out += x * math.log(x * n / (total[y] * side))
        return out

    want = {f for f in {*seen[0], *seen[1]} if seen[0][f] + seen[1][f] >= 5 and gain(f) >= 6}
    sample = spark.createDataFrame(rows, "label int, text string").repartition(3)
    assert set(op10_mil.vocabulary(sample, 10**6, 5, 6.0)) == want and want


def test_training_climbs_the_noisy_or():
    """After training no small step of any parameter makes the labels likelier by much: the gradient is that of the plain likelihood."""
    docs = [(1, [[0], [2]]), (1, [[0, 1]]), (0, [[2]]), (0, [[1], [2]]), (0, []), (1, [])] * 5
    weights, bias, leak = op10_mil.fit(docs, 3, {0: 1.0, 1: 1.0}, steps=3000, rate=0.02, decay=1e-2)

    def objective(x):
        total = 0.0
        for y, bags in docs:
            clear = -math.log1p(math.exp(x[4]))
            for b in bags:
                clear -= math.log1p(math.exp(x[3] + sum(x[f] for f in b)))
            total -= (math.log(-math.expm1(clear)) if y else clear) / len(docs)
        return total + 0.5e-2 * sum(w * w for w in x[:3])

    x = [*weights, bias, leak]
    for i in range(5):
        for h in (1e-3, -1e-3):
            moved = list(x)
            moved[i] += h
            assert objective(moved) > objective(x) - 2e-6
