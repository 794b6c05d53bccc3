"""Toxicity by multiple-instance learning: documents are labelled, sentences are found.

A sentence's chance to offend is a logistic function of its features from a vocabulary: words, and
beginnings of words, whose presence tells documents of the two labels apart. A sentence without any has
none. A document is toxic if any of its sentences offends, or for a reason outside of them (the leak): a noisy-or. Its
log likelihood over labelled documents is climbed by gradient steps through the noisy-or, so a
toxic document's blame goes to the sentences that explain it best. Afterwards the sentences
themselves have scores, which locate the offending ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, common

#: A sentence ends with these, or with a line.
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
#: Beginnings of words that are features, in characters.
PREFIXES = (4, 5, 6)
#: Distinct words whose features a worker remembers.
MEMO_WORDS = 500_000


def features(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) >= n]]


def softplus(z):
    return np.logaddexp(0, z)


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    leak: float

    def __post_init__(self):
        self.memo: dict[str, tuple] = {}

    def known(self, word: str) -> tuple:
        """The word's features that are in the vocabulary."""
        found = self.memo.get(word)
        if found is None:
            found = tuple(f for f in features(word) if f in self.weights)
            if len(self.memo) < MEMO_WORDS:
                self.memo[word] = found
        return found

    def sentences(self, text: str) -> list[tuple[int, int, set]]:
        """(start, end, features) of the sentences that have any."""
        lower, known, out = text.lower(), self.known, []
        if len(lower) != len(text):  # where a letter's lower case is two, positions count in the text
            lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        for m in SENTENCE.finditer(lower):
            found = [known(w) for w in WORD.findall(m.group())]
            if any(found):
                out.append((m.start(), m.end(), set().union(*found)))
        return out

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """A text's chance to be toxic, and (start, end, chance) of its sentences with features."""
        found = [(a, b, self.bias + math.fsum(self.weights[f] for f in fs)) for a, b, fs in self.sentences(text)]
        clear = softplus(self.leak) + softplus(np.array([f[2] for f in found])).sum()
        return float(-np.expm1(-clear)), [(a, b, float(np.exp(-softplus(-z)))) for a, b, z in found]


def _word_counts(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of a task each feature is, by label."""
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in rows_in:
        for label, text in zip(batch.column(0).to_pylist(), batches.texts(batch), strict=True):
            seen[label].update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
    rows = ((label, word, n) for label, words in seen.items() for word, n in words.items())
    yield from batches.record_batches(rows, pa.schema([("label", pa.int32()), ("word", pa.string()), ("n", pa.int64())]))


def vocabulary(sample: DataFrame, size: int, least: int, least_gain: float) -> list[str]:
    """The features whose presence tells most about the label, from all rows of ``sample``: by half the
    G statistic, which must reach ``least_gain`` (10: once in 130,000 words by chance)."""
    total = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    if not n1 or not n0:
        return []
    words = sample.mapInArrow(_word_counts, "label int, word string, n long").groupBy("word").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b"))

    def part(x, whole):
        return F.when(x > 0, x * F.log(x * (n1 + n0) / whole)).otherwise(0.0)

    a, b = F.col("a"), F.col("b")
    g = part(a, (a + b) * n1) + part(b, (a + b) * n0) + part(n1 - a, (n1 + n0 - a - b) * n1) + part(n0 - b, (n1 + n0 - a - b) * n0)
    return [r["word"] for r in words.where(a + b >= least).withColumn("gain", g).where(F.col("gain") >= least_gain).orderBy(F.desc("gain"), "word").limit(size).collect()]


def _bags(known: dict[str, int]):
    """Each document as its label and its sentences' feature numbers."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Model(dict.fromkeys(known, 0.0), 0.0, 0.0)

        def rows():
            for batch in rows_in:
                for label, text in zip(batch.column(0).to_pylist(), batches.texts(batch), strict=True):
                    yield label, [sorted(known[f] for f in fs) for _, _, fs in words.sentences(text)]

        yield from batches.record_batches(rows(), pa.schema([("label", pa.int32()), ("bags", pa.list_(pa.list_(pa.int32())))]), 512)
    return run


def fit(docs: list, n_words: int, class_weight: dict[int, float], steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float, float]:
    """Weights, bias and leak by Adam on the noisy-or's log likelihood. docs: (label, bags)."""
    bag_doc, word, bag = [], [], []
    for i, (_, bags) in enumerate(docs):
        for b in bags:
            word.extend(b)
            bag.extend([len(bag_doc)] * len(b))
            bag_doc.append(i)
    bag_doc, word, bag = np.array(bag_doc, int), np.array(word, int), np.array(bag, int)
    y = np.array([d[0] for d in docs], float)
    share = np.array([class_weight[int(v)] for v in y])
    share /= share.sum()
    x = np.zeros(n_words + 2)
    x[-2], x[-1] = -4.0, -3.0  # bias, leak
    m, v = np.zeros_like(x), np.zeros_like(x)
    logistic = lambda z: np.exp(-softplus(-z))
    for t in range(1, steps + 1):
        z = np.bincount(bag, x[word], len(bag_doc)) + x[-2]
        clear = softplus(x[-1]) + np.bincount(bag_doc, softplus(z), len(y))
        by_clear = share * np.where(y == 1, -1 / np.expm1(np.minimum(np.maximum(clear, 1e-9), 500)), 1.0)
        by_z = by_clear[bag_doc] * logistic(z)
        grad = np.empty_like(x)
        grad[:-2] = np.bincount(word, by_z[bag], n_words) + decay * x[:-2]
        grad[-2] = by_z.sum()
        grad[-1] = by_clear.sum() * logistic(x[-1])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x[:-2], float(x[-2]), float(x[-1])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = 4096, vocabulary_size: int = 2048, least_docs: int = 5, least_gain: float = 10.0) -> Model:
    """A model from at most ``sample_rows`` labelled rows of each label (those whose ids hash lowest), each
    label weighted by how many rows it has in all. Labels but 0 and 1 and null ids are left out; a row with two
    labels counts for both, and of rows that repeat an id the smallest text is learned from. Without rows
    of both labels the model has no vocabulary, and its leak is the share of label 1 (one half without rows).
    """
    spark = docs.sparkSession
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)").distinct()
    total = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    taken = None
    for label in (0, 1):
        part = rows.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
        taken = part if taken is None else taken.unionByName(part)
    taken = common.written(spark, taken, "labels")
    wanted = common.id_and_text(docs, id_col, text_col)
    sample = wanted.join(F.broadcast(taken), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    sample = common.written(spark, sample.select("label", "text"), "labelled")
    words = vocabulary(sample, vocabulary_size, least_docs, least_gain)
    n = sum(total.values())
    if not words:
        share = min(max(total.get(1, 0) / n if n else 0.5, 1e-6), 1 - 1e-6)
        return Model({}, 0.0, float(np.log(np.expm1(-np.log1p(-share)))))
    known = {w: i for i, w in enumerate(words)}
    found = [(r["label"], r["bags"]) for r in sample.mapInArrow(_bags(known), "label int, bags array<array<int>>").collect()]
    used = Counter(d[0] for d in found)
    weights, bias, leak = fit(found, len(words), {k: total[k] / c for k, c in used.items()})
    return Model({w: float(weights[i]) for w, i in known.items()}, bias, leak)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", offending: float = 0.3) -> DataFrame:
    """(id, score, offending) of every row of ``docs``: the chance of label 1, and (start, end, score) of the
    sentences that reach ``offending``.

    A null or empty text, or one without words of the vocabulary, has the leak's score and no sentences. Repeated rows and null ids
    give a row each; other columns are not read; no shuffle.
    """
    stretch = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in:
            found = [model.score(t) for t in batches.texts(batch)]
            named = [[{"start": a, "end": b, "score": p} for a, b, p in f[1] if p >= offending] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.float64()), pa.array(named, stretch)], names=[id_col, "score", "offending"])

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, common.output(docs, id_col, "score double, offending array<struct<start:long,`end`:long,score:double>>"))
