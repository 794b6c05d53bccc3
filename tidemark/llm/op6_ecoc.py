"""Language identification by error-correcting output codes.

Each language has a codeword of bits, far from the others'. For each bit there is one binary
classifier over hashed character n-grams: the log odds of an n-gram among the languages whose
codewords have the bit against those whose codewords don't, from counts that Spark takes over all
labelled texts. A text's margin for a bit is the mean log odds of its n-grams; loss-weighted
decoding adds, for each language, an exponential loss of how far each margin goes against its
codeword, and takes the language of the least loss. Where two languages are nearly as close, the text is ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, common

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For each code point whether it is a letter (made once in each worker)."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngrams(text: str) -> np.ndarray | None:
    """Buckets of the 1- to 3-grams of lower-cased letters, other characters as one mark; None without a letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letter_table()[c]
    if not letter.any():
        return None
    c = np.where(letter, c, 0)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    c = np.concatenate(([0], c[keep], [0])).astype(np.uint32)
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:]
    three = two[:-1] * np.uint32(0x85EBCA6B) + c[2:]
    shift = np.uint32(32 - BUCKET_BITS)
    return np.concatenate([(c[1:-1] * np.uint32(0xC2B2AE35)) >> shift, (two * np.uint32(0x27D4EB2F)) >> shift, (three * np.uint32(0x165667B1)) >> shift])


def codewords(n: int) -> np.ndarray:
    """(n, bits) of +1 and -1: all splits of up to 5 classes, else the random code whose nearest words are farthest apart."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        splits = [[1] + [1 if s >> i & 1 else -1 for i in range(n - 1)] for s in range(2 ** (n - 1) - 1)]
        return np.array(splits, float).T
    bits, r, best = math.ceil(10 * math.log2(n)), np.random.default_rng(6), (-1, None)
    for _ in range(200):
        code = r.choice([-1.0, 1.0], (n, bits))
        code[0, np.abs(code.sum(0)) == n] *= -1  # a bit must split the classes
        apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if apart > best[0]:
            best = (apart, code)
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (BUCKETS, bits)

    def losses(self, text: str) -> np.ndarray | None:
        found = ngrams(text)
        if found is None or not self.languages:
            return None
        counts = np.bincount(found, minlength=BUCKETS)
        at = np.flatnonzero(counts)
        margins = counts[at] @ self.weights[at] / len(found)
        return np.exp(np.clip(-self.code * margins * 4, -30, 30)).mean(axis=1)

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score (0 to 1) and whether it is ambiguous."""
        losses = self.losses(text)
        if losses is None:
            return UNDETERMINED, 0.0, True
        p = np.exp(-4 * (losses - losses.min()))
        p /= p.sum()
        best = int(losses.argmin())
        second = np.partition(p, -2)[-2] if len(p) > 1 else 0.0
        return self.languages[best], float(p[best]), bool(p[best] - second < 0.1)


def _counts(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's n-gram counts by language, as one row of numbers a language."""
    total: dict[str, np.ndarray] = {}
    for batch in rows_in:
        for lang, text in zip(batch.column(0).to_pylist(), batches.texts(batch), strict=True):
            found = ngrams(text)
            if found is not None:
                total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total[lang] += np.bincount(found, minlength=BUCKETS)
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], schema=schema)


def train(labelled: DataFrame, *, lang_col: str = "lang", text_col: str = "text", smoothing: float = 0.5) -> Model:
    """The model of all rows of ``labelled`` with a language and a letter in the text.

    The driver gets one count for each language and bucket: its size depends on the number of languages only.
    """
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = rows.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    table = np.zeros((len(languages), BUCKETS))
    for i, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        table[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    table /= np.maximum(table.sum(1, keepdims=True), 1) / 1e6  # each language counts alike, by a million n-grams
    code = codewords(len(languages))
    weights = np.zeros((BUCKETS, code.shape[1]))
    for bit in range(code.shape[1]):
        sides = [table[code[:, bit] == s].sum(0) + smoothing for s in (1, -1)]
        if (code[:, bit] == -1).any():
            weights[:, bit] = np.log(sides[0] / sides[0].sum()) - np.log(sides[1] / sides[1].sum())
    return Model(languages, code, weights)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous) of every row of ``docs``.

    A null text, or one without a letter, is ``und`` with score 0 (as is every text when the model knows no
    language). Repeated rows and null ids give a row each; other columns are not read. No shuffle.
    """
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in:
            found = [model.predict(t) for t in batches.texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                                              pa.array([f[2] for f in found], pa.bool_())], names=[id_col, "lang_pred", "score", "ambiguous"])

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, common.output(docs, id_col, "lang_pred string, score double, ambiguous boolean"))
