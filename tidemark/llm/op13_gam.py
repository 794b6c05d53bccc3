"""Quality by a generalised additive model with pairwise interactions.

A text is described by a few measures of its characters, words and lines. Each measure is cut into bins at
quantiles, and the log odds of label 1 are an intercept plus one number from a table per measure, by its bin, plus one
from a table per interacting pair, by both bins. The tables are learned by cyclic boosting: in turn
each measure gets a shallow tree over its bins that follows the gradient of the log loss, shrunk and added to its
table, round by round. Then pairs are ranked by how much a tree with one cut on either measure would still
gain, and the best are boosted in the same way. Scoring looks tables up for a batch of texts at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, common

MEASURES = ("log_chars", "log_words", "letters", "upper_case", "digits", "white_space", "stops", "symbols", "word_length", "distinct_words",
            "commonest_word", "short_words", "words_with_symbols", "capitalised", "distinct_lines", "line_length", "symbol_entropy", "char_entropy",
            "distinct_symbols", "repeated_pairs")

#: Kinds of code points: other sign, letter, upper-case letter, digit, white space, stop or comma.
OTHER, LETTER, UPPER, DIGIT, SPACE, STOP = range(6)


def _kinds() -> np.ndarray:
    table = np.fromiter((SPACE if chr(c).isspace() else DIGIT if chr(c).isdigit() else UPPER if chr(c).isupper() else LETTER if chr(c).isalpha() else OTHER
                         for c in range(0x110000)), np.uint8, 0x110000)
    table[[ord(c) for c in ".,;:'\"?()-"]] = STOP
    return table


def _entropy(counts: np.ndarray) -> float:
    p = counts[counts > 0] / max(1, counts.sum())
    return float(-(p * np.log2(p)).sum()) if len(p) else 0.0


def measures(text: str) -> list[float]:
    """The measures of a whole text, in the order of ``MEASURES``; an empty text has zeros."""
    if not text:
        return [0.0] * len(MEASURES)
    kinds = batches.kept_by_worker(("op13 kinds",), _kinds)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = kinds[points]
    n, by_kind = len(points), np.bincount(kind, minlength=6)
    letters = by_kind[LETTER] + by_kind[UPPER]
    signs = points[kind == OTHER]
    words, lines = text.split(), [s for s in text.split("\n") if s.strip()]
    m = max(1, len(words))
    counts, pairs = Counter(words), Counter(zip(words, words[1:], strict=False))
    edge = kind.copy()
    edge[1:][kind[:-1] != SPACE] = SPACE  # only first characters of words are left
    first = np.bincount(edge, minlength=6)
    ends = np.zeros(n, bool)  # a sign after anything but white space and before white space or the end
    ends[:] = kind == OTHER
    ends[:-1] &= kind[1:] == SPACE
    return [math.log1p(n), math.log1p(len(words)), letters / n, by_kind[UPPER] / max(1, letters), by_kind[DIGIT] / n, by_kind[SPACE] / n, by_kind[STOP] / n, by_kind[OTHER] / n,
            (n - by_kind[SPACE]) / m, len(counts) / m, max(counts.values(), default=0) / m, sum(c for w, c in counts.items() if len(w) <= 3) / m, int(ends.sum()) / m,
            first[UPPER] / m, len(set(lines)) / max(1, len(lines)), math.log1p(n / max(1, len(lines))), _entropy(np.bincount(signs % 4096)) if len(signs) else 0.0,
            _entropy(np.bincount(points[points < 4096])), math.log1p(len(np.unique(signs))), sum(c for c in pairs.values() if c > 1) / m]


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)  # of each measure's bins
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # of each measure's bin, its bin in the pairs' tables
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def names(self) -> list[str]:
        return [MEASURES[i] for i in range(len(self.tables))] + [f"{MEASURES[i]} x {MEASURES[j]}" for i, j in self.pairs]

    def terms(self, x: np.ndarray) -> np.ndarray:
        """(texts, tables): what each table adds to the log odds."""
        bins = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)]
        singles = [t[b] for t, b in zip(self.tables, bins, strict=True)]
        doubles = [t[self.coarse[i][bins[i]], self.coarse[j][bins[j]]] for (i, j), t in zip(self.pairs, self.pair_tables, strict=True)]
        return np.stack([*singles, *doubles], axis=1) if singles else np.zeros((len(x), 0))

    def chances(self, terms: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + terms.sum(axis=1), -40, 40)))


def _gain(g, h, ridge: float):
    return g * g / (h + ridge)


def shallow_tree(g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, ridge: float, least: int) -> np.ndarray:
    """Steps by bin of a tree of at most ``2 ** depth`` leaves over ordered bins with gradients ``g``, curvatures ``h`` and at least ``least`` of the ``rows`` in a leaf."""
    step = np.full(len(g), -g.sum() / (h.sum() + ridge))
    if depth and len(g) > 1:
        gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(rows)[:-1]
        found = _gain(gl, hl, ridge) + _gain(g.sum() - gl, h.sum() - hl, ridge)
        found = np.where((nl >= least) & (rows.sum() - nl >= least), found, -np.inf)
        cut = int(found.argmax()) + 1
        if found[cut - 1] > _gain(g.sum(), h.sum(), ridge) + 1e-12:
            step = np.concatenate([shallow_tree(g[at], h[at], rows[at], depth - 1, ridge, least) for at in (slice(cut), slice(cut, None))])
    return step


def _quarters(table: np.ndarray) -> list[np.ndarray]:
    """Sums of the four parts (low and low, low and high, high and low, high and high) that each pair of cuts makes."""
    c = table.cumsum(0).cumsum(1)
    low, rows, columns = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
    return [low, rows - low, columns - low, c[-1, -1] - rows - columns + low]


def cross_tree(g: np.ndarray, h: np.ndarray, rows: np.ndarray, ridge: float, least: int) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree with one cut on either side of a table; ``least`` rows on both sides of either cut."""
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gs, hs, (ll, lh, hl, hh) = _quarters(g), _quarters(h), _quarters(rows)
    gain = sum(_gain(a, b, ridge) for a, b in zip(gs, hs, strict=True)) - _gain(g.sum(), h.sum(), ridge)
    gain = np.where(np.minimum.reduce([ll + lh, hl + hh, ll + hl, lh + hh]) >= least, gain, -np.inf)
    at = np.unravel_index(int(gain.argmax()), gain.shape)
    if not gain[at] > 0:
        return 0.0, np.zeros_like(g)
    down, across = np.arange(g.shape[0]) > at[0], np.arange(g.shape[1]) > at[1]
    step = np.array([-a[at] / (b[at] + ridge) for a, b in zip(gs, hs, strict=True)])
    return float(gain[at]), step[2 * down[:, None] + across[None, :]]


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, bins: int = 32, pair_bins: int = 8, n_pairs: int = 10, rounds: int = 150, pair_rounds: int = 50,
        rate: float = 0.1, depth: int = 2, ridge: float = 1.0, least: int = 5) -> Model:
    """The tables for measures ``x``, labels ``y`` and row weights (their mean is one)."""
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(x.shape[1])]
    binned = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)]
    size = [len(e) + 1 for e in edges]
    share = min(max(float((weight * y).sum() / weight.sum()), 1e-6), 1 - 1e-6)
    odds = np.full(len(y), math.log(share / (1 - share)))
    tables, rows = [np.zeros(s) for s in size], [np.bincount(b, minlength=s) for b, s in zip(binned, size, strict=True)]

    def slopes():
        p = 1 / (1 + np.exp(-odds))
        return weight * (p - y), weight * p * (1 - p)

    for _ in range(rounds):
        for i, b in enumerate(binned):
            g, h = slopes()
            step = rate * shallow_tree(np.bincount(b, g, size[i]), np.bincount(b, h, size[i]), rows[i], depth, ridge, least)
            tables[i] += step
            odds += step[b]
    coarse = [np.arange(s) * pair_bins // s if s > pair_bins else np.arange(s) for s in size]
    rough, width = [c[b] for c, b in zip(coarse, binned, strict=True)], [int(c[-1]) + 1 for c in coarse]

    def crossed(i, j, v=None):
        return np.bincount(rough[i] * width[j] + rough[j], v, width[i] * width[j]).reshape(width[i], width[j])

    g, h = slopes()
    ranked = sorted(((cross_tree(crossed(i, j, g), crossed(i, j, h), crossed(i, j), ridge, least)[0], i, j) for i, j in combinations(range(len(size)), 2)), key=lambda r: (-r[0], r[1:]))
    pairs = [(i, j) for gain, i, j in ranked[:n_pairs] if gain > 0]
    pair_tables, pair_rows = [np.zeros((width[i], width[j])) for i, j in pairs], [crossed(i, j) for i, j in pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(pairs):
            g, h = slopes()
            step = rate * cross_tree(crossed(i, j, g), crossed(i, j, h), pair_rows[k], ridge, least)[1]
            pair_tables[k] += step
            odds += step[rough[i], rough[j]]
    intercept = math.log(share / (1 - share))
    for table, at in [*zip(tables, binned, strict=True), *zip(pair_tables, [(rough[i], rough[j]) for i, j in pairs], strict=True)]:
        mean = float((weight * table[at]).sum() / weight.sum())  # a table says how far from the usual text
        table -= mean
        intercept += mean
    return Model(intercept, edges, tables, pairs, coarse, pair_tables)


def _measured(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_in:
        found = [measures(t) for t in batches.texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["label", "x"])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = 8192, **settings) -> Model:
    """A model from at most ``sample_rows`` labelled rows of each label (those whose ids hash lowest), each weighted by how
    many rows its label has in all; ``settings`` are those of ``fit``.

    Labels but 0 and 1 and null ids are left out; a row with two labels counts for both, and of rows that repeat an id the
    smallest text is learned from. Without rows of both labels there are no tables, and every text's score is the share of
    label 1 (one half without rows). The driver gets the measures of the sample only.
    """
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)").distinct()
    taken = None
    for label in (0, 1):
        part = rows.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
        taken = part if taken is None else taken.unionByName(part)
    taken = common.written(docs.sparkSession, taken, "quality_labels")
    sample = common.id_and_text(docs, id_col, text_col).join(F.broadcast(taken), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    found = sample.select("label", "text").mapInArrow(_measured, "label int, x array<double>").toPandas()
    total = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(total.values())
    y = found["label"].to_numpy(float)
    if not (0 < y.sum() < len(y)):
        share = min(max(total.get(1, 0) / n if n else 0.5, 1e-6), 1 - 1e-6)
        return Model(math.log(share / (1 - share)))
    x = np.array(found["x"].tolist())
    order = np.lexsort([*x.T, y])  # whatever order the rows came in
    x, y = x[order], y[order]
    weight = np.where(y == 1, total[1] / y.sum(), total[0] / (1 - y).sum())
    return fit(x, y, weight / weight.mean(), **settings)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", n_reasons: int = 3) -> DataFrame:
    """(id, score, reasons) of every row: the chance of label 1, and the names of up to ``n_reasons`` tables that lower it most.

    A null text is empty; an empty text has measures of zero. Repeated rows and null ids give a row each; other columns
    are not read; no shuffle.
    """
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = model.names()
        for batch in rows_in:
            terms = model.terms(np.array([measures(t) for t in batches.texts(batch)]).reshape(-1, len(MEASURES)))
            worst = np.argsort(terms, axis=1, kind="stable")[:, :n_reasons]
            reasons = [[names[k] for k in w if t[k] < 0] for w, t in zip(worst, terms, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.chances(terms), pa.float64()), pa.array(reasons, pa.list_(pa.string()))], names=[id_col, "score", "reasons"])

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, common.output(docs, id_col, "score double, reasons array<string>"))
