"""Exact top-k search by term-at-a-time accumulation over blocks of postings.

Candidates are cut into blocks; a block keeps, for each term (vector position), a posting list
of (row in the block, weight). A query row is its non-zero (term, weight) pairs. For each
of its terms the weighted postings are scattered into a dense array of the block's
scores, so every candidate is scored; a partition selection keeps the block's best k, and
the cells' bests are merged by a ranking in Spark. Where most rows have most terms, a block's posting lists are full
columns of a matrix, and the terms of many queries are accumulated together, as a product of matrices.

Query blocks meet candidate blocks in the cells of a grid: candidate blocks are dealt over its columns and
go to all rows, query blocks are dealt over the rows and go to all columns, in such proportions that the fewest bytes are
copied. A cell is one task, which reads its queries first and holds them with their best so far; the candidate blocks
stream past them, so that no pair of blocks is ever a row. The grid has as many rows as a cell's queries need to fit a worker.
No side is broadcast or passes through the driver.

Weights are whole numbers, sent in as few bytes as hold a block's largest and kept as floats that hold them exactly. A query block whose scores in
a candidate block can't leave the whole numbers of a float (by the sum of its own weights and the block's largest) is multiplied in 32 or 64 bits; a query of
another is scored in 64-bit integers, or in Python's. A score that is among the best but has no place in a 64-bit column is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import batches

#: Bytes that a cell's queries may take in a worker, and what a component of a query takes there.
HELD_BYTES, COMPONENT_BYTES = 128 << 20, 16
#: Components of a block, and scores that are held at a time.
BLOCK_COMPONENTS, TILE = 1 << 20, 1 << 19
#: Rows of a block, unless the table has too few for all cells.
LEAST_ROWS = 16

BLOCK = pa.schema([("ids", pa.binary()), ("width", pa.int64()), ("ends", pa.binary()), ("terms", pa.binary()), ("weights", pa.binary()), ("kind", pa.string())])
BLOCK_DDL = "ids binary, width long, ends binary, terms binary, weights binary, kind string"


def floored(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, lengths, components row by row) of the usable rows: floor(scale * x)."""
    batch = batch.filter(pc.and_(pc.is_valid(batch.column(0)), pc.is_valid(batch.column(1))))
    ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    x = pc.fill_null(vectors.flatten().cast(pa.float64(), safe=False), np.nan).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(ids)), lengths)
    usable = np.ones(len(ids), bool)
    usable[row[~np.isfinite(x)]] = False
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(scale * x)
    if len(lost := row[usable[row] & ~np.isfinite(x)]):
        raise OverflowError(f"row {ids[lost[0]]}: a component times {scale} is no number any more")
    return ids[usable].astype(np.int64), lengths[usable], x[usable[row]]


def block_row(ids: np.ndarray, lengths: np.ndarray, x: np.ndarray) -> tuple:
    """A block as it is sent: a matrix if at least half of its cells are filled (width: its columns), else compressed sparse rows (width -1)."""
    at = np.flatnonzero(x)
    row = np.repeat(np.arange(len(ids)), lengths)[at]
    terms, weights = at - (np.cumsum(lengths) - lengths)[row], x[at]
    largest, width = np.abs(weights).max(initial=0), int(terms.max(initial=-1)) + 1
    kind = next((f"<i{n}" for n in (1, 2, 4) if largest < 2 ** (8 * n - 1)), "<f8")
    if len(ids) * width <= 2 * len(at):
        cells = np.zeros((len(ids), width), kind)
        cells[row, terms] = weights
        return ids.tobytes(), width, b"", b"", cells.tobytes(), kind
    ends = np.cumsum(np.bincount(row, minlength=len(ids)))
    return ids.tobytes(), -1, ends.astype(np.int64).tobytes(), terms.astype(np.int64).tobytes(), weights.astype(kind).tobytes(), kind


def in_blocks(size: int, scale: float):
    """mapInArrow function: rows of a task as blocks of at most ``size`` rows, fewer of long vectors."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = components = 0

        def block() -> pa.RecordBatch:
            row = block_row(*map(np.concatenate, zip(*held, strict=True)))
            held.clear()
            return next(batches.record_batches(iter([row]), BLOCK))

        for batch in rows_in:
            ids, lengths, x = floored(batch, scale)
            ends = np.cumsum(lengths)
            at = 0
            while at < len(ids):
                before = int(ends[at - 1]) if at else 0
                n = min(size - rows, int(np.searchsorted(ends[at:], before + BLOCK_COMPONENTS - components, "right")))
                if n <= 0 and rows:
                    yield block()
                    rows = components = 0
                    continue
                to = min(at + max(n, 1), len(ids))
                held.append((ids[at:to], lengths[at:to], x[before:int(ends[to - 1])]))
                rows, components, at = rows + to - at, components + int(ends[to - 1]) - before, to
        if held:
            yield block()
    return run


def postings(ids: np.ndarray, ends: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> dict[int, tuple]:
    """term: (rows in the block, or None for all of them in order; weights)."""
    rows = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
    order = np.argsort(terms, kind="stable")
    terms, rows, weights = terms[order], rows[order], weights[order]
    firsts = np.flatnonzero(np.diff(terms, prepend=-1)) if len(terms) else np.empty(0, np.int64)
    return {int(terms[a]): (None if b - a == len(ids) else rows[a:b], weights[a:b]) for a, b in zip(firsts, [*firsts[1:], len(terms)], strict=True)}


def best_of_block(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k highest (score, id) but the query's own, ties to the smaller id."""
    other = np.flatnonzero(ids != own)
    if scores.dtype == object:
        return sorted(((scores[j], int(ids[j])) for j in other), key=lambda x: (-x[0], x[1]))[:k]
    if len(other) > k:
        s = scores[other]
        least = s[np.argpartition(-s, k - 1)[:k]].min()
        other = other[s >= least]
    order = np.lexsort((ids[other], -scores[other]))[:k]
    return [(int(scores[j]), int(ids[j])) for j in other[order]]


class Block:
    """Rows of a block: a matrix, if it was sent as one, and compressed sparse rows and postings where those are asked for."""

    def __init__(self, row: dict):
        self.ids, self.width = np.frombuffer(row["ids"], np.int64), row["width"]
        weights = np.frombuffer(row["weights"], row["kind"])
        self.largest = int(np.abs(weights.astype(np.float64)).max(initial=0))
        self.cells = weights.reshape(len(self.ids), self.width) if self.width >= 0 else None
        self.sent = None if self.width >= 0 else (np.frombuffer(row["ends"], np.int64), np.frombuffer(row["terms"], np.int64), weights.astype(np.float64))
        self.kept: dict[object, object] = {}

    def of(self, key: object, make):
        if key not in self.kept:
            self.kept[key] = make()
        return self.kept[key]

    def matrix(self, kind: type) -> np.ndarray:
        return self.of(("matrix", kind), lambda: self.cells.astype(kind))

    def sparse(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ends, terms, weights)"""
        def made():
            row, terms = np.nonzero(self.cells)
            return np.cumsum(np.bincount(row, minlength=len(self.ids))), terms, self.cells[row, terms].astype(np.float64)
        return self.sent or self.of("sparse", made)

    def typed(self, kind: type) -> dict[int, tuple]:
        """The postings, as 64-bit integers or as Python's."""
        whole = (lambda w: w.astype(np.int64)) if kind is np.int64 else (lambda w: np.array([int(x) for x in w], object))
        return self.of(("postings", kind), lambda: {t: (rows, whole(w)) for t, (rows, w) in postings(self.ids, *self.sparse()).items()})

    def scores(self, terms: list[int], weights: list[int]) -> np.ndarray:
        """The block's scores for a query, term at a time."""
        kind = np.int64 if sum(map(abs, weights)) * self.largest < 2**63 and self.largest < 2**63 else object
        out, by_term = np.zeros(len(self.ids), kind), self.typed(kind)
        for term, weight in zip(terms, weights, strict=True):
            at, w = by_term.get(term, (None, None))
            if w is None:
                continue
            if at is None:
                out += weight * w
            else:
                out[at] += weight * w
        return out


class Asked:
    """A query block and its best so far."""

    def __init__(self, block: Block, k: int):
        self.block, self.k, n = block, k, len(block.ids)
        ends, terms, weights = block.sparse()
        self.most = float(np.bincount(np.repeat(np.arange(n), np.diff(ends, prepend=0)), np.abs(weights), n).max(initial=0))
        block.kept.pop("sparse", None)
        self.found, self.scores, self.vecs = np.zeros(n, np.int64), np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.least = np.full(n, -np.inf)  # no more than a full row's worst

    def meet(self, other: Block, own: tuple[np.ndarray, np.ndarray]) -> None:
        """Scores the candidates of a block. own: the query rows and candidates of the same id."""
        bound = max(self.most, 1) * max(other.largest, 1)
        if self.block.cells is None or other.cells is None or bound >= 2**53:
            ends, terms, weights = self.block.sparse()
            for row, (a, b, query) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), self.block.ids.tolist(), strict=True)):
                best = best_of_block(other.scores(terms[a:b].tolist(), [int(w) for w in weights[a:b]]), other.ids, query, self.k)
                if best:
                    fits = all(-(2**63) < score < 2**63 for score, _ in best)
                    self.merge(np.full(len(best), row), np.array([score for score, _ in best], np.int64 if fits else object), np.array([vec for _, vec in best], np.int64))
            return
        kind, n = np.float32 if bound < 2**24 else np.float64, len(other.ids)
        both, step = min(self.block.width, other.width), max(1, TILE // n)
        q, c = self.block.matrix(kind)[:, :both], other.matrix(kind)[:, :both].T
        room = other.of(("room", kind), lambda: np.empty((step, n), kind))
        for a in range(0, len(q), step):
            scores = np.matmul(q[a:a + step], c, out=room[:len(q) - a])
            mine = (own[0] >= a) & (own[0] < a + step)
            scores[own[0][mine] - a, own[1][mine]] = -np.inf
            least = np.nextafter(self.least[a:a + step].astype(kind), kind(-np.inf))
            rows = np.flatnonzero(scores.max(axis=1) >= least)
            some, least = scores[rows], least[rows]
            if n > self.k and len(fresh := np.flatnonzero(self.found[a + rows] < self.k)):
                least[fresh] = np.partition(some[fresh], n - self.k, axis=1)[:, n - self.k]
            at, j = np.divmod(np.flatnonzero(some >= least[:, None]), n)
            score, at, vecs = some[at, j], rows[at] + a, other.ids[j]
            real = score > -np.inf
            if self.scores.dtype != object:  # a tie counts with a smaller id only
                real &= (self.found[at] < self.k) | (score > self.scores[at, -1]) | (vecs < self.vecs[at, -1])
            if real.any():
                self.merge(at[real], score[real].astype(np.int64), vecs[real])

    def merge(self, at: np.ndarray, scores: np.ndarray, vecs: np.ndarray) -> None:
        """Takes in (query row, score, candidate): the k highest stay, ties to the smaller id."""
        if scores.dtype == object:
            self.scores = self.scores.astype(object)
        rows = np.unique(at)
        old = np.arange(self.k) < self.found[rows][:, None]
        at, scores, vecs = np.concatenate([at, np.repeat(rows, self.found[rows])]), np.concatenate([scores, self.scores[rows][old]]), np.concatenate([vecs, self.vecs[rows][old]])
        order = np.array(sorted(range(len(at)), key=lambda i: (at[i], -scores[i], vecs[i]))) if scores.dtype == object else np.lexsort((vecs, -scores, at))
        at, scores, vecs = at[order], scores[order], vecs[order]
        _, firsts, counts = np.unique(at, return_index=True, return_counts=True)
        place = np.arange(len(at)) - np.repeat(firsts, counts)
        best = place < self.k
        self.scores[at[best], place[best]], self.vecs[at[best], place[best]] = scores[best], vecs[best]
        self.found[rows] = np.minimum(counts, self.k)
        full = rows[self.found[rows] == self.k]
        worst = self.scores[full, -1]
        self.least[full] = np.nextafter((np.array([min(max(w, -(2**62)), 2**62) for w in worst], np.int64) if worst.dtype == object else worst).astype(np.float64), -np.inf)

    def best(self) -> pa.RecordBatch:
        full = np.arange(self.k) < self.found[:, None]
        scores, over = self.scores[full], np.zeros(int(full.sum()), bool)
        if scores.dtype == object:
            near = np.array([min(max(s, -(2**63)), 2**63 - 1) for s in scores], np.int64)
            over, scores = np.array([n != s for n, s in zip(near.tolist(), scores, strict=True)], bool), near
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(self.block.ids, self.found), self.vecs[full], scores, over)], schema=BEST)


BEST = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("over", pa.bool_())])


def score_blocks(k: int):
    """mapInArrow function over a cell's blocks, the queries' first: the best of each query among the cell's candidates. Scores that
    don't fit 64 bits are marked, with the nearest that does."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[Asked] = []
        places = None

        def placed() -> tuple[np.ndarray, ...]:
            """(ids in order, their blocks, their rows there)"""
            ids = np.concatenate([x.block.ids for x in asked])
            of, order = np.array([len(x.block.ids) for x in asked]), np.argsort(ids)
            return ids[order], np.repeat(np.arange(len(of)), of)[order], (np.arange(len(ids)) - np.repeat(np.cumsum(of) - of, of))[order]

        for batch in rows_in:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                block = Block(row)
                if not row["candidates"]:
                    asked.append(Asked(block, k))
                    continue
                if not asked:
                    continue
                ids, of, rows = places = places or placed()
                at = np.minimum(np.searchsorted(ids, block.ids), len(ids) - 1)
                same = np.flatnonzero(ids[at] == block.ids)
                same = same[np.argsort(of[at[same]], kind="stable")]
                cuts = np.searchsorted(of[at[same]], np.arange(len(asked) + 1))
                for i, queries in enumerate(asked):
                    j = same[cuts[i]:cuts[i + 1]]
                    queries.meet(block, (rows[at[j]], j))
        for queries in asked:
            yield queries.best()
    return run


def grid(slots: int, n_queries: int, n_candidates: int, held: int = 0) -> tuple[int, int]:
    """(rows, columns) of about ``slots`` cells for which the copies, candidates times rows plus queries (and their best, which take
    about as much) times columns, are fewest. There are at least ``held`` rows, if need be in more cells."""
    rows = max(held, min(slots, max(1, round((2 * slots * n_queries / max(1, n_candidates)) ** 0.5))))
    return rows, max(1, slots // rows)


def top_k(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
          scale: float = 256.0, query_block: int = 256, block_rows: int = 4096, slots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products.

    Components become floor(scale * x). Rows whose id or vector is null, or that hold a null
    or non-finite component, take no part. Scores are exact whatever the components' size; if one of the
    best needs more than 64 bits, or a component more than a double, the query fails. Vectors of
    different lengths are multiplied over the positions both have; an empty vector scores 0. A
    candidate with the query's id is the query's own row. Rows that repeat an id are
    candidates each; a query id that repeats asks once, by the smallest of its vectors that can take part. Ties go to
    the smaller id. Other columns are not read; empty tables give no rows.
    """
    spark = vectors.sparkSession
    slots = slots or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    real = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    candidates = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    asked = (queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", real))
             .groupBy("id").agg(F.min("v").alias("v")))
    n_candidates = candidates.count()
    n_queries, components = queries.select(F.count("*"), F.coalesce(F.sum(F.greatest(F.size(vector_col), F.lit(1))), F.lit(0))).first()
    rows, columns = grid(slots, n_queries, n_candidates, -(-components * COMPONENT_BYTES // HELD_BYTES))
    sized = lambda most, n, over: min(most, max(LEAST_ROWS, -(-n // (4 * over))))  # noqa: E731  a few blocks for each column or row at least
    c = candidates.mapInArrow(in_blocks(sized(block_rows, n_candidates, columns), scale), BLOCK_DDL)
    q = asked.mapInArrow(in_blocks(sized(query_block, n_queries, rows), scale), BLOCK_DDL)

    def dealt(block: DataFrame, candidates: bool, over: int, copies: int, cell) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        block = block.select("*", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(over)).cast("int").alias("own"))
        block = block.select("*", every.alias("other"))
        return block.select(cell(F.col("own"), F.col("other")).alias("cell"), F.lit(candidates).alias("candidates"), *BLOCK.names)

    c = dealt(c, True, columns, rows, lambda column, row: row * columns + column)
    q = dealt(q, False, rows, columns, lambda row, column: row * columns + column)
    cells = q.unionByName(c).repartitionById(rows * columns, "cell").sortWithinPartitions("candidates").drop("cell")
    found = cells.mapInArrow(score_blocks(k), "query_id long, vec_id long, score long, over boolean")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    loud = F.when(F.col("over"), F.raise_error(F.lit("a score among the best needs more than 64 bits")).cast("long")).otherwise(F.col("score"))
    return found.select("query_id", "rank", "vec_id", loud.alias("score"))
