"""Packing by minimum bin slack: a bitset subset-sum picks what fills each window.

Documents of a window or more give whole windows; their remainders and the shorter
documents wait in a pool of pieces by length. For each window the longest piece is set
and a subset-sum over the multiset of lengths (one big integer's bits; counts split into
powers of two) finds the fill closest to capacity; going back through the steps gives how
many pieces of each length it takes. The same choice is used as often as the counts
allow. What the best choice leaves open is filled by the head of one more piece, whose
rest goes back to the pool. Each task packs its own rows in bounded memory: there is no
shuffle. Its last tokens, fewer than a window, go into sequences of powers of two.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm import batches, common
from tidemark.llm.tokens import piece_encoder


def best_fill(lengths: list[int], counts: dict[int, int], target: int) -> dict[int, int]:
    """How many of each length come closest to ``target`` from below. lengths: distinct, tried in this order."""
    bits, mask, steps = 1, (1 << (target + 1)) - 1, []
    for length in lengths:
        left, k = min(counts[length], target // length), 1
        while left > 0:
            m = min(k, left)
            steps.append((bits, length, m))
            bits |= (bits << (length * m)) & mask
            left, k = left - m, k * 2
        if bits >> target & 1:
            break
    total, take = bits.bit_length() - 1, {}
    for before, length, m in reversed(steps):
        if not before >> total & 1:
            take[length] = take.get(length, 0) + m
            total -= length * m
    return take


class Pool:
    """Pieces waiting for a window: (key, ids, start, tokens of the document), by length."""

    def __init__(self, capacity: int):
        self.capacity, self.by_length, self.tokens = capacity, {}, 0

    def add(self, piece: tuple) -> None:
        n = len(piece[1]) // 4
        if n:
            self.by_length.setdefault(n, deque()).append(piece)
            self.tokens += n

    def take(self, length: int) -> tuple:
        waiting = self.by_length[length]
        piece = waiting.popleft()
        if not waiting:
            del self.by_length[length]
        self.tokens -= length
        return piece

    def windows(self, until: int) -> Iterator[list[tuple]]:
        """Full windows, while more than ``until`` tokens wait and a window can be filled."""
        while self.tokens >= max(until, self.capacity):
            counts = {n: len(d) for n, d in self.by_length.items()}
            lengths = sorted(counts, reverse=True)
            while self.tokens >= max(until, self.capacity):
                lengths = [n for n in lengths if counts.get(n)]
                if not lengths:
                    break
                seed = lengths[0]
                counts[seed] -= 1
                take = best_fill(lengths, counts, self.capacity - seed)
                counts[seed] += 1
                take[seed] = take.get(seed, 0) + 1
                slack = self.capacity - sum(n * k for n, k in take.items())
                times = 1 if slack else min(counts[n] // k for n, k in take.items())
                times = max(1, min(times, (self.tokens - until) // self.capacity))
                for _ in range(times):
                    window = [self.take(n) for n, k in take.items() for _ in range(k)]
                    if slack:
                        key, ids, start, total = self.take(max(self.by_length))  # longer than the slack, or it would have been taken
                        window.append((key, ids[:4 * slack], start, total))
                        self.add((key, ids[4 * slack:], start + slack, total))
                    yield window
                if slack:
                    break
                for n, k in take.items():
                    counts[n] -= k * times

    def tail(self) -> Iterator[list[tuple]]:
        """All that waits (less than a window) in sequences of powers of two, the largest first."""
        pieces = [self.take(n) for n in sorted(self.by_length, reverse=True) for _ in range(len(self.by_length[n]))]
        left = sum(len(p[1]) // 4 for p in pieces)
        while left:
            room = size = 1 << (left.bit_length() - 1)
            left -= size
            window = []
            while room:
                key, ids, start, total = pieces.pop(0)
                n = min(room, len(ids) // 4)
                window.append((key, ids[:4 * n], start, total))
                if 4 * n < len(ids):
                    pieces.insert(0, (key, ids[4 * n:], start + n, total))
                room -= n
            yield window


def sequences(documents: Iterator[tuple], capacity: int, pool_tokens: int) -> Iterator[list[tuple]]:
    """documents: (key, ids). Yields the pieces of each sequence: (key, ids, start, tokens of the document)."""
    pool = Pool(capacity)
    for key, ids in documents:
        total = len(ids) // 4
        whole = total - total % capacity
        for start in range(0, whole, capacity):
            yield [(key, ids[4 * start:4 * (start + capacity)], start, total)]
        pool.add((key, ids[4 * whole:], whole, total))
        if pool.tokens >= pool_tokens:
            yield from pool.windows(pool_tokens // 2)
    yield from pool.windows(capacity)
    yield from pool.tail()


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 4096, end_id: int = 2, pool_tokens: int = 1 << 21, with_ids: bool = True) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), a row per piece.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers. ``sequence_id`` is
    the task's partition number times 2**33 plus a count, so it is unique and the same when
    a task is run again on the same input. A null or empty text is a document of the end
    id alone; repeated rows and null ids are documents of their own; an empty table gives
    no rows. A task holds at most ``pool_tokens`` ids, a batch of texts and the remembered pieces.
    """
    end = end_id.to_bytes(4, "little")

    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, schema = piece_encoder(tokenizer_path), None
        base = TaskContext.get().partitionId() << 33

        def documents():
            nonlocal schema
            for batch in rows_in:
                if schema is None:
                    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                    schema = pa.schema([(id_col, batch.schema.field(0).type), *((n, pa.int64()) for n in longs), *[("ids", pa.binary())] * with_ids])
                keys = batch.column(0).to_pylist()
                for key, ids in zip(keys, encoder.ids(batches.texts(batch)), strict=True):
                    yield key, ids + end

        def rows():
            for i, pieces in enumerate(sequences(documents(), capacity, pool_tokens)):
                offset = 0
                for key, ids, start, total in pieces:
                    n = len(ids) // 4
                    yield (key, start, n, zlib.crc32(ids), total, base + i, offset, *[ids] * with_ids)
                    offset += n

        ready = rows()
        first = next(ready, None)
        if first is not None:
            def again():
                yield first
                yield from ready
            yield from batches.record_batches(again(), schema)

    return common.id_and_text(docs, id_col, text_col).mapInArrow(
        run, common.output(docs, id_col, "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids))
