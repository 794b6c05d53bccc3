"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of consecutive benchmark words. For the patterns of one length m, a shift
table tells for a block of words how far its nearest occurrence in any pattern lies from the
pattern's end: a block that is in none lets the search skip m - block + 1 words. A
shift of 0 leads to the bucket of patterns that end in the block, whose first words are
compared and then all of them. Shorter items have tables of their own, so that they
don't shorten the shifts of the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, common
from tidemark.session import scratch_path

#: Bytes of UTF-8 that are part of words; A-Z go to lower case, all else separates.
WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(WORD_BYTES).split()


class WuManber:
    """Search for word patterns of one length."""

    def __init__(self, patterns: dict[tuple, list[int]], length: int):
        self.length = length
        self.block = min(2, length)
        self.longest = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.longest), length - end)
            self.buckets.setdefault(pattern[-self.block:], {}).setdefault(pattern[:self.block], []).append((pattern, items))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(end, items) of each occurrence."""
        m, block, longest, shift, end = self.length, self.block, self.longest, self.shift, self.length
        n = len(words)
        while end <= n:
            key = tuple(words[end - block:end])
            s = shift.get(key, longest)
            if s:
                end += s
                continue
            candidates = self.buckets[key].get(tuple(words[end - m:end - m + block]))
            if candidates:
                found = tuple(words[end - m:end])
                for pattern, items in candidates:
                    if pattern == found:
                        yield end, items
            end += 1


def tables(items: list[tuple[object, str]], window: int) -> list[WuManber]:
    """items: (index, text). One table for each length of pattern."""
    by_length: dict[int, dict[tuple, list[int]]] = {}
    for index, text in items:
        words = words_of(text)
        m = min(window, len(words))
        if m:
            for s in range(len(words) - m + 1):
                found = by_length.setdefault(m, {}).setdefault(tuple(words[s:s + m]), [])
                if not found or found[-1] != index:
                    found.append(index)
    return [WuManber(patterns, m) for m, patterns in sorted(by_length.items())]


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """[start, end) stretches in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search(words: list[bytes], searchers: list[WuManber]) -> tuple[list[tuple[int, int]], set[int]]:
    """The hit stretches of words, and the items that occur."""
    stretches, items = [], set()
    for searcher in searchers:
        for end, found in searcher.occurrences(words):
            stretches.append((end - searcher.length, end))
            items.update(found)
    return merged(stretches), items


def _searchers(own: str, sent, window: int) -> list[WuManber]:
    """The tables of a block, built once by each worker, which holds those of one block."""
    held = batches.kept_by_worker(("op8",), dict)
    if own not in held:
        held.clear()
        held[own] = tables([(i, text) for i, (_, text) in enumerate(sent.value)], window)
    return held[own]


def find_windows(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = 13, block_chars: int = 2 << 20, steps: int = 4) -> DataFrame:
    """(id, n_words, hits, item_ids) of every row of ``docs``: hit stretches [start, end) of words, and the
    items (as sorted strings) of which a window occurs.

    Spark numbers the test strings into blocks of about ``block_chars`` of text and writes them to the shared folder. Each block is
    one search step over the rows, which carry what was found before: the driver and a task hold one block at a time (its tables
    take some 140 bytes a character, and a worker builds them once), and after ``steps`` of them the carried rows are written, so
    neither plans nor what is held grows with the test strings.
    No shuffle. Null and empty texts have no words, an item without words no window. Items with a null id
    hit words but are not listed. Repeated rows and null ids give a row each. Other columns are not read.
    """
    spark = docs.sparkSession
    found_ddl = "n_words long, hits array<struct<start:long,`end`:long>>, item_ids array<string>"
    stretch = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def step(block: list[tuple], last: bool):
        sent, own = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searchers = _searchers(own, sent, window)
            names = [name for name, _ in sent.value]
            for batch in rows_in:
                before = batch.select(["hits", "item_ids"]).to_pylist() if "hits" in batch.schema.names else None
                counts, hits, ids = [], [], []
                for i, text in enumerate(batches.texts(batch)):
                    words = words_of(text)
                    here, found = search(words, searchers)
                    listed = {names[k] for k in found if names[k] is not None}
                    if before:
                        here = merged(here + [(h["start"], h["end"]) for h in before[i]["hits"]])
                        listed.update(before[i]["item_ids"])
                    counts.append(len(words))
                    hits.append([{"start": a, "end": b} for a, b in here])
                    ids.append(sorted(listed))
                columns = {id_col: batch.column(0)} if last else {"id": batch.column(0), "text": batch.column(1)}
                columns |= {"n_words": pa.array(counts, pa.int64()), "hits": pa.array(hits, stretch), "item_ids": pa.array(ids, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_pydict(columns)
        return run

    strings = items.select(F.col(item_col).cast("string").alias("name"), F.col(item_text_col).cast("string").alias("text")).where("text is not null").distinct()
    chars = strings.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    if blocks > 1:
        numbered = strings.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
        path = scratch_path(spark, "llm", "blocks")
        numbered.repartition("block").write.partitionBy("block").parquet(path)
        strings = spark.read.schema(numbered.schema).parquet(path)
    rows = common.id_and_text(docs, id_col, text_col)
    for i in range(blocks):
        last, own = i == blocks - 1, strings if blocks == 1 else strings.where(F.col("block") == i)
        block = [tuple(r) for r in own.select("name", "text").collect()]
        rows = rows.mapInArrow(step(block, last), common.output(docs, id_col, ("" if last else "text string, ") + found_ddl, None if last else "id"))
        if not last and i % steps == steps - 1:
            rows = common.written(spark, rows, "carried")
    return rows
