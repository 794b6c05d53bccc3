"""Fill-in-middle transformation by secondary-sort assembly.

A text is cut into units (lines); its id decides which units are prefix, middle and suffix, and in which order
they are written. The parts leave the map side as pieces of whole units, keyed by document and output
position. One shuffle by document with a sort by (document, position) inside each partition, Spark's
repartition-and-sort, streams the pieces of a document in output order through an incremental digest, so
no task holds a document's output unless it is asked for. The same stream is read for the marks, which gives each
stretch its place in the original; the partitions are sorted once more, without a shuffle, and
the restored text runs through a digest of its own.

Rows are told apart by a digest of id and text. A task sends equal rows once, with how often
they came, so that repeated rows are neither lost nor a hot key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tidemark.llm import common

MARK = re.compile("<[PSM]>")
#: The beginning of a mark at the end of a chunk.
TORN = re.compile(r"<[PSM]?\Z")
#: The parts in the order in which they are written, by form.
WRITTEN = {"psm": "PSM", "spm": "SPM"}
#: The place of each part in the original text.
PLACE = {"<P>": 0, "<M>": 1, "<S>": 2}
#: Code points of a piece at most; a unit longer than that is cut.
CHUNK = 32_768
#: Documents whose repeats a task counts at a time.
REMEMBERED = 1 << 16
#: Rows and code points of an Arrow batch that a task gives out.
BATCH_ROWS, BATCH_CHARS = 2048, 4 << 20


def n_units(text: str) -> int:
    r"""Units of ``[^\n]*\n|[^\n]+``."""
    return text.count("\n") + (not text.endswith("\n")) if text else 0


def unit_end(text: str, units: int) -> int:
    """Where the first ``units`` units end."""
    at = 0
    for _ in range(units):
        at = text.find("\n", at) + 1 or len(text)
    return at


def choose(text: str, id_text: str, seed: int = 7, fim_percent: int = 100, spm_percent: int = 50) -> tuple[int, str, int | None, int | None]:
    """(units, form, end of the prefix, end of the middle); the ends are None if the form is plain."""
    n, digest = n_units(text), hashlib.sha256(f"{seed}:{id_text}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or MARK.search(text) or h3 % 100 >= fim_percent:
        return n, "plain", None, None
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, "spm" if h4 % 100 < spm_percent else "psm", unit_end(text, low), unit_end(text, high)


def pieces(text: str, form: str, prefix: int | None, middle: int | None, size: int = CHUNK) -> Iterator[str]:
    """The output in order, in pieces of whole units of up to ``size`` code points (one empty piece for an empty text)."""
    parts = [("", 0, len(text))]
    if form != "plain":
        bounds = {"P": (0, prefix), "M": (prefix, middle), "S": (middle, len(text))}
        parts = [(f"<{p}>", *bounds[p]) for p in WRITTEN[form] + "M" * ("M" not in WRITTEN[form])]
    for mark, at, end in parts:
        while True:
            stop = min(at + size, end)
            if stop < end:
                stop = text.rfind("\n", at, stop) + 1 or stop
            yield mark + text[at:stop]
            mark, at = "", stop
            if at >= end:
                break


class Restorer:
    """Stretches of the original, with their places, from the output in chunks and its form alone."""

    def __init__(self, form: str):
        self.place, self.marked, self.held = 0, form != "plain", ""

    def feed(self, chunk: str) -> Iterator[tuple[int, str]]:
        text, at = self.held + chunk, 0
        self.held = ""
        if self.marked:
            for m in MARK.finditer(text):
                if m.start() > at:
                    yield self.place, text[at:m.start()]
                self.place, at = PLACE[m.group()], m.end()
            torn = TORN.search(text, at)
            if torn:
                self.held = torn.group()
        if len(text) - len(self.held) > at:
            yield self.place, text[at:len(text) - len(self.held)]

    def end(self) -> Iterator[tuple[int, str]]:
        if self.held:
            yield self.place, self.held


def restore(output: str, form: str) -> str:
    """The original text of one output."""
    r = Restorer(form)
    found = [*r.feed(output), *r.end()]
    return "".join(s for _, s in sorted(found, key=lambda f: f[0]))


def _given_out(rows: Iterator[tuple], schema: pa.Schema, text_at: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches, bounded in rows and in the code points of the columns ``text_at``."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(row[i] or "") for i in text_at)
        if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


#: What the first piece of a document carries beside the id; None on its other pieces.
HEAD = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]


def _arrow(id_type: pa.DataType, *more) -> pa.Schema:
    return pa.schema([("key", pa.binary()), ("at", pa.int64()), ("chunk", pa.string()), ("copies", pa.int64()), ("id", id_type), *HEAD, *more])


def _spark(id_field: StructField, *more: StructField) -> StructType:
    head = [StructField(n, StringType() if t == pa.string() else LongType()) for n, t in HEAD]
    return StructType([StructField("key", BinaryType()), StructField("at", LongType()), StructField("chunk", StringType()), StructField("copies", LongType()),
                       StructField("id", id_field.dataType), *head, *more])


def _cut(seed: int, fim_percent: int, spm_percent: int):
    """Rows (id, id_text, id_digest, text) as pieces; a row that the task has met adds to a count instead."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (None,) * (len(HEAD) + 1)
        schema, met = None, {}

        def repeats():
            for key, n in met.items():
                if n:
                    yield (key, -1, None, n, *none)
            met.clear()

        def rows(batch):
            for own, id_text, id_digest, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                key = hashlib.md5(id_digest.encode() + hashlib.sha256(text.encode()).digest()).digest()
                if key in met:
                    met[key] += 1
                    continue
                if len(met) >= REMEMBERED:
                    yield from repeats()
                met[key] = 0
                n, form, prefix, middle = choose(text, id_text, seed, fim_percent, spm_percent)
                head = (1, own, n, form, prefix, None if prefix is None else middle - prefix)
                for at, chunk in enumerate(pieces(text, form, prefix, middle)):
                    yield (key, at, chunk, *(head if at == 0 else (0, *none)))

        for batch in rows_in:
            schema = _arrow(batch.schema.field(0).type)
            yield from _given_out(rows(batch), schema, (2,))
        if schema is not None:
            yield from _given_out(repeats(), schema, ())
    return run


def _assemble(with_text: bool):
    """Sorted pieces as stretches with their places in the original, and a row at -1 that closes each document."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            key, last, copies, head, digest, restorer, n, text = None, -1, 0, None, None, None, 0, []

            def closing():
                return (key, -1, None, copies, *head, digest.hexdigest(), "".join(text) if with_text else None)

            def stretches(found):
                nonlocal n
                for place, stretch in found:
                    yield (key, place << 48 | n, stretch, 0, *(None,) * (len(HEAD) + 3))
                    n += 1

            for batch in rows_in:
                for k, at, chunk, c, *h in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                    if k != key:
                        if key is not None:
                            yield from stretches(restorer.end())
                            yield closing()
                        key, last, copies, head, digest, restorer, n, text = k, -1, 0, None, hashlib.sha256(), None, 0, []
                    copies += c
                    if at <= last:  # a count of repeats, or a piece that another task sent as well
                        continue
                    last = at
                    if at == 0:
                        head, restorer = h, Restorer(h[2])
                    digest.update(chunk.encode())
                    if with_text:
                        text.append(chunk)
                    yield from stretches(restorer.feed(chunk))
            if key is not None:
                yield from stretches(restorer.end())
                yield closing()

        first = next(rows_in, None)
        if first is not None:
            schema = _arrow(first.schema.field("id").type, ("output_sha256", pa.string()), ("output", pa.string()))
            rows_in = _chained(first, rows_in)
            yield from _given_out(rows(), schema, (2, len(schema) - 1))
    return run


def _chained(first, rest):
    yield first
    yield from rest


def _restored(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each copy of each document, from its closing row and its stretches in their places."""
    def rows():
        closing, digest = None, None
        for batch in rows_in:
            for key, at, chunk, copies, *head in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if at == -1:
                    if closing is not None:
                        yield from done(closing, digest)
                    closing, digest = (copies, head), hashlib.sha256()
                else:
                    digest.update(chunk.encode())
        if closing is not None:
            yield from done(closing, digest)

    def done(closing, digest):
        copies, head = closing
        for _ in range(copies):
            yield (*head, digest.hexdigest())

    first = next(rows_in, None)
    if first is not None:
        schema = pa.schema([*list(first.schema)[4:], ("restored_sha256", pa.string())])
        rows_in = _chained(first, rows_in)
        yield from _given_out(rows(), schema, (len(schema) - 2,))


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, fim_percent: int = 100, spm_percent: int = 50, with_text: bool = True) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output, output_sha256, restored_sha256) of every row.

    ``output`` is null unless ``with_text``; ``restored_sha256`` is that of the text rebuilt from output and
    form. A null text is empty, an empty text and one that holds a mark are plain, a null id counts as an empty one. Rows
    that repeat come out as often as they came in; other columns are not read; an empty table gives no rows.
    """
    rows = common.id_and_text(docs, id_col, text_col)
    rows = rows.select("id", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id_text"), F.md5(F.to_json(F.struct("id"))).alias("id_digest"), "text")
    own = rows.schema["id"]
    cut = rows.mapInArrow(_cut(seed, fim_percent, spm_percent), _spark(own))
    sent = cut.repartition(F.col("key")).sortWithinPartitions("key", "at")
    more = [StructField("output_sha256", StringType()), StructField("output", StringType())]
    written = sent.mapInArrow(_assemble(with_text), _spark(own, *more)).sortWithinPartitions("key", "at")
    out = StructType([*_spark(own, *more).fields[4:], StructField("restored_sha256", StringType())])
    return written.mapInArrow(_restored, out).select(F.col("id").alias(id_col), *[n for n, _ in HEAD], "output", "output_sha256", "restored_sha256")
