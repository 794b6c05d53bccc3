"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: mail and IP addresses, card and phone numbers. Over the
corpus, the pointwise mutual information of a word t and an entity e that are in one document, relative to e's own
information content,

    log(p(t, e) / (p(t) p(e))) / -log p(e),

says how much of e the word gives away: 1 if t only occurs with e. Few texts prove little, so there are two bounds on the evidence,
both counted in different texts, for copies of a text prove nothing more than it does. Of the n(t) texts with the word and one more without the entity, e must be
in a share of ``least_share``: at 0.5 a word that only one text has is enough (one of two), at 0.6 it takes two of two, or three of four. And if words fell
on texts at random, so many of n(t) texts would have e with a chance of ``most_chance`` at most (by Chernoff's bound; the share of
texts with e where the word is in one text): in a small corpus nothing is disclosed by a single text, in a large one an otherwise
unseen word next to an address is. In a document that holds e, words whose disclosure reaches a threshold are
generalised, and beyond a higher one removed.

Which words and entities come together depends only on the texts that each is in. So both are put into classes by
a digest of those texts, with how many they are, and classes meet in the texts they share: a list of a thousand addresses that
always come together is one class, and only words rare enough to pass meet any.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, common

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does; saying so keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
WORD = re.compile(r"\w+")

#: Bits of the filter of words that are counted over the corpus: its size is fixed, and what
#: it lets through in excess is joined away.
FILTER_BITS = 24

#: Words that a task counts at a time.
HELD_WORDS = 500_000

SPANS_DDL = "array<struct<kind:string,start:long,`end`:long>>"
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the protected entities, by kind as listed, then by start."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return found
    if "." in text:
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                  if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m.group())) <= 15]
    return found


def _as_rows(spans: list[tuple[str, int, int]]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def _scan(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_in:
        spans = [_as_rows(base_spans(t)) for t in batches.texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("rest"), batch.column("text"), pa.array(spans, SPANS)], names=["rest", "text", "base"])


def _outside(text: str, covered: list[tuple[int, int]]) -> list[re.Match]:
    """The words of a text that touch none of the stretches."""
    hidden = np.zeros(len(text) + 1, np.int32)
    for a, b in covered:
        hidden[a] += 1
        hidden[b] -= 1
    inside = np.concatenate(([0], np.cumsum(np.cumsum(hidden[:-1]) > 0)))
    return [m for m in WORD.finditer(text) if inside[m.end()] == inside[m.start()]]


def _entities(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, copies, entity): the entities of each text, each once, as digests."""
    def rows():
        for batch in rows_in:
            for doc, copies, text, base in zip(*[batch.column(c).to_pylist() for c in ("doc", "copies", "text", "base")], strict=True):
                for value in {f"{s['kind']}:{text[s['start']:s['end']].lower()}" for s in base}:
                    yield doc, copies, xxhash.xxh3_64_intdigest(value) - (1 << 63)

    yield from batches.record_batches(rows(), pa.schema([("doc", pa.binary()), ("copies", pa.int64()), ("entity", pa.int64())]))


def _terms(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, copies, term): the words of each whole text outside of its entities, each once."""
    def rows():
        for batch in rows_in:
            for doc, copies, text, base in zip(*[batch.column(c).to_pylist() for c in ("doc", "copies", "text", "base")], strict=True):
                for term in {m.group().lower() for m in _outside(text, [(s["start"], s["end"]) for s in base])}:
                    yield doc, copies, term

    yield from batches.record_batches(rows(), pa.schema([("doc", pa.binary()), ("copies", pa.int64()), ("term", pa.string())]))


def _is_set(bits: bytes, at: int) -> int:
    return bits[at >> 3] >> (at & 7) & 1


def _term_counts(bits: bytes):
    """(term, n): in how many rows of a task each word is, of those that the filter lets through."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, seen, schema = (1 << FILTER_BITS) - 1, Counter(), pa.schema([("term", pa.string()), ("n", pa.int64())])
        for batch in rows_in:
            for text in batches.texts(batch):
                seen.update(w for w in {w.lower() for w in set(WORD.findall(text))} if _is_set(bits, zlib.crc32(w.encode()) & mask))
            if len(seen) > HELD_WORDS:
                yield from batches.record_batches(iter(seen.items()), schema)
                seen.clear()
        yield from batches.record_batches(iter(seen.items()), schema)
    return run


def _seen_terms(bits: bytes):
    """(term, doc): the words of each text that the filter lets through, each once."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = (1 << FILTER_BITS) - 1

        def rows():
            for batch in rows_in:
                for text in batches.texts(batch):
                    found = [w for w in {w.lower() for w in set(WORD.findall(text))} if _is_set(bits, zlib.crc32(w.encode()) & mask)]
                    if found:
                        doc = xxhash.xxh3_128_digest(text.encode())
                        for term in found:
                            yield term, doc

        yield from batches.record_batches(rows(), pa.schema([("term", pa.string()), ("doc", pa.binary())]))
    return run


def _bitmap(terms: DataFrame) -> bytes:
    """The filter's bits for the column ``term``, put together from pieces of 4 KB that Spark makes: its size is fixed."""
    slot = terms.select((F.crc32(F.col("term").cast("binary")) % (1 << FILTER_BITS) + 1).alias("slot"))
    pieces = slot.groupBy(F.expr("bitmap_bucket_number(slot)").alias("piece")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
    out = bytearray(1 << (FILTER_BITS - 3))
    for row in pieces.toLocalIterator():
        size = len(row["bits"])
        out[(row["piece"] - 1) * size:row["piece"] * size] = row["bits"]
    return bytes(out)


def _classes(pairs: DataFrame, member: str) -> DataFrame:
    """(member, sig, n, rows): the class of each member of (doc, copies, member), by the texts it is in, how many they are and how many rows have them."""
    texts = F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("sig")
    return pairs.groupBy(member).agg(texts, F.count("*").alias("n"), F.sum("copies").alias("rows"))


def _text_key() -> Column:
    return F.unhex(F.md5("text")).alias("doc")


def _chance(hits: Column, of: Column, p: Column) -> Column:
    """An upper bound of the chance that so many of ``of`` or more are hits, each with chance ``p`` (Chernoff's)."""
    q = hits / of
    part = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    return F.when((q > p) & (p < 1), F.exp(-of * (part(q, p) + part(1 - q, 1 - p)))).otherwise(1.0)


def _disclosing(rows: DataFrame, hits: DataFrame, least_share: float, threshold: float, most_chance: float) -> DataFrame:
    """(doc, term, disclosure): the words to hide in each text of ``hits``; ``doc`` is the text's digest."""
    spark = rows.sparkSession
    once = hits.select(_text_key(), "text", "base").groupBy("doc").agg(F.count("*").alias("copies"), F.any_value(F.struct("text", "base")).alias("t"))
    once = common.written(spark, once.select("doc", "copies", "t.*"), "texts")
    of_entities = common.written(spark, once.mapInArrow(_entities, "doc binary, copies long, entity long"), "of_entities")
    of_terms = common.written(spark, once.mapInArrow(_terms, "doc binary, copies long, term string"), "of_terms")
    # t_both >= least_share * (t_term + 1), and t_term >= t_both: fewer texts than these can't be enough
    least = max(1, math.ceil(least_share / (1 - least_share) - 1e-9))
    entities = common.written(spark, _classes(of_entities, "entity").where(F.col("n") >= least), "entities")
    most = entities.agg(F.max("n")).first()[0] or 0
    terms = common.written(spark, _classes(of_terms, "term").where((F.col("n") >= least) & (least_share * (F.col("n") + 1) <= most)), "terms")
    e = of_entities.join(entities, "entity").select("doc", "copies", F.col("sig").alias("e_sig"), F.col("n").alias("t_entity"), F.col("rows").alias("n_entity")).distinct()
    t = of_terms.join(terms, "term").select("doc", F.col("sig").alias("t_sig"), F.col("n").alias("t_near")).distinct()
    e = common.written(spark, e, "entity_classes")
    both = e.join(t, "doc").where(least_share * (F.col("t_near") + 1) <= F.col("t_entity"))
    both = both.groupBy("e_sig", "t_entity", "n_entity", "t_sig", "t_near").agg(F.count("*").alias("t_both"), F.sum("copies").alias("n_both"))
    both = common.written(spark, both.where(F.col("t_both") >= least_share * (F.col("t_near") + 1)), "pairs")
    wanted = terms.join(both.select(F.col("t_sig").alias("sig"), F.col("t_near").alias("n")).distinct(), ["sig", "n"])
    wanted = common.written(spark, wanted.select("term", F.col("sig").alias("t_sig"), F.col("n").alias("t_near"), F.col("rows").alias("n_near")), "wanted")
    if wanted.isEmpty():
        return e.where(F.lit(False)).select("doc", F.lit("").alias("term"), F.lit(0.0).alias("disclosure"))
    counts = rows.select("text").mapInArrow(_term_counts(_bitmap(wanted)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    pairs = common.written(spark, wanted.join(counts, "term").join(both, ["t_sig", "t_near"]), "counted")
    # a word that no other row has is in no other text; of the others only those are counted by texts for which one more text would not be too many
    here = pairs.where("n_term = n_near").withColumn("t_term", F.col("t_near"))
    there = pairs.where((F.col("n_term") > F.col("n_near")) & (F.col("t_both") >= least_share * (F.col("t_near") + 2)))
    if not there.isEmpty():
        found = rows.select("text").mapInArrow(_seen_terms(_bitmap(there)), "term string, doc binary").distinct().groupBy("term").agg(F.count("*").alias("t_term"))
        here = here.unionByName(there.join(found, "term"))
    total, texts = rows.count(), rows.select(_text_key()).distinct().count()
    own = F.log(F.lit(total) / F.col("n_entity"))
    shared = F.log(F.col("n_both") * F.lit(total) / (F.col("n_term") * F.col("n_entity")))
    strong = (here.where((F.col("t_both") >= least_share * (F.col("t_term") + 1)) & (own > 0))
              .where(_chance(F.col("t_both"), F.col("t_term"), F.col("t_entity") / F.lit(texts)) <= most_chance)
              .withColumn("disclosure", shared / own).where(F.col("disclosure") >= threshold).select("e_sig", "n_entity", "term", "disclosure"))
    return e.join(strong, ["e_sig", "n_entity"]).groupBy("doc", "term").agg(F.max("disclosure").alias("disclosure"))


def _finish(remove_at: float):
    """Base and term spans of rows with entities, and the sanitised text."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in:
            all_spans, cleaned = [], []
            for text, base, terms in zip(batches.texts(batch), batch.column("base").to_pylist(), batch.column("terms").to_pylist(), strict=True):
                spans = [(s["kind"], s["start"], s["end"]) for s in base]
                known = {t["term"]: t["disclosure"] for t in terms or ()}
                marks = [(a, b, f"[{k.upper()}]") for k, a, b in spans]
                if known:
                    for m in _outside(text, [(a, b) for _, a, b in spans]):
                        strength = known.get(m.group().lower())
                        if strength is not None:
                            spans.append((TERM, m.start(), m.end()))
                            marks.append((m.start(), m.end(), "" if strength >= remove_at else "[NUMBER]" if m.group().isdigit() else "[WORD]"))
                all_spans.append(_as_rows(spans))
                cleaned.append(_replaced(text, marks))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(cleaned, pa.string()), batch.column("base"), pa.array(all_spans, SPANS)],
                                             names=["rest", "clean", "base", "spans"])
    return run


def _replaced(text: str, marks: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, label in sorted(marks, key=lambda m: m[:2]):
        if a >= at:
            out += [text[at:a], label]
        at = max(at, b)
    return "".join([*out, text[at:]])


#: Shares into which the rows of one text are dealt when they meet its words to hide.
SHARES = 16


def sanitise(docs: DataFrame, *, text_col: str = "text", least_share: float = 0.5, most_chance: float = 0.05,
             generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """(rest, clean, base, spans) of every row of ``docs``.

    ``rest`` is a struct of all columns but the text (so no name clashes), ``clean`` the sanitised text, ``base`` the
    entities' spans and ``spans`` those and the terms' after them, as (kind, start, end) in code points. A null
    text counts as empty; repeated rows, null and repeated ids are rows of their own in the result, but equal texts
    count once in the corpus; texts without entities stay as they are. Only rows with
    entities are shuffled. An empty table gives no rows.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(*[docs[c] for c in others]) if others else F.struct(F.lit(None).cast("string").alias("none"))
    rows = docs.select(rest.alias("rest"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    scanned = rows.mapInArrow(_scan, common.output(rows, "rest", f"text string, base {SPANS_DDL}"))
    hits = common.written(spark, scanned.where(F.size("base") > 0), "entity_rows")
    terms = _disclosing(rows, hits, least_share, generalise_at, most_chance)
    terms = terms.groupBy("doc").agg(F.collect_list(F.struct("term", "disclosure")).alias("terms"))
    terms = terms.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    dealt = hits.select("*", _text_key(), F.pmod(F.monotonically_increasing_id(), F.lit(SHARES)).cast("int").alias("share"))
    found = dealt.join(terms, ["doc", "share"], "left").select("rest", "text", "base", "terms")
    found = found.mapInArrow(_finish(remove_at), common.output(rows, "rest", f"clean string, base {SPANS_DDL}, spans {SPANS_DDL}"))
    plain = scanned.where(F.size("base") == 0).select("rest", F.col("text").alias("clean"), "base", F.col("base").alias("spans"))
    return plain.unionByName(found)


def listed(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
