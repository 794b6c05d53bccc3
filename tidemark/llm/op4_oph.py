"""Near-duplicates by one-permutation hashing with optimal densification.

A document's set of word shingles is hashed once; the top bits of a hash name its bin,
and each bin keeps its smallest hash. An empty bin copies a bin that is not empty, found by the
bin's own random order of the others (the same for all documents), which makes all
bins agree with the Jaccard similarity as their chance. Bands of bins are bucket keys.

Equal sets are one class from the start. In each bucket every class is paired with the bucket's smallest
class only: a star, so a bucket of n gives n - 1 pairs. Pairs whose signatures (a few
bits of each bin before densification) don't rule it out are confirmed on full sets, and their links give components. A star can miss a link between two
of its other members; it matters only if they are in different components. So the members of buckets that
still span components are compared by their signatures, in blocks, and the few pairs across
components that may be alike are confirmed on full sets as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, common
from tidemark.llm.components import components

BIN_BITS = 9
BINS = 1 << BIN_BITS
BAND_ROWS = 4
BANDS = 32
#: Unions of up to so many shingles are ruled out by signatures only if that is certain, larger ones also if a link would agree so rarely by chance.
CERTAIN_UNION = 1024
MISSED = 1e-12
#: Bits of the filter that keeps texts no pair asks for out of the shuffle (it lets some through, which are joined away).
FILTER_BITS = 24
#: Members of a block when a bucket's signatures are compared.
BLOCK = 256

_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_EDGES = np.arange(1, BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)
#: For each bin, its random order of the bins to copy from when it is empty.
_ORDER = np.argsort(np.random.default_rng(4).random((BINS, BINS)), axis=1).argsort(axis=1).astype(np.int16)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose top bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, or of all words if there are fewer."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII white spaces only
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = _mix(h * _P + w[i:len(w) - n + 1 + i])
    return np.unique(h)


def _cut(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the bins of a sorted set begin and end, and which have a hash."""
    cut = np.concatenate(([0], np.searchsorted(hashes, _EDGES), [len(hashes)]))
    return cut, cut[:-1] < cut[1:]


def bins_of(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin of a sorted, non-empty set, empty bins densified."""
    cut, filled = _cut(hashes)
    source = np.flatnonzero(filled)
    if len(source) < BINS:
        copied = np.arange(BINS)
        empty = np.flatnonzero(~filled)
        copied[empty] = source[_ORDER[np.ix_(empty, source)].argmin(axis=1)]
        return hashes[cut[copied]]
    return hashes[cut[:-1]]


def band_keys(bins: np.ndarray) -> np.ndarray:
    rows = bins[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    key = _mix(np.arange(BANDS, dtype=np.uint64) + _P)
    for i in range(BAND_ROWS):
        key = _mix(key * _P + rows[:, i])
    return key.view(np.int64)


def signature(hashes: np.ndarray) -> bytes:
    """Four bits of each bin, two bins in a byte: 0 if the bin is empty, else 1 to 15 by its smallest hash."""
    cut, filled = _cut(hashes)
    low = np.zeros(BINS, np.uint8)
    low[filled] = hashes[cut[:-1][filled]] % np.uint64(15) + np.uint64(1)
    return (low[0::2] | (low[1::2] << np.uint8(4))).tobytes()


def least_matches(nu: np.ndarray, nv: np.ndarray, occupied: np.ndarray, percent: int) -> np.ndarray:
    """How many of the bins ``occupied`` by either set hold the same smallest hash at least, if the sets reach ``percent``.

    The smallest hashes of the union's bins are a sample of it without replacement, as large as ``occupied``; those
    that both sets have are the smallest of both. The sample misses no more of them than the sets differ in, which is certain.
    Of larger unions it also has fewer than Serfling's bound with a chance of ``MISSED`` at most, whatever the size.
    """
    total = nu.astype(np.int64) + nv
    both = -(-percent * total // (100 + percent))
    union = total - both
    certain = (occupied - (union - both)).astype(float)
    spread = np.sqrt(occupied * np.maximum(1 - (occupied - 1) / union, 0) * -np.log(MISSED) / 2)
    return np.where(union <= CERTAIN_UNION, certain, np.maximum(certain, occupied * both / union - spread - 1e-6))


def may_link(u: np.ndarray, v: np.ndarray, nu: np.ndarray, nv: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two matrices of signature bins don't rule out that their sets reach ``percent``."""
    empty = ((u | v) == 0).sum(axis=1)
    return (u == v).sum(axis=1) - empty >= least_matches(nu, nv, u.shape[1] - empty, percent)


def _sketches(size: int):
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("n", pa.int32()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])
        for batch in rows_in:
            counts, digests, bands, signatures = [], [], [], []
            for text in batches.texts(batch):
                s = shingles(text, size)
                counts.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                bins = bins_of(s) if len(s) else None
                bands.append(None if bins is None else band_keys(bins))
                signatures.append(signature(s) if len(s) else None)
            arrays = [pa.array(x, f.type) for x, f in zip((counts, digests, bands, signatures), schema, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *schema.names])
    return run


def _sets(size: int, wanted: np.ndarray):
    """The full sets of rows whose slot is wanted."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in:
            slot = batch.column("slot").to_numpy()
            part = batch.filter(pa.array((wanted[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))
            sets = [shingles(t, size) for t in batches.texts(part)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                                              pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "digest", "members"])
    return run


def _slot():
    return F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))


def wanted_slots(ids: DataFrame) -> np.ndarray:
    """A bitmap of the slots of ``ids``, put together from pieces of 4 KB that Spark makes: its size is fixed."""
    pieces = ids.select(_slot().alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot + 1)").alias("piece")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot + 1))").alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in pieces.toLocalIterator():
        piece = np.frombuffer(row["bits"], np.uint8)
        out[(row["piece"] - 1) * len(piece):row["piece"] * len(piece)] = piece
    return out


def _bins(signatures: pa.Array) -> np.ndarray:
    packed = np.frombuffer(b"".join(signatures.to_pylist()), np.uint8).reshape(len(signatures), -1)
    bins = np.empty((len(signatures), 2 * packed.shape[1]), np.uint8)
    bins[:, 0::2], bins[:, 1::2] = packed & 15, packed >> 4
    return bins


def _alike(percent: int):
    """Those pairs that their signatures don't rule out."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in:
            if batch.num_rows:
                nu, nv = (batch.column(c).to_numpy() for c in ("nu", "nv"))
                yield batch.select(["u", "v"]).filter(pa.array(may_link(_bins(batch.column("su")), _bins(batch.column("sv")), nu, nv, percent)))
    return run


def _members(items: pa.Array) -> dict[str, np.ndarray]:
    """A block's members as arrays."""
    fields = dict(zip([f.name for f in items.type], items.flatten(), strict=True))
    return {"bins": _bins(fields["signature"]), "bands": fields["bands"].flatten().to_numpy(zero_copy_only=False).reshape(len(items), -1)} | {k: fields[k].to_numpy(zero_copy_only=False) for k in ("node", "root", "n")}


def _compare(percent: int):
    """Pairs of two blocks of a bucket: of different components, of sizes that fit, not ruled out by their signatures,
    and with this band as the first they share (else another bucket gives them)."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in:
            us, vs = [], []
            columns = [batch.column(c) for c in ("left", "right")]
            for i, (band, same) in enumerate(zip(batch.column("band").to_pylist(), batch.column("same").to_pylist(), strict=True)):
                a, b = (_members(c[i].values) for c in columns)
                small, large = np.minimum.outer(a["n"], b["n"]), np.maximum.outer(a["n"], b["n"])
                open_ = (a["root"][:, None] != b["root"][None, :]) & (100 * small.astype(np.int64) >= percent * large.astype(np.int64))
                for k in range(band):
                    open_ &= a["bands"][:, k][:, None] != b["bands"][:, k][None, :]
                x, y = np.nonzero(np.triu(open_, 1) if same else open_)
                for s in range(0, len(x), 8192):
                    p, q = x[s:s + 8192], y[s:s + 8192]
                    alike = may_link(a["bins"][p], b["bins"][q], a["n"][p], b["n"][q], percent)
                    us.append(a["node"][p[alike]])
                    vs.append(b["node"][q[alike]])
            u, v = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (us, vs))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v), pa.int64()), pa.array(np.maximum(u, v), pa.int64())], names=["u", "v"])
    return run


def links(rows: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v) whose full sets are similar enough (some twice, where an id repeats). rows: (id, text)."""
    spark = rows.sparkSession
    pairs = common.written(spark, pairs, "pairs")
    wanted = pairs.select(F.col("u").alias("id")).union(pairs.select(F.col("v").alias("id"))).distinct()
    wanted = common.written(spark, wanted, "wanted")
    asked = rows.where("id is not null").select("id", "text", _slot().alias("slot"))
    sets = asked.mapInArrow(_sets(size, wanted_slots(wanted)), "id long, digest binary, members array<long>")
    sets = common.written(spark, sets.join(wanted, "id").dropDuplicates(["id", "digest"]).select("id", "members"), "sets")
    u = sets.select(F.col("id").alias("u"), F.col("members").alias("mu"))
    v = sets.select(F.col("id").alias("v"), F.col("members").alias("mv"))
    both = F.size(F.array_intersect("mu", "mv"))
    joined = pairs.join(v, "v").join(u, "u").select("u", "v", (F.size("mu") + F.size("mv")).alias("total"), both.alias("both"))
    return joined.where(100 * F.col("both") >= percent * (F.col("total") - F.col("both"))).select("u", "v")


#: Blocks of a bucket that one task meets with others.
MET = 16


def block_pairs(placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(band, same, left, right): the pairs of blocks whose members must be compared, members of different components of a bucket.

    placed: (key, band, node, root, n); classes: (node, bands, signature). A block keeps to one class of sizes, in
    which sizes differ by less than a link allows, and meets only its own class and the next ones. A component that fills a block in its bucket has
    blocks of its own, which never meet each other: a bucket of one giant component and a few strays takes as many pairs of
    blocks as the component has, not their square. Blocks of a bucket are dealt over tasks by their number.
    """
    by_size = F.floor(F.log(F.col("n")) / math.log(100 / percent) + 1e-9).cast("long") if percent < 100 else F.col("n").cast("long")
    placed = placed.withColumn("class", by_size)
    alone = placed.groupBy("key", "root").agg(F.count("*").alias("c")).where(F.col("c") >= BLOCK).select("key", "root", F.lit(True).alias("alone"))
    placed = placed.join(alone, ["key", "root"], "left").withColumn("alone", F.coalesce("alone", F.lit(False)))
    placed = placed.withColumn("own", F.when(F.col("alone"), F.col("root")).otherwise(F.lit(0)))
    group = ["key", "class", "alone", "own"]
    parts = placed.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    # a group's rows are dealt over shares to meet their number of blocks
    parts = parts.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(MET - 1).cast("long"))))
    placed = placed.withColumn("share", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(MET).cast("long"))).join(parts, [*group, "share"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), "parts"))
    blocks = placed.join(classes, "node").groupBy(*group, "band", "block").agg(F.collect_list(F.struct("node", "root", "n", "bands", "signature")).alias("items"))
    blocks = common.written(placed.sparkSession, blocks, "blocks")

    def met(left: DataFrame, right: DataFrame, which) -> DataFrame:
        """Pairs of blocks of a bucket and of near classes for which ``which`` holds; each left one is in one place, right ones go to all places of their bucket."""
        tasks = left.groupBy("key").agg(F.ceil(F.count("*") / MET).alias("tasks"))
        x = left.join(tasks, "key").select("key", F.pmod(F.xxhash64("class", "own", "block"), "tasks").alias("task"), *[F.col(c).alias(f"l_{c}") for c in (*group[1:], "band", "block", "items")])
        y = right.join(tasks, "key").select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), *[F.col(c).alias(f"r_{c}") for c in (*group[1:], "block", "items")])
        near = F.abs(F.col("l_class") - F.col("r_class")) <= 1
        found = x.join(y, ["key", "task"]).where(near & which(*[F.struct(*[F.col(f"{side}_{c}").alias(c) for c in ("class", "block")]) for side in "lr"]))
        same = (F.col("l_class") == F.col("r_class")) & (F.col("l_block") == F.col("r_block")) & ~F.col("l_alone") & ~F.col("r_alone")
        return found.select(F.col("l_band").alias("band"), same.alias("same"), F.col("l_items").alias("left"), F.col("r_items").alias("right"))

    mixed, single = blocks.where("not alone"), blocks.where("alone")
    several = single.groupBy("key").agg(F.min("own").alias("a"), F.max("own").alias("b")).where("a <> b").select("key")
    giants = single.join(several, "key", "left_semi")
    return (met(mixed, mixed, lambda x, y: x <= y).unionByName(met(single, mixed, lambda x, y: F.lit(True)))
            .unionByName(met(giants, giants, lambda x, y: F.col("l_own") < F.col("r_own"))))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 75) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``; ids are whole numbers.

    Rows are linked if 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest id reachable, ``kept`` marks the row that has it. Null and empty texts,
    or ones without words, have an empty set and no links. Rows that repeat an id are one
    vertex with all their links. A row whose id is null takes no part: it has no component and is kept.
    Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = common.id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    sketches = common.written(spark, rows.mapInArrow(_sketches(shingle_words), "id long, n int, digest binary, bands array<long>, signature binary"), "sketches")
    sets = sketches.where("id is not null and digest is not null")
    classes = common.written(spark, sets.groupBy("digest").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "classes")
    members = classes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    fits = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
    buckets = members.groupBy("key").agg(F.min("node").alias("centre"), F.min_by("n", "node").alias("cn"), F.count("*").alias("size")).where("size > 1")
    star = (members.join(buckets, "key").where(F.col("node") != F.col("centre")).where(fits(F.col("n"), F.col("cn")))
            .select(F.col("centre").alias("u"), F.col("node").alias("v")).distinct())
    star = common.written(spark, star, "star")

    marked = (star.join(classes.select(F.col("node").alias("v"), F.col("signature").alias("sv"), F.col("n").alias("nv")), "v")
              .join(classes.select(F.col("node").alias("u"), F.col("signature").alias("su"), F.col("n").alias("nu")), "u"))
    star = marked.mapInArrow(_alike(percent), "u long, v long").distinct()
    found = common.written(spark, links(rows, star, shingle_words, percent), "links")
    roots = common.written(spark, components(found), "roots")

    # buckets that span components: pairs across them, but those with the bucket's centre, which the star has
    placed = members.join(roots.withColumnRenamed("v", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("node").alias("centre"), F.count("*").alias("size"))
    mixed = mixed.where("lo <> hi and size > 2").select("key", "centre")
    placed = common.written(spark, placed.join(mixed, "key").where("node <> centre").select("key", "band", "node", "root", "n"), "mixed")
    compared = block_pairs(placed, classes.select("node", "bands", "signature"), percent)
    rest = compared.mapInArrow(_compare(percent), "u long, v long").where("u <> v").distinct()
    more = common.written(spark, links(rows, rest, shingle_words, percent), "links")

    # the other rows of a class, and the classes of an id that repeats, are linked as well
    same = sets.join(classes.select("digest", "node"), "digest").where("id <> node").select(F.col("node").alias("u"), F.col("id").alias("v")).distinct()
    final = components(found.unionByName(more).unionByName(same))
    out = sketches.join(final.select(F.col("v").alias("id"), "root"), "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
