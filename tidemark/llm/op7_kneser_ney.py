"""Interpolated modified Kneser-Ney bigram model, counted in Spark, stored as sorted hash arrays.

Counting. Each task turns words into 64-bit hashes, counts its distinct bigrams and sends
them, as arrays, to shards by hash. A shard adds up its bigrams, writes them to the shared folder
as sorted hashes with counts, and sends on what it knows of each word: occurrences, distinct words before it,
and how many words followed it once, twice and more often. Word shards add those up and write
them as sorted hash arrays too. The driver only sees totals.

Scoring. Workers map the files into memory and look tokens up by hash, sorted, many texts at a time.

    P(w | h) = max(c(h w) - D(c), 0) / c(h) + (D1 N1(h) + D2 N2(h) + D3 N3(h)) / c(h) * P(w)
    P(w)     = max(N(. w) - D'(N), 0) / N(. .) + (the same with D' and numbers of words) / N(. .) / (V + 1)

with N(. w) the number of distinct words before w; a word never seen takes the last term.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, common
from tidemark.session import checkpoint_root

_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Stand for a text's begin and end; no word is or holds a space.
BEGIN, END = xxhash.xxh3_64_intdigest(b"  "), xxhash.xxh3_64_intdigest(b" ")
#: A word that goes before others is known by its upper 48 bits.
BEFORE_SHIFT = np.uint64(16)
#: A frequent word's bigrams are dealt to at least so many shards, by the word before it, and to a quarter of them if they are many.
SPREAD = 16
#: Bits of a bigram's hash that the index of its shard takes; the next 32 are stored.
INDEX_BITS = 12

WORD_FIELDS = [("n", "<i8"), ("before", "<i8"), ("n1", "<i8"), ("n2", "<i8"), ("n3", "<i8")]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def pair_hash(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    return _mix(_mix(word) * _P + before)


def shard_of(word: np.ndarray, before: np.ndarray, shards: int) -> np.ndarray:
    spread = np.uint64(max(SPREAD, shards // 4))
    return (_mix(word * _P + _mix(before) % spread) % np.uint64(shards)).astype(np.int64)


def word_shard_of(before48: np.ndarray, shards: int) -> np.ndarray:
    return (_mix(before48) % np.uint64(shards)).astype(np.int64)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens, of what goes before each (48 bits), and each text's first position."""
    parts, starts, at = [], [], 0
    for text in texts:
        words = text.encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII white spaces only
        hashes = np.empty(len(words) + 1, np.uint64)
        hashes[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        hashes[-1] = END
        parts.append(hashes)
        starts.append(at)
        at += len(hashes)
    word = np.concatenate(parts)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[starts] = BEGIN
    return word, before >> BEFORE_SHIFT, np.array(starts)


def _pack48(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view("<u2").reshape(-1, 4)[:, :3]).tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 4), "<u2")
    out[:, :3] = np.frombuffer(data, "<u2").reshape(-1, 3)
    return out.view("<u8").ravel()


def _pack_counts(n: np.ndarray) -> bytes:
    """One byte each; those of 255 and more follow in full."""
    return np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype("<i8").tobytes()


def _unpack_counts(data: bytes, k: int) -> np.ndarray:
    n = np.frombuffer(data, np.uint8, k).astype(np.int64)
    n[n == 255] = np.frombuffer(data[k:], "<i8")
    return n


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.empty(0, np.int64)


BIGRAMS = pa.schema([("shard", pa.int64()), ("words", pa.binary()), ("lengths", pa.binary()), ("before", pa.binary()), ("counts", pa.binary())])
BIGRAMS_DDL = "shard long, words binary, lengths binary, before binary, counts binary"


def _count(shards: int, flush_tokens: int):
    """A task's bigrams as a row for each shard: distinct words, how many bigrams each has, words before, counts."""
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list) -> Iterator[tuple]:
            word, before = (np.concatenate([h[i] for h in held]) for i in range(2))
            order = np.argsort(pair_hash(word, before))
            word, before = word[order], before[order]
            runs = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (before[1:] != before[:-1]))))
            counts = np.diff(runs, append=len(word))
            word, before = word[runs], before[runs]
            shard = shard_of(word, before, shards)
            order = np.lexsort((word, shard))
            word, before, counts, shard = word[order], before[order], counts[order], shard[order]
            cut = _runs(shard)
            for a, b in zip(cut, [*cut[1:], len(shard)], strict=True):
                own = _runs(word[a:b])
                yield (int(shard[a]), word[a:b][own].tobytes(), _pack_counts(np.diff(own, append=b - a)), _pack48(before[a:b]), _pack_counts(counts[a:b]))

        def rows() -> Iterator[tuple]:
            held, size = [], 0
            for batch in rows_in:
                if batch.num_rows:
                    word, before, _ = tokens(batches.texts(batch))
                    held.append((word, before))
                    size += len(word)
                    if size >= flush_tokens:
                        yield from flush(held)
                        held, size = [], 0
            if held:
                yield from flush(held)

        yield from batches.record_batches(rows(), BIGRAMS, 16)
    return run


def _write(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Each array as a file of its own, in place at once: a task that runs again writes the same."""
    for key, array in arrays.items():
        path = os.path.join(folder, f"{name}.{key}.npy")
        draft = f"{path}.{uuid.uuid4().hex}"
        with open(draft, "wb") as f:
            np.save(f, array)
        os.replace(draft, path)


WORDS = pa.schema([("shard", pa.int64()), ("kind", pa.string()), ("keys", pa.binary()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
WORDS_DDL = "shard long, kind string, keys binary, a binary, b binary, c binary"


def _merge_bigrams(folder: str, shards: int, word_shards: int):
    def run(table: pa.Table) -> pa.Table:
        words, befores, counts = [], [], []
        for row in table.to_pylist():
            own = np.frombuffer(row["words"], np.uint64)
            before = _unpack48(row["before"])
            words.append(np.repeat(own, _unpack_counts(row["lengths"], len(own))))
            befores.append(before)
            counts.append(_unpack_counts(row["counts"], len(before)))
        shard = table.column("shard")[0].as_py()
        word, before, count = np.concatenate(words), np.concatenate(befores), np.concatenate(counts)
        del words, befores, counts
        key = pair_hash(word, before)
        order = np.argsort(key)
        key = key[order]
        runs = _runs(key)
        count = np.add.reduceat(count[order], runs)
        word, before, key = word[order[runs]], before[order[runs]], key[runs]
        del order
        index = np.searchsorted(key >> np.uint64(64 - INDEX_BITS), np.arange((1 << INDEX_BITS) + 1, dtype=np.uint64))
        stored = ((key >> np.uint64(32 - INDEX_BITS)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        many = np.flatnonzero(count >= 255)
        _write(folder, f"bigrams-{shard}", index=index.astype(np.int64), hash=stored, count=np.minimum(count, 255).astype(np.uint8), at=many, many=count[many])

        def by_shard(kind: str, at: np.ndarray, keys: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple]:
            order = np.argsort(at, kind="stable")
            cut = _runs(at[order])
            for a, b in zip(cut, [*cut[1:], len(at)], strict=True):
                take = order[a:b]
                yield (int(at[take[0]]), kind, keys[take].tobytes(), *[_pack_counts(c[take]) for c in columns])

        def rows() -> Iterator[tuple]:
            order = np.argsort(word)
            own = word[order]
            runs = _runs(own)
            n = np.add.reduceat(count[order], runs)
            kinds = np.diff(runs, append=len(own))
            yield from by_shard("word", word_shard_of(own[runs] >> BEFORE_SHIFT, word_shards), own[runs], [n, kinds, np.zeros(len(runs), np.int64)])
            order = np.argsort(before)
            own, c = before[order], count[order]
            runs = _runs(own)
            follow = [np.add.reduceat((c == k).astype(np.int64), runs) for k in (1, 2)] + [np.add.reduceat((c > 2).astype(np.int64), runs)]
            yield from by_shard("before", word_shard_of(own[runs], word_shards), own[runs], follow)
            yield (-1, f"bigrams-{shard}", np.uint64([len(key)]).tobytes(), b"", b"", b"")
            yield (-1, "bigrams", np.bincount(np.minimum(count, 5), minlength=6).astype(np.int64).tobytes(), b"", b"", b"")

        return pa.Table.from_batches(list(batches.record_batches(rows(), WORDS, 64)), schema=WORDS)
    return run


TOTALS_DDL = "kind string, name string, n long"


def _merge_words(folder: str):
    """Writes a word shard; gives totals: tokens, words, and words by the number of words before them."""
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        schema = pa.schema([("kind", pa.string()), ("name", pa.string()), ("n", pa.int64())])
        rows = table.to_pylist()
        if shard < 0:
            found = sum(np.frombuffer(r["keys"], np.int64) for r in rows if r["kind"] == "bigrams")
            out = [("bigrams", str(k), int(v)) for k, v in enumerate(found)]
            out += [("written", r["kind"], int(np.frombuffer(r["keys"], np.int64)[0])) for r in rows if r["kind"] != "bigrams"]
            return pa.Table.from_batches(list(batches.record_batches(iter(out), schema)), schema=schema)

        def added(kind: str) -> tuple[np.ndarray, list[np.ndarray]]:
            own = [(np.frombuffer(r["keys"], np.uint64), r) for r in rows if r["kind"] == kind]
            if not own:
                return np.empty(0, np.uint64), [np.empty(0, np.int64)] * 3
            keys = np.concatenate([k for k, _ in own])
            columns = [np.concatenate([_unpack_counts(r[c], len(k)) for k, r in own]) for c in "abc"]
            order = np.argsort(keys)
            runs = _runs(keys[order])
            return keys[order][runs], [np.add.reduceat(c[order], runs) for c in columns]

        words, (n, kinds, _) = added("word")
        befores, follow = added("before")
        _write(folder, f"words-{shard}", hash=words, n=n, kinds=kinds)
        _write(folder, f"before-{shard}", hash=befores, n1=follow[0], n2=follow[1], n3=follow[2])
        by_kinds = np.bincount(np.minimum(kinds, 5), minlength=6)
        out = [("written", f"words-{shard}", len(words)), ("written", f"before-{shard}", len(befores)), ("tokens", "", int(n.sum())), ("words", "", len(words)), ("kinds", "", int(kinds.sum())), *[("unigrams", str(k), int(v)) for k, v in enumerate(by_kinds)]]
        return pa.Table.from_batches(list(batches.record_batches(iter(out), schema)), schema=schema)
    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3 from how many n-grams occur 1, 2, 3 and 4 times (n[1] to n[4]); where a
    number is missing, a share of the count."""
    if not (n[1] and n[2]):
        return 0.5, 1.0, 1.5
    y = n[1] / (n[1] + 2 * n[2])
    raw = 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5
    return tuple(min(max(d, 0.05 * k), float(k)) for k, d in enumerate(raw, 1))


@dataclass
class Model:
    """Where the arrays are, and the totals. ``tokens`` and ``words``: all and distinct ones of training, ends included."""
    folder: str
    shards: int
    word_shards: int
    documents: int
    tokens: int
    words: int
    kinds: int  # distinct bigrams
    unigram_counts: list[int]
    bigram_counts: list[int]
    written: dict[str, int]  # the shards' files, and how many entries each has


def posix_folder(spark) -> str:
    """A new folder in the shared checkpoint folder as a path that workers can map files from."""
    root = checkpoint_root(spark)
    scheme, _, path = root.partition(":") if ":" in root else ("file", "", root)
    if scheme != "file":
        raise ValueError(f"the model's files are mapped into memory: give a folder of a mounted file system that all nodes share, not {root}")
    return os.path.join("/" + path.lstrip("/"), "tidemark", "kneser_ney", uuid.uuid4().hex)


def train(docs: DataFrame, *, text_col: str = "text", folder: str | None = None, shard_chars: int = 16_000_000, flush_tokens: int = 2_000_000) -> Model:
    """Counts all rows of ``docs``; a null text is its end token alone. ``folder``: on a file system that all
    nodes mount; by default a new one in ``spark.checkpoint.dir``."""
    spark = docs.sparkSession
    folder = folder or posix_folder(spark)
    os.makedirs(folder, exist_ok=True)
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    documents, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()
    shards = max(4, -(-chars // shard_chars))
    bigrams = rows.mapInArrow(_count(shards, flush_tokens), BIGRAMS_DDL)
    words = bigrams.groupBy("shard").applyInArrow(_merge_bigrams(folder, shards, shards), WORDS_DDL)
    totals = words.groupBy("shard").applyInArrow(_merge_words(folder), TOTALS_DDL).groupBy("kind", "name").agg(F.sum("n").alias("n")).collect()
    n = {(r["kind"], r["name"]): r["n"] for r in totals}
    of = lambda kind: [n.get((kind, str(k)), 0) for k in range(6)]
    return Model(folder, shards, shards, documents, n.get(("tokens", ""), 0), n.get(("words", ""), 0), n.get(("kinds", ""), 0), of("unigrams"), of("bigrams"),
                 {name: k for (kind, name), k in n.items() if kind == "written"})


class Tables:
    """The model's arrays, mapped into memory."""

    def __init__(self, model: Model):
        self.model = model
        self.bigrams = [self._load(f"bigrams-{s}", "index", "hash", "count", "at", "many") for s in range(model.shards)]
        self.words = [self._load(f"words-{s}", "hash", "n", "kinds") for s in range(model.word_shards)]
        self.before = [self._load(f"before-{s}", "hash", "n1", "n2", "n3") for s in range(model.word_shards)]

    def _load(self, name: str, *keys: str) -> dict[str, np.ndarray] | None:
        if name not in self.model.written:  # no row came to that shard
            return None
        paths = {k: os.path.join(self.model.folder, f"{name}.{k}.npy") for k in keys}
        if missing := [p for p in paths.values() if not os.path.exists(p)]:
            raise FileNotFoundError(f"the model's folder must be on a file system that all nodes share, and keep its files: {missing[0]} is not there")
        found = {k: np.load(p, mmap_mode="r") for k, p in paths.items()}
        if len(found["hash"]) != self.model.written[name]:
            raise ValueError(f"{paths['hash']} has {len(found['hash'])} entries, not the {self.model.written[name]} of the model")
        return found

    @staticmethod
    def _shard_by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(shard, kind="stable")
        cut = _runs(shard[order])
        for a, b in zip(cut, [*cut[1:], len(shard)], strict=True):
            yield int(shard[order[a]]), order[a:b]

    def look_up(self, tables: list, keys: np.ndarray, shard: np.ndarray, columns: tuple[str, ...]) -> list[np.ndarray]:
        """The columns' values of each key, 0 where it isn't there. keys: sorted, distinct."""
        out = [np.zeros(len(keys), np.int64) for _ in columns]
        for s, at in self._shard_by_shard(shard):
            table = tables[s]
            if table is None or not len(table["hash"]):
                continue
            hashes = table["hash"]
            i = np.minimum(np.searchsorted(hashes, keys[at]), len(hashes) - 1)
            there = hashes[i] == keys[at]
            for o, c in zip(out, columns, strict=True):
                o[at[there]] = table[c][i[there]]
        return out

    def bigram_counts(self, word: np.ndarray, before: np.ndarray) -> np.ndarray:
        key = pair_hash(word, before)
        shard = shard_of(word, before, self.model.shards)
        out = np.zeros(len(key), np.int64)
        for s, at in self._shard_by_shard(shard):
            table = self.bigrams[s]
            if table is None:
                continue
            own = key[at]
            top = (own >> np.uint64(64 - INDEX_BITS)).astype(np.int64)
            low = ((own >> np.uint64(32 - INDEX_BITS)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            index, hashes = np.asarray(table["index"]), table["hash"]
            lo, hi = index[top], index[top + 1]
            end, last = hi.copy(), len(hashes) - 1
            while (open_ := lo < hi).any():
                mid = (lo + hi) >> 1
                right = open_ & (hashes[np.minimum(mid, last)] < low)
                lo = np.where(right, mid + 1, lo)
                hi = np.where(open_ & ~right, mid, hi)
            there = (lo < end) & (hashes[np.minimum(lo, last)] == low)
            found = lo[there]
            n = table["count"][found].astype(np.int64)
            if len(table["at"]):
                big = n == 255
                n[big] = table["many"][np.searchsorted(table["at"], found[big])]
            out[at[there]] = n
        return out


def log_probabilities(tables: Tables, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: its count in training, the base model's log10 probability, and this model's."""
    m = tables.model
    words, which = np.unique(word, return_inverse=True)
    n, kinds = tables.look_up(tables.words, words, word_shard_of(words >> BEFORE_SHIFT, m.word_shards), ("n", "kinds"))
    base = np.log10((n + 1) / (m.tokens + m.words + 1))
    d = np.array([0.0, *discounts(m.unigram_counts)])
    c = m.unigram_counts
    total = max(m.kinds, 1)
    left = (d[1] * c[1] + d[2] * c[2] + d[3] * (m.words - c[1] - c[2])) / total if m.kinds else 1.0
    single = np.maximum(kinds - d[np.minimum(kinds, 3)], 0) / total + left / (m.words + 1)

    befores, which_before = np.unique(before, return_inverse=True)
    n1, n2, n3 = tables.look_up(tables.before, befores, word_shard_of(befores, m.word_shards), ("n1", "n2", "n3"))
    pairs, first, which_pair = np.unique(pair_hash(word, before), return_index=True, return_inverse=True)
    both = tables.bigram_counts(word[first], before[first])
    seen = np.zeros(len(befores), np.int64)
    seen_words, at = np.unique(words >> BEFORE_SHIFT, return_index=True)
    i = np.searchsorted(seen_words, befores)
    ok = i < len(seen_words)
    ok[ok] = seen_words[i[ok]] == befores[ok]
    seen[ok] = n[at[i[ok]]]
    seen[befores == np.uint64(BEGIN >> 16)] = m.documents

    d = np.array([0.0, *discounts(m.bigram_counts)])
    gamma = np.where(seen > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / np.maximum(seen, 1), 1.0)
    c = both[which_pair]
    p = np.maximum(c - d[np.minimum(c, 3)], 0) / np.maximum(seen[which_before], 1) + gamma[which_before] * single[which]
    return n[which], base[which], np.log10(p)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", batch_tokens: int = 500_000) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    A null text counts as empty: its end is its one token. Repeated rows and null ids give a row each; other columns are not
    read. A model of no rows gives every token 1 / (V + 1) = 1. A shard's file that is missing or not the one that was written is an error. No shuffle; a task holds ``batch_tokens`` tokens and a batch of texts.
    """
    longs, doubles = ["n_tokens", "n_known", "train_tokens"], ["base_score", "score"]

    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(model)

        def scored(held: list) -> pa.RecordBatch:
            word, before = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            starts, size = [], 0
            for _, own, _, own_starts in held:
                starts.append(own_starts + size)
                size += len(own)
            starts = np.concatenate(starts)
            n, base, own = log_probabilities(tables, word, before)
            sums = [np.diff(starts, append=size), np.add.reduceat((n > 0).astype(np.int64), starts), np.full(len(starts), model.tokens)]
            arrays = [pa.array(x, pa.int64()) for x in sums] + [pa.array(np.add.reduceat(x, starts), pa.float64()) for x in (base, own)]
            ids = pa.chunked_array([h[0] for h in held]).combine_chunks()
            return pa.RecordBatch.from_arrays([ids, *arrays], names=[id_col, *longs, *doubles])

        held, size = [], 0
        for batch in rows_in:
            if batch.num_rows:
                held.append((batch.column(0), *tokens(batches.texts(batch))))
                size += len(held[-1][1])
                if size >= batch_tokens:
                    yield scored(held)
                    held, size = [], 0
        if held:
            yield scored(held)

    ddl = ", ".join([*[f"{c} long" for c in longs], *[f"{c} double" for c in doubles]])
    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, common.output(docs, id_col, ddl))
