"""Token counts and packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op2_resync, op5_pack
from tidemark.llm.tokens import PieceEncoder, load

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["Hello", "world's", "x" * 50, "123456", "  ", "\n\t", "!!'s", "é", "é", "́", "İ", "क़", "<|endoftext|>", "<|end", "oftext|>",
         "🙂🙂", "ﬁ", "Σας", " ", " ", "\x1c", "한국어", "각", "don't", "a.b,c", "'ll", "-", "漢字" * 20, "End,", "x.,", "9.\n", "!!, ", "<|ENDOFTEXT|>", "ONE. "]


def odd_texts(n, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) + r.choice(["", "", " "]) for _ in range(r.randint(0, 120))) for _ in range(n)]


def test_chunks_splice_to_the_whole_texts_count():
    tokenizer = load(PATH)
    encode = op2_resync.ChunkEncoder(tokenizer)
    widened = 0
    for text in odd_texts(300) + ["z" * 3000, "漢" * 2000, "", "a"]:
        n, _, w = op2_resync.count_by_chunks(encode, text, 100, 40)
        widened += w
        assert n == len(tokenizer.encode(text, add_special_tokens=False).ids), text
    assert widened > 0


def test_piece_encoder_gives_the_library_ids():
    tokenizer, encoder = load(PATH), PieceEncoder(PATH, cache_pieces=50)
    for text in odd_texts(300, seed=6):
        ids = np.frombuffer(encoder.ids([text])[0], "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("slow", [False, True])
def test_best_fill_is_the_best(slow):
    r = random.Random(1)
    for _ in range(200):
        counts = {r.randint(1, 30): r.randint(1, 3) for _ in range(r.randint(1, 5))}
        target = r.randint(1, 60)
        take = op5_pack.best_fill(sorted(counts, reverse=True), counts, target)
        reach = {0}
        for n, c in counts.items():
            reach = {s + n * k for s in reach for k in range(c + 1)}
        assert all(take[n] <= counts[n] for n in take)
        assert sum(n * k for n, k in take.items()) == max(s for s in reach if s <= target)


def frame(spark):
    rows = [(i, t, "x") for i, t in enumerate(odd_texts(150, seed=7))]
    rows += [(500, None, "x"), (501, "", "x"), (502, "same text", "x"), (502, "same text", "x"), (None, "no id", None), (503, "word " * 6000, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)


def test_counts_of_a_table(spark):
    tokenizer = load(PATH)
    df = frame(spark)
    got = op2_resync.count_tokens(df, PATH, chunk_chars=200, overlap_chars=64).select("doc_id", "n_bytes", "n_tokens").collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert op2_resync.count_tokens(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("capacity, pool", [(64, 4096), (4096, 1 << 21)])
def test_every_id_lies_in_one_piece_and_no_window_is_padded(spark, capacity, pool):
    tokenizer = load(PATH)
    df = frame(spark)
    rows = op5_pack.pack(df, PATH, capacity=capacity, pool_tokens=pool).collect()
    want = sorted(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for r in df.collect())
    by_sequence = {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        filled = 0
        for r in pieces:
            assert r.offset == filled
            filled += r.length
        assert filled <= capacity and (filled == capacity or filled & (filled - 1) == 0)
    by_doc = {}
    for r in rows:
        if r.doc_id != 502:
            by_doc.setdefault(r.doc_id, []).append(r)
    whole = []
    for pieces in by_doc.values():
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        ids = b"".join(r.ids for r in pieces)
        assert len(ids) == 4 * pieces[0].doc_tokens
        whole.append(ids)
    twice = np.array([*tokenizer.encode("same text", add_special_tokens=False).ids, 2], "<u4").tobytes()
    assert sorted([*whole, twice, twice]) == want
    assert sum(r.length for r in rows if r.doc_id == 502) == 2 * len(twice) // 4
    assert op5_pack.pack(df.where(F.lit(False)), PATH).count() == 0


def test_many_copies_leave_no_padding():
    copies = ((i, b"\1\0\0\0" * 3000) for i in range(1000))
    found = list(op5_pack.sequences(copies, 4096, 1 << 18))
    fills = [sum(len(p[1]) // 4 for p in s) for s in found]
    assert sum(fills) == 3_000_000 and all(f == 4096 or f & (f - 1) == 0 for f in fills) and sum(f != 4096 for f in fills) <= 12
