"""The Kneser-Ney model against one counted in plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import op7_kneser_ney as kn

END, BEGIN = "</s>", "<s>"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w] + [END]


class Plain:
    def __init__(self, texts):
        self.c, self.pairs, self.after, self.n_texts = Counter(), Counter(), Counter(), len(texts)
        for t in texts:
            before = BEGIN
            for w in words(t):
                self.c[w] += 1
                self.pairs[before, w] += 1
                self.after[before] += 1
                before = w
        self.kinds, self.follow = Counter(), defaultdict(lambda: [0, 0, 0])
        for (h, w), n in self.pairs.items():
            self.kinds[w] += 1
            self.follow[h][min(n, 3) - 1] += 1
        of = lambda counts: [0] + [sum(1 for n in counts.values() if n == k) for k in range(1, 6)]
        self.d2, self.d1 = (0, *kn.discounts(of(self.pairs))), (0, *kn.discounts(of(self.kinds)))
        self.N, self.V = sum(self.c.values()), len(self.c)

    def single(self, w):
        total = sum(self.kinds.values())
        if not total:
            return 1 / (self.V + 1)
        left = sum(self.d1[min(n, 3)] for n in self.kinds.values()) / total
        return max(self.kinds[w] - self.d1[min(self.kinds[w], 3)], 0) / total + left / (self.V + 1)

    def p(self, h, w):
        if not self.after[h]:
            return self.single(w)
        gamma = sum(d * n for d, n in zip(self.d2[1:], self.follow[h], strict=True)) / self.after[h]
        c = self.pairs[h, w]
        return max(c - self.d2[min(c, 3)], 0) / self.after[h] + gamma * self.single(w)

    def score(self, t):
        h, total, base, known = BEGIN, 0.0, 0.0, 0
        for w in words(t):
            total += math.log10(self.p(h, w))
            base += math.log10((self.c[w] + 1) / (self.N + self.V + 1))
            known += self.c[w] > 0
            h = w
        return known, base, total


def texts(n, seed, vocabulary=60):
    r = random.Random(seed)
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [r.choice([" ", "\n", "  "]).join(r.choices([f"W{i}é" for i in range(vocabulary)], weights, k=r.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("shard_chars, flush", [(10**6, 10**6), (300, 200)])
def test_scores_equal_a_plain_count(spark, shard_chars, flush):
    learned = [*texts(200, 1), *["the same text again"] * 400, None, "", "UPPER upper"]
    asked = [*texts(60, 2, 90), "the same text", None, "", " never seen", "the the the"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(learned)], "doc_id long, text string, score int").repartition(5)
    model = kn.train(df, shard_chars=shard_chars, flush_tokens=flush)
    plain = Plain(learned)
    assert (model.tokens, model.words, model.documents) == (plain.N, plain.V, len(learned))
    rows = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(asked)], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in kn.score(rows, model, batch_tokens=300).collect()}
    for i, t in enumerate(asked):
        known, base, total = plain.score(t)
        r = got[i if i else None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words(t)), known, plain.N)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(total, rel=1e-9)


def test_probabilities_sum_to_one():
    plain = Plain(texts(300, 3))
    for h in [BEGIN, "w0é", "w5é", "never"]:
        assert sum(plain.p(h, w) for w in plain.c) + plain.p(h, "unknown") == pytest.approx(1)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = kn.train(none)
    assert model.tokens == 0 and kn.score(none, model).count() == 0
    row = kn.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert (row.n_tokens, row.n_known, row.score) == (3, 0, 0.0)


def test_packing_of_counts_and_hashes():
    n = np.array([0, 1, 254, 255, 256, 2**40])
    assert kn._unpack_counts(kn._pack_counts(n), 6).tolist() == n.tolist()
    h = np.array([0, 1, 2**48 - 1], np.uint64)
    assert kn._unpack48(kn._pack48(h)).tolist() == h.tolist()


def test_a_lost_or_strange_shard_is_an_error(spark, tmp_path):
    """Not a word that was never seen: a folder that isn't shared must not change scores silently."""
    docs = spark.createDataFrame([(i, f"a b c w{i} d") for i in range(60)], "doc_id long, text string")
    model = kn.train(docs, folder=str(tmp_path))
    assert kn.score(docs, model).count() == 60 and set(model.written) >= {"bigrams-0", "words-0", "before-0"}
    lost = next(p for p in sorted(tmp_path.iterdir()) if p.name.startswith("words-") and p.name.endswith(".n.npy"))
    held = lost.read_bytes()
    lost.unlink()
    with pytest.raises(Exception, match="not there"):
        kn.score(docs, model).collect()
    lost.write_bytes(held)
    hashes = next(p for p in sorted(tmp_path.iterdir()) if p.name.startswith("bigrams-") and p.name.endswith(".hash.npy"))
    np.save(hashes, np.load(hashes)[:-1])
    with pytest.raises(Exception, match="entries"):
        kn.score(docs, model).collect()


@pytest.mark.parametrize("shards", [4, 64, 400])
def test_a_frequent_word_lies_in_many_shards(shards):
    word = np.full(100_000, kn.END, np.uint64)
    before = np.arange(100_000, dtype=np.uint64) * np.uint64(7919)
    used = np.bincount(kn.shard_of(word, before, shards), minlength=shards)
    assert used.max() < 100_000 * 5 / min(shards, max(16, shards // 4))
