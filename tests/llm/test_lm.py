import math
import random
from collections import Counter

import numpy as np

from furrow.llm import lm

SCHEMA = "doc_id long, text string, score int"


def corpus(seed=2):
    rng = random.Random(seed)
    topics = [[f"{c}{i}" for i in range(30)] for c in "ab"]
    rows = [(i, " ".join(rng.choice(topics[i % 2]) for _ in range(rng.randint(1, 60))), 0) for i in range(80)]
    rows += [(100, None, 0), (101, "", 0), (102, "A1 \n a1", 0), (102, "A1 \n a1", 0), (None, "a1 a2", 0), (103, "b1 " * 20_000, 0)]
    return rows


def brute(rows, target, vocabulary, mixed):
    tokens = [(t or "").lower().split() for _, t, _ in rows]
    count = Counter(w for x in tokens for w in x)
    known = set()
    for c in sorted({math.floor(8 * math.log2(n)) for n in count.values()}, reverse=True):
        more = {w for w, n in count.items() if math.floor(8 * math.log2(n)) == c}
        if len(known) + len(more) > vocabulary:
            break
        known |= more
    seqs = [["<s>", *(w if w in known else "?" for w in x), "</s>"] for x in tokens]
    size = len(known) + 3
    models = []
    for rows_in in ([s for s, r in zip(seqs, rows, strict=True) if r[0] in target], seqs):
        models.append((Counter(w for s in rows_in for w in s[1:]), Counter(w for s in rows_in for w in s[:-1]), Counter(p for s in rows_in for p in zip(s, s[1:], strict=False))))
    out = []
    for (d, *_), s in zip(rows, seqs, strict=True):
        loss = []
        for own, before, pair in models:
            lp = 0.0
            for p in zip(s, s[1:], strict=False):
                word = (own[p[1]] + 1) / (sum(own.values()) + size)
                lp += math.log(mixed * pair[p] / before[p[0]] + (1 - mixed) * word if before[p[0]] else word)
            loss.append(-lp / (len(s) - 1))
        out.append((d, len(s) - 1, *loss, loss[0] - loss[1]))
    return sorted(out, key=str)


def test_against_plain_counts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    target = list(range(0, 80, 2)) + [102]
    ids = spark.createDataFrame([(i,) for i in target + [0, 999]] + [(None,)], "doc_id long")
    for vocabulary in (20, 1000):
        got = sorted(map(tuple, lm.cross_entropy_difference(docs, ids, vocabulary, bits=22).collect()), key=str)
        want = brute(rows, set(target), vocabulary, 0.7)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2:] for g in got], [w[2:] for w in want], rtol=1e-6)
    own = {g[0]: g[4] for g in got}
    assert all(own[i] < 0 for i in range(0, 80, 2)) and all(own[i] > 0 for i in range(1, 80, 2))


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    ids = spark.createDataFrame([], "doc_id long")
    assert lm.cross_entropy_difference(none, ids, 100, 10).collect() == []
    got = lm.cross_entropy_difference(spark.createDataFrame([(1, "x y", 0)], SCHEMA), ids, 100, 10).collect()
    assert len(got) == 1 and got[0].score > 0


def test_shared_counters_never_exceed_their_context(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    ids = docs.select("doc_id")
    assert all(abs(r.score) < 1e-9 for r in lm.cross_entropy_difference(docs.where("doc_id IS NOT NULL"), ids, 100, bits=4).collect())


def test_every_word_and_pair_is_counted_for_itself(spark, monkeypatch):
    rng = random.Random(5)
    rows = corpus() + [(1000 + i, " ".join(f"r{rng.randint(0, 40_000)}" for _ in range(400)), 0) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    target = list(range(0, 80, 2)) + list(range(1000, 1100))
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    want = brute(rows, set(target), 10**9, 0.7)
    monkeypatch.setattr(lm, "BLOCK", 3000)
    # 80,000 different pairs: with 2^10 counters these would be shared by many
    got = sorted(map(tuple, lm.cross_entropy_difference(docs, ids, bits=10, bucket_bytes=10_000).collect()), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], rtol=1e-9)
