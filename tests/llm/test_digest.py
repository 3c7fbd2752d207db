import hashlib
import math
import random
from collections import Counter

import numpy as np

from furrow.llm import digest


def brute_levels(raw):
    out = []
    for i in range(len(raw) - 63):
        s = sum(round(c * math.log2(c) * (1 << 20)) for c in Counter(raw[i : i + 64]).values())
        out.append((digest._MOST - s) * 1000 // digest._MOST)
    return out


def brute_features(raw, rank):
    ranks = [int(rank[x]) for x in brute_levels(raw)]
    runs = max(1, len(ranks) - 63)
    points = Counter(min(range(r, min(r + 64, len(ranks))), key=lambda i: (ranks[i], i)) for r in range(runs))
    return sorted(i for i, p in points.items() if p >= min(16, runs))


def texts(n=12, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshrdluéß") for _ in range(rng.randint(1, 9)))
    return [" ".join(word() for _ in range(rng.randint(20, 400))) for _ in range(n)]


def test_levels_and_features(monkeypatch):
    rank = np.random.default_rng(2).permutation(1001).astype("u2")
    for part in (1 << 17, 100, 1000):
        monkeypatch.setattr(digest, "_PART", part)
        for t in ["a" * 64, "ab" * 50, *texts(4)]:
            raw = np.frombuffer(t.encode(), "u1")
            assert digest.levels(raw).tolist() == brute_levels(raw)
            assert digest.features_of(digest.ranks_of([raw], rank))[0].tolist() == brute_features(raw, rank)
        many = [np.frombuffer(t.encode(), "u1") for t in ["", "ab", "a" * 64, "xyz" * 40, "ab" * 70, *texts(6)]]
        for raw, places in zip(many, digest.features_of(digest.ranks_of(many, rank)), strict=True):
            assert places.tolist() == (brute_features(raw, rank) if len(raw) >= 64 else [])


def test_likeness():
    rank = np.arange(1001).astype("u2")
    a, b = (" ".join(texts(8, s)) for s in (1, 2))
    of = lambda t: digest.Digest.of(t, rank)
    assert len(of(a).counts) > 1
    assert digest.likeness(of(a), of(a)) == 1 and digest.likeness(of(a), of(b)) < 0.15
    assert 0.5 < digest.likeness(of(a), of(digest.edited(a, b))) < 0.85
    assert digest.likeness(of(a), of("inserted at the front, moves every filter " + a)) > 0.9
    assert digest.likeness(of(""), of("")) == 1 and digest.likeness(of(""), of("x")) == 0 and digest.likeness(of("x"), of("x")) == 1
    for t in (a, "", "short"):
        assert str(digest.Digest.parse(str(of(t)))) == str(of(t))


def brute_rows(rows, rank):
    order = sorted(rows, key=lambda r: digest.LOWEST if r[0] is None else r[0], reverse=True)
    out = []
    for i, (d, t, *_) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        n = len(t) // 3
        e = t[: len(t) - n] + nxt[:n]
        x, y, z = (digest.Digest.of(s, rank) for s in (t, e, nxt))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), str(x), str(y), digest.likeness(x, y), digest.likeness(x, z)))
    return sorted(out, key=str)


def test_compare_edited(spark):
    body = texts(40)
    rows = [(i * 7 - 20, t, "x", 1) for i, t in enumerate(body)]
    rows += [(1000, None, "x", 1), (1001, "", "x", 1), (1002, "ab", "x", 1), (1003, body[0], "x", 1), (1004, body[0], "x", 1), (None, "null id " * 30, "x", 1), (1005, "long " * 40_000, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, range int").repartition(4)
    rank = digest.fit_ranks(df)
    count = Counter(x for _, t, *_ in rows if len((t or "").encode()) >= 64 for x in digest.levels(np.frombuffer(t.encode(), "u1")).tolist())
    assert rank.tolist() == np.argsort(sorted(range(1001), key=lambda x: (count[x], x))).tolist()
    got = sorted(map(tuple, digest.compare_edited(df, rank, bucket_bytes=5000).collect()), key=str)
    assert got == brute_rows(rows, rank)
    own = {r.doc_id: r.fingerprint for r in digest.fingerprints(df, rank).collect()}
    assert own == {r[0]: r[3] for r in got}


def test_few_rows(spark):
    rank = np.arange(1001).astype("u2")
    schema = "doc_id long, text string"
    assert digest.compare_edited(spark.createDataFrame([], schema), rank).collect() == []
    one = [(5, "abc" * 40)]
    assert sorted(map(tuple, digest.compare_edited(spark.createDataFrame(one, schema), rank).collect())) == brute_rows(one, rank)
    same = [(5, "abc" * 40), (5, "abc" * 40), (6, "q")]
    assert len(digest.compare_edited(spark.createDataFrame(same, schema), rank).collect()) == 3
    assert digest.fit_ranks(spark.createDataFrame([], schema)).tolist() == list(range(1001))


def test_only_empty_texts_have_empty_digests():
    rank = np.random.default_rng(3).permutation(1001).astype("u2")
    of = lambda t: digest.Digest.of(t, rank)
    body, other = (" ".join(texts(3, s)).encode().decode("utf-8") for s in (7, 8))
    for n in range(1, 300):
        a, b = body[:n], other[:n]
        assert sum(of(a).counts) > 0 and digest.likeness(of(a), of(a)) == 1
        assert n < 10 or digest.likeness(of(a), of(b)) < 1
    spam, eggs = "spam " * 2000, "eggs " * 2000
    assert digest.likeness(of(spam), of(spam)) == 1 and digest.likeness(of(spam), of(eggs)) < 0.5
    assert digest.likeness(of("a" * 5000), of("b" * 5000)) < 0.5 and digest.likeness(of("a" * 5000), of("")) == 0
    assert digest.likeness(of(spam), of(digest.edited(spam, body * 10))) > 0.5


def test_texts_without_features_in_spark(spark):
    rows = [(1, "spam " * 300), (2, "eggs " * 300), (3, texts(1, 9)[0][:140]), (4, ""), (5, "a" * 1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rank = digest.fit_ranks(df)
    got = {r.doc_id: r for r in digest.compare_edited(df, rank).collect()}
    assert [bool(got[i].fingerprint) for i in range(1, 6)] == [True, True, True, False, True]
    assert got[2].near_next < 1 and got[2].near_edited > 0
    assert sorted(map(tuple, got.values()), key=str) == brute_rows(rows, rank)


def test_edits_of_short_texts_are_near(spark):
    rank = np.random.default_rng(4).permutation(1001).astype("u2")
    bodies = texts(24, 11)
    of = lambda t: digest.Digest.of(t, rank)
    for n in (20, 40, 60, 100, 200, 300, 500, 520):
        near = [digest.likeness(of(a[:n]), of(digest.edited(a[:n], b[:n]))) for a, b in zip(bodies, bodies[1:])]
        apart = [digest.likeness(of(a[:n]), of(b[:n])) for a, b in zip(bodies, bodies[1:])]
        assert np.mean(near) > 0.4 and np.mean(apart) < 0.1, (n, np.mean(near), np.mean(apart))
    a = bodies[0][:540]
    assert digest.likeness(of(a), of(digest.edited(a, "x" * 20))) > 0.4  # the edit is short, the text is not


def test_rows_without_an_id_in_many_ranges(spark):
    rows = [(None, f"{t} {i}") for i, t in enumerate(texts(60, 5))] + [(i, t) for i, t in enumerate(texts(5, 6))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rank = np.arange(1001).astype("u2")
    got = digest.compare_edited(df, rank, bucket_bytes=4000).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got} == {None, *range(5)}
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    prints = Counter(str(digest.Digest.of(t, rank)) for _, t in order)
    assert Counter(r.fingerprint for r in got) == prints
    whole = digest.compare_edited(df, rank).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, whole), key=str)
