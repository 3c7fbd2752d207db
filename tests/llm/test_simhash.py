import random

import numpy as np
import xxhash

from furrow.llm import simhash
from furrow.llm.common import Scratch


def brute_fingerprint(text, k=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    w = [x for x in lower.split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=3):
    parent = {i: i for i in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_fingerprint_matches_plain_definition():
    for t in [None, "", " \n", "One", "one TWO", "a b c", "Ä É a b c\x1cd e\x0bf g", "x " * 50, "The cat sat on the mat. " * 7 + "é"]:
        assert simhash.fingerprint(t, 3) == brute_fingerprint(t)


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    for radius in (0, 1, 2, 3, 4, 7):
        a = rng.integers(0, 1 << 63, 300, dtype="u8")
        b = a.copy()
        for i in range(300):
            for bit in rng.choice(64, i % 11, replace=False):
                b[i] ^= np.uint64(1 << int(bit))
        i, j = simhash._link_pairs(np.concatenate([a, b]), np.arange(300), np.arange(300, 600), radius)
        assert i.tolist() == [k for k in range(300) if (int(a[k]) ^ int(b[k])).bit_count() <= radius]
        assert (j - i == 300).all()


def test_links_cut_large_buckets_and_lose_none(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {}
    for i in range(400):  # one bucket family of many near copies, chained
        f = base
        for b in rng.sample(range(64), rng.randint(0, 6)):
            f ^= 1 << b
        fps.setdefault(f, i)
    for i in range(400, 500):
        fps.setdefault(rng.getrandbits(64), i)
    rows = [(f - (1 << 64) if f >> 63 else f, i) for f, i in fps.items()]
    reps = spark.createDataFrame(rows, "fp long, rep long")
    for block in (8, 4096):
        scratch = Scratch(spark, "t")
        found = simhash.connected_components(simhash.links(reps, 3, scratch, block), scratch)
        got = {r.node: r.component for r in found.collect()}
        want = brute_components({i: f for f, i in fps.items()})
        assert {i: got.get(i, i) for i in want} == want


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(200)]
    texts = [None, "", "  ", "One", "one", "two words"]
    for _ in range(40):
        t = [rng.choice(vocab) for _ in range(rng.randint(30, 120))]
        texts.append(" ".join(t))
        for _ in range(rng.randint(0, 3)):
            u = list(t)
            u[rng.randrange(len(u))] = "edit"
            texts.append(" ".join(u))
    texts.append("long " * 20000)
    rows = [(i * 3, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp int")  # clashing extra columns
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    fps = {i: brute_fingerprint(t) for i, t, *_ in rows}
    comps = brute_components(fps)
    assert got == {i: (fps[i], comps[i]) for i in fps}


def test_empty_null_ids_and_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    df = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (7, "q r s t u"), (None, "only here x y")], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    assert got == [("7", "7"), ("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")]


def test_rows_without_doc_id_link_and_one_row_of_a_group_stays(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    edit = [*base[:-1], "edit"]
    a, b = " ".join(base), " ".join(edit)
    while bin(brute_fingerprint(a) ^ brute_fingerprint(b)).count("1") > 3:
        base = [f"w{rng.randrange(500)}" for _ in range(400)]
        a, b = " ".join(base), " ".join([*base[:-1], "edit"])
    rows = [(None, a, "x"), (4, b, "y"), (4, b, "y"), (4, b, "z"), (4, "q r s t u", "y"), (9, a, "x"), (None, "only here x y", "p"), (None, "only here x y", "o"), (2**63 - 1, "z z z", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted([("None", "4"), ("4", "4"), ("4", "4"), ("4", "4"), ("4", "4"), ("9", "4"), ("None", "None"), ("None", "None"), (str(2**63 - 1), str(2**63 - 1))])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, spark.createDataFrame([(4, b, "y"), (4, "q r s t u", "y"), (None, "only here x y", "o"), (2**63 - 1, "z z z", "m")], docs.schema).collect()))
    assert simhash.keep_one(docs.limit(0)).collect() == []
