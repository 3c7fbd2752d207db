import random

import pytest

from furrow.llm import substring
from furrow.llm.common import words


def brute(docs, width):
    """(doc_id, n_words, n_removed, kept) by the plain definition."""
    first, covered = {}, {}
    order = sorted(docs, key=lambda d: (substring.LOWEST if d[0] is None else d[0]))
    for n, (_, t) in enumerate(order):
        w = words(t)
        covered[n] = [False] * len(w)
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            if key in first:
                covered[n][i : i + width] = [True] * width
            else:
                first[key] = (n, i)
    out = []
    for n, (d, t) in enumerate(order):
        w = words(t)
        kept = [x for x, c in zip(w, covered[n], strict=True) if not c]
        out.append((d, len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return sorted(out, key=str)


def corpus(seed, vocab=30):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyzäöü") + str(rng.randint(0, vocab))
    passages = [[word() for _ in range(rng.randint(18, 60))] for _ in range(8)]
    docs = []
    for d in range(120):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += [word() for _ in range(rng.randint(0, 25))]
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randint(0, 5)
                w += p[a : a + rng.randint(15, 60)]
        docs.append((d * 2, rng.choice([" ", "\n", "  "]).join(w)))
    copies = rng.sample(docs, 10)
    docs += [(d + 1, t) for d, t in copies] + [(1000, None), (1001, ""), (1002, "x " * 3000), (1003, "p q " * 500), (1004, "one two"), (1005, "\x1cA a\xa0b")]
    return docs


def test_cover():
    for i in range(13):
        for j in range(13):
            assert any((i + s) % 13 in substring.COVER and (j + s) % 13 in substring.COVER for s in range(13))


@pytest.mark.parametrize("width", [20, 13])
def test_against_brute_force(spark, monkeypatch, width):
    docs = corpus(width)
    rows = [(d, t, "k", 5) for d, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, th string, n_words int").repartition(5)
    got = sorted(map(tuple, substring.remove_repeats(df, width, bucket_bytes=5000).collect()), key=str)
    assert got == brute(docs, width)
    assert sum(r[2] for r in got) > 1000


def test_small_stretches():
    docs = [(d, d, substring.word_hashes(words(t))) for d, t in corpus(5)]
    e = substring._anchors(docs, 8)
    order, new = e.groups()
    sent = list(e.send(substring.np.sort(order[new]), 7))
    back = [x for b in range(7) for x in [substring._unpack([(h, y) for bucket, _, _, h, y in sent if bucket == b], False)]]
    assert sum(len(x.h1) for x in back) == new.sum()
    assert {(int(k), int(p), int(h)) for x in back for k, p, h in zip(x.docs[x.doc][:, 0], x.pos, x.h1, strict=True)} == {
        (int(e.docs[e.doc[i]][0]), int(e.pos[i]), int(e.h1[i])) for i in order[new]
    }


def test_repeated_rows_null_ids_and_nothing(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(3, t), (3, t), (None, t + " end"), (9, t)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring.remove_repeats(df).collect()), key=str)
    assert got == [(3, 30, 30), (3, 30, 30), (9, 30, 30), (None, 31, 0)]
    df = spark.createDataFrame([(3, t), (3, t)], "doc_id long, text string")
    assert [r.n_removed for r in substring.remove_repeats(df).collect()] == [0, 0]
    assert substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
