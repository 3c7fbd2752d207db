import random
import zlib

import numpy as np
import pytest

from furrow.llm import toxicity

SCHEMA = "doc_id long, text string, score string, source string"


def corpus(seed, n, stem):
    """Random words; toxic ones hold words of a made-up stem, with clean look-alikes elsewhere."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ba", "lo", "ti", "ren", "su", "mek", "da", "ol"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(5, 200))]
        toxic = rng.random() < 0.15
        for _ in range(rng.randint(3, 8) if toxic else 0):
            w.insert(rng.randint(0, len(w)), stem + word())
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def data(spark):
    rows = corpus(3, 1500, "zorq")
    docs = spark.createDataFrame([(i, t, "s", "x") for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows if i % 5], "doc_id long, toxic int, score int")
    return rows, docs, labels


def test_held_out_accuracy(data):
    rows, docs, labels = data
    truth = {i: y for i, _, y in rows}
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == len(rows) and all(r.held_out == held_out(r.doc_id) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    mine = [r for r in out if r.held_out]
    caught = [r.predicted for r in mine if truth[r.doc_id]]
    wrong = [r.predicted for r in mine if not truth[r.doc_id]]
    assert sum(caught) >= 0.97 * len(caught) and sum(wrong) <= 0.01 * len(wrong)


def test_held_out_labels_are_not_learnt(data, spark):
    rows, docs, labels = data
    flipped = spark.createDataFrame([(i, 1 - y if held_out(i) else y, 1) for i, _, y in rows if i % 5], "doc_id long, toxic int, score int")
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.score_documents(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_terms_come_from_all_labelled_training_texts(data):
    _, docs, labels = data
    few, all_ = (toxicity.fit(docs, labels, sample=n)[0] for n in (50, 20_000))
    assert few.terms == all_.terms and any("zorq".startswith(t) or t.startswith("zorq") for t in few.terms)


def test_copies_and_repeated_rows_are_mined_once(spark):
    texts = {0: "one two three four five six", 2: "one two three four five six", 3: "other words that are here alone", 7: "one two three four five six"}
    ids = [i for i in range(60) if not held_out(i)][:4]
    rows = [(i, t) for i, t in zip(ids, texts.values(), strict=True)] * 2 + [(ids[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = toxicity.known_labels(spark.createDataFrame([(i, int(k == 3)) for k, i in enumerate(ids)], "doc_id long, toxic int"))
    found, total = toxicity.mining_rows(docs, known, toxicity.Scratch(spark, "mining"))
    got = found.collect()
    assert total == {0: 3, 1: 1}
    assert sorted((r.text or "", r.toxic) for r in got) == [("", 0), (texts[0], 0), (texts[0], 1), (texts[3], 0)]


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(4)
    y = rng.random(40_000) < 0.2
    votes = np.where(y[:, None], rng.random((40_000, toxicity.VOTERS)) < 0.6, rng.random((40_000, toxicity.VOTERS)) < 0.05)
    votes[:, 1] = votes[:, 0]  # one voter copied
    codes, at, counts = np.unique(votes @ (1 << np.arange(toxicity.VOTERS)), return_inverse=True, return_counts=True)
    patterns = (codes[:, None] >> np.arange(toxicity.VOTERS) & 1).astype(float)
    start = 0.1 + 0.6 * (patterns.sum(1) > 4)
    prior, (rate0, rate1), cov, post = toxicity.fit_label_model(patterns, counts.astype(float), start, anchor=100.0, rounds=20)
    assert abs(prior - 0.2) < 0.02 and np.abs(rate1 - 0.6).max() < 0.05 and np.abs(rate0 - 0.05).max() < 0.02
    r = cov / np.sqrt(np.outer(np.diag(cov), np.diag(cov)))
    assert r[0, 1] > 0.95 and abs(r[2, 3]) < 0.05
    assert ((post[at] > 0.5) == y).mean() > 0.99


def test_edges(data, spark):
    rows, docs, labels = data
    odd = [(9001, None), (9002, ""), (9003, "zorqba " * 30_000), (9004, "!!!"), (9004, "!!!"), (None, "zorqba zorqlo zorqti zorqren")]
    more = docs.unionByName(spark.createDataFrame([(i, t, "s", "x") for i, t in odd], SCHEMA))
    marks = labels.unionByName(spark.createDataFrame([(None, 1, 1), (9001, None, 1), (9001, 0, 1), (9001, 0, 1)], "doc_id long, toxic int, score int"))
    out = toxicity.score_documents(more, marks).collect()
    assert len(out) == len(rows) + 6
    got = {r.doc_id: r for r in out}
    assert got[9001].score == got[9002].score < 0.3 and got[None].predicted == 1 and got[None].held_out is False
    kept = toxicity.remove_toxic(more, marks)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if not r.predicted)


def test_without_labels_or_rows(data, spark):
    _, docs, labels = data
    out = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert len(out) == 1500 and not any(r.predicted for r in out)
    assert toxicity.score_documents(docs.limit(0), labels).collect() == []
    assert toxicity.score_documents(spark.createDataFrame([(1, "you are a stupid idiot, moron and loser " * 3)], "doc_id long, text string"), labels.limit(0)).count() == 1
