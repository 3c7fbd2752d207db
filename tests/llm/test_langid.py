import unicodedata
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from furrow.llm import langid
from furrow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_profile(texts, size):
    """The ranked n-grams, one letter string at a time."""
    found = Counter()
    for text in texts:
        word = ""
        kinds = [unicodedata.category(c)[0] for c in text.lower()]
        if "L" not in kinds:
            continue
        for c, kind in zip(text.lower() + " ", [*kinds, "Z"], strict=True):
            if kind == "L" or kind == "M" and word:
                word += c
            elif word:
                padded = f" {word} "
                found.update(word)
                found.update(padded[i : i + 2] for i in range(len(padded) - 1))
                found.update(padded[i : i + 3] for i in range(len(padded) - 2))
                word = ""
    return [g for g, _ in sorted(found.items(), key=lambda x: (-x[1], x[0].ljust(3, "\0")))][:size]


def plain(rows, size):
    """rows: (doc_id, text, lang) -> doc_id -> (held out, language, score)."""
    out = {}
    by = {}
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in rows}
    for d, text, lang in rows:
        if text is not None and lang is not None and not held[d]:
            by.setdefault(lang, []).append(text)
    profiles = {k: p for k, v in sorted(by.items()) if (p := plain_profile(v, size))}
    places = {k: {g: i for i, g in enumerate(p)} for k, p in profiles.items()}
    for d, text, _ in rows:
        own = plain_profile([text or ""], size)
        if not own or not profiles:
            out[d] = (held[d], "und", 0.0)
            continue
        far = {k: sum(abs(p[g] - i) if g in p else size for i, g in enumerate(own)) / (size * len(own)) for k, p in places.items()}
        best = min(far, key=lambda k: (far[k], k.encode()))
        after = min([1.0, *(v for k, v in far.items() if k != best)])
        out[d] = (held[d], best, 1 - far[best] / after if after else 0.0)
    return out


def same(found, want):
    assert len(found) == len(want)
    for r in found:
        held, lang, score = want[r["doc_id"]]
        assert (r["held_out"], r["lang_pred"]) == (held, lang), r
        assert r["score"] == pytest.approx(score, abs=1e-9)


def test_whole_table_matches_plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    found = QUERIES["op11_language_id"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    same(found.collect(), plain(rows, 300))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = found.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 200 and right >= 0.99 * total


EDGE = [
    (1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "the cat and the dog", "en"), (4, None, "en"), (5, "", "fr"),
    (6, "123 !? ́", "en"), (7, "你好 世界", "zh"), (8, "THE CAT", None), (9, "été L'ÉTÉ", "fr"), (10, "the " * 50_000, "en"),
    (11, "zzz qqq", None), (12, "le chat", "fr"), (13, "the dog", "en"), (14, "chien", None), (15, "\U0001f600", "xx"),
]


def test_edges_and_repeats(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string")
    want = plain(EDGE, 50)
    assert want[6][1] == want[4][1] == want[5][1] == want[15][1] == "und"
    for parts in (1, 5):
        same(langid.identify(df.repartition(parts), 50).collect(), want)
    twice = df.union(df.where("doc_id IN (11, 14)"))
    assert langid.identify(twice, 50).count() == len(EDGE) + 2


def test_null_ids_extra_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "the cat", "en", 0.5, "x"), (1, "le chat", "fr", 0.1, "y")], "doc_id long, text string, lang string, score double, gram string")
    found = {r["doc_id"]: r for r in langid.identify(df).collect()}
    assert found[None]["held_out"] is False and found[None]["lang_pred"] == "en" and found[1]["lang_pred"] == "fr"
    assert langid.identify(df.limit(0)).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(unlabelled).collect()] == [("und", 0.0)] * 2


def test_many_languages_in_several_passes(spark, monkeypatch):
    want = plain(EDGE, 50)
    monkeypatch.setattr(langid, "LANGUAGES_AT_ONCE", 1)
    monkeypatch.setattr(langid, "HELD_CHARS", 10)
    monkeypatch.setattr(langid, "HELD_GRAMS", 3)
    same(langid.identify(spark.createDataFrame(EDGE, "doc_id long, text string, lang string"), 50).collect(), want)


def test_columns_other_than_text_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    profiles = langid.fit_profiles(docs)
    a = {tuple(r) for r in langid.predict(docs, profiles).collect()}
    b = {tuple(r) for r in langid.predict(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None)), profiles).collect()}
    assert a == b
