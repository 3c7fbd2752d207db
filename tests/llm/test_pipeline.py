"""The pipeline's stages against plain Python, and run() against the stages."""

import zlib

import pytest

import corpus_pipeline as cp
from furrow.llm import lines
from tests.conftest import SF
from tests.llm.test_native import brute_contained, brute_lines
from tests.llm.test_simhash import brute_components, brute_fingerprint

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage got and gave, as lists of rows."""
    top = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in cp.STAGES:
        got = stage(spark, docs, SF)
        got.write.parquet(f"{top}/{name}")
        after = spark.read.parquet(f"{top}/{name}")
        out[name] = docs.collect(), after.collect(), after.columns
        docs = after
    return out


def test_stages_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    assert all(steps[n][2] == cp.COLUMNS for n, _ in cp.STAGES[:-1])


def test_toxic_documents_go(spark, steps):
    before, after, _ = steps["toxicity"]
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone and set(after) <= set(before)
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert len(gone & toxic) >= 0.3 * len(toxic) and len(gone & clean) <= 0.02 * len(clean)


def test_lines(steps):
    before, after, _ = steps["line_dedup"]
    want = brute_lines([(r.doc_id, r.source, r.text) for r in before], 0.02, 5)
    assert sorted((str(r.doc_id), r.text, r.text.count("\n") + 1 if r.text else 0) for r in after) == sorted((i, t, t.count("\n") + 1 if t else 0) for i, t, _ in want)
    assert all(r.n_chars == len(r.text) for r in after) and lines.BLANK


def test_near_duplicates(steps):
    before, after, _ = steps["simhash_near_dedup"]
    groups = brute_components({r.doc_id: brute_fingerprint(r.text) for r in before})
    assert sorted(after) == sorted(r for r in before if groups[r.doc_id] == r.doc_id)


def test_benchmark(spark, steps):
    before, after, _ = steps["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute_contained([(r.doc_id, r.text) for r in before], items)}
    assert sorted(after) == sorted(r for r in before if r.doc_id not in bad)


def test_packing_and_run(spark, steps):
    from furrow.llm.packing import Encoder

    import public_tokenizers

    before, after, _ = steps["packing"]
    encode = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: encode([r.text])[0] + b"\1\0\0\0" for r in before}
    held = {}
    for p in after:
        held.setdefault(p.doc_id, 0)
        held[p.doc_id] += p.length
        ids = want[p.doc_id][4 * p.start : 4 * (p.start + p.length)]
        assert p.ids_crc32 == zlib.crc32(ids) and p.doc_tokens * 4 == len(want[p.doc_id])
    assert held == {d: len(x) // 4 for d, x in want.items()}
    narrow = ["doc_id", "doc_tokens"]
    assert sorted(cp.run(spark, SF).select(narrow).distinct().collect()) == sorted({(r.doc_id, r.doc_tokens) for r in after})
