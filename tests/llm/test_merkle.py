import zlib
from hashlib import sha256

import pytest

from furrow.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Levels of a tree, lowest first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, at):
    """(before, after) of each level up to the root."""
    out = []
    for level in tree[:-1]:
        run = at // 3 * 3
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 3])))
        at //= 3
    return out


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = climb([leaf(r) for r in by[s]])
    top = climb([trees[s][-1][0] for s in sources])
    root = top[-1][0]
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            steps = path(trees[s], i) + path(top, k)
            struck = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", "") if r[4] is not None else None)) if struck else leaf(r)
            for a, b in steps:
                node = h(a + node + b)
            out.append((r[0], leaf(r), trees[s][-1][0], root, h("".join(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


def corpus():
    rows = [(i, f"s{i % 3}" if i % 2 else "big", "en", i, f"line {i}\nnext" if i % 4 else f"one {i}") for i in range(2, 140)]
    rows += [(1000, None, None, None, None), (1001, "", "de", 0, ""), (None, "big", "en", 1, "a\nb"), (None, None, "en", 1, "c")]
    rows += [(7, "big", "en", 1, "again\n"), (7, "big", "en", 1, "again\n"), (7, "big", "en", 1, "other"), (2**60 + 1, "big", "fr", 5, "é\n漢字")]
    rows += [(2000, "long", "en", 3, "word\n" * 40_000), (-5, "big", "en", 2, "\n\n")]
    return rows


@pytest.mark.parametrize("height", [1, 2, 7])
def test_matches_plain_trees(spark, height):
    rows = corpus()
    found = merkle.document_manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), height=height)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)


def test_one_source_one_row_and_many_sources(spark):
    one = [(1, "s", "en", 1, "x")]
    (r,) = merkle.document_manifest(spark.createDataFrame(one, SCHEMA)).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == leaf(one[0]) and r["proof_sha256"] == h("")
    many = [(i, f"host{i // 2}", "en", 1, "x\ny") for i in range(60)]
    found = merkle.document_manifest(spark.createDataFrame(many, SCHEMA), height=2).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(many)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    assert merkle.document_manifest(df.limit(0)).collect() == []
    clash = df.selectExpr("*", "'x' AS leaf", "1 AS idx", "2 AS tree", "3 AS block", "4 AS root")
    found = merkle.document_manifest(clash, height=3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(corpus())


def test_a_changed_text_is_noticed(spark):
    """Of tampered rows exactly those verify whose text has no line feed."""
    rows = corpus()
    found = merkle.document_manifest(spark.createDataFrame(rows, SCHEMA), height=2).collect()
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[4] or "")
    for r in found:
        struck = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        if len({"\n" in t for t in texts[r["doc_id"]]}) == 1:
            assert r["verified"] == (not struck or "\n" not in texts[r["doc_id"]][0])
