import random
import zlib

import numpy as np
import pytest

from furrow.llm import packing

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_cached_words_give_the_tokenizers_ids():
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\t", "\r\n", "　", "\xa0", "\x1c", "a", "B", "don't", "'s", "été", "ß", "12", "$$$", "😀", "一", "．", "<|endoftext|>", "x́"]
    texts = ["", " ", "a", " a", "a ", "a\n", "\na b", "a \nb", "plain words here, and there.\nNext line"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(800)]
    texts += [" ".join(rng.choice(bits[8:]) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    texts += [" ".join("".join(chr(rng.choice([rng.randint(33, 0x24F), rng.randint(0x370, 0x9FFF), rng.randint(0x1F300, 0x1FAFF)])) for _ in range(rng.randint(1, 8))) for _ in range(40)) for _ in range(150)]
    for limit in (10, 400_000):
        encode = packing.Encoder(PATH, limit)
        got = [np.frombuffer(b, "<u4").tolist() for at in range(0, len(texts), 50) for b in encode(texts[at : at + 50])]
        assert got == reference_ids(texts)


def test_hilbert_neighbours_are_one_step_apart():
    for dims, bits in ((2, 3), (3, 2)):
        grid = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        order = np.argsort(hk := packing.hilbert_key(grid, bits))
        assert sorted(hk.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[order].astype(int), axis=0)).sum(1) == 1).all()


def test_pack_is_an_exact_round_trip(spark):
    rng = random.Random(4)
    texts = [None, "", "x", "same text here"] + ["same text here"] * 30
    texts += [" ".join(f"w{rng.randint(0, 50)}" for _ in range(rng.randint(1, 900))) for _ in range(60)]
    texts.append("long " * 30000)
    rows = [(i if i != 5 else None, t, 9) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    pieces = packing.pack(docs, PATH, length=256).collect()
    want = {i: np.array(x + [1], "<u4").tobytes() for (i, *_), x in zip(rows, reference_ids([t or "" for t in texts]), strict=True)}
    got, seqs = {}, {}
    for p in pieces:
        got.setdefault(p.doc_id, []).append((p.start, p.length, p.ids))
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert p.doc_tokens * 4 == len(want[p.doc_id]) and len(p.ids) == 4 * p.length
    for i, ids in want.items():
        at, joined = 0, b""
        for start, n, part in sorted(got[i], key=lambda x: x[:2]):
            assert start == at and n > 0
            at, joined = at + n, joined + part
        assert joined == ids
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 256 or at < 256 and at.bit_count() == 1
    assert zlib.crc32(want[0]) == zlib.crc32(b"\x01\x00\x00\x00")


def test_neighbours_on_the_curve_are_alike():
    rng = random.Random(1)
    a = [" ".join(rng.choice(["the", "and", "of", "house"]) for _ in range(200)) for _ in range(10)]
    b = [" ".join(rng.choice(["zug", "über", "ßen", "xyz"]) for _ in range(200)) for _ in range(10)]
    order = np.argsort(packing.hilbert_key(packing.project(a + b)))
    side = (order >= 10).astype(int)
    assert np.abs(np.diff(side)).sum() <= 3


def test_pack_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_added_tokens_have_their_ids_as_in_the_tokenizer_as_loaded(spark):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "<|endoftext|> <|endoftext|>", "<|endoftext |> no", "two  spaces <|endoftext|>", "plain words here"]
    want = [e.ids for e in loaded.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.Encoder(PATH, as_loaded=True)(texts)] == want
    pieces = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH, length=4).collect()
    got = {i: b"".join(p.ids for p in sorted(pieces, key=lambda p: p.start) if p.doc_id == i) for i in range(len(texts))}
    assert got == {i: np.array([*x, 1], "<u4").tobytes() for i, x in enumerate(want)}
