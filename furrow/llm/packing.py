"""Packing documents into training sequences along a space-filling curve.

1. Every document gets a hashed vector (counts of hashed byte 4-grams),
   projected to three dimensions by pseudo-random signs and weights taken from
   the hash itself; the three coordinates give its place on a Hilbert curve.
2. Rows are range-sorted by (Hilbert key, doc_id, text hash). A hot key, such
   as that of thousands of exact copies, is split between tasks by doc_id.
3. Each range is one stretch of the curve: its documents are tokenised and laid
   end to end into sequences of ``length`` tokens, cut wherever a sequence is
   full. What is left at the end of a stretch is cut into sequences of powers
   of two, so nothing is padded.

Only one stretch's current sequence is held in memory, beside a batch of texts.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters that the tokenizer takes as space, but for the space itself.
SPACES = "\t\n\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: how the byte-level vocabulary cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BITS = 21


def single_spaced(text: str) -> bool:
    """Whether every space stands alone between two characters that are no space."""
    if not text or "  " in text or text[0] == " " or text[-1] == " ":
        return False
    return not any(c in text and (c + " " in text or " " + c in text) for c in (SPACES[:5] if text.isascii() else SPACES))


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level BPE file as ranks; None where ids do not follow the order of the merges."""
    model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][x + y] for x, y in merges]
    if ids != sorted(ids) or any(c not in byte for w in model["vocab"] if len(w) == 1 for c in w):
        return None
    return {bytes(byte[c] for c in w): i for w, i in model["vocab"].items() if all(c in byte for c in w)}


class Encoder(dict):
    """Token ids as little-endian uint32 bytes; itself a bounded cache of the ids of words after a space.

    The vocabulary cuts a text before every space that stands alone, so a
    single-spaced text is the concatenation of its words' ids. A word that is
    not cached is merged by the file's ranks; any other text, and all if the
    file's ids are no ranks, goes to the tokenizer whole.

    ``as_loaded``: the ids are those of the file's tokenizer with its settings, so
    the content of an added token, as ``<|endoftext|>``, has that token's id.
    Otherwise special tokens' contents are words like others.
    """

    def __init__(self, path: str, limit: int = 400_000, as_loaded: bool = False):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not as_loaded
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if as_loaded or not t.special]
        self.limit = limit
        self.merge = None
        if ranks := merge_ranks(path):
            import tiktoken

            self.merge = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = array("I", self.merge(" " + word)).tobytes()
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        plain = [t.split(" ") if self.merge and single_spaced(t) and not any(a in t for a in self.added) else None for t in texts]
        whole = iter(self._encode([p[0] if p else t for t, p in zip(texts, plain, strict=True)]))
        get = self.__getitem__
        return [next(whole) + b"".join(map(get, p[1:])) if p else next(whole) for p in plain]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker: its tasks share the cached words."""
    return Encoder(path, as_loaded=True)


def project(texts: list[str]) -> np.ndarray:
    """Three coordinates in [0, 2^21) for every text."""
    out = np.zeros((len(texts), 3), "u8")
    for row, text in enumerate(texts):
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), "u1")
        if len(raw) < 4:
            raw = np.concatenate([raw, np.zeros(4 - len(raw), "u1")])
        sums = np.zeros(3)
        n = len(raw) - 3
        for at in range(0, n, 1 << 20):
            part = raw[at : at + (1 << 20) + 3].astype("u4")
            gram = part[:-3] | part[1:-2] << np.uint32(8) | part[2:-1] << np.uint32(16) | part[3:] << np.uint32(24)
            gram *= np.uint32(0x9E3779B1)
            gram ^= gram >> np.uint32(15)
            gram *= np.uint32(0x85EBCA77)
            # 2 x 8 bits of the hash: weights between -128 and 127 of each dimension
            sums += [(gram >> np.uint32(s) & np.uint32(255)).sum(dtype="f8") - 127.5 * len(gram) for s in (24, 16, 8)]
        # the mean moves by 1/sqrt(n); tanh spreads the usual range over all cells
        out[row] = (np.tanh(sums / n / 8.0) * 0.5 + 0.5) * ((1 << BITS) - 1)
    return out


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points (rows x dimensions) of ``bits`` bits a coordinate (Skilling's transform)."""
    x = points.astype("u8").copy()
    dims = x.shape[1]
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        p = q - one
        for i in range(dims):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p).astype("u8")
            x[:, 0] ^= np.where(high, p, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), "u8")
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        turn = np.where(x[:, -1] & q, turn ^ (q - one), turn)
    x ^= turn[:, None]
    key = np.zeros(len(x), "u8")
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << one | (x[:, i] >> np.uint64(b) & one)
    return key.view("i8")


def powers(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Layout:
    """Cuts documents, one after another, into pieces of sequences."""

    def __init__(self, length: int, first: int):
        self.length, self.next = length, first
        self.held: list[tuple] = []
        self.used = 0

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        total, start = len(ids) // 4, 0
        while start < total:
            n = min(total - start, self.length - self.used)
            self.held.append((doc_id, start, n, ids[4 * start : 4 * (start + n)], total))
            self.used += n
            start += n
            if self.used == self.length:
                yield from self._close([self.length])

    def end(self) -> Iterator[tuple]:
        yield from self._close(powers(self.used))

    def _close(self, sizes: list[int]) -> Iterator[tuple]:
        room = iter(sizes)
        left = offset = 0
        sequence = self.next - 1
        for doc_id, start, n, ids, total in self.held:
            done = 0
            while done < n:
                if not left:
                    left, offset, sequence = next(room), 0, sequence + 1
                m = min(left, n - done)
                yield doc_id, start + done, m, ids[4 * done : 4 * (done + m)], total, sequence, offset
                done, left, offset = done + m, left - m, offset + m
        self.next, self.held, self.used = sequence + 1, [], 0


def _runs(texts: list[str], size: int = 1 << 21) -> Iterator[slice]:
    """Slices of neighbouring texts of about ``size`` characters."""
    begin = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield slice(begin, i + 1)
            begin, held = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def pack(
    docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids``: the piece's token ids as little-endian uint32 bytes. A document is
    its text's ids (those of the file's tokenizer as loaded, without special tokens added) and ``end_id``; a null or empty text is ``end_id`` alone.
    Each row of ``docs`` is a document of its own, also where rows repeat or
    their doc_id is null. Sequences are full, or have the length of a power of
    two. ``sequence_id`` is unique, not gapless. No rows in, no rows out. Other
    columns are not read.
    """

    def keys(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(1).to_pylist()
            key = pa.array(hilbert_key(project(texts)) if texts else np.empty(0, "i8"))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), key], names=["doc_id", "text", "key"])

    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )
    end = np.array([end_id], "<u4").tobytes()

    def lay(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = Layout(length, TaskContext.get().partitionId() << 40)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for part in parts:
            ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for run in _runs(texts):
                rows = [p for i, t in zip(ids[run], encoder(tokenizer)(texts[run]), strict=True) for p in layout.add(i, t + end)]
                if rows:
                    yield batch(rows)
        if rows := list(layout.end()):
            yield batch(rows)

    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = text.mapInArrow(keys, "doc_id long, text string, key long")
    order = ["key", "doc_id", F.xxhash64("text")]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(
        lay, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
