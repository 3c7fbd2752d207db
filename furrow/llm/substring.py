"""Substring dedup over words, by difference-cover anchors.

D = {0, 1, 3, 9} is a difference cover modulo 13: for any two places there is
a shift below 13 that takes both to residues in D. So two equal windows of
``width`` words, wherever they start, share a shorter run of ``width - 12``
words that begins at a cover position in both documents.

1. Anchors: runs of ``width - 12`` words at cover positions only (4 of 13) are
   hashed and sent to buckets by hash; a bucket tells which hashes occur twice.
2. Extension: windows around such anchors are hashed whole (96 bits) and sent
   to buckets; a bucket finds every window's first occurrence in (doc_id,
   start) order. All later ones are repeats.
3. Words covered by a repeated window are removed.

Shuffled rows are packed arrays, one row for a stretch of documents and a
bucket. Before they are sent, equal hashes of a stretch are reduced to one, so
a passage that a third of all documents share costs one entry a stretch.
Buckets follow the input's size; a task holds one bucket or one stretch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import Scratch, batches, shuffle_partitions, window_hashes, word_hashes, words

PERIOD = 13
#: Every difference modulo 13 is that of two of these.
COVER = (0, 1, 3, 9)
#: Words of a stretch of documents that is handled at once.
STRETCH = 1 << 20
LOWEST = -(1 << 63)

_SENT = pa.schema([("bucket", pa.int32()), ("k", pa.int64()), ("th", pa.int64()), ("head", pa.binary()), ("body", pa.binary())])
_SENT_SQL = "bucket int, k long, th long, head binary, body binary"
_FOUND = pa.schema([("k", pa.int64()), ("th", pa.int64()), ("at", pa.binary())])
_FOUND_SQL = "k long, th long, at binary"


def buckets_for(docs: DataFrame, bucket_bytes: int, least: int = 16) -> int:
    """Number of buckets: bytes of all texts (one narrow pass) over ``bucket_bytes``, ``least`` at least."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(least, math.ceil(size / bucket_bytes))


def _spans(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    if len(values):
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True)


class _Entries:
    """Hashed places of a stretch: ``h1`` (64 bits), ``h2`` (32 more, of windows), document number, position; documents in (k, th) order."""

    def __init__(self, docs: np.ndarray, doc: np.ndarray, pos: np.ndarray, h1: np.ndarray, h2: np.ndarray | None = None):
        self.docs, self.doc, self.pos, self.h1, self.h2 = docs, doc, pos, h1, h2

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The entries in order of hash, then document and position; and which of them begin a group of equal hashes."""
        if self.h2 is None:
            order = np.argsort(self.h1, kind="stable")
        else:
            order = np.lexsort((self.h2, self.h1))  # stable: entries come in order of document and position
        new = np.ones(len(order), bool)
        if len(order):
            a = self.h1[order]
            new[1:] = a[1:] != a[:-1]
            if self.h2 is not None:
                b = self.h2[order]
                new[1:] |= b[1:] != b[:-1]
        return order, new

    def send(self, take: np.ndarray, buckets: int) -> Iterator[tuple]:
        """Packed rows of the entries ``take`` (in order of document and position), one a bucket."""
        squeeze = zstandard.ZstdCompressor(level=1).compress
        bucket = (self.h1[take] >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        take, bucket = take[order], bucket[order]
        for x, y in _spans(bucket):
            mine = take[x:y]
            doc = self.doc[mine]
            first, end = np.array(list(_spans(doc))).T
            count = (end - first).astype("<u4")
            head = self.docs[doc[first]].astype("<i8").tobytes()
            rest = count.tobytes() + self.pos[mine].astype("<u4").tobytes()
            hashes = self.h1[mine].astype("<u8").tobytes() + (b"" if self.h2 is None else self.h2[mine].astype("<u4").tobytes())
            yield int(bucket[x]), None, None, len(first).to_bytes(4, "little") + squeeze(head + rest), hashes

    def places(self, at: np.ndarray) -> Iterator[tuple]:
        """``(k, th, positions)`` of the entries ``at`` (in order of document)."""
        doc = self.doc[at]
        for x, y in _spans(doc):
            k, th = self.docs[doc[x]]
            yield int(k), int(th), self.pos[at[x:y]].astype("<u4").tobytes()


def _unpack(rows: list[tuple[bytes, bytes]], wide: bool) -> _Entries:
    """The entries of all rows of a bucket, in order of document and position."""
    docs, doc, pos, h1, h2, base = [], [], [], [], [], 0
    for head, body in rows:
        n = int.from_bytes(head[:4], "little")
        raw = zstandard.ZstdDecompressor().decompress(head[4:])
        docs.append(np.frombuffer(raw, "<i8", 2 * n).reshape(n, 2))
        count = np.frombuffer(raw, "<u4", n, 16 * n)
        pos.append(np.frombuffer(raw, "<u4", -1, 20 * n))
        doc.append(np.repeat(np.arange(base, base + n), count))
        m = len(pos[-1])
        h1.append(np.frombuffer(body, "<u8", m))
        if wide:
            h2.append(np.frombuffer(body, "<u4", m, 8 * m))
        base += n
    ids, number = np.unique(np.concatenate(docs), axis=0, return_inverse=True)
    doc, pos = number.reshape(-1)[np.concatenate(doc)], np.concatenate(pos)
    order = np.lexsort((pos, doc))
    return _Entries(ids, doc[order], pos[order], np.concatenate(h1)[order], np.concatenate(h2)[order] if wide else None)


def _later(e: _Entries) -> np.ndarray:
    """Entries of a group that are not at the place of its first one, in order of document."""
    order, new = e.groups()
    first = order[new][np.cumsum(new) - 1]
    later = (e.doc[order] != e.doc[first]) | (e.pos[order] != e.pos[first])
    return np.sort(order[later])


def _repeated(e: _Entries) -> np.ndarray:
    """Entries of groups of two or more, in order of document."""
    order, new = e.groups()
    number = np.cumsum(new) - 1
    return np.sort(order[np.bincount(number)[number] > 1]) if len(order) else order


def _reduce(wide: bool):
    """Per bucket: the places of later (wide) or of repeated entries. Rows that carry places already pass."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(rows: list) -> Iterator[pa.RecordBatch]:
            if rows:
                e = _unpack(rows, wide)
                yield from batches(e.places(_later(e) if wide else _repeated(e)), _FOUND)

        held, now = [], None
        for part in parts:
            passed = []
            for bucket, k, th, head, body in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if head is None:
                    passed.append((k, th, body))
                    continue
                if bucket != now:
                    yield from close(held)
                    held, now = [], bucket
                held.append((head, body))
            yield from batches(passed, _FOUND)
        yield from close(held)

    return run


def _squeeze(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their text (last column) as compressed UTF-8, for a shuffle."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for part in parts:
        z = pa.array([squeeze(t.as_py().encode("utf-8", "surrogatepass")) for t in part.column(part.num_columns - 1)], pa.binary())
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], z], names=[*part.schema.names[:-1], "z"])


def _expand(z: bytes) -> list[bytes]:
    """The words of a compressed text."""
    return zstandard.ZstdDecompressor().decompress(z).split()


def _stretches(parts: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Documents ``(k, th, hashes of the words, places)`` of about ``STRETCH`` words, in (k, th) order; repeated rows once."""
    held: dict[tuple, tuple] = {}
    size = 0
    for part in parts:
        columns = [part.column(i) for i in range(part.num_columns)]
        for i in range(part.num_rows):
            k, th, text, *at = (c[i].as_py() for c in columns)
            if (k, th) not in held:
                held[k, th] = (word_hashes(_expand(text) if isinstance(text, bytes) else words(text)), *at)
                size += len(held[k, th][0])
            if size >= STRETCH:
                yield [(*key, *held[key]) for key in sorted(held)]
                held, size = {}, 0
    if held:
        yield [(*key, *held[key]) for key in sorted(held)]


def _anchors(docs: list[tuple], run: int) -> _Entries:
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    h, doc, pos = [np.empty(0, "u8")], [np.empty(0, "i8")], [np.empty(0, "i8")]
    for i, (_, _, hashes) in enumerate(docs):
        n = len(hashes) - run + 1
        if n > 0:
            at = np.flatnonzero(np.resize(cover, n))
            h.append(window_hashes(hashes, run)[at])
            doc.append(np.full(len(at), i))
            pos.append(at)
    return _Entries(np.array([d[:2] for d in docs], "i8"), np.concatenate(doc), np.concatenate(pos), np.concatenate(h))


def _windows(docs: list[tuple], width: int) -> _Entries:
    """Windows that hold a repeated anchor."""
    reach = PERIOD - 1
    h1, h2, doc, pos = [np.empty(0, "u8")], [np.empty(0, "u4")], [np.empty(0, "i8")], [np.empty(0, "i8")]
    for i, (_, _, hashes, at) in enumerate(docs):
        n = len(hashes) - width + 1
        if n > 0:
            anchors = np.concatenate([np.frombuffer(x, "<u4") for x in at]).astype("i8")
            edge = np.zeros(n + 1, "i8")
            np.add.at(edge, np.clip(anchors - reach, 0, n), 1)
            np.add.at(edge, np.clip(anchors + 1, 0, n), -1)
            starts = np.flatnonzero(np.cumsum(edge[:n]) > 0)
            h1.append(window_hashes(hashes, width)[starts])
            h2.append((window_hashes(hashes, width, seed=7)[starts] >> np.uint64(32)).astype("u4"))
            doc.append(np.full(len(starts), i))
            pos.append(starts)
    return _Entries(np.array([d[:2] for d in docs], "i8"), *map(np.concatenate, (doc, pos, h1, h2)))


def _sender(make, wide: bool, buckets: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for docs in _stretches(parts):
                e = make(docs)
                order, new = e.groups()
                yield from e.send(np.sort(order[new]), buckets)
                # what the stretch alone shows needs no bucket; such rows are spread evenly
                for k, th, at in e.places(_later(e) if wide else _repeated(e)):
                    yield -1 - (th & 0x3FFF), k, th, None, at

        yield from batches(rows(), _SENT, 64)

    return run


def _bucketed(sent: DataFrame, wide: bool, buckets: int) -> DataFrame:
    """What the buckets find; there are as many tasks as buckets, or as the session says if that is more."""
    tasks = max(buckets, shuffle_partitions(sent.sparkSession))
    return sent.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_reduce(wide), _FOUND_SQL)


def repeated_windows(base: DataFrame, squeezed: DataFrame, width: int, scratch: Scratch, bucket_bytes: int) -> DataFrame:
    """``(k, th, at)``: starts of the windows of each document that an earlier place holds too; several rows a document."""
    if width < PERIOD:
        raise ValueError(f"windows need at least {PERIOD} words")
    buckets = buckets_for(base, bucket_bytes)
    run = width - PERIOD + 1
    anchors = _bucketed(base.mapInArrow(_sender(lambda d: _anchors(d, run), False, buckets), _SENT_SQL), False, buckets)
    anchors = scratch.write(anchors, "anchors")
    scratch.release()
    near = squeezed.join(anchors.groupBy("k", "th").agg(F.collect_list("at").alias("at")), ["k", "th"]).select("k", "th", "z", "at")
    found = scratch.write(_bucketed(near.mapInArrow(_sender(lambda d: _windows(d, width), True, buckets), _SENT_SQL), True, buckets), "windows")
    scratch.drop("anchors")
    scratch.release()
    return found


def remove_repeats(
    docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 48 << 20
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_removed, text`` (the kept words joined by one space).

    A word is removed if a window of ``width`` consecutive words that covers it
    occurs earlier too: in a document with a smaller doc_id, or earlier in the
    same one; windows are those of the input. Words are runs of characters other
    than blanks, unchanged; a null or empty text has none, and an empty result.
    Rows with one doc_id and different texts are ordered by the texts' hashes;
    rows that are equal are one document, returned as often as it is there. A
    null doc_id counts as the smallest. Other columns are not read. No rows in,
    no rows out.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    base = base.select("doc_id", F.coalesce("doc_id", F.lit(LOWEST)).alias("k"), F.xxhash64("text").alias("th"), "text")
    squeezed = base.mapInArrow(_squeeze, "doc_id long, k long, th long, z binary")
    found = repeated_windows(base.select("k", "th", "text"), squeezed, width, scratch, bucket_bytes)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for i in range(part.num_rows):
                doc_id, z, at = (part.column(c)[i].as_py() for c in range(3))
                tokens = _expand(z)
                n = len(tokens)
                if at:
                    starts = np.concatenate([np.frombuffer(x, "<u4") for x in at]).astype("i8")
                    edge = np.zeros(n + 1, "i8")
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + width, -1)
                    keep = np.cumsum(edge[:n]) == 0
                    tokens = [w for w, k in zip(tokens, keep.tolist(), strict=True) if k]
                out.append((doc_id, n, n - len(tokens), b" ".join(tokens).decode("utf-8", "surrogatepass")))
            yield from batches(out, schema)

    joined = squeezed.join(found.groupBy("k", "th").agg(F.collect_list("at").alias("at")), ["k", "th"], "left")
    return joined.select("doc_id", "z", "at").mapInArrow(cut, "doc_id long, n_words long, n_removed long, text string")
