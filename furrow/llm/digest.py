"""Document fingerprints: improbable-feature digests.

Every window of 64 bytes has an entropy level (0 to 1000). How rare a level is
among all windows of the corpus is its rank (fitted by one pass, a table of
1001 numbers). In every run of 64 consecutive windows the leftmost window of
the rarest level gains a point; windows with 16 points or more are the text's
features. Where more than 256 windows in a row hold none (repeated words), and
in a text that has none (a short one), every window with a point is one, so only
empty texts have empty digests. A text below 512 bytes has few windows that an
edit leaves whole, so all its runs of 8 bytes are features too. Features go, 160 at a time, into a chain of
Bloom filters of 2048 bits with five bits each. Likeness compares filters by the bits they share,
normalised by what chance alone would share.

Levels are computed in integers, so a window's level depends on its bytes only.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import Scratch, batches, shuffle_partitions
from furrow.llm.substring import LOWEST, buckets_for

WINDOW, RUN, LEVELS = 64, 64, 1001
POINTS, FEATURES, BITS, HASHES = 16, 160, 2048, 5
#: A text of fewer bytes than ``SHORT`` is also known by all its windows of ``NARROW`` bytes.
SHORT, NARROW = 512, 8
#: More windows than this in a row without a feature count each that has a point.
GAP = 4 * RUN
_SCALE = 1 << 20
_PLOG = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 1)], "i8")
_MORE = np.diff(_PLOG, prepend=0)
_MOST = 6 * WINDOW * _SCALE
#: Bytes that are handled at once; many short texts, or a part of a long one.
_PART = 1 << 14
_PLACE = 21


def levels(raw: np.ndarray) -> np.ndarray:
    """Entropy level of the window at every place of at least ``WINDOW`` bytes."""
    if len(raw) > _PART + WINDOW:
        return np.concatenate([levels(raw[at : at + _PART + WINDOW - 1]) for at in range(0, len(raw) - WINDOW + 1, _PART)])
    n = len(raw)
    order = np.argsort(raw, kind="stable")
    key = raw[order].astype("i4") * np.int32(n + 2 * WINDOW) + order.astype("i4")
    place = np.arange(n)
    before, after = np.empty(n, "i4"), np.empty(n, "i4")
    first = np.searchsorted(key, key - np.int32(WINDOW - 1))  # the first equal byte in the window that ends here
    before[order] = place - first + 1
    # a byte's window reaches the later ones whose own windows reach back to it
    after[order] = np.cumsum(np.bincount(first, minlength=n)) - place
    total = np.empty(n - WINDOW + 1, "i8")
    total[0] = _PLOG[np.bincount(raw[:WINDOW])].sum()
    total[1:] = _MORE[before[WINDOW:]] - _MORE[after[: n - WINDOW]]
    return (_MOST - np.cumsum(total)) * (LEVELS - 1) // _MOST


def _groups(sizes: list[int]) -> Iterator[slice]:
    """Neighbours that are handled together, of about ``_PART`` in all."""
    begin = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > _PART:
            yield slice(begin, i)
            begin = i
            held = 0
        held += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def ranks_of(raws: list[np.ndarray], rank: np.ndarray) -> list[np.ndarray]:
    """The ranks of all windows of each text; a text of fewer bytes than a window has none."""
    out = []
    for group in _groups([len(r) for r in raws]):
        joined = np.concatenate(raws[group])
        found = rank[levels(joined)] if len(joined) >= WINDOW else np.empty(0, "u2")
        at = 0
        for raw in raws[group]:  # windows that reach into the next text belong to neither
            out.append(found[at : at + max(0, len(raw) - WINDOW + 1)])
            at += len(raw)
    return out


def _points(ranks: np.ndarray) -> np.ndarray:
    """The points of the windows of one text."""
    n = len(ranks)
    runs = max(1, n - RUN + 1)
    points = np.zeros(n, "i8")
    for at in range(0, runs if n else 0, _PART):
        part = ranks[at : at + _PART + RUN - 1].astype("u4") << np.uint32(_PLACE) | np.arange(min(_PART + RUN - 1, n - at), dtype="u4")
        best = _least(part, min(RUN, len(part))) & np.uint32((1 << _PLACE) - 1)
        points[at : at + len(part)] += np.bincount(best, minlength=len(part))
    return points


def _features(ranks: np.ndarray) -> np.ndarray:
    """Places of the features of one text, in order."""
    return np.flatnonzero(_points(ranks) >= min(POINTS, max(1, len(ranks) - RUN + 1)))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def features_of(ranks: list[np.ndarray]) -> list[np.ndarray]:
    """Places of the features of each text, in order."""
    out: list[np.ndarray] = [np.empty(0, "i8")] * len(ranks)
    usual = [i for i, r in enumerate(ranks) if RUN + POINTS <= len(r) <= _PART]
    for i, r in enumerate(ranks):
        if len(r) and not RUN + POINTS <= len(r) <= _PART:
            out[i] = _features(r)
    for group in _groups([len(ranks[i]) for i in usual]):
        mine = [ranks[i] for i in usual[group]]
        sizes = np.array([len(r) for r in mine])
        ends = np.cumsum(sizes)
        joined = np.concatenate(mine).astype("u4") << np.uint32(_PLACE) | np.arange(ends[-1], dtype="u4")
        best = _least(joined, RUN) & np.uint32((1 << _PLACE) - 1)
        inside = np.ones(ends[-1], bool)  # runs that do not reach into the next text
        for e in ends.tolist():
            inside[e - RUN + 1 : e] = False
        found = np.flatnonzero(np.bincount(best[inside[: len(best)]], minlength=ends[-1]) >= POINTS)
        for i, begin, places in zip(usual[group], (ends - sizes).tolist(), np.split(found, np.searchsorted(found, ends[:-1])), strict=True):
            out[i] = places - begin
    return out


def places_of(ranks: list[np.ndarray]) -> list[np.ndarray]:
    """Places of the windows that go into the digest of each text, in order.

    Its features; and every window with a point where more than ``GAP`` windows in a
    row hold no feature, or the whole text has none.
    """
    out = features_of(ranks)
    for i, r in enumerate(ranks):
        if not len(r) or len(out[i]) and len(r) <= GAP:
            continue
        ends = np.concatenate([[-1], out[i], [len(r)]])
        wide = np.flatnonzero(np.diff(ends) - 1 > (GAP if len(out[i]) else 0))
        if len(wide):
            points = _points(r)
            out[i] = np.union1d(out[i], np.concatenate([ends[k] + 1 + np.flatnonzero(points[ends[k] + 1 : ends[k + 1]]) for k in wide]))
    return out


class Digest:
    """A chain of Bloom filters: ``filters`` (rows of bytes) and the features in each."""

    def __init__(self, filters: np.ndarray, counts: list[int]):
        self.filters, self.counts = filters, counts

    @classmethod
    def of(cls, text: str, rank: np.ndarray) -> Digest:
        data = text.encode("utf-8", "surrogatepass")
        return cls.build(data, places_of(ranks_of([np.frombuffer(data, "u1")], rank))[0])

    @classmethod
    def build(cls, data: bytes, places: np.ndarray) -> Digest:
        """The digest of a text by its windows at ``places`` and, if it is short, its narrow ones (or its few bytes)."""
        parts = [data[i : i + WINDOW] for i in places.tolist()]
        if len(data) < SHORT:
            parts += [data[i : i + NARROW] for i in range(max(1, len(data) - NARROW + 1))] if data else []
        hashes = np.array(list(dict.fromkeys(xxhash.xxh64_intdigest(p) for p in parts)), "u8")
        chain = [hashes[i : i + FEATURES] for i in range(0, len(hashes), FEATURES)]
        filters = np.zeros((len(chain), BITS), bool)
        for row, held in zip(filters, chain, strict=True):
            for k in range(HASHES):
                row[(held >> np.uint64(11 * k)) & np.uint64(BITS - 1)] = True
        return cls(np.packbits(filters, axis=1), [len(c) for c in chain])

    def __str__(self) -> str:
        return ".".join(base64.b64encode(c.to_bytes(2, "little") + f.tobytes()).decode() for c, f in zip(self.counts, self.filters, strict=True))

    @classmethod
    def parse(cls, text: str) -> Digest:
        raw = [base64.b64decode(x) for x in text.split(".")] if text else []
        return cls(np.array([list(x[2:]) for x in raw], "u1").reshape(len(raw), BITS // 8), [int.from_bytes(x[:2], "little") for x in raw])


def _overlap(a: np.ndarray, b: np.ndarray) -> float:
    x, y = int(np.bitwise_count(a).sum()), int(np.bitwise_count(b).sum())
    chance, most = x * y / BITS, min(x, y)
    return max(0.0, (int(np.bitwise_count(a & b).sum()) - chance) / (most - chance)) if most > chance else 1.0


def likeness(a: Digest, b: Digest) -> float:
    """0 to 1. Each filter of the shorter chain is set against the best filter, or two neighbouring ones, of the other.

    Neighbours count because an edit moves later features across the ends of
    filters. Two empty digests are alike (1); an empty one is like no other (0).
    """
    if (sum(b.counts), b.filters.tobytes()) < (sum(a.counts), a.filters.tobytes()):
        a, b = b, a
    if not a.counts or not b.counts:
        return float(not a.counts and not b.counts)
    others = [*b.filters, *(b.filters[:-1] | b.filters[1:])]
    scores = [max(_overlap(f, g) for g in others) for f in a.filters]
    return min(1.0, float(np.average(scores, weights=a.counts)))


def fit_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank of each entropy level, the rarest first, over all windows of all texts (ties: the lower level first)."""
    schema = pa.schema([("level", pa.int32()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, every = np.zeros(LEVELS, "i8"), np.arange(LEVELS, dtype="u2")
        for part in parts:
            raws = [np.frombuffer((t.as_py() or "").encode("utf-8", "surrogatepass"), "u1") for t in part.column(0)]
            for found in ranks_of(raws, every):
                count += np.bincount(found, minlength=LEVELS)
        seen = np.flatnonzero(count)
        yield from batches(zip(seen.tolist(), count[seen].tolist(), strict=True), schema)

    total = np.zeros(LEVELS, "i8")
    for level, n in docs.select(text_col).mapInArrow(run, "level int, n long").groupBy("level").agg(F.sum("n")).collect():  # 1001 rows at most
        total[level] = n
    rank = np.empty(LEVELS, "u2")
    rank[np.lexsort((np.arange(LEVELS), total))] = np.arange(LEVELS)
    return rank


def fingerprints(docs: DataFrame, rank: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row. Null texts are empty, and empty ones have an empty fingerprint."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([str(Digest.of(t.as_py() or "", rank)) for t in part.column(1)], pa.string())], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


class _Read:
    """A text with what its edits reuse: its bytes, the ranks of its windows and its digest."""

    def __init__(self, text: str, data: bytes, ranks: np.ndarray, digest: Digest):
        self.text, self.data, self.ranks, self.digest = text, data, ranks, digest


def _read(texts: list[str], rank: np.ndarray) -> list[_Read]:
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    ranks = ranks_of([np.frombuffer(d, "u1") for d in data], rank)
    return [_Read(t, d, r, Digest.build(d, f)) for t, d, r, f in zip(texts, data, ranks, places_of(ranks), strict=True)]


def _compare(pairs: list[tuple], rank: np.ndarray) -> Iterator[tuple]:
    """The result rows of ``(doc_id, text read, next text read)``.

    An edited text is a beginning of one text and a beginning of the next, so
    the ranks of its windows are theirs, but for the windows across the seam.
    """
    new, seams, cut = [], [], []
    for _, old, following in pairs:
        n = len(old.text) // 3
        kept = old.data if not n else old.text[: len(old.text) - n].encode("utf-8", "surrogatepass")
        added = following.text[:n].encode("utf-8", "surrogatepass")
        new.append(kept + added)
        cut.append((len(kept), len(added)))
        seams.append(np.frombuffer(kept[max(0, len(kept) - WINDOW + 1) :] + added[: WINDOW - 1], "u1"))
    ranks = [
        np.concatenate([old.ranks[: max(0, x - WINDOW + 1)], seam, following.ranks[: max(0, y - WINDOW + 1)]])
        for (_, old, following), seam, (x, y) in zip(pairs, ranks_of(seams, rank), cut, strict=True)
    ]
    for (doc_id, old, following), data, places in zip(pairs, new, places_of(ranks), strict=True):
        other = Digest.build(data, places)
        sha = hashlib.sha256(data).hexdigest()
        yield doc_id, len(old.text), sha, str(old.digest), str(other), likeness(old.digest, other), likeness(old.digest, following.digest)


_FIRST, _LAST = 1, 2
_RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
_RESULT += [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_RESULT_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_edited(docs: DataFrame, rank: np.ndarray, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 128 << 20) -> DataFrame:
    """Fingerprints of all texts and of their edits, and their likeness to the edit and to the next document.

    The next document is that with the next smaller doc_id; after the smallest
    comes the largest (a single document is its own next one). Rows with equal
    doc_ids are ordered by their texts' hashes; a null doc_id is the smallest.
    A null text is empty. Other columns are not read. No rows in, no rows out.

    Rows are range-partitioned by (doc_id, text hash), so rows without a doc_id
    are split too. A task compares neighbours as they pass and hands on its
    first and last document; those are joined afterwards, one pair a task.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.coalesce("doc_id", F.lit(LOWEST)).desc(), F.xxhash64("text").desc()]
    ranges = buckets_for(base, bucket_bytes, least=shuffle_partitions(spark))
    result, schema = pa.schema(_RESULT), pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string()), *_RESULT])
    nothing = (None,) * (len(_RESULT) - 1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()

        def rows() -> Iterator[tuple]:
            last = None
            for part in parts:
                ids, column = part.column(0).to_pylist(), part.column(1)
                for group in _groups([s.as_py() for s in pc.binary_length(column)]):
                    pairs = []
                    for doc_id, now in zip(ids[group], _read(column[group].to_pylist(), rank), strict=True):
                        if last:
                            pairs.append((*last, now))
                        else:
                            yield _FIRST, at, now.text, doc_id, *nothing
                        last = doc_id, now
                    for row in _compare(pairs, rank):
                        yield 0, at, None, *row
            if last:
                yield _LAST, at, last[1].text, last[0], *nothing

        yield from batches(rows(), schema, 1024)

    def across(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                for doc_id, *both in zip(*part.columns, strict=True):
                    yield from _compare([(doc_id.as_py(), *_read([t.as_py() for t in both], rank))], rank)

        yield from batches(rows(), result, 1024)

    ranged = base.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    done = Scratch(spark, "digest").write(ranged.mapInArrow(run, f"kind int, part int, text string, {_RESULT_SQL}"), "neighbours", codec="zstd")
    first = done.where(f"kind = {_FIRST}").select("part", F.col("text").alias("following"))
    last = done.where(f"kind = {_LAST}").select("part", "doc_id", "text")
    every = Window.partitionBy(F.lit(0))  # one number a task
    after = F.coalesce(F.lead("part").over(every.orderBy("part")), F.min("part").over(every)).alias("after")
    ends = last.join(first.select("part", after), "part").join(first.withColumnRenamed("part", "after"), "after")
    rest = ends.select("doc_id", "text", "following").mapInArrow(across, _RESULT_SQL)
    return done.where("kind = 0").select(*result.names).unionByName(rest)
