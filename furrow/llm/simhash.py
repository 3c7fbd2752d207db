"""SimHash near-dedup: fingerprints, links by bit-sliced comparison, components.

Fingerprints are split into ``radius + 2`` blocks of bits. Two fingerprints
that differ in at most ``radius`` bits agree on two whole blocks, so rows that
share a pair of blocks are the only candidates (no loss). Inside a candidate
bucket, bit planes are stored vertically (64 fingerprints in a machine word),
the distances of many pairs are counted at once by carry-save adders, and a
word of 64 pairs is abandoned once all of them exceed the radius.

A bucket of any size is cut into blocks of about ``block`` fingerprints by
hash; each pair of blocks is a unit of work, so no task holds a whole hot
bucket. A unit emits a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import Scratch, sorted_groups, words
from furrow.llm.components import connected_components
from furrow.operators.ranking import rank_in_group

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the word shingles of an A-Z lower-cased text, as an unsigned int."""
    tokens = [w.lower() for w in words(text)] if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= shingle:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, tokens), "i8", len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    pairs = zip(starts[: len(tokens) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], 42) for a, b in pairs], "<u8")
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, h, fp)`` for every row, ``h`` a hash of the text; null and empty texts have fingerprint 0. Other columns are not read."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("fp", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fps = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, fp long")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows, one for each bit: row b holds bit b of 64 fingerprints in every word."""
    bits = np.unpackbits(np.ascontiguousarray(fps, "<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    wide = np.zeros((64, -(-packed.shape[1] // 8) * 8), "u1")
    wide[:, : packed.shape[1]] = packed
    return wide.view("<u8")


def within_radius(differs, shape: tuple[int, int], radius: int) -> np.ndarray:
    """Bit mask of the pairs whose planes of differing bits add up to at most ``radius``.

    ``differs(b, words)`` gives the plane of bit ``b`` at the given words of 64
    pairs (rows x words). Three planes at a time go through a full adder; sums
    and carries go into counters of ``bits`` bits that start so that they
    overflow beyond the radius. Words whose 64 pairs have all overflowed, in
    every row, are dropped from what follows.
    """
    bits = max(1, int(radius).bit_length())
    start = (1 << bits) - 1 - radius
    live = np.arange(shape[1])
    over = np.zeros(shape, "u8")
    count = [np.full(shape, _FULL if start >> j & 1 else np.uint64(0), "u8") for j in range(bits)]
    near = np.zeros(shape, "u8")
    for b in range(0, 64, 3):
        x = differs(b, live)
        if b + 2 < 64:
            y, z = differs(b + 1, live), differs(b + 2, live)
            half = x ^ y
            s, t = half ^ z, (x & y) | (half & z)
        else:
            s, t = x, np.zeros_like(x)
        carry = count[0] & s
        count[0] ^= s
        if bits == 1:
            over |= carry | t
        else:
            half = count[1] ^ carry
            carry = (count[1] & carry) | (half & t)
            count[1] = half ^ t
            for j in range(2, bits):
                count[j], carry = count[j] ^ carry, count[j] & carry
            over |= carry
        if b % 12 == 9 and b < 60:
            open_ = (over != _FULL).any(0)
            if not open_.any():
                return near
            if open_.sum() * 4 <= 3 * len(open_):
                live, over = live[open_], over[:, open_]
                count = [c[:, open_] for c in count]
    near[:, live] = ~over
    return near


def _roots(label: np.ndarray, at: np.ndarray) -> np.ndarray:
    found = label[at]
    while True:
        up = label[found]
        if (up == found).all():
            return found
        found = up


def _settle(label: np.ndarray) -> np.ndarray:
    return _roots(label, np.arange(len(label)))


def _link_pairs(fps: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the listed pairs are linked; bit-sliced over the pairs."""
    planes = bit_planes(fps[i] ^ fps[j])
    near = within_radius(lambda b, at: planes[b : b + 1, at], (1, planes.shape[1]), radius)
    mask = np.unpackbits(near.view("u1"), bitorder="little")[: len(i)].astype(bool)
    return i[mask], j[mask]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (indices of smaller rows) after joining the rows of each pair."""
    while len(i):
        a, b = _roots(label, i), _roots(label, j)
        open_ = a != b
        if not open_.any():
            break
        a, b, i, j = a[open_], b[open_], i[open_], j[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
    return label


def _link_blocks(fps: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, label: np.ndarray, step: int = 64) -> None:
    """Join rows of ``left`` with the rows of ``right`` within the radius; indices into ``fps``."""
    planes = bit_planes(fps[right])
    for at in range(0, len(left), step):
        mine = left[at : at + step]
        bits = np.unpackbits(fps[mine].astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        flip = np.where(bits, _FULL, np.uint64(0))
        near = within_radius(lambda b, words_, f=flip: planes[b, words_][None, :] ^ f[:, b : b + 1], (len(mine), planes.shape[1]), radius)
        for row in np.flatnonzero(near.any(1)):
            hits = np.flatnonzero(np.unpackbits(near[row].view("u1"), bitorder="little")[: len(right)])
            if len(hits):
                found = np.unique(_roots(label, np.append(right[hits], mine[row])))
                label[found] = found[0]


def _link_batch(cols: dict[str, np.ndarray], begin: np.ndarray, radius: int, small: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links ``(rep, rep of its root)`` of whole buckets."""
    n = len(cols["fp"])
    order = np.lexsort((cols["rep"], np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))))
    fps, rep, side = cols["fp"][order].view("u8"), cols["rep"][order], cols["side"][order]
    two = (cols["lo"] != cols["hi"])[order]
    size = np.diff(np.append(begin, n))
    label = np.arange(n)
    few = (size <= small) & ~two[begin]
    spread = np.repeat(np.where(few, begin + size, 0), size)  # end of the row's small bucket
    rows = np.flatnonzero(spread > 0)
    for d in range(1, small):
        rows = rows[rows + d < spread[rows]]
        if not len(rows):
            break
        for at in range(0, len(rows), 1 << 18):
            i = rows[at : at + (1 << 18)]
            _merge(label, *_link_pairs(fps, i, i + d, radius))
    for b, m in zip(begin[~few], size[~few], strict=True):
        mine = np.arange(b, b + m)
        if two[b]:
            _link_blocks(fps, mine[side[mine] == 0], mine[side[mine] == 1], radius, label)
        else:
            _link_blocks(fps, mine, mine, radius, label)
    root = _settle(label)
    member = np.flatnonzero(root != np.arange(n))
    return rep[member], rep[root[member]]


def links(reps: DataFrame, radius: int, scratch: Scratch, block: int = 4096) -> DataFrame:
    """Spanning links ``(u, v)`` between the ``rep`` of fingerprints at most ``radius`` bits apart.

    ``reps(fp, rep)``: distinct fingerprints with a distinct long for each.
    """
    bounds = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    mask = [sum(1 << b for b in range(x, y)) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    tables = [signed(mask[a] | mask[b]) for a, b in combinations(range(radius + 2), 2)]
    keyed = reps.select(
        "fp", "rep", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in tables])).alias("t", "key")
    )
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    units = (
        keyed.join(sizes, ["t", "key"])
        .select("t", "key", "fp", "rep", blocks.alias("nb"))
        .withColumn("b", F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select("t", "key", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"), (F.col("b") > F.col("o")).cast("int").alias("side"), "fp", "rep")
    )
    keys = ["t", "key", "lo", "hi"]
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, begin in sorted_groups(parts, keys, least=1 << 16):
            u, v = _link_batch(cols, begin, radius)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)

    return units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u long, v long")


def _grouped(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, h, fp, grp, component_id`` of every row: its group, and the smallest doc_id there (null if none has one)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.write(fingerprints(docs, shingle, id_col, text_col), "fps")
    named = scratch.write(fps.groupBy("fp").agg(F.min("doc_id").alias("name")), "reps")
    n, apart, low, high = named.agg(F.count("*"), F.count_distinct("name"), F.min("name"), F.max("name")).first()
    reps = named.withColumn("rep", F.col("name"))
    if apart < n:  # fingerprints without a doc_id, or whose doc_id names another one too, get numbers that no name has
        first = named.where("name IS NOT NULL").groupBy("name").agg(F.min("fp").alias("fp")).select("fp", "name", F.col("name").alias("rep"))
        rest = rank_in_group(named.join(first.select("fp"), "fp", "left_anti"), [], ["fp"], "rank")
        number = F.lit(high or 0) + F.col("rank") if (high or 0) < (1 << 63) - 1 - n else F.lit(low) - F.col("rank")
        reps = scratch.write(first.unionByName(rest.select("fp", "name", number.alias("rep"))), "numbered")
    found = connected_components(links(reps.select("fp", "rep"), radius, scratch), scratch)
    classes = reps.join(found, reps.rep == found.node, "left").select("fp", "name", F.coalesce("component", "rep").alias("grp"))
    if apart < n:
        classes = classes.join(classes.groupBy("grp").agg(F.min("name").alias("component_id")), "grp").select("fp", "grp", "component_id")
    else:
        classes = classes.select("fp", "grp", F.col("grp").alias("component_id"))
    return fps.join(classes, "fp", "left").select("doc_id", "h", "fp", "grp", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, fp, component_id``.

    ``component_id`` is the smallest doc_id reachable through links of at most
    ``radius`` differing bits. Null and empty texts have fingerprint 0 and are
    linked like any other. Rows that repeat a doc_id each get their row, and are
    linked by their fingerprints alone. A row whose doc_id is null is linked
    like any other; it names no component (null where only such rows are
    linked). No rows in, no rows out.
    """
    return _grouped(docs, shingle, radius, id_col, text_col).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay when each group of near duplicates keeps one.

    The row with the smallest doc_id stays (nulls last); of rows that repeat
    that doc_id the one with the smallest text hash, of those the smallest row
    by its columns' values. No rows in, no rows out.
    """
    scratch = Scratch(docs.sparkSession, "simhash-kept")
    rows = _grouped(docs, shingle, radius, id_col, text_col).groupBy("grp", "doc_id", "h").agg(F.count("*").alias("n"))
    first = rows.groupBy("grp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "h", "n")).alias("first"))
    first = scratch.write(first.select(F.col("first.doc_id").alias("d"), F.col("first.h").alias("g"), "first.n"), "first")
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))
    kept = whole.join(first.where("n = 1"), same, "left_semi").select("row.*")
    if not first.where("n > 1").isEmpty():  # rows that repeat both doc_id and text
        again = whole.join(first.where("n > 1"), same, "left_semi").groupBy("doc_id", "h").agg(F.min("row").alias("row"))
        kept = kept.unionByName(again.select("row.*"))
    return kept
