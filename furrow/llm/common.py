"""Shared helpers: words, hashes, Arrow row building, scratch tables and sorted-group iteration."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from furrow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate Parquet tables in the shared checkpoint folder.

    A written table cuts the lineage (a lost executor re-reads it instead of
    recomputing what led to it). ``drop`` removes a table that no later step
    reads; the tables that the returned DataFrame reads stay, as it is lazy.
    ``tidy``: the shuffle files of a table go as soon as it is written, instead of
    when the driver next collects its garbage.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark, self.name, self.paths, self.tidy = spark, name, {}, tidy

    def write(self, df: DataFrame, key: str, codec: str = "snappy") -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{key}")
        before = self.spark.conf.get(SHUFFLE_CLEANUP)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true" if self.tidy else before)
        try:
            df.write.mode("overwrite").parquet(path, compression=codec)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        self.paths[key] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *keys: str) -> None:
        for key in keys:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(key))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark's cleaner remove the shuffle files of finished steps."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def words(text: str | None) -> list[bytes]:
    """Maximal runs of characters outside U+0020 and U+0009 to U+000D, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), "u8", len(tokens))


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[2]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A hash of every run of ``width`` consecutive word hashes (polynomial, mixed)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, "u8")
    base = _MIX[0] + np.uint64(2 * seed)
    values = mix(hashes + np.uint64(seed + 1))
    acc = np.zeros(n, "u8")
    for k in range(width):
        acc = acc * base + values[k : k + n]
    return mix(acc)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def sorted_groups(
    parts: Iterator[pa.RecordBatch], keys: list[str], least: int = 1
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """From rows sorted by ``keys``: columns of whole groups, and where each group begins.

    Consecutive groups come together, at least ``least`` rows at a time where
    there are as many; no group is split.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def columns(part: pa.Table) -> dict[str, np.ndarray]:
        return {n: part.column(n).to_numpy() for n in part.column_names}

    def starts(cols: dict[str, np.ndarray]) -> np.ndarray:
        n = len(cols[keys[0]])
        new = np.zeros(n, bool)
        new[:1] = True
        for k in keys:
            new[1:] |= cols[k][1:] != cols[k][:-1]
        return np.flatnonzero(new)

    for batch in parts:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows < least:
            continue
        part = pa.Table.from_batches(held)
        cols = columns(part)
        begin = starts(cols)
        if len(begin) > 1:
            cut = int(begin[-1])
            yield {n: c[:cut] for n, c in cols.items()}, begin[:-1]
            held = part.slice(cut).to_batches()
            rows -= cut
    if rows:
        cols = columns(pa.Table.from_batches(held))
        yield cols, starts(cols)


