"""Directories that are whole or absent: stored models, cached results, tables with their schema.

A directory is written under a temporary name next to its place, with a manifest
(format version, kind, schema hash and whatever the caller adds) as its last
file, and then renamed in one step. A reader checks the manifest first, so a
half-written, foreign or outdated directory is refused instead of being read.
The manifest is one small JSON text; data goes through Spark's writers.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

MANIFEST = "manifest"
VERSION = 1


class ArtifactError(ValueError):
    """A directory that is absent, half-written, of another kind or version, or does not fit what is asked of it."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    p, fs = _fs(spark, source)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise ArtifactError(f"{source} could not be renamed to {target}")


def schema_hash(schema: T.StructType) -> str:
    """A hash of names and types in order; whether a column may be null does not matter."""
    return hashlib.sha256(json.dumps([(f.name, f.dataType.simpleString()) for f in schema.fields]).encode()).hexdigest()


def publish(spark: SparkSession, path: str, kind: str, write: Callable[[str], None], manifest: dict, overwrite: bool = False) -> None:
    """``write(folder)`` under a temporary name, then the manifest, then one rename to ``path``.

    An existing directory is an error, unless it is to be overwritten: then it is
    moved aside just before the rename and deleted after it. A call that dies
    leaves the old directory, or the new one, or a temporary one that no reader takes.
    """
    path = path.rstrip("/")
    if exists(spark, path) and not overwrite:
        raise ArtifactError(f"{path} exists")
    folder = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
    write(folder)
    text = json.dumps({"format": VERSION, "kind": kind, **manifest}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/{MANIFEST}")
    old = None
    if exists(spark, path):
        old = f"{path}.old-{uuid.uuid4().hex[:12]}"
        rename(spark, path, old)
    rename(spark, folder, path)
    if old:
        delete(spark, old)


def manifest(spark: SparkSession, path: str, kind: str) -> dict:
    """The checked manifest of a directory."""
    path = path.rstrip("/")
    try:
        row = spark.read.text(f"{path}/{MANIFEST}").first()
    except AnalysisException as e:
        raise ArtifactError(f"{path} has no manifest: it is absent or was not finished") from e
    if row is None:
        raise ArtifactError(f"{path} has an empty manifest: it was not finished")
    found = json.loads(row["value"])
    if found.get("kind") != kind or found.get("format") != VERSION:
        raise ArtifactError(f"{path} is a {found.get('kind')} of format {found.get('format')}, not a {kind} of format {VERSION}")
    return found


def check_schema(found: T.StructType, wanted: str, what: str) -> None:
    if schema_hash(found) != wanted:
        raise ArtifactError(f"{what}: its schema is not the one it was stored with ({found.simpleString()[:200]})")
