"""Session helpers: building a local session for tests and benches, the shared
checkpoint folder, and lineage cuts.

On a cluster the checkpoint folder must be shared storage named by the cluster
in ``spark.checkpoint.dir``. We read that setting from the session and only
create our own folder when it is unset *and* the master is local (tests).
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "furrow",
    cpus: int | str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str = "16g",
) -> SparkSession:
    """Local session with AQE on, UI off and UTC time (what tests and bench use)."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def tune_wide(spark: SparkSession) -> None:
    """For plans of hundreds of columns: the optimizer compares every alias with
    every constraint on each projection below a join, which takes minutes there, and
    the driver keeps the text of each plan, which is long.
    Set before such plans run, and left so, as their results are lazy."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    spark.conf.set("spark.sql.maxPlanStringLength", "20000")


@contextmanager
def planned_once(spark: SparkSession, when: bool = True) -> Iterator[None]:
    """For a write whose joins are all broadcast: adaptive execution would plan it anew after
    each of them and could change nothing. Where ``when`` is false it stays on."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    if when:
        spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Between the steps of a long job: lets Spark's cleaner drop the broadcasts and shuffle files of finished
    steps. It only learns of them when the driver collects its garbage, and until then the driver's heap grows.
    What the JVM has freed outside its heap, as after compiling the code of wide plans, goes back to the system."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim_native_heap(spark)


def trim_native_heap(spark: SparkSession) -> str | None:
    """The C library keeps what is freed for later use, hundreds of MB after many wide plans; the JVM's own
    diagnostic command gives it back. None where the driver's JVM has no such command."""
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    try:
        beans = jvm.java.lang.Class.forName("javax.management.MBeanServerConnection")
        invoke = next(m for m in beans.getMethods() if m.getName() == "invoke")
        args = array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        args[2], args[3] = array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and job outputs.

    Uses ``spark.checkpoint.dir`` (or a checkpoint dir already set on the
    context). Only a local-mode session without one gets a fresh folder under
    the system temp dir; a cluster session without one is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required on a cluster"
            )
        conf = tempfile.mkdtemp(prefix="furrow-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for job outputs."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing Parquet to the shared folder and reading it back.

    Used for wide intermediate frames: later stages then read only the columns
    they need (column pruning), which a row-based checkpoint cannot offer.
    Partition layout is not preserved — use :func:`materialize` when the
    partition a row sits in matters.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class Stages:
    """Tables written between the stages of a job, by name; ``drop`` removes those that no later stage reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def write(self, df: DataFrame, key: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{key}")
        df.write.mode("overwrite").parquet(path)
        self.paths[key] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *keys: str) -> None:
        sc = self.spark.sparkContext
        for key in keys:
            path = sc._jvm.org.apache.hadoop.fs.Path(self.paths.pop(key))
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
