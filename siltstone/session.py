"""Session settings and lineage cutting."""

from __future__ import annotations

import gc
import tempfile
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Runtime settings the loads rely on. Only values the caller left unset are filled in.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key is split at run time, also where the split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keys and stamps are some twenty times as large in memory as in a shuffle file, so a task of 64 MB (Spark's default) would need gigabytes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Fill in the adaptive-execution settings that the session has not set itself."""
    for name, value in _DEFAULTS.items():
        if not spark.conf.isModifiable(name):
            continue
        if spark.sparkContext.getConf().get(name) is None:
            spark.conf.set(name, value)
    # Adaptive execution merges small partitions, but it splits large ones for joins alone. So a large
    # cluster starts with several pieces for each of its cores.
    pieces, initial = 4 * spark.sparkContext.defaultParallelism, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if pieces > 256 and spark.conf.get(initial, None) is None:
        spark.conf.set(initial, str(max(pieces, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def build_session(app: str = "siltstone", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings above. On a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: `spark.checkpoint.dir` of the session.

    Only a local session may fall back to a folder of the machine.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="siltstone-"))
    return context.getCheckpointDir().rstrip("/")


def release(spark: SparkSession) -> None:
    """Let the driver drop what the steps so far have left behind.

    Broadcast tables, shuffles, compiled plans and their threads go when the driver's JVM collects its garbage. By itself it does
    that late, after its heap has grown as far as it may. What it frees outside of its heap (the compiler's memory above all, spread
    over the arenas of hundreds of threads) stays with the process until it is asked for.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _trim_native_heap(spark)


def _trim_native_heap(spark: SparkSession) -> None:
    """The diagnostic command System.trim_native_heap, where the JVM has it. It is called as a method of the public
    interface, since the class behind that is closed to reflection."""
    context = spark.sparkContext
    jvm, array = context._jvm, context._gateway.new_array
    java = jvm.java.lang
    kinds, given = array(java.Class, 4), array(java.Object, 4)
    for i, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[i] = java.Class.forName(name)
    given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        java.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(
            java.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JJavaError:  # an older or another JVM
        pass


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict[str, Any]]:
    """`materialize`, and aggregates of the rows that are taken on their way into the files, without another scan."""
    watch = Observation()
    stored = materialize(df.observe(watch, *[c.alias(n) for n, c in metrics.items()]), name)
    return stored, watch.get


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` once into the shared folder and read it back.

    Cuts the lineage, survives lost executors, makes generated row ids final, and
    gives the optimizer true sizes for its join choices. The folder goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/siltstone/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)
