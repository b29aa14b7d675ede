"""Reliable checkpoints in the folder that the session names."""

from __future__ import annotations

import contextlib
import tempfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Share of the heap's limit from which the driver's heap is made smaller between checkpoints, and how much more than
#: the last collection left it has to be.
GROWN, AGAIN = 0.5, 1.25
_left = 0


def give_back(spark: SparkSession) -> None:
    """Give memory that the driver's JVM has freed back to the system, of its heap where that has grown.

    Tasks that end and plans that are compiled leave garbage on the driver; a heap grows to its limit rather than
    shrinking between stages, and the allocator keeps what threads have freed outside of it. A heap that can't shrink,
    for its fixed size or what lives on it, is left alone until it has grown again.
    """
    global _left
    jvm = spark.sparkContext._jvm
    lang = jvm.java.lang
    runtime = lang.Runtime.getRuntime()
    if runtime.totalMemory() > max(GROWN * runtime.maxMemory(), AGAIN * _left):
        lang.System.gc()
        _left = runtime.totalMemory()
    trim(spark)


def trim(spark: SparkSession) -> str | None:
    """Have the driver's allocator give back what is free; what it did, or None of a JVM without the command."""
    jvm, new = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    named = jvm.java.lang.Class.forName
    with contextlib.suppress(Py4JJavaError):
        takes, values = new(jvm.java.lang.Class, 4), new(jvm.java.lang.Object, 4)
        for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            takes[k] = named(kind)
        values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        return named("javax.management.MBeanServer").getMethod("invoke", takes).invoke(server, values)
    return None


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder that the session names.

    ``spark.checkpoint.dir`` is read from the session; only where it is unset (tests on one machine) a
    temporary folder is taken. Spark deletes the files of results that are no longer referenced only where the
    session was started with ``spark.cleaner.referenceTracking.cleanCheckpoints``; else whoever names the folder does.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="weftline-"))
    df = df.checkpoint(eager=True)
    give_back(df.sparkSession)
    return df
