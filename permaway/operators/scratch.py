"""Cutting lineage in a folder that every executor can read."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a session on one machine (tests, a laptop) that names none gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="permaway-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


_written: list[str] = []
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)
#: Tables whose queries have left their shuffle files to the driver's garbage collection.
_loose: set[str] = set()
#: Has Spark delete a query's shuffle files as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: later jobs start
    from the files, whichever executors have been lost meanwhile."""
    out = _store(df)
    _loose.add(_written[-1])
    return out


def cut_clean(df: DataFrame) -> DataFrame:
    """cut(df), and its shuffle files go with the query, without the driver's garbage being collected.
    A full collection takes the driver a tenth of a second, and the time counts for
    letting its heap grow."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return _store(df)
    finally:
        conf.set(CLEANUP, before)


def _store(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/cut-{uuid.uuid4().hex}"
    _written.append(path)
    if (scope := _scope.get()) is not None:
        scope.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def release(spark: SparkSession) -> None:
    """Have the driver collect garbage, on which Spark deletes the shuffle files of queries that are
    over. The listeners' threads hold the last query that ended, with its plan and shuffles,
    until another one ends; hence one of no rows."""
    spark.createDataFrame([], "x int").collect()
    gc.collect()
    spark._jvm.System.gc()


def trim(spark: SparkSession) -> bool:
    """Have the driver's JVM give back native memory that it has freed; malloc keeps it in each of the
    many threads' arenas. Whether this JVM can (HotSpot 17.0.9 on glibc, or later)."""
    jvm = spark._jvm
    try:
        # By reflection, since the server's own class is not public.
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        return False
    return True


def settle(make: Callable[[], DataFrame]) -> DataFrame:
    """cut_clean(make()), less the tables that make() has cut on its way and the shuffle files of that:
    its result is in files of its own, so that nothing reads them any more. The driver's freed native
    memory goes back too."""
    outer, token = _scope.get(), _scope.set([])
    try:
        out = cut_clean(make())
        *steps, last = _scope.get()
    finally:
        _scope.reset(token)
    if outer is not None:
        outer.append(last)
    for path in steps:
        _delete(out.sparkSession, path)
        if path in _written:
            _written.remove(path)
    if _loose & set(steps):
        _loose.difference_update(steps)
        release(out.sparkSession)
    trim(out.sparkSession)
    return out


def discard(table: DataFrame) -> None:
    """Delete a cut table that nothing reads any more."""
    for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
        mine = [p for p in _written if p.rpartition("/")[2] == path.rpartition("/")[2]]
        for p in mine:
            _delete(table.sparkSession, p)
            _written.remove(p)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the tables that cut() has written, once results that read them are stored. How many."""
    done = 0
    _loose.clear()
    while _written:
        done += _delete(spark, _written.pop())
    return done


#: Rows and bytes (as Parquet) up to which a cut table is sent to every executor.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 8 << 20


def bytes_of(df: DataFrame) -> int:
    """Size of the files of a cut table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hint_small(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """A cut table, marked for broadcast if its rows and files have been counted and are few;
    a larger one is left to a shuffled join, whose hot partitions are split at run time."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if bytes_of(df) <= most and df.count() <= rows else df
