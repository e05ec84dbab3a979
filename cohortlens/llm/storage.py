"""Shared work folder: staged tables and files that outlive a lost executor.

Stages are written below the folder named by ``spark.checkpoint.dir``, which
every executor shares.  Only where that setting is absent (tests on one
machine) the session's warehouse folder, shared as well, is used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder URI for one run of an operator."""
    base = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm_work"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet once and read it back (cuts the lineage).

    The write's shuffle files go as it ends, not when the driver happens to collect its garbage."""
    path, conf = f"{folder}/{name}", df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, folder: str, name: str) -> None:
    """Remove a stage that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def put_bytes(spark: SparkSession, uri: str, data: bytes) -> str:
    """Write one small driver-built file to the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        for i in range(0, len(data), 1 << 20):
            out.write(bytearray(data[i:i + (1 << 20)]))
    finally:
        out.close()
    return uri


def open_fs(uri: str):
    """(file system, path) of a shared-folder URI, usable inside a task."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), uri[5:].replace("//", "", 1) if uri.startswith("file://") else uri[5:]
    return fs.FileSystem.from_uri(uri)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows: those with the smallest hash of ``key``, so a run repeats exactly.

    A filter on the hash leaves about twice as many first, so tasks send few rows to the final limit."""
    total, span = df.count(), 1 << 40
    bar = span if total <= 2 * rows else int(span * 2 * rows / total)
    h = F.pmod(F.xxhash64(key), F.lit(span))
    return df.where(h < bar).orderBy(h, key).limit(rows)


def process_cache() -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    import sys
    import types
    return sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__


def release_idle() -> None:
    """Give memory back to the system: the encoder of an ended task that another operator's task found in its worker,
    and what the allocators hold unused."""
    cache = process_cache()
    if cache.get("encoder") is not None and not cache.get("encoder_busy"):
        cache.pop("encoder"), cache.pop("encoder_key", None)
    return_unused()


def return_unused() -> None:
    """Give back to the system what the allocators hold unused."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass
