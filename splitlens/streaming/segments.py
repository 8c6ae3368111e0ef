"""Append-only segments: what a micro-batch adds, under a name of its own.

A stream's output folder holds one sub-folder per (checkpoint, batch).  A batch that runs
again replaces its own segment and nothing else, so a replay, a restart or a
job that dies between two steps never counts anything twice or loses it.
``compact`` folds old segments into one.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from splitlens.sources.versions import physical

SEGMENT = "segment"


def name_of(checkpoint: str, batch_id: int) -> str:
    return f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}-{batch_id}"


def _path(spark: SparkSession, folder: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a job has committed a table in ``folder``."""
    fs, p = _path(spark, folder.rstrip("/") + "/_SUCCESS")
    return fs.exists(p)


def put(df: DataFrame, folder: str, segment: str, partition_by: list[str] | None = None) -> None:
    """Write ``df`` as ``segment`` of ``folder``, replacing that segment only."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{folder.rstrip('/')}/{SEGMENT}={segment}")


def read(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame | None:
    """All segments, with the column ``segment``; None before the first one."""
    whole = T.StructType([*schema.fields, T.StructField(SEGMENT, T.StringType())])
    try:
        return spark.read.schema(whole).option("basePath", folder).parquet(folder)
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex):
            return None
        raise


def once(df: DataFrame, folder: str, segment: str) -> tuple[DataFrame, bool]:
    """(``df`` as a batch first saw it, whether it had been written before).  What a batch
    finds new must not change when it runs again after storing half of it."""
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{SEGMENT}={segment}"
    again = is_complete(spark, path)
    if not again:
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), again


def compact(spark: SparkSession, folder: str, schema: T.StructType, fold, partition_by: list[str] | None = None) -> None:
    """Replace all segments by one, ``fold`` of their rows.  Run it while no batch is:
    the new segment is written aside and moved in after the old ones have been moved out;
    a job that dies in between leaves the old ones under ``<folder>.old-*``."""
    rows = read(spark, folder, schema)
    if rows is None:
        return
    tag = uuid.uuid4().hex
    aside, old = f"{folder.rstrip('/')}.new-{tag}", f"{folder.rstrip('/')}.old-{tag}"
    put(fold(rows.drop(SEGMENT)), aside, f"compact-{tag}", partition_by)
    fs, here = _path(spark, folder)
    for source, target in ((folder, old), (aside, folder)):
        fs.rename(_path(spark, source)[1], _path(spark, target)[1])
    fs.delete(_path(spark, old)[1], True)


def stored(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame | None:
    """What ``source`` (a catalogue table or a folder of Parquet files) holds
    now; None where a folder does not exist yet.  Read anew in every batch: a
    frame resolved once would keep the file listing of its first day."""
    if "/" not in source:
        spark.catalog.refreshTable(physical(spark, source))
        return spark.table(source)
    try:
        r = spark.read.schema(schema) if schema is not None else spark.read
        return r.parquet(source)
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex):
            return None
        raise
