"""Tables whose whole content changes in one step.

The name is a view over the current version, a table of its own (``<name>__v_<id>``).  A change writes
a new version aside and then replaces the view, one entry of the catalogue: a reader
sees the old rows or the new ones, a job that dies leaves the old table or the new one.
Readers that were planned before the switch go on reading their version's files
until ``vacuum`` drops it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MARK = "__v_"


def is_versioned(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def physical(spark: SparkSession, name: str) -> str:
    """The table behind ``name``: its current version, or itself."""
    if not is_versioned(spark, name):
        return name
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()["data_type"]
    return text.split(" FROM ")[-1].strip()


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(physical(spark, name)) if c.isPartition]


def point(spark: SparkSession, name: str, version: str) -> None:
    """The switch."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")


def new_version(name: str) -> str:
    return f"{name}{MARK}{uuid.uuid4().hex}"


def publish(df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """Make ``df`` the content of ``name``; returns the new version's table."""
    spark, version = df.sparkSession, new_version(name)
    if partition_by is None and is_versioned(spark, name):
        partition_by = partition_columns(spark, name)
    w = df.write.format("parquet")
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(version)
    point(spark, name, version)
    return version


def versions(spark: SparkSession, name: str) -> list[str]:
    db, _, short = name.rpartition(".")
    return sorted(f"{db}.{t.name}" if db else t.name for t in spark.catalog.listTables(db or None) if t.name.startswith(f"{short}{MARK}"))


def vacuum(spark: SparkSession, name: str) -> list[str]:
    """Drop every version but the current one, those of jobs that died too.  Run it when no reader
    holds an older version and no writer is at work."""
    now = physical(spark, name)
    gone = [v for v in versions(spark, name) if v != now]
    for v in gone:
        spark.sql(f"DROP TABLE IF EXISTS {v}")
    return gone


def drop(spark: SparkSession, name: str) -> None:
    """Drop the name with all its versions."""
    if is_versioned(spark, name):
        spark.sql(f"DROP VIEW {name}")
    for v in versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {v}")
