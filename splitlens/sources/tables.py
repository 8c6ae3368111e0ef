"""Table access: parquet scans, catalogue tables, CSV with explicit schema."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table_path(base: str, name: str) -> str:
    p = os.path.join(base, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in base else os.path.join(base, name)


def read_table(spark: SparkSession, base: str, name: str, columns=None) -> DataFrame:
    """Parquet scan of ``name`` under ``base``; ``columns`` prunes at the scan."""
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df


def load(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    """Catalogue table ``namespace.name`` (the application's db_type routing)."""
    return spark.table(f"{namespace}.{name}")


def run_query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """SQL with bound parameters (``:name`` markers), never string-formatted
    values; errors propagate instead of turning into empty results."""
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header.  An explicit schema is the default; inference is opt-in
    (it costs an extra pass over the data)."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, every record kept: the columns of ``schema``, ``_file``, and for a record that does not fit
    ``_record`` (its text) and ``_reason`` (the number of fields, or the mistyped columns)."""
    record = T.StructField("_record", T.StringType())
    rows = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record")
            .schema(T.StructType([*schema.fields, record])).csv(path).select("*", F.col("_metadata.file_path").alias("_file")))
    # Commas outside quotes; a doubled quote inside quotes closes and opens again.
    fields = F.regexp_count(F.regexp_replace("_record", '"[^"]*"', ""), F.lit(",")) + 1
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = F.from_csv("_record", texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    odd = F.filter(F.array(*[F.when(raw[f.name].isNotNull() & F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields]),
                   lambda x: x.isNotNull())
    reason = (F.when(F.col("_record").isNull(), F.lit(None))
              .when(fields != len(schema.fields), F.concat(fields.cast("string"), F.lit(f" fields of {len(schema.fields)}")))
              .otherwise(F.concat(F.lit("mistyped: "), F.array_join(odd, ", "))))
    return rows.withColumn("_reason", reason)


def jdbc_read(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """PostgreSQL (or any JDBC) table; parallel when a numeric partition column
    and bounds are given.  Needs the driver jar on the classpath."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def with_event_date(events: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return events.withColumn("event_date", F.to_date(ts_col))
