"""Table maintenance as frame operations: schema evolution, deletes, copies,
health counts.  Writers that apply them to stored tables are in
``splitlens.sources.sinks``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Backfill values for columns added to older tables.
DEFAULTS = {"weight": 1.0}


def evolve(df: DataFrame, target: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Bring ``df`` to the ``target`` schema: missing columns are added (by
    name, never by position) and filled from ``defaults``; columns are cast
    and ordered as in ``target``."""
    defaults = DEFAULTS if defaults is None else defaults
    empty = df.sparkSession.createDataFrame([], target)
    u = df.unionByName(empty, allowMissingColumns=True)
    cols = []
    for f in target.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return u.select(*cols)


def delete_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows kept by ``DELETE ... WHERE predicate`` (NULL predicate keeps)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def copy_new_rows(src: DataFrame, dst: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``src`` whose key is not in ``dst`` yet (insert ... on conflict
    do nothing): one row per key, as the second would conflict with the
    first; a key with a NULL conflicts with none.  Joins only, no collect."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    once = src.filter(known).dropDuplicates(keys)
    return once.join(dst.select(*keys).distinct(), keys, "left_anti").select(*src.columns).unionByName(src.filter(~known))


def table_health(tables: dict[str, DataFrame | None], spark: SparkSession | None = None) -> DataFrame:
    """(table_name, row_count, present) for the expected tables; a missing
    table (None) reports 0 rows and present = false.  One job over all.
    ``spark`` is needed only where every table may be missing."""
    present = {n: d for n, d in tables.items() if d is not None}
    spark = spark or next((d.sparkSession for d in present.values()), None) or SparkSession.active()
    missing = [(n, 0, False) for n in tables if n not in present]
    out = spark.createDataFrame(missing, "table_name string, row_count long, present boolean")
    for name, df in present.items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("row_count"))
                              .select(F.lit(name).alias("table_name"), "row_count", F.lit(True).alias("present")))
    return out


def catalog_tables(spark, namespace: str, expected) -> dict[str, DataFrame | None]:
    """Expected tables of a catalogue namespace (None where absent)."""
    return {t: (spark.table(f"{namespace}.{t}") if spark.catalog.tableExists(f"{namespace}.{t}") else None)
            for t in expected}
