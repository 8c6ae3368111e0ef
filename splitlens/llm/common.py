"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlens.session import checkpoint_dir
from splitlens.sources.tables import read_table

# ASCII blanks: space, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, name, list(columns) or None)


def ship_by_value(module: str) -> None:
    """Send a module's functions to the Python workers by value, so that the
    executors need neither this package nor the driver's folders."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    Cuts the lineage: what is read twice, or fed back into a loop, is computed
    once, and a lost executor costs a re-read instead of a re-run.  The tables
    live until the shared folder is cleaned, since returned frames read them.
    """
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: list[str],
           total: int, values: list[str]) -> DataFrame:
    """Left join of ``rows`` with ``groups`` (one row per ``key``) that no hot
    key can pile up in one task.

    Groups of more than a thousandth of the ``total`` rows are fewer than a
    thousand, so they may be broadcast whatever the volume.  Their rows then
    take no key of the shuffled join: they are dealt out by a hash of the
    ``spread`` columns.  Every other group has at most a thousandth of the rows.
    ``groups`` is read twice and should be a written table.  ``values`` are
    the columns taken from it, NULL where no group fits.
    """
    cut = total / 1000
    pack = F.struct(*[F.col(v) for v in values])
    hot = groups.where(F.col(size) > cut).select(F.col(key).alias("_hk"), pack.alias("_hot"))
    cold = groups.where(F.col(size) <= cut).select(F.col(key).alias("_ck"), pack.alias("_cold"))
    kind = dict(groups.dtypes)[key]
    dealt = F.xxhash64(*[F.col(c) for c in spread]).cast(kind)
    out = (rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
           .withColumn("_jk", F.when(F.col("_hk").isNotNull(), dealt).otherwise(F.col(key)))
           .join(cold, (F.col("_jk") == F.col("_ck")) & F.col("_hk").isNull(), "left"))
    for v in values:
        out = out.withColumn(f"_v_{v}", F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold.{v}")))
    return out.select(*rows.columns, *[F.col(f"_v_{v}").alias(v) for v in values])


def uniform(*columns: Column) -> Column:
    """A number in (0, 1) that depends on the columns' values only, so that
    reruns and retried tasks agree."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 53))
