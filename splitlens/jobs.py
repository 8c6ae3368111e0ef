"""Batch jobs over catalogue tables, composed from the operators and writers.

* ``build_mart_table`` -- build the daily KPI mart with the selected metrics
  and replace the ``dm_daily_kpi`` table (the mart build of the dashboard).
* ``run_etl`` -- the scheduled ETL: the ETL mart, written by range replace
  (every stored day >= the first new day is replaced).
* ``readout`` -- the read-out of chosen runs (or all): counts, z-test,
  guardrail verdicts and the weighted table, as frames.

* ``finish_run`` -- what ends an experiment: its record with the learning
  note, the adoption of a winner, the end of the active experiment and, if
  wanted, the removal of the run's rows.

Every step is a Spark job; nothing passes through the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlens.operators import mart, metrics, reporting, stats
from splitlens.sources import sinks


def _t(db: str, name: str) -> str:
    return f"{db}.{name}"


def build_mart_table(spark: SparkSession, db: str = "experiment", selected=mart.OPTIONAL_METRICS,
                     table: str = "dm_daily_kpi") -> DataFrame:
    """Replace ``db.table`` with the daily KPI mart of ``selected`` metrics
    (plus ``updated_at``); returns the stored table."""
    m = mart.build_mart(spark.table(_t(db, "assignments")), spark.table(_t(db, "events")), selected)
    sinks.replace_table(mart.with_updated_at(m), _t(db, table), partition_by=["report_date"])
    return spark.table(_t(db, table))


def run_etl(spark: SparkSession, db: str = "experiment", table: str = "dm_daily_kpi") -> DataFrame:
    """The daily ETL: the ETL mart (events joined on the user, cvr = buyers /
    clickers) range-replaced into ``db.table``; returns the stored table."""
    etl = mart.build_etl_mart(spark.table(_t(db, "assignments")), spark.table(_t(db, "events")))
    sinks.range_replace(mart.with_updated_at(etl), _t(db, table))
    return spark.table(_t(db, table))


def readout(spark: SparkSession, db: str = "experiment", run_ids=None, metric: str = "CTR",
            margin_pct: float = 5.0) -> dict[str, DataFrame]:
    """Read-out frames for ``run_ids`` (None: every run): ``counts``,
    ``stats`` (z-test, decision), ``guardrails`` (verdicts) and ``weighted``."""
    a, e = spark.table(_t(db, "assignments")), spark.table(_t(db, "events"))
    counts = metrics.ab_primary(a, e, metric, run_ids)
    return {
        "counts": counts,
        "stats": stats.ab_stats(counts),
        "guardrails": stats.guardrail_verdicts(metrics.guardrail_counts(a, e, run_ids), margin_pct),
        "weighted": metrics.weighted_metrics(a, e, run_ids),
    }


def finish_run(spark: SparkSession, run_id: str, target: str, hypothesis: str, learning_note: str = "",
               db: str = "experiment", metric: str = "CTR", config: dict | None = None, margin_pct: float = 5.0,
               adopt: bool = False, clean_up: bool = False) -> DataFrame:
    """End ``run_id``: append its experiment record (read-out, guardrails,
    ``learning_note``), adopt its B variant if ``adopt`` says so -- which ends the
    active experiment too -- else just end the active experiment, and with
    ``clean_up`` drop the run's events and assignments (both tables are
    partitioned by run).  Returns the stored record."""
    a, e = spark.table(_t(db, "assignments")), spark.table(_t(db, "events"))
    design = spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(target).alias("target"), F.lit(hypothesis).alias("hypothesis"),
        F.lit(metric).alias("primary_metric"))
    record = reporting.experiment_records(design, metrics.run_outcomes(a, e, [run_id]), margin_pct)
    sinks.append_experiment_record(record.withColumn("learning_note", F.lit(learning_note)), _t(db, "experiments"))
    stored = spark.table(_t(db, "experiments")).filter(F.col("run_id") == run_id)
    if adopt:
        settings = F.lit(json.dumps(config) if config else None).cast("string")
        sinks.adopt(stored.select("run_id", "target", settings.alias("config"), "lift", "p_value"),
                    _t(db, "adoptions"), _t(db, "active_experiment"))
    else:
        sinks.deactivate(spark, _t(db, "active_experiment"))
    if clean_up:
        for name in ("events", "assignments"):
            sinks.delete_where(spark, _t(db, name), None, partition_col="run_id", partition_value=run_id)
    return stored
