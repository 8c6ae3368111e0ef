"""Batch jobs over catalogue tables: mart build, ETL with range replace,
read-out of chosen runs."""

from pyspark.sql import functions as F

from splitlens import jobs
from splitlens.operators import mart, metrics
from splitlens.sources import sinks


def test_jobs_end_to_end(spark, fx):
    db = "jobs_db"
    sinks.create_tables(spark, db, reset=True)
    sinks.bulk_append(fx.assignments, f"{db}.assignments")
    sinks.append_events(fx.events, f"{db}.events")
    stored = jobs.build_mart_table(spark, db, selected=("revenue", "ctr"))
    assert set(stored.columns) >= {"report_date", "total_users", "total_revenue", "ctr", "updated_at"}
    want = {r.report_date: r.total_users for r in mart.build_mart(fx.assignments, fx.events).collect()}
    assert {r.report_date: r.total_users for r in stored.collect()} == want
    etl = jobs.run_etl(spark, db, table="dm_daily_kpi")
    want = {r.report_date: r.click_count for r in mart.build_etl_mart(fx.assignments, fx.events).collect()}
    assert {r.report_date: r.click_count for r in etl.collect()} == want
    runs = ["run_20240105", "run_20240106"]
    out = jobs.readout(spark, db, run_ids=runs)
    assert {r.run_id for r in out["stats"].collect()} <= set(runs)
    full = {(r.run_id, r.variant): r.users for r in metrics.ab_primary(fx.assignments, fx.events).collect()
            if r.run_id in runs}
    assert {(r.run_id, r.variant): r.users for r in out["counts"].collect()} == full
    assert out["guardrails"].filter(F.col("run_id").isin(runs)).count() == out["guardrails"].count()


def test_finish_run(spark, fx):
    db, run = "finish_db", "run_20240105"
    sinks.create_tables(spark, db, reset=True)
    sinks.bulk_append(fx.assignments, f"{db}.assignments")
    sinks.append_events(fx.events, f"{db}.events")
    sinks.activate(spark, f"{db}.active_experiment")
    want = jobs.readout(spark, db, run_ids=[run])["stats"].first()
    r = jobs.finish_run(spark, run, "banner", "B is better", "keep it short", db=db, config={"title": "x"}, adopt=True, clean_up=True).first()
    assert (r.learning_note, r.target, r.hypothesis, r.primary_metric) == ("keep it short", "banner", "B is better", "CTR")
    assert abs(r.lift - want.lift) < 1e-12 and r.decision == want.decision and "CVR" in r.guardrail_results
    adopted = spark.table(f"{db}.adoptions").first()
    assert adopted.experiment_id == run and '"title":"x"' in adopted.variant_config
    assert spark.table(f"{db}.active_experiment").count() == 0
    for name, src in (("events", fx.events), ("assignments", fx.assignments)):
        left = spark.table(f"{db}.{name}")
        assert left.filter(F.col("run_id") == run).count() == 0
        assert left.count() == src.filter(F.col("run_id") != run).count()
    sinks.activate(spark, f"{db}.active_experiment")
    jobs.finish_run(spark, "run_20240106", "banner", "no difference", db=db)
    assert spark.table(f"{db}.experiments").count() == 2 and spark.table(f"{db}.adoptions").count() == 1
    assert spark.table(f"{db}.active_experiment").count() == 0
