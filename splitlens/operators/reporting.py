"""Experiment reporting: records, adoptions, baseline, portfolio, summary.

The experiments and adoptions tables hold one row per run or adoption, so
they are small next to events; still nothing here collects them: joins are
left to the planner (adaptive execution broadcasts them when their measured
size allows), and every grouping is an ordinary aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlens.operators.assignment import latest_adoption
from splitlens.operators.stats import (ALPHA, DECISION_LOSER, DECISION_NONE, DECISION_WINNER, GUARD_COLUMNS,
                                      GUARDRAILS, control_test, guardrail_array, with_p_value, z_test)
from splitlens.sources.schemas import GUARDRAIL_RESULTS, VARIANT_CONFIG

UNCLASSIFIED = "unclassified"
NOT_AVAILABLE = "N/A"
DEFAULT_WINNER = "B"


def _guardrail_fields(arr) -> list:
    """JSON text, pass count and 'metric:Pass,...' summary of a guardrail
    array (a column name or a Column)."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    clean = F.transform(arr, lambda x: F.struct(x["metric"].alias("metric"), x["control"].alias("control"),
                                                x["test"].alias("test"), x["lift"].alias("lift"),
                                                x["passed"].alias("passed")))
    summary = F.array_join(F.transform(arr, lambda x: F.concat(
        x["metric"], F.lit(":"), F.when(x["passed"], F.lit("Pass")).otherwise(F.lit("Fail")))), ",")
    passed = F.aggregate(arr, F.lit(0), lambda acc, x: acc + F.when(x["passed"], 1).otherwise(0))
    return [F.to_json(clean).alias("guardrail_results"), passed.alias("guardrails_passed"),
            summary.alias("guardrail_summary")]


def guardrail_json(verdicts: DataFrame, order=GUARDRAILS) -> DataFrame:
    """(run_id, guardrail_results JSON, guardrails_passed, guardrail_summary)
    from long-form verdicts.  Each run holds one entry per guardrail metric,
    so the per-run list is bounded by the number of metrics."""
    idx = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("metric"))
    items = F.sort_array(F.collect_list(F.struct(idx.alias("i"), "metric", "control", "test", "lift", "passed")))
    keys = [c for c in ("run_id", "test_variant") if c in verdicts.columns]
    return verdicts.groupBy(*keys).agg(items.alias("_g")).select(*keys, *_guardrail_fields("_g"))


def experiment_records(design: DataFrame, outcomes: DataFrame, margin_pct: float = 5.0,
                       guardrails=GUARDRAILS, alpha: float = ALPHA) -> DataFrame:
    """Experiment records in one pass over ``run_outcomes``: the read-out
    (primary-metric z-test) and the guardrail results come from the same
    pivoted row, so the events are folded once for both.  One record per arm
    compared with the control (``test_variant``)."""
    ct = control_test(outcomes, ["users", "readout"] + [c for c in GUARD_COLUMNS if c != "users"])
    t = z_test(F.col("c_users"), F.col("c_readout"), F.col("t_users"), F.col("t_readout"))
    # The guardrail array is built once and read through a lambda variable, so
    # its expressions are not copied into each of the three derived fields.
    g = F.element_at(F.transform(F.array(guardrail_array(margin_pct, guardrails)),
                                 lambda a: F.struct(*_guardrail_fields(a))), 1)
    r = ct.select("run_id", "test_variant", *[v.alias(k) for k, v in t.items()], g.alias("_g"))
    r = with_p_value(r, alpha).select("run_id", "test_variant", "control_rate", "test_rate", "lift", "p_value", "decision",
                                      "_g.guardrail_results", "_g.guardrails_passed", "_g.guardrail_summary")
    rec = design.select("run_id", "target", "hypothesis", "primary_metric").join(r, "run_id")
    return rec.withColumn("guardrails", F.lit(",".join(guardrails)))


def experiment_record(design: DataFrame, readout: DataFrame, verdicts: DataFrame | None,
                      guardrails=GUARDRAILS) -> DataFrame:
    """One experiment record per run: design fields (run_id, target,
    hypothesis, primary_metric), the read-out (rates, lift, p, decision), the
    configured guardrails as CSV and their results as JSON ('[]' when none).
    ``created_at`` is stamped on write, not here."""
    arm = ["test_variant"] if "test_variant" in readout.columns else []
    r = readout.select("run_id", *arm, "control_rate", "test_rate", "lift", "p_value", "decision")
    rec = design.select("run_id", "target", "hypothesis", "primary_metric").join(r, "run_id")
    rec = rec.withColumn("guardrails", F.lit(",".join(guardrails)))
    if verdicts is not None:
        on = ["run_id", *[c for c in arm if c in verdicts.columns]]
        rec = rec.join(guardrail_json(verdicts, guardrails), on, "left")
    else:
        rec = rec.withColumn("guardrail_results", F.lit(None).cast("string")) \
                 .withColumn("guardrails_passed", F.lit(0)).withColumn("guardrail_summary", F.lit(""))
    return rec.withColumn("guardrail_results", F.coalesce("guardrail_results", F.lit("[]")))


def parse_variant_config(col="variant_config"):
    """The payload as a struct; its ``config`` maps each key to a VARIANT."""
    return F.from_json(F.col(col), VARIANT_CONFIG)


def setting(config, path: str, kind: str = "string"):
    """A setting of a parsed ``config`` by key or path (``size``, ``layout.columns``), as ``kind``; NULL
    where it is missing or of another kind."""
    key, _, inner = path.partition(".")
    return F.try_variant_get(config[key], f"$.{inner}" if inner else "$", kind)


def adoption_board(adoptions: DataFrame, experiments: DataFrame) -> DataFrame:
    """Adoptions with their experiment's fields and the parsed payload
    (malformed JSON gives NULL fields)."""
    e = experiments.select(F.col("run_id").alias("_run"), "hypothesis", "target", "primary_metric",
                           "control_rate", "test_rate", "lift")
    j = adoptions.join(e, adoptions.experiment_id == e._run, "left").drop("_run")
    cfg = parse_variant_config()
    return j.select("experiment_id", "adopted_at", "hypothesis", "target", "primary_metric",
                    "control_rate", "test_rate", "lift",
                    cfg["winning_variant"].alias("winning_variant"), cfg["target"].alias("config_target"),
                    setting(cfg["config"], "title").alias("config_title"), setting(cfg["config"], "theme").alias("config_theme"),
                    cfg["lift"].alias("adopted_lift"))


def current_baseline(adoptions: DataFrame, experiments: DataFrame) -> DataFrame:
    """The newest adoption: winning variant (default B), target (the
    experiment's, else the payload's, else 'N/A') and one row per config
    entry (one row with NULL key when there is no config), its value as text: a string as it is,
    numbers, booleans and nested values as JSON."""
    latest = latest_adoption(adoptions)
    e = experiments.select(F.col("run_id").alias("_run"), "hypothesis", F.col("target").alias("_t"))
    j = latest.join(e, latest.experiment_id == e._run, "left")
    cfg = parse_variant_config()
    target = F.coalesce(F.nullif(F.col("_t"), F.lit("")), F.nullif(cfg["target"], F.lit("")), F.lit(NOT_AVAILABLE))
    return (j.select("experiment_id", "adopted_at", "hypothesis", target.alias("target"),
                     F.coalesce(cfg["winning_variant"], F.lit(DEFAULT_WINNER)).alias("winning_variant"),
                     F.explode_outer(cfg["config"]).alias("config_key", "config_value"))
            .withColumn("config_value", F.col("config_value").cast("string")))


def badge(decision) -> "F.Column":
    """One vocabulary for both spellings of a decision."""
    return (F.when(decision.isin(DECISION_WINNER, "positive"), F.lit(DECISION_WINNER))
            .when(decision.isin(DECISION_LOSER, "negative"), F.lit(DECISION_LOSER))
            .otherwise(F.lit(DECISION_NONE)))


def badge_color(decision) -> "F.Column":
    b = badge(decision)
    return F.when(b == DECISION_WINNER, "green").when(b == DECISION_LOSER, "red").otherwise("orange")


def portfolio(experiments: DataFrame, target: str | None = None, decision: str | None = None) -> DataFrame:
    """Experiments (optionally one target / one decision; None = all) with
    their target group ('unclassified' for NULL), the group's size and the
    result badge."""
    x = experiments
    if target is not None:
        x = x.filter(F.col("target") == target)
    if decision is not None:
        x = x.filter(badge(F.col("decision")) == badge(F.lit(decision)))
    x = x.withColumn("target_group", F.coalesce(F.col("target"), F.lit(UNCLASSIFIED)))
    sizes = x.groupBy("target_group").agg(F.count(F.lit(1)).alias("group_size"))
    return (x.join(sizes, "target_group")
            .select("target_group", "group_size", "run_id", "hypothesis", "primary_metric", "lift", "decision",
                    badge(F.col("decision")).alias("badge"), badge_color(F.col("decision")).alias("badge_color")))


def target_list(experiments: DataFrame) -> DataFrame:
    """Distinct non-NULL targets, sorted."""
    return experiments.select("target").filter(F.col("target").isNotNull()).distinct().orderBy("target")


def newest(df: DataFrame, k: int, *by: str) -> DataFrame:
    """The ``k`` newest rows by the columns ``by`` (a top-k, not a sort): the
    last 5 adoptions, the last 3 experiments."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in by]).limit(k)


def adoption_summary(experiments: DataFrame, adoptions: DataFrame) -> DataFrame:
    """Experiments, adopted (run id among the adopted ids), not adopted and
    adoption rate in percent (0 when there are no experiments)."""
    ids = adoptions.select(F.col("experiment_id").alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    j = experiments.select("run_id").join(ids, F.col("run_id") == F.col("_id"), "left")
    total = F.count(F.lit(1))
    adopted = F.count("_id")
    return j.agg(total.alias("experiments"), adopted.alias("adopted"), (total - adopted).alias("not_adopted"),
                 F.when(total > 0, adopted / total * 100).otherwise(F.lit(0.0)).alias("adoption_rate_pct"))


def guardrail_results(records: DataFrame) -> DataFrame:
    """Stored guardrail results exploded: (run_id, metric, passed, status,
    lift_pct); a record without results keeps one row with NULL metric."""
    g = F.from_json(F.col("guardrail_results"), GUARDRAIL_RESULTS)
    return (records.select("run_id", F.explode_outer(g).alias("r"))
            .select("run_id", F.col("r.metric").alias("metric"), F.col("r.passed").alias("passed"),
                    F.when(F.col("r.passed"), F.lit("Pass")).when(F.col("r.metric").isNotNull(), F.lit("Fail"))
                    .alias("status"),
                    (F.col("r.lift") * 100).alias("lift_pct")))


def for_display(df: DataFrame, order_by=None, limit: int | None = None,
                header_map: dict | None = None) -> DataFrame:
    """Edge-of-pipeline presentation: optional sort (a top-k when ``limit`` is
    given), first rows, and display headers (e.g. localised names)."""
    out = df
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    for old, new in (header_map or {}).items():
        out = out.withColumnRenamed(old, new)
    return out
