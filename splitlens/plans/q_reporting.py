"""Registered queries: experiment records, adoptions, baseline, portfolio."""

from __future__ import annotations

from splitlens.operators import metrics, reporting, stats
from splitlens.plans.catalog import register
from splitlens.plans.q_readout import AB_STATS_SQL, GUARD_VERDICTS_SQL

GUARD_ORDER_SQL = ("CASE metric " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(stats.GUARDRAILS, 1))
                   + " END")


def _record(fx):
    return reporting.experiment_records(fx.designs, metrics.run_outcomes(fx.assignments, fx.events),
                                        margin_pct=5.0)


@register("experiment_record", f"""
SELECT s.run_id, s.test_variant, x.target, x.hypothesis, x.primary_metric, s.control_rate, s.test_rate, s.lift, s.p_value, s.decision,
       '{",".join(stats.GUARDRAILS)}' AS guardrails, g.guardrails_passed, g.guardrail_summary
FROM fx_experiments x
JOIN ({AB_STATS_SQL}) s ON x.run_id = s.run_id
LEFT JOIN (SELECT run_id, test_variant, cast(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS int) AS guardrails_passed,
                  string_agg(metric || ':' || CASE WHEN passed THEN 'Pass' ELSE 'Fail' END, ','
                             ORDER BY {GUARD_ORDER_SQL}) AS guardrail_summary
           FROM ({GUARD_VERDICTS_SQL}) v GROUP BY run_id, test_variant) g ON s.run_id = g.run_id AND s.test_variant = g.test_variant""",
          doubles=("control_rate", "test_rate", "lift", "p_value"))
def q_experiment_record(fx):
    # The JSON column is checked through ``guardrail_results`` (it parses it
    # back); the two engines print small doubles differently.
    return _record(fx).drop("guardrail_results")


@register("guardrail_results", f"""
SELECT v.run_id, v.metric, v.passed, CASE WHEN v.passed THEN 'Pass' ELSE 'Fail' END AS status, v.lift * 100 AS lift_pct
FROM ({GUARD_VERDICTS_SQL}) v JOIN fx_experiments x ON v.run_id = x.run_id""", doubles=("lift_pct",))
def q_guardrail_results(fx):
    return reporting.guardrail_results(_record(fx))


@register("adoption_board", """
SELECT a.experiment_id, a.adopted_at, e.hypothesis, e.target, e.primary_metric, e.control_rate, e.test_rate, e.lift,
       json_extract_string(a.variant_config, '$.winning_variant') AS winning_variant,
       json_extract_string(a.variant_config, '$.target') AS config_target,
       json_extract_string(a.variant_config, '$.config.title') AS config_title,
       json_extract_string(a.variant_config, '$.config.theme') AS config_theme,
       cast(json_extract(a.variant_config, '$.lift') AS double) AS adopted_lift
FROM fx_adoptions a LEFT JOIN fx_experiments e ON a.experiment_id = e.run_id""",
          doubles=("control_rate", "test_rate", "lift", "adopted_lift"))
def q_adoption_board(fx):
    return reporting.adoption_board(fx.adoptions, fx.experiments)


@register("current_baseline", """
WITH latest AS (SELECT * FROM fx_adoptions ORDER BY adopted_at DESC, experiment_id DESC LIMIT 1),
j AS (SELECT l.*, e.hypothesis, e.target AS t FROM latest l LEFT JOIN fx_experiments e ON l.experiment_id = e.run_id),
k AS (SELECT j.*, unnest(json_keys(variant_config, '$.config')) AS config_key FROM j)
SELECT experiment_id, adopted_at, hypothesis,
       coalesce(nullif(t, ''), nullif(json_extract_string(variant_config, '$.target'), ''), 'N/A') AS target,
       coalesce(json_extract_string(variant_config, '$.winning_variant'), 'B') AS winning_variant,
       config_key, json_extract_string(variant_config, '$.config.' || config_key) AS config_value
FROM k""")
def q_current_baseline(fx):
    return reporting.current_baseline(fx.adoptions, fx.experiments)


@register("portfolio", f"""
WITH x AS (SELECT *, coalesce(target, 'unclassified') AS target_group FROM fx_experiments),
s AS (SELECT target_group, count(*) AS group_size FROM x GROUP BY 1)
SELECT x.target_group, s.group_size, x.run_id, x.hypothesis, x.primary_metric, x.lift, x.decision,
       CASE WHEN decision IN ('{stats.DECISION_WINNER}', 'positive') THEN '{stats.DECISION_WINNER}'
            WHEN decision IN ('{stats.DECISION_LOSER}', 'negative') THEN '{stats.DECISION_LOSER}'
            ELSE '{stats.DECISION_NONE}' END AS badge,
       CASE WHEN decision IN ('{stats.DECISION_WINNER}', 'positive') THEN 'green'
            WHEN decision IN ('{stats.DECISION_LOSER}', 'negative') THEN 'red' ELSE 'orange' END AS badge_color
FROM x JOIN s ON x.target_group = s.target_group""", doubles=("lift",))
def q_portfolio(fx):
    return reporting.portfolio(fx.experiments)


@register("portfolio_filtered", f"""
SELECT target AS target_group, count(*) OVER () AS group_size, run_id, hypothesis, primary_metric, lift, decision,
       '{stats.DECISION_NONE}' AS badge, 'orange' AS badge_color
FROM fx_experiments WHERE target = 'target_1' AND decision NOT IN ('{stats.DECISION_WINNER}', '{stats.DECISION_LOSER}')""", doubles=("lift",))
def q_portfolio_filtered(fx):
    return reporting.portfolio(fx.experiments, target="target_1", decision=stats.DECISION_NONE)


@register("target_list", """
SELECT DISTINCT target FROM fx_experiments WHERE target IS NOT NULL ORDER BY target""")
def q_target_list(fx):
    return reporting.target_list(fx.experiments)


@register("newest_adoptions", """
SELECT * FROM fx_adoptions ORDER BY adopted_at DESC NULLS LAST, experiment_id DESC NULLS LAST LIMIT 5""")
def q_newest_adoptions(fx):
    return reporting.newest(fx.adoptions, 5, "adopted_at", "experiment_id")


@register("newest_experiments", """
SELECT run_id, target, decision FROM fx_experiments ORDER BY run_id DESC NULLS LAST LIMIT 3""")
def q_newest_experiments(fx):
    return reporting.newest(fx.experiments.select("run_id", "target", "decision"), 3, "run_id")


@register("adoption_summary", """
SELECT count(*) AS experiments, count(i.id) AS adopted, count(*) - count(i.id) AS not_adopted,
       CASE WHEN count(*) > 0 THEN count(i.id) / count(*) * 100 ELSE 0.0 END AS adoption_rate_pct
FROM fx_experiments x
LEFT JOIN (SELECT DISTINCT experiment_id AS id FROM fx_adoptions WHERE experiment_id IS NOT NULL) i ON x.run_id = i.id""",
          doubles=("adoption_rate_pct",))
def q_adoption_summary(fx):
    return reporting.adoption_summary(fx.experiments, fx.adoptions)
