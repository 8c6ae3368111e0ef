"""Registered queries: journeys, segments, retention, personas, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from splitlens.functions.hashing import bucket_sql_duckdb
from splitlens.operators import journey, segments, spans
from splitlens.plans import oracle_forms as forms
from splitlens.plans.catalog import register
from splitlens.sources.fixtures import AS_OF_SEGMENTS

FUNNEL_SQL = """CASE WHEN e.event_name LIKE 'banner%' THEN 'Awareness' WHEN e.event_name = 'click_banner' THEN 'Interest'
            WHEN e.event_name = 'purchase' THEN 'Conversion' ELSE 'Other' END"""


@register("user_journey", f"""
WITH steps AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, user_id ORDER BY timestamp, event_id) AS n
  FROM fx_events WHERE run_id IS NOT NULL)
SELECT e.event_id, e.user_id, e.run_id, a.variant, e.event_name, e.timestamp, e.value, a.weight,
       cast(e.n AS int) AS event_sequence, b.event_name AS prev_event, f.event_name AS next_event,
       date_diff('second', b.timestamp, e.timestamp) AS time_since_last_event, {FUNNEL_SQL} AS funnel_stage
FROM steps e
LEFT JOIN steps b ON b.run_id = e.run_id AND b.user_id = e.user_id AND b.n = e.n - 1
LEFT JOIN steps f ON f.run_id = e.run_id AND f.user_id = e.user_id AND f.n = e.n + 1
LEFT JOIN fx_assignments a ON a.run_id = e.run_id AND a.user_id = e.user_id""")
def q_user_journey(fx):
    return journey.user_journey(fx.events, fx.assignments)


CUSTOMERS_SQL = forms.customers("fx_users", "fx_orders", AS_OF_SEGMENTS)
SEGMENTS_SQL = f"SELECT segment, count(*) AS users FROM ({CUSTOMERS_SQL}) c GROUP BY segment"


@register("user_segments", SEGMENTS_SQL)
def q_user_segments(fx):
    return segments.user_segments(fx.users, fx.orders, AS_OF_SEGMENTS)


@register("segment_mix", f"""
WITH seg AS ({SEGMENTS_SQL}),
labels AS (SELECT * FROM (VALUES ('Impulsive', 0), ('Rational', 1), ('Window', 2), ('Mission', 3), ('Cautious', 4))
           t(segment, seg_order)),
j AS (SELECT l.segment, l.seg_order, cast(coalesce(s.users, 0) AS bigint) AS users
      FROM labels l LEFT JOIN seg s ON l.segment = s.segment),
t AS (SELECT *, sum(users) OVER () AS total FROM j),
b AS (SELECT *, CASE WHEN total > 0 THEN cast(trunc((cast(users AS double) / total) * 100) AS int) ELSE 0 END AS base FROM t),
r AS (SELECT *, 100 - sum(base) OVER () AS rest, row_number() OVER (ORDER BY base DESC, seg_order) AS rk FROM b)
SELECT segment, users, cast(base + CASE WHEN rk = 1 THEN rest ELSE 0 END AS int) AS pct FROM r WHERE total > 0""")
def q_segment_mix(fx):
    return segments.segment_mix(segments.user_segments(fx.users, fx.orders, AS_OF_SEGMENTS))


@register("age_segment", """
SELECT CASE WHEN age BETWEEN 18 AND 26 THEN 'Student' ELSE 'Office Worker' END AS age_band,
       count(*) AS users, min(age) AS min_age, max(age) AS max_age
FROM (SELECT 18 + cast(user_id AS bigint) % 43 AS age FROM fx_users) u GROUP BY 1""")
def q_age_segment(fx):
    users = fx.users.withColumn("age", F.lit(18) + F.col("user_id").cast("long") % 43)
    return segments.age_segments(users)


@register("cohort_retention", """
WITH joined AS (SELECT user_id, cast(date_trunc('week', joined_at) AS date) AS cohort_week FROM fx_users),
active AS (SELECT DISTINCT j.cohort_week, j.user_id, cast(date_diff('day', j.cohort_week, cast(date_trunc('week', o.order_at) AS date)) // 7 AS int) AS week_number
           FROM joined j JOIN fx_orders o ON o.user_id = j.user_id WHERE o.order_at >= j.cohort_week),
size AS (SELECT cohort_week, count(*) AS cohort_size FROM joined GROUP BY 1)
SELECT cohort_week, week_number, cohort_size, count(user_id) AS retained, cast(count(user_id) AS double) / cohort_size AS retention_rate
FROM size JOIN active USING (cohort_week) GROUP BY cohort_week, week_number, cohort_size
UNION ALL
SELECT cohort_week, NULL, cohort_size, 0, cast(0.0 AS double) FROM size WHERE cohort_week NOT IN (SELECT cohort_week FROM active)""",
          doubles=("retention_rate",))
def q_cohort_retention(fx):
    return segments.cohort_retention(fx.users, fx.orders)


TRAITS_SQL = "[" + ", ".join(f"'{t}'" for t in segments.PERSONA_TRAITS) + "]"


@register("persona_breakdown", f"""
WITH ev AS (SELECT *, concat('agent_', {TRAITS_SQL}[cast(user_id AS bigint) % 5 + 1], '_', user_id) AS agent_id
            FROM fx_events),
per_agent AS (
  SELECT run_id, agent_id,
         max(CASE WHEN event_name LIKE 'banner%' OR event_name = 'click_banner' THEN 1 ELSE 0 END) AS clicked,
         max(CASE WHEN event_name = 'bounce' THEN 1 ELSE 0 END) AS bounced,
         max(CASE WHEN event_name = 'purchase' THEN 1 ELSE 0 END) AS purchased
  FROM ev WHERE agent_id LIKE 'agent_%' GROUP BY 1, 2)
SELECT run_id,
       CASE regexp_extract(agent_id, '^agent_([a-z]+)_', 1) WHEN '' THEN NULL WHEN 'rational' THEN 'calculator'
            WHEN 'window' THEN 'browser' ELSE regexp_extract(agent_id, '^agent_([a-z]+)_', 1) END AS persona,
       count(*) AS total, cast(sum(clicked) AS bigint) AS clicked, cast(sum(bounced) AS bigint) AS bounced,
       cast(sum(purchased) AS bigint) AS purchased, cast(sum(clicked) AS double) / count(*) AS ctr
FROM per_agent GROUP BY 1, 2""", doubles=("ctr",))
def q_persona_breakdown(fx):
    traits = F.array(*[F.lit(t) for t in segments.PERSONA_TRAITS])
    agent = F.concat(F.lit("agent_"), F.element_at(traits, (F.col("user_id").cast("long") % 5 + 1).cast("int")),
                     F.lit("_"), F.col("user_id"))
    return segments.persona_breakdown(fx.events.withColumn("agent_id", agent))


@register("sample_weights", f"""
SELECT o_orderpriority, count(*) AS population, count(CASE WHEN b < 10 THEN 1 END) AS sampled,
       cast(count(*) AS double) / nullif(count(CASE WHEN b < 10 THEN 1 END), 0) AS weight,
       sum(o_totalprice) AS true_total,
       sum(CASE WHEN b < 10 THEN o_totalprice END)
         * (cast(count(*) AS double) / nullif(count(CASE WHEN b < 10 THEN 1 END), 0)) AS estimated_total
FROM (SELECT o_orderpriority, o_totalprice, {bucket_sql_duckdb('o_orderkey')} AS b FROM orders) o
GROUP BY 1""", doubles=("weight", "true_total", "estimated_total"), digits=4)
def q_sample_weights(fx):
    o = fx.table("orders", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return segments.stratified_sample_weights(o, "o_orderpriority", "o_orderkey", "o_totalprice", sample_pct=10)


@register("user_segment_labels", CUSTOMERS_SQL, doubles=("total_spent",), digits=4)
def q_user_segment_labels(fx):
    return segments.user_segment_labels(fx.users, fx.orders, AS_OF_SEGMENTS)


@register("sample_exact", """
SELECT o_orderkey, o_orderpriority, o_totalprice, population, cast(population AS double) / least(population, 20) AS weight
FROM (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) AS population,
             row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42:' || o_orderkey), o_orderkey) AS k FROM orders) o
WHERE k <= 20""", doubles=("weight",))
def q_sample_exact(fx):
    o = fx.table("orders", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return segments.bottom_k_sample(o, "o_orderpriority", "o_orderkey", k=20)


def _bitmaps(fx):
    facts = fx.assignments
    return spans.daily_bitmaps(facts, spans.number_users(facts), F.to_date("assigned_at"), "variant")


@register("weekly_users", """
SELECT cast(date_trunc('week', assigned_at) AS date) AS span, variant, count(DISTINCT user_id) AS users
FROM fx_assignments GROUP BY 1, 2""")
def q_weekly_users(fx):
    return spans.span_users(_bitmaps(fx), spans.week_of(), "variant")


@register("weekly_overlap", """
WITH w AS (SELECT DISTINCT cast(date_trunc('week', assigned_at) AS date) AS span, variant, user_id FROM fx_assignments)
SELECT a.span, a.variant, count(*) AS users, count(b.user_id) AS kept
FROM w a LEFT JOIN w b ON b.user_id = a.user_id AND b.variant = a.variant AND b.span = a.span + 7 GROUP BY 1, 2""")
def q_weekly_overlap(fx):
    return spans.span_overlap(_bitmaps(fx), spans.week_of(), F.date_sub(spans.week_of(), 7), "variant")
