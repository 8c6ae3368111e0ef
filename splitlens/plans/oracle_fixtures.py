"""DuckDB text of the fixture tables, for the oracle queries.

The same derivation as ``splitlens.sources.fixtures`` written the plain way
(distinct users joined back for the bucket, SQL facts per user for the run
counts), so the oracle is an independent implementation.
"""

from splitlens.functions.hashing import bucket_sql_duckdb
from splitlens.plans.oracle_forms import converters

RUN_OF_TS = "concat('run_', strftime(cast({ts} as date), '%Y%m%d'))"

_TENTH = "cast(user_id AS bigint) % 10"
HARD_IDS = f"""* REPLACE (
    CASE WHEN {_TENTH} = 0 THEN 'guest' WHEN {_TENTH} <= 3 THEN 'user_hist_' || user_id
         WHEN {_TENTH} <= 5 THEN 'agent_mission_' || user_id ELSE user_id END AS user_id,
    CASE WHEN {_TENTH} > 3 THEN run_id END AS run_id)"""

FIXTURE_CTES = f"""
fx_bucket AS (
  SELECT u AS user_id, {bucket_sql_duckdb('u')} AS bucket
  FROM (SELECT DISTINCT cast(user_id AS varchar) AS u FROM events) t
),
fx_assignments AS (
  SELECT cast(e.user_id AS varchar) AS user_id, 'exp_default' AS experiment_id,
         CASE WHEN max(b.bucket) >= 50 THEN 'B' ELSE 'A' END AS variant,
         min(e.ts) AS assigned_at,
         {RUN_OF_TS.format(ts='e.ts')} AS run_id,
         cast(1.0 + (e.user_id % 4) * 0.5 AS double) AS weight
  FROM events e JOIN fx_bucket b ON b.user_id = cast(e.user_id AS varchar)
  GROUP BY e.user_id, cast(e.ts AS date)
),
fx_events AS (
  SELECT cast(event_id AS varchar) AS event_id, cast(user_id AS varchar) AS user_id,
         CASE event_type WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'click_banner' ELSE 'banner_B' END
                         WHEN 'view' THEN 'page_view' WHEN 'error' THEN 'bounce' ELSE event_type END AS event_name,
         ts AS timestamp,
         CASE WHEN event_type = 'purchase' THEN value ELSE cast(0.0 AS double) END AS value,
         {RUN_OF_TS.format(ts='ts')} AS run_id
  FROM events
),
fx_hard_events AS (SELECT {HARD_IDS} FROM fx_events),
fx_hard_assignments AS (SELECT {HARD_IDS} FROM fx_assignments),
fx_users AS (
  SELECT cast(c_custkey AS varchar) AS user_id, c_name AS name, c_mktsegment AS segment,
         cast(date '2001-08-01' - cast(c_custkey % 90 AS int) AS date) AS joined_at
  FROM customer
),
fx_orders AS (
  SELECT cast(o_orderkey AS varchar) AS order_id, cast(o_custkey AS varchar) AS user_id,
         o_orderdate AS order_at, o_totalprice AS amount
  FROM orders
),
fx_counts AS ({converters("fx_assignments", "fx_events", "hit")}),
fx_experiments AS (
  SELECT run_id, concat('target_', cast(cast(right(run_id, 2) AS int) % 4 AS varchar)) AS target,
         concat('hypothesis ', run_id) AS hypothesis, 'CTR' AS primary_metric,
         cr AS control_rate, tr AS test_rate, (tr - cr) / nullif(cr, 0) AS lift,
         (tr - cr) / nullif(se, 0) AS z_score,
         CASE WHEN abs((tr - cr) / nullif(se, 0)) > 1.959963984540054
              THEN CASE WHEN tr > cr THEN 'Significant Winner' ELSE 'Significant Loser' END
              ELSE 'Inconclusive' END AS decision
  FROM (SELECT a.run_id, cast(a.conversions AS double) / a.users AS cr,
               cast(b.conversions AS double) / b.users AS tr,
               sqrt((cast(a.conversions + b.conversions AS double) / (a.users + b.users))
                    * (1 - cast(a.conversions + b.conversions AS double) / (a.users + b.users))
                    * (cast(1.0 AS double) / a.users + cast(1.0 AS double) / b.users)) AS se
        FROM fx_counts a JOIN fx_counts b ON a.run_id = b.run_id AND a.variant = 'A' AND b.variant = 'B') t
),
fx_adoptions AS (
  SELECT run_id AS experiment_id,
         concat('{{"winning_variant":"B","target":"', target, '","config":{{"title":"t_', right(run_id, 2),
                '","theme":"Red"}},"lift":0.5}}') AS variant_config,
         cast(concat(substr(run_id, 5, 4), '-', substr(run_id, 9, 2), '-', substr(run_id, 11, 2)) AS date) AS adopted_at
  FROM fx_experiments WHERE lift > 0
)"""


def with_fixtures(body: str, round_cols=(), digits: int = 9) -> str:
    """Full oracle statement: fixture CTEs, the query as ``q``, doubles rounded."""
    sel = "*"
    if round_cols:
        sel = "* REPLACE (" + ", ".join(f"round({c}, {digits}) AS {c}" for c in round_cols) + ")"
    return f"WITH {FIXTURE_CTES.strip()},\nq AS (\n{body.strip()}\n)\nSELECT {sel} FROM q"
