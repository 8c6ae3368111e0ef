"""Experiment statistics as Column expressions over aggregated rows.

All functions take per-(run, variant) aggregates and return one row per run
(or per run and metric); they never touch raw events, so they are cheap even
for many runs.  Control and test are the first and second variant of a run in
sort order, as in the read-out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlens.functions.normal import two_sided_p, z_quantile
from splitlens.functions.text import fixed_str

# Fixed values of the read-out.
ALPHA = 0.05
POWER = 0.8
CI_Z = 1.96
DECISION_WINNER = "Significant Winner"
DECISION_LOSER = "Significant Loser"
DECISION_NONE = "Inconclusive"
ADVICE_ADOPT = "Statistically significant improvement: consider adopting."
ADVICE_RERUN = "Statistically significant deterioration: re-run the experiment."
ADVICE_NONE = "No significant difference: use judgement or re-run."
VISITS_PER_DAY = 500


def _ratio(num: Column, den: Column) -> Column:
    """num/den, 0 when den <= 0 (the read-out's zero guard)."""
    return F.when(den > 0, num.cast("double") / F.nullif(den, F.lit(0)).cast("double")).otherwise(F.lit(0.0))


def _lift(test: Column, control: Column) -> Column:
    return F.when(control > 0, (test - control) / F.nullif(control, F.lit(0.0))).otherwise(F.lit(0.0))


def control_test(counts: DataFrame, value_cols: list[str], key: str = "run_id") -> DataFrame:
    """One row per run and arm compared with its control: ``c_<col>``/``t_<col>``
    of the first variant and of each other one; runs with fewer than two
    variants give none.  The list per run has one entry per variant, so it is
    tiny."""
    arms = F.sort_array(F.collect_list(F.struct("variant", *value_cols)))
    g = counts.groupBy(key).agg(arms.alias("_v")).filter(F.size("_v") >= 2)
    g = g.select(key, F.col("_v")[0].alias("c"), F.explode(F.slice("_v", 2, F.size("_v") - 1)).alias("t"))
    cols = [F.col(key), F.col("c.variant").alias("control_variant"), F.col("t.variant").alias("test_variant")]
    for c in value_cols:
        cols += [F.col(f"c.{c}").alias(f"c_{c}"), F.col(f"t.{c}").alias(f"t_{c}")]
    return g.select(*cols)


def z_test(c_users: Column, c_conv: Column, t_users: Column, t_conv: Column) -> dict[str, Column]:
    """Pooled two-proportion z-test.  Returns Columns control_rate, test_rate,
    lift, se, z_score (p_value is added by ``with_p_value`` from z_score)."""
    cr = _ratio(c_conv, c_users)
    tr = _ratio(t_conv, t_users)
    both = (c_users > 0) & (t_users > 0)
    n = (c_users + t_users).cast("double")
    pooled = (c_conv + t_conv).cast("double") / F.nullif(n, F.lit(0.0))
    inv = F.lit(1.0) / F.nullif(c_users.cast("double"), F.lit(0.0)) + F.lit(1.0) / F.nullif(t_users.cast("double"), F.lit(0.0))
    se = F.when(both, F.sqrt(pooled * (1 - pooled) * inv)).otherwise(F.lit(0.0))
    z = F.when(se > 0, (tr - cr) / F.nullif(se, F.lit(0.0))).otherwise(F.lit(0.0))
    return {"control_rate": cr, "test_rate": tr, "lift": _lift(tr, cr), "se": se, "z_score": z}


def with_p_value(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add p_value (1 when se = 0), decision and advice."""
    df = df.withColumn("p_value", F.when(F.col("se") > 0, two_sided_p("z_score")).otherwise(F.lit(1.0)))
    sig = F.col("p_value") < alpha
    lift = F.col("lift")
    return (df.withColumn("decision",
                          F.when(sig & (lift > 0), F.lit(DECISION_WINNER))
                          .when(sig, F.lit(DECISION_LOSER)).otherwise(F.lit(DECISION_NONE)))
            .withColumn("advice",
                        F.when(sig & (lift > 0), F.lit(ADVICE_ADOPT))
                        .when(sig & (lift < 0), F.lit(ADVICE_RERUN)).otherwise(F.lit(ADVICE_NONE))))


def ab_stats(counts: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Read-out for every run from (run_id, variant, users, conversions)."""
    ct = control_test(counts, ["users", "conversions"])
    t = z_test(F.col("c_users"), F.col("c_conversions"), F.col("t_users"), F.col("t_conversions"))
    out = ct.select("run_id", "control_variant", "test_variant",
                    F.col("c_users").alias("control_users"), F.col("c_conversions").alias("control_conversions"),
                    F.col("t_users").alias("test_users"), F.col("t_conversions").alias("test_conversions"),
                    *[v.alias(k) for k, v in t.items()])
    return with_p_value(out, alpha)


def calculate_statistics(spark, c_users: int, c_conv: int, t_users: int, t_conv: int) -> DataFrame:
    """The read-out of one comparison, as a one-row frame (for callers with
    counts in hand)."""
    df = spark.createDataFrame([("run", "A", c_users, c_conv), ("run", "B", t_users, t_conv)],
                               "run_id string, variant string, users long, conversions long")
    return ab_stats(df)


def variant_ci(counts: DataFrame, z: float = CI_Z) -> DataFrame:
    """Per (run, variant): rate and Wald half-width, both in percent."""
    r = _ratio(F.col("conversions"), F.col("users"))
    err = F.when(F.col("users") > 0,
                 F.lit(z) * F.sqrt(r * (1 - r) / F.nullif(F.col("users").cast("double"), F.lit(0.0)))
                 ).otherwise(F.lit(0.0))
    return counts.select("run_id", "variant", "users", "conversions",
                         (r * 100).alias("rate_pct"), (err * 100).alias("error_pct"))


GUARDRAILS = ("CVR", "AOV", "Bounce Rate", "CTR")


def guardrail_array(margin_pct: float = 5.0, metrics=GUARDRAILS) -> Column:
    """Array of (metric, control, test, lift, passed) structs over the pivoted
    columns c_/t_ users, conversions, revenue, clicks, bounces."""
    m = margin_pct / 100.0
    defs = {
        "CVR": (_ratio(F.col("c_conversions"), F.col("c_users")), _ratio(F.col("t_conversions"), F.col("t_users"))),
        "AOV": (_ratio(F.col("c_revenue"), F.col("c_conversions")), _ratio(F.col("t_revenue"), F.col("t_conversions"))),
        "Bounce Rate": (_ratio(F.col("c_bounces"), F.col("c_users")), _ratio(F.col("t_bounces"), F.col("t_users"))),
        "CTR": (_ratio(F.col("c_clicks"), F.col("c_users")), _ratio(F.col("t_clicks"), F.col("t_users"))),
    }
    rows = []
    for name in metrics:
        c, t = defs[name]
        lift = _lift(t, c)
        passed = (lift <= m) if name == "Bounce Rate" else (lift >= -m)
        rows.append(F.struct(F.lit(name).alias("metric"), c.alias("control"), t.alias("test"),
                             lift.alias("lift"), passed.alias("passed")))
    return F.array(*rows)


GUARD_COLUMNS = ["users", "conversions", "revenue", "clicks", "bounces"]


def guardrail_verdicts(gcounts: DataFrame, margin_pct: float = 5.0, metrics=GUARDRAILS) -> DataFrame:
    """Long form (run_id, test_variant, metric, control, test, lift, passed) from
    guardrail_counts.  Pass iff lift >= -margin (bounce: lift <= margin)."""
    ct = control_test(gcounts, GUARD_COLUMNS)
    return (ct.select("run_id", "test_variant", F.explode(guardrail_array(margin_pct, metrics)).alias("g"))
            .select("run_id", "test_variant", "g.metric", "g.control", "g.test", "g.lift", "g.passed"))


def format_delta(x: Column, is_percent: bool = True) -> Column:
    """'+12.35%' / '-12.35%' (percent) or '+0.1235' text."""
    sign = F.when(x >= 0, F.lit("+")).otherwise(F.lit(""))
    if is_percent:
        return F.concat(sign, fixed_str(x * 100, 2), F.lit("%"))
    return F.concat(sign, fixed_str(x, 4))


METRIC_COLUMNS = ("visitors", "clicks", "buyers", "revenue", "ctr", "cvr", "aov", "arpu")


def metrics_delta(weighted: DataFrame, columns=METRIC_COLUMNS) -> DataFrame:
    """Long form (run_id, test_variant, metric, control, test, delta) of the weighted table:
    delta is '(B-A)/A' in percent with one decimal, 'N/A' when A is 0/NULL or
    B is NULL."""
    ct = control_test(weighted, list(columns))
    rows = [F.struct(F.lit(c).alias("metric"), F.col(f"c_{c}").cast("double").alias("control"),
                     F.col(f"t_{c}").cast("double").alias("test")) for c in columns]
    long = (ct.select("run_id", "test_variant", F.explode(F.array(*rows)).alias("d"))
            .select("run_id", "test_variant", "d.metric", "d.control", "d.test"))
    a, b = F.col("control"), F.col("test")
    pct = (b - a) / F.nullif(a, F.lit(0.0)) * 100
    delta = (F.when(a.isNull() | b.isNull() | (a == 0), F.lit("N/A"))
             .otherwise(F.concat(F.when(pct >= 0, F.lit("+")).otherwise(F.lit("")), fixed_str(pct, 1), F.lit("%"))))
    return long.withColumn("delta", delta)


def sample_size_col(baseline: Column, mde: Column, alpha: float = ALPHA, power: float = POWER,
                    ceil: bool = False) -> Column:
    """Users per group for a two-proportion test, truncated like int()
    (``ceil=True`` rounds up, the conservative choice)."""
    za, zb = z_quantile(1 - alpha / 2), z_quantile(power)
    p1 = baseline.cast("double")
    p2 = p1 * (1 + mde)
    pbar = (p1 + p2) / 2
    n = 2 * pbar * (1 - pbar) * F.lit((za + zb) ** 2) / F.pow(p1 - p2, 2)
    n = F.ceil(n) if ceil else n
    return F.when(p1 == p2, F.lit(0)).otherwise(n.cast("long")).cast("long")


def sample_size(designs: DataFrame, baseline_col: str = "baseline", mde_col: str = "mde",
                alpha: float = ALPHA, power: float = POWER, ceil: bool = False) -> DataFrame:
    return designs.withColumn("n_per_group",
                              sample_size_col(F.col(baseline_col), F.col(mde_col), alpha, power, ceil))


def traffic_plan(plans: DataFrame, n_col: str = "n_per_group", split_col: str = "control_split_pct") -> DataFrame:
    """Total traffic for a control share given in whole percent (the slider):
    50 -> 2n, else the larger of n/control and n/test; group counts; days at
    500 visits per day."""
    n = F.col(n_col)
    c = F.col(split_col).cast("double") / 100
    t = 1 - c
    total = (F.when(F.col(split_col) == 50, n * 2)
             .otherwise(F.greatest(F.when(c > 0, (n / c).cast("long")).otherwise(n * 2),
                                   F.when(t > 0, (n / t).cast("long")).otherwise(n * 2)))).cast("long")
    return (plans.withColumn("total_needed", total)
            .withColumn("control_n", (F.col("total_needed") * c).cast("long"))
            .withColumn("test_n", (F.col("total_needed") * t).cast("long"))
            .withColumn("days_needed", (F.col("total_needed") / VISITS_PER_DAY).cast("long")))


def retention_rate(cohort_size: Column, retained: Column) -> Column:
    """retained / cohort, 0 when the cohort is empty."""
    return F.when(cohort_size <= 0, F.lit(0.0)).otherwise(retained.cast("double") / F.nullif(cohort_size, F.lit(0)))
