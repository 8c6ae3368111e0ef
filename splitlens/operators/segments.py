"""Customer segments, segment mix, age bands, cohort retention, personas and
stratified sample weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splitlens.functions.hashing import bucket_col
from splitlens.operators.stats import retention_rate

# Fixed values of the modelled application.
SEG_WINDOW, SEG_MISSION, SEG_RATIONAL, SEG_IMPULSIVE, SEG_CAUTIOUS = (
    "Window", "Mission", "Rational", "Impulsive", "Cautious")
# Order in which the mix lists segments; the largest-share tie goes to the first.
SEGMENT_ORDER = ("Impulsive", "Rational", "Window", "Mission", "Cautious")
MISSION_MIN_ORDERS = 3
IMPULSIVE_MAX_TENURE_DAYS = 30
STUDENT_AGE = (18, 26)
BAND_STUDENT, BAND_OFFICE = "Student", "Office Worker"
# Behaviour traits of the traffic personas and the aliases they are reported under.
PERSONA_TRAITS = ("impulsive", "rational", "window", "mission", "cautious")
PERSONA_ALIASES = {"rational": "calculator", "window": "browser"}


def user_segment_labels(users: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """Per user: order_count, total_spent, tenure_days (day boundaries from the
    earliest join date to ``as_of``) and segment, first matching rule wins:
    no orders -> Window; >= 3 orders -> Mission; spend above the buyers'
    average -> Rational; tenure < 30 days -> Impulsive; else Cautious."""
    per_order_user = orders.groupBy("user_id").agg(F.count("order_id").alias("o_n"),
                                                  F.sum("amount").alias("o_sum"))
    u = users.groupBy("user_id").agg(F.count(F.lit(1)).alias("u_n"), F.min("joined_at").alias("joined_at"))
    m = u.join(per_order_user, "user_id", "left").select(
        "user_id",
        (F.coalesce(F.col("o_n"), F.lit(0)) * F.col("u_n")).alias("order_count"),
        F.coalesce(F.col("o_sum") * F.col("u_n"), F.lit(0.0)).alias("total_spent"),
        F.datediff(F.lit(as_of).cast("date"), F.to_date("joined_at")).cast("long").alias("tenure_days"))
    # A single-row scalar (the buyers' average), broadcast by construction.
    avg = m.filter(F.col("order_count") > 0).agg(F.avg("total_spent").alias("avg_spent"))
    seg = (F.when(F.col("order_count") == 0, F.lit(SEG_WINDOW))
           .when(F.col("order_count") >= MISSION_MIN_ORDERS, F.lit(SEG_MISSION))
           .when(F.col("total_spent") > F.col("avg_spent"), F.lit(SEG_RATIONAL))
           .when(F.col("tenure_days") < IMPULSIVE_MAX_TENURE_DAYS, F.lit(SEG_IMPULSIVE))
           .otherwise(F.lit(SEG_CAUTIOUS)))
    return m.crossJoin(F.broadcast(avg)).select("user_id", "order_count", "total_spent", "tenure_days",
                                                seg.alias("segment"))


def user_segments(users: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """(segment, users)."""
    return (user_segment_labels(users, orders, as_of)
            .groupBy("segment").agg(F.count(F.lit(1)).alias("users")))


def segment_mix(segment_counts: DataFrame) -> DataFrame:
    """(segment, users, pct): integer percentages that sum to 100 -- each share
    truncated, the remainder added to the largest (ties by segment order),
    missing segments 0.  Empty input gives no rows.  Works on at most five
    rows, so the global windows are bounded."""
    spark = segment_counts.sparkSession
    labels = spark.createDataFrame([(s, i) for i, s in enumerate(SEGMENT_ORDER)], "segment string, seg_order int")
    c = segment_counts.groupBy("segment").agg(F.sum("users").alias("users"))
    j = labels.join(c, "segment", "left").withColumn("users", F.coalesce("users", F.lit(0)).cast("long"))
    all_rows = Window.partitionBy(F.lit(1))
    j = j.withColumn("total", F.sum("users").over(all_rows))
    j = j.withColumn("base", F.when(F.col("total") > 0, ((F.col("users").cast("double") / F.col("total")) * 100)
                                    .cast("int")).otherwise(F.lit(0)))
    j = j.withColumn("rest", F.lit(100) - F.sum("base").over(all_rows))
    j = j.withColumn("rk", F.row_number().over(all_rows.orderBy(F.desc("base"), "seg_order")))
    pct = (F.col("base") + F.when(F.col("rk") == 1, F.col("rest")).otherwise(F.lit(0))).cast("int")
    return j.filter(F.col("total") > 0).select("segment", "users", pct.alias("pct"))


def age_band(age) -> "F.Column":
    lo, hi = STUDENT_AGE
    return F.when(age.between(lo, hi), F.lit(BAND_STUDENT)).otherwise(F.lit(BAND_OFFICE))


def age_segments(users: DataFrame, age_col: str = "age") -> DataFrame:
    """(age_band, users, min_age, max_age)."""
    return (users.withColumn("age_band", age_band(F.col(age_col)))
            .groupBy("age_band").agg(F.count(F.lit(1)).alias("users"),
                                     F.min(age_col).alias("min_age"), F.max(age_col).alias("max_age")))


def cohort_retention(users: DataFrame, orders: DataFrame) -> DataFrame:
    """(cohort_week, week_number, cohort_size, retained, retention_rate):
    cohort = users by the Monday of their sign-up week, those who never ordered
    included; retained = users of the cohort with an order ``week_number``
    weeks later.  Orders from before the sign-up week do not count; a cohort
    without any order has one row with a NULL week and nobody retained."""
    def monday(c):
        return F.to_date(F.date_trunc("week", F.col(c).cast("timestamp_ntz")))

    joined = (users.where("user_id IS NOT NULL AND joined_at IS NOT NULL")
              .groupBy("user_id").agg(F.min(monday("joined_at")).alias("cohort_week")))
    # Orders fold to (user, week) before they meet the users.
    weeks = (orders.where("user_id IS NOT NULL AND order_at IS NOT NULL")
             .select("user_id", monday("order_at").alias("week")).distinct())
    later = joined.join(weeks, "user_id").where("week >= cohort_week")
    k = (F.datediff("week", "cohort_week") / 7).cast("int")
    grid = later.groupBy("cohort_week", k.alias("week_number")).agg(F.count(F.lit(1)).alias("retained"))
    sizes = joined.groupBy("cohort_week").agg(F.count(F.lit(1)).alias("cohort_size"))
    return (sizes.join(grid, "cohort_week", "left")
            .withColumn("retained", F.coalesce("retained", F.lit(0)).cast("long"))
            .select("cohort_week", "week_number", "cohort_size", "retained",
                    retention_rate(F.col("cohort_size"), F.col("retained")).alias("retention_rate")))


def persona_of(agent_id) -> "F.Column":
    """Canonical persona of an ``agent_<trait>_<n>`` id (aliases folded)."""
    t = F.regexp_extract(agent_id, r"^agent_([a-z]+)_", 1)
    out = F.when(t == "", F.lit(None))
    for k, v in PERSONA_ALIASES.items():
        out = out.when(t == k, F.lit(v))
    return out.otherwise(t)


def persona_breakdown(events: DataFrame, agent_col: str = "agent_id") -> DataFrame:
    """(run_id, persona, total, clicked, bounced, purchased, ctr): sessions
    per persona and run, a session counting once per outcome."""
    name = F.col("event_name")
    per_agent = (events.filter(F.col(agent_col).like("agent_%"))
                 .groupBy("run_id", agent_col)
                 .agg(F.max(F.when(name.like("banner%") | (name == "click_banner"), 1).otherwise(0)).alias("clicked"),
                      F.max(F.when(name == "bounce", 1).otherwise(0)).alias("bounced"),
                      F.max(F.when(name == "purchase", 1).otherwise(0)).alias("purchased")))
    return (per_agent.groupBy("run_id", persona_of(F.col(agent_col)).alias("persona"))
            .agg(F.count(F.lit(1)).alias("total"), F.sum("clicked").cast("long").alias("clicked"),
                 F.sum("bounced").cast("long").alias("bounced"), F.sum("purchased").cast("long").alias("purchased"))
            .withColumn("ctr", F.col("clicked") / F.col("total").cast("double")))


def stratified_sample_weights(df: DataFrame, stratum: str, id_col: str, value_col: str,
                              sample_pct: int = 10) -> DataFrame:
    """Deterministic hash sample (md5 bucket < ``sample_pct`` of 100) per
    stratum; each sampled row stands for population / sampled rows.  One pass:
    (stratum, population, sampled, weight, true_total, estimated_total)."""
    s = bucket_col(F.col(id_col)) < sample_pct
    g = df.groupBy(stratum).agg(
        F.count(F.lit(1)).alias("population"),
        F.count(F.when(s, 1)).alias("sampled"),
        F.sum(value_col).alias("true_total"),
        F.sum(F.when(s, F.col(value_col))).alias("_sampled_total"))
    w = F.col("population").cast("double") / F.nullif(F.col("sampled"), F.lit(0)).cast("double")
    return g.select(stratum, "population", "sampled", w.alias("weight"), "true_total",
                    (F.col("_sampled_total") * w).alias("estimated_total"))


def sample_by_stratum(df: DataFrame, stratum: str, fractions: dict, seed: int = 42) -> DataFrame:
    """Bernoulli sample per stratum (``sampleBy``) with weight = 1 / fraction,
    so weighted sums estimate the population (strata missing from
    ``fractions`` are not sampled)."""
    w = F.lit(None).cast("double")
    for k, f in fractions.items():
        w = F.when(F.col(stratum) == k, F.lit(1.0 / f)).otherwise(w) if f > 0 else w
    return df.sampleBy(stratum, fractions, seed).withColumn("weight", w)


def bottom_k_sample(df: DataFrame, stratum: str, id_col: str, k: int, seed: int = 42) -> DataFrame:
    """Exactly min(k, population) rows of each stratum: those of the least seeded md5 of the id, with
    ``population`` and ``weight`` = population / sampled.  The same rows however the input is
    partitioned; every map task passes on its k least rows only (window group limit).  Rows without a
    stratum are a stratum; rows of one id are told apart by a hash of the row."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    w = Window.partitionBy(stratum).orderBy("_key", id_col, "_row")
    least = (df.withColumns({"_key": key, "_row": F.xxhash64(*df.columns)})
             .withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_key", "_row", "_rank"))
    sizes = df.groupBy(F.col(stratum).alias("_stratum")).agg(F.count(F.lit(1)).alias("population"))
    weight = F.col("population").cast("double") / F.least(F.col("population"), F.lit(k)).cast("double")
    return least.join(sizes, F.col(stratum).eqNullSafe(F.col("_stratum"))).drop("_stratum").withColumn("weight", weight)
