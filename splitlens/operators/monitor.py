"""Monitoring: live pulse, KPI cards, funnel, alerts, recent events, runs.

Screens read either raw events (one filtered scan with conditional
aggregates, or a top-k) or the daily mart (one row per day, so operations
over the whole mart are bounded by the number of days, not by the data).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitlens.operators.metrics import is_purchase

# Fixed alert rules of the modelled dashboard.
CTR_MIN = 0.05
REVENUE_RATIO_MIN = 0.7
CVR_MIN = 0.01
ACTIVE_WINDOW_MINUTES = 30
EVENT_DATE = "event_date"        # date partition of stored events


def _ts(v) -> Column:
    if isinstance(v, (dt.datetime, str)):
        return F.lit(str(v)).cast("timestamp_ntz")
    return v


def live_pulse(events: DataFrame, as_of, window_minutes: int = ACTIVE_WINDOW_MINUTES) -> DataFrame:
    """Active users in the last ``window_minutes`` and purchases / revenue since
    midnight, all up to ``as_of``; one filtered scan (the bounds reach the
    parquet reader), conditional aggregates."""
    t = _ts(as_of)
    day = F.to_date(t).cast("timestamp_ntz")
    start = t - F.expr(f"INTERVAL {int(window_minutes)} MINUTES")
    ts = F.col("timestamp")
    scan = events.filter((ts >= F.least(start, day)) & (ts <= t))
    if EVENT_DATE in events.columns:        # stored events: open only the days of the window
        scan = scan.filter(F.col(EVENT_DATE).between(F.to_date(F.least(start, day)), F.to_date(t)))
    recent = ts >= start
    today = (ts >= day) & is_purchase(F.col("event_name"))
    return scan.agg(
        F.count_distinct(F.when(recent, F.col("user_id"))).alias("active_users"),
        F.count(F.when(today, F.lit(1))).alias("today_orders"),
        F.coalesce(F.sum(F.when(today, F.col("value"))), F.lit(0.0)).alias("today_revenue"))


def daily_purchases(events: DataFrame) -> DataFrame:
    """(day, orders, revenue): purchase rows and revenue per calendar day --
    the batch form of the live revenue counter (stream: T3)."""
    p = events.filter(is_purchase(F.col("event_name")))
    return p.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("revenue"))


def active_users_windows(events: DataFrame, window_minutes: int = ACTIVE_WINDOW_MINUTES,
                         slide_minutes: int = 5) -> DataFrame:
    """(window_start, window_end, active_users): distinct users per sliding
    window (the batch form of T2).  Users are counted once per slide first, so
    an event is one row in the shuffle, a hot user one per slide; only those
    rows are copied to the windows that hold them."""
    slots, slide = window_minutes // slide_minutes, slide_minutes * 60
    slot = F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / slide).cast("long")
    seen = events.where(F.col("timestamp").isNotNull()).select(slot.alias("slot"), "user_id").distinct()
    per_user = seen.select(F.explode(F.sequence(F.col("slot") - (slots - 1), F.col("slot"))).alias("first"), "user_id").distinct()
    start = F.timestamp_seconds(F.col("first") * slide)
    return (per_user.groupBy("first").agg(F.count(F.lit(1)).alias("active_users"))
            .select(start.cast("timestamp_ntz").alias("window_start"),
                    (start + F.expr(f"INTERVAL {int(window_minutes)} MINUTES")).cast("timestamp_ntz").alias("window_end"),
                    "active_users"))


def latest_two(mart: DataFrame) -> DataFrame:
    """Newest and previous mart day (previous = newest when there is one day)
    as one row of structs; top-2, not a sort of the mart."""
    top = mart.filter(F.col("report_date").isNotNull()).orderBy(F.desc("report_date")).limit(2)
    row = F.struct(*[F.col(c) for c in mart.columns])
    return top.agg(F.max_by(row, F.col("report_date")).alias("cur"),
                   F.min_by(row, F.col("report_date")).alias("prev"))


def _field(df_cols, prefix: str, name: str) -> Column:
    return F.col(f"{prefix}.{name}") if name in df_cols else F.lit(0)


def kpi_cards(mart: DataFrame) -> DataFrame:
    """Mean daily revenue and AOV, latest CVR, day-over-day differences
    (revenue and AOV truncated like int(); missing metrics give NULL)."""
    cols = set(mart.columns)
    means = mart.filter(F.col("report_date").isNotNull()).agg(
        (F.avg("total_revenue") if "total_revenue" in cols else F.lit(None).cast("double")).alias("avg_revenue"),
        (F.avg("aov") if "aov" in cols else F.lit(None).cast("double")).alias("avg_aov"))
    lt = latest_two(mart)

    def diff(c, trunc):
        if c not in cols:
            return F.lit(None).cast("double")
        d = F.col(f"cur.{c}") - F.col(f"prev.{c}")
        return d.cast("long") if trunc else d

    out = lt.select(F.col("cur.report_date").alias("latest_date"),
                    (F.col("cur.cvr") if "cvr" in cols else F.lit(None).cast("double")).alias("latest_cvr"),
                    diff("total_revenue", True).alias("revenue_delta"),
                    diff("aov", True).alias("aov_delta"),
                    diff("cvr", False).alias("cvr_delta"))
    # Both sides are single-row aggregates.
    return means.crossJoin(out)


def kpi_funnel(mart: DataFrame) -> DataFrame:
    """Funnel of the newest day: users -> clicks -> orders (0 if a column is
    missing)."""
    cols = set(mart.columns)
    lt = latest_two(mart)
    stages = F.array(
        F.struct(F.lit(1).alias("step"), F.lit("Total Users").alias("stage"), _field(cols, "cur", "total_users").cast("long").alias("users")),
        F.struct(F.lit(2).alias("step"), F.lit("Clicks").alias("stage"), _field(cols, "cur", "click_count").cast("long").alias("users")),
        F.struct(F.lit(3).alias("step"), F.lit("Orders").alias("stage"), _field(cols, "cur", "total_orders").cast("long").alias("users")))
    return (lt.filter(F.col("cur").isNotNull())
            .select(F.col("cur.report_date").alias("report_date"), F.explode(stages).alias("s"))
            .select("report_date", "s.step", "s.stage", "s.users"))


def kpi_alerts(mart: DataFrame, ctr_min: float = CTR_MIN, revenue_ratio_min: float = REVENUE_RATIO_MIN,
               cvr_min: float = CVR_MIN, latest_only: bool = False, consecutive_days: int = 1) -> DataFrame:
    """Alert rows (report_date, level, metric, value, threshold, drop_pct):
    CTR below ``ctr_min`` (Critical), revenue below ``revenue_ratio_min`` of the
    previous day with previous > 0 (Warning), CVR below ``cvr_min`` (Critical).
    Missing metric columns raise no alert.  ``consecutive_days`` > 1 raises
    the CTR alert only after that many low days in a row.  Evaluated for every
    day; the windows run over the mart, one row per day."""
    cols = set(mart.columns)
    m = mart.filter(F.col("report_date").isNotNull())
    if "ctr" in cols and consecutive_days > 1:
        run = Window.orderBy("report_date").rowsBetween(-(consecutive_days - 1), 0)
        m = m.withColumn("_low_days", F.sum(F.when(F.col("ctr") < ctr_min, 1).otherwise(0)).over(run))
    if "total_revenue" in cols:
        m = m.withColumn("_prev_rev", F.lag("total_revenue").over(Window.orderBy("report_date")))
    rules = []
    if "ctr" in cols:
        low = (F.col("_low_days") >= consecutive_days) if consecutive_days > 1 else (F.col("ctr") < ctr_min)
        rules.append(F.when(low, F.struct(
            F.lit("Critical").alias("level"), F.lit("ctr").alias("metric"), F.col("ctr").alias("value"),
            F.lit(ctr_min).alias("threshold"), F.lit(None).cast("double").alias("drop_pct"))))
    if "total_revenue" in cols:
        ratio = F.col("total_revenue") / F.nullif(F.col("_prev_rev"), F.lit(0.0))
        rules.append(F.when((F.col("_prev_rev") > 0) & (ratio < revenue_ratio_min), F.struct(
            F.lit("Warning").alias("level"), F.lit("total_revenue").alias("metric"),
            F.col("total_revenue").alias("value"), F.lit(None).cast("double").alias("threshold"),
            ((1 - ratio) * 100).alias("drop_pct"))))
    if "cvr" in cols:
        rules.append(F.when(F.col("cvr") < cvr_min, F.struct(
            F.lit("Critical").alias("level"), F.lit("cvr").alias("metric"), F.col("cvr").alias("value"),
            F.lit(cvr_min).alias("threshold"), F.lit(None).cast("double").alias("drop_pct"))))
    if not rules:
        return m.select("report_date").limit(0).select(
            "report_date", *[F.lit(None).cast(t).alias(c) for c, t in
                             [("level", "string"), ("metric", "string"), ("value", "double"),
                              ("threshold", "double"), ("drop_pct", "double")]])
    fired = F.filter(F.array(*rules), lambda r: r.isNotNull())
    out = m.select("report_date", F.explode(fired).alias("a")).select(
        "report_date", "a.level", "a.metric", "a.value", "a.threshold", "a.drop_pct")
    if latest_only:
        newest = m.agg(F.max("report_date").alias("_d"))
        out = out.join(F.broadcast(newest), out.report_date == newest._d).drop("_d")
    return out.drop("_low_days") if "_low_days" in out.columns else out


def kpi_threshold_series(mart: DataFrame, metric: str, threshold: float | None) -> DataFrame:
    """report_date, value, threshold, breached for one metric of the mart."""
    v = F.col(metric).cast("double")
    thr = F.lit(threshold).cast("double")
    return mart.select("report_date", F.lit(metric).alias("metric"), v.alias("value"), thr.alias("threshold"),
                       F.when(thr.isNull(), F.lit(False)).otherwise(v < thr).alias("breached"))


def _display(df: DataFrame) -> DataFrame:
    name = F.col("event_name")
    label = F.when(is_purchase(name), F.concat(F.lit("Purchase (User_"), F.expr("right(user_id, 4)"),
                                               F.lit(": "), F.col("value").cast("long").cast("string"),
                                               F.lit(")"))).otherwise(F.concat(F.lit("Action: "), name))
    return (df.withColumn("time", F.date_format("timestamp", "HH:mm:ss"))
            .withColumn("user_suffix", F.expr("right(user_id, 4)"))
            .withColumn("label", label))


def recent_events(events: DataFrame, k: int = 3, by: str | None = None, user_like: str | None = None,
                  since=None) -> DataFrame:
    """Newest ``k`` events overall, or per ``by`` (e.g. run_id), ties broken by
    event id, with display fields; ``user_like`` restricts to an id family
    (e.g. 'user_hist_%').  Per group this is a window top-k, which Spark
    limits per partition before the shuffle (WindowGroupLimit).  ``since``
    bounds the time, and the date partitions that are opened."""
    if since is not None:
        events = events.filter(F.col("timestamp") >= _ts(since))
        if EVENT_DATE in events.columns:
            events = events.filter(F.col(EVENT_DATE) >= F.to_date(_ts(since)))
    cols = ["event_id", "user_id", "event_name", "value", "timestamp", "run_id"]
    if user_like:
        events = events.filter(F.col("user_id").like(user_like))
    if by is None:
        top = events.select(*cols).orderBy(F.desc("timestamp"), F.desc("event_id")).limit(k)
        top = top.withColumn("rank", F.lit(None).cast("int"))
    else:
        w = Window.partitionBy(by).orderBy(F.desc("timestamp"), F.desc("event_id"))
        top = (events.filter(F.col(by).isNotNull()).select(*cols)
               .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
    return _display(top)


def active_runs(assignments: DataFrame, k: int = 5) -> DataFrame:
    """Newest ``k`` distinct non-NULL run ids."""
    return (assignments.filter(F.col("run_id").isNotNull()).select("run_id").distinct()
            .orderBy(F.desc("run_id")).limit(k))


def run_progress(assignments: DataFrame, needed: int = 100) -> DataFrame:
    """Per (run, variant): assignment rows, distinct visitors, weighted
    visitors; per run: rows, effective rows (sum of weights, truncated) and
    progress = min(rows / needed, 1)."""
    per = (assignments.filter(F.col("run_id").isNotNull())
           .groupBy("run_id", "variant")
           .agg(F.count(F.lit(1)).alias("assignments"),
                F.count_distinct("user_id").alias("visitors"),
                F.sum("weight").alias("weighted_visitors")))
    runs = per.groupBy("run_id").agg(F.sum("assignments").alias("run_assignments"),
                                     F.sum("weighted_visitors").alias("_w"))
    runs = runs.select("run_id", "run_assignments",
                       F.col("_w").cast("long").alias("effective_assignments"),
                       (F.least(F.col("run_assignments") / F.lit(float(needed)), F.lit(1.0))
                        if needed > 0 else F.lit(0.0)).alias("progress"))
    return per.join(runs, "run_id")


def prefix_counts(events: DataFrame, assignments: DataFrame) -> DataFrame:
    """Row counts for the id / event-name families matched with LIKE
    (``_`` is a wildcard): banner%, banner_%, user_hist_%, agent_%."""
    name = F.col("event_name")
    e = events.agg(F.count(F.when(name.like("banner%"), 1)).alias("banner_events"),
                   F.count(F.when(name.like("banner_%"), 1)).alias("banner_underscore_events"))
    uid = F.col("user_id")
    a = assignments.agg(F.count(F.when(uid.like("user_hist_%"), 1)).alias("history_assignments"),
                        F.count(F.when(uid.like("agent_%"), 1)).alias("agent_assignments"))
    return e.crossJoin(a)
