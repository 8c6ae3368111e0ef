"""The experiment data model derived from the driver's parquet tables.

The modelled application keeps assignments, events, users, orders,
experiments and adoptions.  The test data holds a generic event stream and a
TPC-H-like star schema, so the experiment tables are *derived* from them, by
Spark, with work that grows with the input:

* ``events``        -- one experiment event per driver event; one calendar day
                       is one run (``run_yyyymmdd``).
* ``assignments``   -- one assignment per (user, day), variant by md5 bucket.
* ``users``/``orders`` -- customers and all their orders.
* ``experiments``   -- one read-out per run (click-through, B vs A).
* ``adoptions``     -- runs where B beat A (positive lift) were adopted.

Every frame is a lazy plan; nothing is cached or collected.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlens.functions.hashing import bucket_col, variant_col
from splitlens.sources.tables import read_table

# Fixed values of the derivation (documented in FIXTURES.md).
EXPERIMENT_ID = "exp_default"
AS_OF_SEGMENTS = "2001-08-01"
TARGET_COUNT = 4


def run_id_of(ts_col) -> "F.Column":
    return F.concat(F.lit("run_"), F.date_format(ts_col, "yyyyMMdd"))


class Fixtures:
    """Experiment tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str, columns=None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, columns)

    @cached_property
    def events(self) -> DataFrame:
        e = self.table("events", ["event_id", "ts", "user_id", "event_type", "value"])
        name = (F.when(e.event_type == "click",
                       F.when(e.event_id % 2 == 0, F.lit("click_banner")).otherwise(F.lit("banner_B")))
                .when(e.event_type == "view", F.lit("page_view"))
                .when(e.event_type == "error", F.lit("bounce"))
                .otherwise(e.event_type))
        return e.select(
            e.event_id.cast("string").alias("event_id"),
            e.user_id.cast("string").alias("user_id"),
            name.alias("event_name"),
            e.ts.alias("timestamp"),
            F.when(e.event_type == "purchase", e.value).otherwise(F.lit(0.0)).alias("value"),
            run_id_of(e.ts).alias("run_id"),
        )

    @cached_property
    def assignments(self) -> DataFrame:
        e = self.table("events", ["ts", "user_id"])
        per_day = (e.groupBy("user_id", F.to_date("ts").alias("day"))
                   .agg(F.min("ts").alias("assigned_at")))
        uid = F.col("user_id").cast("string")
        return per_day.select(
            uid.alias("user_id"),
            F.lit(EXPERIMENT_ID).alias("experiment_id"),
            variant_col(bucket_col(uid)).alias("variant"),
            F.col("assigned_at"),
            F.concat(F.lit("run_"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
            (F.lit(1.0) + (F.col("user_id") % 4).cast("double") * 0.5).alias("weight"),
        )

    # The same rows under the id families of the application: every tenth user
    # is the shared ``guest``, three in ten are history users; both are outside
    # runs (NULL).  Two in ten are agents.  A guest has an assignment for each
    # of the users it stands for, so assignments repeat.
    def _hard(self, df: DataFrame) -> DataFrame:
        u = F.col("user_id").cast("long") % 10
        uid = (F.when(u == 0, F.lit("guest")).when(u <= 3, F.concat(F.lit("user_hist_"), F.col("user_id")))
               .when(u <= 5, F.concat(F.lit("agent_mission_"), F.col("user_id"))).otherwise(F.col("user_id")))
        return df.withColumns({"run_id": F.when(u > 3, F.col("run_id")), "user_id": uid})

    @cached_property
    def hard_events(self) -> DataFrame:
        return self._hard(self.events)

    @cached_property
    def hard_assignments(self) -> DataFrame:
        return self._hard(self.assignments)

    @cached_property
    def users(self) -> DataFrame:
        c = self.table("customer", ["c_custkey", "c_name", "c_mktsegment"])
        return c.select(
            c.c_custkey.cast("string").alias("user_id"),
            c.c_name.alias("name"),
            c.c_mktsegment.alias("segment"),
            F.date_sub(F.lit(AS_OF_SEGMENTS).cast("date"), (c.c_custkey % 90).cast("int")).alias("joined_at"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        o = self.table("orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
        return o.select(o.o_orderkey.cast("string").alias("order_id"),
                        o.o_custkey.cast("string").alias("user_id"),
                        o.o_orderdate.alias("order_at"),
                        o.o_totalprice.alias("amount"))

    @cached_property
    def run_counts(self) -> DataFrame:
        """Users and click-through converters per (run, variant)."""
        from splitlens.operators.metrics import ab_primary
        return ab_primary(self.assignments, self.events, metric="CTR")

    @cached_property
    def experiments(self) -> DataFrame:
        """One experiment record per run with A and B present."""
        c = self.run_counts
        # One pass over the counts: A and B side by side per run (both present).
        pick = lambda v, col: F.max(F.when(F.col("variant") == v, F.col(col)))
        j = (c.groupBy("run_id")
             .agg(pick("A", "users").alias("au"), pick("A", "conversions").alias("ac"),
                  pick("B", "users").alias("bu"), pick("B", "conversions").alias("bc"))
             .filter(F.col("au").isNotNull() & F.col("bu").isNotNull()))
        cr = F.col("ac").cast("double") / F.col("au")
        tr = F.col("bc").cast("double") / F.col("bu")
        pooled = (F.col("ac") + F.col("bc")).cast("double") / (F.col("au") + F.col("bu"))
        se = F.sqrt(pooled * (1 - pooled) * (F.lit(1.0) / F.col("au") + F.lit(1.0) / F.col("bu")))
        j = j.select("run_id", cr.alias("cr"), tr.alias("tr"), se.alias("se"))
        z = (F.col("tr") - F.col("cr")) / F.nullif(F.col("se"), F.lit(0.0))
        return j.select(
            "run_id",
            F.concat(F.lit("target_"), (F.substring("run_id", -2, 2).cast("int") % TARGET_COUNT)
                     .cast("string")).alias("target"),
            F.concat(F.lit("hypothesis "), F.col("run_id")).alias("hypothesis"),
            F.lit("CTR").alias("primary_metric"),
            F.col("cr").alias("control_rate"),
            F.col("tr").alias("test_rate"),
            ((F.col("tr") - F.col("cr")) / F.nullif(F.col("cr"), F.lit(0.0))).alias("lift"),
            z.alias("z_score"),
            F.when(F.abs(z) > 1.959963984540054,
                   F.when(F.col("tr") > F.col("cr"), F.lit("Significant Winner"))
                   .otherwise(F.lit("Significant Loser")))
             .otherwise(F.lit("Inconclusive")).alias("decision"),
        )

    @cached_property
    def designs(self) -> DataFrame:
        """The design of each run (target, hypothesis, primary metric): a
        function of the run id, so it needs no read-out."""
        runs = self.assignments.select("run_id").filter(F.col("run_id").isNotNull()).distinct()
        return runs.select(
            "run_id",
            F.concat(F.lit("target_"), (F.substring("run_id", -2, 2).cast("int") % TARGET_COUNT)
                     .cast("string")).alias("target"),
            F.concat(F.lit("hypothesis "), F.col("run_id")).alias("hypothesis"),
            F.lit("CTR").alias("primary_metric"))

    @cached_property
    def adoptions(self) -> DataFrame:
        x = self.experiments
        cfg = F.concat(F.lit('{"winning_variant":"B","target":"'), x.target,
                       F.lit('","config":{"title":"t_'), F.substring(x.run_id, -2, 2),
                       F.lit('","theme":"Red"},"lift":0.5}'))
        adopted_at = F.to_date(F.substring(x.run_id, 5, 8), "yyyyMMdd")
        return x.filter(x.lift > 0).select(x.run_id.alias("experiment_id"),
                                          cfg.alias("variant_config"),
                                          adopted_at.alias("adopted_at"))
