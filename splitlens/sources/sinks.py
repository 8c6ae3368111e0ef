"""Writers: table creation, appends, replace, range replace, deletes.

Everything writes through the DataFrame writer or SQL DDL; nothing is
collected except partition values (bounded by the number of partitions) when
partitions are dropped.  Columns are always matched by name.

Tables made with ``create_tables(versioned=...)`` (see ``versions``) are replaced, range-replaced and
deleted from in one step, whatever their partitions; plain ones partition by partition.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitlens.operators.maintenance import delete_rows, evolve
from splitlens.session import checkpoint_dir
from splitlens.sources import schemas, versions

EVENT_DATE = "event_date"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def table_schema(name: str) -> T.StructType:
    s = schemas.EXPERIMENT.get(name) or schemas.WAREHOUSE[name]
    if name == "events":
        s = T.StructType(s.fields + [T.StructField(EVENT_DATE, T.DateType(), True)])
    return s


def create_tables(spark: SparkSession, database: str = "experiment", reset: bool = False,
                  location: str | None = None, kind: str | None = None, versioned: tuple[str, ...] = (),
                  buckets: int | None = None) -> list[str]:
    """CREATE TABLE IF NOT EXISTS for every table of a catalogue namespace
    (``kind``: 'experiment' or 'warehouse'; default: the database name, else
    'experiment') in ``database`` -- parquet, partitioned as in
    ``schemas.PARTITIONING``; ``reset`` drops them first.  The tables named in ``versioned`` change in
    one step (``versions``).  With ``buckets``, tables with a user are stored in so many buckets, sorted by user,
    so that joins and folds by user read matching buckets instead of shuffling (``session.co_located``);
    choose it so that a bucket of a run's day is no tiny file and one of the whole table fits a task."""
    kind = kind or (database if database in schemas.CATALOGUE else "experiment")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    made = []
    for name in schemas.CATALOGUE[kind]:
        full = f"{database}.{name}"
        if reset:
            versions.drop(spark, full)
            spark.sql(f"DROP TABLE IF EXISTS {full}")
        parts = schemas.PARTITIONING.get(name)
        by = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        if buckets and "user_id" in table_schema(name).names:
            by += f" CLUSTERED BY (user_id) SORTED BY (user_id) INTO {buckets} BUCKETS"
        if name in versioned:
            if not spark.catalog.tableExists(full):
                first = versions.new_version(full)
                spark.sql(f"CREATE TABLE {first} ({_ddl(table_schema(name))}) USING parquet{by}")
                versions.point(spark, full, first)
        else:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({_ddl(table_schema(name))}) USING parquet{by}")
        made.append(full)
    return made


def load_csv_table(spark: SparkSession, path: str, table: str, schema: T.StructType | None = None,
                   infer: bool = False) -> bool:
    """Load a CSV file (header row) into ``table``, replacing it; an explicit
    schema is the default, inference is opt-in.  A missing file leaves the
    table alone and returns False with a warning."""
    import warnings

    from splitlens.sources.tables import read_csv
    try:
        df = read_csv(spark, path, schema, infer)
        df.schema  # noqa: B018 - resolves the path now
    except Exception as ex:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(ex) or "does not exist" in str(ex):
            warnings.warn(f"{path} not found; {table} not loaded", stacklevel=2)
            return False
        raise
    replace_table(df, table)
    return True


def load_csv_checked(spark: SparkSession, path: str, table: str, schema: T.StructType, quarantine: str) -> tuple[int, int]:
    """Load a CSV file or folder into ``table``, replacing it; records that do not fit ``schema`` are appended to the table
    ``quarantine`` (source_file, record, reason, loaded_at) instead of becoming NULLs.  Returns
    the numbers of rows loaded and quarantined, which add up to the input's."""
    from splitlens.sources.tables import read_csv_checked
    parsed = staged(read_csv_checked(spark, path, schema))      # the input is parsed once
    good, bad = parsed.where("_record IS NULL"), parsed.where("_record IS NOT NULL")
    replace_table(good.select(*schema.names), table)
    rows = bad.select(F.col("_file").alias("source_file"), F.col("_record").alias("record"), F.col("_reason").alias("reason"),
                      F.localtimestamp().alias("loaded_at"))
    rows.write.mode("append").format("parquet").saveAsTable(quarantine)
    return good.count(), bad.count()


def insert_by_name(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert matching columns by name (absent ones NULL), never by position."""
    table = versions.physical(df.sparkSession, table)
    evolve(df, df.sparkSession.table(table).schema, defaults={}).write.insertInto(table, overwrite=overwrite)


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared folder."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def overwrite_partitions(rows: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that ``rows`` -- a staged table -- has
    rows of.  The overwrite mode is set in a session of its own, which shares
    the catalogue; the caller's session and its other writes keep theirs."""
    spark = rows.sparkSession
    if versions.is_versioned(spark, table):
        cols = versions.partition_columns(spark, table)
        stored = spark.table(table)
        touched = rows.select(*[F.col(c).alias(f"_new_{c}") for c in cols]).distinct()
        same = [stored[c].eqNullSafe(F.col(f"_new_{c}")) for c in cols]
        versions.publish(stored.join(touched, same, "left_anti").unionByName(evolve(rows, stored.schema, defaults={})), table)
        return
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    insert_by_name(own.read.schema(rows.schema).parquet(*{f.rsplit("/", 1)[0] for f in rows.inputFiles()}), table, overwrite=True)
    spark.catalog.refreshTable(table)


def append_events(events: DataFrame, table: str = "experiment.events") -> None:
    """Append events; a missing id becomes a uuid, a missing time the current
    time, a missing value 0.0; the date partition is derived."""
    cols = set(events.columns)
    e = events
    e = e.withColumn("event_id", F.coalesce(F.col("event_id"), F.expr("uuid()")) if "event_id" in cols
                     else F.expr("uuid()"))
    e = e.withColumn("timestamp", F.coalesce(F.col("timestamp"), F.localtimestamp()) if "timestamp" in cols
                     else F.localtimestamp())
    e = e.withColumn("value", F.coalesce(F.col("value"), F.lit(0.0)) if "value" in cols else F.lit(0.0))
    e = e.withColumn(EVENT_DATE, F.to_date("timestamp"))
    insert_by_name(e, table)


def bulk_append(df: DataFrame, table: str) -> None:
    insert_by_name(df, table)


def replace_table(df: DataFrame, table: str, partition_by=None) -> None:
    """Create-or-replace a table from a frame (the mart build); a versioned one in one step."""
    if versions.is_versioned(df.sparkSession, table):
        versions.publish(df, table, list(partition_by or []))
        return
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def _drop_partitions(spark: SparkSession, table: str, predicate: Column) -> None:
    """Drop the partitions whose partition columns meet ``predicate``.  Their
    values are listed on the driver: one row per partition dropped (the days
    of a run, or of a range), not per row."""
    if versions.is_versioned(spark, table):
        versions.publish(delete_rows(spark.table(table), predicate), table)
        return
    cols = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    gone = spark.table(table).filter(predicate).select(*cols).distinct().collect()
    specs = []
    for r in gone:
        pairs = ["{} = {}".format(c, "NULL" if r[c] is None else "'" + str(r[c]).replace("'", "\\'") + "'") for c in cols]
        specs.append(f"PARTITION ({', '.join(pairs)})")
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
        spark.catalog.refreshTable(table)


def range_replace(new: DataFrame, table: str, key: str = "report_date") -> None:
    """Replace every stored ``key`` >= min(new.key) with ``new``: partitions
    present in ``new`` are overwritten (dynamic partition overwrite), stored
    partitions in the range that ``new`` lacks are dropped.  A versioned table changes in one
    step, a plain one per partition."""
    spark = new.sparkSession
    rows = staged(new)       # a mart: one row per day
    lo = rows.agg(F.min(key)).first()[0]
    if lo is None:
        return
    if versions.is_versioned(spark, table):
        stored = spark.table(table)
        below = stored.where(F.coalesce(F.col(key) < F.lit(lo), F.lit(True)))
        versions.publish(below.unionByName(evolve(rows, stored.schema, defaults={})), table)
        return
    kept = rows.select(key).filter(F.col(key).isNotNull()).distinct()
    # Stored values of the range that the batch lacks; one per partition.
    stale = (spark.table(table).filter(F.col(key) >= F.lit(lo)).select(key).distinct()
             .join(kept, key, "left_anti").collect())
    overwrite_partitions(rows, table)
    if stale:
        _drop_partitions(spark, table, F.col(key).isin([r[0] for r in stale]))


def delete_where(spark: SparkSession, table: str, predicate: Column, partition_col: str | None = None,
                 partition_value=None) -> None:
    """DELETE FROM table WHERE predicate.  A predicate on the partition column
    drops the partitions of that value; anything else writes the rows that stay anew.  A versioned table
    changes in one step.  A plain one goes through a staging table whose name is swapped with its own: if the
    new name cannot be set, the old one is set back, but a job that is killed between the two
    renames leaves the rows under ``<table>__old``."""
    if versions.is_versioned(spark, table):
        gone = predicate if partition_col is None else F.col(partition_col).eqNullSafe(F.lit(partition_value))
        versions.publish(delete_rows(spark.table(table), gone), table)
        return
    if partition_col is not None:
        _drop_partitions(spark, table, F.col(partition_col).eqNullSafe(F.lit(partition_value)))
        return
    kept = delete_rows(spark.table(table), predicate)
    staging = f"{table}__rewrite"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    part_cols = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    w = kept.write.mode("overwrite").format("parquet")
    if part_cols:
        w = w.partitionBy(*part_cols)
    w.saveAsTable(staging)
    # The original is dropped only after the new table is in place.
    old = f"{table}__old"
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {old}")
    if part_cols:
        # The rename moves the files; partition locations are re-discovered.
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")


def copy_tables(spark: SparkSession, src_db: str, dst_db: str, keys: dict[str, list[str]]) -> dict[str, bool]:
    """Copy each table's rows that the destination lacks (insert ... on
    conflict do nothing), skipping empty sources; returns which were copied."""
    from splitlens.operators.maintenance import copy_new_rows
    done = {}
    for table, key in keys.items():
        src = spark.table(f"{src_db}.{table}")
        if src.isEmpty():
            done[table] = False
            continue
        dst = spark.table(f"{dst_db}.{table}")
        # The new rows are written to the shared checkpoint folder before they
        # are appended to the very table they were compared against.
        checkpoint_dir(spark)
        staged = copy_new_rows(src, dst, key).checkpoint(eager=True)
        insert_by_name(staged, f"{dst_db}.{table}")
        done[table] = True
    return done


def append_experiment_record(record: DataFrame, table: str = "experiment.experiments") -> None:
    """Append experiment records stamped with created_at and an id."""
    r = record.withColumn("created_at", F.localtimestamp())
    r = r.withColumn("exp_id", F.xxhash64("run_id", "created_at"))
    insert_by_name(r, table)


def adopt(readout: DataFrame, table: str = "experiment.adoptions",
          active_table: str | None = "experiment.active_experiment",
          winning_variant: str = "B") -> None:
    """Record adoptions for the runs of ``readout`` (run_id, target, config,
    lift, p_value): the payload is JSON; adopting ends the active experiment.  ``config`` is a map, a
    VARIANT, or JSON text (text that is no JSON gives no config)."""
    kind = dict(readout.dtypes).get("config")
    cfg = F.try_parse_json("config") if kind == "string" else F.col("config") if kind else F.lit(None).cast("map<string,string>")
    payload = F.to_json(F.struct(F.lit(winning_variant).alias("winning_variant"), F.col("target"),
                                 cfg.alias("config"), F.col("lift"), F.col("p_value")))
    rows = readout.select(F.col("run_id").alias("experiment_id"), payload.alias("variant_config"),
                          F.localtimestamp().alias("adopted_at"))
    insert_by_name(rows, table)
    if active_table:
        deactivate(readout.sparkSession, active_table)


def activate(spark: SparkSession, table: str = "experiment.active_experiment") -> None:
    """Mark an experiment as running: the table holds exactly one row."""
    row = spark.range(1).select(F.lit(1).alias("id"), F.lit(True).alias("is_active"),
                                F.localtimestamp().alias("started_at"))
    insert_by_name(row, table, overwrite=True)


def deactivate(spark: SparkSession, table: str = "experiment.active_experiment") -> None:
    insert_by_name(spark.createDataFrame([], spark.table(table).schema), table, overwrite=True)


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
               batch_size: int = 10000) -> None:
    """Batched JDBC write (PostgreSQL or any JDBC target; driver jar needed)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()
