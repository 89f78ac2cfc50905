"""

``events`` plays a measurement: ``ts`` is the time, ``event_type`` a tag, ``value`` and ``user_id`` are fields. Jobs are
run as of a fixed day. Each query reads its tables whole. Queries that write do so in a database of their own under the
shared folder.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronoloom import configure  # noqa: E402
from chronoloom.functions.buckets import time_bucket  # noqa: E402
from chronoloom.functions.timeunits import generated_time, to_micros, to_nanos, to_time  # noqa: E402
from chronoloom.operators import measurements as store  # noqa: E402
from chronoloom.operators.lines_out import record_lines, table_lines, write_lines  # noqa: E402
from chronoloom.operators.merge import rows_per_measurement, sparse_merge  # noqa: E402
from chronoloom.operators.results import epoch_rows, row_counts, run_sql  # noqa: E402
from chronoloom.operators.statistics import merged_statistics, refresh_statistics  # noqa: E402
from chronoloom.plans import compaction, continuous, deletion, retention  # noqa: E402
from chronoloom.plans.loading import append_each, append_lines  # noqa: E402
from chronoloom.session import shared_dir  # noqa: E402
from chronoloom.sources.batches import batch_rows  # noqa: E402
from chronoloom.sources.columnar import columnar_batches, columnar_rows  # noqa: E402
from chronoloom.sources.frames import table_rows  # noqa: E402
from chronoloom.sources.lines import parse_lines, read_lines, typed_rows  # noqa: E402
from chronoloom.sources.records import record_rows  # noqa: E402
from chronoloom.streaming.ingest import expose, ingested, into_measurement, start_ingest, stream_points  # noqa: E402
from chronoloom.streaming.rollup import rollup, rollup_into  # noqa: E402

LLM = importlib.util.find_spec("chronoloom.llm") is not None and importlib.util.find_spec("corpus_pipeline") is not None

AS_OF = "2024-01-31"
BASE_US = 1_700_000_000_000_000
BATCH = 1000
HOURLY = (
    "SELECT time_bucket('1 hour', time) AS time, event_type, round(avg(value), 6) AS value, max(value) AS top "
    "FROM {source} GROUP BY 1, 2"
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Events as rows of a measurement."""
    return table_rows(_table(spark, sf_dir, "events").select("ts", *columns), "ts")


def _shown(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables hold them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/run-{uuid4().hex}"


def _database(spark: SparkSession) -> str:
    name = f"run_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def _loaded(spark: SparkSession, sf_dir: str, *columns: str) -> str:
    """A database that holds the events as measurement ``ticks``."""
    database = _database(configure(spark))
    rows = _events(spark, sf_dir, *(columns or ("event_id", "event_type", "user_id", "value")))
    store.append(rows, database, "ticks", tags=["event_type"])
    return database


# Query


def _downsample_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir, "event_type", "value")
    return _shown(spark.sql(HOURLY.format(source="{events}"), events=events))


def _bucket(width: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        grouped = _events(spark, sf_dir, "value").groupBy(time_bucket(width, "time").alias("time"))
        return _shown(grouped.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("value")))

    return query


def _shipped_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table_rows(_table(spark, sf_dir, "lineitem").select("l_shipdate", "l_returnflag", "l_quantity"), "l_shipdate")
    sql = (
        "SELECT time_bucket('1 month', time) AS time, l_returnflag, avg(l_quantity) AS quantity, "
        "max(l_quantity) AS top, count(*) AS n FROM {lines} GROUP BY 1, 2"
    )
    return _shown(spark.sql(sql, lines=lines).withColumn("quantity", F.round("quantity", 6)))


def _tag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    sql = "SELECT time, event_id, event_type, user_id, value FROM ticks WHERE event_type = 'purchase'"
    return _shown(run_sql(spark, sql, database))


def _recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    sql = f"SELECT time, event_id, value FROM ticks WHERE time > TIMESTAMP'{AS_OF} 00:00:00' - INTERVAL '36 hours'"
    return _shown(run_sql(spark, sql, database))


def _day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    part = store.time_range(store.read(spark, database, "ticks"), "2024-01-05T12:00:00Z", "2024-01-09")
    return _shown(part)


def _latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir, "event_id", "event_type", "value")
    return _shown(spark.sql("SELECT * FROM {events} ORDER BY time DESC, event_id DESC LIMIT 10", events=events))


def _tag_avg_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir, "event_type", "user_id", "value")
    sql = "SELECT event_type, round(avg(value), 6) AS value, max(user_id) AS top_user FROM {events} GROUP BY event_type"
    return spark.sql(sql, events=events)


def _days_opened(df: DataFrame) -> int:
    return len({path.split("day=")[1].split("/")[0] for path in df.inputFiles()})


def _sql_day_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds on ``time`` in SQL, and how many days were opened for them."""
    database = _loaded(spark, sf_dir)
    sql = "SELECT time, event_id, value FROM ticks WHERE time >= '2024-01-05 12:00:00' AND time < '2024-01-09 00:00:00'"
    rows = run_sql(spark, sql, database)
    return _shown(rows).withColumn("days_opened", F.lit(_days_opened(rows)).cast("bigint"))


def _sql_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows, from the newest days alone."""
    database = _loaded(spark, sf_dir)
    sql = "SELECT time, event_id, value FROM ticks ORDER BY time DESC, event_id DESC LIMIT 10"
    rows = run_sql(spark, sql, database)
    return _shown(rows).withColumn("days_opened", F.lit(_days_opened(rows)).cast("bigint"))


def _result_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epoch_rows(_events(spark, sf_dir, "event_id", "event_type", "value"))


def _estimate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir, "event_type", "value")
    return row_counts(spark.sql(HOURLY.format(source="{events}"), events=events))


def _estimate_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What estimates are made of: statistics of days, of which some are taken again after a second load, merged."""
    database = _database(configure(spark))
    rows = _events(spark, sf_dir, "event_id", "event_type", "user_id", "value")
    for part in (F.col("time") < F.lit("2024-01-16 12:00:00"), F.col("time") >= F.lit("2024-01-16 12:00:00")):
        store.append(rows.filter(part), database, "ticks", tags=["event_type"])
        refresh_statistics(spark, database, "ticks")
    bounded = F.col("column").isin("time", "event_id", "user_id")
    low, high = (F.when(bounded, F.col(name)).alias(name) for name in ("low", "high"))
    return merged_statistics(spark, database, "ticks").select("column", "rows", "nulls", low, high)


def _measurement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _database(configure(spark))
    rows = _events(spark, sf_dir, "event_type", "value").withColumnRenamed("event_type", "measurement")
    append_each(rows, database)
    listed = store.list_measurements(spark, database)
    days = [
        store.rows_and_files(store.read(spark, database, name)).select(F.lit(name).alias("measurement"), "rows", "files")
        for name in store.names_of(spark, database)
    ]
    counted = sparse_merge(days).groupBy("measurement").agg(F.sum("rows").alias("rows"), F.sum("files").alias("files"))
    return listed.join(counted, "measurement").select(
        "measurement",
        "rows",
        (F.col("file_count") == F.col("files")).alias("files_agree"),
        (F.col("total_size_mb") > 0).alias("has_size"),
    )


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir, "event_type", "value")
    here = store.list_databases(spark).filter(F.col("database") == database)
    tables = store.show_tables(spark, database).join(here, F.col("namespace") == F.col("database"))
    counted = run_sql(spark, "SELECT 'ticks' AS tableName, count(*) AS rows, count(DISTINCT day) AS days FROM ticks", database)
    return tables.join(counted, "tableName").select("tableName", "rows", "days")


# Ingest


def _columnar_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["event_id", "user_id", "event_type", "value"]
    rows = _table(spark, sf_dir, "events")
    rows = rows.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("time"), *names, "_metadata")
    batches = _row_batches(rows, ["time", *names], "events")
    return _shown(columnar_rows(batches))


def _row_batches(rows: DataFrame, names: list[str], measurement: str) -> DataFrame:
    """Columnar batches by place in the file, so each is bounded and the cut is the same in every run."""
    return columnar_batches(rows.select(*names), measurement, BATCH, row=F.col("_metadata.row_index"))


def _columnar_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"), "event_id", "value"
    )
    return _shown(columnar_rows(_row_batches(rows, ["time", "event_id", "value"], "events"), "ms"))


def _columnar_generated_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").select("event_id", "value")
    return _shown(columnar_rows(_row_batches(rows, ["event_id", "value"], "events"), now_us=BASE_US))


RECORD = (
    "measurement string, timestamp bigint, fields struct<value: double, user_id: bigint>, tags map<string, string>"
)


def _records_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    payload = F.to_json(
        F.struct(
            F.lit("events").alias("measurement"),
            F.unix_micros(F.col("ts").cast("timestamp")).alias("timestamp"),
            F.struct("value", "user_id").alias("fields"),
            F.create_map(
                F.lit("event_type"), F.col("event_type"),
                F.lit("k"), F.get_json_object("props", "$.k"),
                F.lit("user_id"), F.when(F.col("event_type") == "error", F.lit("hidden")),
            ).alias("tags"),
        )
    )
    records = events.select(F.from_json(payload, RECORD).alias("r")).select("r.*")
    return _shown(record_rows(records, tag_names=["event_type", "k", "user_id"]))


def _mixed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of at most ``BATCH`` rows: clicks and views as columns, the other types as records."""
    events = _table(spark, sf_dir, "events").select(
        F.col("_metadata.file_path").alias("file"),
        F.expr(f"_metadata.row_index div {BATCH}").alias("part"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t"),
        "event_id", "event_type", "user_id", "value",
    )
    columnar = F.col("event_type").isin("click", "view")
    lists = events.filter(columnar).groupBy("file", "part", "event_type").agg(
        F.collect_list(F.struct("t", "event_id", "value")).alias("r")
    )
    as_columns = lists.select(
        "file", "part",
        F.struct(
            F.col("event_type").alias("m"),
            F.struct(
                F.col("r.t").alias("time"), F.col("r.event_id").alias("event_id"), F.col("r.value").alias("value")
            ).alias("columns"),
            F.lit(None).cast("bigint").alias("t"),
            F.lit(None).cast("struct<event_id: bigint, user_id: bigint>").alias("fields"),
            F.lit(None).cast("map<string, string>").alias("tags"),
        ).alias("item"),
    )
    as_records = events.filter(~columnar).select(
        "file", "part",
        F.struct(
            F.col("event_type").alias("m"),
            F.lit(None).cast("struct<time: array<bigint>, event_id: array<bigint>, value: array<double>>").alias("columns"),
            "t",
            F.struct("event_id", "user_id").alias("fields"),
            F.create_map(F.lit("level"), F.upper("event_type")).alias("tags"),
        ).alias("item"),
    )
    payloads = as_columns.unionByName(as_records).groupBy("file", "part").agg(F.collect_list("item").alias("batch"))
    return payloads.select("batch")


def _mixed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(batch_rows(_mixed_items(spark, sf_dir), tag_names=["level"]))


def _mixed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_measurement(batch_rows(_mixed_items(spark, sf_dir), tag_names=["level"]), total=True)


def _sparse_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir, "event_type", "value")
    orders = table_rows(_table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus", "o_totalprice"), "o_orderdate")
    shipped = table_rows(_table(spark, sf_dir, "lineitem").select("l_shipdate", "l_returnflag", "l_quantity"), "l_shipdate")
    merged = sparse_merge(
        [
            events,
            orders.withColumnRenamed("o_totalprice", "value"),
            shipped.withColumnRenamed("l_quantity", "quantity"),
        ]
    )
    return _shown(merged)


def _time_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("time")
    micros = F.unix_micros(time)
    return _shown(
        _events(spark, sf_dir, "event_id").select(
            "event_id",
            to_time(F.unix_seconds(time), "s").alias("from_s"),
            to_time(F.unix_millis(time), "ms").alias("from_ms"),
            to_time(micros, "us").alias("from_us"),
            to_micros(F.unix_millis(time) / F.lit(1000), "s").alias("from_fraction"),
            to_nanos(F.unix_seconds(time), "s").alias("ns_from_s"),
            to_nanos(micros, "us").alias("ns_from_us"),
            to_nanos(micros, "ns").alias("ns_from_ns"),
            generated_time(BASE_US, F.col("event_id")).alias("generated"),
        )
    )


# Line protocol


def _line_protocol_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_lines(_events(spark, sf_dir, "event_type", "user_id", "value", "props"), "site events", ["event_type"])


def _line_protocol_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select(
        F.lit("doc,s").alias("measurement"),
        F.struct("text", "n_chars", (F.col("n_chars") > 1000).alias("is long")).alias("fields"),
        F.create_map(F.lit("lang"), "lang", F.lit("a b=c"), F.concat(F.lit("from, "), "source")).alias("tags"),
        F.col("doc_id").alias("timestamp"),
    )
    return record_lines(documents, "s")


def _line_protocol_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts to lines and back, whatever quotes, backslashes and line breaks they hold."""
    documents = table_rows(_table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "n_chars"), "doc_id", "s")
    lines = table_lines(documents, "documents", ["lang"])
    back = typed_rows(parse_lines(lines), "documents", ["lang"], {"text": "string", "n_chars": "bigint"})
    return _shown(back)


def _line_protocol_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(configure(spark))
    write_lines(table_lines(_events(spark, sf_dir, "event_id", "event_type", "user_id", "value"), "ticks", ["event_type"]), folder)
    rows = typed_rows(
        parse_lines(read_lines(spark, folder)),
        "ticks",
        ["event_type"],
        {"event_id": "bigint", "user_id": "bigint", "value": "double"},
    )
    database = _database(spark)
    store.append(rows, database, "ticks", tags=["event_type"])
    return _shown(store.read(spark, database, "ticks").drop("day"))


def _line_protocol_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of several measurements to a table each, with tags and types found in the text."""
    events = _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("measurement"),
        F.struct("event_id", "value").alias("fields"),
        F.struct(F.concat(F.lit("u "), "user_id").alias("user")).alias("tags"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("timestamp"),
    )
    database = _database(spark)
    names = append_lines(record_lines(events), database)
    tables = [store.read(spark, database, name).withColumn("measurement", F.lit(name)) for name in names]
    return _shown(sparse_merge(tables).drop("day"))


# Upkeep


def _hourly(database: str, **more) -> continuous.ContinuousQuery:
    return continuous.ContinuousQuery(
        id=1,
        name="hourly",
        database=database,
        source_measurement="ticks",
        destination_measurement="ticks_1h",
        query=HOURLY.format(source=f"{database}.ticks"),
        interval="1h",
        **more,
    )


def _cq_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    continuous.run_query(spark, _hourly(database), "2024-01-03T00:00:00Z", "2024-01-20T06:00:00Z")
    return _shown(store.read(spark, database, "ticks_1h"))


def _cq_two_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    query = _hourly(database)
    continuous.run_query(spark, query, "2024-01-01", "2024-01-12T07:00:00")
    continuous.run_query(spark, query, "2024-01-12T05:00:00", AS_OF)
    return _shown(store.read(spark, database, "ticks_1h").drop("day"))


def _cq_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    query = _hourly(database)
    for as_of in ("2024-01-08T09:40:00", "2024-01-20T17:05:00"):
        continuous.run_pending(spark, query, as_of)
    return _shown(store.read(spark, database, "ticks_1h").drop("day"))


def _cq_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results after rows came for buckets that had been covered."""
    database = _database(configure(spark))
    rows = _events(spark, sf_dir, "event_type", "value")
    late = (F.col("event_type") == "error") & (F.col("time") < F.lit("2024-01-10").cast("timestamp"))
    for part in (rows.filter(~late), rows.filter(late)):
        store.append(part, database, "ticks", tags=["event_type"])
        continuous.run_pending(spark, _hourly(database), "2024-01-20 17:30:00")
    return _shown(store.read(spark, database, "ticks_1h").drop("day"))


def _cq_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    query = _hourly(database)
    for as_of in ("2024-01-08T09:40:00", "2024-01-20T17:05:00"):
        continuous.run_pending(spark, query, as_of)
    history = continuous.query_runs(spark, query)
    return _shown(history.select("query_id", "status", "end_time", "records_read", "records_written"))


def _cq_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    query = _hourly(database, retention_days=20, delete_source_after_days=3)
    continuous.run_query(spark, query, "2024-01-01", "2024-01-25")
    continuous.apply_tiers(spark, query, AS_OF, dry_run=False, confirm=True)
    tiers = [store.read(spark, database, name).select("time", "event_type", "value") for name in ("ticks_1h", "ticks")]
    return _shown(sparse_merge(tiers))


DOOMED = "event_type = 'error' AND value > 20 OR time < '2024-01-04'"


def _delete_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    limits = deletion.DeleteLimits(max_rows_per_delete=2**62)
    deletion.delete(spark, database, "ticks", DOOMED, dry_run=False, confirm=True, limits=limits)
    return _shown(store.read(spark, database, "ticks"))


def _delete_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    report = deletion.delete_report(spark, database, "ticks", DOOMED)
    return report.groupBy("day").agg(
        F.sum("rows").alias("rows"), F.sum("matched").alias("matched"), F.bool_or("rewritten").alias("rewritten")
    )


def _delete_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By day, of files that hold one event type each: how many a delete leaves in place, drops and writes again."""
    database = _database(configure(spark))
    rows = _events(spark, sf_dir, "event_id", "event_type", "value")
    for test in ("event_type = 'error'", "event_type = 'view'", "event_type NOT IN ('error', 'view')"):
        # One task a day, so one file a day.
        store.append(rows.filter(test).repartition(F.to_date("time")), database, "ticks", tags=["event_type"])

    def files() -> DataFrame:
        found = store.read(spark, database, "ticks").select("day", F.col("_metadata.file_path").alias("file"))
        return found.distinct().groupBy("day").agg(F.collect_set("file").alias("files"))

    before = files().checkpoint()
    limits = deletion.DeleteLimits(max_rows_per_delete=2**62)
    done = deletion.delete(spark, database, "ticks", DOOMED, dry_run=False, confirm=True, limits=limits)
    after = files().withColumnRenamed("files", "left")
    steps = done.files_processed.groupBy("day").agg(
        F.count_if(F.col("action") == "dropped").alias("dropped"), F.count_if("rewritten").alias("rewritten")
    )
    none = F.array().cast("array<string>")
    return (
        before.join(after, "day", "left")
        .join(steps, "day", "left")
        .select(
            "day",
            F.size(F.array_intersect("files", F.coalesce("left", none))).cast("bigint").alias("in_place"),
            F.coalesce("dropped", F.lit(0)).alias("dropped"),
            F.coalesce("rewritten", F.lit(0)).alias("rewritten"),
        )
    )


def _delete_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes under several limits: which of them are refused, and the rows that are left after each."""
    database = _loaded(spark, sf_dir)
    cases = [
        ("dry_run", {"dry_run": True, "limits": deletion.DeleteLimits(confirmation_threshold=0)}),
        ("switched_off", {"confirm": True, "limits": deletion.DeleteLimits(enabled=False)}),
        ("unconfirmed", {"limits": deletion.DeleteLimits(confirmation_threshold=20)}),
        ("too_many", {"confirm": True, "limits": deletion.DeleteLimits(max_rows_per_delete=20)}),
        ("confirmed", {"confirm": True, "limits": deletion.DeleteLimits(max_rows_per_delete=2**62)}),
    ]
    out = []
    for name, options in cases:
        try:
            deletion.delete(spark, database, "ticks", DOOMED, **{"dry_run": False, **options})
            refused = False
        except ValueError:
            refused = True
        out.append((name, refused, store.read(spark, database, "ticks").count()))
    return spark.createDataFrame(out, "attempt string, refused boolean, rows bigint")


def _policy(database: str) -> retention.RetentionPolicy:
    return retention.RetentionPolicy(id=7, name="short", database=database, retention_days=10, buffer_days=2)


def _retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    plan = retention.retention_plan(spark, [_policy(database)], AS_OF)
    return _shown(plan.select("policy_id", "measurement", "cutoff_date", "day", "rows"))


def _retention_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    retention.run_retention(spark, _policy(database), AS_OF, dry_run=False, confirm=True)
    return _shown(store.read(spark, database, "ticks").drop("day"))


def _retention_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir)
    for _ in range(2):
        retention.run_retention(spark, _policy(database), AS_OF, dry_run=False, confirm=True)
    return _shown(retention.retention_runs(spark, _policy(database)).select("policy_id", "status", "deleted_count", "cutoff_date"))


def _compacted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By day, rows and files of a measurement that five appends have filled, once its closed days are compacted."""
    database = _database(configure(spark))
    rows = _events(spark, sf_dir, "event_id", "event_type", "value")
    for part in range(5):
        store.append(rows.filter(F.pmod("event_id", F.lit(5)) == part), database, "ticks", tags=["event_type"], cluster=True)
    compaction.compact(spark, database, "ticks", "2024-01-20")
    days = store.rows_and_files(store.read(spark, database, "ticks"))
    return days.select("day", "rows", (F.col("files") == 1).alias("compact"))


# Streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(configure(spark))
    rows = table_rows(_event_stream(spark, sf_dir).select("ts", "event_id", "event_type", "user_id", "value"), "ts")
    fields = {"event_id": "bigint", "user_id": "bigint", "value": "double"}
    points = stream_points(table_lines(rows, "ticks", ["event_type"]), "ticks", ["event_type"], fields)
    start_ingest(points, f"{folder}/rows", f"{folder}/mark", once=True).awaitTermination()
    return _shown(ingested(spark, f"{folder}/rows").drop("day"))


def _stream_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(configure(spark))
    rows = table_rows(_event_stream(spark, sf_dir), "ts")
    out = rollup(rows, "1 hour", ["event_type"], [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")])
    start_ingest(out, f"{folder}/rows", f"{folder}/mark", once=True).awaitTermination()
    return _shown(ingested(spark, f"{folder}/rows").drop("day"))


def _stream_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over what a stream of several measurements has committed."""
    folder, database = _folder(configure(spark)), _database(spark)
    rows = table_rows(_event_stream(spark, sf_dir).select("ts", "event_type", "value"), "ts")
    rows = rows.withColumnRenamed("event_type", "measurement")
    start_ingest(rows, f"{folder}/rows", f"{folder}/mark", once=True).awaitTermination()
    expose(spark, f"{folder}/rows", database, "purchase")
    sql = "SELECT time_bucket('1 day', time) AS time, max(value) AS top, count(*) AS n FROM purchase GROUP BY 1"
    return _shown(run_sql(spark, sql, database))


def _stream_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into a measurement, from which rows are then deleted, downsampled and expired."""
    folder, database = _folder(configure(spark)), _database(spark)
    rows = table_rows(_event_stream(spark, sf_dir).select("ts", "event_type", "value"), "ts")
    into_measurement(rows, database, f"{folder}/mark", "ticks", ["event_type"], once=True).awaitTermination()
    limits = deletion.DeleteLimits(max_rows_per_delete=2**62)
    deletion.delete(spark, database, "ticks", DOOMED, dry_run=False, confirm=True, limits=limits)
    continuous.run_query(spark, _hourly(database), "2024-01-01", AS_OF)
    retention.run_retention(spark, _policy(database), AS_OF, dry_run=False, confirm=True)
    kept = [store.read(spark, database, "ticks_1h"), store.read(spark, database, "ticks").withColumn("top", F.lit(None).cast("double"))]
    return _shown(kept[0].unionByName(kept[1]).drop("day"))


def _stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets that three micro-batches keep up to date; rows of the later ones fall into buckets that are there already."""
    folder, database = _folder(configure(spark)), _database(spark)
    rows = _table(spark, sf_dir, "events").select("ts", "event_id", "event_type", "value")
    for part in range(3):
        rows.filter(F.pmod("event_id", F.lit(3)) == part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    aggregates = [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")]
    rows = table_rows(stream, "ts")
    options = {"checkpoint": f"{folder}/mark", "late": "60 days", "once": True}
    rollup_into(rows, database, "ticks_1h", "1 hour", ["event_type"], aggregates, **options).awaitTermination()
    return _shown(store.read(spark, database, "ticks_1h").drop("day"))


def entry(spark: SparkSession) -> DataFrame:
    """Load events as a measurement, then downsample it by SQL."""
    database = _loaded(spark, "/root/testdata/sf0.001")
    return _shown(run_sql(spark, HOURLY.format(source=f"{database}.ticks")))


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline
    from chronoloom.llm import entries

    return entries.queries() | {"pipeline": corpus_pipeline.run}


def _llm_sql() -> dict[str, str]:
    import corpus_pipeline
    from chronoloom.llm import entries

    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return entries.oracle_sql() | whole


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "downsample_hourly": _downsample_hourly,
        "bucket_15m": _bucket("15m"),
        "bucket_7h": _bucket("7 hours"),
        "bucket_week": _bucket("7 days"),
        "bucket_month": _bucket("1 month"),
        "shipped_monthly": _shipped_monthly,
        "tag_filter": _tag_filter,
        "recent_window": _recent_window,
        "day_range": _day_range,
        "latest_n": _latest_n,
        "sql_day_bounds": _sql_day_bounds,
        "sql_newest": _sql_newest,
        "tag_avg_max": _tag_avg_max,
        "result_envelope": _result_envelope,
        "estimate_rows": _estimate_rows,
        "estimate_statistics": _estimate_statistics,
        "measurement_stats": _measurement_stats,
        "catalogue": _catalogue,
        "columnar_roundtrip": _columnar_roundtrip,
        "columnar_units": _columnar_units,
        "columnar_generated_time": _columnar_generated_time,
        "records_flatten": _records_flatten,
        "mixed_batch": _mixed_batch,
        "mixed_counts": _mixed_counts,
        "sparse_merge": _sparse_merge,
        "time_units": _time_units,
        "line_protocol_out": _line_protocol_out,
        "line_protocol_records": _line_protocol_records,
        "line_protocol_text": _line_protocol_text,
        "line_protocol_roundtrip": _line_protocol_roundtrip,
        "line_protocol_load": _line_protocol_load,
        "cq_run": _cq_run,
        "cq_two_halves": _cq_two_halves,
        "cq_pending": _cq_pending,
        "cq_late_rows": _cq_late_rows,
        "cq_history": _cq_history,
        "cq_tiered": _cq_tiered,
        "delete_survivors": _delete_survivors,
        "delete_files": _delete_files,
        "delete_report": _delete_report,
        "delete_guard": _delete_guard,
        "retention_plan": _retention_plan,
        "retention_survivors": _retention_survivors,
        "retention_history": _retention_history,
        "compacted_days": _compacted_days,
        "stream_ingest": _stream_ingest,
        "stream_downsample": _stream_downsample,
        "stream_sql": _stream_sql,
        "stream_measurement": _stream_measurement,
        "stream_rollup": _stream_rollup,
    } | (_llm_queries() if LLM else {})


def oracle_sql() -> dict[str, str]:
    def hourly(where: str = "true") -> str:
        return (
            "SELECT time_bucket(INTERVAL '1 hour', ts) AS time, event_type, round(avg(value), 6) AS value, "
            f"max(value) AS top FROM events WHERE {where} GROUP BY 1, 2"
        )

    def bucket(width: str) -> str:
        return (
            f"SELECT time_bucket(INTERVAL '{width}', ts) AS time, count(*) AS n, round(avg(value), 6) AS value "
            "FROM events GROUP BY 1"
        )

    def with_day(sql: str) -> str:
        return f"SELECT *, CAST(time AS DATE) AS day FROM ({sql})"

    def escaped(text: str) -> str:
        return f"replace(replace({text}, '\\', '\\\\'), '\"', '\\\"')"

    rows = "SELECT ts AS time, event_id, event_type, user_id, value FROM events"
    doomed = "coalesce(event_type = 'error' AND value > 20 OR ts < TIMESTAMP '2024-01-04', false)"
    runs = [
        ("2024-01-08 09:00:00", "ts < TIMESTAMP '2024-01-08 09:00:00'"),
        (
            "2024-01-20 17:00:00",
            "ts >= TIMESTAMP '2024-01-08 09:00:00' AND ts < TIMESTAMP '2024-01-20 17:00:00'",
        ),
    ]
    return {
        "downsample_hourly": hourly(),
        "bucket_15m": bucket("15 minutes"),
        "bucket_7h": bucket("7 hours"),
        "bucket_week": bucket("7 days"),
        "bucket_month": bucket("1 month"),
        "shipped_monthly": "SELECT time_bucket(INTERVAL '1 month', l_shipdate) AS time, l_returnflag, "
        "round(avg(l_quantity), 6) AS quantity, max(l_quantity) AS top, count(*) AS n FROM lineitem GROUP BY 1, 2",
        "tag_filter": f"{rows} WHERE event_type = 'purchase'",
        "recent_window": "SELECT ts AS time, event_id, value FROM events "
        f"WHERE ts > TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL '36 hours'",
        "day_range": with_day(
            f"{rows} WHERE ts >= TIMESTAMP '2024-01-05 12:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00'"
        ),
        "latest_n": "SELECT ts AS time, event_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 10",
        "sql_day_bounds": "SELECT ts AS time, event_id, value, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events "
        "WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00') AS days_opened FROM events "
        "WHERE ts >= TIMESTAMP '2024-01-05 12:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00'",
        "sql_newest": """WITH days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
            sums AS (SELECT *, sum(n) OVER (ORDER BY day DESC) - n AS newer FROM days)
            SELECT ts AS time, event_id, value, (SELECT count(*) FROM sums WHERE newer < 10) AS days_opened
            FROM events ORDER BY ts DESC, event_id DESC LIMIT 10""",
        "tag_avg_max": "SELECT event_type, round(avg(value), 6) AS value, max(user_id) AS top_user "
        "FROM events GROUP BY event_type",
        "result_envelope": "SELECT epoch_us(ts) AS time, event_id, event_type, value FROM events",
        "estimate_statistics": " UNION ALL ".join(
            f"""SELECT '{column}' AS "column", count(*) AS rows, count(*) - count({of}) AS nulls, {low} AS low, {high} AS high FROM events"""
            for column, of, low, high in [
                ("time", "ts", "strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f')", "strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f')"),
                ("event_id", "event_id", "CAST(min(event_id) AS VARCHAR)", "CAST(max(event_id) AS VARCHAR)"),
                ("user_id", "user_id", "CAST(min(user_id) AS VARCHAR)", "CAST(max(user_id) AS VARCHAR)"),
                ("event_type", "event_type", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
                ("value", "value", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
            ]
        ),
        "estimate_rows": f"""SELECT n AS estimated_rows, CASE WHEN n >= 1000000 THEN 'high' WHEN n >= 100000 THEN 'medium'
            WHEN n >= 10000 THEN 'low' ELSE 'none' END AS warning_level FROM (SELECT count(*) AS n FROM ({hourly()}))""",
        "measurement_stats": "SELECT event_type AS measurement, count(*) AS rows, true AS files_agree, "
        "true AS has_size FROM events GROUP BY 1",
        "catalogue": "SELECT count(*) AS rows, count(DISTINCT CAST(ts AS DATE)) AS days, 'ticks' AS \"tableName\" FROM events",
        "columnar_roundtrip": "SELECT 'events' AS measurement, ts AS time, event_id, user_id, event_type, value FROM events",
        "columnar_units": "SELECT 'events' AS measurement, date_trunc('millisecond', ts) AS time, event_id, value FROM events",
        "columnar_generated_time": f"SELECT 'events' AS measurement, make_timestamp({BASE_US} + event_id % {BATCH}) AS time, "
        "event_id, value FROM events",
        "records_flatten": """SELECT 'events' AS measurement, ts AS time, event_type,
            json_extract_string(props, '$.k') AS k,
            CASE WHEN event_type = 'error' THEN 'hidden' ELSE CAST(user_id AS VARCHAR) END AS user_id, value FROM events""",
        "mixed_batch": """SELECT event_type AS measurement, ts AS time, event_id, value,
              CAST(NULL AS VARCHAR) AS level, CAST(NULL AS BIGINT) AS user_id
            FROM events WHERE event_type IN ('click', 'view')
            UNION ALL SELECT event_type, ts, event_id, NULL, upper(event_type), user_id
            FROM events WHERE event_type NOT IN ('click', 'view')""",
        "mixed_counts": "SELECT event_type AS measurement, count(*) AS rows FROM events GROUP BY 1 "
        "UNION ALL SELECT NULL, count(*) FROM events",
        "sparse_merge": """SELECT ts AS time, event_type, value FROM events
            UNION ALL BY NAME SELECT o_orderdate AS time, o_orderstatus, o_totalprice AS value FROM orders
            UNION ALL BY NAME SELECT l_shipdate AS time, l_returnflag, l_quantity AS quantity FROM lineitem""",
        "time_units": f"""SELECT event_id, date_trunc('second', ts) AS from_s, date_trunc('millisecond', ts) AS from_ms,
            ts AS from_us, CAST(trunc((epoch_us(ts) // 1000) / 1000.0::DOUBLE * 1000000) AS BIGINT) AS from_fraction,
            epoch_us(ts) // 1000000 * 1000000000 AS ns_from_s, epoch_us(ts) * 1000 AS ns_from_us,
            epoch_us(ts) AS ns_from_ns, make_timestamp({BASE_US} + event_id) AS generated FROM events""",
        "line_protocol_out": f"""SELECT 'site\\ events,event_type=' || event_type || ' user_id=' || user_id || 'i,value='
            || value || ',props="' || {escaped('props')} || '" ' || epoch_us(ts) * 1000 AS value FROM events""",
        "line_protocol_records": f"""SELECT 'doc\\,s,a\\ b\\=c=from\\,\\ '
            || replace(replace(replace(source, ',', '\\,'), '=', '\\='), ' ', '\\ ') || ',lang='
            || replace(replace(replace(lang, ',', '\\,'), '=', '\\='), ' ', '\\ ')
            || ' text="' || {escaped('text')} || '",n_chars=' || n_chars || 'i,is\\ long=' || (n_chars > 1000)
            || ' ' || doc_id * 1000000000 AS value FROM documents""",
        "line_protocol_text": "SELECT make_timestamp(doc_id * 1000000) AS time, lang, text, n_chars FROM documents",
        "line_protocol_roundtrip": rows,
        "line_protocol_load": "SELECT event_type AS measurement, ts AS time, 'u ' || user_id AS \"user\", event_id, value "
        "FROM events",
        "cq_run": with_day(hourly("ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-20 06:00:00'")),
        "cq_two_halves": hourly(),
        "cq_pending": hourly("ts < TIMESTAMP '2024-01-20 17:00:00'"),
        "cq_late_rows": hourly("ts < TIMESTAMP '2024-01-20 17:00:00'"),
        "cq_history": " UNION ALL ".join(
            f"""SELECT CAST(1 AS BIGINT) AS query_id, 'completed' AS status, TIMESTAMP '{end}' AS end_time,
            (SELECT count(*) FROM events WHERE {where}) AS records_read,
            (SELECT count(*) FROM ({hourly(where)})) AS records_written"""
            for end, where in runs
        ),
        "cq_tiered": f"""SELECT time, event_type, value FROM
            ({hourly("ts >= TIMESTAMP '2024-01-11 00:00:00' AND ts < TIMESTAMP '2024-01-25 00:00:00'")})
            UNION ALL SELECT ts, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'""",
        "delete_survivors": with_day(f"{rows} WHERE NOT {doomed}"),
        "delete_report": f"""SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS rows,
            count(*) FILTER ({doomed}) AS matched, count(*) FILTER ({doomed}) < count(*) AS rewritten
            FROM events GROUP BY 1 HAVING count(*) FILTER ({doomed}) > 0""",
        "delete_files": f"""WITH files AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER ({doomed}) AS hit FROM events
            GROUP BY 1, CASE WHEN event_type IN ('error', 'view') THEN event_type ELSE '' END)
            SELECT day, count(*) FILTER (hit = 0) AS in_place, count(*) FILTER (hit = n) AS dropped,
            count(*) FILTER (hit > 0 AND hit < n) AS rewritten FROM files GROUP BY day""",
        "delete_guard": f"""WITH c AS (SELECT count(*) AS n, count(*) FILTER ({doomed}) AS hit FROM events)
            SELECT 'dry_run' AS attempt, false AS refused, n AS rows FROM c UNION ALL SELECT 'switched_off', true, n FROM c
            UNION ALL SELECT 'unconfirmed', hit > 20, CASE WHEN hit > 20 THEN n ELSE n - hit END FROM c
            UNION ALL SELECT 'too_many', hit > 20, CASE WHEN hit > 20 THEN n ELSE n - hit END FROM c
            UNION ALL SELECT 'confirmed', false, n - hit FROM c""",
        "retention_plan": """SELECT CAST(7 AS BIGINT) AS policy_id, 'ticks' AS measurement,
            TIMESTAMP '2024-01-19 00:00:00' AS cutoff_date, CAST(ts AS DATE) AS day, count(*) AS rows
            FROM events WHERE ts < TIMESTAMP '2024-01-19 00:00:00' GROUP BY 4""",
        "retention_survivors": f"{rows} WHERE ts >= TIMESTAMP '2024-01-19 00:00:00'",
        "retention_history": """SELECT CAST(7 AS BIGINT) AS policy_id, 'completed' AS status,
            (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-19 00:00:00') * first AS deleted_count,
            TIMESTAMP '2024-01-19 00:00:00' AS cutoff_date FROM (VALUES (1), (0)) v(first)""",
        "compacted_days": """SELECT CAST(ts AS DATE) AS day, count(*) AS rows, min(ts) < TIMESTAMP '2024-01-20 00:00:00'
            OR count(DISTINCT event_id % 5) = 1 AS compact FROM events GROUP BY 1""",
        "stream_ingest": rows,
        "stream_downsample": """SELECT time_bucket(INTERVAL '1 hour', ts) AS time, event_type, count(*) AS n,
            max(value) AS top FROM events GROUP BY 1, 2
            HAVING time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour'
              <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""",
        "stream_measurement": f"""SELECT * FROM ({hourly(f"NOT {doomed}")}) WHERE time >= TIMESTAMP '2024-01-19 00:00:00'
            UNION ALL SELECT ts, event_type, value, CAST(NULL AS DOUBLE) FROM events
            WHERE NOT {doomed} AND ts >= TIMESTAMP '2024-01-19 00:00:00'""",
        "stream_rollup": "SELECT time_bucket(INTERVAL '1 hour', ts) AS time, event_type, count(*) AS n, max(value) AS top "
        "FROM events GROUP BY 1, 2",
        "stream_sql": "SELECT time_bucket(INTERVAL '1 day', ts) AS time, max(value) AS top, count(*) AS n "
        "FROM events WHERE event_type = 'purchase' GROUP BY 1",
    } | (_llm_sql() if LLM else {})
