from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from chronoloom.functions.buckets import time_bucket
from chronoloom.operators.lines_out import table_lines, write_lines
from chronoloom.operators.merge import rows_per_measurement
from chronoloom.operators.measurements import exists, names_of, read, time_range
from chronoloom.plans.continuous import ContinuousQuery, mark_of, query_runs
from chronoloom.session import shared_dir
from chronoloom.sources.batches import batch_rows
from chronoloom.sources.frames import table_rows
from chronoloom.sources.lines import read_lines
from chronoloom.streaming.ingest import expose, ingested, pending_rows, start_ingest, stream_json, stream_lines, stream_points
from chronoloom.streaming.rollup import BucketWriter, rollup, rollup_into
from tests.conftest import DATA

FIELDS = {"value": "double", "user_id": "bigint"}


@pytest.fixture()
def folder(spark):
    return f"{shared_dir(spark)}/stream-{uuid4().hex}"


def run(query):
    query.awaitTermination()
    return query


def test_ingest_of_gzip_lines_is_exactly_once(spark, events, folder):
    rows = table_rows(events.select("ts", "event_type", "value", "user_id"), "ts")
    lines = table_lines(rows, "events", ["event_type"])
    write_lines(lines.repartition(4), f"{folder}/in")
    assert read_lines(spark, f"{folder}/in").count() == events.count()

    def once():
        points = stream_points(stream_lines(spark, f"{folder}/in", 2), "events", ["event_type"], FIELDS)
        return run(start_ingest(points, f"{folder}/out", f"{folder}/mark", max_rows_per_file=50, once=True))

    first = once()
    assert sum(p["numInputRows"] for p in first.recentProgress) >= events.count() and pending_rows(first) > 0
    got = ingested(spark, f"{folder}/out").drop("day").select(rows.columns)
    assert got.exceptAll(rows).isEmpty() and rows.exceptAll(got).isEmpty()
    files = ingested(spark, f"{folder}/out").groupBy(F.col("_metadata.file_path")).count()
    assert files.agg(F.max("count")).first()[0] <= 50
    once()
    assert ingested(spark, f"{folder}/out").count() == events.count()
    write_lines(lines.limit(10), f"{folder}/in")
    once()
    assert ingested(spark, f"{folder}/out").count() == events.count() + 10


def test_ingest_of_mixed_payloads(spark, folder, database):
    schema = """batch array<struct<m:string, columns:struct<time:array<bigint>,value:array<double>>,
                t:bigint, fields:struct<used:bigint>, tags:map<string,string>>>"""
    payload = """{"batch": [{"m": "cpu", "columns": {"time": [1, 2], "value": [0.5, 0.6]}},
                 {"m": "mem", "t": 3, "fields": {"used": 7}, "tags": {"host": "a"}}]}"""
    spark.createDataFrame([(payload.replace("\n", ""),)], "value string").write.text(f"{folder}/in")
    rows = batch_rows(stream_json(spark, f"{folder}/in", schema), tag_names=["host"])
    run(start_ingest(rows, f"{folder}/out", f"{folder}/mark", once=True))
    got = {r.measurement: r.rows for r in rows_per_measurement(ingested(spark, f"{folder}/out")).collect()}
    assert got == {"cpu": 2, "mem": 1}
    expose(spark, f"{folder}/out", database, "cpu")
    expose(spark, f"{folder}/out", database, "mem")
    cpu = read(spark, database, "cpu")
    assert cpu.columns == ["time", "value", "host", "used", "day"]
    assert time_range(cpu, "1970-01-01", "1970-01-02").count() == 2 and read(spark, database, "mem").count() == 1
    plan = cpu.filter("day = '1970-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "measurement#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert exists(spark, database, "cpu") and names_of(spark, database) == []


@pytest.mark.parametrize("width", ["1 hour", "7h", "7 days"])
def test_rollup_equals_the_batch_on_closed_buckets(spark, events, folder, width):
    aggregates = [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")]
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(DATA)
    out = rollup(table_rows(stream, "ts"), width, ["event_type"], aggregates)
    run(start_ingest(out, f"{folder}/out", f"{folder}/mark", once=True))
    got = ingested(spark, f"{folder}/out").drop("day")
    rows = table_rows(events, "ts")
    want = rows.groupBy(time_bucket(width, "time").alias("time"), "event_type").agg(*aggregates)
    newest = rows.agg(F.max("time")).first()[0]
    from chronoloom.functions.buckets import width_micros

    bound = F.unix_micros(F.lit(newest)) - F.expr("600000000L") - F.lit(width_micros(spark, width))
    closed = want.filter(F.unix_micros("time") <= bound).select(got.columns)
    assert 0 < closed.count() < want.count()
    assert got.exceptAll(closed).isEmpty() and closed.exceptAll(got).isEmpty()
    plain = rollup(rows, width, ["event_type"], aggregates).select(want.columns)
    assert plain.exceptAll(want).isEmpty() and want.exceptAll(plain).isEmpty()


def test_rollup_refuses_months(spark, events):
    with pytest.raises(ValueError, match="days or shorter"):
        rollup(table_rows(events, "ts"), "1 month", [], [F.count(F.lit(1))])


def put(spark, folder, *values):
    rows = spark.createDataFrame(list(values), "at string, host string, value double")
    rows.coalesce(1).write.mode("append").json(f"{folder}/in")


def test_streamed_buckets_change_with_late_rows(spark, folder, database):
    def turn():
        rows = stream_json(spark, f"{folder}/in", "at string, host string, value double")
        rows = rows.select(F.col("at").cast("timestamp").alias("time"), "host", "value")
        aggregates = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")]
        options = {"checkpoint": f"{folder}/mark", "late": "2 hours", "query_id": 4, "once": True}
        run(rollup_into(rows, database, "hourly", "1 hour", ["host"], aggregates, **options))
        got = read(spark, database, "hourly").select(F.date_format("time", "dd HH").alias("at"), "host", "n", "total")
        return sorted((tuple(row) for row in got.collect()), key=str)

    put(spark, folder, ("2024-01-01 23:10:00", "a", 1.0), ("2024-01-01 23:20:00", None, 2.0), ("2024-01-02 00:05:00", "a", 4.0))
    first = [("01 23", "a", 1, 1.0), ("01 23", None, 1, 2.0), ("02 00", "a", 1, 4.0)]
    assert turn() == first and turn() == first
    # Late rows change buckets of the day before, one of them without a host; the bucket between stays.
    put(spark, folder, ("2024-01-01 23:50:00", "a", 8.0), ("2024-01-01 23:59:00", None, 16.0), ("2024-01-02 01:00:00", "b", 32.0))
    second = [("01 23", "a", 2, 9.0), ("01 23", None, 2, 18.0), ("02 00", "a", 1, 4.0), ("02 01", "b", 1, 32.0)]
    assert turn() == second
    query = ContinuousQuery(4, "hourly", database, "cpu", "hourly", "SELECT 1 FROM cpu", "1 hour")
    history = query_runs(spark, query).collect()
    assert [row.status for row in history] == ["streamed"] * 2 and sorted(row.records_written for row in history) == [3, 3]
    assert mark_of(spark, query) is None


def test_streamed_batch_that_runs_again_counts_once(spark, folder, database):
    rows = spark.sql("SELECT timestamp'2024-01-01 05:00:00' AS time, 'a' AS host, 3L AS n")
    writer = BucketWriter(database, "hourly", "1 hour", ["host"], f"{folder}/mark", 5)
    writer(rows, 0)
    writer(rows, 0)
    # Lost after the rows were put in place, before the batch was noted: staged rows are put there again.
    rows.write.parquet(f"{folder}/mark-staged/batch-1")
    writer(rows, 1)
    writer(rows.limit(0), 2)
    assert read(spark, database, "hourly").count() == 1
    assert spark.table(f"{database}._query_runs").count() == 2
