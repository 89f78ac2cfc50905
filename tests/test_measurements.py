import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from chronoloom.operators import measurements as store
from chronoloom.operators.results import analyze, estimate, response, run_sql
from chronoloom.plans.loading import append_each
from chronoloom.sources.frames import table_rows


@pytest.fixture()
def loaded(spark, events, database):
    rows = table_rows(events.select("ts", "event_type", "value", "user_id"), "ts")
    store.append(rows, database, "events", tags=["event_type"])
    return database


def test_append_keeps_rows_and_notes_tags(spark, events, loaded):
    table = store.read(spark, loaded, "events")
    assert table.columns == ["time", "event_type", "value", "user_id", "day"]
    assert table.count() == events.count()
    assert store.tags_of(spark, loaded, "events") == ["event_type"]
    assert table.filter("day <> to_date(time)").isEmpty()
    store.append(spark.sql("SELECT TIMESTAMP'2024-01-05 01:00:00' AS time, 'eu' AS region"), loaded, "events", ["region"])
    assert store.tags_of(spark, loaded, "events") == ["event_type", "region"]


def test_append_adds_columns_and_refuses_clashes(spark, loaded):
    before = store.read(spark, loaded, "events").count()
    more = spark.sql("SELECT TIMESTAMP'2024-03-01 00:00:00' AS time, 7 AS user_id, true AS fresh")
    store.append(more, loaded, "events", cluster=True)
    table = store.read(spark, loaded, "events")
    assert table.count() == before + 1
    assert tuple(table.filter("fresh").select("user_id", "value", "day").first()) == (7, None, date(2024, 3, 1))
    for sql in ("'x' AS value", "1.5D AS user_id", "1 AS event_type"):
        with pytest.raises(ValueError, match="the new rows hold"):
            store.append(spark.sql(f"SELECT TIMESTAMP'2024-03-01 00:00:00' AS time, {sql}"), loaded, "events")
    assert store.read(spark, loaded, "events").count() == before + 1


def test_append_refusals(spark, loaded):
    with pytest.raises(ValueError, match="timestamp column 'time'"):
        store.append(spark.range(1), loaded, "m")
    with pytest.raises(ValueError, match="partition column"):
        store.append(spark.sql("SELECT now() AS time, 1 AS day"), loaded, "m")
    with pytest.raises(Exception, match="no time"):
        store.append(spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS time, 1 AS x"), loaded, "m")
    with pytest.raises(ValueError, match="empty"):
        store.append(spark.sql("SELECT now() AS time"), loaded, "")


def test_append_each_splits_by_measurement(spark, events, database):
    rows = table_rows(events.select("ts", "event_type", "value"), "ts").select(
        F.col("event_type").alias("measurement"),
        "time",
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.when(F.col("event_type") == "view", F.lit("v")).alias("kind"),
    )
    names = append_each(rows, database)
    assert names == ["click", "error", "purchase", "signup", "view"]
    assert store.names_of(spark, database) == names
    assert store.read(spark, database, "view").columns == ["time", "kind", "day"]
    assert store.read(spark, database, "click").columns == ["time", "value", "day"]
    total = sum(store.read(spark, database, n).count() for n in names)
    assert total == events.count()


def test_time_range_prunes_days(spark, loaded):
    table = store.read(spark, loaded, "events")
    part = store.time_range(table, "2024-01-05T12:00:00Z", "2024-01-07")
    assert part.count() == table.filter("time >= '2024-01-05 12:00:00' and time < '2024-01-07'").count()
    assert {r.day for r in part.select("day").distinct().collect()} == {date(2024, 1, 5), date(2024, 1, 6)}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(time)" in plan


def test_replace_days(spark, loaded):
    before = {r.day: r["count"] for r in store.read(spark, loaded, "events").groupBy("day").count().collect()}
    days = [date(2024, 1, 2), date(2024, 1, 3)]
    keep = store.read(spark, loaded, "events").filter("day = '2024-01-02' and value > 10")
    extra = spark.sql("SELECT TIMESTAMP'2025-01-01 05:00:00' AS time, DATE'2025-01-01' AS day, 1.0D AS value")
    rows = keep.unionByName(extra, allowMissingColumns=True)
    left = keep.count()
    for _ in range(2):
        written = store.replace_days(spark, loaded, "events", rows, days)
        assert written == {date(2024, 1, 2): left, date(2025, 1, 1): 1}
        rows = store.read(spark, loaded, "events").filter("day = '2024-01-02' or day = '2025-01-01'")
    after = {r.day: r["count"] for r in store.read(spark, loaded, "events").groupBy("day").count().collect()}
    del before[days[1]]
    assert after == {**before, **written}
    store.append(extra.drop("day"), loaded, "events")
    assert store.read(spark, loaded, "events").filter("day = '2025-01-01'").count() == 2
    root = store.location(spark, loaded, "events").removeprefix("file:")
    assert not os.path.exists(f"{root}/day=2024-01-02")
    store.drop_days(spark, loaded, "events", [date(2024, 1, 2), date(2030, 1, 1)])
    assert date(2024, 1, 2) not in store.days_of(spark, loaded, "events")


def test_catalogue(spark, loaded):
    assert loaded in {r.database for r in store.list_databases(spark).collect()}
    assert [r.tableName for r in store.show_tables(spark, loaded).collect()] == ["events"]
    assert store.show_tables(spark).columns == ["namespace", "tableName", "isTemporary"]
    spark.sql(f"CREATE TABLE {loaded}.empty (x INT) USING parquet")
    got = {r.measurement: r for r in store.list_measurements(spark, loaded).collect()}
    files = {f for f in store.read(spark, loaded, "events").inputFiles()}
    size = sum(os.path.getsize(f.removeprefix("file://")) for f in files)
    assert got["events"].file_count == len(files)
    assert got["events"].total_size_mb == pytest.approx(size / 1024 / 1024, abs=1e-5)
    assert got["events"].storage_path.endswith("/events/**/*.parquet")
    assert (got["empty"].file_count, got["empty"].total_size_mb) == (0, 0.0)
    assert loaded in {r.database for r in store.list_measurements(spark).collect()}


def test_sql_in_a_database(spark, loaded):
    sql = "SELECT time_bucket('1h', time) AS time, event_type, avg(value) AS v FROM events GROUP BY 1, 2"
    assert run_sql(spark, sql, loaded).count() == run_sql(spark, sql.replace("events", f"{loaded}.events")).count()
    assert spark.catalog.currentDatabase() == "default"
    for call in (run_sql, response, estimate):
        for text in ("", "  \n"):
            with pytest.raises(ValueError, match="empty"):
                call(spark, text)


def test_response(spark, loaded):
    got = response(spark, "SELECT time, event_type, value FROM events ORDER BY time LIMIT 1", loaded)
    assert got["success"] and got["columns"] == ["time", "event_type", "value"] and got["row_count"] == 1
    assert isinstance(got["data"][0][0], int) and got["execution_time_ms"] > 0
    bad = response(spark, "SELECT nothing FROM nowhere")
    assert not bad["success"] and "nowhere" in bad["error"] and bad["data"] == []
    with pytest.raises(ValueError, match="over 5 rows"):
        response(spark, "SELECT * FROM events", loaded, max_rows=5)


def test_estimate(spark, loaded):
    sql = f"SELECT * FROM {loaded}.events"
    total = spark.sql(sql).count()
    got = estimate(spark, sql)
    assert (got["estimated_rows"], got["warning_level"]) == (total, "none")
    levels = (("none", 0), ("low", 10), ("medium", 100), ("high", total))
    assert estimate(spark, sql, levels=levels)["warning_level"] == "high"
    assert estimate(spark, "SELECT x FROM missing")["warning_level"] == "error"
    analyze(spark, f"{loaded}.events")
    assert estimate(spark, sql)["estimated_rows"] == total
    filtered = estimate(spark, f"{sql} WHERE event_type = 'view'")["estimated_rows"]
    assert 0 < filtered < total
