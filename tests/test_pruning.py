"""Days that SQL opens, and results that stay as they are."""

import pytest
from pyspark.sql import functions as F

from chronoloom.operators import measurements, results
from chronoloom.operators.pruning import day_bounds, newest_from, scans


@pytest.fixture()
def ticks(spark, database):
    start = "TIMESTAMP'2024-01-01 00:00:00'"
    rows = spark.range(240).selectExpr(f"{start} + make_dt_interval(0, CAST(id AS INT)) AS time", "id AS n", "id % 3 AS host")
    measurements.append(rows, database, "ticks", tags=["host"])
    return database


def days_read(df):
    return {path.split("day=")[1].split("/")[0] for path in df.inputFiles()}


def filters_of(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PartitionFilters" in line]


CASES = [
    ("SELECT * FROM ticks WHERE time >= '2024-01-03 05:00:00' AND time < '2024-01-04 12:00:00'", {"2024-01-03", "2024-01-04"}, 31),
    ("SELECT n FROM ticks WHERE time BETWEEN '2024-01-03' AND '2024-01-03 02:00:00' AND n > 0", {"2024-01-03"}, 3),
    ("SELECT n FROM ticks WHERE TIMESTAMP'2024-01-10 10:00:00' <= time", {"2024-01-10"}, 14),
    ("SELECT n FROM ticks WHERE time = '2024-01-02 03:00:00'", {"2024-01-02"}, 1),
    ("SELECT host, count(*) AS c FROM ticks WHERE time > TIMESTAMP'2024-01-10' - INTERVAL '1 day' GROUP BY host", {"2024-01-09", "2024-01-10"}, 3),
    ("SELECT * FROM (SELECT time AS t, n FROM ticks) WHERE t < '2024-01-01 04:00:00'", {"2024-01-01"}, 4),
    ("WITH x AS (SELECT * FROM ticks) SELECT * FROM x WHERE time >= '2024-01-10' AND (n > 5 OR n < 3)", {"2024-01-10"}, 24),
    (
        "SELECT a.n FROM ticks a JOIN ticks b ON a.n = b.n - 24 WHERE a.time < '2024-01-02' AND b.time < '2024-01-03'",
        {"2024-01-01", "2024-01-02"},
        24,
    ),
    ("SELECT time, n FROM ticks ORDER BY time DESC LIMIT 30", {"2024-01-09", "2024-01-10"}, 30),
    ("SELECT time, n + 1 AS m FROM ticks ORDER BY time DESC, m LIMIT 3", {"2024-01-10"}, 3),
]


@pytest.mark.parametrize("sql,days,count", CASES)
def test_days(spark, ticks, sql, days, count):
    got = results.run_sql(spark, sql, ticks)
    assert days_read(got) == days
    assert all("day#" in line for line in filters_of(got)) and filters_of(got)
    with measurements.current_database(spark, ticks):
        want = spark.sql(sql).collect()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want)) and len(want) == count


WHOLE = [
    "SELECT * FROM ticks WHERE time >= '2024-01-10' OR n = 1",
    "SELECT time, n FROM ticks ORDER BY time LIMIT 3",
    "SELECT time, n FROM ticks WHERE n < 10 ORDER BY time DESC LIMIT 3",
    "SELECT time, n FROM ticks ORDER BY n, time DESC LIMIT 3",
    "SELECT max(time) AS time FROM ticks ORDER BY time DESC LIMIT 3",
    "SELECT a.n FROM ticks a LEFT JOIN ticks b ON a.n = b.n AND b.time < '2024-01-02'",
    "SELECT * FROM ticks WHERE NOT time < '2024-01-02' OR time IS NULL",
]


@pytest.mark.parametrize("sql", WHOLE)
def test_whole_tables_stay_whole(spark, ticks, sql):
    got = results.run_sql(spark, sql, ticks)
    assert len(days_read(got)) == 10
    with measurements.current_database(spark, ticks):
        assert sorted(map(repr, got.collect())) == sorted(map(repr, spark.sql(sql).collect()))


def test_clock_and_views(spark, ticks):
    assert results.run_sql(spark, "SELECT * FROM ticks WHERE time > now() - INTERVAL '1 hour'", ticks).collect() == []
    got = results.run_sql(spark, "SELECT * FROM ticks WHERE time < now() AND time > '2024-01-10'", ticks)
    assert got.count() == 23 and days_read(got) == {"2024-01-10"}
    spark.range(3).withColumn("time", F.timestamp_micros(F.col("id"))).createOrReplaceTempView("ticks")
    assert results.run_sql(spark, "SELECT * FROM ticks WHERE time >= '1970-01-01'", ticks).count() == 3
    spark.catalog.dropTempView("ticks")
    assert results.run_sql(spark, f"SELECT * FROM {ticks}.ticks WHERE time >= '2024-01-10'").count() == 24
    assert not spark.catalog.tableExists("ticks")


def test_newest_days(spark, ticks):
    found = {n: newest_from(spark, ticks, "ticks", n) for n in (1, 24, 25, 240, 241)}
    assert {n: d and d.isoformat() for n, d in found.items()} == {1: "2024-01-10", 24: "2024-01-10", 25: "2024-01-09", 240: "2024-01-01", 241: None}


def test_bounds_of_a_plan(spark, ticks):
    sql = f"SELECT * FROM {ticks}.ticks WHERE time > '2024-01-05 01:00:00'"
    df = spark.sql(sql)
    assert [(s.database, s.measurement, s.high) for s in scans(df)] == [(ticks, "ticks", None)]
    assert {k: str(v[0]) for k, v in day_bounds(spark, df, sql).items()} == {(ticks, "ticks"): "2024-01-05"}
