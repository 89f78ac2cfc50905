from datetime import date

import pytest
from pyspark.sql import functions as F

from chronoloom.operators import measurements as store
from chronoloom.operators import results
from chronoloom.operators.results import estimate
from chronoloom.operators.statistics import merged_statistics, refresh_statistics
from chronoloom.sources.frames import table_rows


@pytest.fixture()
def loaded(spark, events, database):
    rows = table_rows(events.select("ts", "event_type", "value", "user_id"), "ts")
    store.append(rows, database, "cpu", tags=["event_type"])
    return database


def test_statistics_of_days_merge_to_those_of_the_whole(spark, loaded):
    days = store.days_of(spark, loaded, "cpu")
    assert merged_statistics(spark, loaded, "cpu") is None
    assert refresh_statistics(spark, loaded, "cpu") == days
    # A day that grows is taken again; columns that come later are nulls before.
    rows = spark.sql(f"SELECT timestamp'{days[3]} 00:00:00' AS time, 'zz' AS event_type, 7.5D AS load FROM range(9)")
    store.append(rows, loaded, "cpu")
    store.drop_days(spark, loaded, "cpu", days[:1])
    assert days[3] in refresh_statistics(spark, loaded, "cpu")
    table = store.read(spark, loaded, "cpu")
    got = {row["column"]: row for row in merged_statistics(spark, loaded, "cpu").collect()}
    assert set(got) == {"time", "event_type", "value", "user_id", "load"}
    for name in got:
        column = F.col(name)
        want = table.agg(F.count(F.lit(1)), F.min(column), F.max(column), F.count_if(column.isNull()), F.countDistinct(column)).first()
        row = got[name]
        assert (row.rows, row.nulls) == (want[0], want[3])
        assert abs(row.distinct - want[4]) <= max(1, 0.05 * want[4])
        if row.kind in ("double", "bigint"):
            assert (float(row.low), float(row.high)) == (want[1], want[2])
    assert got["time"].low == table.agg(F.date_format(F.min("time"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]


def test_estimate_from_kept_statistics_reads_no_data(spark, loaded, monkeypatch):
    refresh_statistics(spark, loaded, "cpu")

    def refuse(*_):
        raise AssertionError("rows were counted")

    monkeypatch.setattr(results, "row_counts", refuse)
    for where in ("true", "time >= '2024-01-10' AND time < '2024-01-20'", "event_type = 'click'", "time >= '2030-01-01'"):
        sql = f"SELECT * FROM cpu WHERE {where}"
        found = estimate(spark, sql, loaded)
        true = spark.sql(f"SELECT count(*) AS n FROM {loaded}.cpu WHERE {where}").first().n
        assert found["success"] and abs(found["estimated_rows"] - true) <= 0.25 * true + 2, where
    kinds = store.read(spark, loaded, "cpu").select("event_type").distinct().count()
    assert estimate(spark, "SELECT event_type, count(*) FROM cpu GROUP BY 1", loaded)["estimated_rows"] == kinds
    assert estimate(spark, "SELECT max(value) FROM cpu", loaded)["estimated_rows"] == 1
    assert estimate(spark, "SELECT * FROM cpu ORDER BY time DESC LIMIT 7", loaded)["estimated_rows"] == 7


def test_what_statistics_cannot_tell_is_left_to_plans_and_counts(spark, loaded):
    refresh_statistics(spark, loaded, "cpu")
    having = "SELECT event_type, count(*) AS n FROM cpu GROUP BY 1 HAVING n < 0"
    assert estimate(spark, having, loaded)["estimated_rows"] == 0
    n = store.read(spark, loaded, "cpu").count()
    # The optimizer knows of the limit alone.
    assert estimate(spark, "SELECT * FROM (SELECT * FROM cpu LIMIT 5) WHERE value < -1e9", loaded)["estimated_rows"] <= 5
    store.append(spark.sql("SELECT timestamp'2031-01-01' AS time, 'zz' AS event_type"), loaded, "cpu")
    assert estimate(spark, "SELECT * FROM cpu", loaded)["estimated_rows"] == n + 1


def test_statistics_of_an_empty_and_of_an_odd_measurement(spark, database):
    store.append(spark.sql("SELECT timestamp'2024-01-01' AS time, CAST(NULL AS string) AS s, map('a', 1) AS m, 1.5BD AS d WHERE false"), database, "none")
    assert refresh_statistics(spark, database, "none") == []
    assert estimate(spark, "SELECT * FROM none", database)["estimated_rows"] == 0
    store.append(spark.sql("SELECT timestamp'2024-01-01' AS time, CAST(NULL AS string) AS `s t`, map('a', 1) AS m, 1.5BD AS d, true AS b"), database, "odd")
    assert refresh_statistics(spark, database, "odd") == [date(2024, 1, 1)]
    assert estimate(spark, "SELECT * FROM odd", database)["estimated_rows"] == 1
