from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from chronoloom.functions.buckets import bucket_end, bucket_start, time_bucket, width_micros

WIDTHS = ["90 seconds", "15 minutes", "1 hour", "7 hours", "36 hours", "1 day", "7 days", "2 weeks", "1 month",
          "3 months", "5 months", "1 year", "1500 milliseconds"]


@pytest.mark.parametrize("width", WIDTHS)
def test_buckets_match_duckdb(spark, width):
    moments = "SELECT TIMESTAMP '{}' + INTERVAL 1 HOUR * i * 37 + INTERVAL 1 SECOND * i AS t FROM {} "
    table = spark.sql(
        "SELECT CAST(TIMESTAMP_NTZ'1969-11-03 05:06:07.123456' + make_dt_interval(0, id * 37, 0, id) AS TIMESTAMP) AS t "
        "FROM range(20000)"
    )
    ours = spark.sql(
        f"SELECT CAST(time_bucket('{width}', t) AS TIMESTAMP_NTZ) AS b, count(*) AS n FROM {{table}} GROUP BY 1", table=table
    )
    theirs = duckdb.sql(
        f"SELECT time_bucket(INTERVAL '{width}', t) AS b, count(*) AS n FROM "
        f"({moments.format('1969-11-03 05:06:07.123456', 'range(20000) r(i)')}) GROUP BY 1"
    ).fetchall()
    assert sorted(map(tuple, ours.collect())) == sorted(theirs)


@pytest.mark.parametrize("short,long", [("1h", "1 hour"), ("15m", "15 minutes"), ("7d", "7 days"), ("30S", "30 second"),
                                        ("2w", "14 days"), ("250ms", "250 milliseconds")])
def test_short_forms(spark, short, long):
    assert width_micros(spark, short) == width_micros(spark, long)


@pytest.mark.parametrize("bad", ["1x", "", "hour", "0 hours", "-1 hour", "1 month 1 day", "it's"])
def test_bad_widths(spark, bad):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' AS t").repartition(1)
    with pytest.raises(Exception, match="width"):
        df.select(time_bucket(bad, "t")).collect()
    with pytest.raises(ValueError, match="width"):
        width_micros(spark, bad)


def test_null_time(spark):
    df = spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS t").repartition(1)
    assert df.select(time_bucket("1 hour", "t"), time_bucket("1 month", F.col("t"))).first() == (None, None)


def test_bounds(spark):
    moment = datetime(2024, 1, 10, 7, 30)
    assert bucket_start(spark, "1h", moment) == datetime(2024, 1, 10, 7)
    assert bucket_end(spark, "1h", moment) == datetime(2024, 1, 10, 8)
    assert bucket_end(spark, "1h", datetime(2024, 1, 10, 8)) == datetime(2024, 1, 10, 8)
    assert bucket_end(spark, "1 month", moment) == datetime(2024, 2, 1)


def test_no_python_and_no_interval_work_per_row(spark, events):
    plan = events.select(time_bucket("1 hour", "ts").alias("b"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "interval" not in plan.lower() and "3600000000" in plan
