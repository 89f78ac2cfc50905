from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoloom import Workspace
from chronoloom.plans.continuous import ContinuousQuery
from chronoloom.plans.retention import RetentionPolicy
from tests.test_sources import BATCH, MIXED


@pytest.fixture()
def space(spark, database):
    return Workspace(spark, database)


def stored(space, name):
    return sorted(map(tuple, space.read(name).drop("day").withColumn("time", F.unix_micros("time")).collect()), key=repr)


def test_columnar(space):
    columns = {"time": [1633024800, 1633024801], "host": ["a", "b"], "usage": [1.5, None]}
    space.write_columnar("cpu", columns, time_unit="s")
    assert stored(space, "cpu") == [(1633024800000000, "a", 1.5), (1633024801000000, "b", None)]
    space.write_columnar("mem", {"used": [1, 2]}, time_unit="s")
    first, second = stored(space, "mem")
    assert second[0] == first[0] + 1
    for args, match in (
        (("", {"a": [1]}), "measurement"),
        (("m", {}), "empty"),
        (("m", {"a": [1], "b": []}), "same length"),
        (("m", {"time": [1], "a": [1]}, None, "min"), "unit"),
    ):
        with pytest.raises(ValueError, match=match):
            space.write_columnar(*args)


def test_batches_records_and_mixed(space, spark):
    batches = spark.createDataFrame([("cpu", ([1, 2], ["a", "b"], [0.5, 1.0])), ("disk", ([3], None, [2.0]))], BATCH)
    assert space.write_batches(batches) == ["cpu", "disk"]
    assert space.read("disk").columns == ["time", "usage", "day"]
    records = [
        {"measurement": "cpu", "timestamp": 5, "fields": {"usage": 2.5}, "tags": {"host": "c", "zone": "z"}},
        {"measurement": "net", "fields": {"up": True}},
    ]
    assert space.write_records(records) == ["cpu", "net"]
    assert stored(space, "cpu")[-1] == (5, "c", 2.5, "z")
    frame = spark.createDataFrame(
        [("net", 9, {"up": False}, None)],
        "measurement string, timestamp bigint, fields map<string,boolean>, tags map<string,string>",
    )
    assert space.write_records(frame) == ["net"] and space.read("net").count() == 2
    assert space.write_mixed(spark.createDataFrame([([("cpu", ([7], [0.1]), None, None, None)],)], MIXED)) == ["cpu"]
    for bad, match in (([], "empty"), ([{"fields": {"a": 1}}], "measurement"), ([{"measurement": "m"}], "fields")):
        with pytest.raises(ValueError, match=match):
            space.write_records(bad)


def test_dataframe_and_queries(space):
    pdf = pd.DataFrame(
        {"ts": pd.date_range("2024-01-01", periods=100, freq="min"), "host": ["a", "b"] * 50, "cpu": [float(i) for i in range(100)]}
    )
    space.write_dataframe(pdf, "server", time_column="ts", tag_columns=["host"], cluster=True)
    sql = "SELECT host, avg(cpu) AS c, max(cpu) AS m FROM server GROUP BY host ORDER BY 1"
    assert [tuple(r) for r in space.query(sql).collect()] == [("a", 49.0, 98.0), ("b", 50.0, 99.0)]
    assert space.response(sql)["data"] == [["a", 49.0, 98.0], ["b", 50.0, 99.0]]
    assert space.estimate("SELECT * FROM server")["estimated_rows"] == 100
    assert space.read("server", "2024-01-01T01:00:00", datetime(2024, 1, 2)).count() == 40
    assert [r.measurement for r in space.list_measurements(space.database).collect()] == ["server"]
    assert space.show_tables(space.database).count() == 1 and space.list_databases().count() > 1


def test_line_protocol(space, spark):
    text = "cpu,host=server01 usage=45.2 1633024800000000000\nmem used=1i 1633024800000000000\n\n# note"
    assert space.write_line_protocol(text) == ["cpu", "mem"]
    assert space.write_line_protocol(["cpu,host=b usage=1 1633024801000000000"]) == ["cpu"]
    assert stored(space, "cpu") == [(1633024800000000, "server01", 45.2), (1633024801000000, "b", 1.0)]
    with pytest.raises(ValueError, match="off the grammar"):
        space.write_line_protocol(["cpu usage=2 5", "broken"])
    assert space.read("cpu").count() == 2
    from chronoloom.session import shared_dir

    bad = f"{shared_dir(spark)}/{space.database}-bad"
    space.write_line_protocol(["cpu usage=2 5", "broken"], reject_path=bad)
    assert space.read("cpu").count() == 3
    assert [r.value for r in spark.read.text(bad).collect()] == ["broken"]


def test_merge_and_upkeep(space, spark):
    a = spark.sql("SELECT TIMESTAMP'2024-01-01 00:10:00' AS time, 'x' AS host, 1.0D AS usage")
    b = spark.sql("SELECT TIMESTAMP'2024-01-05 00:20:00' AS time, 3.0D AS usage, true AS ok")
    space.merge([a, b], "cpu")
    query = ContinuousQuery(
        id=1, name="h", database=space.database, source_measurement="cpu", destination_measurement="cpu_1h",
        query="SELECT time_bucket('1 hour', time) AS time, avg(usage) AS usage FROM cpu GROUP BY 1", interval="1h",
    )
    assert space.run_continuous(query, "2024-01-01", "2024-01-02").records_written == 1
    assert space.run_pending(query, "2024-01-06").records_written == 1
    got = space.delete(space.database, "cpu", "ok", dry_run=False)
    assert got.deleted_count == 1 and space.read("cpu").count() == 1
    policy = RetentionPolicy(id=1, name="p", database=space.database, retention_days=3, buffer_days=0)
    result = space.run_retention(policy, "2024-01-06", dry_run=False, confirm=True)
    assert result.affected_measurements == ["cpu", "cpu_1h"] and result.deleted_count == 2


SAMPLES = [
    "SELECT * FROM {db}.cpu WHERE host = 'server01'",
    "SELECT * FROM {db}.cpu WHERE time > now() - INTERVAL '1 hour'",
    "SELECT * FROM {db}.cpu LIMIT 1000",
    "SELECT * FROM {db}.cpu ORDER BY time DESC LIMIT 10",
    "SELECT * FROM {db}.cpu ORDER BY time",
    "SELECT host, avg(usage_idle) AS a, max(usage_user) AS m FROM {db}.cpu GROUP BY host",
    "SELECT time_bucket('1 hour', time) as time, host, avg(usage_idle) as usage_idle FROM {db}.cpu GROUP BY 1, 2",
    "SELECT time_bucket('1h', time) AS t, count(*) FROM {db}.cpu GROUP BY 1",
    "SHOW DATABASES",
    "SHOW TABLES FROM {db}",
]


def test_sample_queries_run_unchanged(space):
    space.write_columnar(
        "cpu",
        {
            "time": [1704067200000000, 1704067201000000, 1704067202000000],
            "host": ["server01", "server01", "server02"],
            "region": ["us-east", "us-east", "us-west"],
            "usage_idle": [95.0, 94.5, 87.3],
            "usage_user": [3.2, 3.5, 8.1],
        },
    )
    counts = [space.query(sql.format(db=space.database)).count() for sql in SAMPLES]
    assert counts[:8] == [2, 0, 3, 3, 3, 2, 2, 1] and counts[9] == 1
    first = space.response(SAMPLES[3].format(db=space.database))
    assert first["data"][0][0] == 1704067202000000 and first["row_count"] == 3
    assert space.delete(space.database, "cpu", "time < '2024-01-01'").deleted_count == 0
    assert space.delete(space.database, "cpu", "time < '2024-01-01T00:00:01Z'").deleted_count == 1


def test_a_heavy_day_is_split(space, spark):
    from chronoloom.session import settings

    rows = spark.range(400_000).select(
        F.expr("TIMESTAMP'2024-01-01 00:00:00' + make_dt_interval(if(id % 3 = 0, 5, int(id % 9)), 0, 0, id / 10)").alias("time"),
        F.concat(F.lit("host"), F.col("id") % 7).alias("host"),
        F.rand(1).alias("value"),
    )
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        space.write_dataframe(rows, "load", tag_columns=["host"], cluster=True)
    per_day = space.read("load").groupBy("day", F.col("_metadata.file_path").alias("f")).count()
    files = {r.day.day: r.files for r in per_day.groupBy("day").agg(F.count("f").alias("files")).collect()}
    assert space.read("load").count() == 400_000
    assert files[6] >= 4 and sum(files.values()) < 40
