import pyarrow as pa
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoloom.functions.timeunits import generated_time, nanos_to_time, to_micros, to_nanos
from chronoloom.operators.merge import rows_per_measurement, sparse_merge
from chronoloom.sources.batches import batch_rows
from chronoloom.sources.columnar import columnar_batches, columnar_rows
from chronoloom.sources.frames import as_spark, table_rows
from chronoloom.sources.records import record_rows


def rows(df):
    """Rows with times as microseconds."""
    return [tuple(r) for r in df.withColumn("time", F.unix_micros("time")).collect()]


BATCH = "m string, columns struct<time:array<bigint>,host:array<string>,usage:array<double>>"


def test_columnar(spark):
    df = spark.createDataFrame([("cpu", ([1633024800000000, 1633024801000000], ["a", "b"], [45.2, 47.8]))], BATCH)
    assert rows(columnar_rows(df)) == [("cpu", 1633024800000000, "a", 45.2), ("cpu", 1633024801000000, "b", 47.8)]


@pytest.mark.parametrize("unit,stamps", [("s", [1633024800, 1633024801]), ("ms", [1633024800000, 1633024801000])])
def test_columnar_units(spark, unit, stamps):
    df = spark.createDataFrame([("cpu", (stamps, ["a", "b"], [1.0, 2.0]))], BATCH)
    assert [r[1] for r in rows(columnar_rows(df, unit))] == [1633024800000000, 1633024801000000]


def test_fractional_seconds(spark):
    df = spark.sql("SELECT explode(array(1.5D, -1.5D, 1.0000019D)) AS t")
    assert [r[0] for r in df.select(to_micros(F.col("t"), "s")).collect()] == [1500000, -1500000, 1000001]
    got = spark.sql("SELECT 2147483647 AS t").select(to_micros(F.col("t"), "s"), to_nanos(F.col("t"), "s"))
    assert tuple(got.first()) == (2147483647000000, 2147483647000000000)


def test_nanos_floor(spark):
    df = spark.sql("SELECT explode(array(1999L, -1L, 1633024800000000999L)) AS t")
    got = df.select(F.unix_micros(nanos_to_time(F.col("t")))).collect()
    assert [r[0] for r in got] == [1, -1, 1633024800000000]


def test_columnar_generated_time(spark):
    df = spark.sql("SELECT 'cpu' AS m, struct(array('a','b','c') AS host) AS columns")
    for unit in ("us", "s"):
        assert [r[1] for r in rows(columnar_rows(df, unit, now_us=1000))] == [1000, 1001, 1002]
    with_null = spark.createDataFrame([("cpu", (None, ["a"], [1.0])), ("cpu", ([5], None, [2.0]))], BATCH)
    assert rows(columnar_rows(with_null, "s", now_us=7)) == [("cpu", 7, "a", 1.0), ("cpu", 5000000, None, 2.0)]
    assert spark.range(1).select(F.unix_micros(generated_time(5))).first()[0] == 5


@pytest.mark.parametrize(
    "row,message",
    [
        (("", ([1], ["a"], [1.0])), "measurement name cannot be empty"),
        (("cpu", (None, None, None)), "columns cannot be empty"),
        (("cpu", ([1, 2], ["a"], [1.0])), "same length"),
    ],
)
def test_columnar_refusals(spark, row, message):
    with pytest.raises(Exception, match=message):
        columnar_rows(spark.createDataFrame([row], BATCH)).collect()


def test_columnar_plan_refusals(spark):
    df = spark.createDataFrame([("cpu", ([1], ["a"], [1.0]))], BATCH)
    with pytest.raises(ValueError, match="time unit"):
        columnar_rows(df, "ns")
    with pytest.raises(ValueError, match="struct of arrays"):
        columnar_rows(spark.sql("SELECT 'a' AS m, struct(1 AS x) AS columns"))


def test_columnar_batches_are_bounded_and_whole(spark, events):
    df = table_rows(events.select("ts", "event_id", "event_type"), "ts").withColumn("time", F.unix_micros("time"))
    batches = columnar_batches(df.repartition(3), "events", batch_size=70)
    assert batches.select(F.max(F.size("columns.time"))).first()[0] <= 70
    back = columnar_rows(batches).drop("measurement")
    want = table_rows(events.select("ts", "event_id", "event_type"), "ts").select(back.columns)
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()


def test_records(spark):
    schema = "measurement string, timestamp bigint, fields struct<usage:double,n:bigint>, tags map<string,string>"
    df = spark.createDataFrame(
        [("cpu", 5, (45.2, None), {"host": "a"}), ("mem", None, (None, 3), None), ("cpu", 6, (1.0, 7), {"n": "tag"})],
        schema,
    )
    got = record_rows(df, now_us=9)
    assert got.columns == ["measurement", "time", "host", "n", "usage"]
    assert rows(got) == [("cpu", 5, "a", None, 45.2), ("mem", 9, None, "3", None), ("cpu", 6, None, "tag", 1.0)]
    assert record_rows(df, tag_names=["host"], now_us=9).columns == ["measurement", "time", "host", "usage", "n"]


@pytest.mark.parametrize(
    "row,message", [((None, 1, {"a": 1.0}), "'measurement'"), (("m", 1, {}), "'fields'"), (("m", 1, None), "'fields'")]
)
def test_record_refusals(spark, row, message):
    df = spark.createDataFrame([row], "measurement string, timestamp bigint, fields map<string,double>")
    with pytest.raises(Exception, match=message):
        record_rows(df, field_names=["a"]).collect()


def test_time_may_not_be_a_field(spark):
    with pytest.raises(ValueError, match="'time'"):
        record_rows(spark.sql("SELECT 'm' AS measurement, struct(1 AS time) AS fields"))


MIXED = """batch array<struct<m:string, columns:struct<time:array<bigint>,value:array<double>>,
           t:bigint, fields:struct<used:bigint,value:double>, tags:map<string,string>>>"""


def test_mixed_batch(spark):
    items = [
        ("cpu", ([1, 2], [0.5, 0.6]), None, None, None),
        ("mem", None, 3, (7, None), {"host": "a"}),
        ("mem", None, None, (8, 1.5), None),
    ]
    got = batch_rows(spark.createDataFrame([(items,)], MIXED), now_us=9)
    assert got.columns == ["measurement", "time", "value", "host", "used"]
    assert rows(got) == [
        ("cpu", 1, 0.5, None, None),
        ("cpu", 2, 0.6, None, None),
        ("mem", 3, None, "a", 7),
        ("mem", 9, 1.5, None, 8),
    ]
    counts = {r.measurement: r.rows for r in rows_per_measurement(got, total=True).collect()}
    assert counts == {"cpu": 2, "mem": 2, None: 4}


def test_mixed_batch_refusals(spark):
    with pytest.raises(Exception, match="batch cannot be empty"):
        batch_rows(spark.createDataFrame([([],)], MIXED), tag_names=[]).collect()
    bare = [("m", None, 1, None, None)]
    with pytest.raises(Exception, match="'fields'"):
        batch_rows(spark.createDataFrame([(bare,)], MIXED), tag_names=[]).collect()


def test_table_rows(spark):
    pdf = pd.DataFrame({"ts": pd.to_datetime(["2024-01-01", "2024-01-02"]), "host": ["a", "b"], "value": [42.0, 43.5]})
    got = table_rows(as_spark(spark, pdf), "ts")
    assert rows(got) == [(1704067200000000, "a", 42.0), (1704153600000000, "b", 43.5)]
    arrow = pa.table({"time": pa.array([1, 2]), "v": [1.0, 2.0]})
    assert rows(table_rows(as_spark(spark, arrow))) == [(1, 1.0), (2, 2.0)]
    assert rows(table_rows(spark.sql("SELECT DATE'1970-01-02' AS d, 1 AS v"), "d")) == [(86400000000, 1)]
    with pytest.raises(ValueError, match="not found"):
        table_rows(spark.range(1))
    with pytest.raises(ValueError, match="another column"):
        table_rows(spark.sql("SELECT 1 AS ts, 2 AS time"), "ts")
    with pytest.raises(ValueError, match="not a time"):
        table_rows(spark.sql("SELECT 'x' AS time"))


def test_sparse_merge(spark):
    a, b = spark.sql("SELECT 1 AS x, 'p' AS h"), spark.sql("SELECT 2.5D AS x, true AS ok")
    got = sparse_merge([a, b])
    assert got.columns == ["x", "h", "ok"]
    assert [tuple(r) for r in got.collect()] == [(1.0, "p", None), (2.5, None, True)]
    with pytest.raises(ValueError, match="column 'x'"):
        sparse_merge([a, spark.sql("SELECT 'text' AS x")])
    with pytest.raises(ValueError, match="nothing"):
        sparse_merge([])
