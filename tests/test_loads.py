"""What loads refuse, widen and note."""

import pytest
from pyspark.sql import functions as F

from chronoloom import Workspace
from chronoloom.operators import measurements
from chronoloom.plans import deletion
from chronoloom.plans.loading import append_each, append_lines
from chronoloom.sources.batches import batch_rows
from chronoloom.sources.records import record_rows
from chronoloom.streaming.ingest import BatchWriter, into_measurement, replayed, stream_json

def mixed(spark, many, single, one, two):
    kind = (
        f"struct<m: string, columns: struct<time: array<bigint>, v: array<{many}>>, t: bigint, "
        f"fields: struct<v: {single}>, tags: struct<host: string>>"
    )
    items = [("a", ([1, 2], one), None, None, None), ("a", None, 3, (two,), ("h",))]
    return spark.createDataFrame([(items,)], f"batch array<{kind}>")


def test_mixed_types_are_widened(spark):
    rows = batch_rows(mixed(spark, "bigint", "double", [7, 8], 1.9), now_us=5)
    assert rows.schema["v"].dataType.simpleString() == "double"
    assert sorted(r.v for r in rows.collect()) == [1.9, 7.0, 8.0]
    rows = batch_rows(mixed(spark, "int", "bigint", [7, 8], 1 << 60), now_us=5)
    assert rows.schema["v"].dataType.simpleString() == "bigint" and sorted(r.v for r in rows.collect()) == [7, 8, 1 << 60]


def test_mixed_types_that_clash(spark):
    with pytest.raises(ValueError, match="holds bigint in one item and string"):
        batch_rows(mixed(spark, "bigint", "string", [7, 8], "x"))
    with pytest.raises(Exception, match="a double cannot hold"):
        batch_rows(mixed(spark, "bigint", "double", [(1 << 53) + 1, 8], 1.5)).collect()


def test_load_is_refused_whole(spark, database):
    first = spark.range(3).selectExpr("'b' AS measurement", "timestamp_micros(id) AS time", "'x' AS v")
    append_each(first, database)
    clash = spark.range(4).selectExpr("IF(id < 2, 'a', 'b') AS measurement", "timestamp_micros(id) AS time", "id AS v")
    with pytest.raises(ValueError, match="is string"):
        append_each(clash, database)
    with pytest.raises(ValueError, match="is string"):
        append_lines(spark.createDataFrame([("a v=1i 1",), ("b v=1i 1",)], "value string"), database)
    assert measurements.names_of(spark, database) == ["b"]


def test_columns_of_nulls_wait_for_a_type(spark, database):
    space = Workspace(spark, database)
    space.write_columnar("m", {"time": [1, 2], "v": [None, None], "w": [1, 2]})
    assert "v" not in spark.table(f"{database}.m").columns
    space.write_columnar("m", {"time": [3], "v": ["text"], "w": [3]})
    assert [r.v for r in spark.table(f"{database}.m").orderBy("time").collect()] == [None, None, "text"]


def test_lossy_and_confusing_columns_are_refused(spark, database):
    rows = lambda sql: spark.range(2).selectExpr("timestamp_micros(id) AS time", sql)
    measurements.append(rows("1.5D AS v"), database, "m")
    measurements.append(rows("1 AS v"), database, "m")
    with pytest.raises(ValueError, match="is double"):
        measurements.append(rows("id AS v"), database, "m")
    with pytest.raises(ValueError, match="differ in case"):
        measurements.append(rows("1.5D AS V"), database, "m")


def test_tags_are_noted(spark, database):
    space = Workspace(spark, database)
    records = [("cpu", {"host, rack": "a"}, {"usage": 1.0}), ("mem", {"pool": "p"}, {"used": 2.0})]
    space.write_records(spark.createDataFrame(records, "measurement string, tags map<string,string>, fields map<string,double>"))
    assert measurements.tags_of(spark, database, "cpu") == ["host, rack"]
    assert measurements.tags_of(spark, database, "mem") == ["pool"]
    space.write_mixed(mixed(spark, "bigint", "bigint", [7, 8], 9))
    assert measurements.tags_of(spark, database, "a") == ["host"]


def test_many_keys(spark):
    keys = spark.range(12_000).selectExpr("'m' AS measurement", "map(concat('k', id), 1.0D) AS fields").repartition(2)
    assert len(record_rows(keys).columns) == 12_002


def test_delete_report_says_what_is_rewritten(spark, database):
    rows = lambda a, b: spark.range(a, b, 1, 1).selectExpr("timestamp_micros(id) AS time", "id AS n")
    for a, b in ((0, 5), (5, 10), (10, 12)):
        measurements.append(rows(a, b), database, "m")
    before = set(spark.table(f"{database}.m").inputFiles())
    got = deletion.delete(spark, database, "m", "n IN (1, 10, 11)", dry_run=False)
    assert (got.deleted_count, got.affected_files, got.rewritten_files) == (3, 2, 1)
    # The file without a match stays where it is.
    after = set(spark.table(f"{database}.m").inputFiles())
    assert (len(before & after), len(after - before)) == (1, 1)
    assert sorted((r.rows, r.matched, r.rewritten) for r in got.files_processed.collect()) == [(2, 2, False), (5, 1, True)]


def test_stream_into_a_measurement(spark, database, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    source.mkdir()
    schema = "measurement string, fields struct<v: double>, tags struct<host: string>"

    def run():
        rows = record_rows(stream_json(spark, str(source), schema))
        into_measurement(rows, database, checkpoint, tags=["host"], once=True).awaitTermination()

    (source / "a.json").write_text('{"measurement":"cpu","fields":{"v":1.0},"tags":{"host":"x"}}\n' * 3)
    run()
    (source / "b.json").write_text('{"measurement":"cpu","fields":{"v":2.0}}\n{"measurement":"mem","fields":{"v":5.0}}\n')
    run()
    run()
    cpu = spark.table(f"{database}.cpu")
    assert (cpu.count(), spark.table(f"{database}.mem").count()) == (4, 1)
    assert measurements.tags_of(spark, database, "cpu") == ["host"]
    assert cpu.select("time").distinct().count() == 2  # one moment for each micro-batch
    assert [r.batch for r in replayed(spark, database).orderBy("batch").collect()] == [0, 1]
    deletion.delete(spark, database, "cpu", "v = 1.0", dry_run=False)
    assert [r.v for r in spark.table(f"{database}.cpu").collect()] == [2.0]


def test_a_batch_that_runs_again_is_written_once(spark, database, tmp_path, monkeypatch):
    rows = spark.range(4).selectExpr("timestamp_micros(id) AS time", "IF(id < 3, 'a', 'b') AS measurement", "id AS v")
    writer = BatchWriter(database, str(tmp_path / "s"))
    writer(rows, 0)
    writer(rows, 0)
    count = lambda name: spark.table(f"{database}.{name}").count()
    assert (count("a"), count("b")) == (3, 1)

    # A driver that dies between two measurements, and one that dies before the ledger is written.
    publish = BatchWriter._publish

    def dies(self, spark, files, folder, name, batch):
        if name == "b":
            raise RuntimeError("lost")
        publish(self, spark, files, folder, name, batch)

    monkeypatch.setattr(BatchWriter, "_publish", dies)
    with pytest.raises(RuntimeError, match="lost"):
        writer(rows, 1)
    monkeypatch.undo()
    writer(rows, 1)
    assert (count("a"), count("b")) == (6, 2)
    assert sorted((r.batch, r.rows) for r in replayed(spark, database).collect()) == [(0, 4), (1, 4)]
