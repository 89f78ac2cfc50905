"""Timed ingest as a stream: files come in, typed rows go out in committed batches."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chronoloom.operators.files import Files
from chronoloom.operators.measurements import COMPRESSION, DAY, aligned, check_columns, exists, prepare, quoted, with_day
from chronoloom.plans.loading import loads_of
from chronoloom.sources.lines import parse_lines, typed_rows


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the lines of text files in a folder, gzip or plain."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Stream of JSON payloads in a folder: records, columnar batches or mixed batches, by their schema."""
    return spark.readStream.schema(schema).json(path)


def stream_points(
    lines: DataFrame, measurement: str, tags: Sequence[str], fields: Mapping[str, str], now_us: int | None = None
) -> DataFrame:
    """Typed rows of a stream of line-protocol text."""
    return typed_rows(parse_lines(lines), measurement, tags, fields, now_us)


def start_ingest(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    flush_interval: float = 5.0,
    max_rows_per_file: int = 1_000_000,
    once: bool = False,
) -> StreamingQuery:
    """Write a stream of rows as Parquet by measurement, if the rows name one, and day.

    A batch is committed every ``flush_interval`` seconds, or all that is there with ``once``. The file sink and the
    checkpoint make each batch count exactly once, also after a restart: nothing held back in memory can be lost. The
    row bound splits a heavy batch into several files; it does not hold rows back.
    """
    by = ["measurement", DAY] if "measurement" in rows.columns else [DAY]
    writer = (
        with_day(rows)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", COMPRESSION)
        .option("maxRecordsPerFile", max_rows_per_file)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{flush_interval} seconds")
    return writer.start()


BATCHES = "_stream_batches"
LEDGER = "stream string, batch bigint, rows bigint, committed timestamp"


class BatchWriter:
    """Appends micro-batches to their measurements, each batch once however often it is run.

    A batch is staged whole beside the stream's checkpoint, then its files are moved into the days of the tables under
    names of their own, and last the ledger notes the batch. A run that dies while staging has moved nothing and
    stages anew; one that dies later finds the staged files that are left and moves those. A noted batch is skipped.
    Columns that clash with a table are an error before anything is moved.
    """

    def __init__(self, database: str, checkpoint: str, tags: Sequence[str] = (), measurement: str | None = None) -> None:
        self.database, self.tags, self.measurement = database, list(tags), measurement
        self.folder = f"{checkpoint.rstrip('/')}-staged"
        self.stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:16]

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        noted = (F.col("stream") == self.stream) & (F.col("batch") == batch)
        if not replayed(spark, self.database).filter(noted).isEmpty():
            return
        stage, files = f"{self.folder}/batch-{batch}", Files(spark)
        if not files.exists(f"{stage}/_STAGED"):
            files.remove(stage)
            self._stage(rows, stage)
            files.touch(f"{stage}/_STAGED")
        for folder in files.folders(stage):
            self._publish(spark, files, f"{stage}/{folder}", folder, batch)
        count = int(files.names(stage, "_ROWS-")[0].removeprefix("_ROWS-"))
        ledger = quoted(self.database, BATCHES)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger} ({LEDGER}) USING parquet")
        one = spark.range(1).select(F.lit(self.stream), F.lit(batch).cast("bigint"), F.lit(count).cast("bigint"), F.current_timestamp())
        one.write.insertInto(ledger)
        files.remove(stage)

    def _stage(self, rows: DataFrame, stage: str) -> None:
        spark, total = rows.sparkSession, 0
        if self.measurement is not None:
            rows = rows.withColumn("measurement", F.lit(self.measurement))
        with loads_of(rows, self.tags) as loads:
            for name, (part, _) in loads.items():
                check_columns(spark, with_day(part), self.database, name)
            for name, (part, tags) in loads.items():
                part = with_day(part)
                prepare(spark, part, self.database, name, tags)
                part = aligned(part, spark.table(quoted(self.database, name)))
                # Rows of a day come together, so a batch adds a file or so to each day it touches.
                target = f"{stage}/{name}"
                part.hint("rebalance", DAY).write.partitionBy(DAY).option("compression", COMPRESSION).parquet(target)
                total += spark.read.schema(part.schema).parquet(target).count()
        Files(spark).touch(f"{stage}/_ROWS-{total}")

    def _publish(self, spark: SparkSession, files: Files, folder: str, name: str, batch: int) -> None:
        table = quoted(self.database, name)
        for day in files.folders(folder):
            spec = f"PARTITION ({DAY} = '{day.split('=', 1)[1]}')"
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec}")
            place = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").filter("col_name = 'Location'").first().data_type
            for part in files.names(f"{folder}/{day}", "part-"):
                target = f"{place.rstrip('/')}/{self.stream}-{batch}-{part}"
                files.move(f"{folder}/{day}/{part}", target)
                files.renew(target)
        spark.catalog.refreshTable(table)


def replayed(spark: SparkSession, database: str) -> DataFrame:
    """The ledger of micro-batches that are in their measurements: ``stream, batch, rows, committed``."""
    return spark.table(quoted(database, BATCHES)) if exists(spark, database, BATCHES) else spark.createDataFrame([], LEDGER)


def into_measurement(
    rows: DataFrame,
    database: str,
    checkpoint: str,
    measurement: str | None = None,
    tags: Sequence[str] = (),
    flush_interval: float = 5.0,
    once: bool = False,
) -> StreamingQuery:
    """Append a stream of rows to the measurements that their column ``measurement`` names, or to the one given.

    They are rows of the tables like any others: SQL, deletes, continuous queries and retention see them.
    """
    if measurement is None and "measurement" not in rows.columns:
        raise ValueError("rows of a stream need a measurement")
    writer = rows.writeStream.foreachBatch(BatchWriter(database, checkpoint, tags, measurement)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{flush_interval} seconds")
    return writer.start()


def ingested(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Committed rows of ``start_ingest``; batches that did not finish are not among them."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def expose(spark: SparkSession, path: str, database: str, measurement: str) -> None:
    """Make a stream's committed rows known to SQL as ``database.measurement``, by a view.

    The view reads through the sink's log, so batches in progress stay unseen, and it keeps the partition columns, so
    a range of days opens only those. Deletes and retention work on tables; ``append`` moves rows into one.
    """
    rows = ingested(spark, path)
    columns = ", ".join(quoted(name) for name in rows.columns if name != "measurement")
    text = measurement.replace("\\", "\\\\").replace("'", "\\'")
    where = f" WHERE measurement = '{text}'" if "measurement" in rows.columns else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(database, measurement)} AS "
        f"SELECT {columns} FROM parquet.{quoted(path)}{where}"
    )


def pending_rows(query: StreamingQuery) -> int:
    """Rows taken in by the newest batch."""
    progress = query.lastProgress
    return progress["numInputRows"] if progress else 0
