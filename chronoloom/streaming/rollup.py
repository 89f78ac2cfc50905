"""Downsampling as a stream."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronoloom.functions.buckets import ORIGIN_SECONDS, width_micros
from chronoloom.operators.files import Files
from chronoloom.operators.measurements import exists, quoted, upsert
from chronoloom.plans.history import QUERY_RUNS, record


def rollup(
    rows: DataFrame,
    width: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    late: str = "10 minutes",
) -> DataFrame:
    """``time, keys..., aggregates...`` by bucket, the same buckets as ``time_bucket``.

    Rows are combined before the shuffle, so a heavy key costs one partial row per task. A bucket comes out once the
    newest time seen is ``late`` past its end, and its state is then dropped; rows later than that need a batch run
    of their range. Works on a plain DataFrame too.
    """
    micros = width_micros(rows.sparkSession, width)
    shift = ORIGIN_SECONDS * 1_000_000 % micros
    length = f"{micros} microseconds"
    bucket = F.window("time", length, length, f"{shift} microseconds")
    return (
        rows.withWatermark("time", late)
        .groupBy(bucket.alias("_bucket"), *keys)
        .agg(*aggregates)
        .withColumn("time", F.col("_bucket.start"))
        .drop("_bucket")
    )


#: Status of a micro-batch in the run history; its buckets may still change, so it covers no range for ``mark_of``.
STREAMED = "streamed"


class BucketWriter:
    """Puts the buckets that a micro-batch changed into their measurement, and notes the batch as a run.

    Buckets are staged beside the stream's checkpoint first, so the state is read once. A batch that runs again puts the same
    values in the same places, and is noted once.
    """

    def __init__(
        self, database: str, measurement: str, width: str, keys: Sequence[str], checkpoint: str, query_id: int | None = None
    ) -> None:
        self.database, self.measurement, self.width, self.keys = database, measurement, width, list(keys)
        self.folder, self.query_id = f"{checkpoint.rstrip('/')}-staged", query_id
        self.stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:16]

    def __call__(self, buckets: DataFrame, batch: int) -> None:
        spark = buckets.sparkSession
        run = f"{self.stream}-{batch}"
        if exists(spark, self.database, QUERY_RUNS):
            noted = spark.table(quoted(self.database, QUERY_RUNS)).filter(F.col("execution_id") == run)
            if not noted.isEmpty():
                return
        stage, files = f"{self.folder}/batch-{batch}", Files(spark)
        if not files.exists(f"{stage}/_STAGED"):
            buckets.write.mode("overwrite").parquet(stage)
            files.touch(f"{stage}/_STAGED")
        changed = spark.read.schema(buckets.schema).parquet(stage)
        edges = [f("time").cast("timestamp_ntz").alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
        seen = changed.agg(F.count(F.lit(1)).alias("rows"), *edges).first()
        if seen.rows:
            upsert(spark, self.database, self.measurement, changed, self.keys)
            record(
                spark,
                self.database,
                QUERY_RUNS,
                query_id=self.query_id,
                execution_id=run,
                status=STREAMED,
                start_time=seen.low,
                end_time=seen.high + timedelta(microseconds=width_micros(spark, self.width)),
                records_written=seen.rows,
            )
        files.remove(stage)


def rollup_into(
    rows: DataFrame,
    database: str,
    measurement: str,
    width: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    checkpoint: str,
    late: str = "10 minutes",
    query_id: int | None = None,
    flush_interval: float = 5.0,
    once: bool = False,
) -> StreamingQuery:
    """Keep ``rollup`` of a stream in a measurement: after each micro-batch its buckets are as the rows so far make them.

    Unfinished buckets are there from their first row on, and a row that is up to ``late`` behind the newest changes its bucket again.
    The state holds the open buckets alone; a micro-batch reads and writes only the days of the measurement whose buckets it
    changed, never the source. Rows later than ``late`` need a batch run of their range. Each micro-batch is a row of the run history
    with the status ``streamed``.
    """
    writer = BucketWriter(database, measurement, width, keys, checkpoint, query_id)
    out = rollup(rows, width, keys, aggregates, late).writeStream.outputMode("update")
    out = out.foreachBatch(writer).option("checkpointLocation", checkpoint)
    out = out.trigger(availableNow=True) if once else out.trigger(processingTime=f"{flush_interval} seconds")
    return out.start()
