"""Run histories: one small table per kind of job and database."""

from __future__ import annotations

from datetime import datetime
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions.timeunits import now_micros
from chronoloom.operators.measurements import exists, quoted

# Names begin with an underscore, which keeps them out of the measurements.
QUERY_RUNS = "_query_runs"
RETENTION_RUNS = "_retention_runs"
QUERY_STATE = "_query_state"

SCHEMAS = {
    QUERY_RUNS: "id bigint, query_id bigint, execution_id string, execution_time timestamp, status string, "
    "start_time timestamp, end_time timestamp, records_read bigint, records_written bigint, "
    "execution_duration_seconds double, error_message string",
    RETENTION_RUNS: "id bigint, policy_id bigint, execution_time timestamp, status string, deleted_count bigint, "
    "files_deleted bigint, cutoff_date timestamp, execution_duration_ms double, error_message string",
    # Up to which file time, in microseconds, a continuous query has looked for late rows, and before when its source has been dropped.
    QUERY_STATE: "id bigint, query_id bigint, execution_time timestamp, checked_until bigint, dropped_before timestamp",
}


def record(spark: SparkSession, database: str, table: str, **values: Any) -> None:
    """Append one run. Datetimes are naive UTC."""
    now = now_micros()
    name = quoted(database, table)
    if not exists(spark, database, table):
        spark.sql(f"CREATE TABLE {name} ({SCHEMAS[table]}) USING parquet")
    known = {"id": now, "execution_id": uuid4().hex, **values}
    columns = [part.strip().split(" ") for part in SCHEMAS[table].split(",")]
    # Times go in as text, which the session reads as UTC whatever the zone of the driver.
    row = [v.isoformat(sep=" ") if isinstance(v, datetime) else v for v in (known.get(c) for c, _ in columns)]
    texts = ", ".join(f"{c} {'string' if kind == 'timestamp' else kind}" for c, kind in columns)
    one = spark.createDataFrame([tuple(row)], texts)
    one = one.withColumn("execution_time", F.timestamp_micros(F.lit(now)))
    one.select(*[F.col(c).cast(kind) for c, kind in columns]).coalesce(1).write.insertInto(name)


def runs(spark: SparkSession, database: str, table: str, key: str, value: int, limit: int = 50) -> DataFrame:
    """The newest ``limit`` runs of one definition, newest first."""
    if exists(spark, database, table):
        rows = spark.table(quoted(database, table))
    else:
        rows = spark.createDataFrame([], SCHEMAS[table])
    return rows.filter(F.col(key) == value).orderBy(F.desc("execution_time"), F.desc("id")).limit(limit)
