"""Retention: drop days older than a policy keeps."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass, fields
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions.timeunits import as_utc
from chronoloom.operators.measurements import days_of, drop_days, encoded, locations, names_of
from chronoloom.plans.history import RETENTION_RUNS, record, runs

PLAN_SCHEMA = (
    "policy_id bigint, database string, measurement string, cutoff_date timestamp, day date, rows bigint, files bigint"
)


@dataclass(frozen=True)
class RetentionPolicy:
    """Keep ``retention_days`` plus ``buffer_days`` of one measurement, or of all in the database."""

    id: int
    name: str
    database: str
    retention_days: int
    measurement: str | None = None
    buffer_days: int = 7
    is_active: bool = True

    def cutoff(self, as_of: datetime | date | str) -> datetime:
        """Moment before which data is out; whole days before its day are dropped, none is rewritten."""
        return as_utc(as_of) - timedelta(days=self.retention_days + self.buffer_days)


@dataclass(frozen=True)
class RetentionResult:
    """What a run did or, as a dry run, would do."""

    policy_id: int
    policy_name: str
    deleted_count: int
    files_deleted: int
    execution_time_ms: float
    dry_run: bool
    cutoff_date: datetime
    affected_measurements: list[str]


def policies_of(control: DataFrame | Iterable[RetentionPolicy]) -> list[RetentionPolicy]:
    """Policies from control rows, one per policy; columns that are no policy field are passed over."""
    if not isinstance(control, DataFrame):
        return list(control)
    known = [f.name for f in fields(RetentionPolicy) if f.name in control.columns]
    return [RetentionPolicy(**row.asDict()) for row in control.select(*known).collect()]


def scope(spark: SparkSession, policy: RetentionPolicy) -> list[str]:
    """Measurements a policy applies to; none if it is inactive."""
    if not policy.is_active:
        return []
    return _applies(policy, names_of(spark, policy.database))


def _applies(policy: RetentionPolicy, names: Iterable[str]) -> list[str]:
    return [n for n in names if policy.measurement in (None, n)]


def retention_plan(
    spark: SparkSession, control: DataFrame | Iterable[RetentionPolicy], as_of: datetime | date | str
) -> DataFrame:
    """Days the policies would drop: ``policy_id, database, measurement, cutoff_date, day, rows, files``.

    The catalogue's days are held against all policies at once; the folders of those that are expired are one scan, of which
    only file footers are read. The plan has the same size however many policies and measurements there are.
    """
    policies = [policy for policy in policies_of(control) if policy.is_active]
    names = {database: names_of(spark, database) for database in sorted({p.database for p in policies})}
    folders: dict[tuple[str, str], dict[date, str]] = {}
    expired = []
    for policy in policies:
        cutoff = policy.cutoff(as_of)
        for name in _applies(policy, names[policy.database]):
            key = policy.database, name
            if key not in folders:
                folders[key] = locations(spark, *key)
            expired += [
                (policy.id, *key, cutoff.isoformat(sep=" "), day, folder)
                for day, folder in folders[key].items()
                if day < cutoff.date()
            ]
    if not expired:
        return spark.createDataFrame([], PLAN_SCHEMA)
    days = spark.createDataFrame(
        expired, "policy_id bigint, database string, measurement string, cutoff_date string, day date, folder string"
    )
    paths = sorted({row[-1] for row in expired})
    # One column is named so that Spark need not open a file for its schema; none is read.
    files = spark.read.schema("time timestamp").parquet(*paths).select(F.col("_metadata.file_path").alias("path"))
    files = files.groupBy("path").count().withColumn("folder", _place(F.regexp_replace("path", "/[^/]*$", "")))
    sums = files.groupBy("folder").agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("files"))
    known = spark.createDataFrame([(path, encoded(spark, path)) for path in paths], "folder string, place string")
    known = known.select(F.col("folder").alias("known"), _place(F.col("place")).alias("place"))
    found = days.join(known, days["folder"] == known["known"]).join(sums, F.col("place") == sums["folder"])
    return found.select(
        "policy_id", "database", "measurement", F.col("cutoff_date").cast("timestamp").alias("cutoff_date"), "day", "rows", "files"
    )


def _place(path: Column) -> Column:
    """A path without the number of slashes after its scheme, which differs from one Spark function to another."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def run_retention(
    spark: SparkSession,
    policy: RetentionPolicy,
    as_of: datetime | date | str,
    dry_run: bool = True,
    confirm: bool = False,
) -> RetentionResult:
    """Drop the expired days of a policy and note the run; a dry run only counts. A real run needs ``confirm``."""
    started = time.monotonic()
    if not dry_run and not confirm:
        raise ValueError("pass confirm=True to delete data")
    cutoff = policy.cutoff(as_of)
    sums = (
        retention_plan(spark, [policy], as_of)
        .groupBy("measurement")
        .agg(F.sum("rows").alias("rows"), F.sum("files").alias("files"))
        .orderBy("measurement")
        .collect()
    )
    deleted, files = sum(row.rows for row in sums), sum(row.files for row in sums)

    def note(status: str, error: str | None = None) -> None:
        record(
            spark,
            policy.database,
            RETENTION_RUNS,
            policy_id=policy.id,
            status=status,
            deleted_count=deleted if error is None else 0,
            files_deleted=files if error is None else 0,
            cutoff_date=cutoff,
            execution_duration_ms=(time.monotonic() - started) * 1000,
            error_message=error,
        )

    if not dry_run:
        try:
            for name in scope(spark, policy):
                drop_days(
                    spark, policy.database, name, [d for d in days_of(spark, policy.database, name) if d < cutoff.date()]
                )
        except Exception as error:
            note("failed", str(error))
            raise
        note("completed")
    return RetentionResult(
        policy_id=policy.id,
        policy_name=policy.name,
        deleted_count=deleted,
        files_deleted=files,
        execution_time_ms=(time.monotonic() - started) * 1000,
        dry_run=dry_run,
        cutoff_date=cutoff,
        affected_measurements=[row.measurement for row in sums],
    )


def retention_runs(spark: SparkSession, policy: RetentionPolicy, limit: int = 50) -> DataFrame:
    """History of a policy, newest first."""
    return runs(spark, policy.database, RETENTION_RUNS, "policy_id", policy.id, limit)
