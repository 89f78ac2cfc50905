"""Delete by predicate."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass
from datetime import date, datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions.timeunits import as_utc
from chronoloom.operators.measurements import DAY, finish_changes, read, replace_files
from chronoloom.session import shared_dir


@dataclass(frozen=True)
class DeleteLimits:
    """Guard of a delete."""

    enabled: bool = True
    confirmation_threshold: int = 10_000
    max_rows_per_delete: int = 1_000_000


@dataclass(frozen=True)
class DeleteResult:
    """What a delete did or, as a dry run, would do; ``files_processed`` is the report by file.

    ``affected_files`` hold matching rows; ``rewritten_files`` are those of them that hold others too, which go to new files.
    """

    success: bool
    deleted_count: int
    affected_files: int
    rewritten_files: int
    execution_time_ms: float
    dry_run: bool
    files_processed: DataFrame


def check(database: str, measurement: str, where: str) -> None:
    if not database:
        raise ValueError("database is required")
    if not measurement:
        raise ValueError("measurement is required")
    if not where or not where.strip():
        raise ValueError("where clause is required; use '1=1' with confirm=True to delete all")


_CLOCK = re.compile(
    r"('(?:[^']|'')*')|\b(now\(\s*\)|current_timestamp(?:\(\s*\))?)|\b(current_date(?:\(\s*\))?|curdate\(\s*\))|\b(localtimestamp(?:\(\s*\))?)", re.I
)


def at_moment(where: str, as_of: datetime | date | str | None = None) -> str:
    """The predicate with its clock stopped at ``as_of``, or now.

    A delete reads the table more than once, and every time has to mean the same rows.
    """
    moment = datetime.now(timezone.utc) if as_of is None else as_of
    stamp = f"TIMESTAMP'{as_utc(moment).isoformat(sep=' ')}'"
    return _CLOCK.sub(lambda m: m.group(1) or _stopped(m, stamp), where)


def _stopped(found: re.Match, stamp: str) -> str:
    if found.group(2):
        return stamp
    return f"to_date({stamp})" if found.group(3) else stamp.replace("TIMESTAMP", "TIMESTAMP_NTZ", 1)


def survivors(rows: DataFrame, where: str | Column) -> DataFrame:
    """Rows a delete keeps, among them those for which the predicate is null."""
    predicate = F.expr(where) if isinstance(where, str) else where
    return rows.filter(~F.coalesce(predicate, F.lit(False)))


def delete_report(spark: SparkSession, database: str, measurement: str, where: str) -> DataFrame:
    """Files of days with matching rows, and what a delete does to each: ``day, file_path, rows, matched, rewritten, action``.

    A file without matching rows is ``untouched``; one with nothing else is ``dropped``; the others are ``rewritten``.
    Matching rows are found with the predicate pushed into the scan, so files and row groups without any are skipped; all rows
    are counted, from footers, only in the days that were hit. A predicate that may be true of other rows each time it is read,
    such as one with ``rand()``, is refused.
    """
    check(database, measurement, where)
    shared_dir(spark)
    rows = read(spark, database, measurement).select("*", F.col("_metadata.file_path").alias("_file"))
    matching = rows.filter(F.expr(where))
    if not matching._jdf.queryExecution().analyzed().deterministic():
        raise ValueError("the where clause does not mean the same rows each time")
    hits = matching.groupBy(DAY, "_file").agg(F.count(F.lit(1)).alias("matched")).checkpoint()
    days = [row[DAY] for row in hits.select(DAY).distinct().collect()]
    totals = rows.filter(F.col(DAY).isin(days)).groupBy(DAY, "_file").agg(F.count(F.lit(1)).alias("rows"))
    matched = F.coalesce("matched", F.lit(0))
    action = F.when(matched == 0, "untouched").when(matched == F.col("rows"), "dropped").otherwise("rewritten")
    return (
        totals.join(hits, [DAY, "_file"], "left")
        .select(DAY, F.col("_file").alias("file_path"), "rows", matched.alias("matched"), action.alias("action"))
        .select(DAY, "file_path", "rows", "matched", (F.col("action") == "rewritten").alias("rewritten"), "action")
    )


def delete(
    spark: SparkSession,
    database: str,
    measurement: str,
    where: str,
    dry_run: bool = True,
    confirm: bool = False,
    limits: DeleteLimits = DeleteLimits(),
    as_of: datetime | date | str | None = None,
) -> DeleteResult:
    """Delete the rows for which ``where`` is true; a dry run only reports. ``now()`` in it means ``as_of``.

    Only files with matching rows are read in full, and those with other rows too are written again; all other files stay as
    and where they are, and days left without rows are dropped. The change is made whole or not at all (``replace_files``). A
    delete over ``max_rows_per_delete``, or over the threshold without ``confirm``, is refused before any write. Names of the files
    with matching rows, never their rows, come to the driver.
    """
    started = time.monotonic()
    check(database, measurement, where)
    if not limits.enabled:
        raise ValueError("delete is switched off")
    where = at_moment(where, as_of)
    if not dry_run:
        finish_changes(spark, database, measurement)
    # Kept, since it is read several times and has to outlast the files it was made from.
    report = delete_report(spark, database, measurement, where).checkpoint()
    by_day = (
        report.groupBy(DAY)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("matched").alias("matched"),
            F.count_if(F.col("matched") > 0).alias("affected"),
            F.count_if("rewritten").alias("rewritten"),
        )
        .collect()
    )
    deleted = sum(row.matched for row in by_day)
    if not dry_run:
        if deleted > limits.max_rows_per_delete:
            raise ValueError(f"{deleted} rows match, at most {limits.max_rows_per_delete} may be deleted at once")
        if deleted > limits.confirmation_threshold and not confirm:
            raise ValueError(f"{deleted} rows match; pass confirm=True to delete over {limits.confirmation_threshold}")
        if deleted:
            whole = {row[DAY] for row in by_day if row.matched == row.rows}
            _rewrite(spark, database, measurement, where, report, whole)
    return DeleteResult(
        success=True,
        deleted_count=deleted,
        affected_files=sum(row.affected for row in by_day),
        rewritten_files=sum(row.rewritten for row in by_day),
        execution_time_ms=(time.monotonic() - started) * 1000,
        dry_run=dry_run,
        files_processed=report.filter("matched > 0"),
    )


def _rewrite(spark: SparkSession, database: str, measurement: str, where: str, report: DataFrame, whole: set[date]) -> None:
    """Carry out a report: ``whole`` days go, and of the others the files with matching rows, whose other rows are written again."""
    hit = [row for row in report.filter("matched > 0").collect() if row[DAY] not in whole]
    files: dict[date, list[str]] = {}
    for row in hit:
        files.setdefault(row[DAY], []).append(unquote(row.file_path))
    mixed = [row for row in hit if row.rewritten]
    # Days prune partitions, paths the files in them, so nothing else is opened.
    inside = F.col(DAY).isin(sorted({row[DAY] for row in mixed})) & F.col("_metadata.file_path").isin([row.file_path for row in mixed])
    rows = survivors(read(spark, database, measurement).filter(inside), where)
    replace_files(spark, database, measurement, rows, sum(row.rows - row.matched for row in mixed), files, whole)
