"""Continuous queries: run SQL over a time range of one measurement and keep the result in another."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass, fields
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions.buckets import bucket_end, bucket_start
from chronoloom.functions.timeunits import as_utc, instant, now_micros
from chronoloom.operators import measurements as store
from chronoloom.operators.measurements import DAY, current_database, time_range
from chronoloom.plans.history import QUERY_RUNS, QUERY_STATE, record, runs
from chronoloom.plans.retention import RetentionPolicy, RetentionResult, run_retention

Moment = datetime | date | str


@dataclass(frozen=True)
class ContinuousQuery:
    """Definition of a continuous query; its SQL reads the source by name, with or without the database."""

    id: int
    name: str
    database: str
    source_measurement: str
    destination_measurement: str
    query: str
    interval: str
    retention_days: int | None = None
    delete_source_after_days: int | None = None
    is_active: bool = True
    last_processed_time: datetime | str | None = None


@dataclass(frozen=True)
class QueryRun:
    """What a run did or, as a dry run, would do; the range is the one really covered."""

    query_id: int
    query_name: str
    execution_id: str
    status: str
    start_time: datetime
    end_time: datetime
    records_read: int
    records_written: int
    execution_time_seconds: float
    destination_measurement: str
    dry_run: bool
    executed_query: str


def queries_of(control: DataFrame) -> list[ContinuousQuery]:
    """Definitions from control rows; columns that are no definition field are passed over."""
    known = [f.name for f in fields(ContinuousQuery) if f.name in control.columns]
    return [ContinuousQuery(**row.asDict()) for row in control.select(*known).collect()]


def widths_of(query: ContinuousQuery) -> list[str]:
    """Bucket widths the SQL uses, else the interval."""
    return re.findall(r"(?i)\btime_bucket\(\s*'([^']+)'", query.query) or [query.interval]


def over_range(spark: SparkSession, query: ContinuousQuery, source: DataFrame) -> DataFrame:
    """The query's result with ``source`` in place of the source measurement.

    The range has to be cut before the SQL aggregates, so the source's rows stand in under its own name: qualified
    mentions lose their database, and a temporary view of that name is in place while the text is resolved.
    """
    name = query.source_measurement
    mention = re.compile(
        rf"('(?:[^']|'')*')|(?<![\w.`])`?{re.escape(query.database)}`?\s*\.\s*`?{re.escape(name)}`?(?![\w`])", re.I
    )
    text = mention.sub(lambda m: m.group(1) or store.quoted(name), query.query)
    if not re.search(rf"(?i)(?<![\w.]){re.escape(name)}(?!\w)", text):
        raise ValueError(f"the query does not read {name!r}")
    try:
        source.createTempView(store.quoted(name))
    except AnalysisException as error:
        raise ValueError(f"a temporary view hides the measurement {name!r}") from error
    try:
        with current_database(spark, query.database):
            return spark.sql(text)
    finally:
        spark.catalog.dropTempView(name)


def mark_of(spark: SparkSession, query: ContinuousQuery) -> datetime | None:
    """End of what has been covered without a gap from the source's least time on; None if that is not covered.

    Completed runs of the history count, and the mark given with the definition, which covers all before it. A later run
    beyond a gap does not move the mark, so ``run_pending`` fills the gap and no tier drops rows that were never read.
    """
    ranges = [(datetime.min, as_utc(query.last_processed_time))] if query.last_processed_time else []
    if store.exists(spark, query.database, QUERY_RUNS):
        done = spark.table(store.quoted(query.database, QUERY_RUNS)).filter(
            (F.col("query_id") == query.id) & (F.col("status") == "completed")
        )
        times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("start_time", "end_time")]
        ranges += [(row.start_time, row.end_time) for row in done.select(*times).distinct().collect()]
    if not ranges:
        return None
    least = _least_time(spark, query)
    if least is None:
        return max(end for _, end in ranges)
    reach = least
    for start, end in sorted(ranges):
        if start <= reach:
            reach = max(reach, end)
    return reach if reach > least else None


def covered_range(
    spark: SparkSession, query: ContinuousQuery, start: Moment | None, end: Moment | None, as_of: Moment
) -> tuple[datetime, datetime] | None:
    """Range of a run, on bucket bounds, so that no bucket is worked out from a part of its rows.

    No start means the mark, else the least time of the source. A given end is widened to the end of its bucket; no end
    means the last bucket bound up to ``as_of``.
    """
    widths = widths_of(query)
    if start is None:
        first = mark_of(spark, query) or _least_time(spark, query)
        if first is None:
            return None
    else:
        first = as_utc(start)
    low = _bound(spark, widths, first, bucket_start)
    if end is None:
        high = _bound(spark, [*widths, query.interval], as_utc(as_of), bucket_start)
    else:
        high = _bound(spark, widths, as_utc(end), bucket_end)
    if query.delete_source_after_days is not None:
        # Results over source days that a tier has dropped cannot be worked out again, so they stay as they are.
        days = store.days_of(spark, query.database, query.source_measurement)
        kept = [datetime.combine(day, datetime.min.time()) for day in days[:1]]
        # A late row may have brought a dropped day back, without the rows that it had.
        kept += [dropped for dropped in [_state(spark, query)[1]] if dropped is not None]
        if kept:
            low = max(low, _bound(spark, widths, max(kept), bucket_start))
    return (low, high) if low < high else None


def _bound(spark: SparkSession, widths: list[str], moment: datetime, edge: Callable) -> datetime:
    """The nearest moment on one side that is a bucket bound of every width."""
    while True:
        moved = moment
        for width in widths:
            moved = edge(spark, width, moved)
        if moved == moment:
            return moment
        moment = moved


def _least_time(spark: SparkSession, query: ContinuousQuery) -> datetime | None:
    days = store.days_of(spark, query.database, query.source_measurement)
    if not days:
        return None
    # The least time lies on the first day, so only that day is read.
    rows = store.read(spark, query.database, query.source_measurement).filter(F.col(DAY) == F.lit(days[0]))
    return rows.agg(F.min("time").cast("timestamp_ntz").alias("least")).first().least


def run_query(
    spark: SparkSession,
    query: ContinuousQuery,
    start: Moment | None = None,
    end: Moment | None = None,
    as_of: Moment | None = None,
    dry_run: bool = False,
) -> QueryRun | None:
    """Run a continuous query over ``[start, end)`` and note the run; None if there is nothing to cover.

    The destination's rows in the range are replaced, so a range can be run again. A dry run reads and counts only.
    """
    started = time.monotonic()
    if end is None and as_of is None:
        raise ValueError("name an end or as_of")
    covered = covered_range(spark, query, start, end, as_of if as_of is not None else end)
    if covered is None:
        return None
    low, high = covered
    source = time_range(store.read(spark, query.database, query.source_measurement), low, high).drop(DAY)
    result = over_range(spark, query, source)
    run_id = uuid4().hex

    def report(status: str, read: int, written: int) -> QueryRun:
        return QueryRun(
            query_id=query.id,
            query_name=query.name,
            execution_id=run_id,
            status=status,
            start_time=low,
            end_time=high,
            records_read=read,
            records_written=written,
            execution_time_seconds=time.monotonic() - started,
            destination_measurement=query.destination_measurement,
            dry_run=dry_run,
            executed_query=query.query,
        )

    def note(run: QueryRun, error: str | None = None) -> None:
        record(
            spark,
            query.database,
            QUERY_RUNS,
            query_id=query.id,
            execution_id=run_id,
            status=run.status,
            start_time=low,
            end_time=high,
            records_read=run.records_read,
            records_written=run.records_written,
            execution_duration_seconds=run.execution_time_seconds,
            error_message=error,
        )

    if dry_run:
        return report("completed", source.count(), result.count())
    try:
        read = source.count()
        written = replace_range(spark, query.database, query.destination_measurement, result, low, high)
    except Exception as error:
        note(report("failed", 0, 0), str(error))
        raise
    run = report("completed", read, written)
    note(run)
    return run


def replace_range(
    spark: SparkSession, database: str, measurement: str, rows: DataFrame, low: datetime, high: datetime
) -> int:
    """Make ``rows`` the whole content of ``[low, high)``; gives their number.

    Only the first and last day can hold other rows, and only those two are read back.
    """
    inside = (F.col("time") >= instant(low)) & (F.col("time") < instant(high))
    stray = F.raise_error(F.concat(F.lit("a result row lies outside the range: "), F.col("time").cast("string")))
    new = store.with_day(rows)
    new = new.withColumn(DAY, F.when(inside, F.col(DAY)).otherwise(stray.cast("date")))
    store.prepare(spark, new, database, measurement)
    edges = [low.date(), store.last_day(high)]
    kept = store.read(spark, database, measurement).filter(F.col(DAY).isin(edges) & ~inside)
    days = [d for d in store.days_of(spark, database, measurement) if edges[0] <= d <= edges[1]]
    rows = kept.unionByName(new, allowMissingColumns=True)
    store.replace_days(spark, database, measurement, rows, days, cluster=True)
    return time_range(store.read(spark, database, measurement), low, high).count()


def _state(spark: SparkSession, query: ContinuousQuery) -> tuple[int | None, datetime | None]:
    """Up to which file time late rows were looked for, and before when the source has been dropped."""
    if not store.exists(spark, query.database, QUERY_STATE):
        return None, None
    noted = spark.table(store.quoted(query.database, QUERY_STATE)).filter(F.col("query_id") == query.id)
    return tuple(noted.agg(F.max("checked_until"), F.max("dropped_before").cast("timestamp_ntz")).first())


def _first_start(spark: SparkSession, query: ContinuousQuery) -> int | None:
    """When the first completed run of the history began, in microseconds."""
    if not store.exists(spark, query.database, QUERY_RUNS):
        return None
    done = spark.table(store.quoted(query.database, QUERY_RUNS)).filter(
        (F.col("query_id") == query.id) & (F.col("status") == "completed")
    )
    began = F.unix_micros("execution_time") - F.ceil(F.col("execution_duration_seconds") * 1_000_000)
    return done.agg(F.min(began).alias("began")).first().began


def late_ranges(spark: SparkSession, query: ContinuousQuery) -> list[tuple[datetime, datetime]]:
    """Ranges of source times below the mark with rows in files that came since late rows were last looked for.

    Days prune partitions and file times prune files, so only new files that may hold rows below the mark are opened, for their
    times alone. Files that deletes wrote count as new. Days that a tier has dropped are left out, as their results cannot
    be worked out again. Times of files and of the driver are compared, so their clocks have to agree; files of an append that was
    still running when the rows were looked for may be missed.
    """
    mark = mark_of(spark, query)
    checked, dropped = _state(spark, query)
    since = checked if checked is not None else _first_start(spark, query)
    if mark is None or since is None or not store.exists(spark, query.database, query.source_measurement):
        return []
    rows = time_range(store.read(spark, query.database, query.source_measurement), dropped, mark)
    rows = rows.filter(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since // 1000)))
    edges = [f("time").cast("timestamp_ntz").alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
    out: list[tuple[datetime, datetime]] = []
    for row in rows.groupBy(DAY).agg(*edges).orderBy(DAY).collect():
        if out and out[-1][1].date() >= row[DAY] - timedelta(days=1):
            out[-1] = out[-1][0], row.high + timedelta(microseconds=1)
        else:
            out.append((row.low, row.high + timedelta(microseconds=1)))
    return out


def run_pending(spark: SparkSession, query: ContinuousQuery, as_of: Moment) -> QueryRun | None:
    """One turn of the schedule: cover the buckets that late rows fell into again, then all whole buckets from the mark to ``as_of``.

    However many intervals were missed, they are one job. Inactive queries rest. Gives the last run, None if there was none.
    """
    if not query.is_active:
        return None
    moment, run = now_micros(), None
    for low, high in late_ranges(spark, query):
        run = run_query(spark, query, low, high) or run
    run = run_query(spark, query, as_of=as_of) or run
    # Noted last: a turn that dies looks for the same rows again.
    if run is not None:
        record(spark, query.database, QUERY_STATE, query_id=query.id, checked_until=moment)
    return run


def query_runs(spark: SparkSession, query: ContinuousQuery, limit: int = 50) -> DataFrame:
    """History of a continuous query, newest first."""
    return runs(spark, query.database, QUERY_RUNS, "query_id", query.id, limit)


def apply_tiers(
    spark: SparkSession, query: ContinuousQuery, as_of: Moment, dry_run: bool = True, confirm: bool = False
) -> dict[str, RetentionResult]:
    """Drop what the definition no longer keeps: old results, and old source rows that are covered already."""
    moment = as_utc(as_of)
    out = {}
    if query.retention_days is not None:
        out["destination"] = _tier(
            spark, query, query.destination_measurement, moment, query.retention_days, dry_run, confirm
        )
    mark = mark_of(spark, query)
    if query.delete_source_after_days is not None and mark is not None:
        age = timedelta(days=query.delete_source_after_days)
        # Days with late rows wait for the run that covers them again.
        read_until = min([mark, *[low for low, _ in late_ranges(spark, query)]])
        until = min(moment, read_until + age)
        if not dry_run and confirm:
            # Noted first: rows that come later for these days are not taken for whole days.
            cutoff = datetime.combine((until - age).date(), datetime.min.time())
            record(spark, query.database, QUERY_STATE, query_id=query.id, dropped_before=cutoff)
        out["source"] = _tier(
            spark, query, query.source_measurement, until, query.delete_source_after_days, dry_run, confirm
        )
    return out


def _tier(
    spark: SparkSession,
    query: ContinuousQuery,
    measurement: str,
    as_of: datetime,
    keep_days: int,
    dry_run: bool,
    confirm: bool,
) -> RetentionResult:
    policy = RetentionPolicy(
        id=query.id,
        name=f"{query.name}: {measurement}",
        database=query.database,
        measurement=measurement,
        retention_days=keep_days,
        buffer_days=0,
    )
    return run_retention(spark, policy, as_of, dry_run, confirm)
