from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronoloom.operators import measurements as store
from chronoloom.operators.results import run_sql
from chronoloom.plans import compaction, continuous
from chronoloom.plans.compaction import compact, compaction_plan
from chronoloom.plans.continuous import (
    ContinuousQuery,
    apply_tiers,
    covered_range,
    late_ranges,
    mark_of,
    over_range,
    query_runs,
    run_pending,
    run_query,
)
from chronoloom.plans.deletion import DeleteLimits, at_moment, delete, delete_report
from chronoloom.plans.retention import RetentionPolicy, policies_of, retention_plan, retention_runs, run_retention
from chronoloom.sources.frames import table_rows

SQL = "SELECT time_bucket('1 hour', time) AS time, event_type, avg(value) AS value FROM {}.events GROUP BY 1, 2"


@pytest.fixture()
def loaded(spark, events, database):
    rows = table_rows(events.select("ts", "event_type", "value", "user_id"), "ts")
    store.append(rows, database, "events", tags=["event_type"])
    return database


def same(a, b):
    a = a.select(*sorted(a.columns))
    b = b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def cq(database, **more):
    given = dict(
        id=1,
        name="hourly",
        database=database,
        source_measurement="events",
        destination_measurement="events_1h",
        query=SQL.format(database),
        interval="1h",
    )
    return ContinuousQuery(**{**given, **more})


def rounded(df):
    return df.drop("day").withColumn("value", F.round("value", 9))


# delete


@pytest.mark.parametrize("args", [("", "m", "x"), ("d", "", "x"), ("d", "m", ""), ("d", "m", "   ")])
def test_delete_refusals(spark, args):
    with pytest.raises(ValueError, match="required"):
        delete(spark, *args)


def test_dry_run_writes_nothing(spark, loaded):
    before = store.read(spark, loaded, "events").inputFiles()
    hit = store.read(spark, loaded, "events").filter("event_type = 'error'").count()
    got = delete(spark, loaded, "events", "event_type = 'error'")
    assert got.dry_run and got.deleted_count == hit
    assert got.affected_files == got.files_processed.count() == got.rewritten_files
    assert sorted(store.read(spark, loaded, "events").inputFiles()) == sorted(before)


def test_delete_keeps_null_rows_and_drops_empty_days(spark, loaded):
    odd = spark.sql("SELECT TIMESTAMP'2024-01-02 01:00:00' AS time, 'odd' AS event_type")
    store.append(odd, loaded, "events")
    where = "value < 10 OR time < '2024-01-02'"
    table = store.read(spark, loaded, "events")
    want = spark.createDataFrame(table.filter(f"NOT coalesce({where}, false)").collect(), table.schema)
    matched = table.filter(where).count()
    report = delete_report(spark, loaded, "events", where)
    assert report.agg(F.sum("matched")).first()[0] == matched
    got = delete(spark, loaded, "events", where, dry_run=False)
    assert (got.deleted_count, got.dry_run) == (matched, False)
    # The first day's one file goes whole, the odd row's file has no match and stays.
    assert got.affected_files == got.rewritten_files + 1
    assert got.files_processed.agg(F.sum("matched")).first()[0] == matched
    after = store.read(spark, loaded, "events")
    assert same(after, want)
    assert after.filter("event_type = 'odd'").count() == 1
    assert date(2024, 1, 1) not in store.days_of(spark, loaded, "events")
    again = delete(spark, loaded, "events", where, dry_run=False)
    assert again.deleted_count == 0 and same(store.read(spark, loaded, "events"), want)


def files_of(spark, database):
    rows = store.read(spark, database, "events").select("day", F.col("_metadata.file_path").alias("path")).distinct()
    return {(row.day, row.path) for row in rows.collect()}


def three_files_a_day(spark, database):
    table = spark.table(f"{database}.events")
    for kind in ("a", "b"):
        more = table.limit(0).drop("day").unionByName(
            spark.range(48).selectExpr(
                "TIMESTAMP'2024-01-02 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS time",
                f"'{kind}' AS event_type", "CAST(id AS DOUBLE) AS value", "id AS user_id",
            )
        )
        store.append(more.coalesce(1), database, "events")


def test_delete_leaves_other_files_alone(spark, loaded):
    three_files_a_day(spark, loaded)
    before = files_of(spark, loaded)
    where = "event_type = 'a' AND value < 30 OR event_type = 'b' AND day = '2024-01-03'"
    report = {(r.action, r.rewritten) for r in delete_report(spark, loaded, "events", where).collect()}
    assert report == {("untouched", False), ("dropped", False), ("rewritten", True)}
    want = store.read(spark, loaded, "events").filter(f"NOT ({where})")
    want = spark.createDataFrame(want.collect(), want.schema)
    got = delete(spark, loaded, "events", where, dry_run=False)
    # Day 2 loses all of a's file, day 3 a part of it and all of b's.
    assert (got.deleted_count, got.affected_files, got.rewritten_files) == (30 + 24, 3, 1)
    after = files_of(spark, loaded)
    assert len(before - after) == 3 and len(after - before) == 1
    assert same(store.read(spark, loaded, "events"), want)


def test_a_lost_delete_is_finished_by_the_next_writer(spark, loaded, monkeypatch):
    three_files_a_day(spark, loaded)
    where = "event_type = 'a' AND value < 30 OR day = '2024-01-01'"
    want = store.read(spark, loaded, "events").filter(f"NOT ({where})")
    want = spark.createDataFrame(want.collect(), want.schema)
    before, real, writes = files_of(spark, loaded), store._carry_out, store.Files.write

    def lost(*_):
        raise KeyboardInterrupt

    # Before the list is there, nothing has changed, and what was staged goes.
    monkeypatch.setattr(store.Files, "write", lost)
    with pytest.raises(KeyboardInterrupt):
        delete(spark, loaded, "events", where, dry_run=False)
    monkeypatch.setattr(store.Files, "write", writes)
    assert files_of(spark, loaded) == before
    root = store.location(spark, loaded, "events")
    assert store.Files(spark).folders(root, hidden=store.CHANGE)
    assert store.finish_changes(spark, loaded, "events") == 0
    assert not store.Files(spark).folders(root, hidden=store.CHANGE) and files_of(spark, loaded) == before

    # After it, the next append finishes the delete, even one that got half way.
    monkeypatch.setattr(store, "_carry_out", lost)
    with pytest.raises(KeyboardInterrupt):
        delete(spark, loaded, "events", where, dry_run=False)
    monkeypatch.setattr(store, "_carry_out", real)
    monkeypatch.setattr(store.Files, "move", lost)
    with pytest.raises(KeyboardInterrupt):
        store.finish_changes(spark, loaded, "events")
    monkeypatch.undo()
    store.append(want.limit(0).drop("day"), loaded, "events")
    assert same(store.read(spark, loaded, "events"), want)
    assert store.finish_changes(spark, loaded, "events") == 0


def test_rows_of_a_lost_delete_stay_out_of_a_dropped_day(spark, loaded, monkeypatch):
    three_files_a_day(spark, loaded)
    real = store._carry_out
    monkeypatch.setattr(store, "_carry_out", lambda *_: None)
    delete(spark, loaded, "events", "event_type = 'a' AND value < 30", dry_run=False)
    monkeypatch.setattr(store, "_carry_out", real)
    day = date(2024, 1, 3)
    store.drop_days(spark, loaded, "events", [day])
    again = spark.sql("SELECT TIMESTAMP'2024-01-03 01:00:00' AS time, 'new' AS event_type")
    store.append(again, loaded, "events")
    assert store.read(spark, loaded, "events").filter(F.col("day") == F.lit(day)).count() == 1


@pytest.mark.parametrize("where", ["rand() < 0.5", "uuid() > 'a'", "value > 1 AND random() < value"])
def test_delete_refuses_predicates_that_change(spark, loaded, where):
    with pytest.raises(ValueError, match="same rows"):
        delete(spark, loaded, "events", where, dry_run=False)


def test_delete_all(spark, loaded):
    limits = DeleteLimits(confirmation_threshold=10)
    with pytest.raises(ValueError, match="confirm=True"):
        delete(spark, loaded, "events", "1=1", dry_run=False, limits=limits)
    with pytest.raises(ValueError, match="at most 10"):
        delete(spark, loaded, "events", "1=1", False, True, DeleteLimits(max_rows_per_delete=10))
    with pytest.raises(ValueError, match="off"):
        delete(spark, loaded, "events", "1=1", limits=DeleteLimits(enabled=False))
    got = delete(spark, loaded, "events", "1=1", dry_run=False, confirm=True, limits=limits)
    assert got.rewritten_files == 0 and got.affected_files > 0
    assert store.read(spark, loaded, "events").count() == 0


def test_the_clock_stands_still_during_a_delete(spark, loaded):
    assert at_moment("a = 'now()' AND t < NOW() - INTERVAL '1 day'", "2024-01-10") == (
        "a = 'now()' AND t < TIMESTAMP'2024-01-10 00:00:00' - INTERVAL '1 day'"
    )
    assert at_moment("d < current_date AND t < current_timestamp()", "2024-01-10T05:00:00Z") == (
        "d < to_date(TIMESTAMP'2024-01-10 05:00:00') AND t < TIMESTAMP'2024-01-10 05:00:00'"
    )
    assert "now" not in at_moment("t < now()")
    assert at_moment("t < localtimestamp()", "2024-01-10") == "t < TIMESTAMP_NTZ'2024-01-10 00:00:00'"
    want = store.read(spark, loaded, "events").filter("time < '2024-01-09'").count()
    got = delete(spark, loaded, "events", "time < now() - INTERVAL '1 day'", dry_run=False, as_of="2024-01-10")
    assert got.deleted_count == want and store.days_of(spark, loaded, "events")[0] == date(2024, 1, 9)


# retention


def test_retention(spark, loaded):
    as_of = "2024-01-31T10:00:00Z"
    policy = RetentionPolicy(id=3, name="short", database=loaded, measurement="events", retention_days=10, buffer_days=2)
    assert policy.cutoff(as_of) == datetime(2024, 1, 19, 10)
    table = store.read(spark, loaded, "events")
    old, total = table.filter("day < '2024-01-19'").count(), table.count()
    dry = run_retention(spark, policy, as_of)
    assert (dry.deleted_count, dry.files_deleted, dry.dry_run) == (old, 18, True)
    assert dry.affected_measurements == ["events"]
    assert store.read(spark, loaded, "events").count() == total
    with pytest.raises(ValueError, match="confirm"):
        run_retention(spark, policy, as_of, dry_run=False)
    assert retention_runs(spark, policy).count() == 0
    real = run_retention(spark, policy, as_of, dry_run=False, confirm=True)
    assert real.deleted_count == old and store.read(spark, loaded, "events").count() == total - old
    assert min(store.days_of(spark, loaded, "events")) == date(2024, 1, 19)
    run_retention(spark, policy, as_of, dry_run=False, confirm=True)
    history = retention_runs(spark, policy).collect()
    assert [r.deleted_count for r in history] == [0, old]
    assert history[0].status == "completed" and retention_runs(spark, policy, limit=1).count() == 1


def test_policy_scope(spark, loaded):
    more = spark.sql("SELECT TIMESTAMP'2023-01-01 00:00:00' AS time, 1 AS x")
    store.append(more, loaded, "other")
    control = spark.createDataFrame(
        [(1, "all", loaded, None, 1, 0, True), (2, "off", loaded, None, 1, 0, False), (3, "one", loaded, "other", 1, 7, True)],
        "id bigint, name string, database string, measurement string, retention_days int, buffer_days int, is_active boolean",
    )
    assert [p.name for p in policies_of(control)] == ["all", "off", "one"]
    plan = retention_plan(spark, control, "2024-01-31")
    got = {(r.policy_id, r.measurement) for r in plan.select("policy_id", "measurement").distinct().collect()}
    assert got == {(1, "events"), (1, "other"), (3, "other")}
    run_retention(spark, policies_of(control)[0], "2024-01-31", dry_run=False, confirm=True)
    assert store.read(spark, loaded, "other").count() == 0
    assert store.days_of(spark, loaded, "events") == [date(2024, 1, 30)]


# continuous queries


def test_run_equals_the_query(spark, loaded):
    query = cq(loaded)
    dry = run_query(spark, query, "2024-01-01", "2024-01-31", dry_run=True)
    assert not store.exists(spark, loaded, "events_1h") and query_runs(spark, query).count() == 0
    run = run_query(spark, query, "2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z")
    want = run_sql(spark, SQL.format(loaded))
    assert (dry.records_read, dry.records_written) == (run.records_read, run.records_written)
    assert run.records_read == store.read(spark, loaded, "events").count()
    assert run.records_written == want.count()
    assert same(rounded(store.read(spark, loaded, "events_1h")), rounded(want))


def test_halves_and_repeats(spark, loaded):
    query = cq(loaded)
    for start, end in (
        ("2024-01-01", "2024-01-10T07:30:00"),
        ("2024-01-10T08:00:00", "2024-01-31"),
        ("2024-01-09T03:10:00", "2024-01-11T05:00:00"),
    ):
        run_query(spark, query, start, end)
    assert same(rounded(store.read(spark, loaded, "events_1h")), rounded(run_sql(spark, SQL.format(loaded))))
    history = query_runs(spark, query).collect()
    assert [r.status for r in history] == ["completed"] * 3
    assert history[0].start_time == datetime(2024, 1, 9, 3) and history[2].end_time == datetime(2024, 1, 10, 8)


def test_repeat_after_source_rows_went(spark, loaded):
    query = cq(loaded)
    run_query(spark, query, "2024-01-01", "2024-01-31")
    delete(spark, loaded, "events", "time >= '2024-01-05' AND time < '2024-01-06T12:00:00'", dry_run=False)
    run_query(spark, query, "2024-01-05", "2024-01-07")
    assert same(rounded(store.read(spark, loaded, "events_1h")), rounded(run_sql(spark, SQL.format(loaded))))


def test_pending_runs_follow_the_mark(spark, loaded):
    query = cq(loaded)
    first = run_pending(spark, query, "2024-01-08T09:40:00")
    least = store.read(spark, loaded, "events").agg(F.min("time").cast("timestamp_ntz")).first()[0]
    assert first.start_time == least.replace(minute=0, second=0, microsecond=0)
    assert first.end_time == mark_of(spark, query) == datetime(2024, 1, 8, 9)
    assert run_pending(spark, query, "2024-01-08T09:59:00") is None
    second = run_pending(spark, query, "2024-01-31")
    assert (second.start_time, second.end_time) == (first.end_time, datetime(2024, 1, 31))
    assert same(rounded(store.read(spark, loaded, "events_1h")), rounded(run_sql(spark, SQL.format(loaded))))
    assert run_pending(spark, cq(loaded, id=2, is_active=False), "2024-01-31") is None


def test_ranges_follow_the_buckets_of_the_sql(spark, loaded):
    weekly = cq(loaded, query=SQL.format(loaded).replace("1 hour", "7 days"))
    got = covered_range(spark, weekly, "2024-01-10", "2024-01-11", "2024-01-31")
    assert got == (datetime(2024, 1, 8), datetime(2024, 1, 15))
    monthly = cq(loaded, query=SQL.format(loaded).replace("1 hour", "1 month"))
    assert covered_range(spark, monthly, "2024-01-10", None, "2024-03-31") == (datetime(2024, 1, 1), datetime(2024, 3, 1))


def test_source_names(spark, loaded):
    source = store.read(spark, loaded, "events").filter("day = '2024-01-03'").drop("day")
    n = source.count()
    for sql in (
        "SELECT count(*) AS n FROM events",
        f"SELECT count(e.value) AS n FROM `{loaded}`.events AS e",
        f"SELECT count({loaded}.events.value) AS n, '{loaded}.events' AS s FROM {loaded.upper()} . EVENTS",
    ):
        assert over_range(spark, cq(loaded, query=sql), source).first().n == n
    kept = over_range(spark, cq(loaded, query=f"SELECT '{loaded}.events' AS s FROM events"), source).first().s
    assert kept == f"{loaded}.events"
    with pytest.raises(ValueError, match="does not read"):
        over_range(spark, cq(loaded, query="SELECT 1"), source)
    spark.range(1).createOrReplaceTempView("events")
    try:
        with pytest.raises(ValueError, match="temporary view hides"):
            over_range(spark, cq(loaded), source)
        assert spark.table("events").count() == 1
    finally:
        spark.catalog.dropTempView("events")


def test_failed_runs_are_noted(spark, loaded):
    query = cq(loaded, query="SELECT time - INTERVAL 1 DAY AS time, value FROM events")
    with pytest.raises(Exception, match="outside the range"):
        run_query(spark, query, "2024-01-05", "2024-01-06")
    row = query_runs(spark, query).first()
    assert row.status == "failed" and "outside the range" in row.error_message
    assert mark_of(spark, query) is None
    with pytest.raises(ValueError, match="as_of"):
        run_query(spark, query)


def test_tiers(spark, loaded):
    query = cq(loaded, retention_days=20, delete_source_after_days=3)
    run_query(spark, query, "2024-01-01", "2024-01-25")
    dry = apply_tiers(spark, query, "2024-01-31")
    assert store.days_of(spark, loaded, "events")[0] == date(2024, 1, 1)
    got = apply_tiers(spark, query, "2024-01-31", dry_run=False, confirm=True)
    assert got["source"].deleted_count == dry["source"].deleted_count > 0
    assert store.days_of(spark, loaded, "events")[0] == date(2024, 1, 25)
    assert store.days_of(spark, loaded, "events_1h")[0] == date(2024, 1, 11)
    assert timedelta(0) < timedelta(milliseconds=got["source"].execution_time_ms)


def test_gap_is_filled_and_kept(spark, database, events):
    """A run beyond a gap moves no mark: tiers drop nothing, and the next turn covers all from the start."""
    store.append(table_rows(events.select("ts", "event_type", "value"), "ts"), database, "ticks", tags=["event_type"])
    sql = f"SELECT time_bucket('2 hours', time) AS time, time_bucket('3 hours', max(time)) AS top FROM {database}.ticks GROUP BY 1"
    query = continuous.ContinuousQuery(
        id=5, name="two widths", database=database, source_measurement="ticks", destination_measurement="two",
        query=sql, interval="1h", delete_source_after_days=3,
    )
    continuous.run_query(spark, query, "2024-01-20T01:00:00", "2024-01-25")
    assert continuous.mark_of(spark, query) is None
    days = store.days_of(spark, database, "ticks")
    continuous.apply_tiers(spark, query, "2024-01-31", dry_run=False, confirm=True)
    assert store.days_of(spark, database, "ticks") == days
    run = continuous.run_pending(spark, query, "2024-01-28")
    assert run.start_time.date() == days[0] and run.end_time.hour % 6 == 0
    before = store.read(spark, database, "two").count()
    continuous.apply_tiers(spark, query, "2024-01-28", dry_run=False, confirm=True)
    left = store.days_of(spark, database, "ticks")
    assert days[0] < left[0]
    continuous.run_query(spark, query, "2024-01-03", "2024-01-28")
    assert store.read(spark, database, "two").count() == before


def late(spark, database, *times):
    table = spark.table(f"{database}.events").drop("day")
    rows = ", ".join(f"(TIMESTAMP'{t}', 'late', 1000.0D)" for t in times)
    more = spark.sql(f"SELECT * FROM VALUES {rows} AS t(time, event_type, value)")
    store.append(table.limit(0).unionByName(more, allowMissingColumns=True), database, "events")


def test_late_rows_are_covered_again(spark, loaded):
    query = cq(loaded)
    first = run_pending(spark, query, "2024-01-20T00:00:00")
    assert first.end_time == datetime(2024, 1, 20) and late_ranges(spark, query) == []
    assert run_pending(spark, query, "2024-01-20T00:30:00") is None
    # Two near days, one alone, and rows beyond the mark, which are not late.
    late(spark, loaded, "2024-01-05 03:10:00", "2024-01-06 04:00:00", "2024-01-11 10:20:00", "2024-01-25 00:00:00")
    assert late_ranges(spark, query) == [
        (datetime(2024, 1, 5, 3, 10), datetime(2024, 1, 6, 4, 0, 0, 1)),
        (datetime(2024, 1, 11, 10, 20), datetime(2024, 1, 11, 10, 20, 0, 1)),
    ]
    again = run_pending(spark, query, "2024-01-20T00:30:00")
    assert (again.start_time, again.end_time) == (datetime(2024, 1, 11, 10), datetime(2024, 1, 11, 11))
    want = run_sql(spark, SQL.format(loaded)).filter("time < '2024-01-20'")
    assert same(rounded(store.read(spark, loaded, "events_1h")), rounded(want))
    assert late_ranges(spark, query) == [] and run_pending(spark, query, "2024-01-20T00:30:00") is None
    third = run_pending(spark, query, "2024-01-21")
    assert (third.start_time, third.end_time) == (datetime(2024, 1, 20), datetime(2024, 1, 21))


def test_tiers_wait_for_late_rows(spark, loaded):
    query = cq(loaded, delete_source_after_days=3)
    run_pending(spark, query, "2024-01-20")
    late(spark, loaded, "2024-01-10 03:10:00")
    apply_tiers(spark, query, "2024-01-20", dry_run=False, confirm=True)
    assert store.days_of(spark, loaded, "events")[0] == date(2024, 1, 10)
    run_pending(spark, query, "2024-01-20")
    results = store.read(spark, loaded, "events_1h")
    assert results.filter("event_type = 'late'").count() == 1
    apply_tiers(spark, query, "2024-01-20", dry_run=False, confirm=True)
    assert store.days_of(spark, loaded, "events")[0] == date(2024, 1, 17)
    # A row for a dropped day cannot change results that its other rows are in.
    before = store.read(spark, loaded, "events_1h").count()
    late(spark, loaded, "2024-01-05 03:10:00")
    assert late_ranges(spark, query) == []
    run_pending(spark, query, "2024-01-21")
    assert store.read(spark, loaded, "events_1h").filter("time < '2024-01-20'").count() == before


def test_retention_plan_is_one_scan_however_many_policies(spark, database):
    for name in ("cpu", "mem"):
        for start in (1, 5):
            rows = spark.sql(f"SELECT timestamp'2024-01-0{start} 12:00:00' + make_interval(0, 0, 0, id % 3) AS time, id FROM range(30)")
            store.append(rows, database, name)
    spark.sql(f"CREATE TABLE {database}._notes (x int) USING parquet")

    def policy(number, measurement=None, days=3):
        return RetentionPolicy(number, f"p{number}", database, days, measurement, buffer_days=0)

    few = [policy(1, "cpu"), policy(2, days=1)]
    got = retention_plan(spark, few, "2024-01-06")
    rows = sorted((r.policy_id, r.measurement, r.day.day, r.rows, r.files > 0) for r in got.collect())
    want = [(1, "cpu", d, 10, True) for d in (1, 2)] + [(2, m, d, 10, True) for m in ("cpu", "mem") for d in (1, 2, 3)]
    assert rows == want

    def nodes(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("\n")

    many = retention_plan(spark, [policy(n, days=n % 5) for n in range(60)], "2024-01-06")
    assert nodes(many) == nodes(got)
    assert retention_plan(spark, [policy(1, days=900)], "2024-01-06").isEmpty()
    # Days that were replaced lie in other folders.
    store.replace_days(spark, database, "cpu", store.read(spark, database, "cpu").filter("id < 15"), [date(2024, 1, 1), date(2024, 1, 2)])
    assert sorted((r.day.day, r.rows) for r in retention_plan(spark, few[:1], "2024-01-06").collect()) == [(1, 5), (2, 5)]


# compaction


def fill(spark, database, parts, day="2024-01-01"):
    for part in range(parts):
        rows = spark.sql(f"SELECT timestamp'{day} 00:00:00' + make_dt_interval(0, 0, id, {part}) AS time, 'h' || id % 2 AS host, id + {part} AS v FROM range(20)")
        store.append(rows.coalesce(1), database, "cpu", tags=["host"])


def test_compaction_bounds_files_and_keeps_rows(spark, database):
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        fill(spark, database, 4, day)
    before = store.read(spark, database, "cpu").collect()
    begun = store.read(spark, database, "cpu")
    begun.count()
    assert compact(spark, database, "cpu", "2024-01-03T10:00:00", dry_run=True).files_after == 2
    done = compact(spark, database, "cpu", "2024-01-03T10:00:00")
    assert [d.day for d in done.days] == [1, 2] and (done.rows, done.files_before, done.files_after) == (160, 8, 2)
    files = {r["day"].day: r["files"] for r in store.rows_and_files(store.read(spark, database, "cpu")).collect()}
    assert files == {1: 1, 2: 1, 3: 4}
    after = store.read(spark, database, "cpu").collect()
    assert sorted(map(repr, after)) == sorted(map(repr, before))
    # A query that had begun still finds its files, until they are swept.
    assert sorted(map(repr, begun.collect())) == sorted(map(repr, before))
    again = compact(spark, database, "cpu", "2024-01-03T10:00:00")
    assert again.days == [] and again.swept == 0
    assert compact(spark, database, "cpu", "2024-01-03", grace=timedelta(0)).swept == 2
    assert store.read(spark, database, "cpu").count() == 240
    # Late rows go to the new folder, and the day is compacted again.
    fill(spark, database, 1)
    assert compact(spark, database, "cpu", "2024-01-03", grace=timedelta(0)).rows == 100


def test_compaction_gives_a_heavy_day_several_files(spark, database):
    fill(spark, database, 6)
    bytes_of = compaction_plan(spark, database, "cpu", "2024-02-01").first()["bytes"]
    done = compact(spark, database, "cpu", "2024-02-01", file_bytes=bytes_of // 3 + 1)
    # Two parts of a day may fall to one task, which then writes one file.
    assert (done.files_before, done.rows) == (6, 120) and 1 < done.files_after <= 3
    assert store.read(spark, database, "cpu").count() == 120


def test_dropped_day_does_not_find_its_old_files_again(spark, database):
    fill(spark, database, 3)
    compact(spark, database, "cpu", "2024-02-01")
    store.drop_days(spark, database, "cpu", store.days_of(spark, database, "cpu"))
    fill(spark, database, 1)
    assert store.read(spark, database, "cpu").count() == 20
    assert store.sweep(spark, database, "cpu") == 0
    assert store.read(spark, database, "cpu").count() == 20


def test_compaction_that_died_is_swept(spark, database, monkeypatch):
    fill(spark, database, 3)
    with monkeypatch.context() as patch:
        patch.setattr(compaction, "locations", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            compact(spark, database, "cpu", "2024-02-01")
    assert store.read(spark, database, "cpu").count() == 60
    done = compact(spark, database, "cpu", "2024-02-01", grace=timedelta(0))
    assert (done.swept, done.files_after) == (1, 1) and store.read(spark, database, "cpu").count() == 60
