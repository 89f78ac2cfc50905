"""``time_bucket``: floor a time to a width.

It is a SQL function, so Catalyst inlines it: a literal width folds to a constant, and what is left per row is
integer arithmetic inside whole-stage codegen. Buckets of days or less count from a Monday, buckets of months from a
January, as analytical SQL engines do; ``window()`` counts from a Thursday and knows no months.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Bucket origins (Monday 2000-01-03 in epoch seconds; January 2000 as a month number).
ORIGIN_SECONDS = 946_857_600
ORIGIN_MONTH = 24_000

# Short width forms, such as 15m.
_SHORT_UNITS = {
    "us": "microsecond",
    "ms": "millisecond",
    "s": "second",
    "m": "minute",
    "h": "hour",
    "d": "day",
    "w": "week",
}


def _width_sql(width: str) -> tuple[str, str, str]:
    """SQL for the interval of a width, its months and its microseconds; ``width`` is a SQL string expression."""
    text = f"lower(trim({width}))"
    units = ", ".join(f"'{short}', '{unit}'" for short, unit in _SHORT_UNITS.items())
    number, unit = (f"regexp_extract({text}, '^([0-9]+) ?([a-z]+)$', {group})" for group in (1, 2))
    spelled = f"concat({number}, ' ', try_element_at(map({units}), {unit}))"
    interval = f"CAST(coalesce({spelled}, {text}) AS INTERVAL)"
    months = f"(extract(YEAR FROM {interval}) * 12 + extract(MONTH FROM {interval}))"
    seconds = " + ".join(
        f"CAST(extract({part} FROM {interval}) AS BIGINT) * {length}"
        for part, length in (("DAY", 86_400), ("HOUR", 3_600), ("MINUTE", 60))
    )
    micros = f"(({seconds}) * 1000000 + CAST(extract(SECOND FROM {interval}) * 1000000 AS BIGINT))"
    return interval, months, micros


# Marks a session that knows the functions.
_REGISTERED = "chronoloom.time_bucket.registered"


def register(spark: SparkSession) -> None:
    """Make ``time_bucket(width, time)`` known to the session's SQL.

    The width is taken apart once, in the arguments of a second function, instead of wherever it is used; that keeps
    the plan small until the constants fold.
    """
    if spark.conf.get(_REGISTERED, "") == "true":
        return
    _, months, micros = _width_sql("width")
    since = f"(unix_micros(t) - {ORIGIN_SECONDS * 1_000_000})"
    month = "(year(t) * 12 + month(t) - 1)"
    first = f"({month} - pmod({month} - {ORIGIN_MONTH}, greatest(months, 1)))"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION time_floor(width STRING, months INT, micros BIGINT, t TIMESTAMP)
        RETURNS TIMESTAMP RETURN CASE
          WHEN months = 0 AND micros > 0 THEN timestamp_micros(unix_micros(t) - pmod({since}, greatest(micros, 1)))
          WHEN months > 0 AND micros = 0
            THEN make_timestamp(CAST(floor({first} / 12) AS INT), pmod({first}, 12) + 1, 1, 0, 0, 0)
          ELSE raise_error(concat('a bucket width is positive, in months or in shorter units: ', width))
        END"""
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION time_bucket(width STRING, t TIMESTAMP) RETURNS TIMESTAMP "
        f"RETURN time_floor(width, CAST({months} AS INT), {micros}, t)"
    )
    spark.conf.set(_REGISTERED, "true")


def time_bucket(width: str, time: Column | str) -> Column:
    """Column form of the SQL function; the session must be configured."""
    column = F.col(time) if isinstance(time, str) else time
    return F.call_function("time_bucket", F.lit(width), column.cast("timestamp"))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def width_micros(spark: SparkSession, width: str) -> int:
    """Length of a width; months have none and are refused."""
    interval, months, micros = _width_sql(_literal(width))
    row = spark.sql(f"SELECT {interval} IS NULL AS bad, {months} AS months, {micros} AS micros").first()
    if row.bad or row.months or row.micros <= 0:
        raise ValueError(f"not a positive width in days or shorter units: {width!r}")
    return row.micros


def bucket_start(spark: SparkSession, width: str, moment: datetime) -> datetime:
    """Start of the bucket that holds ``moment``."""
    return _bucket_edges(spark, width, moment)[0]


def bucket_end(spark: SparkSession, width: str, moment: datetime) -> datetime:
    """``moment`` if it is a bucket start, else the start of the next bucket."""
    start, following = _bucket_edges(spark, width, moment)
    return start if start == moment else following


def _bucket_edges(spark: SparkSession, width: str, moment: datetime) -> tuple[datetime, datetime]:
    # One row without a table: Spark folds it on the driver and starts no job.
    literal = _literal(width)
    interval, _, _ = _width_sql(literal)
    time = f"TIMESTAMP_NTZ'{moment.isoformat(sep=' ')}'"
    row = spark.sql(
        f"SELECT CAST(s AS TIMESTAMP_NTZ) AS s, CAST(s + {interval} AS TIMESTAMP_NTZ) AS e "
        f"FROM (SELECT time_bucket({literal}, CAST({time} AS TIMESTAMP)) AS s)"
    ).first()
    return row.s, row.e
