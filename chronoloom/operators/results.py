"""SQL over measurements, result envelopes and estimates."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.operators.measurements import current_database
from chronoloom.operators.pruning import pruned_sql
from chronoloom.operators.statistics import estimated_rows
from chronoloom.session import settings

# Levels of an estimate and the row count each begins at.
LEVELS = (("none", 0), ("low", 10_000), ("medium", 100_000), ("high", 1_000_000))


def run_sql(spark: SparkSession, sql: str, database: str | None = None) -> DataFrame:
    """The query's rows; names without a database are looked up in ``database``.

    Bounds on ``time`` prune days, and the newest rows are looked for in the newest days.
    """
    if not sql or not sql.strip():
        raise ValueError("SQL query cannot be empty")
    with current_database(spark, database):
        return pruned_sql(spark, sql)


def epoch_rows(df: DataFrame) -> DataFrame:
    """The same rows with timestamps as epoch microseconds, the form of a result envelope."""
    return df.select(
        *[
            F.unix_micros(F.col(f"`{f.name}`").cast("timestamp")).alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def response(spark: SparkSession, sql: str, database: str | None = None, max_rows: int = 100_000) -> dict[str, Any]:
    """Envelope of a small result: success, columns, data, row_count, execution_time_ms, timestamp, error.

    A failing query gives ``success`` false and its error. A result over ``max_rows`` is refused and not cut short;
    use the DataFrame of ``run_sql`` for it.
    """
    started = time.monotonic()
    out: dict[str, Any] = {"success": True, "columns": [], "data": [], "row_count": 0, "error": None}
    if not sql or not sql.strip():
        raise ValueError("SQL query cannot be empty")
    try:
        rows = epoch_rows(run_sql(spark, sql, database))
        found = rows.limit(max_rows + 1).collect()
        if len(found) > max_rows:
            raise ValueError(f"the result has over {max_rows} rows; read it as a DataFrame")
        out.update(columns=rows.columns, data=[list(row) for row in found], row_count=len(found))
    except PySparkException as error:
        out.update(success=False, error=str(error))
    out["execution_time_ms"] = (time.monotonic() - started) * 1000
    out["timestamp"] = datetime.now(timezone.utc).isoformat()
    return out


def analyze(spark: SparkSession, table: str) -> None:
    """Gather the statistics that let ``estimate`` answer from the plan."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def row_counts(df: DataFrame, levels: Sequence[tuple[str, int]] = LEVELS) -> DataFrame:
    """``estimated_rows, warning_level`` of a query by counting its rows; only needed columns are read."""
    count = df.agg(F.count(F.lit(1)).alias("estimated_rows"))
    level = F.lit(levels[0][0])
    for name, least in levels[1:]:
        level = F.when(F.col("estimated_rows") >= least, F.lit(name)).otherwise(level)
    return count.select("estimated_rows", level.alias("warning_level"))


def estimate(
    spark: SparkSession, sql: str, database: str | None = None, levels: Sequence[tuple[str, int]] = LEVELS
) -> dict[str, Any]:
    """Rows a query would return: from the statistics that ``refresh_statistics`` keeps or the optimizer has, else by a count."""
    if not sql or not sql.strip():
        raise ValueError("SQL query cannot be empty")
    started = time.monotonic()
    out: dict[str, Any] = {"success": True, "estimated_rows": None, "warning_level": "none", "error": None}
    try:
        df = run_sql(spark, sql, database)
        rows = estimated_rows(spark, df)
        if rows is None:
            rows = _planned_rows(spark, sql, database)
        if rows is None:
            rows = row_counts(df, levels).first().estimated_rows
        name, least = [level for level in levels if rows >= level[1]][-1]
        out.update(estimated_rows=rows, warning_level=name)
        out["warning_message"] = f"about {rows} rows, {least} or more" if name != levels[0][0] else None
    except PySparkException as error:
        out.update(success=False, warning_level="error", warning_message=str(error), error=str(error))
    out["execution_time_ms"] = (time.monotonic() - started) * 1000
    return out


def _planned_rows(spark: SparkSession, sql: str, database: str | None) -> int | None:
    with settings(spark, {"spark.sql.cbo.enabled": "true"}), current_database(spark, database):
        plan = spark.sql(f"EXPLAIN COST {sql}").first()[0]
    # The first statistics are those of the topmost node of the optimized plan.
    top = re.search(r"Statistics\(([^)]*)\)", plan)
    found = re.search(r"rowCount=([0-9.E+]+)", top.group(1)) if top else None
    return round(float(found.group(1))) if found else None
