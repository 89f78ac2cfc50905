"""One object for the whole surface: writes, queries and upkeep in a database.

Every write takes DataFrames, which is the way to load data at scale; small Python values are taken as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import explode, lit

from chronoloom.functions.timeunits import now_micros, to_micros
from chronoloom.operators import measurements, results
from chronoloom.operators.merge import sparse_merge
from chronoloom.plans import continuous, deletion, retention
from chronoloom.plans.loading import append_each, append_lines
from chronoloom.session import configure
from chronoloom.sources.batches import batch_rows
from chronoloom.sources.columnar import columnar_rows
from chronoloom.sources.frames import as_spark, table_rows
from chronoloom.sources.records import record_rows, tags_in


class Workspace:
    """A configured session and the database used where none is named."""

    def __init__(self, spark: SparkSession, database: str = "default") -> None:
        self.spark = configure(spark)
        self.database = database

    # Writes

    def write_columnar(
        self,
        measurement: str,
        columns: Mapping[str, Sequence[Any]],
        database: str | None = None,
        time_unit: str = "us",
    ) -> None:
        """Append one batch of columns held by the caller; without ``time`` row i gets now + i."""
        if not measurement:
            raise ValueError("measurement name cannot be empty")
        if not columns:
            raise ValueError("columns cannot be empty")
        lengths = {name: len(values) for name, values in columns.items()}
        if len(set(lengths.values())) > 1:
            raise ValueError(f"all columns must have the same length, got {lengths}")
        to_micros(lit(0), time_unit)
        if "time" not in columns:
            now = now_micros()
            columns = {"time": range(now, now + next(iter(lengths.values()))), **columns}
            time_unit = "us"
        rows = table_rows(_columns_to_spark(self.spark, columns), "time", time_unit)
        measurements.append(rows, database or self.database, measurement)

    def write_batches(self, batches: DataFrame, database: str | None = None, time_unit: str = "us") -> list[str]:
        """Append columnar batches, ``m, columns``."""
        return append_each(columnar_rows(batches, time_unit), database or self.database)

    def write_mixed(self, payloads: DataFrame, database: str | None = None, **keys: Sequence[str]) -> list[str]:
        """Append mixed batches, ``batch``."""
        items = payloads.select(explode("batch").alias("item"))
        tags = tags_in(items, keys.get("tag_names"), "item.tags")
        return append_each(batch_rows(payloads, **keys), database or self.database, tags)

    def write_records(
        self, records: DataFrame | Sequence[Mapping[str, Any]], database: str | None = None, **keys: Sequence[str]
    ) -> list[str]:
        """Append records ``{measurement, timestamp?, fields, tags?}``."""
        if isinstance(records, DataFrame):
            tags = tags_in(records, keys.get("tag_names"))
            return append_each(record_rows(records, **keys), database or self.database, tags)
        if not records:
            raise ValueError("records cannot be empty")
        by_name: dict[str, list[dict[str, Any]]] = {}
        for record in records:
            if not record.get("measurement"):
                raise ValueError("record must have 'measurement'")
            if not record.get("fields"):
                raise ValueError("record must have 'fields'")
            row = {**record["fields"], **(record.get("tags") or {})}
            if "time" in row:
                raise ValueError("a tag or field may not be called 'time'")
            stamp = record.get("timestamp")
            row["time"] = now_micros() if stamp is None else stamp
            by_name.setdefault(record["measurement"], []).append(row)
        for name, rows in by_name.items():
            columns = dict.fromkeys(key for row in rows for key in row)
            self.write_columnar(name, {key: [row.get(key) for row in rows] for key in columns}, database)
        return sorted(by_name)

    def write_dataframe(
        self,
        df: Any,
        measurement: str,
        database: str | None = None,
        time_column: str = "time",
        tag_columns: Sequence[str] = (),
        time_unit: str = "us",
        cluster: bool = False,
    ) -> None:
        """Append a Spark, pandas or Arrow table."""
        rows = table_rows(as_spark(self.spark, df), time_column, time_unit)
        measurements.append(rows, database or self.database, measurement, tag_columns, cluster)

    def write_line_protocol(
        self, lines: str | Sequence[str] | DataFrame, database: str | None = None, reject_path: str | None = None
    ) -> list[str]:
        """Append the points of line-protocol text."""
        if not isinstance(lines, DataFrame):
            listed = lines.split("\n") if isinstance(lines, str) else list(lines)
            lines = self.spark.createDataFrame([(line,) for line in listed], "value string")
        return append_lines(lines, database or self.database, reject_path)

    def merge(self, batches: Sequence[DataFrame], measurement: str, database: str | None = None) -> None:
        """Append batches with different columns as one."""
        measurements.append(sparse_merge(batches), database or self.database, measurement)

    # Queries

    def query(self, sql: str, database: str | None = None) -> DataFrame:
        return results.run_sql(self.spark, sql, database or self.database)

    def response(self, sql: str, database: str | None = None, max_rows: int = 100_000) -> dict[str, Any]:
        return results.response(self.spark, sql, database or self.database, max_rows)

    def estimate(self, sql: str, database: str | None = None) -> dict[str, Any]:
        return results.estimate(self.spark, sql, database or self.database)

    def read(self, measurement: str, start: Any = None, end: Any = None, database: str | None = None) -> DataFrame:
        """Rows of a measurement with ``start <= time < end``; only the days of the range are opened."""
        rows = measurements.read(self.spark, database or self.database, measurement)
        return measurements.time_range(rows, start, end)

    def list_measurements(self, database: str | None = None) -> DataFrame:
        return measurements.list_measurements(self.spark, database)

    def list_databases(self) -> DataFrame:
        return measurements.list_databases(self.spark)

    def show_tables(self, database: str | None = None) -> DataFrame:
        return measurements.show_tables(self.spark, database)

    # Upkeep

    def delete(
        self,
        database: str,
        measurement: str,
        where: str,
        dry_run: bool = True,
        confirm: bool = False,
        limits: deletion.DeleteLimits = deletion.DeleteLimits(),
        as_of: Any = None,
    ) -> deletion.DeleteResult:
        return deletion.delete(self.spark, database, measurement, where, dry_run, confirm, limits, as_of)

    def run_retention(
        self, policy: retention.RetentionPolicy, as_of: Any, dry_run: bool = True, confirm: bool = False
    ) -> retention.RetentionResult:
        return retention.run_retention(self.spark, policy, as_of, dry_run, confirm)

    def run_continuous(
        self, query: continuous.ContinuousQuery, start: Any = None, end: Any = None, as_of: Any = None, dry_run: bool = False
    ) -> continuous.QueryRun | None:
        return continuous.run_query(self.spark, query, start, end, as_of, dry_run)

    def run_pending(self, query: continuous.ContinuousQuery, as_of: Any) -> continuous.QueryRun | None:
        return continuous.run_pending(self.spark, query, as_of)


def _columns_to_spark(spark: SparkSession, columns: Mapping[str, Sequence[Any]]) -> DataFrame:
    return spark.createDataFrame(pa.table({name: pa.array(list(values)) for name, values in columns.items()}))
