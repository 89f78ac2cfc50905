"""Compaction: days that many small appends or micro-batches have filled get few files again."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions.timeunits import as_utc
from chronoloom.operators.files import Files
from chronoloom.operators.measurements import (
    COMPRESSION,
    DAY,
    finish_changes,
    location,
    locations,
    quoted,
    read,
    retire,
    rows_and_files,
    sweep,
    tags_of,
)

#: Bytes a file should have about; a day gets as many files as its bytes ask for.
FILE_BYTES = 256 * 1024 * 1024
#: How long files that were replaced stay for readers that have begun.
GRACE = timedelta(hours=1)


@dataclass(frozen=True)
class Compaction:
    """What a compaction did or, as a dry run, would do."""

    days: list[date]
    rows: int
    files_before: int
    files_after: int
    swept: int
    dry_run: bool


def compaction_plan(
    spark: SparkSession, database: str, measurement: str, before: datetime | date | str, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """``day, rows, files, bytes, wanted`` of closed days with twice the files their bytes ask for, or more; footers alone are read."""
    rows = read(spark, database, measurement).filter(F.col(DAY) < F.lit(as_utc(before).date()))
    files = rows.select(DAY, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    sizes = files.groupBy(DAY, "path", "size").agg(F.count(F.lit(1)).alias("rows"))
    days = sizes.groupBy(DAY).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).cast("bigint").alias("files"), F.sum("size").alias("bytes")
    )
    wanted = F.ceil(F.col("bytes") / F.lit(file_bytes)).cast("bigint")
    return days.withColumn("wanted", wanted).filter("files >= 2 * wanted")


def compact(
    spark: SparkSession,
    database: str,
    measurement: str,
    before: datetime | date | str,
    file_bytes: int = FILE_BYTES,
    grace: timedelta = GRACE,
    dry_run: bool = False,
) -> Compaction:
    """Rewrite closed days, those before the day of ``before``, that have twice the files their bytes ask for, or more.

    A day of b bytes gets at most ceil(b / ``file_bytes``) files, each sorted by tags and time. Rows are spread over a day's files
    by their values, so a heavy day is the work of as many tasks as it gets files. The new files are written to a folder of their own
    and counted; then the catalogue is pointed to them day by day. A query that has begun goes on with the old files, which stay for
    ``grace`` and go with a later compaction; none sees a row twice. Other days are not touched. A run that dies leaves each day old or
    new and may be repeated; what it wrote in vain is swept. As with any change there is one writer a measurement.
    """
    finish_changes(spark, database, measurement)
    plan = {row[DAY]: row for row in compaction_plan(spark, database, measurement, before, file_bytes).collect()}
    days = sorted(plan)
    rows, files, wanted = (sum(row[name] for row in plan.values()) for name in ("rows", "files", "wanted"))
    if dry_run:
        return Compaction(days, rows, files, wanted, 0, True)
    swept = sweep(spark, database, measurement, grace)
    if days:
        target = f"{location(spark, database, measurement)}/rev={uuid4().hex}"
        # Noted before it is written: a folder that the catalogue never names is swept.
        retire(spark, database, measurement, {day: [f"{target}/{DAY}={day}"] for day in days})
        written = _rewritten(spark, database, measurement, plan, target)
        off = [day for day in days if written.get(day, (0, 0))[0] != plan[day]["rows"]]
        if off:
            Files(spark).remove(target)
            raise RuntimeError(f"{off[0]} has other rows than were counted; the measurement has changed meanwhile")
        wanted = sum(files for _, files in written.values())
        old = locations(spark, database, measurement)
        retire(spark, database, measurement, {day: [old[day]] for day in days})
        table = quoted(database, measurement)
        for day in days:
            spark.sql(f"ALTER TABLE {table} PARTITION ({DAY} = '{day}') SET LOCATION '{target}/{DAY}={day}'")
        spark.catalog.refreshTable(table)
    return Compaction(days, rows, files, wanted, swept, False)


def _rewritten(
    spark: SparkSession, database: str, measurement: str, plan: Mapping[date, Row], target: str
) -> dict[date, tuple[int, int]]:
    """Write days to a folder, each with the files it is to have; gives rows and files by day, from the footers written."""
    table = read(spark, database, measurement)
    rows = table.filter(F.col(DAY).isin(list(plan)))
    wanted = spark.createDataFrame([(day, row["wanted"]) for day, row in plan.items()], f"{DAY} date, _wanted bigint")
    values = [quoted(f.name) for f in table.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = rows.join(wanted, DAY).withColumn("_slice", F.pmod(F.xxhash64(*values), "_wanted")).drop("_wanted")
    rows = rows.repartition(sum(row["wanted"] for row in plan.values()), DAY, "_slice").drop("_slice")
    rows = rows.select(table.columns)
    rows = rows.sortWithinPartitions(DAY, *[quoted(tag) for tag in tags_of(spark, database, measurement)], "time")
    rows.write.partitionBy(DAY).option("compression", COMPRESSION).parquet(target)
    counts = rows_and_files(spark.read.schema(table.schema).parquet(target)).collect()
    return {row[DAY]: (row["rows"], row["files"]) for row in counts}
