"""Load rows of several measurements at once.

The rows are first written to the shared folder, split by measurement, so the source is read and worked out once and
not once per measurement; each measurement then reads only its own part.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.measurements import WRITERS, append, check_columns, remove, with_day
from chronoloom.session import settings, shared_dir
from chronoloom.sources.lines import known_schemas, parse_lines, rejects, typed_rows


@contextmanager
def _split(df: DataFrame) -> Iterator[DataFrame]:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/split-{uuid4().hex}"
    with settings(spark, WRITERS):
        df.write.partitionBy("measurement").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path, shared_dir(spark))


def append_each(df: DataFrame, database: str, tags: Sequence[str] = ()) -> list[str]:
    """Append rows to the measurements their column ``measurement`` names; gives the names.

    A column goes to a measurement only if some row of it has a value there. All measurements are checked against their tables
    before the first is written.
    """
    with loads_of(df, tags) as loads:
        _append_all(loads, database)
    return sorted(loads)


@contextmanager
def loads_of(df: DataFrame, tags: Sequence[str] = ()) -> Iterator[dict[str, tuple[DataFrame, list[str]]]]:
    """Rows and tags of each measurement, with the columns it has values in; the source is worked out once."""
    columns = [name for name in df.columns if name not in ("measurement", "time")]
    with _split(df) as parts:
        used = parts.groupBy("measurement").agg(
            *[F.bool_or(F.col(f"`{name}`").isNotNull()).alias(name) for name in columns]
        )
        found = {row.measurement: [name for name in columns if row[name]] for row in used.toLocalIterator()}
        loads = {}
        for measurement, own in found.items():
            rows = parts.filter(F.col("measurement") == measurement)
            loads[measurement] = rows.select("time", *[F.col(f"`{name}`") for name in own]), [t for t in tags if t in own]
        yield loads


def _append_all(loads: Mapping[str, tuple[DataFrame, Sequence[str]]], database: str) -> None:
    """Append to several measurements, each with its tags; a clash in any of them is raised before the first write."""
    for name, (rows, _) in loads.items():
        check_columns(rows.sparkSession, with_day(rows), database, name)
    for name, (rows, tags) in loads.items():
        append(rows, database, name, tags)


def append_lines(
    lines: DataFrame, database: str, reject_path: str | None = None, now_us: int | None = None
) -> list[str]:
    """Append the points of line-protocol text to their measurements; gives the names.

    Tags and field types are found in the text. Lines off the grammar are written to ``reject_path``; without one they
    are an error, raised before anything is appended.
    """
    with _split(parse_lines(lines)) as parts:
        bad = rejects(parts)
        if reject_path is not None:
            bad.write.mode("append").text(reject_path)
        elif not bad.isEmpty():
            raise ValueError(f"lines off the grammar, such as {bad.first().line[:200]!r}")
        good = parts.filter(F.col("measurement").isNotNull())
        schemas = known_schemas(good)
        loads = {name: (typed_rows(good, name, tags, fields, now_us), tags) for name, (tags, fields) in schemas.items()}
        _append_all(loads, database)
    return sorted(schemas)
