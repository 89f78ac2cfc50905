"""Any table to a measurement."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.timeunits import to_time


def as_spark(spark: SparkSession, frame: Any) -> DataFrame:
    """Spark DataFrame of a Spark, pandas or Arrow table, or of any frame with ``to_arrow``."""
    if isinstance(frame, DataFrame):
        return frame
    if hasattr(frame, "to_arrow"):
        frame = frame.to_arrow()
    return spark.createDataFrame(frame)


def table_rows(df: DataFrame, time_column: str = "time", time_unit: str = "us") -> DataFrame:
    """The table with its time column as a timestamp called ``time``, in front; a narrow projection.

    Dates and timestamps keep their instant, numbers count ``time_unit`` since the epoch.
    """
    if time_column not in df.columns:
        raise ValueError(f"time column {time_column!r} not found")
    if time_column != "time" and "time" in df.columns:
        raise ValueError(f"{time_column!r} cannot become 'time': there is another column of that name")
    kind = df.schema[time_column].dataType
    column = F.col(f"`{time_column}`")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        time = column.cast("timestamp")
    elif isinstance(kind, T.NumericType):
        time = to_time(column, time_unit)
    else:
        raise ValueError(f"time column {time_column!r} holds {kind.simpleString()}, not a time or a number")
    return df.select(time.alias("time"), *[F.col(f"`{name}`") for name in df.columns if name != time_column])
