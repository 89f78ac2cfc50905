"""Columnar batches, ``{m, columns: {name: [values]}}``, to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.timeunits import generated_time, moment_of, to_time
from chronoloom.session import shared_dir


def columnar_rows(df: DataFrame, time_unit: str = "us", now_us: int | None = None) -> DataFrame:
    """Rows of columnar batches: ``measurement, time`` and one column per array.

    Each row of ``df`` is one batch: ``m`` string, ``columns`` struct of arrays. An array that is null is a column the
    batch does not have, and gives nulls. A batch without ``time`` gets ``now_us + i`` for its row i, whatever the
    unit. An empty name, no arrays, or arrays of unequal length are errors. One narrow stage.
    """
    kind = df.schema["columns"].dataType
    if not isinstance(kind, T.StructType) or not all(isinstance(f.dataType, T.ArrayType) for f in kind.fields):
        raise ValueError("'columns' must be a struct of arrays")
    names = kind.fieldNames()
    if not names:
        raise ValueError("columns cannot be empty")
    to_time(F.lit(0), time_unit)
    stamp = moment_of(df, now_us)

    # What is asked of a whole batch is asked before the explode: after it, each row would carry the arrays along.
    sized = df.select("m", "columns", *_lengths(kind))
    timed = F.col("columns")["time"].isNotNull() if "time" in names else F.lit(False)
    batches = sized.select(F.col("m").alias("_m"), timed.alias("_timed"), _checked_zip(kind).alias("_rows"))
    # The outer form, as for the inner one Catalyst would first zip every batch just to see whether it is empty.
    rows = batches.select("_m", "_timed", F.posexplode_outer("_rows").alias("_pos", "_row"))
    rows = rows.filter(F.col("_pos").isNotNull())

    generated = generated_time(stamp, F.col("_pos"))
    if "time" in names:
        given = to_time(F.col("_row")[str(names.index("time"))], time_unit)
        time = F.when(F.col("_timed"), given).otherwise(generated)
    else:
        time = generated
    values = [F.col("_row")[str(i)].alias(name) for i, name in enumerate(names) if name != "time"]
    return rows.select(F.col("_m").alias("measurement"), time.alias("time"), *values)


def _lengths(kind: T.StructType) -> list[Column]:
    sizes = [F.when(F.col("columns")[f.name].isNotNull(), F.size(F.col("columns")[f.name])) for f in kind.fields]
    # Twice the first, since both functions want two arguments.
    return [F.greatest(sizes[0], *sizes).alias("_longest"), F.least(sizes[0], *sizes).alias("_shortest")]


def _checked_zip(kind: T.StructType) -> Column:
    # arrays_zip pads short arrays without a word and gives null for a null one, so lengths are checked before.
    longest, shortest = F.col("_longest"), F.col("_shortest")
    padded = [
        F.coalesce(F.col("columns")[f.name], F.array_repeat(F.lit(None).cast(f.dataType.elementType), longest))
        for f in kind.fields
    ]
    unequal = F.concat(
        F.lit("all columns must have the same length, got "), shortest.cast("string"), F.lit(" to "), longest.cast("string")
    )
    return (
        F.when(F.coalesce(F.col("m"), F.lit("")) == "", F.raise_error(F.lit("measurement name cannot be empty")))
        .when(longest.isNull(), F.raise_error(F.lit("columns cannot be empty")))
        .when(longest != shortest, F.raise_error(unequal))
        .otherwise(F.arrays_zip(*padded))
    )


def columnar_batches(df: DataFrame, measurement: str, batch_size: int = 10_000, row: Column | None = None) -> DataFrame:
    """Rows to columnar batches of at most ``batch_size`` rows: ``m, columns``.

    ``row`` numbers the rows within the file named by ``_metadata.file_path``, as ``_metadata.row_index`` does. Without
    it Spark's own row ids are taken; those can differ when a lost task runs again, so the numbered rows are first put
    into a checkpoint. No batch can outgrow ``batch_size``, whatever the data, and since the rows of a batch lie
    together they are gathered before the shuffle.
    """
    names = df.columns
    if row is None:
        shared_dir(df.sparkSession)
        numbered = df.select("*", F.monotonically_increasing_id().alias("_row"), F.lit("").alias("_file")).checkpoint()
    else:
        numbered = df.select("*", row.alias("_row"), F.col("_metadata.file_path").alias("_file"))
    keyed = numbered.withColumn("_batch", F.expr(f"_row div {int(batch_size)}"))
    rows = F.sort_array(F.collect_list(F.struct("_row", *names)))
    grouped = keyed.groupBy("_file", "_batch").agg(rows.alias("rows"))
    return grouped.select(
        F.lit(measurement).alias("m"),
        F.struct(*[F.col("rows")[name].alias(name) for name in names]).alias("columns"),
    )
