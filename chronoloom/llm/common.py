"""What several operators share: tables written between two steps, and filters by a set of ids."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.session import settings, shared_dir

#: Characters between words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Ids that may be sent to every executor. Eight bytes each, so a broadcast stays under some 16 MB of memory.
MAX_SENT_IDS = 400_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Hand rows to Python workers a few at a time, as a row may hold a long text."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"})


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: worked out once, and safe from lost executors."""
    path = scratch(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(column) -> F.Column:
    """A to Z in lower case; all other letters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(column) -> F.Column:
    """Words of a text in order, an empty array for null."""
    spaced = F.translate(F.coalesce(column, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def by_ids(rows: DataFrame, ids: DataFrame, keys: list[str], how: str, limit: int = MAX_SENT_IDS) -> DataFrame:
    """Semi or anti join on ``keys``; ``ids`` is sent to the executors if it has at most ``limit`` rows.

    Beyond that both sides are shuffled by the keys, which are unique in ``ids``.
    """
    count = ids.limit(limit + 1).count()
    if count == 0 and how == "left_anti":
        return rows
    kept = rows.join(F.broadcast(ids) if count <= limit else ids, keys, how)
    return kept.select(*columns_of(rows))


def let(value: F.Column, use: Callable[[F.Column], F.Column]) -> F.Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def columns_of(docs: DataFrame) -> list[F.Column]:
    """All columns, whatever signs their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def packed(docs: DataFrame, name: str = "doc") -> F.Column:
    """All columns as one struct, so that no column of the caller's can clash with one of ours."""
    return F.struct(*columns_of(docs)).alias(name)
