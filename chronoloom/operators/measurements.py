"""Measurements: Parquet tables partitioned by ``day``, and what the catalogue knows of them."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta
from functools import reduce
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.timeunits import as_utc, instant, now_micros
from chronoloom.operators.files import Files
from chronoloom.session import settings

DAY = "day"
COMPRESSION = "zstd"
# A task that holds few days writes their files side by side; only beyond that are its rows sorted by day first.
WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "4"}
LIST_SCHEMA = "database string, measurement string"


def quoted(*parts: str) -> str:
    """Identifier for SQL text."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def exists(spark: SparkSession, database: str, measurement: str) -> bool:
    return spark.catalog.databaseExists(quoted(database)) and spark.catalog.tableExists(quoted(database, measurement))


def read(spark: SparkSession, database: str, measurement: str) -> DataFrame:
    """All rows, as the table is now; read again after a write, since files may have been replaced."""
    if not exists(spark, database, measurement):
        raise ValueError(f"measurement not found: {database}.{measurement}")
    return spark.table(quoted(database, measurement))


def time_range(
    df: DataFrame, start: datetime | date | str | None = None, end: datetime | date | str | None = None
) -> DataFrame:
    """Rows with ``start <= time < end``.

    A filter on ``time`` reaches the files but prunes no partition, so bounds on ``day`` go with it.
    """
    if start is not None:
        df = df.filter((F.col("time") >= instant(start)) & (F.col(DAY) >= F.lit(as_utc(start).date())))
    if end is not None:
        df = df.filter((F.col("time") < instant(end)) & (F.col(DAY) <= F.lit(last_day(end))))
    return df


def last_day(end: datetime | date | str) -> date:
    """Last day that holds a moment before ``end``."""
    return (as_utc(end) - timedelta(microseconds=1)).date()


def days_of(spark: SparkSession, database: str, measurement: str) -> list[date]:
    """Days the table has, from the catalogue alone; no file is opened."""
    rows = spark.sql(f"SHOW PARTITIONS {quoted(database, measurement)}").collect()
    return sorted(date.fromisoformat(row.partition.split("=", 1)[1]) for row in rows)


def with_day(df: DataFrame) -> DataFrame:
    """Rows with their partition column; a row without a time is an error."""
    if "time" not in df.columns or not isinstance(df.schema["time"].dataType, T.TimestampType):
        raise ValueError("rows of a measurement need a timestamp column 'time'")
    if DAY in df.columns:
        raise ValueError(f"{DAY!r} is the partition column and may not be a field")
    timeless = F.raise_error(F.lit("a row has no time"))
    return df.withColumn(DAY, F.when(F.col("time").isNull(), timeless).otherwise(F.to_date("time")))


def append(
    df: DataFrame,
    database: str,
    measurement: str,
    tags: Sequence[str] = (),
    cluster: bool = False,
    max_rows_per_file: int = 0,
) -> None:
    """Append rows, creating the table or adding its new columns as needed.

    Columns the rows lack become null; a column whose type clashes is refused before anything is written. By default
    the write is one narrow stage without a sort, right for input that comes in time order. With ``cluster`` rows are
    brought together by day first and lie by tag and time in each file, so that row groups can be skipped on both;
    AQE splits a heavy day over many tasks and files instead of giving it to one.
    """
    if not measurement:
        raise ValueError("measurement name cannot be empty")
    spark = df.sparkSession
    rows = with_day(df)
    prepare(spark, rows, database, measurement, tags)
    rows = aligned(rows, spark.table(quoted(database, measurement)))
    if cluster:
        rows = _clustered(rows, tags_of(spark, database, measurement))
    limit = {"spark.sql.files.maxRecordsPerFile": str(max_rows_per_file)} if max_rows_per_file else {}
    with settings(spark, {**WRITERS, **limit}):
        rows.write.insertInto(quoted(database, measurement))


def _clustered(rows: DataFrame, tags: Sequence[str]) -> DataFrame:
    return rows.hint("rebalance", DAY).sortWithinPartitions(DAY, *[quoted(tag) for tag in tags], "time")


def prepare(
    spark: SparkSession, rows: DataFrame, database: str, measurement: str, tags: Sequence[str] = ()
) -> None:
    """Create the table, or add its new columns, for rows that have a ``day``. Columns of nulls alone have no type yet and are left out."""
    table = quoted(database, measurement)
    fields = check_columns(spark, rows, database, measurement)
    finish_changes(spark, database, measurement)
    if not exists(spark, database, measurement):
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields if f.name != DAY)
        listed = f"TBLPROPERTIES ('tags' = '{_property(sorted(set(tags)))}')"
        spark.sql(
            f"CREATE TABLE {table} ({columns}, {DAY} DATE) USING parquet "
            f"OPTIONS ('compression' = '{COMPRESSION}') PARTITIONED BY ({DAY}) {listed}"
        )
        return
    have = set(spark.table(table).columns)
    new = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")
    known = tags_of(spark, database, measurement)
    if set(tags) - set(known):
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('tags' = '{_property(sorted({*known, *tags}))}')")


def check_columns(spark: SparkSession, rows: DataFrame, database: str, measurement: str) -> list[T.StructField]:
    """Columns of new rows that a table will hold; one that clashes with another or with the table's is an error."""
    fields = [f for f in rows.schema.fields if not isinstance(f.dataType, T.NullType)]
    known = spark.table(quoted(database, measurement)).schema.fields if exists(spark, database, measurement) else []
    have = {f.name: f.dataType for f in known}
    spelt = {name.lower(): name for name in have}
    for field in fields:
        if spelt.setdefault(field.name.lower(), field.name) != field.name:
            raise ValueError(f"columns {spelt[field.name.lower()]!r} and {field.name!r} of {database}.{measurement} differ in case alone")
        if field.name in have and not _fits(field.dataType, have[field.name]):
            raise ValueError(
                f"column {field.name!r} of {database}.{measurement} is {have[field.name].simpleString()}, "
                f"the new rows hold {field.dataType.simpleString()}"
            )
    return fields


def _property(names: Sequence[str]) -> str:
    return json.dumps(list(names)).replace("\\", "\\\\").replace("'", "\\'")


def tags_of(spark: SparkSession, database: str, measurement: str) -> list[str]:
    """Tag columns, as noted in the table's properties."""
    row = spark.sql(f"SHOW TBLPROPERTIES {quoted(database, measurement)} ('tags')").first()
    if row is None or "not have property" in row.value:
        return []
    return json.loads(row.value) if row.value.startswith("[") else [n for n in row.value.split(",") if n]


# Numeric types from narrow to wide, each of which holds the ones before it without loss.
_WIDTHS = ["tinyint", "smallint", "int", "bigint"], ["tinyint", "smallint", "int", "double"], ["float", "double"]


def _fits(new: T.DataType, old: T.DataType) -> bool:
    if new == old or isinstance(new, T.NullType):
        return True
    narrow, wide = new.simpleString(), old.simpleString()
    return any(narrow in kinds and wide in kinds and kinds.index(narrow) <= kinds.index(wide) for kinds in _WIDTHS)


def aligned(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with a table's columns and types; columns they lack are null."""
    return rows.select(
        *[
            (F.col(quoted(f.name)) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )


def replace_days(
    spark: SparkSession,
    database: str,
    measurement: str,
    rows: DataFrame,
    days: Iterable[date],
    cluster: bool = False,
    files: DataFrame | None = None,
) -> dict[date, int]:
    """Make ``rows`` (with ``day``) the whole content of ``days``; gives the row count by day written.

    ``rows`` may be read from the table itself. They are written once, to a new folder under the table; then the
    catalogue is pointed to it day by day and the old files go. Until its turn a day keeps its old content, so a run
    that dies loses nothing and can be repeated. Days without rows are dropped. ``cluster`` is as in ``append``; rows
    read from the table's own files lie by day already. ``files`` lists the table's files, ``day, file_path``, where
    the caller knows them.
    """
    table = quoted(database, measurement)
    root = location(spark, database, measurement)
    finish_changes(spark, database, measurement)
    target = f"{root}/rev={uuid4().hex}"
    rows = aligned(rows, spark.table(table))
    if cluster:
        rows = _clustered(rows, tags_of(spark, database, measurement))
    with settings(spark, WRITERS):
        rows.write.partitionBy(DAY).option("compression", COMPRESSION).parquet(target)
    # Counted from the file footers of what was written: at most one row per day comes back.
    counts = spark.read.schema(rows.schema).parquet(target).groupBy(DAY).count().collect()
    written = {row[DAY]: row["count"] for row in counts}

    have = set(days_of(spark, database, measurement))
    if files is None:
        rows = read(spark, database, measurement).select(DAY, F.col("_metadata.file_path"))
        files = rows.filter(F.col(DAY).isin(list(have & set(written)))).distinct()
    folders = _folders(files)
    for day in sorted(written):
        spec = f"PARTITION ({DAY} = '{day}')"
        path = f"{target}/{DAY}={day}"
        if day in have:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{path}'")
            for folder in folders.get(day, []):
                remove(spark, folder, root)
        else:
            spark.sql(f"ALTER TABLE {table} ADD {spec} LOCATION '{path}'")
    drop_days(spark, database, measurement, (set(days) & have) - set(written))
    spark.catalog.refreshTable(table)
    return written


def upsert(spark: SparkSession, database: str, measurement: str, rows: DataFrame, keys: Sequence[str]) -> None:
    """Put rows, one for each time and ``keys``, in the place of those with the same time and keys; other rows stay.

    Nulls among the keys are alike. Only the days of the new rows are read and written, and their keys alone are shuffled with them.
    The new rows are read twice, so they should be a table. ``keys`` become tags.
    """
    new = with_day(rows)
    prepare(spark, new, database, measurement, keys)
    days = [row[DAY] for row in new.select(DAY).distinct().collect()]
    old = read(spark, database, measurement).filter(F.col(DAY).isin(days))
    spots = new.select(DAY, "time", *[quoted(k) for k in keys]).alias("spots")
    same = [F.col(f"old.{quoted(k)}").eqNullSafe(F.col(f"spots.{quoted(k)}")) for k in (DAY, "time", *keys)]
    kept = old.alias("old").join(spots, reduce(Column.__and__, same), "left_anti")
    replace_days(spark, database, measurement, kept.unionByName(new, allowMissingColumns=True), days, cluster=True)


# Folders of changes to single files; readers pass over names that begin so.
CHANGE = "_change-"
LISTED = "_LIST"


def replace_files(
    spark: SparkSession,
    database: str,
    measurement: str,
    rows: DataFrame,
    count: int,
    files: dict[date, list[str]],
    whole: Iterable[date] = (),
) -> None:
    """Put ``rows`` in the place of some files of days, and drop ``whole`` days; all other files stay where they are.

    ``rows``, which may be read from these files, are staged in a hidden folder of the table, and have to be ``count``. Then the
    list of what goes is put beside them in one step, and from there on the change holds: it is carried out now, or, if the driver
    is lost, by the next writer to the table, from wherever it stopped. Without its list a change has done nothing. While files
    change places a reader may miss rows of the files that are replaced; it sees none twice.
    """
    store, stage = Files(spark), f"{location(spark, database, measurement)}/{CHANGE}{uuid4().hex}"
    rows = aligned(rows, spark.table(quoted(database, measurement)))
    if count:
        with settings(spark, WRITERS):
            rows.write.partitionBy(DAY).option("compression", COMPRESSION).parquet(stage)
        staged = spark.read.schema(rows.schema).parquet(stage).count()
        if staged != count:
            store.remove(stage)
            raise RuntimeError(f"{staged} rows are left where {count} were counted; the measurement has changed meanwhile")
    gone = {f"{DAY}={day}": paths for day, paths in files.items()}
    store.write(f"{stage}/{LISTED}", json.dumps({"gone": gone, "whole": [day.isoformat() for day in whole]}))
    _carry_out(spark, database, measurement, stage)


def finish_changes(spark: SparkSession, database: str, measurement: str) -> int:
    """Carry out listed changes whose driver was lost, and drop those that had no list yet; gives the number of the former."""
    if not exists(spark, database, measurement):
        return 0
    store, root, done = Files(spark), location(spark, database, measurement), 0
    for name in store.folders(root, hidden=CHANGE):
        if store.exists(f"{root}/{name}/{LISTED}"):
            _carry_out(spark, database, measurement, f"{root}/{name}")
            done += 1
        else:
            store.remove(f"{root}/{name}")
    return done


def _carry_out(spark: SparkSession, database: str, measurement: str, stage: str) -> None:
    store = Files(spark)
    change = json.loads(store.text(f"{stage}/{LISTED}"))
    drop_days(spark, database, measurement, map(date.fromisoformat, change["whole"]))
    have = {f"{DAY}={day}" for day in days_of(spark, database, measurement)}
    for day, paths in change["gone"].items():
        # A day that was dropped meanwhile takes no rows back.
        if day not in have:
            continue
        for path in paths:
            store.remove(path)
        for part in store.names(f"{stage}/{day}", "part-"):
            store.move(f"{stage}/{day}/{part}", f"{paths[0].rsplit('/', 1)[0]}/{part}")
    spark.catalog.refreshTable(quoted(database, measurement))
    store.remove(stage)


def _folders(files: DataFrame) -> dict[date, list[str]]:
    """Folders by day, about one for each."""
    folder = F.regexp_replace("file_path", "/[^/]*$", "").alias("folder")
    out: dict[date, list[str]] = {}
    for row in files.select(DAY, folder).distinct().collect():
        out.setdefault(row[DAY], []).append(unquote(row.folder))
    return out


def drop_days(spark: SparkSession, database: str, measurement: str, days: Iterable[date]) -> None:
    """Drop whole days in one statement; files go, none is read or rewritten."""
    days = sorted(days)
    specs = ", ".join(f"PARTITION ({DAY} = '{day}')" for day in days)
    if specs:
        spark.sql(f"ALTER TABLE {quoted(database, measurement)} DROP IF EXISTS {specs}")
        # A day that comes back later must not find the files it had before a compaction.
        sweep(spark, database, measurement, days=days)


# Hidden folders, one a compaction, that list the folders it put out of use; their names end in the second of that.
RETIRED = "_retired-"


def retire(spark: SparkSession, database: str, measurement: str, folders: dict[date, list[str]]) -> None:
    """Note folders of days that are out of use, for ``sweep`` to remove when no reader needs them any more."""
    name = f"{RETIRED}{uuid4().hex}-{now_micros() // 1_000_000}"
    listed = {day.isoformat(): paths for day, paths in folders.items()}
    Files(spark).write(f"{location(spark, database, measurement)}/{name}/{LISTED}", json.dumps(listed))


def sweep(
    spark: SparkSession,
    database: str,
    measurement: str,
    older_than: timedelta = timedelta(),
    days: Iterable[date] | None = None,
) -> int:
    """Remove folders that were put out of use ``older_than`` ago, of all days or of those given; gives their number.

    A folder that the catalogue names again for its day is left. A sweep that dies is taken up by the next one.
    """
    store, root, removed = Files(spark), location(spark, database, measurement), 0
    names = store.folders(root, hidden=RETIRED)
    wanted = None if days is None else {day.isoformat() for day in days}
    for name in names:
        if int(name.rsplit("-", 1)[1]) > now_micros() // 1_000_000 - older_than.total_seconds():
            continue
        listed = json.loads(store.text(f"{root}/{name}/{LISTED}"))
        due = [day for day in listed if wanted is None or day in wanted]
        places = set(locations(spark, database, measurement).values()) if due else set()
        for path in [path for day in due for path in listed[day] if path.rstrip("/") not in places]:
            remove(spark, path, root)
            removed += 1
        if len(due) == len(listed):
            store.remove(f"{root}/{name}")
    return removed


def locations(spark: SparkSession, database: str, measurement: str) -> dict[date, str]:
    """Folder of each day, from the catalogue alone."""
    catalogue = spark._jsparkSession.sessionState().catalog()
    identifier = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(quoted(database, measurement))
    found = catalogue.listPartitions(identifier, spark._jvm.scala.Option.empty())
    parts = [found.apply(i) for i in range(found.size())]
    path = spark._jvm.org.apache.hadoop.fs.Path
    return {date.fromisoformat(p.spec().apply(DAY)): path(p.location()).toString() for p in parts}


def encoded(spark: SparkSession, path: str) -> str:
    """A path as file names of rows have it, with its special characters encoded."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def rows_and_files(df: DataFrame) -> DataFrame:
    """``day, rows, files`` of a measurement, from file footers; no column is read."""
    files = df.select(DAY, F.col("_metadata.file_path").alias("file")).groupBy(DAY, "file").count()
    return files.groupBy(DAY).agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("files"))


def location(spark: SparkSession, database: str, measurement: str) -> str:
    """Folder of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(database, measurement)}").filter("col_name = 'Location'")
    return rows.first().data_type.rstrip("/")


def remove(spark: SparkSession, path: str, within: str) -> None:
    """Remove a folder this package wrote; it must lie ``within`` another."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, parent = hadoop.Path(path), hadoop.Path(within)
    if not target.toUri().getPath().startswith(parent.toUri().getPath() + "/"):
        raise RuntimeError(f"{path} does not lie within {within}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_databases(spark: SparkSession) -> DataFrame:
    """``database`` of each database."""
    return spark.sql("SHOW DATABASES").toDF("database")


def show_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of a database, ``default`` if none is named: ``namespace, tableName, isTemporary``."""
    return spark.sql(f"SHOW TABLES FROM {quoted(database or 'default')}").filter("NOT isTemporary")


def names_of(spark: SparkSession, database: str) -> list[str]:
    """Measurements of a database: its tables, but no views and no run histories, which begin with an underscore."""
    views = {row.viewName for row in spark.sql(f"SHOW VIEWS FROM {quoted(database)}").collect()}
    names = {row.tableName for row in show_tables(spark, database).collect()}
    return sorted(name for name in names - views if not name.startswith("_"))


def list_measurements(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``database, measurement, file_count, total_size_mb, storage_path``, of all databases unless one is named.

    Files are listed by Spark with their lengths; none is opened.
    """
    names = [database] if database else [row.database for row in list_databases(spark).collect()]
    parts = [_database_files(spark, name) for name in names]
    known = spark.createDataFrame([(db, m) for db in names for m in names_of(spark, db)], LIST_SCHEMA)
    files = reduce(DataFrame.unionByName, [part for part in parts if part is not None], _no_files(spark))
    sums = files.groupBy("database", "measurement").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("bytes"), F.first("root").alias("root")
    )
    return known.join(sums, ["database", "measurement"], "left").select(
        "database",
        "measurement",
        F.coalesce("file_count", F.lit(0)).alias("file_count"),
        F.round(F.coalesce("bytes", F.lit(0)) / F.lit(1024 * 1024), 6).alias("total_size_mb"),
        F.concat("root", F.lit("/"), "measurement", F.lit("/**/*.parquet")).alias("storage_path"),
    )


def _no_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{LIST_SCHEMA}, root string, length bigint")


def _database_files(spark: SparkSession, database: str) -> DataFrame | None:
    if not names_of(spark, database):
        return None
    rows = spark.sql(f"DESCRIBE DATABASE {quoted(database)}").filter("info_name = 'Location'").collect()
    root = rows[0].info_value.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )
    # Tables lie at <database>/<measurement>/, so the measurement is the first step below the root.
    below: Column = F.substring("path", F.lit(len(root) + 2), F.length("path"))
    return files.select(
        F.lit(database).alias("database"),
        F.substring_index(below, "/", 1).alias("measurement"),
        F.lit(root).alias("root"),
        "length",
    )


@contextmanager
def current_database(spark: SparkSession, database: str | None):
    """Resolve unqualified names in ``database`` for a while."""
    before = spark.catalog.currentDatabase()
    if database:
        spark.catalog.setCurrentDatabase(database)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)
