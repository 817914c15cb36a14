"""Parquet tables laid out by month or day, table definitions and column descriptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from isohour import schemas
from isohour.functions.times import day_key, days_before, instant, month_key


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first run."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _on_store(spark: SparkSession, path: str):
    """The path and its file system, whichever store it lies on."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders and files right below ``path``, hidden ones left out."""
    found, store = _on_store(spark, path)
    if not store.exists(found):
        return []
    names = (entry.getPath().getName() for entry in store.listStatus(found))
    return sorted(f"{path}/{name}" for name in names if not name.startswith(("_", ".")))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that is not there is left alone."""
    found, store = _on_store(spark, path)
    store.delete(found, True)


def scan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """An explicit column list, so that the scan reads nothing else."""
    return df.select(*columns)


# Folder columns of a table, by how finely it is laid out.
GRAINS = {"month": ("ym",), "day": ("ym", "day")}
# What Spark names the folder of rows whose folder column is NULL.
NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def grain_of(table: DataFrame) -> str:
    return "day" if {"ym", "day"} <= set(table.columns) else "month"


def without_folders(table: DataFrame) -> DataFrame:
    """The table's own columns."""
    return table.drop(*GRAINS[grain_of(table)])


def folder_key(ts: Column, grain: str) -> Column:
    """The number of the folder a row belongs to: yyyymm or yyyymmdd."""
    return day_key(ts) if grain == "day" else month_key(ts)


def in_folders(table: DataFrame, keys: Sequence[int | None]) -> DataFrame:
    """Rows of the given folders; other folders are not read. None names the folder of rows
    without a time."""
    return table.where(_among(_folder_of(table), keys))


def outside_folders(table: DataFrame, keys: Sequence[int | None]) -> DataFrame:
    """Rows of all folders but the given ones, which are not read."""
    return table.where(~_among(_folder_of(table), keys))


def of_days(rows: DataFrame, ts: str, days: Sequence[int | None]) -> DataFrame:
    """Rows of the given days, of rows without folders.

    The span of the days is stated as well, for the file statistics.
    """
    found = rows.where(_among(day_key(F.col(ts)), days))
    dated = sorted(d for d in days if d is not None)
    if None in days or not dated:
        return found
    first, last = (f"{d // 10000}-{d // 100 % 100:02}-{d % 100:02}" for d in (dated[0], dated[-1]))
    return found.where(F.col(ts) >= instant(first)).where(F.col(ts) < days_before(instant(last), -1))


def _folder_of(table: DataFrame) -> Column:
    return F.col("ym") if grain_of(table) == "month" else F.col("ym") * 100 + F.col("day")


def _among(folder: Column, keys: Sequence[int | None]) -> Column:
    """True or false, also where the folder is NULL."""
    known = folder.isNotNull() & folder.isin([k for k in keys if k is not None])
    return known | folder.isNull() if None in keys else known


def keep_folders(
    spark: SparkSession, path: str, keys: Sequence[int | None], grain: str
) -> None:
    """Remove the folders of a stored table that are not among ``keys``."""
    kept = set()
    for key in keys:
        if key is None:
            values: tuple[int | str, ...] = (NO_FOLDER,) * len(GRAINS[grain])
        else:
            values = (key,) if grain == "month" else divmod(key, 100)
        kept.add("/".join(f"{name}={value}" for name, value in zip(GRAINS[grain], values)))
    for month in children(spark, path):
        for folder in [month] if grain == "month" else children(spark, month):
            if folder.removeprefix(f"{path}/") not in kept:
                remove(spark, folder)


def laid_out(df: DataFrame, ts: str, order: Sequence[str], grain: str = "month") -> DataFrame:
    """Add the folder columns and arrange rows for a write: few files per folder, each sorted.

    ``rebalance`` lets adaptive execution split a month or day that is too large for one task and
    merge small ones; a plain repartition would put each folder into a single task.
    """
    made = {"ym": month_key(F.col(ts)), "day": F.dayofmonth(ts)}
    folders = GRAINS[grain]
    return (
        df.withColumns({c: made[c] for c in folders})
        .hint("rebalance", *folders)
        .sortWithinPartitions(*folders, *order)
    )


def write_table(
    df: DataFrame,
    path: str,
    ts: str,
    order: Sequence[str],
    mode: str = "append",
    grain: str = "month",
) -> None:
    """``append`` rows, ``overwrite`` the table, or replace only the ``folders`` present in df.

    ``grain="month"`` suits small tables. With ``grain="day"`` an upsert of the last days rewrites
    those days only, which pays once a month is large.
    """
    writer = laid_out(df, ts, order, grain).write.partitionBy(*GRAINS[grain])
    if mode == "folders":
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.option("partitionOverwriteMode", "static").mode(mode)
    writer.parquet(path)


def append_raw(
    rows: DataFrame, path: str, loaded_at: str | Column | None = None, grain: str = "month"
) -> None:
    """Append to a raw table. Duplicates are welcome here; the load time decides later."""
    if "ingestion_ts" not in rows.columns:
        stamp = F.localtimestamp() if loaded_at is None else instant(loaded_at)
        rows = rows.withColumn("ingestion_ts", stamp)
    columns = [F.col(f.name).cast(f.dataType) for f in schemas.RAW.fields]
    write_table(rows.select(*columns), path, "timestamp", ("city_id", "timestamp"), grain=grain)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition: str | None = None,
    load_time: str | None = None,
    location: str | None = None,
) -> None:
    """Create a Parquet table if absent; ``load_time`` names a column that defaults to now."""
    columns = []
    for field in schema.fields:
        text = f"`{field.name}` {field.dataType.simpleString()}"
        if field.name == load_time:
            text += " DEFAULT localtimestamp()"
        note = field.metadata.get("comment")
        if note:
            text += f" COMMENT {_quoted(note)}"
        columns.append(text)
    if partition and partition not in schema.fieldNames():
        columns.append(f"`{partition}` INT COMMENT {_quoted(schemas.DESCRIPTIONS['ym'])}")
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet"]
    if partition:
        parts.append(f"PARTITIONED BY (`{partition}`)")
    if location:
        parts.append(f"LOCATION {_quoted(location)}")
    spark.sql(" ".join(parts))


def describe_columns(
    spark: SparkSession, table: str, notes: Mapping[str, str] = schemas.DESCRIPTIONS
) -> None:
    """Store column descriptions on a table that has been built from a query."""
    for column in spark.table(table).columns:
        if column in notes:
            spark.sql(
                f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {_quoted(notes[column])}"
            )


def build(df: DataFrame, name: str, how: str = "view") -> DataFrame:
    """Materialise a model as a ``view`` or a ``table``; incremental ones go through upserts."""
    if how == "view":
        df.createOrReplaceTempView(name)
    elif how == "table":
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
        describe_columns(df.sparkSession, name)
    else:
        raise ValueError(f"unknown materialisation {how!r}")
    return df.sparkSession.table(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
