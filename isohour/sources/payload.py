"""Landed payload files: one JSON document per line, an object of parallel hourly arrays.

    {"city_id": 1, "hourly": {"time": ["2024-01-01T00:00", ...], "temperature_2m": [3.1, ...], ...}}

A file may also sit in a ``city_id=<n>`` folder; the folder then names the series.
A document that is broken in any way goes to quarantine whole; the others are loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from isohour import schemas
from isohour.functions.measures import nan_to_null
from isohour.functions.times import instant

_CORRUPT = "_corrupt_record"
_PARSED = T.StructType([*schemas.PAYLOAD.fields, T.StructField(_CORRUPT, T.StringType())])
_ARRAYS = ("time", *schemas.PAYLOAD_FIELDS)


def landed(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Documents of a landing folder: ``body`` and ``source_file``, plus folder columns.

    ``whole_files`` reads each file as one document, for JSON that spans lines.
    """
    return spark.read.text(path, wholetext=whole_files).select(
        F.col("value").alias("body"), F.col("_metadata.file_path").alias("source_file"), "*"
    ).drop("value")


def parse(documents: DataFrame) -> DataFrame:
    """Add ``series``, ``hourly`` and ``reason`` (NULL for a sound document)."""
    parsed = documents.withColumn(
        "_doc",
        F.from_json("body", _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}),
    )
    in_body = F.col("_doc.city_id")
    series = F.coalesce(in_body, F.col("city_id")) if "city_id" in documents.columns else in_body
    arrays = [F.col(f"_doc.hourly.{name}") for name in _ARRAYS]
    reason = (
        F.when(F.col("_doc").isNull() | F.col(f"_doc.{_CORRUPT}").isNotNull(), "malformed")
        .when(series.isNull(), "no_series")
        .when(_any([a.isNull() for a in arrays]), "missing_field")
        .when(_any([F.size(a) != F.size(arrays[0]) for a in arrays[1:]]), "ragged_arrays")
        .when(F.exists(arrays[0], lambda t: t.try_cast("timestamp_ntz").isNull()), "bad_time")
    )
    return (
        parsed.withColumn("series", series.cast("int"))
        .withColumn("hourly", F.col("_doc.hourly"))
        .withColumn("reason", reason)
        .drop("_doc")
    )


def _any(tests: list[Column]) -> Column:
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return found


def sound(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull())


def quarantined(parsed: DataFrame, refused_at: str | Column | None = None) -> DataFrame:
    """The refused documents, whole, with the reason; a re-run may read them again.

    Jobs and streams pass ``refused_at``, so that they share one quarantine table.
    """
    refused = parsed.where(F.col("reason").isNotNull()).select(
        *[c for c in ("source_file", "series", "reason", "body") if c in parsed.columns]
    )
    return refused if refused_at is None else refused.withColumn("refused_at", instant(refused_at))


def to_rows(parsed: DataFrame, loaded_at: str | Column) -> DataFrame:
    """Zip the arrays of sound documents into raw rows, stamped with series and load time."""
    zipped = F.arrays_zip(*[F.col(f"hourly.{name}").alias(name) for name in _ARRAYS])
    rows = sound(parsed).select("series", F.inline(zipped))
    named = rows.select(
        F.col("time").cast("timestamp_ntz").alias("timestamp"),
        F.col("series").alias("city_id"),
        *[F.col(field).alias(measure) for field, measure in schemas.PAYLOAD_FIELDS.items()],
        instant(loaded_at).alias("ingestion_ts"),
    )
    return nan_to_null(named, schemas.MEASURES)


def drop_future(rows: DataFrame, as_of: str | Column, ts: str = "timestamp") -> DataFrame:
    """Forecast hours come along in a live payload; keep what has been observed."""
    return rows.where(F.col(ts) <= instant(as_of))


def payload_of(rows: DataFrame, *keys: str) -> DataFrame:
    """The inverse of :func:`to_rows`: one document per ``keys``, as ``city_id`` and ``body``.

    ``keys`` must bound the group (a series and a day: 24 hours at most).
    """
    packed = rows.groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "timestamp",
                    *[F.col(m) for m in schemas.MEASURES],
                )
            )
        ).alias("_rows")
    )
    hourly = F.struct(
        F.transform(
            "_rows",
            lambda r: F.translate(F.substring(r["timestamp"].cast("string"), 1, 16), " ", "T"),
        ).alias("time"),
        *[
            F.col("_rows").getField(measure).alias(field)
            for field, measure in schemas.PAYLOAD_FIELDS.items()
        ],
    )
    return packed.select(
        *keys,
        F.to_json(
            F.struct("city_id", hourly.alias("hourly")), {"ignoreNullFields": "false"}
        ).alias("body"),
    )
