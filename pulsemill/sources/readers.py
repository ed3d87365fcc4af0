"""Scans of raw telemetry with fixed schemas (nothing is inferred)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.model import POINTS, SPAN_LOGS, SPANS

CORRUPT = "_corrupt_record"


def _flat(schema: T.StructType) -> T.StructType:
    """The schema as a text file can hold it: maps and arrays are JSON text."""
    fields = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.MapType, T.ArrayType)) else f.dataType)
        for f in schema.fields
    ]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    columns: Mapping[str, str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read ``path`` (file, folder or glob) as ``schema``.

    ``columns`` maps schema columns to SQL expressions over a differently shaped parquet, ORC or JSON table. CSV
    keeps maps and arrays as JSON text, and unreadable rows arrive with ``_corrupt_record`` filled.
    """
    reader = spark.read.options(**(options or {}))
    if columns is not None:
        raw = reader.format(fmt).load(path)
        return raw.select(*[
            (F.expr(columns[f.name]) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    if fmt == "csv":
        flat = _flat(schema)
        raw = reader.schema(flat).option("header", "true").option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", CORRUPT).option("escape", '"').csv(path)
        return raw.select(*[
            (F.from_json(f.name, f.dataType) if isinstance(f.dataType, (T.MapType, T.ArrayType)) else F.col(f.name)).alias(f.name)
            for f in schema.fields], CORRUPT)
    return reader.schema(schema).format(fmt).load(path)


def scan_points(spark: SparkSession, path: str, fmt: str = "parquet", columns: Mapping[str, str] | None = None, **options: str) -> DataFrame:
    return scan(spark, path, POINTS, fmt, columns, options)


def scan_spans(spark: SparkSession, path: str, fmt: str = "parquet", columns: Mapping[str, str] | None = None, **options: str) -> DataFrame:
    return scan(spark, path, SPANS, fmt, columns, options)


def scan_span_logs(spark: SparkSession, path: str, fmt: str = "parquet", columns: Mapping[str, str] | None = None, **options: str) -> DataFrame:
    """Flat log rows; group them per span with ``operators.spans.group_span_logs``."""
    return scan(spark, path, SPAN_LOGS, fmt, columns, options)
