"""Scalar text expressions: names, paths, markers, partition values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def qualify(db: Column, table: Column) -> Column:
    """``db.table``."""
    return F.concat_ws(".", db, table)


def db_part(qualified: Column) -> Column:
    return F.split_part(qualified, F.lit("."), F.lit(1))


def table_part(qualified: Column) -> Column:
    return F.split_part(qualified, F.lit("."), F.lit(2))


def text_between(text: Column, start: str, end: str) -> Column:
    """Text after the first ``start`` and before the last ``end``; empty if there is none."""
    pattern = rf"(?s)^.*?\Q{start}\E(.*)\Q{end}\E"
    return F.regexp_extract(text, pattern, 1)


def path_bucket(path: Column) -> Column:
    """First part after the scheme: ``s3://bucket/key`` -> ``bucket``."""
    return F.regexp_extract(path, r"^[^:/]+://([^/]*)", 1)


def path_key(path: Column) -> Column:
    """Everything after the bucket: ``s3://bucket/a/b.parquet`` -> ``a/b.parquet``."""
    return F.regexp_extract(path, r"^[^:/]+://[^/]*/(.*)$", 1)


def path_file(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def path_extension(path: Column) -> Column:
    """Text after the last dot of the file name, which names the format; else empty."""
    return F.regexp_extract(path, r"\.([^./]*)$", 1)


def pad2(value: Column) -> Column:
    """Month or day with two digits; longer values stay as they are."""
    text = value.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def date_partition(year: Column, month: Column, day: Column) -> Column:
    """``yyyy/MM/dd`` from three partition columns, padded or not."""
    return F.concat_ws("/", year.cast("string"), pad2(month), pad2(day))


def sql_quote(text: Column) -> Column:
    """A text as SQL literal."""
    return F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
