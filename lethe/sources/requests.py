"""Request lists and settings files: lines of ``key=value`` or ``key=['a', 'b']``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.settings import REQUEST_KEY

# The line format of request and settings files.
LINE = r"^\s*([^=]+?)\s*=\s*(.*?)\s*$"
QUOTED_ITEM = r"'(?:[^'\\]|\\.)*'|" + r'"(?:[^"\\]|\\.)*"'


def parse_key_values(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines to ``(key, items array<string>)``; lines without ``=`` are skipped."""
    key = F.regexp_extract(F.col(column), LINE, 1)
    raw = F.regexp_extract(F.col(column), LINE, 2)
    quoted = F.regexp_extract_all(raw, F.lit(QUOTED_ITEM), F.lit(0))
    unquoted = F.transform(
        quoted,
        lambda q: F.regexp_replace(F.substring(q, F.lit(2), F.length(q) - 2), r"\\(.)", "$1"),
    )
    is_list = raw.startswith("[") | F.rlike(raw, F.lit(rf"^(?:{QUOTED_ITEM})$"))
    return lines.where(F.col(column).rlike(LINE)).select(
        key.alias("key"), F.when(is_list, unquoted).otherwise(F.array(raw)).alias("items")
    )


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    return parse_key_values(spark.read.text(path))


def subjects_from(pairs: DataFrame, key: str = REQUEST_KEY) -> DataFrame:
    """The people asked for: ``(subject)``, trimmed, each once."""
    return (
        pairs.where(F.col("key") == key)
        .select(F.explode("items").alias("subject"))
        .select(F.trim("subject").alias("subject"))
        .where(F.col("subject") != "")
        .distinct()
    )
