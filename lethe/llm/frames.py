"""Small helpers the operators share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.scratch import new_folder, write_table

#: White space between words, everywhere in this package.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns only, found by exact name first, whatever other columns are called.

    Two columns whose names differ in case only are no problem, as none is looked up by Spark.
    """
    columns = df.columns

    def place(name: str) -> int:
        if name in columns:
            return columns.index(name)
        lower = [c.lower() for c in columns]
        if name.lower() in lower:
            return lower.index(name.lower())
        raise ValueError(f"no column {name} in {columns}")

    numbered = df.toDF(*[f"__c{i}" for i in range(len(columns))])
    return numbered.select(*[F.col(f"__c{place(n)}").alias(n) for n in names])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows with columns named ``__c0 ...``, and the safe name of each old one."""
    safe = [f"__c{i}" for i in range(len(df.columns))]
    return df.toDF(*safe), dict(zip(reversed(df.columns), reversed(safe)))


#: Spark then removes the shuffle files of a written table at once and not some time later.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: a lost executor costs no recomputation."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return write_table(df, new_folder(df.sparkSession, label))
    finally:
        conf.set(_CLEANUP, before)


def row_key(doc_id: Column, text: Column) -> Column:
    """The id (which may be null or repeated) and a hash of the text; equal for equal rows only."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.xxhash64(text.cast("string")))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def ship(module: str) -> None:
    """Send a module's functions to the executors whole, so that they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
