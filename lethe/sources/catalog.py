"""Column metadata of lake and warehouse in one shape.

One row per column: ``(source, db, table, column, type, is_partition)``.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.scratch import local_table
from lethe.settings import LAKE, WAREHOUSE

CATALOG_SCHEMA = (
    "source string, db string, table string, column string, type string, is_partition boolean"
)
_COLUMNS = "source, db, table, column, type, is_partition:bool"


def lake_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def catalog_columns(
    spark: SparkSession, databases: Iterable[str] | None = None, source: str = LAKE
) -> DataFrame:
    """Columns of the session catalog's tables (one catalog call per table, no data read)."""
    rows = []
    for db in lake_databases(spark) if databases is None else databases:
        for table in spark.catalog.listTables(db):
            if table.isTemporary:
                continue
            for c in spark.catalog.listColumns(f"`{db}`.`{table.name}`"):
                rows.append((source, db, table.name, c.name, c.dataType, c.isPartition))
    return local_table(spark, rows, _COLUMNS)


def columns_of(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    source: str = LAKE,
    partition_columns: Collection[str] = (),
) -> DataFrame:
    """The same rows for tables at hand, named ``db.table``, from their schemas."""
    rows = []
    for name, df in tables.items():
        db, table = name.split(".", 1)
        for f in df.schema.fields:
            is_partition = f.name in partition_columns
            rows.append((source, db, table, f.name, f.dataType.simpleString(), is_partition))
    return local_table(spark, rows, _COLUMNS)


def warehouse_columns(metadata: DataFrame, source: str = WAREHOUSE) -> DataFrame:
    """A database's own column view (``table_schema, table_name, column_name``)."""
    has_type = "data_type" in metadata.columns
    return metadata.select(
        F.lit(source).alias("source"),
        F.col("table_schema").alias("db"),
        F.col("table_name").alias("table"),
        F.col("column_name").alias("column"),
        (F.col("data_type") if has_type else F.lit(None).cast("string")).alias("type"),
        F.lit(False).alias("is_partition"),
    )


def write_metadata_csv(columns: DataFrame, path: str) -> None:
    columns.write.mode("errorifexists").option("header", True).csv(path)


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(CATALOG_SCHEMA).csv(path)
