"""A small lake with personal data, as views over the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lethe.settings import LAKE, WAREHOUSE
from lethe.sources.catalog import columns_of

PARTITIONS = ("partition_0", "partition_1", "partition_2")
REQUESTS = ("user1@example.com", "user7@example.com", "user42@example.com", "nobody@example.com")


_SCHEMAS: dict[str, StructType] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table. Its schema is looked up once, as from a catalog."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def address(key: str) -> Column:
    return F.concat(F.lit("user"), F.col(key).cast("string"), F.lit("@example.com"))


def day_parts(column: str) -> list[Column]:
    return [
        F.date_format(column, pattern).alias(name)
        for pattern, name in zip(("yyyy", "MM", "dd"), PARTITIONS)
    ]


def customer_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        address("c_custkey").alias("email"),
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"),
    )


def events_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        address("user_id").alias("contact_email"),
        "event_id",
        "user_id",
        F.col("ts").alias("event_ts"),
        "event_type",
        "value",
        "props",
        *day_parts("ts"),
    )


def orders_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("orderstatus"),
        F.col("o_totalprice").alias("totalprice"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderpriority").alias("orderpriority"),
        *day_parts("o_orderdate"),
    )


def lineitem_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "l_ship_ts")
    return raw.select([F.col(c).alias(c[2:]) for c in raw.columns])


def supplier_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load(spark, sf_dir, "supplier")
    return raw.select([F.col(c).alias(c[2:]) for c in raw.columns])


def nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load(spark, sf_dir, "nation")
    return raw.select([F.col(c).alias(c[2:]) for c in raw.columns])


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load(spark, sf_dir, "part")
    return raw.select([F.col(c).alias(c[2:]) for c in raw.columns])


VIEWS = {
    "crm_pii.customer_pii": customer_pii,
    "web_pii.events_pii": events_pii,
    "sales_pii.orders_pii": orders_pii,
    "sales_pii.lineitem_pii": lineitem_pii,
    "ref_pii.supplier_pii": supplier_pii,
    "crm_pii.nation": nation,
    "ref.part": part,
}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir) for name, view in VIEWS.items()}


def columns(spark: SparkSession, found: dict[str, DataFrame], source: str = LAKE) -> DataFrame:
    return columns_of(spark, found, source, PARTITIONS)


def requested(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s,) for s in REQUESTS], "subject string")


def every_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole customer base asks at once."""
    return load(spark, sf_dir, "customer").select(address("c_custkey").alias("subject")).distinct()


def customers_of(spark: SparkSession, sf_dir: str, segment: str) -> DataFrame:
    """All customers of a market segment ask."""
    customers = load(spark, sf_dir, "customer").where(F.col("c_mktsegment") == segment)
    return customers.select(address("c_custkey").alias("subject")).distinct()


def shop_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog that grows with the data: every part is a table of its brand's database.

    Columns of ``lethe.sources.catalog``. Names follow from the part's own values, so that
    all combinations of personal and other databases, tables and columns occur.
    """
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    brand = F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")))
    names = F.array(
        F.lit("partkey"),
        F.lit("name"),
        F.lit("user_id"),
        F.concat(F.lit("hash_"), size.cast("string")),
        F.concat(F.lower("p_type"), F.lit("_price")),
        F.lit("partition_0"),
        F.when(size <= 20, F.concat(F.lit("email_"), F.lower("p_type"))).otherwise(F.lit("phone")),
    )
    return (
        load(spark, sf_dir, "part")
        .select(
            F.when(size % 4 == 0, WAREHOUSE).otherwise(LAKE).alias("source"),
            F.concat(brand, F.when(size % 2 == 0, "_pii").otherwise("")).alias("db"),
            F.concat(
                F.replace(F.col("p_name"), F.lit(" "), F.lit("_")),
                F.lit("_"),
                key,
                F.when(size % 3 == 0, "_pii").otherwise(""),
            ).alias("table"),
            F.explode(names).alias("column"),
        )
        .select(
            "*",
            F.lit("string").alias("type"),
            (F.col("column") == "partition_0").alias("is_partition"),
        )
    )
