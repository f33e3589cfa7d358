"""One query per capability, over the sample lake or data derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.functions import hashing, text
from lethe.functions.identity import partition_text
from lethe.operators import audit, classify, erase, forecast, linkage, masking, review
from lethe.plans.rewrite import Change, Places, Run, partition_folders, purge, read_manifest
from lethe.plans.search import SearchResult, search, search_two_pass, write_hits
from lethe.plans.store import SubjectStore
from lethe.plans.workflow import erase_reviewed
from lethe.scratch import children, move, new_folder, write_table
from lethe.settings import LAKE, WAREHOUSE, Limits, Settings
from lethe.sources import catalog, files, requests
from lethe.sources import tables as scans
from lethe.sources.tables import LakeTable, in_partitions, scan_catalog_table
from samples import lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SETTINGS = Settings()
NO_COUNTRY = Settings(exclude_keys=frozenset({"nationkey"}))
ORDERS, LINEITEM = "sales_pii.orders_pii", "sales_pii.lineitem_pii"
CUSTOMER, EVENTS, SUPPLIER = "crm_pii.customer_pii", "web_pii.events_pii", "ref_pii.supplier_pii"
MONTHS = ("partition_0", "partition_1")

# Business keys of the sample tables; row ids depend on the engine's JSON text.
ROW_KEY = {
    CUSTOMER: ("custkey",),
    EVENTS: ("event_id",),
    ORDERS: ("orderkey",),
    LINEITEM: ("orderkey", "linenumber", "partkey", "suppkey", "extendedprice"),
    SUPPLIER: ("suppkey",),
}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def row_key(table: str = "table_name") -> Column:
    key = None
    for name, columns in ROW_KEY.items():
        found = F.concat_ws("/", *[F.get_json_object("row_json", f"$.{c}") for c in columns])
        condition = F.col(table) == name
        key = F.when(condition, found) if key is None else key.when(condition, found)
    return key.alias("row_key")


def find(
    spark: SparkSession, sf_dir: str, everybody: bool = False, settings: Settings = NO_COUNTRY, allow_errors: bool = False, **options
) -> SearchResult:
    """The search in the sample lake. A table that cannot be read ends it, but for queries that show the coverage."""
    tables = lake.tables(spark, sf_dir)
    subjects = lake.every_customer(spark, sf_dir) if everybody else lake.requested(spark)
    return search(
        tables,
        subjects,
        settings,
        columns=lake.columns(spark, tables),
        partition_columns=lake.PARTITIONS,
        allow_errors=allow_errors,
        **options,
    )


def find_in_warehouse(
    spark: SparkSession, sf_dir: str, everybody: bool = False, settings: Settings = NO_COUNTRY, **options
):
    tables = lake.tables(spark, sf_dir)
    subjects = lake.every_customer(spark, sf_dir) if everybody else lake.requested(spark)
    return search_two_pass(
        tables,
        subjects,
        settings,
        columns=lake.columns(spark, tables, WAREHOUSE),
        source=WAREHOUSE,
        allow_errors=False,
        **options,
    )


# -- metadata ----------------------------------------------------------------------------


@query
def meta_lake_columns(spark, sf_dir):
    """Column metadata of the lake, with the number of values each column holds."""
    tables = lake.tables(spark, sf_dir)
    columns = lake.columns(spark, tables)
    counted = None
    for name, df in tables.items():
        filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).select(
            F.lit(name).alias("name"), F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values")) for c in df.columns
            ]))
        )
        counted = filled if counted is None else counted.unionByName(filled)
    return columns.withColumn("name", text.qualify(F.col("db"), F.col("table"))).join(
        counted, ["name", "column"]
    ).select("source", "db", "table", "column", "is_partition", "n_values")


@query
def meta_warehouse_columns(spark, sf_dir):
    shop = lake.shop_catalog(spark, sf_dir)
    raw = shop.select(
        F.col("db").alias("table_schema"),
        F.col("table").alias("table_name"),
        F.col("column").alias("column_name"),
    )
    return catalog.warehouse_columns(raw).select("source", "db", "table", "column")


@query
def meta_csv_roundtrip(spark, sf_dir):
    path = new_folder(spark, "metadata")
    catalog.write_metadata_csv(lake.shop_catalog(spark, sf_dir), path)
    return catalog.read_metadata_csv(spark, path)


@query
def classification_roundtrip(spark, sf_dir):
    """All lists of a large catalog, written, edited and read back.

    The editor takes every other brand's tables out, adds a column to the keys and repeats a line.
    """
    columns = lake.shop_catalog(spark, sf_dir)
    path, edited = new_folder(spark, "lists"), new_folder(spark, "lists")
    classify.classify(columns, SETTINGS).write(path)
    changes = {
        "tables": lambda rows: rows.where(F.col("db").rlike("_[13]")),
        "candidate_keys": lambda rows: rows.unionByName(rows.select("source", F.lit("phone").alias("column"))),
        "mask_columns": lambda rows: rows.unionByName(rows.limit(1)),
    }
    for name in classify.LISTS:
        rows = spark.read.schema("source string, db string, `table` string, `column` string").json(f"{path}/{name}")
        changes.get(name, lambda rows: rows)(rows.select(*classify.LISTS[name])).write.json(f"{edited}/{name}")
    lists = classify.read_classification(spark, edited, columns)
    found = [lists.search_names(source).select(F.lit(source).alias("source"), "kind", "name") for source in (LAKE, WAREHOUSE)]
    masked = lists.mask_columns.select("source", F.lit("mask").alias("kind"), F.col("column").alias("name"))
    return found[0].unionByName(found[1]).unionByName(masked)


@query
def link_by_edited_lists(spark, sf_dir):
    """The search follows lists from which a person removed a key that links strangers."""
    columns = lake.columns(spark, lake.tables(spark, sf_dir))
    path = new_folder(spark, "lists")
    made = classify.classify(columns, SETTINGS)
    edited = {"candidate_keys": made.candidate_keys.where("column <> 'nationkey'")}
    for name in classify.LISTS:
        edited.get(name, getattr(made, name)).write.json(f"{path}/{name}")
    lists = classify.read_classification(spark, path, columns)
    return _rows(find(spark, sf_dir, everybody=True, settings=SETTINGS, lists=lists).hits)


@query
def request_list(spark, sf_dir):
    """A request file with a line per customer, each naming the person's two addresses."""
    path = new_folder(spark, "requests")
    key = F.col("c_custkey").cast("string")
    lake.load(spark, sf_dir, "customer").select(
        F.concat(
            F.lit(" given_email = ['user"), key, F.lit("@example.com', \"o'user"), key, F.lit("@x.de\"]")
        ).alias("value")
    ).write.text(path)
    return requests.subjects_from(requests.read_key_values(spark, path))


@query
def classify_databases(spark, sf_dir):
    return classify.databases(classify.lake(lake.shop_catalog(spark, sf_dir)), SETTINGS)


@query
def classify_lake_tables(spark, sf_dir):
    return classify.personal_tables(classify.lake(lake.shop_catalog(spark, sf_dir)), SETTINGS)


@query
def classify_wh_tables(spark, sf_dir):
    return classify.personal_tables(classify.warehouse(lake.shop_catalog(spark, sf_dir)), SETTINGS)


@query
def classify_wh_schemas(spark, sf_dir):
    columns = classify.warehouse(lake.shop_catalog(spark, sf_dir))
    schemas = classify.databases(columns, SETTINGS).select(
        F.lit("schema").alias("kind"), F.col("db").alias("name"), "is_personal"
    )
    names = classify.personal_table_names(columns, SETTINGS).select(
        F.lit("table").alias("kind"), F.col("table").alias("name"), F.lit(True).alias("is_personal")
    )
    return schemas.unionByName(names)


@query
def classify_wh_link_tables(spark, sf_dir):
    return classify.personal_tables_with_link(
        classify.warehouse(lake.shop_catalog(spark, sf_dir)), SETTINGS
    )


@query
def link_columns_lake(spark, sf_dir):
    return classify.link_columns(classify.lake(lake.shop_catalog(spark, sf_dir)), SETTINGS)


@query
def link_columns_wh(spark, sf_dir):
    return classify.link_columns(classify.warehouse(lake.shop_catalog(spark, sf_dir)), SETTINGS)


@query
def tables_with_link(spark, sf_dir):
    return classify.tables_with_link(lake.shop_catalog(spark, sf_dir), SETTINGS)


@query
def tables_without_link(spark, sf_dir):
    return classify.personal_tables_without_link(lake.shop_catalog(spark, sf_dir), SETTINGS)


@query
def tables_to_search(spark, sf_dir):
    return classify.tables_to_search(lake.shop_catalog(spark, sf_dir), SETTINGS)


@query
def pii_columns_lake(spark, sf_dir):
    return classify.personal_columns(classify.lake(lake.shop_catalog(spark, sf_dir)), SETTINGS)


@query
def pii_columns_wh(spark, sf_dir):
    return classify.personal_columns(classify.warehouse(lake.shop_catalog(spark, sf_dir)), SETTINGS)


@query
def candidate_keys(spark, sf_dir):
    return classify.candidate_keys(lake.shop_catalog(spark, sf_dir), SETTINGS)


@query
def set_intersect(spark, sf_dir):
    columns = classify.personal_columns(lake.shop_catalog(spark, sf_dir), SETTINGS)
    return classify.common_items(
        classify.lake(columns).select("column"), classify.warehouse(columns).select("column")
    )


@query
def mask_columns_by_table(spark, sf_dir):
    columns = lake.shop_catalog(spark, sf_dir)
    return classify.columns_in_table(columns, classify.mask_columns(columns, SETTINGS))


@query
def link_columns_by_table(spark, sf_dir):
    columns = lake.shop_catalog(spark, sf_dir)
    return classify.columns_in_table(columns, classify.link_columns(columns, SETTINGS))


# -- search ------------------------------------------------------------------------------


@query
def scan_lake_table(spark, sf_dir):
    lake.orders_pii(spark, sf_dir).createOrReplaceTempView("orders_pii_scan")
    df, columns = scan_catalog_table(spark, "orders_pii_scan")
    return df.select(
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "order_ts" else c for c in columns]
    )


@query
def scan_warehouse_filter(spark, sf_dir):
    """The plain equality scan of one warehouse table; the filter reaches the file scan."""
    return linkage.find_by_value(lake.orders_pii(spark, sf_dir), "custkey", "42").select(
        "orderkey", "custkey", "orderstatus", "totalprice"
    )


@query
def find_by_value(spark, sf_dir):
    return linkage.find_by_value(lake.lineitem_pii(spark, sf_dir), "suppkey", "7").select(
        "orderkey", "partkey", "suppkey", "linenumber", "quantity"
    )


@query
def frontier_seed(spark, sf_dir):
    return linkage.frontier_seed(lake.every_customer(spark, sf_dir), ["contact_email", "email"])


def _table_columns(spark, sf_dir) -> DataFrame:
    columns = lake.columns(spark, lake.tables(spark, sf_dir))
    personal = classify.personal_tables(columns, SETTINGS).select("source", "db", "table")
    return columns.join(personal, ["source", "db", "table"], "left_semi").select(
        text.qualify(F.col("db"), F.col("table")).alias("table_name"), "column"
    )


@query
def frontier_by_table(spark, sf_dir):
    seed = linkage.frontier_seed(lake.every_customer(spark, sf_dir), ["contact_email", "email"])
    return linkage.route(seed, _table_columns(spark, sf_dir))


@query
def harvest_keys_all(spark, sf_dir):
    return linkage.harvest(find(spark, sf_dir, everybody=True).hits)


@query
def harvest_keys_first(spark, sf_dir):
    order = {name: keys for name, keys in ROW_KEY.items()}
    found = find(spark, sf_dir, everybody=True, order_columns=order)
    return linkage.harvest(found.hits, "first")


@query
def frontier_next(spark, sf_dir):
    """Search values of pass 2, by definition: what pass 1 harvested, where it still has to be looked for."""
    found = find(spark, sf_dir, everybody=True, max_passes=1)
    return found.hits.transform(linkage.harvest).select("column", "value").distinct()


def _rows(hits: DataFrame) -> DataFrame:
    return hits.select(
        "subject", "source", "table_name", F.col("pass").cast("bigint").alias("pass"),
        "matched_column", "matched_value", row_key(),
    )


@query
def link_fixpoint(spark, sf_dir):
    return _rows(find(spark, sf_dir).hits)


@query
def link_fixpoint_everybody(spark, sf_dir):
    return _rows(find(spark, sf_dir, everybody=True).hits)


@query
def link_fixpoint_screened(spark, sf_dir):
    """A market segment's search with limits so low that no search values are broadcast: rows are screened, then shuffled."""
    tables = lake.tables(spark, sf_dir)
    low = Limits(driver_rows=0, literal_pairs=0, broadcast_rows=64, broadcast_bytes=64 * 1024)
    subjects = lake.customers_of(spark, sf_dir, "MACHINERY")
    return _rows(search(tables, subjects, NO_COUNTRY, columns=lake.columns(spark, tables), limits=low, allow_errors=False).hits)


@query
def link_fixpoint_first(spark, sf_dir):
    """Only the first row's keys are followed, by the smallest business key."""
    order = {name: keys for name, keys in ROW_KEY.items()}
    return _rows(find(spark, sf_dir, harvest="first", order_columns=order).hits)


@query
def link_open_three_passes(spark, sf_dir):
    """Tables stay open: what chains of keys reach within three passes, by definition of the query."""
    found = find(spark, sf_dir, everybody=True, close_tables=False, max_passes=3)
    return found.hits.groupBy("subject", "table_name", "pass").agg(
        F.count(F.lit(1)).alias("n_hits")
    ).withColumn("pass", F.col("pass").cast("bigint"))


@query
def link_hits_by_pass(spark, sf_dir):
    """Nothing excluded: the country links people to suppliers and on to other orders."""
    return (
        find(spark, sf_dir, settings=SETTINGS)
        .hits.groupBy(F.col("pass").cast("bigint").alias("pass"), "table_name", "matched_column")
        .agg(F.count(F.lit(1)).alias("n_hits"))
    )


@query
def link_two_pass(spark, sf_dir):
    return _rows(find_in_warehouse(spark, sf_dir, everybody=True).hits)


@query
def search_hits(spark, sf_dir):
    path = new_folder(spark, "hits")
    write_hits(find(spark, sf_dir).hits, path)
    kept = spark.read.schema(linkage.HIT_SCHEMA).parquet(path)
    return kept.select("subject", "source", "table_name", row_key())


@query
def search_coverage(spark, sf_dir):
    return find(spark, sf_dir, everybody=True, allow_errors=True).coverage().withColumn(
        "found_pass", F.col("found_pass").cast("bigint")
    )


@query
def tables_remaining(spark, sf_dir):
    found = find(spark, sf_dir, everybody=True, max_passes=1)
    wanted = found.subjects.select(
        "subject", F.explode(F.array(*[F.lit(t) for t in found.tables])).alias("table_name")
    )
    return linkage.remaining_tables(wanted, found.hits.select("subject", "table_name").distinct())


@query
def hit_counts(spark, sf_dir):
    return linkage.hit_counts(find(spark, sf_dir, everybody=True).hits)


@query
def pair_fanout(spark, sf_dir):
    return linkage.pair_fanout(find(spark, sf_dir, everybody=True).hits)


@query
def fanout_forecast(spark, sf_dir):
    """Rows that addresses and customer keys of everybody reach in each table, with the sketch's bound checked."""
    tables = lake.tables(spark, sf_dir)
    people = lake.every_customer(spark, sf_dir)
    keys = tables[CUSTOMER].select(
        F.col("email").alias("subject"), F.lit("custkey").alias("column"), F.col("custkey").cast("string").alias("value")
    )
    wanted = linkage.frontier_seed(people, ["contact_email", "email"]).unionByName(keys)
    probes = linkage.route(wanted, _table_columns(spark, sf_dir))
    searched = {CUSTOMER: ("custkey", "email"), EVENTS: ("contact_email",), ORDERS: ("custkey",)}
    bounds = forecast.forecast(forecast.key_sketch(tables, searched), probes)
    true = reduce(
        DataFrame.unionByName,
        [
            tables[name].select(F.inline(linkage.key_pairs(columns))).groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "*")
            for name, columns in searched.items()
        ],
    )
    return bounds.join(true, ["table_name", "column", "value"], "left").select(
        "table_name", "column", "value",
        F.coalesce("n", F.lit(0)).alias("n_rows"),
        (F.col("at_most") >= F.coalesce("n", F.lit(0))).alias("bounded"),
    )


@query
def row_to_json(spark, sf_dir):
    rows = review.rows_as_json(lake.events_pii(spark, sf_dir))
    fields = ("contact_email", "event_id", "event_ts", "event_type", "props", "partition_2")
    return rows.select(*[F.get_json_object("row_json", f"$.{c}").alias(c) for c in fields])


@query
def affected_files(spark, sf_dir):
    scan = lake.load(spark, sf_dir, "lineitem")
    found = scans.affected_files(scan, F.col("l_suppkey") == 7)
    return found.select(text.path_file(F.col("file_path")).alias("file_name"), "n_rows")


# -- report ------------------------------------------------------------------------------


@query
def report_annotate(spark, sf_dir):
    return review.annotate(lake.customer_pii(spark, sf_dir), LAKE, CUSTOMER)


@query
def report_placeholders(spark, sf_dir):
    status = F.col("orderstatus")
    rows = lake.orders_pii(spark, sf_dir).select(
        "orderkey",
        F.when(status == "P", F.lit(None)).when(status == "F", F.lit(float("nan")))
        .otherwise(F.col("totalprice")).alias("totalprice"),
        F.when(status == "O", F.col("order_ts")).alias("order_ts"),
        F.when(status != "O", F.col("orderpriority")).alias("orderpriority"),
    )
    return review.placeholders(rows)


@query
def subject_report(spark, sf_dir):
    """Both sources' hits of the requested people as one report, written and read back."""
    hits = find(spark, sf_dir).hits.unionByName(find_in_warehouse(spark, sf_dir).hits)
    reported = review.report(hits)
    path = new_folder(spark, "report")
    review.write_report(reported, path)
    kept = spark.read.schema(reported.schema).json(path)
    return kept.select(
        "subject", "Source", "Table Name", "update_flag", "copies", row_key("Table Name")
    )


def _decided(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Everybody's customer, event and order rows; the reviewer keeps finished orders."""
    found = find(spark, sf_dir, everybody=True)
    reported = review.report(found.hits, found.parts)
    status = F.get_json_object("row_json", "$.orderstatus")
    # no other table has the column
    decisions = reported.where((F.col("Table Name") == ORDERS) & status.isin("F", "O")).select(
        "subject",
        F.col("Source").alias("source"),
        F.col("Table Name").alias("table_name"),
        "row_id",
        F.when(status == "F", "N").otherwise("Y").alias("update_flag"),
    )
    return reported, decisions


@query
def review_decisions(spark, sf_dir):
    reported, decisions = _decided(spark, sf_dir)
    return review.apply_decisions(reported, decisions).select(
        "subject", "Source", "Table Name", "update_flag", row_key("Table Name")
    )


@query
def report_roundtrip(spark, sf_dir):
    """Written, edited and read back: the reviewer flags finished orders and takes pending ones out."""
    found = find(spark, sf_dir, everybody=True)
    reported = review.report(found.hits, found.parts)
    path, edited = new_folder(spark, "report"), new_folder(spark, "report")
    review.write_report(reported, path, buckets=32)
    written = review.read_report(spark, path)
    status = F.coalesce(F.get_json_object("row_json", "$.orderstatus"), F.lit(""))
    review.write_report(
        written.where(status != "P").withColumn(
            "update_flag", F.when(status == "F", " n").otherwise(F.col("update_flag"))
        ),
        edited,
        buckets=32,
        placed=True,
    )
    return review.apply_edits(written, review.read_report(spark, edited)).select(
        "subject", "Source", "Table Name", "update_flag", row_key("Table Name")
    )


@query
def review_filter(spark, sf_dir):
    reviewed = review.apply_decisions(*_decided(spark, sf_dir))
    return review.flagged_rows(reviewed, LAKE, "N").select(
        "subject", "Table Name", row_key("Table Name")
    )


@query
def hits_from_json(spark, sf_dir):
    schema = lake.orders_pii(spark, sf_dir).schema
    hits = find(spark, sf_dir, everybody=True).hits
    return review.read_rows(hits, ORDERS, schema).select(
        "subject", "orderkey", "custkey", "totalprice", "orderstatus",
        F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss").alias("order_ts"), "partition_1",
    )


@query
def erase_targets(spark, sf_dir):
    reviewed = review.apply_decisions(*_decided(spark, sf_dir))
    return review.erase_targets(review.flagged_rows(reviewed, LAKE), deny=[EVENTS])


@query
def partitions_touched(spark, sf_dir):
    """From numbers, as they come back without padding; months 10 to 12 stay two digits."""
    hits = find(spark, sf_dir, everybody=True).hits
    rows = review.read_rows(hits, ORDERS, lake.orders_pii(spark, sf_dir).schema).select(
        *[F.col(c).cast("int").alias(c) for c in lake.PARTITIONS]
    )
    return review.partitions_touched(rows, *lake.PARTITIONS)


@query
def hits_purge(spark, sf_dir):
    """Everybody's hits and reports in stores of 32 folders, after one person is purged; a purge writes one folder of each."""
    found = find(spark, sf_dir, everybody=True)
    hits = SubjectStore(spark, new_folder(spark, "hits"), found.hits.schema, 32)
    hits.append_hits(found)
    reported = review.report(hits.read())  # a person's report lies in the bucket of the person's hits
    reports = SubjectStore(spark, new_folder(spark, "report"), reported.schema, 32)
    reports.append(reported, placed=True)
    left = []
    for kind, store in (("hits", hits), ("report", reports)):
        written = store.purge([lake.REQUESTS[0]])
        folders = [f for f in children(spark, store.path) if "=" in f]
        table = "table_name" if kind == "hits" else "Table Name"
        left.append(
            store.read().select(
                F.lit(kind).alias("kind"),
                "subject",
                F.col(f"`{table}`").alias("table_name"),
                row_key(f"`{table}`"),
                F.lit(written).alias("n_written"),
                F.lit(len(folders) <= 32).alias("few_folders"),
            )
        )
    return _together(left)


@query
def search_probed(spark, sf_dir):
    """The coverage without the pairs that have nothing to look for."""
    return find(spark, sf_dir, everybody=True, allow_errors=True).probed()


# -- erase -------------------------------------------------------------------------------


@query
def hash_sha256(spark, sf_dir):
    return lake.customer_pii(spark, sf_dir).select(
        "custkey", hashing.sha256_hex(F.col("email")).alias("hashed")
    )


@query
def mask_column_token(spark, sf_dir):
    return masking.mask(lake.customer_pii(spark, sf_dir), ["email", "name", "acctbal", "absent"])


@query
def mask_value_hash(spark, sf_dir):
    return masking.mask(
        lake.customer_pii(spark, sf_dir), ["email", "name"], mode="value_hash", salt="pepper"
    )


@query
def mask_null(spark, sf_dir):
    return masking.mask(lake.customer_pii(spark, sf_dir), ["email", "nationkey"], mode="null")


@query
def strip_control_columns(spark, sf_dir):
    rows = review.annotate(lake.supplier_pii(spark, sf_dir), LAKE, SUPPLIER)
    return masking.strip_control_columns(rows)


@query
def partition_filter(spark, sf_dir):
    days = [("1998", "10", "03"), ("1998", "10", "04"), ("1998", "12", "31"), ("2001", "02", "09")]
    orders = lake.orders_pii(spark, sf_dir)
    return orders.where(in_partitions(lake.PARTITIONS, days)).select(
        "orderkey", "custkey", *lake.PARTITIONS
    )


@query
def pad_partition(spark, sf_dir):
    day = lake.load(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.day("o_orderdate").alias("d")
    )
    return (
        day.groupBy("y", "m", "d").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            text.date_partition(F.col("y"), F.col("m"), F.col("d")).alias("partition"),
            text.pad2(F.col("m")).alias("month"),
            "n_rows",
        )
    )


def _repeated_events(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Events reduced to columns with many identical rows; flagged are the different errors."""
    rows = lake.events_pii(spark, sf_dir).select("user_id", "event_type")
    return rows, rows.where(F.col("event_type") == "error").distinct()


def _counted(df: DataFrame) -> DataFrame:
    return df.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def erase_except_all(spark, sf_dir):
    rows, flagged = _repeated_events(spark, sf_dir)
    return _counted(erase.erase(rows, flagged, action="delete", match="counted"))


@query
def erase_anti_join(spark, sf_dir):
    rows, flagged = _repeated_events(spark, sf_dir)
    return _counted(erase.erase(rows, flagged, action="delete", match="copies"))


MASKED = ("orderstatus", "orderpriority", "totalprice")


def _order_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "orderkey", "custkey", "orderstatus", "totalprice", "orderpriority", *MONTHS
    )


@query
def erase_mask_replace(spark, sf_dir):
    """The order table with the requested people's orders masked."""
    hits = find(spark, sf_dir).hits.where(F.col("table_name") == ORDERS)
    return _order_columns(erase.erase(lake.orders_pii(spark, sf_dir), hits, columns=MASKED))


@query
def erase_delete(spark, sf_dir):
    """The order table without them."""
    hits = find(spark, sf_dir).hits.where(F.col("table_name") == ORDERS)
    return _order_columns(erase.erase(lake.orders_pii(spark, sf_dir), hits, action="delete"))


@query
def swap_check(spark, sf_dir):
    old = lake.orders_pii(spark, sf_dir)
    hits = find(spark, sf_dir).hits.where(F.col("table_name") == ORDERS)
    new = erase.erase(old, hits, columns=MASKED)
    flagged = erase.tag_flagged(old, hits).where(erase.is_flagged())
    masked = masking.mask(erase.untag(flagged), MASKED)
    return erase.swap_check(old, new, masked)


@query
def audit_partition_counts(spark, sf_dir):
    hits = find(spark, sf_dir, everybody=True).hits
    flagged = hits.where(
        (F.col("table_name") == ORDERS) & (F.get_json_object("row_json", "$.orderstatus") == "F")
    )
    tagged = erase.tag_flagged(lake.orders_pii(spark, sf_dir), flagged)
    return audit.count_changes(tagged, erase.is_flagged(), MONTHS, action="delete")


@query
def update_by_row_match(spark, sf_dir):
    """Flagged: finished orders, matched by all columns but the time."""
    orders = lake.orders_pii(spark, sf_dir)
    flagged = orders.where(F.col("orderstatus") == "F")
    return _order_columns(
        erase.update_by_row_match(orders, flagged, ["orderpriority", "custkey"])
    )


@query
def match_columns(spark, sf_dir):
    """How many different rows the match columns tell apart, by type and by name fragment."""
    customers = lake.customer_pii(spark, sf_dir)
    orders = lake.orders_pii(spark, sf_dir)
    rows = None
    for name, df in (("customer", customers), ("orders", orders)):
        for rule, fragment in (("type", None), ("name", "ts")):
            columns = masking.match_columns(df.schema, fragment)
            one = df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.lit(",".join(sorted(columns))).alias("columns"),
                "n_rows",
            )
            rows = one if rows is None else rows.unionByName(one)
    return rows


@query
def update_script(spark, sf_dir):
    customers = lake.customer_pii(spark, sf_dir).withColumn(
        "name", F.when(F.col("mktsegment") != "MACHINERY", F.concat("name", F.lit("'s")))
    )
    flagged = review.annotate(customers, WAREHOUSE, CUSTOMER)
    return masking.update_script(flagged, CUSTOMER, ["email", "name", "nationkey"])


#: How the sample tables with personal rows are stored.
STORED = {CUSTOMER: (), EVENTS: MONTHS, ORDERS: MONTHS, LINEITEM: MONTHS, SUPPLIER: ()}
MASKED_TEXTS = {
    CUSTOMER: ("email", "name"),
    EVENTS: ("contact_email", "props"),
    ORDERS: ("orderstatus", "orderpriority"),
    LINEITEM: ("returnflag", "linestatus"),
    SUPPLIER: ("name",),
}
MASKED_ANYWHERE = tuple(sorted({c for columns in MASKED_TEXTS.values() for c in columns}))


def _stored_lake(spark, sf_dir) -> dict[str, LakeTable]:
    """Writable copies of all tables with personal rows, partitioned by month or not at all."""
    stored = {}
    for name, columns in STORED.items():
        path, df = new_folder(spark, "table"), lake.VIEWS[name](spark, sf_dir)
        if name == LINEITEM:
            df = df.select("*", *lake.day_parts("ship_ts"))
        if columns:
            df.drop("partition_2").hint("rebalance", *columns).write.partitionBy(*columns).parquet(path)
        else:
            df.write.parquet(path)
        stored[name] = LakeTable(name, path, columns, schema=spark.read.parquet(path).schema)
    return stored


def _rewritten(
    spark, sf_dir, change: Change, subjects: DataFrame | None = None, stored=None, **options
) -> tuple[dict[str, LakeTable], Places, dict[str, DataFrame]]:
    """Search, report, review and rewrite of every table with hits; the audits by table."""
    stored = stored or _stored_lake(spark, sf_dir)
    tables = {**lake.tables(spark, sf_dir), **{name: t.read(spark) for name, t in stored.items()}}
    found = search(
        tables,
        lake.requested(spark) if subjects is None else subjects,
        NO_COUNTRY,
        columns=lake.columns(spark, tables),
        partition_columns=MONTHS,
    )
    root = new_folder(spark, "erase")
    places = Places(f"{root}/backups", f"{root}/stage", f"{root}/records")
    audits = erase_reviewed(
        spark, stored, review.report(found.hits, found.parts), places, "run1", change, coverage=found.coverage(), **options
    )
    return stored, places, audits


def _shown(df: DataFrame, name: str) -> DataFrame:
    """Key, partition and the columns to mask of each row, alike for all tables."""
    texts = [F.coalesce(F.col(c), F.lit("null")) for c in MASKED_TEXTS[name]]
    return df.select(
        F.lit(name).alias("table_name"),
        F.concat_ws("/", *[F.col(c).cast("string") for c in ROW_KEY[name]]).alias("row_key"),
        partition_text(STORED[name]).alias("partition"),
        F.concat_ws("|", *texts).alias("masked"),
    )


def _together(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@query
def erase_partition_rewrite(spark, sf_dir):
    """All rows of all tables after the requested people's rows are masked."""
    stored, _, _ = _rewritten(spark, sf_dir, Change("mask", MASKED_ANYWHERE))
    return _together(_shown(t.read(spark), name) for name, t in stored.items())


@query
def erase_partition_delete(spark, sf_dir):
    """All customers of a market segment ask; what is gone and what is left, by table."""
    subjects = lake.customers_of(spark, sf_dir, "MACHINERY")
    stored, _, audits = _rewritten(spark, sf_dir, Change("delete"), subjects)
    rows = F.count(F.lit(1)).alias("n_rows")
    left = _together(t.read(spark).agg(rows).select(F.lit(n).alias("table_name"), "n_rows") for n, t in stored.items())
    gone = _together(
        a.agg(F.sum("n_flagged").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, a in audits.items()
    )
    return gone.withColumn("what", F.lit("gone")).unionByName(left.withColumn("what", F.lit("left"))).where("n_rows > 0")


@query
def update_rewrite(spark, sf_dir):
    """The row-match update on storage: rows equal to a found one but for the time."""
    stored, _, _ = _rewritten(spark, sf_dir, Change("mask", MASKED_ANYWHERE, match="columns"))
    return _together(_shown(t.read(spark), name) for name, t in stored.items())


@query
def audit_rewrite(spark, sf_dir):
    _, _, audits = _rewritten(spark, sf_dir, Change("mask", MASKED_ANYWHERE))
    counts = ("partition", "n_before", "n_flagged", "n_after", "passed")
    return _together(a.select(F.lit(name).alias("table_name"), *counts) for name, a in audits.items())


@query
def backup_snapshot(spark, sf_dir):
    """The touched partitions of all tables as they were before the masking."""
    change = Change("mask", MASKED_ANYWHERE)
    stored, places, audits = _rewritten(spark, sf_dir, change)
    return _together(_shown(Run(spark, stored[name], places, "run1", change).backup(), name) for name in audits)


def _file_sums(spark, stored: dict[str, LakeTable]) -> DataFrame:
    """Checksums of all files of all tables as they lie now, kept as a table."""
    sums = _together(
        files.checksums(files.list_files(spark, [t.path])).withColumn("table_name", F.lit(name)) for name, t in stored.items()
    )
    return write_table(sums, new_folder(spark, "sums"))


@query
def backup_files(spark, sf_dir):
    """All tables backed up file by file, masked and restored: by partition, the rows kept in copies with the bytes of
    the originals, whether the masking changed the files, and whether the very same files are back."""
    stored = _stored_lake(spark, sf_dir)
    before = _file_sums(spark, stored)
    change = Change("mask", MASKED_ANYWHERE)
    _, places, audits = _rewritten(spark, sf_dir, change, stored=stored, backup="files")
    runs = {name: Run(spark, stored[name], places, "run1", change) for name in audits}
    masked = _file_sums(spark, stored)
    for run in runs.values():
        run.restore()
    after = _file_sums(spark, stored)
    shown = []
    for name, run in runs.items():
        told = run.backup_files().select(F.col("source").alias("path"), "target", F.struct("length", "sha256").alias("told"))
        own = [
            sums.where(F.col("table_name") == name).select("path", F.struct("length", "sha256").alias(label))
            for label, sums in (("before", before), ("masked", masked), ("after", after))
        ]
        joined = told.join(own[0], "path", "left").join(own[1], "path", "left").join(own[2], "path", "left")
        address = F.col("_metadata.file_path")
        rows = run.backup().groupBy(partition_text(STORED[name]).alias("partition"), address.alias("address")).agg(
            F.count(F.lit(1)).alias("n_rows")
        )
        parts = len(STORED[name]) + 1  # a file's name is unique in its partition only

        def file(path: str, parts=parts) -> Column:
            return F.array_join(F.slice(F.split(path, "/"), -parts, parts), "/")

        by_file = rows.withColumn("file", file("address")).join(joined.withColumn("file", file("target")), "file", "left")
        shown.append(
            by_file.groupBy("partition").agg(
                F.sum("n_rows").alias("n_rows"),
                F.bool_and(F.coalesce(F.col("told") == F.col("before"), F.lit(False))).alias("same_bytes"),
                F.bool_and(~F.col("told").eqNullSafe(F.col("masked"))).alias("changed"),
                F.bool_and(F.coalesce(F.col("told") == F.col("after"), F.lit(False))).alias("restored"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return _together(shown)


@query
def backup_manifest(spark, sf_dir):
    _, places, _ = _rewritten(spark, sf_dir, Change("mask", MASKED_ANYWHERE))
    return read_manifest(spark, places).select("run_id", "subject", "table_name", "partition")


@query
def backup_purge(spark, sf_dir):
    """What is left of the backups after one person's are purged."""
    _, places, _ = _rewritten(spark, sf_dir, Change("mask", MASKED_ANYWHERE))
    purge(spark, places, lake.REQUESTS[0])
    return read_manifest(spark, places).select("run_id", "subject", "table_name", "partition")


def _masked_in(spark, sf_dir, stored: LakeTable, table: DataFrame) -> LakeTable:
    """The requested people's rows masked in one further table beside the sample tables, which stay as they are."""
    tables = {name: df for name, df in lake.tables(spark, sf_dir).items() if name != ORDERS} | {stored.name: table}
    columns = catalog.columns_of(spark, tables, LAKE, (*lake.PARTITIONS, *stored.partition_columns))
    found = search(
        tables, lake.requested(spark), NO_COUNTRY, columns=columns, partition_columns=stored.partition_columns
    )
    root = new_folder(spark, "erase")
    places = Places(f"{root}/backups", f"{root}/stage", f"{root}/records")
    reported = review.report(found.hits.where(F.col("table_name") == stored.name))
    change = Change("mask", MASKED_TEXTS[ORDERS])
    erase_reviewed(spark, {stored.name: stored}, reported, places, "run1", change, coverage=found.coverage())
    return stored


def _shown_orders(df: DataFrame, partitions) -> DataFrame:
    return df.select("orderkey", "orderstatus", "orderpriority", partition_text(partitions).alias("partition"))


@query
def erase_typed_partition(spark, sf_dir):
    """A table of the catalog, found by its name, whose partition columns are numbers and dates."""
    orders = lake.orders_pii(spark, sf_dir).drop(*lake.PARTITIONS)
    month = F.trunc("order_ts", "month").alias("order_month")
    orders = orders.select("*", F.year("order_ts").alias("order_year"), month)
    root = new_folder(spark, "typed")
    name = "sales_pii.orders_pii_" + root.rsplit("-", 1)[-1]
    spark.sql("CREATE DATABASE IF NOT EXISTS sales_pii")
    partitions = ("order_year", "order_month")
    writer = orders.hint("rebalance", *partitions).write.partitionBy(*partitions)
    writer.format("parquet").option("path", root).saveAsTable(name)
    _masked_in(spark, sf_dir, LakeTable.from_catalog(spark, name), spark.table(name))
    return _shown_orders(spark.table(name), partitions)


@query
def erase_plain_folders(spark, sf_dir):
    """A table in folders ``yyyy/MM`` without the columns' names."""
    path, keyed = new_folder(spark, "plain"), new_folder(spark, "keyed")
    lake.orders_pii(spark, sf_dir).drop("partition_2").hint("rebalance", *MONTHS).write.partitionBy(*MONTHS).parquet(keyed)
    stored = LakeTable(ORDERS, path, MONTHS, schema=spark.read.parquet(keyed).schema, layout="plain")
    for values, folder in partition_folders(LakeTable(ORDERS, keyed, MONTHS).read(spark), MONTHS).items():
        move(spark, folder, stored.folder(values))
    _masked_in(spark, sf_dir, stored, stored.read(spark))
    return _shown_orders(stored.read(spark), MONTHS)


# -- scalar ------------------------------------------------------------------------------


@query
def qualify_name(spark, sf_dir):
    shop = lake.shop_catalog(spark, sf_dir).select("db", "table").distinct()
    name = text.qualify(F.col("db"), F.col("table"))
    return shop.select(
        name.alias("qualified"), text.db_part(name).alias("db"), text.table_part(name).alias("table")
    )


@query
def text_between(spark, sf_dir):
    pages = lake.load(spark, sf_dir, "pages")
    return pages.select("page_id", text.text_between(F.col("html"), "<title>", "</title>").alias("title"))


@query
def path_parts(spark, sf_dir):
    url = F.col("url")
    return lake.load(spark, sf_dir, "pages").select(
        "page_id",
        text.path_bucket(url).alias("bucket"),
        text.path_key(url).alias("key"),
        text.path_file(url).alias("file"),
        text.path_extension(url).alias("extension"),
    )
