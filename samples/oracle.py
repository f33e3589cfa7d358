"""The same queries in SQL over the given tables, for comparison."""

from __future__ import annotations

from samples.lake import REQUESTS

LAKE_VIEWS = """
customer_pii AS (
  SELECT 'user' || c_custkey || '@example.com' AS email, c_custkey AS custkey, c_name AS name,
         c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer),
events_pii AS (
  SELECT 'user' || user_id || '@example.com' AS contact_email, event_id, user_id, ts AS event_ts,
         event_type, value, props, strftime(ts, '%Y') AS partition_0,
         strftime(ts, '%m') AS partition_1, strftime(ts, '%d') AS partition_2 FROM events),
orders_pii AS (
  SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS orderstatus,
         o_totalprice AS totalprice, o_orderdate AS order_ts, o_orderpriority AS orderpriority,
         strftime(o_orderdate, '%Y') AS partition_0, strftime(o_orderdate, '%m') AS partition_1,
         strftime(o_orderdate, '%d') AS partition_2 FROM orders),
lineitem_pii AS (
  SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey,
         l_linenumber AS linenumber, l_quantity AS quantity, l_extendedprice AS extendedprice,
         l_discount AS discount, l_tax AS tax, l_returnflag AS returnflag,
         l_linestatus AS linestatus, l_shipdate AS ship_ts FROM lineitem),
supplier_pii AS (
  SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal
  FROM supplier)"""

_TABLES = {
    "crm_pii.customer_pii": ("customer_pii", "custkey", ("email", "custkey", "nationkey")),
    "web_pii.events_pii": ("events_pii", "event_id", ("contact_email", "event_id", "user_id")),
    "sales_pii.orders_pii": ("orders_pii", "orderkey", ("orderkey", "custkey")),
    "sales_pii.lineitem_pii": (
        "lineitem_pii",
        "orderkey || '/' || linenumber || '/' || partkey || '/' || suppkey || '/' || extendedprice",
        ("orderkey", "partkey", "suppkey"),
    ),
    "ref_pii.supplier_pii": ("supplier_pii", "suppkey", ("suppkey", "nationkey")),
}
TABLE_NAMES = ", ".join(f"('{t}')" for t in _TABLES)


def _cells(exclude: set[str]) -> str:
    """Every key value of every row: (table_name, row_key, col, val)."""
    parts = [
        f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS row_key, '{c}' AS col, "
        f"CAST({c} AS VARCHAR) AS val FROM {view} WHERE {c} IS NOT NULL"
        for name, (view, key, columns) in _TABLES.items()
        for c in columns
        if c not in exclude
    ]
    return "cells AS MATERIALIZED (\n  " + "\n  UNION ALL ".join(parts) + ")"


def _subjects(everybody: bool | str) -> str:
    """The requested people, every customer, or those of a market segment."""
    if isinstance(everybody, str):
        return f"subjects AS (SELECT DISTINCT email AS subject FROM customer_pii WHERE mktsegment = '{everybody}')"
    if everybody:
        return "subjects AS (SELECT DISTINCT email AS subject FROM customer_pii)"
    values = ", ".join(f"('{s}')" for s in REQUESTS)
    return f"subjects AS (SELECT subject FROM (VALUES {values}) v(subject))"


# The business key by its parts, as numbers.
_KEY_PARTS = ", ".join(f"TRY_CAST(split_part(row_key, '/', {i}) AS DOUBLE)" for i in range(1, 6))


def search_ctes(
    everybody: bool | str = False,
    passes: int = 5,
    exclude: set[str] = frozenset({"nationkey"}),
    first_match: bool = False,
    harvest_first: bool = False,
    close: bool = True,
    source: str = "DataLake",
    prefix: str = "",
    base: bool = True,
) -> str:
    """The passes written out one by one; the last CTE is ``<prefix>hits``."""
    p = prefix
    ctes = [LAKE_VIEWS.strip(), _cells(exclude), _subjects(everybody)] if base else []
    ctes.append(
        f"{p}f1 AS (SELECT subject, c.col, subject AS val FROM subjects, "
        "(VALUES ('email'), ('contact_email')) c(col))"
    )
    done: list[str] = []
    for n in range(1, passes + 1):
        open_only = ""
        if done and close:
            earlier = " UNION ALL ".join(f"SELECT subject, table_name FROM {h}" for h in done)
            open_only = f" WHERE (f.subject, c.table_name) NOT IN (SELECT subject, table_name FROM ({earlier}))"
        found = (
            f"SELECT f.subject, '{source}' AS source, c.table_name, CAST({n} AS BIGINT) AS pass, "
            f"c.col AS matched_column, c.val AS matched_value, c.row_key FROM {p}f{n} f "
            f"JOIN cells c ON f.col = c.col AND f.val = c.val{open_only}"
        )
        if first_match and n > 1:
            found += (
                " QUALIFY dense_rank() OVER (PARTITION BY f.subject, c.table_name "
                "ORDER BY c.col, c.val) = 1"
            )
        ctes.append(f"{p}h{n} AS MATERIALIZED ({found})")
        rows = f"{p}h{n}"
        if harvest_first:
            rows = (
                f"(SELECT * FROM {p}h{n} QUALIFY row_number() OVER (PARTITION BY subject, table_name, "
                f"matched_column, matched_value ORDER BY {_KEY_PARTS}) = 1)"
            )
        new = (
            f"SELECT DISTINCT h.subject, c.col, c.val FROM {rows} h JOIN cells c "
            "ON h.table_name = c.table_name AND h.row_key = c.row_key AND h.matched_column <> c.col"
        )
        if not close:
            seen = " UNION ALL ".join(f"SELECT subject, col, val FROM {p}f{i}" for i in range(1, n + 1))
            new += f" WHERE (h.subject, c.col, c.val) NOT IN (SELECT subject, col, val FROM ({seen}))"
        ctes.append(f"{p}f{n + 1} AS MATERIALIZED ({new})")
        done.append(f"{p}h{n}")
    union = " UNION ALL ".join(f"SELECT * FROM {h}" for h in done)
    ctes.append(f"{p}hits AS ({union})")
    return ",\n".join(ctes)


def _search(select: str, **options) -> str:
    return f"WITH {search_ctes(**options)}\n{select}"


SHOP = """
shop_names AS (
  SELECT CASE WHEN p_size % 4 = 0 THEN 'Redshift' ELSE 'DataLake' END AS source,
         lower(replace(p_brand, '#', '_')) || CASE WHEN p_size % 2 = 0 THEN '_pii' ELSE '' END AS db,
         replace(p_name, ' ', '_') || '_' || p_partkey
           || CASE WHEN p_size % 3 = 0 THEN '_pii' ELSE '' END AS "table",
         unnest(['partkey', 'name', 'user_id', 'hash_' || p_size, lower(p_type) || '_price',
                 'partition_0',
                 CASE WHEN p_size <= 20 THEN 'email_' || lower(p_type) ELSE 'phone' END]) AS "column"
  FROM part),
shop AS (
  SELECT *, 'string' AS type, "column" = 'partition_0' AS is_partition,
         db || '.' || "table" AS qualified,
         CASE WHEN source = 'Redshift' THEN contains(db || '.' || "table", 'pii')
              ELSE contains(db, 'pii') AND contains("table", 'pii') END AS personal,
         contains("column", 'email') AS is_link
  FROM shop_names),
shop_personal_columns AS (
  SELECT DISTINCT source, "column" FROM shop
  WHERE NOT is_link AND NOT is_partition
    AND CASE WHEN source = 'Redshift' THEN contains("table", 'pii') ELSE personal END),
shop_link_columns AS (
  SELECT DISTINCT source, "column" FROM shop WHERE is_link AND (source = 'Redshift' OR personal))"""


def _shop(select: str) -> str:
    return f"WITH {SHOP.strip()}\n{select}"


def _lake(select: str) -> str:
    return f"WITH {LAKE_VIEWS.strip()}\n{select}"


_TABLE_COLUMNS = 'SELECT DISTINCT source, db, "table", qualified FROM shop WHERE '
_ROWS = "SELECT subject, source, table_name, pass, matched_column, matched_value, row_key FROM hits"
_ORDER_COLUMNS = "orderkey, custkey, orderstatus, totalprice, orderpriority, partition_0, partition_1"
_FLAGGED = "SELECT row_key FROM hits WHERE table_name = 'sales_pii.orders_pii'"
_MASKED_ORDERS = (
    "SELECT orderkey, custkey, "
    "CASE WHEN hit THEN sha256('orderstatus') ELSE orderstatus END AS orderstatus, "
    "CASE WHEN NOT hit THEN totalprice END AS totalprice, "
    "CASE WHEN hit THEN sha256('orderpriority') ELSE orderpriority END AS orderpriority, "
    "partition_0, partition_1 FROM (SELECT *, CAST(orderkey AS VARCHAR) IN "
    f"({_FLAGGED}) AS hit FROM orders_pii)"
)
# The stored tables: partition, and the columns that are masked.
_MONTH = "strftime({0}, '%Y') || '/' || strftime({0}, '%m')"
_STORED = {
    "crm_pii.customer_pii": ("CAST(NULL AS VARCHAR)", ("email", "name")),
    "web_pii.events_pii": (_MONTH.format("event_ts"), ("contact_email", "props")),
    "sales_pii.orders_pii": (_MONTH.format("order_ts"), ("orderstatus", "orderpriority")),
    "sales_pii.lineitem_pii": (_MONTH.format("ship_ts"), ("returnflag", "linestatus")),
    "ref_pii.supplier_pii": ("CAST(NULL AS VARCHAR)", ("name",)),
}


def _stored_rows() -> str:
    """Every row of every stored table: (table_name, row_key, partition, kept, token, hit)."""
    parts = []
    for name, (partition, masked) in _STORED.items():
        view, key, _ = _TABLES[name]
        kept = " || '|' || ".join(f"coalesce({c}, 'null')" for c in masked)
        token = " || '|' || ".join(f"sha256('{c}')" for c in masked)
        parts.append(
            f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS row_key, {partition} AS partition, "
            f"{kept} AS kept, {token} AS token FROM {view}"
        )
    union = " UNION ALL ".join(parts)
    return (
        f"stored AS (SELECT *, (table_name, row_key) IN (SELECT table_name, row_key FROM hits) AS hit FROM ({union})),\n"
        "touched AS (SELECT DISTINCT h.subject, s.table_name, s.partition, coalesce(s.partition, '') AS place "
        "FROM hits h JOIN stored s USING (table_name, row_key))"
    )


def _stored(select: str, **options) -> str:
    return f"WITH {search_ctes(**options)},\n{_stored_rows()}\n{select}"




def _masked_in(partition: str) -> str:
    hit = f"CAST(orderkey AS VARCHAR) IN ({_FLAGGED})"
    masked = ", ".join(f"CASE WHEN {hit} THEN sha256('{c}') ELSE {c} END AS {c}" for c in ("orderstatus", "orderpriority"))
    return _search(f"SELECT orderkey, {masked}, {partition} AS partition FROM orders_pii")


_PLACE = "(table_name, coalesce(partition, ''))"
_MASKED_ROWS = "SELECT table_name, row_key, partition, CASE WHEN hit THEN token ELSE kept END AS masked FROM stored"
_MANIFEST = "SELECT 'run1' AS run_id, subject, table_name, partition FROM touched"

_COVERAGE = (
    "SELECT s.subject, 'DataLake' AS source, t.table_name, "
    "CASE WHEN count(h.subject) > 0 THEN 'hit' WHEN bool_or(p.subject IS NOT NULL) THEN 'no_value' "
    "ELSE 'no_column' END AS status, min(h.pass) AS found_pass, count(h.subject) AS n_hits "
    f"FROM subjects s CROSS JOIN (VALUES {TABLE_NAMES}) t(table_name) "
    "LEFT JOIN hits h ON h.subject = s.subject AND h.table_name = t.table_name "
    "LEFT JOIN (SELECT DISTINCT f.subject, c.table_name FROM (SELECT * FROM f1 UNION ALL "
    "SELECT * FROM f2 UNION ALL SELECT * FROM f3 UNION ALL SELECT * FROM f4 UNION ALL "
    "SELECT * FROM f5) f JOIN (SELECT DISTINCT table_name, col FROM cells) c ON f.col = c.col) p "
    "ON p.subject = s.subject AND p.table_name = t.table_name GROUP BY ALL"
)

_LAKE_METADATA = {
    "crm_pii.customer_pii": ("customer_pii", "email custkey name nationkey acctbal mktsegment"),
    "web_pii.events_pii": (
        "events_pii",
        "contact_email event_id user_id event_ts event_type value props "
        "partition_0 partition_1 partition_2",
    ),
    "sales_pii.orders_pii": (
        "orders_pii",
        "orderkey custkey orderstatus totalprice order_ts orderpriority "
        "partition_0 partition_1 partition_2",
    ),
    "sales_pii.lineitem_pii": (
        "lineitem_pii",
        "orderkey partkey suppkey linenumber quantity extendedprice discount tax returnflag "
        "linestatus ship_ts",
    ),
    "ref_pii.supplier_pii": ("supplier_pii", "suppkey name nationkey acctbal"),
    "crm_pii.nation": ("nation_v", "nationkey name regionkey"),
    "ref.part": ("part_v", "partkey name brand type size retailprice"),
}


def _lake_metadata() -> str:
    plain = (
        ",\nnation_v AS (SELECT n_nationkey AS nationkey, n_name AS name, n_regionkey AS regionkey "
        "FROM nation),\npart_v AS (SELECT p_partkey AS partkey, p_name AS name, p_brand AS brand, "
        "p_type AS type, p_size AS size, p_retailprice AS retailprice FROM part)\n"
    )
    parts = []
    for name, (view, columns) in _LAKE_METADATA.items():
        db, table = name.split(".")
        for c in columns.split():
            parts.append(
                f"SELECT 'DataLake' AS source, '{db}' AS db, '{table}' AS \"table\", '{c}' AS \"column\", "
                f"{str(c.startswith('partition_')).lower()} AS is_partition, "
                f"count({c}) AS n_values FROM {view}"
            )
    return f"WITH {LAKE_VIEWS.strip()}{plain}" + "\nUNION ALL ".join(parts)


def _match_columns() -> str:
    rules = {
        ("customer", "type"): ("customer_pii", "acctbal,custkey,email,mktsegment,name,nationkey"),
        ("customer", "name"): ("customer_pii", "acctbal,custkey,email,name,nationkey"),
        ("orders", "type"): (
            "orders_pii",
            "custkey,orderkey,orderpriority,orderstatus,partition_0,partition_1,partition_2,totalprice",
        ),
        ("orders", "name"): (
            "orders_pii",
            "custkey,orderkey,orderpriority,orderstatus,partition_0,partition_1,partition_2,totalprice",
        ),
    }
    parts = [
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{columns}' AS columns, count(*) AS n_rows "
        f"FROM (SELECT DISTINCT {columns} FROM {view})"
        for (t, rule), (view, columns) in rules.items()
    ]
    return _lake("\nUNION ALL ".join(parts))


_REPEATED = (
    "ev AS (SELECT user_id, event_type FROM events), "
    "flagged AS (SELECT DISTINCT user_id, event_type FROM ev WHERE event_type = 'error') "
)

ORACLE: dict[str, str] = {
    # metadata
    "meta_lake_columns": _lake_metadata(),
    "meta_warehouse_columns": _shop(
        "SELECT 'Redshift' AS source, db, \"table\", \"column\" FROM shop"
    ),
    "meta_csv_roundtrip": _shop(
        'SELECT source, db, "table", "column", type, is_partition FROM shop'
    ),
    "classification_roundtrip": _shop(
        "SELECT DISTINCT source, 'table' AS kind, qualified AS name FROM shop WHERE personal "
        "AND regexp_matches(db, '_[13]') "
        "UNION ALL SELECT source, 'link', \"column\" FROM shop_link_columns "
        "UNION ALL SELECT source, 'key', \"column\" FROM shop_personal_columns WHERE contains(\"column\", 'key') "
        "OR contains(\"column\", 'id') OR contains(\"column\", 'hash') "
        "UNION ALL SELECT DISTINCT source, 'key', 'phone' FROM shop_personal_columns "
        "UNION ALL (SELECT source, 'mask', \"column\" FROM shop_personal_columns "
        "UNION SELECT source, 'mask', \"column\" FROM shop_link_columns)"
    ),
    "link_by_edited_lists": _search(_ROWS, everybody=True),
    "request_list": (
        "SELECT 'user' || c_custkey || '@example.com' AS subject FROM customer UNION "
        "SELECT 'o''user' || c_custkey || '@x.de' FROM customer"
    ),
    "classify_databases": _shop(
        "SELECT DISTINCT source, db, contains(db, 'pii') AS is_personal FROM shop "
        "WHERE source = 'DataLake'"
    ),
    "classify_lake_tables": _shop(_TABLE_COLUMNS + "source = 'DataLake' AND personal"),
    "classify_wh_tables": _shop(_TABLE_COLUMNS + "source = 'Redshift' AND personal"),
    "classify_wh_schemas": _shop(
        "SELECT DISTINCT 'schema' AS kind, db AS name, contains(db, 'pii') AS is_personal FROM shop "
        "WHERE source = 'Redshift' UNION ALL SELECT DISTINCT 'table', \"table\", true FROM shop "
        "WHERE source = 'Redshift' AND contains(\"table\", 'pii')"
    ),
    "classify_wh_link_tables": _shop(
        _TABLE_COLUMNS
        + "source = 'Redshift' AND personal AND is_link"
    ),
    "link_columns_lake": _shop("SELECT * FROM shop_link_columns WHERE source = 'DataLake'"),
    "link_columns_wh": _shop("SELECT * FROM shop_link_columns WHERE source = 'Redshift'"),
    "tables_with_link": _shop(_TABLE_COLUMNS + "is_link"),
    "tables_without_link": _shop(
        _TABLE_COLUMNS
        + "personal AND (source, qualified) NOT IN (SELECT source, qualified FROM shop WHERE is_link)"
    ),
    "tables_to_search": _shop(
        _TABLE_COLUMNS
        + "personal AND is_link UNION "
        + _TABLE_COLUMNS
        + "personal AND (source, qualified) NOT IN (SELECT source, qualified FROM shop WHERE is_link)"
    ),
    "pii_columns_lake": _shop("SELECT * FROM shop_personal_columns WHERE source = 'DataLake'"),
    "pii_columns_wh": _shop("SELECT * FROM shop_personal_columns WHERE source = 'Redshift'"),
    "candidate_keys": _shop(
        "SELECT * FROM shop_personal_columns WHERE contains(\"column\", 'key') "
        "OR contains(\"column\", 'id') OR contains(\"column\", 'hash')"
    ),
    "set_intersect": _shop(
        "SELECT \"column\" FROM shop_personal_columns WHERE source = 'DataLake' INTERSECT "
        "SELECT \"column\" FROM shop_personal_columns WHERE source = 'Redshift'"
    ),
    "mask_columns_by_table": _shop(
        'SELECT source, db, "table", "column" FROM shop WHERE (source, "column") IN '
        "(SELECT * FROM shop_personal_columns UNION ALL SELECT * FROM shop_link_columns)"
    ),
    "link_columns_by_table": _shop(
        'SELECT source, db, "table", "column" FROM shop WHERE (source, "column") IN '
        "(SELECT * FROM shop_link_columns)"
    ),
    # search
    "scan_lake_table": _lake(
        "SELECT * REPLACE (strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts) FROM orders_pii"
    ),
    "scan_warehouse_filter": (
        "SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS orderstatus, "
        "o_totalprice AS totalprice FROM orders WHERE CAST(o_custkey AS VARCHAR) = '42'"
    ),
    "find_by_value": (
        "SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey, "
        "l_linenumber AS linenumber, l_quantity AS quantity FROM lineitem "
        "WHERE CAST(l_suppkey AS VARCHAR) = '7'"
    ),
    "frontier_seed": _lake(
        'SELECT email AS subject, c.col AS "column", email AS value FROM customer_pii, '
        "(VALUES ('email'), ('contact_email')) c(col)"
    ),
    "frontier_by_table": _lake(
        "SELECT email AS subject, 'email' AS \"column\", email AS value, "
        "'crm_pii.customer_pii' AS table_name FROM customer_pii UNION ALL "
        "SELECT email, 'contact_email', email, 'web_pii.events_pii' FROM customer_pii"
    ),
    "harvest_keys_all": _search(
        'SELECT subject, col AS "column", val AS value FROM f2 '
        + " ".join(f"UNION SELECT * FROM f{n}" for n in range(3, 7)),
        everybody=True,
    ),
    "harvest_keys_first": _search(
        "SELECT DISTINCT h.subject, c.col AS \"column\", c.val AS value FROM (SELECT * FROM hits "
        "QUALIFY row_number() OVER (PARTITION BY subject, table_name, matched_column, matched_value "
        f"ORDER BY {_KEY_PARTS}) = 1) h JOIN cells c ON h.table_name = c.table_name "
        "AND h.row_key = c.row_key AND h.matched_column <> c.col",
        everybody=True,
    ),
    "frontier_next": _search(
        'SELECT DISTINCT col AS "column", val AS value FROM f2', everybody=True, passes=1
    ),
    "link_fixpoint": _search(_ROWS),
    "link_fixpoint_everybody": _search(_ROWS, everybody=True),
    "link_fixpoint_screened": _search(_ROWS, everybody="MACHINERY"),
    "link_fixpoint_first": _search(_ROWS, harvest_first=True),
    "link_open_three_passes": _search(
        "SELECT subject, table_name, pass, count(*) AS n_hits FROM hits GROUP BY ALL",
        everybody=True,
        passes=3,
        close=False,
    ),
    "link_hits_by_pass": _search(
        "SELECT pass, table_name, matched_column, count(*) AS n_hits FROM hits GROUP BY ALL",
        exclude=set(),
    ),
    "link_two_pass": _search(
        _ROWS, everybody=True, passes=2, first_match=True, source="Redshift"
    ),
    "search_hits": _search("SELECT subject, source, table_name, row_key FROM hits"),
    "search_coverage": _search(_COVERAGE, everybody=True),
    "search_probed": _search(f"SELECT * FROM ({_COVERAGE}) WHERE status <> 'no_column'", everybody=True),
    "hits_purge": _search(
        "SELECT 'hits' AS kind, subject, table_name, row_key, 1 AS n_written, true AS few_folders FROM hits "
        f"WHERE subject <> '{REQUESTS[0]}' UNION ALL SELECT DISTINCT 'report', subject, table_name, row_key, 1, true FROM hits "
        f"WHERE subject <> '{REQUESTS[0]}'",
        everybody=True,
    ),
    "tables_remaining": _search(
        f"SELECT s.subject, t.table_name FROM subjects s CROSS JOIN (VALUES {TABLE_NAMES}) "
        "t(table_name) WHERE (s.subject, t.table_name) NOT IN (SELECT subject, table_name FROM hits)",
        everybody=True,
        passes=1,
    ),
    "hit_counts": _search(
        "SELECT subject, source, table_name, count(*) AS n_hits FROM hits GROUP BY ALL",
        everybody=True,
    ),
    "pair_fanout": _search(
        "SELECT table_name, matched_column, matched_value, count(*) AS n_hits FROM hits GROUP BY ALL",
        everybody=True,
    ),
    "fanout_forecast": _lake(
        "SELECT 'crm_pii.customer_pii' AS table_name, 'email' AS \"column\", email AS value, 1 AS n_rows, true AS bounded "
        "FROM customer_pii "
        "UNION ALL SELECT 'crm_pii.customer_pii', 'custkey', CAST(custkey AS VARCHAR), 1, true FROM customer_pii "
        "UNION ALL SELECT 'web_pii.events_pii', 'contact_email', c.email, count(e.event_id), true "
        "FROM customer_pii c LEFT JOIN events_pii e ON e.contact_email = c.email GROUP BY c.email "
        "UNION ALL SELECT 'sales_pii.orders_pii', 'custkey', CAST(c.custkey AS VARCHAR), count(o.orderkey), true "
        "FROM customer_pii c LEFT JOIN orders_pii o ON o.custkey = c.custkey GROUP BY c.custkey"
    ),
    "row_to_json": _lake(
        "SELECT contact_email, CAST(event_id AS VARCHAR) AS event_id, "
        "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts, event_type, props, partition_2 "
        "FROM events_pii"
    ),
    "affected_files": (
        "SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows FROM lineitem WHERE l_suppkey = 7"
    ),
    # report
    "report_annotate": _lake(
        "SELECT 'DataLake' AS \"Source\", 'crm_pii.customer_pii' AS \"Table Name\", *, "
        "'Y' AS update_flag FROM customer_pii"
    ),
    "report_placeholders": _lake(
        "SELECT CAST(orderkey AS VARCHAR) AS orderkey, "
        "CASE WHEN orderstatus IN ('P', 'F') THEN 'no_data' ELSE CAST(totalprice AS VARCHAR) END "
        "AS totalprice, CASE WHEN orderstatus = 'O' THEN strftime(order_ts, '%Y-%m-%d %H:%M:%S') "
        "ELSE 'no_time' END AS order_ts, CASE WHEN orderstatus <> 'O' THEN orderpriority "
        "ELSE 'no_data' END AS orderpriority FROM orders_pii"
    ),
    "subject_report": (
        f"WITH {search_ctes()},\n"
        f"{search_ctes(passes=2, first_match=True, source='Redshift', prefix='w_', base=False)}\n"
        "SELECT DISTINCT subject, source AS \"Source\", table_name AS \"Table Name\", "
        "'Y' AS update_flag, CAST(1 AS BIGINT) AS copies, row_key "
        "FROM (SELECT * FROM hits UNION ALL SELECT * FROM w_hits)"
    ),
    "review_decisions": _search(
        "SELECT DISTINCT h.subject, h.source AS \"Source\", h.table_name AS \"Table Name\", "
        "CASE WHEN h.table_name = 'sales_pii.orders_pii' AND o.orderstatus = 'F' THEN 'N' ELSE 'Y' END "
        "AS update_flag, h.row_key FROM hits h LEFT JOIN orders_pii o "
        "ON h.row_key = CAST(o.orderkey AS VARCHAR) AND h.table_name = 'sales_pii.orders_pii'",
        everybody=True,
    ),
    "report_roundtrip": _search(
        "SELECT DISTINCT h.subject, h.source AS \"Source\", h.table_name AS \"Table Name\", "
        "CASE WHEN h.table_name = 'sales_pii.orders_pii' AND o.orderstatus IN ('F', 'P') THEN 'N' ELSE 'Y' END "
        "AS update_flag, h.row_key FROM hits h LEFT JOIN orders_pii o "
        "ON h.row_key = CAST(o.orderkey AS VARCHAR) AND h.table_name = 'sales_pii.orders_pii'",
        everybody=True,
    ),
    "review_filter": _search(
        "SELECT DISTINCT h.subject, h.table_name AS \"Table Name\", h.row_key FROM hits h "
        "JOIN orders_pii o ON h.row_key = CAST(o.orderkey AS VARCHAR) "
        "WHERE h.table_name = 'sales_pii.orders_pii' AND o.orderstatus = 'F'",
        everybody=True,
    ),
    "hits_from_json": _search(
        "SELECT h.subject, o.orderkey, o.custkey, o.totalprice, o.orderstatus, "
        "strftime(o.order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts, o.partition_1 FROM hits h "
        "JOIN orders_pii o ON h.row_key = CAST(o.orderkey AS VARCHAR) "
        "WHERE h.table_name = 'sales_pii.orders_pii'",
        everybody=True,
    ),
    "erase_targets": _search(
        "SELECT DISTINCT table_name FROM hits WHERE table_name <> 'web_pii.events_pii'",
        everybody=True,
    ),
    "partitions_touched": _search(
        "SELECT DISTINCT strftime(o.order_ts, '%Y/%m/%d') AS partition FROM hits h JOIN orders_pii o "
        "ON h.row_key = CAST(o.orderkey AS VARCHAR) WHERE h.table_name = 'sales_pii.orders_pii'",
        everybody=True,
    ),
    # erase
    "hash_sha256": _lake("SELECT custkey, sha256(email) AS hashed FROM customer_pii"),
    "mask_column_token": _lake(
        "SELECT * REPLACE (sha256('email') AS email, sha256('name') AS name, "
        "CAST(NULL AS DOUBLE) AS acctbal) FROM customer_pii"
    ),
    "mask_value_hash": _lake(
        "SELECT * REPLACE (sha256('pepper' || email) AS email, sha256('pepper' || name) AS name) "
        "FROM customer_pii"
    ),
    "mask_null": _lake(
        "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS email, CAST(NULL AS INTEGER) AS nationkey) "
        "FROM customer_pii"
    ),
    "strip_control_columns": _lake("SELECT * FROM supplier_pii"),
    "partition_filter": _lake(
        "SELECT orderkey, custkey, partition_0, partition_1, partition_2 FROM orders_pii "
        "WHERE strftime(order_ts, '%Y-%m-%d') IN ('1998-10-03', '1998-10-04', '1998-12-31', '2001-02-09')"
    ),
    "pad_partition": (
        "SELECT strftime(o_orderdate, '%Y/%m/%d') AS partition, strftime(o_orderdate, '%m') AS month, "
        "count(*) AS n_rows FROM orders GROUP BY ALL"
    ),
    "erase_except_all": (
        f"WITH {_REPEATED} SELECT user_id, event_type, count(*) AS n_rows FROM "
        "(SELECT * FROM ev EXCEPT ALL SELECT * FROM flagged) GROUP BY ALL"
    ),
    "erase_anti_join": (
        f"WITH {_REPEATED} SELECT user_id, event_type, count(*) AS n_rows FROM ev "
        "WHERE (user_id, event_type) NOT IN (SELECT * FROM flagged) GROUP BY ALL"
    ),
    "erase_mask_replace": _search(_MASKED_ORDERS),
    "erase_delete": _search(
        f"SELECT {_ORDER_COLUMNS} FROM orders_pii WHERE CAST(orderkey AS VARCHAR) NOT IN ({_FLAGGED})",
    ),
    "swap_check": _search(
        f"SELECT n AS n_added, n AS n_masked, n AS n_common, true AS passed FROM "
        f"(SELECT count(DISTINCT row_key) AS n FROM ({_FLAGGED}))",
    ),
    "audit_partition_counts": _search(
        "SELECT partition_0 || '/' || partition_1 AS partition, count(*) AS n_before, "
        "count(*) FILTER (hit) AS n_flagged, CAST(0 AS BIGINT) AS n_masked, "
        "count(*) FILTER (NOT hit) AS n_after FROM (SELECT *, orderstatus = 'F' AND "
        f"CAST(orderkey AS VARCHAR) IN ({_FLAGGED}) AS hit FROM orders_pii) GROUP BY ALL",
        everybody=True,
    ),
    "update_by_row_match": _lake(
        "SELECT orderkey, CASE WHEN orderstatus <> 'F' THEN custkey END AS custkey, orderstatus, "
        "totalprice, CASE WHEN orderstatus = 'F' THEN sha256('orderpriority') ELSE orderpriority END "
        "AS orderpriority, partition_0, partition_1 FROM orders_pii"
    ),
    "match_columns": _match_columns(),
    "update_script": _lake(
        "SELECT 'UPDATE crm_pii.customer_pii SET email = ''' || sha256('email') || ''', name = ''' || "
        "sha256('name') || ''', nationkey = NULL WHERE email = ''' || email || ''' AND custkey = ' || "
        "custkey || ' AND name ' || CASE WHEN mktsegment = 'MACHINERY' THEN 'IS NULL' ELSE '= ''' || "
        "name || '''''s''' END || ' AND nationkey = ' || nationkey || ' AND acctbal = ' || acctbal || "
        "' AND mktsegment = ''' || mktsegment || ''';' AS statement FROM customer_pii"
    ),
    "erase_partition_rewrite": _stored(_MASKED_ROWS),
    "update_rewrite": _stored(_MASKED_ROWS),
    "erase_partition_delete": _stored(
        "SELECT table_name, CASE WHEN hit THEN 'gone' ELSE 'left' END AS what, count(*) AS n_rows FROM stored GROUP BY ALL",
        everybody="MACHINERY",
    ),
    "erase_typed_partition": _masked_in("year(order_ts) || '/' || strftime(order_ts, '%Y-%m-01')"),
    "erase_plain_folders": _masked_in("partition_0 || '/' || partition_1"),
    "audit_rewrite": _stored(
        "SELECT table_name, partition, count(*) AS n_before, count(*) FILTER (hit) AS n_flagged, count(*) AS n_after, "
        f"true AS passed FROM stored WHERE {_PLACE} IN (SELECT table_name, place FROM touched) GROUP BY ALL"
    ),
    "backup_snapshot": _stored(
        "SELECT table_name, row_key, partition, kept AS masked FROM stored "
        f"WHERE {_PLACE} IN (SELECT table_name, place FROM touched)"
    ),
    "backup_files": _stored(
        "SELECT table_name, partition, count(*) AS n_rows, true AS same_bytes, true AS changed, true AS restored "
        f"FROM stored WHERE {_PLACE} IN (SELECT table_name, place FROM touched) GROUP BY ALL"
    ),
    "backup_manifest": _stored(_MANIFEST),
    "backup_purge": _stored(
        _MANIFEST + " WHERE (table_name, place) NOT IN "
        f"(SELECT table_name, place FROM touched WHERE subject = '{REQUESTS[0]}')"
    ),
    # scalar
    "qualify_name": _shop('SELECT DISTINCT qualified, db, "table" FROM shop'),
    "text_between": (
        "SELECT page_id, CASE WHEN instr(html, '<title>') > 0 AND "
        "instr(substr(html, instr(html, '<title>') + 7), '</title>') > 0 THEN "
        "regexp_extract(html, '(?s)^.*?<title>(.*)</title>', 1) ELSE '' END AS title FROM pages"
    ),
    "path_parts": (
        "SELECT page_id, split_part(regexp_replace(url, '^[^:/]+://', ''), '/', 1) AS bucket, "
        "CASE WHEN instr(regexp_replace(url, '^[^:/]+://', ''), '/') > 0 THEN "
        "substr(regexp_replace(url, '^[^:/]+://', ''), "
        "instr(regexp_replace(url, '^[^:/]+://', ''), '/') + 1) ELSE '' END AS key, "
        "split_part(url, '/', -1) AS file, CASE WHEN contains(split_part(url, '/', -1), '.') THEN "
        "split_part(split_part(url, '/', -1), '.', -1) ELSE '' END AS extension FROM pages"
    ),
}
