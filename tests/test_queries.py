"""Every registered query against its SQL on the given tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
import samples.oracle
import samples.queries
from tests.conftest import MEDIUM, SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = {name: entry_module.queries()[name] for name in samples.queries.QUERIES}
ORACLE = {name: entry_module.oracle_sql()[name] for name in samples.oracle.ORACLE}


def database(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(shown(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    found = table_of(df.columns, [tuple(r) for r in df.collect()])
    result = database(SMALL).execute(ORACLE[name])
    expected = table_of([c[0] for c in result.description], result.fetchall())
    assert found == expected


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "row_key" in df.columns


def test_golden_counts_without_country(spark):
    rows = QUERIES["link_fixpoint"](spark, MEDIUM).groupBy("pass", "table_name").count().collect()
    assert {(r["pass"], r["table_name"].split(".")[1]): r["count"] for r in rows} == {
        (1, "customer_pii"): 3,
        (1, "events_pii"): 228,
        (2, "orders_pii"): 24,
        (3, "lineitem_pii"): 93,
        (4, "supplier_pii"): 76,
    }


def test_golden_counts_with_country(spark):
    rows = QUERIES["link_hits_by_pass"](spark, MEDIUM).collect()
    found = {(r["pass"], r["table_name"].split(".")[1], r["matched_column"]): r["n_hits"] for r in rows}
    assert found == {
        (1, "customer_pii", "email"): 3,
        (1, "events_pii", "contact_email"): 228,
        (2, "orders_pii", "custkey"): 24,
        (2, "supplier_pii", "nationkey"): 16,
        (3, "lineitem_pii", "orderkey"): 93,
        (3, "lineitem_pii", "suppkey"): 9484,
    }
