"""Masking and removal as DataFrame functions: edge cases and invariants."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from lethe import Limits, mask, update_by_row_match, update_script
from lethe.functions.identity import row_id, row_json
from lethe.operators import audit, erase, masking, review
from lethe.operators.lookup import lookup_join, measure

SHUFFLED = Limits(broadcast_rows=0, max_hot_keys=3, salts=3)
SCHEMA = "name string, n int, d double, ts timestamp, tags map<string,int>, p string"


@pytest.fixture(scope="module")
def rows(spark):
    noon = datetime.datetime(2024, 1, 2, 12, 0, 0, 123456)
    data = [
        ("ann", 1, 1.5, noon, {"a": 1}, "01"),
        ("ann", 1, 1.5, noon, {"a": 1}, "01"),
        ("ann", 1, 1.5, noon + datetime.timedelta(microseconds=1), {"a": 1}, "01"),
        (None, None, float("nan"), None, None, "02"),
        ("bob", 2, -0.5, noon, {}, "02"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def ids(df, condition):
    return df.select("*", row_id(df.columns).alias("row_id")).where(condition).select("row_id")


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED])
def test_delete_by_id_takes_all_copies_and_only_them(rows, limits):
    flagged = ids(rows, "name = 'ann' AND date_format(ts, 'SSSSSS') = '123456'")
    left = erase.erase(rows, flagged, action="delete", limits=limits)
    assert sorted((r["name"] or "", r["p"]) for r in left.collect()) == [("", "02"), ("ann", "01"), ("bob", "02")]
    assert left.schema == rows.schema


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED])
def test_mask_by_id_keeps_count_schema_and_other_rows(rows, limits):
    flagged = ids(rows, "name = 'bob' OR name IS NULL")
    done = erase.erase(rows, flagged, columns=["name", "n", "absent"], limits=limits)
    assert done.schema.simpleString() == rows.schema.simpleString()
    token = hashlib.sha256(b"name").hexdigest()
    found = sorted((r["name"], r["n"]) for r in done.collect() if r["n"] is None or r["name"] == token)
    assert found == [(token, None), (token, None)]
    others = done.where("p = '01'")
    assert others.select(row_id(rows.columns).alias("i")).exceptAll(
        rows.where("p = '01'").select(row_id(rows.columns).alias("i"))
    ).isEmpty()


def test_erase_twice_is_erase_once(rows):
    flagged = ids(rows, "p = '02'")
    once = erase.erase(rows, flagged, columns=["name"])
    twice = erase.erase(once, flagged, columns=["name"])
    key = [row_id(rows.columns).alias("i")]
    assert once.select(key).exceptAll(twice.select(key)).isEmpty()


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED])
def test_counted_and_copies(spark, limits):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "a int, b string")
    flagged = spark.createDataFrame([(None, 1)], "b string, a int")  # columns in another order
    counted = erase.erase(rows, flagged, action="delete", match="counted", limits=limits)
    copies = erase.erase(rows, flagged, action="delete", match="copies", limits=limits)
    assert sorted(r["a"] for r in counted.collect()) == [1, 2, 3]
    assert sorted(r["a"] for r in copies.collect()) == [2, 3]
    masked = erase.erase(rows, flagged, match="copies", columns=["b"], limits=limits)
    assert masked.count() == 4


def test_nan_equals_nan(spark):
    rows = spark.createDataFrame([(float("nan"),), (1.0,)], "a double")
    flagged = spark.createDataFrame([(float("nan"),)], "a double")
    for match in ("counted", "copies"):
        assert erase.erase(rows, flagged, "delete", match).collect() == [(1.0,)]


def test_mask_modes(spark):
    df = spark.createDataFrame([("a", 1)], "s string, i int")
    salted = hashlib.sha256(b"peppera").hexdigest()
    assert mask(df, ["s"], mode="value_hash", salt="pepper").first()["s"] == salted
    assert mask(df, ["s", "i"], mode="null").first() == (None, None)
    with pytest.raises(TypeError):
        mask(df, ["i"], on_non_string="error")
    with pytest.raises(ValueError):
        mask(df, ["s"], mode="other")


def test_match_columns_by_type_or_name(spark):
    df = spark.createDataFrame([], "mktsegment string, ts timestamp, d date, n timestamp_ntz, k int")
    assert masking.match_columns(df.schema) == ["mktsegment", "k"]
    assert masking.match_columns(df.schema, "ts") == ["d", "n", "k"]


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED])
def test_update_by_row_match_with_nulls(spark, limits):
    df = spark.createDataFrame([(1, None, "x"), (1, "b", "y"), (2, None, "z")], "k int, b string, c string")
    flagged = spark.createDataFrame([(1, None)], "k int, b string")
    done = update_by_row_match(df, flagged, ["c"], match=["k", "b"], limits=limits)
    token = hashlib.sha256(b"c").hexdigest()
    assert sorted(r["c"] for r in done.collect()) == sorted([token, "y", "z"])
    assert done.columns == df.columns


def test_update_script_quotes(spark):
    df = spark.createDataFrame([("o'x", None, 2, "a:b, c")], "email string, b string, k int, t string")
    text = update_script(df, "s.t", ["email"]).first()["statement"]
    token = hashlib.sha256(b"email").hexdigest()
    assert text == (
        f"UPDATE s.t SET email = '{token}' WHERE email = 'o''x' AND b IS NULL AND k = 2 AND t = 'a:b, c';"
    )
    assert update_script(df, "s.t", ["other"]).isEmpty()


def test_swap_check_refuses_lost_rows(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "s string, i int")
    masked = spark.createDataFrame([("t", 1)], "s string, i int")
    good = spark.createDataFrame([("t", 1), ("b", 2)], "s string, i int")
    bad = spark.createDataFrame([("b", 2)], "s string, i int")
    assert erase.swap_check(old, good, masked).first()["passed"]
    assert not erase.swap_check(old, bad, masked).first()["passed"]


def test_checksums_see_copies(spark):
    one = spark.createDataFrame([("a",), ("b",)], "s string")
    two = spark.createDataFrame([("a",), ("a",), ("b",), ("b",)], "s string")
    sums = [audit.partition_checksums(df, []).first()["checksum"] for df in (one, two)]
    assert sums[0] * 2 == sums[1] and sums[0] != 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffled_join_equals_broadcast(spark, how):
    # one key holds a third of the rows
    big = spark.range(300).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)).alias("k"), "id")
    small = spark.createDataFrame([(7, "a"), (7, "b"), (1, "c"), (99, "d")], "k bigint, v string")

    def shown(rows):
        return sorted(rows, key=str)

    a = lookup_join(big, small, ["k"], how, Limits())
    expected = shown([tuple(r[c] for c in sorted(a.columns)) for r in a.collect()])
    for spread_by in (None, ["id"]):
        b = lookup_join(big, small, ["k"], how, SHUFFLED, spread_by=spread_by)
        assert sorted(a.columns) == sorted(b.columns)
        assert shown([tuple(r[c] for c in sorted(b.columns)) for r in b.collect()]) == expected


def test_measured_size_decides(spark):
    df = spark.createDataFrame([("x" * 100,), (None,)], "s string")
    size = measure(df)
    assert size.rows == 2 and size.bytes >= 100
    assert not size.fits(Limits(broadcast_bytes=50)) and size.fits(Limits())


def test_placeholders_leave_words_alone(spark):
    df = spark.createDataFrame(
        [("nanny", float("nan"), None, None), (None, 1.5, 3, datetime.date(2024, 1, 2))],
        "s string, d double, i int, t date",
    )
    assert [tuple(r) for r in review.placeholders(df).collect()] == [
        ("nanny", "no_data", "no_data", "no_time"),
        ("no_data", "1.5", "3", "2024-01-02"),
    ]


def test_report_counts_copies_once_per_pair(spark):
    hit = ("s", "DataLake", "d.t", "id1", "", "{}")
    pairs = [("a", "1"), ("a", "1"), ("b", "2"), ("b", "2")]
    hits = spark.createDataFrame(
        [(*hit, *p) for p in pairs],
        "subject string, source string, table_name string, row_id string, partition string, "
        "row_json string, matched_column string, matched_value string",
    )
    assert [(r["copies"], r["update_flag"]) for r in review.report(hits).collect()] == [(2, "Y")]


def test_rows_survive_the_report(rows):
    hits = rows.select(
        F.lit("s").alias("subject"),
        F.lit("d.t").alias("table_name"),
        row_id(rows.columns).alias("row_id"),
        row_json(rows.columns).alias("row_json"),
    )
    back = review.read_rows(hits, "d.t", rows.schema)
    assert back.where(F.col("row_id") != row_id(rows.columns)).isEmpty()
    assert back.count() == rows.count()
