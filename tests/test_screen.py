"""The filter of search values: never a row too few, few too many, and of bounded size."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lethe import Limits
from lethe.operators import linkage
from lethe.operators.lookup import Size
from lethe.operators.screen import SLOT_BYTES, screen, slots_for

PAIRS = "column string, value string"


def numbers(spark, first, last):
    return spark.range(first, last).select(F.lit("k").alias("column"), F.col("id").cast("string").alias("value"))


@pytest.mark.parametrize("n", [1, 1_000, 50_000])
def test_every_match_passes_and_few_others(spark, n):
    filter_ = screen(numbers(spark, 0, n), n, Limits())
    passed = filter_.passed(numbers(spark, 0, n + 100_000), "column", "value")
    found = passed.agg(
        F.count_if(F.col("value").cast("long") < n).alias("right"), F.count_if(F.col("value").cast("long") >= n).alias("more")
    ).first()
    assert found["right"] == n and found["more"] < 3_000


def test_a_filter_too_small_still_loses_nothing(spark):
    filter_ = screen(numbers(spark, 0, 5_000), 5_000, Limits(broadcast_bytes=0, broadcast_rows=0))
    assert filter_.slots == 1 and filter_.frame.count() == 1
    assert filter_.passed(numbers(spark, 0, 5_000), "column", "value").count() == 5_000


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.text(max_size=3) | st.none()), min_size=1, max_size=30))
def test_any_texts(spark, pairs):
    values = spark.createDataFrame([p for p in pairs if p[1] is not None] or [("a", "x")], PAIRS)
    rows = spark.createDataFrame(pairs, PAIRS)
    passed = {tuple(r) for r in screen(values, len(pairs), Limits()).passed(rows, "column", "value").collect()}
    assert passed == {p for p in pairs if p[1] is not None}


@pytest.mark.parametrize("n", [0, 1, 10**6, 10**9, 10**12])
def test_size_is_bounded_by_the_limits(n):
    for limits in (Limits(), Limits(broadcast_bytes=10_000), Limits(broadcast_rows=3), Limits(broadcast_rows=0)):
        slots = slots_for(n, limits)
        assert slots & (slots - 1) == 0
        assert slots == 1 or (slots * SLOT_BYTES <= limits.broadcast_bytes and slots <= limits.broadcast_rows)


def test_rows_without_a_match_are_not_shuffled(spark, tmp_path):
    spark.range(20_000).select(F.col("id").alias("user_id"), F.lit("x").alias("note")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    probes = spark.range(100).select(
        F.lit("s").alias("subject"), F.lit("user_id").alias("column"), F.col("id").cast("string").alias("value"),
        F.lit("t").alias("table_name"),
    )
    low = Limits(broadcast_rows=10, literal_pairs=10)
    found = linkage.probe(table, "t", "DataLake", probes, ["user_id"], ["user_id"], Size(100, 10_000), low)
    assert found.count() == 100
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and not re.search(r"Aggregate \[(column|value)", plan)
    # the rows that reach the join, as the screen lets them through
    rows = table.select(F.lit("user_id").alias("column"), F.col("user_id").cast("string").alias("value"))
    assert screen(probes, 100, low).passed(rows, "column", "value").count() < 100 + 2_000
