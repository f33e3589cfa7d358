"""Lists and reports that people have edited, and the forecast of a pass."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lethe.operators import classify, forecast, review
from lethe.settings import LAKE, Settings

COLUMNS = [
    (LAKE, "a_pii", "t_pii", c, "string", c == "day") for c in ("email", "user_id", "name", "day")
] + [(LAKE, "a_pii", "u_pii", c, "string", False) for c in ("user_id", "phone")]


@pytest.fixture
def columns(spark):
    return spark.createDataFrame(
        COLUMNS, "source string, db string, `table` string, `column` string, type string, is_partition boolean"
    )


def written(spark, columns, path, **changes):
    made = classify.classify(columns, Settings())
    for name, keys in classify.LISTS.items():
        rows = [tuple(r) for r in getattr(made, name).select(*keys).collect()]
        schema = ", ".join(f"`{k}` string" for k in keys)
        spark.createDataFrame(changes.get(name, lambda r: r)(rows), schema).write.json(f"{path}/{name}")
    return classify.read_classification(spark, str(path), columns)


def test_lists_as_written(spark, columns, tmp_path):
    lists = written(spark, columns, tmp_path)
    found = {tuple(r) for r in lists.search_names(LAKE).collect()}
    expected = {tuple(r) for r in classify.search_names(columns, Settings()).collect()}
    assert found == expected and found


def test_edited_lists(spark, columns, tmp_path):
    lists = written(
        spark,
        columns,
        tmp_path,
        tables=lambda rows: [r for r in rows if r[2] != "u_pii"] * 2,
        candidate_keys=lambda rows: [*rows, (LAKE, "phone")],
        link_columns=lambda rows: [],
    )
    assert {tuple(r) for r in lists.search_names(LAKE).collect()} == {
        ("table", "a_pii.t_pii"), ("key", "user_id"), ("key", "phone")
    }
    assert lists.tables.count() == 1


@pytest.mark.parametrize(
    "name,entry",
    [
        ("tables", (LAKE, "a_pii", "gone_pii")),
        ("tables", (LAKE, None, "t_pii")),
        ("candidate_keys", (LAKE, "user_idd")),
        ("candidate_keys", ("Redshift", "user_id")),
        ("mask_columns", (LAKE, "day")),
        ("link_columns", (None, None)),
    ],
)
def test_unknown_entries_are_refused(spark, columns, tmp_path, name, entry):
    lists = written(spark, columns, tmp_path, **{name: lambda rows: [*rows, entry]})
    with pytest.raises(PySparkException, match="not in the metadata"):
        getattr(lists, name).collect()


def test_broken_line_is_refused(spark, columns, tmp_path):
    written(spark, columns, tmp_path)
    (tmp_path / "tables" / "part-x.json").write_text('{"source": "DataLake", "db": ')
    with pytest.raises((PySparkException, Py4JJavaError)):
        classify.read_classification(spark, str(tmp_path), columns).tables.collect()


ROWS = [("s1", LAKE, "t", "Y", 1, None, f"r{i}", "{}") for i in range(4)] + [("007", LAKE, "t", "Y", 2, "d=1", "r0", "{}")]


def edits(spark, tmp_path, change):
    reported = spark.createDataFrame(ROWS, review.REPORT_SCHEMA)
    path = str(tmp_path / "edited")
    spark.createDataFrame(change(ROWS), review.REPORT_SCHEMA).write.partitionBy("subject").json(path)
    found = review.apply_edits(reported, review.read_report(spark, path))
    assert found.columns == reported.columns
    return {(r["subject"], r["row_id"]): r["update_flag"] for r in found.collect()}


def flagged(row, flag):
    return (*row[:3], flag, *row[4:])


def test_edited_report(spark, tmp_path):
    found = edits(spark, tmp_path, lambda r: [flagged(r[0], " n"), r[0][:3] + ("N",) + r[0][4:], r[1], r[4]])
    assert found == {("s1", "r0"): "N", ("s1", "r1"): "Y", ("s1", "r2"): "N", ("s1", "r3"): "N", ("007", "r0"): "Y"}


@pytest.mark.parametrize(
    "change,message",
    [
        (lambda r: [*r, flagged(r[0], "N")], "conflicting"),
        (lambda r: [*r, (*r[0][:6], "r9", "{}")], "not reported"),
        (lambda r: [flagged(r[0], "maybe"), *r[1:]], "no valid flag"),
        (lambda r: [flagged(r[0], None), *r[1:]], "no valid flag"),
        (lambda r: [flagged(r[0], None), *r], "conflicting"),
    ],
)
def test_bad_edits_are_refused(spark, tmp_path, change, message):
    with pytest.raises(PySparkException, match=message):
        edits(spark, tmp_path, change)


@pytest.mark.parametrize("width,depth", [(1 << 14, 4), (8, 2), (1, 1)])
def test_forecast_is_never_below(spark, width, depth):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 100, None).otherwise(F.col("id").cast("string")).alias("a key"),
        (F.col("id") % 50).alias("n"),
    )
    sketch = forecast.key_sketch({"t": rows, "none": rows}, {"t": ["a key", "n"], "none": []}, width, depth)
    assert sketch.count() <= 2 * width * depth
    probes = [("t", "a key", "hot"), ("t", "a key", "101"), ("t", "a key", "101"), ("t", "a key", "no"), ("t", "n", "7"), ("x", "n", "7")]
    given = spark.createDataFrame(probes, "table_name string, column string, value string")
    found = {tuple(r)[:3]: r["at_most"] for r in forecast.forecast(sketch, given, width, depth).collect()}
    true = {("t", "a key", "hot"): 1000, ("t", "a key", "101"): 1, ("t", "a key", "no"): 0, ("t", "n", "7"): 60, ("x", "n", "7"): 0}
    assert found.keys() == true.keys() and all(found[k] >= n for k, n in true.items())
    assert found["x", "n", "7"] == 0
    if width > 8:
        assert found["t", "a key", "hot"] == 1000 and found["t", "n", "7"] == 60
    total = {r["column"]: (r["n_values"], r["at_most"]) for r in forecast.pass_forecast(sketch, given.where("table_name = 't'"), width, depth).collect()}
    assert total["n"] == (1, found["t", "n", "7"])
