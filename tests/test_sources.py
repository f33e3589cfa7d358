"""Readers, names and paths."""

import pytest
from pyspark.sql import functions as F

from lethe import (
    Settings, catalog_columns, classify, open_catalog_tables, read_key_values, scan_catalog_table, subjects_from,
)
from lethe.functions import text
from lethe.operators.classify import search_names
from lethe.sources.tables import LakeTable, affected_files, in_partitions


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_request_and_settings_lines(spark, tmp_path):
    path = tmp_path / "request.txt"
    path.write_text(
        "given_email=['a@x.de', \"o'b@x.de\", ' a@x.de ']\n"
        "default_map_column = mail\n"
        "candidate_key_columns=['key', 'nr']\n"
        "rest_all_pii_columns =['name']\n"
        "\n"
        "search_phrase=personal=x\n"
    )
    pairs = read_key_values(spark, str(path))
    assert sorted(r["subject"] for r in subjects_from(pairs).collect()) == ["a@x.de", "o'b@x.de"]
    settings = Settings.from_key_values(pairs)
    assert settings.link_phrase == "mail" and settings.key_fragments == ("key", "nr")
    assert settings.search_phrase == "personal=x"
    found = {r["key"]: r["items"] for r in pairs.collect()}
    assert found["rest_all_pii_columns"] == ["name"]


def test_catalog_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS crm_pii")
    spark.sql("DROP TABLE IF EXISTS crm_pii.people_pii")
    spark.sql("CREATE TABLE crm_pii.people_pii (email STRING, user_id INT, y STRING) USING parquet PARTITIONED BY (y)")
    columns = catalog_columns(spark, ["crm_pii"])
    rows = {r["column"]: (r["type"], r["is_partition"]) for r in columns.collect()}
    assert rows == {"email": ("string", False), "user_id": ("int", False), "y": ("string", True)}
    found = classify(columns)
    assert [r["column"] for r in found.personal_columns.collect()] == ["user_id"]
    assert {r["column"] for r in found.mask_columns.collect()} == {"user_id", "email"}
    names = {(r["kind"], r["name"]) for r in search_names(columns, Settings()).collect()}
    assert names == {("table", "crm_pii.people_pii"), ("link", "email"), ("key", "user_id")}
    found.write(str(tmp_path / "lists"))
    assert spark.read.json(str(tmp_path / "lists" / "candidate_keys")).first()["column"] == "user_id"
    assert set(open_catalog_tables(spark, ["crm_pii.people_pii", "crm_pii.absent"])) == {"crm_pii.people_pii"}
    assert scan_catalog_table(spark, "crm_pii.people_pii")[1] == ["email", "user_id", "y"]


def test_partition_values_stay_text_and_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "2024", "02"), (2, "2024", "12"), (3, "2023", None)], "i int, y string, m string") \
        .write.partitionBy("y", "m").parquet(path)
    df = LakeTable("a.b", path, ("y", "m")).read(spark)
    assert sorted((r["m"] or "") for r in df.collect()) == ["", "02", "12"]
    some = df.where(in_partitions(("y", "m"), [("2024", "02"), ("2023", None)]))
    assert sorted(r["i"] for r in some.collect()) == [1, 3]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    files = affected_files(df, F.col("i") < 3).collect()
    assert sum(r["n_rows"] for r in files) == 2 and len(files) == 2


@pytest.mark.parametrize("value,start,end,expected", [
    ("Bucket:b+'File:'+k", "Bucket:", "+'File:", "b"),
    ("x<a>1</a><a>2</a>y", "<a>", "</a>", "1</a><a>2"),
    ("nothing", "<", ">", ""),
    ("a.b(c)", "a.b(", ")", "c"),
])
def test_text_between(spark, value, start, end, expected):
    assert one(spark, text.text_between(F.lit(value), start, end)) == expected


def test_paths(spark):
    path = F.lit("s3://bucket/a/b=c/part-0.snappy.parquet")
    assert one(spark, text.path_bucket(path)) == "bucket"
    assert one(spark, text.path_key(path)) == "a/b=c/part-0.snappy.parquet"
    assert one(spark, text.path_file(path)) == "part-0.snappy.parquet"
    assert one(spark, text.path_extension(path)) == "parquet"
    assert one(spark, text.path_extension(F.lit("s3://b/a.d/file"))) == ""


def test_dates(spark):
    assert one(spark, text.date_partition(F.lit(2024), F.lit(3), F.lit("9"))) == "2024/03/09"
    assert one(spark, text.date_partition(F.lit("2024"), F.lit("12"), F.lit("10"))) == "2024/12/10"
    assert one(spark, text.sql_quote(F.lit("o'x"))) == "'o''x'"


def test_shared_folder_is_the_clusters(spark):
    from lethe.scratch import new_folder

    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
