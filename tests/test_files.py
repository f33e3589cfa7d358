"""Copies of files: byte for byte, whatever the names, and complete or not there at all."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lethe import Change, CheckFailed, LakeTable, Places, Run, purge
from lethe.functions.identity import row_id, row_json
from lethe.sources import files

ROWS = [("a@x.de", 1, "x y", "02"), ("b@x.de", 2, "x y", "02"), ("a@x.de", 3, "{*}", "1%"), ("c@x.de", 4, "z", "03")]
SCHEMA = "email string, n bigint, p string, m string"


def tree(path):
    found = [p for p in Path(path).rglob("*") if p.is_file() and not p.name.startswith((".", "_"))]
    return {str(p.relative_to(path)): p.read_bytes() for p in found}


def flagged(spark, table, condition):
    df = table.read(spark)
    ids = (row_id(df.columns).alias("row_id"), row_json(df.columns).alias("row_json"))
    return df.where(condition).select(F.lit("a@x.de").alias("subject"), *ids)


@pytest.fixture
def places(tmp_path):
    return Places(*[str(tmp_path / n) for n in ("backups", "stage", "records")])


def stored(spark, tmp_path, kind):
    path = str(tmp_path / "table")
    df = spark.createDataFrame(ROWS, SCHEMA)
    if kind == "whole":
        df.write.parquet(path)
        return LakeTable("t_pii", path)
    if kind == "plain":
        for p in ("x", "z"):
            rows = df.where(F.col("p").startswith(p)).drop("p", "m")
            rows.write.parquet(f"{path}/{p}/02")
        schema = "email string, n bigint, p string, m string"
        return LakeTable("t_pii", path, ("p", "m"), schema=spark.createDataFrame([], schema).schema, layout="plain")
    df.write.partitionBy("p", "m").parquet(path)
    return LakeTable("t_pii", path, ("p", "m"))


@pytest.mark.parametrize("kind", ["keyed", "plain", "whole"])
@pytest.mark.parametrize("action", ["mask", "delete"])
def test_restore_brings_the_same_files_back(spark, tmp_path, places, kind, action):
    table = stored(spark, tmp_path, kind)
    before, rows = tree(table.path), sorted(map(tuple, table.read(spark).collect()))
    run = Run(spark, table, places, "r1", Change(action, ("email",)), backup="files")
    run.run(flagged(spark, table, "email = 'a@x.de'"))
    kept = set(tree(run.backup_path).values())
    assert kept <= set(before.values()) and tree(table.path) != before
    assert not any(r[0] == "a@x.de" for r in table.read(spark).collect())
    run.restore()
    assert tree(table.path) == before
    assert sorted(map(tuple, table.read(spark).collect())) == rows
    run.restore()
    assert tree(table.path) == before


def test_record_tells_length_and_checksum(spark, tmp_path, places):
    import hashlib

    table = stored(spark, tmp_path, "keyed")
    before = tree(table.path)
    run = Run(spark, table, places, "r1", Change("mask", ("email",)), backup="files")
    run.run(flagged(spark, table, "email = 'a@x.de'"))
    told = {(r["length"], r["sha256"]) for r in run.backup_files().collect()}
    touched = [b for name, b in before.items() if not name.startswith("p=z")]
    assert told == {(len(b), hashlib.sha256(b).hexdigest()) for b in touched}


def test_changed_backup_is_not_restored(spark, tmp_path, places):
    table = stored(spark, tmp_path, "keyed")
    run = Run(spark, table, places, "r1", Change("mask", ("email",)), backup="files")
    run.run(flagged(spark, table, "email = 'a@x.de'"))
    one = next(p for p in Path(run.backup_path).rglob("*.parquet"))
    one.write_bytes(one.read_bytes() + b"!")
    masked = tree(table.path)
    with pytest.raises(CheckFailed, match="nothing was restored"):
        run.restore()
    assert tree(table.path) == masked


def test_purged_partitions_are_left_alone_by_restore(spark, tmp_path, places):
    table = stored(spark, tmp_path, "keyed")
    run = Run(spark, table, places, "r1", Change("mask", ("email",)), backup="files")
    run.run(flagged(spark, table, "email = 'a@x.de'"))
    assert purge(spark, places, "a@x.de") == 2
    assert tree(places.backups) == {}
    masked = tree(table.path)
    run.restore()
    assert tree(table.path) == masked


def test_wrong_copy_stops_the_run(spark, tmp_path, places, monkeypatch):
    table = stored(spark, tmp_path, "keyed")
    before = tree(table.path)
    right = files.checksums
    monkeypatch.setattr(files, "checksums", lambda f: right(f).withColumn("sha256", F.lit("0")))
    run = Run(spark, table, places, "r1", Change("mask", ("email",)), backup="files")
    with pytest.raises(CheckFailed, match="copied files"):
        run.run(flagged(spark, table, "email = 'a@x.de'"))
    assert run.state() is None and tree(table.path) == before


def test_large_and_odd_files(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "from [a]", tmp_path / "to"
    (source / "k=%7B x").mkdir(parents=True)
    big = bytes(range(256)) * 80_000
    assert len(big) > 2 * files.PIECE
    (source / "k=%7B x" / "big").write_bytes(big)
    (source / "one").write_bytes(b"1")
    (source / "_hidden").write_bytes(b"2")
    listed = files.list_files(spark, [str(source)])
    assert sorted(r["length"] for r in listed.collect()) == [1, len(big)]
    place = F.replace("path", F.lit("/from [a]/"), F.lit("/to/"))
    assert files.copy_files(listed.select(F.col("path").alias("source"), place.alias("target"), "length")).count() == 2
    assert tree(target) == {"k=%7B x/big": big, "one": b"1"}
    assert not [p for p in target.rglob(".*")]
    assert files.delete_files(files.list_files(spark, [str(target)])) == 2 and tree(target) == {}


def test_no_files(spark):
    assert files.list_files(spark, []).isEmpty()
    assert files.checksums(files.list_files(spark, [])).isEmpty()


def test_unknown_kind_of_backup(spark, tmp_path, places):
    with pytest.raises(ValueError):
        Run(spark, stored(spark, tmp_path, "whole"), places, "r1", Change("mask"), backup="tape")
