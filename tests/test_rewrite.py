"""The staged rewrite on storage: what it must never lose, leave behind or repeat."""

import hashlib
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lethe import (
    Change, CheckFailed, LakeTable, Places, Run, Settings, apply_decisions, columns_of,
    erase_reviewed, purge, read_manifest, report, search,
)
from lethe.functions.identity import row_id, row_json
from lethe.operators import erase
from lethe.plans import rewrite

SCHEMA = "email string, user_id bigint, note string, y string, m string"
TOKEN = hashlib.sha256(b"email").hexdigest()


@pytest.fixture
def place(tmp_path):
    return Places(*[str(tmp_path / n) for n in ("backups", "stage", "records")])


@pytest.fixture
def table(spark, tmp_path):
    rows = [
        ("a@x.de", 1, "one", "2024", "02"),
        ("a@x.de", 1, "one", "2024", "02"),
        ("b@x.de", 2, "two", "2024", "02"),
        ("a@x.de", 1, "ten", "2024", "10"),
        ("c@x.de", 3, "untouched", "2024", "11"),
    ]
    path = str(tmp_path / "table")
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df.write.partitionBy("y", "m").parquet(path)
    return LakeTable("web_pii.visits_pii", path, ("y", "m"))


def flagged(spark, table, condition):
    df = table.read(spark)
    return df.where(condition).select(
        F.lit("a@x.de").alias("subject"),
        row_id(df.columns).alias("row_id"),
        row_json(df.columns).alias("row_json"),
    )


def content(spark, table):
    return sorted(tuple(r) for r in table.read(spark).collect())


def data_files(path):
    return sorted(str(p) for p in Path(path).rglob("*.parquet"))


def test_mask_changes_only_flagged_rows(spark, table, place):
    before = content(spark, table)
    untouched = data_files(table.path + "/y=2024/m=11")
    run = Run(spark, table, place, "r1", Change("mask", ("email", "user_id", "m")))
    audit = run.run(flagged(spark, table, "email = 'a@x.de'"))
    after = content(spark, table)
    assert sorted(r[0] for r in after) == sorted([TOKEN] * 3 + ["b@x.de", "c@x.de"])
    assert [r for r in after if r[0] != TOKEN] == [r for r in before if r[0] != "a@x.de"]
    assert data_files(table.path + "/y=2024/m=11") == untouched
    assert sorted(p.name for p in Path(table.path, "y=2024").iterdir() if p.is_dir()) == ["m=02", "m=10", "m=11"]
    counts = {r["partition"]: (r["n_before"], r["n_flagged"], r["n_after"]) for r in audit.collect()}
    assert counts == {"2024/02": (3, 2, 3), "2024/10": (1, 1, 1)}
    assert sorted(tuple(r) for r in run.backup().collect()) == [r for r in before if r[4] != "11"]


def test_one_file_per_partition(spark, table, place):
    Run(spark, table, place, "r1", Change("mask", ("email",))).run(flagged(spark, table, "email = 'a@x.de'"))
    assert len(data_files(table.path + "/y=2024/m=02")) == 1


def test_delete_drops_emptied_partition(spark, table, place):
    Run(spark, table, place, "r1", Change("delete")).run(flagged(spark, table, "email = 'a@x.de'"))
    assert [r[0] for r in content(spark, table)] == ["b@x.de", "c@x.de"]
    assert not Path(table.path, "y=2024", "m=10").exists()


def test_backups_lie_outside_and_are_purged_for_everybody_in_them(spark, table, place):
    both = flagged(spark, table, "email = 'a@x.de'").unionByName(
        flagged(spark, table, "email = 'b@x.de'").withColumn("subject", F.lit("b@x.de"))
    )
    Run(spark, table, place, "r1", Change("mask", ("email",))).run(both)
    manifest = {(r["subject"], r["partition"]) for r in read_manifest(spark, place).collect()}
    assert manifest == {("a@x.de", "2024/02"), ("a@x.de", "2024/10"), ("b@x.de", "2024/02")}
    assert purge(spark, place, "b@x.de") == 1
    left = {(r["subject"], r["partition"]) for r in read_manifest(spark, place).collect()}
    assert left == {("a@x.de", "2024/10")}
    assert not data_files(place.backups + "/run_id=r1/table=web_pii.visits_pii/y=2024/m=02")
    assert purge(spark, place, "b@x.de") == 0
    assert purge(spark, place, "a@x.de") == 1
    assert data_files(place.backups) == [] and read_manifest(spark, place).isEmpty()


@pytest.mark.parametrize("step", ["_stage", "_check", "_swap"])
def test_interrupted_run_goes_on(spark, table, place, monkeypatch, step):
    rows = flagged(spark, table, "email = 'a@x.de'")
    change = Change("mask", ("email",))
    run = Run(spark, table, place, "r1", change)
    with monkeypatch.context() as broken:
        def stop(self, *args):
            raise OSError("lost")

        broken.setattr(Run, step, stop)
        with pytest.raises(OSError):
            run.run(rows)
    assert "a@x.de" in {r[0] for r in content(spark, table)}
    Run(spark, table, place, "r1", change).run(rows)
    assert sorted(r[0] for r in content(spark, table)) == sorted([TOKEN] * 3 + ["b@x.de", "c@x.de"])


def test_wrong_stage_is_not_swapped(spark, table, place, monkeypatch):
    before = content(spark, table)
    run = Run(spark, table, place, "r1", Change("mask", ("email",)))
    staged = Run._stage

    def lose_a_row(self):
        staged(self)
        kept = self._like_backup(self.stage_path).where("user_id <> 2").collect()
        self._write(spark.createDataFrame(kept, self._schema)).save(self.stage_path)

    monkeypatch.setattr(Run, "_stage", lose_a_row)
    with pytest.raises(CheckFailed):
        run.run(flagged(spark, table, "email = 'a@x.de'"))
    assert content(spark, table) == before


def test_table_changed_meanwhile_is_not_swapped(spark, table, place, monkeypatch):
    run = Run(spark, table, place, "r1", Change("mask", ("email",)))
    check = Run._check

    def somebody_writes(self):
        check(self)
        new = spark.createDataFrame([("n@x.de", 9, "new", "2024", "02")], SCHEMA)
        new.write.mode("append").partitionBy("y", "m").parquet(table.path)

    monkeypatch.setattr(Run, "_check", somebody_writes)
    with pytest.raises(CheckFailed):
        run.run(flagged(spark, table, "email = 'a@x.de'"))
    assert "n@x.de" in {r[0] for r in content(spark, table)}


def test_row_changed_since_the_search_stops_the_run(spark, table, place):
    rows = flagged(spark, table, "email = 'a@x.de'").distinct()
    rows = rows.withColumn("copies", F.when(F.get_json_object("row_json", "$.m") == "02", 2).otherwise(1))
    rows = spark.createDataFrame(rows.collect(), rows.schema)  # as a search keeps them
    Run(spark, table, place, "r1", Change("mask", ("note",))).run(rows)
    stale = Run(spark, table, place, "r2", Change("mask", ("email",)))
    with pytest.raises(CheckFailed):
        stale.run(rows)
    assert "a@x.de" in {r[0] for r in content(spark, table)}
    Run(spark, table, place, "r2", Change("mask", ("email",)), allow_missing=True).run(rows)
    assert stale.state() == "swapped"


@pytest.mark.parametrize("action,left", [("mask", 2), ("delete", 1)])
def test_table_without_partitions(spark, tmp_path, place, action, left):
    path = str(tmp_path / "flat")
    spark.createDataFrame([("a@x.de", 1), ("b@x.de", 2)], "email string, k int").write.parquet(path)
    table = LakeTable("s_pii.flat_pii", path)
    Run(spark, table, place, "r1", Change(action, ("email",))).run(flagged(spark, table, "k = 1"))
    rows = content(spark, table)
    assert len(rows) == left and "a@x.de" not in {r[0] for r in rows}


def test_row_match_ignores_points_in_time(spark, tmp_path, place):
    path = str(tmp_path / "timed")
    spark.sql(
        "SELECT * FROM VALUES ('a', 1, timestamp'2024-01-01'), ('a', 1, timestamp'2024-01-02'), "
        "('a', NULL, timestamp'2024-01-01'), ('b', 1, timestamp'2024-01-01') AS t(email, k, ts)"
    ).write.parquet(path)
    table = LakeTable("s_pii.timed_pii", path)
    rows = flagged(spark, table, "email = 'a' AND k = 1 AND day(ts) = 1")
    Run(spark, table, place, "r1", Change("mask", ("email",), match="columns")).run(rows)
    assert sorted(r[0] for r in content(spark, table)) == sorted([TOKEN, TOKEN, "a", "b"])


def test_nothing_flagged_changes_nothing(spark, table, place):
    files = data_files(table.path)
    audit = Run(spark, table, place, "r1", Change("delete")).run(flagged(spark, table, "false"))
    assert audit.isEmpty() and data_files(table.path) == files


@pytest.mark.parametrize("value", ["a}b", "a/b:c", "50% off", "[x]^'\"", None])
def test_odd_partition_is_emptied_and_purged(spark, tmp_path, place, value):
    path = str(tmp_path / "odd")
    rows = spark.createDataFrame([("a@x.de", 1, value), ("b@x.de", 2, "other")], "email string, k int, p string")
    rows.write.partitionBy("p").parquet(path)
    table = LakeTable("s_pii.odd_pii", path, ("p",))
    Run(spark, table, place, "r1", Change("delete")).run(flagged(spark, table, "k = 1"))
    assert [r[0] for r in content(spark, table)] == ["b@x.de"]
    assert len(data_files(place.backups)) == 1
    assert purge(spark, place, "a@x.de") == 1
    assert data_files(place.backups) == [] and read_manifest(spark, place).isEmpty()


def test_columns_of_newer_files_are_kept(spark, tmp_path, place):
    path = str(tmp_path / "evolved")
    old = spark.createDataFrame([("a@x.de", 1, "1"), ("b@x.de", 2, "1")], "email string, k int, p string")
    old.write.partitionBy("p").parquet(path)
    new = spark.createDataFrame([("a@x.de", 3, "more", "2")], "email string, k int, extra string, p string")
    new.write.mode("append").partitionBy("p").parquet(path)
    table = LakeTable("s_pii.evolved_pii", path, ("p",))
    run = Run(spark, table, place, "r1", Change("mask", ("email",)))
    run.run(flagged(spark, table, "email = 'a@x.de'"))
    assert sorted((r["k"], r["extra"]) for r in table.read(spark).collect()) == [(1, None), (2, None), (3, "more")]
    assert "more" in {r["extra"] for r in run.backup().collect()}
    short = replace(table, schema=old.schema)
    with pytest.raises(CheckFailed, match="extra"):
        Run(spark, short, place, "r2", Change("delete")).run(flagged(spark, table, "k = 2"))


def test_reused_run_id_is_refused(spark, table, place):
    change = Change("mask", ("email",))
    first, second = (spark.createDataFrame(f.collect(), f.schema) for f in (
        flagged(spark, table, "email = 'a@x.de'"), flagged(spark, table, "email = 'b@x.de'")))
    Run(spark, table, place, "r1", change).run(first)
    with pytest.raises(ValueError, match="other rows"):
        Run(spark, table, place, "r1", change).run(second)
    with pytest.raises(ValueError, match="other rows"):
        Run(spark, table, place, "r1", Change("delete")).run(first)
    assert "b@x.de" in {r[0] for r in content(spark, table)}


@pytest.mark.parametrize("lost", ["y=2024/m=02", "y=2024/m=10", "."])
def test_swap_stopped_inside_goes_on(spark, table, place, monkeypatch, lost):
    rows = flagged(spark, table, "email = 'a@x.de'")
    run = Run(spark, table, place, "r1", Change("mask", ("email",)))

    def stop(self, live):
        for file in Path(table.path, lost).rglob("part-*"):
            if "m=11" not in str(file):
                file.unlink()
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(Run, "_refuse_if_not_swapped", stop)
        with pytest.raises(OSError):
            run.run(rows)
    assert run.state() == "swapping"
    again = Run(spark, table, place, "r1", Change("mask", ("email",)))
    again.run()
    assert sorted(r[0] for r in content(spark, table)) == sorted([TOKEN] * 3 + ["b@x.de", "c@x.de"])
    again.restore()
    assert sorted(r[0] for r in content(spark, table)) == ["a@x.de"] * 3 + ["b@x.de", "c@x.de"]


def test_row_ids_do_not_depend_on_the_session(spark, tmp_path, place):
    path = str(tmp_path / "zoned")
    spark.sql("SELECT 'a@x.de' AS email, timestamp'2024-01-01 10:00:00' AS ts").write.parquet(path)
    table = LakeTable("s_pii.zoned_pii", path)
    rows = flagged(spark, table, "true")
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    unknown = rows.withColumn("row_id", F.lit("0"))
    with pytest.raises(CheckFailed):
        Run(spark, table, place, "r0", Change("delete")).run(unknown)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        Run(spark, table, place, "r1", Change("mask", ("email",))).run(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert content(spark, table)[0][0] == TOKEN


def test_whole_workflow_with_review(spark, table, place):
    """Search, report, one row kept by the reviewer, mask; a new search finds only that row."""
    def found():
        tables = {table.name: table.read(spark)}
        asked = spark.createDataFrame([("a@x.de",)], "subject string")
        return search(tables, asked, Settings(), columns=columns_of(spark, tables, partition_columns=("y", "m")),
                      partition_columns=("y", "m"))

    first = found()
    reported = report(first.hits)
    keep = reported.where(F.get_json_object("row_json", "$.note") == "ten").select(
        "subject", F.col("Source").alias("source"), F.col("Table Name").alias("table_name"), "row_id",
        F.lit("N").alias("update_flag"),
    )
    reviewed = apply_decisions(reported, keep)
    change = Change("mask", ("email", "user_id", "note"))
    audits = erase_reviewed(spark, {table.name: table}, reviewed, place, "r1", change, coverage=first.coverage())
    assert list(audits) == [table.name]
    again = found().hits.collect()
    assert [r["partition"] for r in again] == ["2024/10"]


@pytest.mark.parametrize("odd", [False, True])
def test_ids_of_texts_are_neither_kept_nor_told_apart(spark, table, place, monkeypatch, odd):
    """Two people ask for the same rows; some ids may be no text's."""
    asked = flagged(spark, table, "email = 'a@x.de'")
    asked = asked.unionByName(asked.withColumn("subject", F.lit("b@x.de")))
    if odd:
        given = [("a@x.de", i, r["row_json"]) for i in (None, "no id", "0" * 64) for r in asked.limit(1).collect()]
        asked = asked.unionByName(spark.createDataFrame(given, asked.schema))
    told = []
    tagged = erase.tag_flagged

    def watched(*given):
        told.append(given[-1])
        return tagged(*given)

    def stopped(run):
        raise OSError("stopped")

    monkeypatch.setattr(erase, "tag_flagged", watched)
    run = Run(spark, table, place, "r1", Change("delete"), allow_missing=True)
    with monkeypatch.context() as broken:
        broken.setattr(Run, "_swap", stopped)
        with pytest.raises(OSError):
            run.run(asked)
    kept = {r["row_id"] for r in spark.read.parquet(run.flagged_path).collect()}
    assert kept == ({None, "no id", "0" * 64} if odd else {None}) and told == [not odd] * 2
    audit = Run(spark, table, place, "r1", Change("delete"), allow_missing=True).run(asked)
    assert {r["partition"]: r["n_flagged"] for r in audit.collect()} == {"2024/02": 2, "2024/10": 1}
    assert sorted(r[0] for r in content(spark, table)) == ["b@x.de", "c@x.de"]


def test_denied_and_unsearched_tables(spark, table, place):
    reviewed = flagged(spark, table, "email = 'a@x.de'").select(
        "subject", F.lit("DataLake").alias("Source"), F.lit(table.name).alias("Table Name"),
        F.lit("Y").alias("update_flag"), "row_id", "row_json",
    )
    change = Change("delete")
    fine = spark.createDataFrame([("hit",)], "status string")
    assert erase_reviewed(spark, {}, reviewed, place, "r1", change, deny=[table.name], coverage=fine) == {}
    with pytest.raises(KeyError):
        erase_reviewed(spark, {}, reviewed, place, "r1", change, coverage=fine)
    cut = spark.createDataFrame([("not_searched",)], "status string")
    with pytest.raises(RuntimeError):
        erase_reviewed(spark, {table.name: table}, reviewed, place, "r1", change, coverage=cut)
    failed = spark.createDataFrame([("error",)], "status string")
    with pytest.raises(RuntimeError):
        erase_reviewed(spark, {table.name: table}, reviewed, place, "r1", change, coverage=failed)


def test_manifest_of_nothing(spark, place):
    assert rewrite.read_manifest(spark, place).isEmpty()


def test_folders_are_named_by_file_and_not_by_row(spark, tmp_path):
    """Several files in a partition, and values that folders spell with escapes."""
    rows = [(k, f"{k % 3}:%a b") for k in range(60)] + [(60, None)]
    path = str(tmp_path / "odd")
    spark.createDataFrame(rows, "n bigint, m string").repartition(4).write.partitionBy("m").parquet(path)
    df = LakeTable("t", path, ("m",)).read(spark)
    held, seen = rewrite.partition_folders(df, ("m",)), []

    class Watched:  # what reaches the driver comes out of rows grouped by file, with no work on names
        sparkSession = spark

        def select(self, *columns):
            seen.append(df.select(*columns)._jdf.queryExecution().optimizedPlan().toString())
            return df.select(*columns)

    assert rewrite.partition_folders(Watched(), ("m",)) == held
    assert seen and not any("regexp" in plan for plan in seen)
    assert set(held) == {("0:%a b",), ("1:%a b",), ("2:%a b",), (None,)}
    for (value,), folder in held.items():
        inside = {r["n"] for r in spark.read.parquet(folder.removeprefix("file:")).collect()}
        assert inside == {n for n, m in rows if m == value}


def test_text_is_made_of_rows_with_a_flagged_rows_numbers_only(spark):
    schema = "n bigint, k int, note string"
    rows = [(1, 1, "one"), (1, 1, "other"), (1, None, "null"), (2, 1, "two"), (None, None, "none"), (2**62, 1, None)] * 2
    df = spark.createDataFrame(rows, schema)
    with_text = df.select("*", row_id(df.columns).alias("row_id"), row_json(df.columns).alias("row_json"))
    wanted = with_text.where("note IN ('one', 'null') OR note IS NULL")
    plain = erase.tag_flagged(df, wanted)
    screened = erase.tag_flagged(df, wanted, numbers=["n", "k"])
    assert sorted(map(str, screened.collect())) == sorted(map(str, plain.collect()))
    assert screened.where(erase.is_flagged()).count() == 6 and screened.columns == plain.columns


def test_rewrite_screens_by_numbers_unless_a_row_has_none(spark, table, place):
    rows = flagged(spark, table, "user_id = 1")
    run = Run(spark, table, place, "r", Change("mask", ("email",)))
    run._back_up(rows)
    assert run._numbers(rows) == ["user_id"]  # partition columns are not among them
    assert "__word_0" in run._tagged()._jdf.queryExecution().analyzed().toString()
    unread = rows.unionByName(rows.withColumn("row_json", F.lit("{broken")))
    assert run._numbers(unread) == []
    assert run._tagged().where(rewrite.E.is_flagged()).count() == 3
