"""Erasure in plain folders, typed partitions and tables of the catalog; parallel runs; review conflicts."""

import uuid
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lethe import Change, CheckFailed, LakeTable, Places, Run, apply_decisions, erase_reviewed
from lethe.functions.identity import row_id, row_json
from lethe.operators import erase
from lethe.settings import LAKE
from lethe.sources.tables import PLAIN

ROWS = [
    ("a@x.de", 1, "one", "2024", "02"),
    ("b@x.de", 2, "two", "2024", "02"),
    ("a@x.de", 1, "ten", "2024", "10"),
    ("c@x.de", 3, "other", "2024", "11"),
]
SCHEMA = "email string, user_id bigint, note string, y string, m string"


@pytest.fixture
def place(tmp_path):
    return Places(*[str(tmp_path / n) for n in ("backups", "stage", "records")])


def flagged(df, condition="email = 'a@x.de'"):
    columns = df.columns
    return df.where(condition).select(
        F.lit("a@x.de").alias("subject"), row_id(columns).alias("row_id"), row_json(columns).alias("row_json")
    )


def plain_table(spark, tmp_path):
    root = tmp_path / "plain"
    for values in sorted({r[3:] for r in ROWS}):
        rows = [r[:3] for r in ROWS if r[3:] == values]
        spark.createDataFrame(rows, "email string, user_id bigint, note string").write.parquet(str(root.joinpath(*values)))
    return LakeTable("web_pii.visits_pii", str(root), ("y", "m"), layout=PLAIN)


def emails(df):
    return sorted((r["email"][:6], r["note"], r["y"], r["m"]) for r in df.collect())


def files(path):
    return sorted(str(p) for p in Path(path).rglob("part-*"))


def test_plain_folders_keep_their_names(spark, tmp_path, place):
    table = plain_table(spark, tmp_path)
    untouched = files(f"{table.path}/2024/11")
    assert sorted(map(tuple, table.read(spark).collect())) == sorted(ROWS)
    assert table.read_partitions(spark, [("2024", "10"), ("1999", "01")]).count() == 1
    Run(spark, table, place, "r1", Change("mask", ("email",))).run(flagged(table.read(spark)))
    left = emails(table.read(spark))
    assert [r for r in left if r[0] in ("b@x.de", "c@x.de")] == [("b@x.de", "two", "2024", "02"), ("c@x.de", "other", "2024", "11")]
    assert len(left) == 4 and "a@x.de" not in {r[0] for r in left}
    assert files(f"{table.path}/2024/11") == untouched
    assert sorted(p.name for p in Path(table.path, "2024").iterdir()) == ["02", "10", "11"]


def test_plain_delete_drops_folders_and_restore_brings_them_back(spark, tmp_path, place):
    table = plain_table(spark, tmp_path)
    run = Run(spark, table, place, "r1", Change("delete"))
    run.run(flagged(table.read(spark)))
    assert not Path(table.path, "2024", "10").exists() and table.read(spark).count() == 2
    run.restore()
    assert sorted(map(tuple, table.read(spark).collect())) == sorted(ROWS)


def test_plain_swap_goes_on_after_a_stop(spark, tmp_path, place, monkeypatch):
    from lethe.plans import rewrite

    table, moved = plain_table(spark, tmp_path), []

    def stops(spark, source, target, move=rewrite.move):
        if moved:
            raise OSError("lost")
        moved.append(target)
        move(spark, source, target)

    change, rows = Change("mask", ("email",)), flagged(table.read(spark))
    with monkeypatch.context() as broken:
        broken.setattr(rewrite, "move", stops)
        with pytest.raises(OSError):
            Run(spark, table, place, "r1", change).run(rows)
    Run(spark, table, place, "r1", change).run()
    assert len(moved) == 1 and table.read(spark).where("email = 'a@x.de'").count() == 0
    assert table.read(spark).count() == 4


@pytest.mark.parametrize("match", ["row_id", "columns"])
def test_typed_partitions_keep_their_spelling(spark, tmp_path, place, match):
    """Folders ``m=02`` that others read as the number 2."""
    path = str(tmp_path / "typed")
    spark.createDataFrame(ROWS, SCHEMA).write.partitionBy("y", "m").parquet(path)
    shown = spark.read.parquet(path)  # types as inferred: numbers
    assert dict(shown.dtypes)["m"] == "int"
    table = LakeTable("web_pii.visits_pii", path, ("y", "m"), partition_types=(("y", "int"), ("m", "int")))
    Run(spark, table, place, "r1", Change("mask", ("email",), match=match)).run(flagged(shown))
    assert table.read(spark).where("email = 'a@x.de'").count() == 0
    assert sorted(p.name for p in Path(path, "y=2024").iterdir() if p.is_dir()) == ["m=02", "m=10", "m=11"]


def test_table_of_the_catalog(spark, tmp_path, place):
    name = "default.visits_" + uuid.uuid4().hex
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr(
        "email", "user_id", "note", "cast(y as int) y", "make_date(2024, cast(m as int), 1) as m"
    )
    df.write.partitionBy("y", "m").option("path", str(tmp_path / "t")).saveAsTable(name)
    try:
        table = LakeTable.from_catalog(spark, name)
        assert table.partition_columns == ("y", "m") and dict(table.partition_types) == {"y": "int", "m": "date"}
        Run(spark, table, place, "r1", Change("delete")).run(flagged(spark.table(name)))
        assert sorted(r["email"] for r in spark.table(name).collect()) == ["b@x.de", "c@x.de"]
        assert len(spark.sql(f"SHOW PARTITIONS {name}").collect()) == 2
    finally:
        spark.sql(f"DROP TABLE {name}")
    spark.range(1).createOrReplaceTempView("no_files")
    with pytest.raises(ValueError):
        LakeTable.from_catalog(spark, "no_files")


def test_format_options_are_kept(spark, tmp_path, place):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.option("header", True).option("sep", ";").partitionBy("y", "m").csv(path)
    table = LakeTable("web_pii.visits_pii", path, ("y", "m"), "csv", options=(("header", "true"), ("sep", ";")))
    Run(spark, table, place, "r1", Change("delete")).run(flagged(table.read(spark)))
    assert sorted(r["email"] for r in table.read(spark).collect()) == ["b@x.de", "c@x.de"]
    assert all(Path(f).read_text().startswith("email;user_id;note\n") for f in files(path))


# --- several tables ----------------------------------------------------------------------------


def reviewed(rows, names):
    return [
        (name, r["subject"], r["row_id"], r["row_json"], LAKE, "Y") for name in names for r in rows.collect()
    ], "`Table Name` string, subject string, row_id string, row_json string, Source string, update_flag string"


def test_other_tables_go_on_when_one_fails(spark, tmp_path, place, monkeypatch):
    names = [f"web_pii.t{k}_pii" for k in range(3)]
    stored = {}
    for name in names:
        path = str(tmp_path / name)
        spark.createDataFrame(ROWS, SCHEMA).write.partitionBy("y", "m").parquet(path)
        stored[name] = LakeTable(name, path, ("y", "m"))
    report = spark.createDataFrame(*reviewed(flagged(stored[names[0]].read(spark)), names))
    covered = spark.createDataFrame([], "status string")
    go = lambda: erase_reviewed(spark, stored, report, place, "r1", Change("delete"), coverage=covered, parallel=2)
    with monkeypatch.context() as broken:
        stage = Run._stage

        def fails(self):
            if self.table.name == names[1]:
                raise CheckFailed("not this one")
            stage(self)

        broken.setattr(Run, "_stage", fails)
        with pytest.raises(CheckFailed):
            go()
    assert [stored[n].read(spark).count() for n in names] == [2, 4, 2]
    audits = go()
    assert [stored[n].read(spark).count() for n in names] == [2, 2, 2] and sorted(audits) == names


def test_conflicting_decisions_are_refused(spark):
    rows = spark.createDataFrame(
        [("a", LAKE, "t", "r1", "Y"), ("a", LAKE, "t", "r2", "Y")],
        "subject string, Source string, `Table Name` string, row_id string, update_flag string",
    )
    decide = lambda *d: spark.createDataFrame(
        [("a", LAKE, "t", *x) for x in d], "subject string, source string, table_name string, row_id string, update_flag string"
    )
    twice = apply_decisions(rows, decide(("r1", "N"), ("r1", "N"))).collect()
    assert sorted((r["row_id"], r["update_flag"]) for r in twice) == [("r1", "N"), ("r2", "Y")]
    with pytest.raises(PySparkException, match="conflicting decisions on row r1"):
        apply_decisions(rows, decide(("r1", "N"), ("r1", "Y"))).collect()


# --- multisets -----------------------------------------------------------------------------------


def test_counted_removal_of_a_hot_value(spark):
    """One value holds most rows; copies are taken off by counts."""
    values = ["hot"] * 5000 + [None] * 40 + [f"v{i % 50}" for i in range(500)]
    gone = ["hot"] * 1234 + [None] * 39 + ["v1"] * 99 + ["v2", "absent"]
    df = spark.createDataFrame([(v, 1) for v in values], "v string, n int").repartition(7)
    found = erase.remove_counted(df, spark.createDataFrame([(v, 1) for v in gone], "v string, n int"))
    counts = {r["v"]: r["count"] for r in found.groupBy("v").count().collect()}
    assert counts == {"hot": 3766, None: 1} | {f"v{i}": 10 for i in range(50) if i not in (1, 2)} | {"v2": 9}


def test_swap_check_sees_every_difference(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", None)], "v string, n int")
    masked = spark.createDataFrame([("x", 1), ("x", 1)], "v string, n int")
    right = spark.createDataFrame([("x", 1), ("x", 1), ("b", 2), ("c", None)], "v string, n int")
    row = erase.swap_check(old, right, masked).first()
    assert (row["n_added"], row["n_masked"], row["n_common"], row["passed"]) == (2, 2, 2, True)
    for wrong in ([("x", 1), ("x", 2)], [("x", 1), ("a", 1)], [("x", 1), ("x", 1), ("z", 0)]):
        new = spark.createDataFrame([*wrong, ("b", 2), ("c", None)], "v string, n int")
        assert not erase.swap_check(old, new, masked).first()["passed"]
