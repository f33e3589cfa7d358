"""What must not grow with the number of people: folders, keys that lead nowhere, text written with hits, shuffled reports."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lethe import Limits, SubjectStore, columns_of, search
from lethe.functions.identity import row_id, with_made_ids, without_made_ids
from lethe.operators import erase, linkage, review
from lethe.operators.lookup import Size, hot_keys, lookup_join
from lethe.scratch import children

WRITTEN = Limits(driver_rows=0, broadcast_rows=0)
HIT = "subject string, source string, table_name string, matched_column string, matched_value string, row_id string, partition string, row_json string"


@pytest.fixture(scope="module")
def found(spark):
    people = [(f"p{i}@x.de", i, i % 3) for i in range(6)]
    orders = [(100 + i, i % 6, i) for i in range(12)]
    tables = {
        "s_pii.people_pii": spark.createDataFrame(people, "email string, user_id int, own_id int"),
        "s_pii.orders_pii": spark.createDataFrame(orders, "order_key bigint, user_id bigint, item_key bigint"),
    }
    subjects = spark.createDataFrame([(p[0],) for p in people], "subject string")
    return search(tables, subjects, columns=columns_of(spark, tables), limits=WRITTEN)


def test_hits_are_stored_as_rows_and_read_as_hits(spark, found):
    stored = [c for p in (1, 2) for f in children(spark, f"{found.folder}/hits/pass={p}") for c in spark.read.parquet(f).columns]
    assert stored and not {"row_json", "row_id", "keys"} & set(stored)
    assert found.hits.columns == linkage.HIT_SCHEMA.fieldNames()
    row = found.hits.where("table_name = 's_pii.orders_pii' AND subject = 'p1@x.de'").orderBy("row_json").first()
    assert row["row_json"] == '{"order_key":101,"user_id":1,"item_key":1}' and row["pass"] == 2
    assert found.hits.count() == 6 + 12


def test_keys_that_lead_nowhere_are_no_search_values(spark, found):
    assert {(r["table_name"], r["column"]) for r in found.probes.collect()} == {
        ("s_pii.people_pii", "email"), ("s_pii.orders_pii", "user_id")
    }
    assert found.passes == 2  # orders' keys are in no other table, and people's in no third one


def test_rows_of_types_that_files_cannot_keep(spark):
    rows = spark.createDataFrame([("a@x.de",), ("b@x.de",)], "email string").withColumn("nothing", F.lit(None))
    tables = {"s_pii.people_pii": rows}
    people = spark.createDataFrame([("a@x.de",)], "subject string")
    hits = search(tables, people, columns=columns_of(spark, tables)).hits.collect()
    assert [h["row_json"] for h in hits] == ['{"email":"a@x.de","nothing":null}']


def test_no_key_is_frequent(spark):
    limits = Limits(broadcast_rows=0, max_hot_keys=10)
    even = spark.range(1000).select((F.col("id") % 100).alias("k"), "id")
    assert hot_keys(even, ["k"], limits) is None
    one = even.withColumn("k", F.when(F.col("id") < 300, 7).otherwise(F.col("k")))
    assert [r["k"] for r in hot_keys(one, ["k"], limits).collect()] == [7]
    few = spark.createDataFrame([(7, "x"), (8, "y")], "k bigint, v string")
    for rows in (even, one):
        assert lookup_join(rows, few, ["k"], "inner", limits).count() == rows.where("k in (7, 8)").count()


DECISIONS = "subject string, source string, table_name string, row_id string, update_flag string"


def reports(spark):
    once = [(f"s{i}", "DataLake", "t", "k", "1", f"r{i}", None, f'{{"a":{i}}}') for i in range(50)]
    twice = [("s1", "DataLake", "t", "k", v, "r1", None, '{"a":1}') for v in ("1", "2")] + [("s2", *once[3][1:])] * 3
    return spark.createDataFrame([*once, *twice, (None,) * 8, (None,) * 8], HIT)


def test_report_shuffles_repeated_rows_only(spark):
    found = review.report(reports(spark))
    copies = {(r["subject"], r["row_id"]): r["copies"] for r in found.collect()}
    assert len(copies) == found.count() == 52
    assert {k: n for k, n in copies.items() if n > 1} == {("s1", "r1"): 2, ("s2", "r3"): 3, (None, None): 2}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "__again" not in found.columns


@pytest.mark.parametrize("limits", [Limits(), WRITTEN])
@pytest.mark.parametrize("doubled", [False, True])
def test_report_of_parts_is_the_report_of_hits(spark, limits, doubled):
    """Rows found by several pairs, in several passes and with identical copies."""
    tables = chain(spark)
    if doubled:
        tables["s_pii.orders_pii"] = tables["s_pii.orders_pii"].unionByName(tables["s_pii.orders_pii"].where("order_key < 13"))
        text = F.when(F.col("user_id") < 3, F.lit(b"\xffa").cast("string")).otherwise("x")
        tables["s_pii.people_pii"] = tables["s_pii.people_pii"].withColumn("note", text).unionByName(
            tables["s_pii.people_pii"].withColumn("note", F.lit(b"\xfea").cast("string"))
        )
    people = tables["s_pii.people_pii"].select(F.col("email").alias("subject"))
    found = search(tables, people, columns=columns_of(spark, tables), close_tables=not doubled, max_passes=3, limits=limits)
    whole, parts = review.report(found.hits), review.report(found.hits, found.parts)
    assert parts.columns == whole.columns
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    assert (parts.where("copies > 1").count() > 0) == doubled
    made = parts.select("subject")._jdf.queryExecution().optimizedPlan().toString()
    assert doubled or "to_json" not in made  # nobody asked for text


@pytest.mark.parametrize("limits", [Limits(), Limits(driver_rows=0, literal_pairs=0), WRITTEN])
def test_matched_values_are_not_written(spark, limits):
    tables = chain(spark)
    tables["s_pii.orders_pii"] = tables["s_pii.orders_pii"].withColumn("second_key", F.col("order_key").cast("double"))
    tables["s_pii.notes_pii"] = spark.createDataFrame([(float(i), "x") for i in range(8, 14)], "second_key double, note string")
    people = tables["s_pii.people_pii"].select(F.col("email").alias("subject"))
    found = search(tables, people, columns=columns_of(spark, tables), limits=limits)
    for part in found.parts:
        files = part.rows.inputFiles()
        assert files and "__value" not in spark.read.parquet(*files).columns
    values = {(r["table_name"], r["matched_column"], r["matched_value"]) for r in found.hits.collect()}
    assert {("s_pii.notes_pii", "second_key", f"{i}.0") for i in range(10, 14)} <= values
    assert {("s_pii.people_pii", "email", f"p{i}@x.de") for i in range(4)} <= values and not any(v[2] is None for v in values)


def test_decisions_are_computed_once_and_for_their_tables_only(spark):
    reported = review.report(reports(spark))
    poison = F.when(F.col("Table Name") == "u", F.raise_error(F.lit("made"))).otherwise(F.col("row_id"))
    more = reported.unionByName(reported.where("subject = 's3'").withColumn("Table Name", F.lit("u")).withColumn("row_id", poison))
    calls = spark.sparkContext.accumulator(0)
    some = spark.createDataFrame([("s1", "DataLake", "t", "r1", "N"), (None, "DataLake", None, None, "N")], DECISIONS)
    counted = some.mapInArrow(lambda batches: (calls.add(1) or b for b in batches if b.num_rows), some.schema)
    done = review.apply_decisions(more, counted)
    once = calls.value
    assert done.groupBy("update_flag").count().count() == 2 and done.where("update_flag = 'N'").count() == 1
    assert calls.value == once
    assert done.select("Table Name").where("`Table Name` = 'u'").count() == 1


def test_decisions_on_some_rows(spark):
    reported = review.report(reports(spark))
    schema = "subject string, source string, table_name string, row_id string, update_flag string"
    some = [("s1", "DataLake", "t", "r1", "N"), ("s5", "DataLake", "t", "r5", "N"), ("s6", "DataLake", "t", "r6", None), ("no", "DataLake", "t", "r1", "N")]
    done = review.apply_decisions(reported, spark.createDataFrame(some, schema))
    assert done.columns == reported.columns and done.count() == 52
    assert {r["subject"] for r in done.where("update_flag = 'N'").collect()} == {"s1", "s5"}
    clash = spark.createDataFrame([*some, ("no", "DataLake", "t", "r1", "Y")], schema)
    with pytest.raises(PySparkException, match="conflicting"):
        review.apply_decisions(reported, clash).collect()


def test_reports_of_many_people_in_few_folders(spark, tmp_path):
    reported = review.report(reports(spark)).where("subject IS NOT NULL")
    path = str(tmp_path / "report")
    review.write_report(reported, path, buckets=4)
    assert len([f for f in children(spark, path) if "=" in f]) <= 4
    back = review.read_report(spark, path)
    assert set(back.columns) == set(reported.columns)
    assert sorted(map(str, back.select(*reported.columns).collect())) == sorted(map(str, reported.collect()))


def chain(spark):
    """People, their orders, the orders' items and the items' makers."""
    return {
        "s_pii.people_pii": spark.createDataFrame([(f"p{i}@x.de", i) for i in range(4)], "email string, user_id int"),
        "s_pii.orders_pii": spark.createDataFrame([(10 + i, i % 4) for i in range(8)], "order_key int, user_id int"),
        "s_pii.items_pii": spark.createDataFrame([(10 + i % 8, i % 3) for i in range(24)], "order_key int, maker_key int"),
        "s_pii.makers_pii": spark.createDataFrame([(i,) for i in range(3)], "maker_key int"),
    }


def test_the_only_searched_column_leads_nowhere(spark, monkeypatch):
    def never(*args, **options):
        raise AssertionError("closed tables were looked up")

    monkeypatch.setattr(linkage, "still_open", never)
    tables = chain(spark)
    people = tables["s_pii.people_pii"].select(F.col("email").alias("subject"))
    found = search(tables, people, columns=columns_of(spark, tables), limits=WRITTEN)
    assert found.passes == 4 and found.complete
    counts = {r["table_name"]: r["count"] for r in found.hits.groupBy("table_name").count().collect()}
    assert counts == {"s_pii.people_pii": 4, "s_pii.orders_pii": 8, "s_pii.items_pii": 24, "s_pii.makers_pii": 12}


@pytest.mark.parametrize("first_match", [False, True])
def test_hits_are_shuffled_into_a_store_as_they_are_kept(spark, tmp_path, first_match):
    tables = chain(spark)
    people = tables["s_pii.people_pii"].select(F.col("email").alias("subject"))
    found = search(tables, people, columns=columns_of(spark, tables), limits=WRITTEN, first_match=first_match)
    store = SubjectStore(spark, str(tmp_path / "hits"), found.hits.schema, 3)
    store.append_hits(found)
    assert len([f for f in children(spark, store.path) if "=" in f]) <= 3
    assert sorted(map(str, store.read().collect())) == sorted(map(str, found.hits.collect()))
    assert {r["subject"] for r in store.read(["p1@x.de"]).collect()} == {"p1@x.de"}
    if not first_match:
        assert not any({"row_json", "row_id"} & set(part.rows.columns) for part in found.parts)
    reports = SubjectStore(spark, str(tmp_path / "report"), review.report(found.hits).schema, 3)
    reports.append(review.report(store.read()), placed=True)
    assert sorted(map(str, reports.read().collect())) == sorted(map(str, review.report(found.hits).collect()))
    assert reports.purge(["p1@x.de"]) == store.purge(["p1@x.de"]) == 1


def test_edits_shuffle_changed_rows_only(spark, tmp_path):
    reported = review.report(reports(spark)).where("subject IS NOT NULL")
    path, copy = str(tmp_path / "report"), str(tmp_path / "edited")
    review.write_report(reported, path, buckets=4)
    written = review.read_report(spark, path)
    flag = F.when(F.col("row_id") == "r7", " n").otherwise(F.col("update_flag"))
    review.write_report(written.where("row_id <> 'r9'").withColumn("update_flag", flag), copy, buckets=4, placed=True)
    edited = review.read_report(spark, copy)
    done = review.apply_edits(written, edited)
    assert {r["row_id"] for r in done.where("update_flag = 'N'").collect()} == {"r7", "r9"}
    unflagged = [c for c in reported.columns if c != "update_flag"]
    assert sorted(map(str, done.select(unflagged).collect())) == sorted(map(str, reported.select(unflagged).collect()))
    assert done.collect()  # the plan as it ran
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "BroadcastHashJoin" in plan  # lines are compared once; a filter tells the changed ones
    # what was flagged before the edit counts for nothing
    before = written.withColumn("update_flag", F.when(F.col("row_id") == "r3", "N").otherwise(F.col("update_flag")))
    again = review.apply_edits(before, edited)
    assert {r["row_id"] for r in again.where("update_flag = 'N'").collect()} == {"r7", "r9"}
    with pytest.raises(PySparkException, match="not reported"):
        review.apply_edits(written.limit(0), edited).collect()
    with pytest.raises(PySparkException, match="not reported"):
        unknown = review.apply_edits(written.where("row_id <> 'r5'"), edited)
        review.flagged_rows(unknown, "no source").where("copies > 5 AND row_id = 'r1'").collect()


ID_A, ID_B = "0a" * 32, "0A" * 32


@pytest.mark.parametrize(
    "own,given,wanted",
    [
        ("aY bY", "aY bY", "aY bY"),
        ("aY bY", "bY aY", "aY bY"),
        ("aY bY", "aY aY", "aY bN"),
        ("aY bY", "aY", "aY bN"),
        ("aN bN", "aY bN", "aY bN"),
        ("aN bN", "aN bN", "aN bN"),
        ("aY bY", "aY bY bN", "conflicting"),
        ("aY aN", "aY aN", "conflicting"),
        ("aY bx", "aY bx", "no valid flag"),
        ("aY bY", "aY cY", "not reported"),
        ("aY bY cY", "aY dY eY", "not reported"),
        ("aY", "aY aY aY", "aY"),
    ],
)
def test_edits_are_told_by_sums_first(spark, own, given, wanted):
    """The lines of one person; another's stay as they are."""
    ids = {"a": ID_A, "b": ID_B, "c": None, "d": "r", "e": ""}

    def lines(text):
        return spark.createDataFrame(
            [(s, "DataLake", "t", x[1], 1, None, ids[x[0]], "{}") for s, ls in (("s1", text), ("s2", "aY bY cY"), (None, "dY")) for x in ls.split()],
            review.REPORT_SCHEMA,
        )

    done = review.apply_edits(lines(own), lines(given))
    if wanted[1] not in "YN":
        with pytest.raises(PySparkException, match=wanted):
            done.collect()
        return
    found = done.collect()
    assert {(r["row_id"], r["update_flag"]) for r in found if r["subject"] == "s1"} == {(ids[x[0]], x[1]) for x in wanted.split()}
    assert [r["update_flag"] for r in found if r["subject"] != "s1"] == ["Y"] * 4


def test_unedited_lines_are_not_shuffled(spark, tmp_path):
    reported = spark.range(4000).select(
        F.concat(F.lit("s"), (F.col("id") % 10).cast("string")).alias("subject"), F.lit("DataLake").alias("Source"), F.lit("t").alias("Table Name"),
        F.lit("Y").alias("update_flag"), F.lit(1).cast("bigint").alias("copies"), F.lit(None).cast("string").alias("partition"),
        F.sha2(F.col("id").cast("string"), 256).alias("row_id"), F.col("id").cast("string").alias("row_json"),
    )
    path = str(tmp_path / "report")
    review.write_report(reported, path, buckets=4)
    written = review.read_report(spark, path)
    flag = F.when(F.col("subject") == "s3", "N").otherwise(F.col("update_flag"))
    review.apply_edits(written, written.withColumn("update_flag", flag)).write.parquet(str(tmp_path / "done"))
    done = spark.read.parquet(str(tmp_path / "done"))
    assert done.groupBy("update_flag").count().where("update_flag = 'N'").first()["count"] == 400
    # what is compared line by line: both reports' lines of s3
    compared = review.differing_lines(written, written.withColumn("update_flag", flag))
    assert compared.select("subject").distinct().collect() == [("s3",)] and compared.count() == 800


def test_made_ids_are_left_out_of_a_shuffle(spark):
    rows = spark.createDataFrame(
        [('{"a":1}', None), (None, None), ("", "x"), ('{"a":2}', "r"), (None, "r")], "row_json string, row_id string"
    )
    rows = rows.unionByName(rows.withColumn("row_id", F.sha2("row_json", 256)))
    kept = without_made_ids(rows)
    assert {r["row_id"] for r in kept.collect()} == {None, "x", "r"}
    assert sorted(map(str, with_made_ids(kept).collect())) == sorted(map(str, rows.collect()))


def test_rows_without_another_key_are_not_sorted(spark):
    hits = spark.createDataFrame(
        [("a", "S", "t", "k", "1", [("k", "1")], "r1"), ("a", "S", "u", "k", "1", [("k", "1"), ("j", "5")], "r2"),
         ("a", "S", "u", "k", "1", [("k", "1"), ("j", None)], "r1")],
        "subject string, source string, table_name string, matched_column string, matched_value string, "
        "keys array<struct<column:string,value:string>>, row_id string",
    ).withColumn("order_key", F.lit(None).cast(linkage.SORT_KEY))
    poison = F.when(F.col("table_name") == "t", F.raise_error(F.lit("sorted"))).otherwise(F.col("row_id"))
    assert linkage.harvest(hits.withColumn("row_id", poison), "first").collect() == []  # the first row's other key is null
    later = hits.withColumn("row_id", F.when(F.col("row_id") == "r1", "r3").otherwise(F.col("row_id")))
    assert [tuple(r) for r in linkage.harvest(later, "first").collect()] == [("a", "j", "5")]


@pytest.mark.parametrize("dtype", ["tinyint", "bigint", "string", "double"])
@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, max_hot_keys=3, salts=3)])
def test_search_values_that_are_not_the_text_of_a_number(spark, tmp_path, dtype, limits):
    given = ["5", "05", " 5", "+5", "5.0", "-3", "-0", "300", "99999999999999999999", "x", ""]
    kept = {"tinyint": ["5", "-3"], "bigint": ["5", "-3", "300"], "string": given, "double": ["5.0"]}[dtype]
    values = spark.createDataFrame([(f"s{i}", "a.key", v, "t") for i, v in enumerate(given * 2)], linkage.PROBE_SCHEMA)
    texts = [(v,) for v in [*(given if dtype == "string" else ["5", "-3", "0", "7"]), *(["300"] if dtype == "bigint" else []), None]]
    table = spark.createDataFrame(texts, "v string").select(F.col("v").cast(dtype).alias("a.key"), F.col("v").alias("note"))
    table.write.parquet(str(tmp_path / "t"))
    found = linkage.matches(spark.read.parquet(str(tmp_path / "t")), values, ["a.key"], Size(22, 2_000), limits)
    assert found.columns == ["a.key", "note", "__subject", "__column", "__value"]
    rows = [(r["__value"], r["__column"], int(r["__subject"][1:])) for r in found.collect()]
    assert sorted(rows) == sorted((v, "a.key", i) for i, v in enumerate(given * 2) if v in kept)


@pytest.mark.parametrize("dtype", ["bigint", "string"])
def test_the_text_of_a_searched_column_is_not_shuffled(spark, tmp_path, dtype):
    spark.range(1000).select(F.col("id").cast(dtype).alias("user_id")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    values = spark.range(100).selectExpr("concat('s', id) subject", "'user_id' column", "cast(id AS string) value", "'t' table_name")
    found = linkage.matches(table, values, ["user_id"], Size(100, 10_000), Limits(broadcast_rows=10, literal_pairs=10))
    joined = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert joined and "user_id" in joined[0] and "__value" not in joined[0]
    assert found.where("__value = cast(user_id AS string) AND __subject = concat('s', __value)").count() == 100


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, max_hot_keys=3, salts=3)])
def test_ids_are_joined_as_bytes(spark, monkeypatch, limits):
    joined = []

    def watched(big, lookup, on, *more):
        joined.append({df.schema[on[0]].dataType.simpleString() for df in (big, lookup)})
        return lookup_join(big, lookup, on, *more)

    monkeypatch.setattr(erase, "lookup_join", watched)
    rows = spark.range(9).select("id", F.lit("x").alias("note"))
    given = rows.where("id < 4").select("id", row_id(rows.columns).alias("row_id"))
    odd = F.when(F.col("id") == 1, F.upper("row_id")).when(F.col("id") == 2, F.concat("row_id", F.lit("\n")))
    flagged = given.select(F.coalesce(odd, F.when(F.col("id") < 3, F.col("row_id"))).alias("row_id"))
    flagged = flagged.unionByName(flagged).unionByName(spark.createDataFrame([("no id",), ("",)], "row_id string"))
    tagged = erase.tag_flagged(rows, flagged, limits)
    assert tagged.count() == 9 and [r["id"] for r in tagged.where(erase.is_flagged()).collect()] == [0]
    assert joined == [{"binary"}]
