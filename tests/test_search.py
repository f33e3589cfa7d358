"""The search against a brute-force walk, and its edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from lethe import Limits, Settings, columns_of, search, search_two_pass
from lethe.operators import linkage
from lethe.plans.search import ERROR, HIT, NO_COLUMN, NO_VALUE, SearchFailed
from samples import lake
from samples.queries import QUERIES
from tests.conftest import SMALL

SHUFFLED = Limits(driver_rows=0, literal_pairs=0, broadcast_rows=0, max_hot_keys=3, salts=3)
WRITTEN = Limits(driver_rows=0)


def subjects(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "subject string")


def run(spark, tables, *names, settings=Settings(), **options):
    return search(
        tables, subjects(spark, *names), settings, columns=columns_of(spark, tables), **options
    )


def hits(result):
    rows = result.hits.select("subject", "table_name", "pass", "matched_column", "matched_value", "row_json")
    return sorted(tuple(r) for r in rows.collect())


def walk(tables, names, link, keys, close=True):
    """The same search, row by row, over lists of dicts."""
    found = []
    for subject in names:
        open_tables = set(tables)
        frontier = {(c, subject) for c in link}
        seen = set()
        number = 0
        while frontier and (open_tables or not close):
            number += 1
            seen |= frontier
            new, hit_tables = set(), set()
            for t in sorted(open_tables):
                for row in tables[t]:
                    for column, value in frontier:
                        if row.get(column) is not None and str(row[column]) == value:
                            found.append((subject, t, number, column, value, str(sorted(row.items(), key=str))))
                            hit_tables.add(t)
                            new |= {
                                (c, str(row[c]))
                                for c in keys
                                if c != column and row.get(c) is not None
                            }
            if close:
                open_tables -= hit_tables
                frontier = new
            else:
                frontier = new - seen
    return sorted(found)


def random_lake(seed):
    rnd = random.Random(seed)
    columns = {
        "a_pii.users_pii": ("email", "user_id"),
        "a_pii.carts_pii": ("user_id", "cart_key", "owner_email"),
        "a_pii.lines_pii": ("cart_key", "item_key"),
        "a_pii.items_pii": ("item_key", "shop_id"),
        "a_pii.notes_pii": ("text",),
    }

    def value(column):
        if rnd.random() < 0.15:
            return None
        if "email" in column:
            return f"p{rnd.randrange(4)}@x.de"
        # one value in three is the same: a hot key
        return 1 if rnd.random() < 0.33 else rnd.randrange(6)

    return columns, {
        t: [{c: value(c) for c in cs} for _ in range(rnd.randrange(1, 12))] for t, cs in columns.items()
    }


def as_tables(spark, columns, rows):
    result = {}
    for t, cs in columns.items():
        schema = ", ".join(f"{c} {'string' if 'email' in c or c == 'text' else 'bigint'}" for c in cs)
        data = [tuple(str(r[c]) if c == "text" and r[c] is not None else r[c] for c in cs) for r in rows[t]]
        result[t] = spark.createDataFrame(data, schema)
    return result


@pytest.mark.parametrize("seed,close,limits", [
    (1, True, Limits()),
    (2, True, SHUFFLED),
    (3, False, Limits()),
    (4, False, SHUFFLED),
    (5, True, WRITTEN),
])
def test_equals_brute_force(spark, seed, close, limits):
    columns, rows = random_lake(seed)
    names = ["p0@x.de", "p1@x.de", "nobody@x.de"]
    tables = as_tables(spark, columns, rows)
    result = run(spark, tables, *names, close_tables=close, limits=limits)
    found = sorted(
        (r["subject"], r["table_name"], r["pass"], r["matched_column"], r["matched_value"])
        for r in result.hits.collect()
    )
    link = ["email", "owner_email"]
    keys = [*link, "user_id", "cart_key", "item_key", "shop_id"]
    assert found == [h[:5] for h in walk(rows, names, link, keys, close)]


@pytest.fixture(scope="module")
def shop(spark):
    people = [("a@x.de", 1, "A"), ("aa@x.de", 2, "B"), ("b@x.de", None, "C")]
    orders = [(10, 1), (11, 1), (12, 2), (13, None)]
    return {
        "s_pii.people_pii": spark.createDataFrame(people, "email string, user_id int, name string"),
        "s_pii.orders_pii": spark.createDataFrame(orders, "order_key bigint, user_id bigint"),
        "s_pii.diary_pii": spark.createDataFrame([("x",)], "note string"),
        "s_pii.logs": spark.createDataFrame([("a@x.de",)], "email string"),
    }


def test_address_must_match_whole(spark, shop):
    found = hits(run(spark, shop, "a@x.de"))
    assert [(h[1], h[2]) for h in found] == [
        ("s_pii.orders_pii", 2), ("s_pii.orders_pii", 2), ("s_pii.people_pii", 1)
    ]
    assert all("aa@x.de" not in h[5] for h in found)


def test_null_keys_are_not_followed(spark, shop):
    assert [h[1] for h in hits(run(spark, shop, "b@x.de"))] == ["s_pii.people_pii"]


def test_two_people_at_once_equal_each_alone(spark, shop):
    both = hits(run(spark, shop, "a@x.de", "aa@x.de"))
    assert both == sorted(hits(run(spark, shop, "a@x.de")) + hits(run(spark, shop, "aa@x.de")))


def test_unknown_person_ends(spark, shop):
    result = run(spark, shop, "nobody@x.de")
    assert result.passes == 1 and result.hits.isEmpty()


def test_coverage_tells_why(spark, shop):
    result = run(spark, shop, "a@x.de", "nobody@x.de")
    status = {(r["subject"], r["table_name"]): r["status"] for r in result.coverage().collect()}
    assert status[("a@x.de", "s_pii.people_pii")] == HIT
    assert status[("a@x.de", "s_pii.diary_pii")] == NO_COLUMN
    assert status[("nobody@x.de", "s_pii.people_pii")] == NO_VALUE
    assert ("a@x.de", "s_pii.logs") not in status  # no personal table
    assert result.open_tables().count() == 1 + 3


def test_unreadable_table_is_reported(spark, shop, tmp_path):
    path = str(tmp_path / "broken")
    shop["s_pii.people_pii"].coalesce(1).write.parquet(path)
    broken = spark.read.schema("email string, user_id int, name string").parquet(path)
    for file in (tmp_path / "broken").glob("part-*.parquet"):
        file.write_bytes(b"no parquet at all, but long enough to be looked at")
    for file in (tmp_path / "broken").glob(".part-*.crc"):
        file.write_bytes(b"")
    tables = {**shop, "t_pii.broken_pii": broken}
    result = run(spark, tables, "a@x.de")
    status = {r["table_name"]: r["status"] for r in result.coverage().collect()}
    assert status["t_pii.broken_pii"] == ERROR
    assert status["s_pii.orders_pii"] == HIT


@pytest.mark.parametrize("limits", [Limits(), WRITTEN, SHUFFLED, Limits(broadcast_rows=0), Limits(literal_pairs=0)])
def test_unreadable_table_is_an_error_under_all_limits(spark, shop, tmp_path, limits):
    path = str(tmp_path / "gone")
    spark.createDataFrame([("a@x.de", 1)], "email string, custkey long").write.parquet(path)
    broken = spark.read.parquet(path)
    for file in (tmp_path / "gone").glob("part-*"):
        file.write_bytes(b"no parquet")
    whole = run(spark, shop, "a@x.de", limits=limits)
    found = run(spark, {**shop, "crm_pii.broken_pii": broken}, "a@x.de", limits=limits)
    assert hits(found) == hits(whole)
    status = {r["table_name"]: r["status"] for r in found.coverage().collect()}
    assert status["crm_pii.broken_pii"] == ERROR


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED])
def test_unreadable_table_ends_a_search_for_hits_alone(spark, shop, tmp_path, limits):
    path = str(tmp_path / "gone")
    spark.createDataFrame([("a@x.de", 1)], "email string, custkey long").write.parquet(path)
    broken = spark.read.parquet(path)
    for file in (tmp_path / "gone").glob("part-*"):
        file.write_bytes(b"no parquet")
    with pytest.raises(SearchFailed, match="crm_pii.broken_pii"):
        run(spark, {**shop, "crm_pii.broken_pii": broken}, "a@x.de", limits=limits, allow_errors=False)
    columns = columns_of(spark, {**shop, "crm_pii.broken_pii": broken})
    with pytest.raises(SearchFailed, match="not available"):
        search(shop, subjects(spark, "a@x.de"), columns=columns, allow_errors=False)


@pytest.mark.parametrize("name", ["link_by_edited_lists", "link_fixpoint_everybody"])
def test_query_fails_with_an_unreadable_table(spark, tmp_path, monkeypatch, name):
    path = str(tmp_path / "gone")
    lake.supplier_pii(spark, SMALL).write.parquet(path)
    broken = spark.read.parquet(path)
    for file in (tmp_path / "gone").glob("part-*"):
        file.write_bytes(b"no parquet")
    monkeypatch.setitem(lake.VIEWS, "ref_pii.supplier_pii", lambda spark, sf_dir: broken)
    with pytest.raises(SearchFailed, match="ref_pii.supplier_pii"):
        QUERIES[name](spark, SMALL)


ODD = ["${spark.app.name}", "it's", 'a"b', "back\\slash", "tick`s", "two\nlines", "%s {x}", "\\u0041"]


@pytest.mark.parametrize("limits", [Limits(), WRITTEN, SHUFFLED, Limits(literal_pairs=0), Limits(broadcast_rows=0)])
def test_odd_values_are_found_under_all_limits(spark, limits):
    emails = [f"{x}@x.de" for x in ODD]
    tables = {
        "a_pii.one_pii": spark.createDataFrame([(e, f"k{x}") for e, x in zip(emails, ODD)], "email string, refkey string"),
        "a_pii.two_pii": spark.createDataFrame([(f"k{x}", i) for i, x in enumerate(ODD)], "refkey string, n int"),
    }
    found = run(spark, tables, *emails, limits=limits)
    assert found.complete
    got = sorted((r["subject"], r["table_name"]) for r in found.hits.collect())
    assert got == sorted((e, t) for e in emails for t in tables)


def test_a_search_that_was_cut_says_so(spark, shop):
    cut = run(spark, shop, "a@x.de", max_passes=1)
    assert not cut.complete
    status = {r["status"] for r in cut.coverage().collect()}
    assert "not_searched" in status and NO_COLUMN not in status and NO_VALUE not in status
    assert run(spark, shop, "a@x.de").complete


def test_missing_table_is_reported(spark, shop):
    columns = columns_of(spark, shop)
    some = {k: v for k, v in shop.items() if "orders" not in k}
    result = search(some, subjects(spark, "a@x.de"), columns=columns)
    status = {r["table_name"]: r["status"] for r in result.coverage().collect()}
    assert status["s_pii.orders_pii"] == ERROR


def test_excluded_keys_do_not_link(spark, shop):
    result = run(spark, shop, "a@x.de", settings=Settings(exclude_keys=frozenset({"user_id"})))
    assert [h[1] for h in hits(result)] == ["s_pii.people_pii"]


def test_text_numbers_match_exactly(spark):
    df = spark.createDataFrame([(5, "5", 5.0), (50, "05", 0.5)], "i int, s string, d double")
    count = lambda c, v: linkage.find_by_value(df, c, v).count()
    assert (count("i", "5"), count("i", "05"), count("i", "5.0"), count("i", "x")) == (1, 0, 0, 0)
    assert (count("i", "99999999999999999999"), count("i", "-0")) == (0, 0)
    assert (count("s", "5"), count("s", "05")) == (1, 1)
    assert (count("d", "5.0"), count("d", "5")) == (1, 0)


def test_value_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("other", F.lit("x")).write.parquet(path)
    plan = linkage.find_by_value(spark.read.parquet(path), "id", "7")._jdf.queryExecution().toString()
    assert "EqualTo(id,7)" in plan or "In(id, [7])" in plan


def test_first_row_by_stated_order(spark, shop):
    lines = spark.createDataFrame([(10, "p"), (11, "q")], "order_key bigint, item string")
    tables = {**shop, "s_pii.lines_pii": lines}
    options = {"harvest": "first", "order_columns": {"s_pii.orders_pii": ["order_key"]}}
    found = [h for h in hits(run(spark, tables, "a@x.de", **options)) if "lines" in h[1]]
    assert [h[4] for h in found] == ["10"]
    found = [h for h in hits(run(spark, tables, "a@x.de")) if "lines" in h[1]]
    assert [h[4] for h in found] == ["10", "11"]


def test_two_pass_takes_lowest_pair(spark):
    tables = {
        "w.a_pii": spark.createDataFrame([("a@x.de", 1, 9), ("a@x.de", 2, 9)], "email string, k_id int, z_id int"),
        "w.b_pii": spark.createDataFrame([(1, 9), (2, 9), (3, 9)], "k_id int, z_id int"),
        "w.c_pii": spark.createDataFrame([(3,)], "b_only_id int"),
    }
    columns = columns_of(spark, tables, source="Redshift")
    result = search_two_pass(tables, subjects(spark, "a@x.de"), columns=columns, source="Redshift")
    found = hits(result)
    assert [(h[1], h[2], h[3], h[4]) for h in found if "b_pii" in h[1]] == [("w.b_pii", 2, "k_id", "1")]


def test_lowest_pair_is_chosen_before_text_is_made(spark):
    """Of subjects with one pair and with several, also where the subjects to look up are too many to broadcast."""
    people = [("a@x.de", 1), ("a@x.de", 2), ("b@x.de", 2), ("c@x.de", 4), ("c@x.de", 3)]
    tables = {
        "w.a_pii": spark.createDataFrame(people, "email string, k_id int"),
        "w.b_pii": spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (3, None), (4, "z")], "k_id int, note string"),
    }
    columns = columns_of(spark, tables, source="Redshift")
    wanted = subjects(spark, "a@x.de", "b@x.de", "c@x.de")
    for limits in (Limits(), Limits(driver_rows=0, broadcast_rows=0)):
        result = search_two_pass(tables, wanted, columns=columns, source="Redshift", limits=limits)
        assert all("__subject" in part.rows.columns and "row_json" not in part.rows.columns for part in result.parts)
        found = [(h["subject"], h["matched_value"]) for h in result.hits.where("table_name = 'w.b_pii'").collect()]
        assert sorted(found) == [("a@x.de", "1"), ("b@x.de", "2"), ("b@x.de", "2"), ("c@x.de", "3")]


def test_discard_removes_the_files(spark, shop):
    from lethe.scratch import exists

    result = run(spark, shop, "a@x.de")
    assert exists(spark, result.folder)
    result.discard()
    assert not exists(spark, result.folder)
