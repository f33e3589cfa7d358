"""Line dedup against plain edit distances."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lethe.llm import lines, queries
from lethe.llm.frames import table
from tests.conftest import SMALL
from tests.llm.test_screening import documents


def distance(a, b, most):
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return min(row[-1], most + 1)


def edited(text, n, rng):
    for _ in range(n):
        i = rng.randrange(len(text) + 1)
        kind = rng.randrange(3)
        text = text[:i] + (rng.choice("abé") if kind else "") + text[i + (kind != 1) :]
    return text


@pytest.mark.parametrize("errors", [1, 2, 4])
def test_edit_distance_equals_plain(spark, errors):
    rng = random.Random(errors)
    pairs = [("", ""), ("a", ""), ("", "abc"), ("abc", "xyz"), ("kitten", "sitting"), ("😀é", "é😀")]
    for _ in range(300):
        a = "".join(rng.choice("ab é") for _ in range(rng.randrange(0, 60)))
        pairs.append((a, edited(a, rng.randrange(0, errors + 3), rng)))
    a = "".join(rng.choice("abcdefg") for _ in range(3000))
    pairs += [(a, edited(a, errors, rng)), (a, a[::-1])]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.withColumn("d", lines.edit_distance(F.col("a"), F.col("b"), errors)).collect():
        assert r["d"] == distance(r["a"], r["b"], errors), (r["a"], r["b"])


@pytest.mark.parametrize("hot,errors", [(512, 2), (3, 2), (2, 1)])
def test_links_equal_plain(spark, hot, errors):
    rng = random.Random(hot)
    made = {"".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30, 50))) for _ in range(25)}
    for x in sorted(made)[:12]:
        made |= {edited(x, rng.randrange(1, errors + 2), rng) for _ in range(12)}
    made |= {f"the same words stand before the number {i} in here" for i in range(60)}
    texts = sorted(made)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = [tuple(sorted(r)) for r in lines.line_links(df, errors, hot).collect()]
    expected = {
        (i, j) for j, y in enumerate(texts) for i, x in enumerate(texts[:j]) if distance(x, y, errors) <= errors
    }
    assert len(found) == len(set(found)) and set(found) == expected


def plain_whole_report(docs, errors=lines.ERRORS):
    """Copies of any length go; one edit links for each 15 characters of the shorter line, ``errors`` at most."""
    key = lambda p: (p[0] is not None, p[0] or 0, p[1])
    first, by_size = {}, {}
    for i, t in docs:
        for no, x in enumerate((t or "").split("\n")):
            if x:
                first[x] = min(first.get(x, (i, no)), (i, no), key=key)
    for x in first:
        by_size.setdefault(len(x), []).append(x)
    letters = {x: Counter(x) for x in first}

    def close(x, y):
        most = min(errors, min(len(x), len(y)) // 15)
        if x == y or abs(len(x) - len(y)) > most:
            return False
        # an edit changes the counts of two letters by one each at most
        apart = sum(((letters[x] - letters[y]) + (letters[y] - letters[x])).values())
        return apart <= 2 * most and distance(x, y, most) <= most

    near = {
        x: [y for size in range(len(x) - errors, len(x) + errors + 1) for y in by_size.get(size, []) if close(x, y)]
        for x in first
    }
    gone = {x for x in first if any(key(first[y]) < key(first[x]) for y in near[x])}
    out = []
    for i, t in docs:
        parts = (t or "").split("\n")
        drop = [no for no, x in enumerate(parts) if x and (x in gone or first[x] != (i, no))]
        out.append((i, len(parts), len(drop), sum(len(near[x]) for x in parts if x), ",".join(map(str, drop))))
    return out


def test_line_report_equals_plain(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    found = queries.op3_line_dedup(spark, SMALL).collect()
    assert sorted(map(tuple, found)) == sorted(plain_whole_report(docs))


LINE = "this line is long enough to be looked at by the join"
CASES = [
    (5, f"{LINE}\nshort\n{LINE}!\nshort"),
    (3, f"x\n{LINE}"),
    (None, f"{LINE}??\nsome other line that is long enough to matter"),
    (7, None), (8, ""), (9, f"{LINE}\n" * 3), (9, f"{LINE}\n" * 3),
    (10, "e" * 1_500 + "\n" + "e" * 1_499), (11, LINE.replace("long", "LO")),
]


def test_line_removal_in_hard_cases(spark):
    df = documents(spark, [(i, t, "en", "s", 1) for i, t in CASES]).withColumn("TEXT2", F.lit("x")).withColumnRenamed("TEXT2", "Text")
    expected = plain_whole_report(CASES)
    found = lines.line_report(df).select("doc_id", "n_lines", "n_dropped", "n_links", F.concat_ws(",", F.transform("dropped", lambda i: i.cast("string")))).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    kept = lines.drop_duplicate_lines(df)
    assert kept.columns == df.columns
    texts = []
    for (i, t), (_, _, _, _, drop) in zip(CASES, expected):
        gone = set(drop.split(",")) if drop else set()
        texts.append((i, t if not gone else "\n".join(x for no, x in enumerate(t.split("\n")) if str(no) not in gone)))
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=repr) == sorted(texts, key=repr)


def test_lines_of_an_empty_table(spark):
    assert lines.line_report(documents(spark, [])).collect() == []
    assert lines.drop_duplicate_lines(documents(spark, [])).collect() == []


def test_short_lines(spark):
    rng = random.Random(5)
    docs = [
        (1, "All rights reserved.\n\n}\nab\nLicensed under CC BY-NC 4.0."),
        (2, "All rights reserved.\n\n{\nac\nLicensed under CC BY-NC 4.0."),
        (3, "All rights reserved!\n}\nLicensed under CC BY-SA 4.0.\nAll right reserved!\nab"),
    ]
    for size in (13, 14, 15, 16, 28, 29, 30, 31):  # around the lengths at which the edits allowed change
        x = "".join(rng.choice("abcdefgh") for _ in range(size))
        docs.append((size, "\n".join([x, *[edited(x, k % 4, rng) for k in range(20)]])))
    found = lines.line_report(documents(spark, [(i, t, "en", "s", 1) for i, t in docs])).collect()
    got = sorted((*r[:4], ",".join(map(str, r["dropped"]))) for r in found)
    assert got == sorted(plain_whole_report(docs))
    assert {r[0]: r[4] for r in got}[2] == "0,4"
