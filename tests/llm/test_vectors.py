"""Whitening and vector codes against numpy and plain Python."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from lethe.llm import codes, queries, whitening
from lethe.llm.frames import table
from tests.conftest import MEDIUM, SMALL

VECTORS = "vec_id long, embedding array<float>, label int"


def usable(rows):
    good = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    sizes = Counter(len(r[1]) for r in good)
    most = max(sizes, key=lambda s: (sizes[s], s), default=0)
    good = [r for r in good if len(r[1]) == most]
    return good, np.array([[math.floor(256 * c) for c in r[1]] for r in good], dtype=np.int64).reshape(len(good), most)


def odd_rows(dim=8):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in v], int(i % 3)) for i, v in enumerate(rng.normal(size=(90, dim)))]
    rows += [(None, rows[4][1], None), (7, rows[7][1], 1), (8, rows[9][1], None), (-5, [-0.0] * dim, 2)]
    rows += [(200, None, 1), (201, [None] + [0.5] * (dim - 1), 1), (202, [math.nan] + [0.5] * (dim - 1), 1)]
    rows += [(203, [math.inf] + [0.5] * (dim - 1), 1), (204, [], 1), (205, [0.5] * (dim - 1), 1)]
    return rows


def read(spark, source):
    if source == "medium":
        df = table(spark, MEDIUM, "embeddings")
        return df, [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    rows = odd_rows(int(source))
    return spark.createDataFrame(rows, VECTORS), rows


# --- whitening -------------------------------------------------------------------------------


def plain_whitening(rows):
    good, x = usable(rows)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for (i, _, _), row in zip(good, x):
        away = sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums))
        for k in range(4):
            out.append((i, k + 1, n, away, (row - sums / n) @ axes[:, k] / math.sqrt(values[k]), values[k] / values.sum()))
    return out


@pytest.mark.parametrize("source", ["medium", "8", "4"])
def test_whitening_equals_plain(spark, source):
    df, rows = read(spark, source)
    found = whitening.whiten(df).collect()
    expected = sorted(plain_whitening(rows), key=repr)
    got = sorted(map(tuple, found), key=repr)
    assert Counter(g[:4] for g in got) == Counter(e[:4] for e in expected)
    assert all(g[6] == got[0][6] and 0 <= g[6] < 1e-9 for g in got)
    for k in range(1, 5):
        mine = sorted((g for g in got if g[1] == k), key=lambda r: (repr(r[0]), r[3]))
        plain = sorted((e for e in expected if e[1] == k), key=lambda r: (repr(r[0]), r[3]))
        sign = np.sign(sum(g[4] * e[4] for g, e in zip(mine, plain)))
        assert all(g[4] == pytest.approx(sign * e[4], abs=1e-8) for g, e in zip(mine, plain))
        assert all(g[5] == pytest.approx(e[5], rel=1e-9) for g, e in zip(mine, plain))


def test_principal_components_of_hard_matrices():
    rng = np.random.default_rng(5)
    turned, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    for values in ([1e6, 1e3, 1, 1e-2] + [0] * 8, [3.0] * 12, [0] * 12, list(range(12, 0, -1))):
        scatter = turned @ np.diag(values) @ turned.T
        got, axes = whitening.principal((scatter + scatter.T) / 2)
        some = sorted((v for v in values if v > 1e-3), reverse=True)
        assert len(got) <= 12 and np.allclose(got[: len(some)], some, rtol=1e-6)
        assert np.allclose(axes.T @ axes, np.eye(len(got)), atol=1e-9)
    factor, order = whitening.pivoted_cholesky(np.diag([1.0, 9.0, 4.0]))
    assert order.tolist() == [1, 2, 0] and np.allclose(factor, np.diag([3, 2, 1]))
    assert whitening.principal(np.array([[4.0]]))[0].tolist() == [4.0]


def test_whitening_without_spread(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    same = [(i, [0.5, 0.25], 1) for i in range(5)] + [(9, None, 1)]
    assert whitening.whiten(spark.createDataFrame(same, VECTORS)).collect() == []
    line = [(i, [float(i), 2.0 * i], 1) for i in range(6)]  # one component only
    found = whitening.whiten(spark.createDataFrame(line, VECTORS)).collect()
    assert [r["component"] for r in found] == [1] * 6 and found[0]["explained"] == pytest.approx(1)


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 29, 5], [0, 0]])
    assert whitening.deviations(x, 1 << 10, np.array([0, 0])).to_pylist() == [None, 0]
    assert whitening.deviations(x, 3, np.array([1, 2])).to_pylist() == [(3 * (1 << 29) - 1) ** 2 + 169, 5]


def test_whitening_with_clashing_names(spark):
    df = table(spark, SMALL, "embeddings")
    clash = df.selectExpr("vec_id", "embedding", "label", "label as component", "1 as x", "2 as X", "3 as Embedding")
    assert sorted(whitening.whiten(clash).collect()) == sorted(whitening.whiten(df).collect())


# --- codes -----------------------------------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2):
    good, x = usable(rows)
    d = x.shape[1]
    at = [(d * p // parts, d * (p + 1) // parts) for p in range(parts)]
    first = sorted(range(len(good)), key=lambda r: (good[r][0] is None, good[r][0] or 0, x[r].tolist()))[:entries]
    book = [[x[r, a:b].tolist() for r in first] for a, b in at]

    def assigned(p, a, b):
        out = []
        for row in x[:, a:b].tolist():
            away = [sum((u - v) ** 2 for u, v in zip(row, e)) for e in book[p]]
            out.append((away.index(min(away)), min(away)))
        return out

    for _ in range(rounds):
        for p, (a, b) in enumerate(at):
            to = assigned(p, a, b)
            for e in range(len(book[p])):
                mine = [x[r, a:b].tolist() for r in range(len(x)) if to[r][0] == e]
                if mine:
                    book[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [assigned(p, a, b) for p, (a, b) in enumerate(at)]
    errors = [sum(f[r][1] for f in final) for r in range(len(x))]
    by_label = Counter()
    for (_, _, label), e in zip(good, errors):
        by_label[label] += e
    text = ",".join(str(c) for p in book for e in p for c in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [
        (good[r][0], "".join(f"{f[r][0]:02x}" for f in final), errors[r], by_label[good[r][2]], digest) for r in range(len(x))
    ]


@pytest.mark.parametrize("source", ["medium", "16", "20", "7"])
def test_codes_equal_plain(spark, source):
    df, rows = read(spark, source)
    found = codes.compress(df).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain_codes(rows), key=repr)


def test_query_of_codes(spark):
    _, rows = read(spark, "medium")
    assert sorted(map(tuple, queries.op12_vector_codes(spark, MEDIUM).collect())) == sorted(plain_codes(rows))


@pytest.mark.parametrize("entries", [1, 2, 63, 64])
def test_box_search_is_exact(entries):
    rng = np.random.default_rng(entries)
    for spread in (3, 40, 100_000):
        book = rng.integers(-spread, spread, (entries, 4))
        x = np.vstack([rng.integers(-2 * spread, 2 * spread, (400, 4)), book, [[1 << 27] * 4, [-(1 << 27)] * 4]])
        which, away = codes.SlicedBook(book).nearest(x)
        plain = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (which == plain.argmin(1)).all() and (away == plain.min(1)).all()


def test_masks_are_the_boxes():
    rng = np.random.default_rng(1)
    book, x = rng.integers(-20, 20, (64, 3)), rng.integers(-25, 25, (300, 3))
    radius = rng.integers(0, 30, 300)
    masks = codes.SlicedBook(book).in_box(x, radius)
    inside = (np.abs(x[:, None] - book[None]) <= radius[:, None, None]).all(2)
    assert all(int(m) == sum(1 << int(e) for e in np.flatnonzero(row)) for m, row in zip(masks, inside))


def test_codes_of_few_rows(spark):
    assert codes.compress(spark.createDataFrame([], VECTORS)).collect() == []
    rows = [(1, [0.5] * 16, None), (1, [0.5] * 16, None), (2, None, 3)]
    found = codes.compress(spark.createDataFrame(rows, VECTORS)).collect()
    assert [tuple(r)[:4] for r in found] == [(1, "00" * 16, 0, 0)] * 2
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame(rows, VECTORS), entries=65)


def test_huge_coordinates(spark):
    rows = [(i, [3e38 * (-1) ** i, 1.0, 2.0, float(i)], i) for i in range(5)]
    df = spark.createDataFrame(rows, VECTORS)
    assert codes.compress(df).count() == 5 and whitening.whiten(df).count() == 10
