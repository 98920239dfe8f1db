"""Hard negatives and vector codes against plain Python."""
import math
import random

import numpy as np
import pytest
from navrecon.llm import negatives, vector_codes
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string"


def vectors(n=700, dim=16, seed=5, spread=4):
    """Clustered vectors, with rows that take no part, exact copies, ties and one hot vector and label."""
    rng = random.Random(seed)
    rows, hot = [], [rng.gauss(0, 0.2) for _ in range(dim)]
    centres = [[rng.gauss(0, 0.3) for _ in range(dim)] for _ in range(spread)]
    for i in range(n):
        v = hot if i % 3 == 0 else [c + rng.gauss(0, 0.05) for c in centres[i % spread]]
        rows.append((i, [float(x) for x in v], rng.choice((0, 0, 0, 1, 2)), "x", "y"))
    rows += [(n, None, 1, "x", "y"), (n + 1, [None] * dim, 1, "x", "y"), (n + 2, [math.nan] * dim, 1, "x", "y"),
             (n + 3, [math.inf] + [0.0] * (dim - 1), 1, "x", "y"), (n + 5, [0.0] * dim, None, "x", "y"),
             (n + 6, [0.0] * dim, 2, None, None)]
    return rows


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def whole(v, scale):
    return np.array([math.floor(scale * float(np.float32(x))) for x in v], np.int64)


def mined(rows, step, k=5):
    rows = {r[0]: (r[2], whole(r[1], 256)) for r in usable(rows) if r[2] is not None and r[0] is not None}
    out = []
    for a in (i for i in rows if i % step == 0):
        score = {i: int(rows[a][1] @ rows[i][1]) for i in rows if i != a and len(rows[i][1]) == len(rows[a][1])}
        near = sorted((i for i in score if rows[i][0] == rows[a][0]), key=lambda i: (-score[i], i))[:k]
        for p in near:
            far = sorted((i for i in score if rows[i][0] != rows[a][0] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]),
                         key=lambda i: (-score[i], i))[:k]
            out += [(a, p, n, i, score[p], score[i]) for n, i in enumerate(far, 1)]
    return sorted(out)


def found(df, step=10):
    got = negatives.mine_negatives(df, F.col("vec_id") % step == 0, F.col("label")).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("block,step,anchors", [(4096, 8, 16384), (50, 3, 9)])
def test_negatives(spark, monkeypatch, block, step, anchors):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "STEP", step)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    rows = vectors(400)
    expected = mined(rows, 10)
    assert len(expected) > 50
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == expected


def test_negatives_of_odd_rows(spark):
    rows = vectors(60) + [(None, [1.0] * 16, 1, "x", "y"), (80, [0.5] * 7, 1, "x", "y"), (81, [0.5] * 7, 1, "x", "y"),
                          (82, [0.5] * 7, 2, "x", "y"), (90, [], 1, "x", "y"), (91, [], 1, "x", "y"), (92, [], 3, "x", "y")]
    expected = mined(rows, 10)
    assert {r[0] for r in expected} >= {80, 90}
    assert found(spark.createDataFrame(rows + rows[:9], SCHEMA)) == expected
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame(rows[1:3], SCHEMA)) == []


def test_the_scan_leaves_what_matters():
    rng = np.random.default_rng(1)
    cols, q = rng.integers(-90, 90, (24, 500)), rng.integers(-90, 90, 24)
    exact = q @ cols
    for useful, wanted in ((negatives.among_best(7), np.sort(exact)[-7:]),
                           (negatives.in_windows(np.array([100]), np.array([9000]), 500), exact[(exact >= 100) & (exact <= 9000)])):
        left, score = negatives.vertical(q, cols, cols.min(axis=1), cols.max(axis=1), np.ones(500, bool), useful)
        assert (score == exact[left]).all() and set(wanted.tolist()) <= set(score.tolist()) and len(left) < 500


def lloyd(rows, parts=8, entries=16, rounds=6):
    rows = usable(rows)
    x = np.stack([whole(r[1], 4096) for r in rows])
    w = x.shape[1] // parts
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))[:entries]
    codes, books = [], []
    for k in range(parts):
        p = x[:, k * w:(k + 1) * w]
        book = p[first].copy()
        for turn in range(rounds + 1):
            d = ((p[:, None, :] - book[None]) ** 2).sum(axis=2)
            own = d.argmin(axis=1)
            if turn < rounds:
                for e in range(len(book)):
                    if (own == e).any():
                        book[e] = [int(s) // int((own == e).sum()) for s in p[own == e].sum(axis=0)]
        codes.append((own, d.min(axis=1)))
        books.append(book)
    error = sum(d for _, d in codes)
    by_label = {}
    for r, e in zip(rows, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    return sorted(((r[0], "".join("%02x" % o[i] for o, _ in codes), int(error[i]), by_label[r[2]])
                   for i, r in enumerate(rows)), key=by_id), np.stack(books)


def by_id(row):
    return row[0] is None, row[0] or 0, row[1]


@pytest.mark.parametrize("block,leaf", [(2048, 32), (90, 4)])
def test_codes(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    rows = vectors(500)
    expected, books = lloyd(rows)
    got, made = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert (made == books).all()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()) == expected


def test_trees_give_the_nearest():
    rng = np.random.default_rng(2)
    for n, m, width, spread in ((1, 1, 2, 5), (3, 16, 2, 2), (500, 16, 2, 30), (800, 11, 3, 400), (700, 16, 8, 9)):
        points, entries = rng.integers(-spread, spread, (n, width)), rng.integers(-spread, spread, (m, width))
        tree = vector_codes.Tree(points, 8)
        nodes, owner, single, chosen = vector_codes.nearest(tree, entries)
        got = np.full(n, -1)
        for node, e in zip(nodes, owner, strict=True):
            assert (got[tree.begin[node]:tree.end[node]] == -1).all()
            assert (tree.sums[node] == tree.points[tree.begin[node]:tree.end[node]].sum(axis=0)).all()
            got[tree.begin[node]:tree.end[node]] = e
        assert (got[single] == -1).all()
        got[single] = chosen
        d = ((tree.points.astype(np.int64)[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (got == d.argmin(axis=1)).all()


def test_whole_nodes_are_assigned():
    """Far clusters are settled by their nodes; no point is compared."""
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(-5, 5, (200, 4)) + 1000 * k for k in range(8)])
    nodes, _, single, _ = vector_codes.nearest(vector_codes.Tree(points, 16), np.full((8, 4), 1000) * np.arange(8)[:, None])
    assert len(single) == 0 and len(nodes) < 40


def test_codes_of_odd_rows(spark):
    rows = vectors(40) + [(None, [0.1] * 16, None, "x", "y")]
    rows += rows[:5]
    expected, _ = lloyd(rows)
    got, _ = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
    found_rows = [(r.vec_id, r.code, r.error, r.label_error) for r in got.collect()]
    assert sorted(found_rows, key=by_id) == expected
    for few in ([], rows[:3], [(1, None, 1, "x", "y")], [(1, [], 1, "x", "y")], [(1, [0.5] * 5, 1, "x", "y"), (2, [0.5] * 19, 1, "x", "y")]):
        got, _ = vector_codes.compress(spark.createDataFrame(few, SCHEMA))
        assert got.count() == len(usable(few))
        assert all(r.error == 0 for r in got.collect())
