import math

import numpy as np
import pytest

from checks.compare import connect
from smelter.llm.cover_tree import NO_ID, NONE, build, descend, from_bytes, take_best, to_bytes
from smelter.llm.hard_negatives import Queries, hard_negatives
from smelter.llm.queries import op13_cover_tree_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, mark long, x int, block int, data string, score int, window int, rank int, id int, scores int"


def table(spark, data):
    return spark.createDataFrame([(i, v, label, *[7] * 3, "d", *[7] * 5) for i, v, label in data], SCHEMA)


def brute(data):
    usable = [
        (i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v, label in data
        if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for at, (anchor, label, vector) in enumerate(usable):
        if anchor % 50:
            continue
        met = [(-sum(a * b for a, b in zip(vector, v)), i, other) for k, (i, other, v) in enumerate(usable) if k != at]
        for score, positive, _ in sorted(m for m in met if m[2] == label)[:5]:
            fits = sorted(m for m in met if m[2] != label and 50 * -score <= 100 * -m[0] <= 95 * -score)[:3]
            out += [(anchor, positive, k + 1, m[1], -score, -m[0]) for k, m in enumerate(fits)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(n, dims, seed, clusters=8):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dims)) * 3
    points = centres[rng.integers(0, clusters, n)] + rng.standard_normal((n, dims)) * 0.2
    return [(i, [float(c) for c in p], int(rng.integers(0, 4))) for i, p in enumerate(points)]


@pytest.mark.parametrize("blocks", [(2048, 512), (40, 3)])
def test_equals_brute_force_on_clusters(spark, blocks):
    data = clustered(400, 5, 1)
    assert got(hard_negatives(table(spark, data).repartition(3), *blocks)) == brute(data) != []


def test_ties_copies_and_unusable_rows(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(c) for c in rng.integers(-2, 3, 3)], int(rng.integers(0, 3))) for i in range(300)]
    data += data[50:60] + [(50, [1.0, 1.0, 1.0], 1)] + [(100 + k % 2, [2.0, 0.0, 1.0], 2) for k in range(40)]
    odd = [(400, None, 1), (450, [], 1), (500, [1.0, None, 1.0], 1), (550, [1.0, math.nan, 1.0], 1), (600, [1.0, 1.0], 1), (650, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (700, [-math.inf, 0.0, 0.0], 1)]
    usable = [r for r in odd if r[0] != 600]
    assert got(hard_negatives(table(spark, data + odd), 30, 4)) == brute(data + usable) != []


def test_small_and_empty_tables(spark):
    assert got(hard_negatives(table(spark, []))) == []
    assert got(hard_negatives(table(spark, [(0, [1.0], 1)]))) == []
    assert got(hard_negatives(table(spark, [(1, [1.0], 1), (2, [1.0], 1)]))) == []  # no anchor
    assert got(hard_negatives(table(spark, [(50, [1.0], 1), (2, [1.0], 1), (3, [0.9], 2)]))) == [(50, 2, 1, 3, 65536, 230 * 256)]


def test_large_whole_numbers_are_exact(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(np.float32(c)) for c in rng.uniform(2e5, 2.5e5, 4)], i % 3) for i in range(120)]
    assert got(hard_negatives(table(spark, data), 16, 2)) == brute(data) != []


def some_tree(seed, n=500, dims=6):
    rng = np.random.default_rng(seed)
    rows = (rng.standard_normal((10, dims)) * 800)[rng.integers(0, 10, n)] + rng.standard_normal((n, dims)) * 20
    return build(np.floor(rows).astype(np.int64), np.arange(n), np.arange(n), rng.integers(0, 3, n))


def test_nodes_cover_their_rows():
    tree = some_tree(4)
    lengths = (tree.rows.astype(float) ** 2).sum(axis=1)
    whole = np.column_stack([tree.rows, np.sqrt(tree.square[0] - lengths)])
    assert np.allclose((whole**2).sum(axis=1), tree.square[0])

    def below(node):
        parts = [np.arange(tree.own[node], tree.own[node + 1])]
        parts += [below(c) for c in range(tree.child[node], tree.child[node] + tree.children[node])]
        return np.concatenate(parts)

    for node in range(len(tree.centre)):
        inside = below(node)
        away = np.sqrt(((whole[inside] - whole[tree.centre[node]]) ** 2).sum(axis=1))
        assert tree.centre[node] in inside and away.max() <= tree.radius[node]
        assert bool(tree.pure[node]) == (len(set(tree.labels[inside])) == 1)
    assert sorted(below(0)) == list(range(500)) and len(tree.centre) > 10


def test_descent_bounds_hold_and_skip_nodes():
    tree = some_tree(5)
    vectors = tree.rows[:20]
    exact = vectors @ tree.rows.T
    seen = np.zeros(exact.shape, bool)
    best = np.full(20, -(1 << 60))

    def wanted(who, node, low, high):
        start, stop = tree.own[node], tree.own[node + 1]
        inside = exact[who, start:stop]
        assert (inside >= low[:, None]).all() and (inside <= high[:, None]).all()
        return high >= best[who]

    def verify(who, start, stop, scores):
        assert (scores == exact[who, start:stop]).all()
        seen[who, start:stop] = True
        best[who] = np.maximum(best[who], scores.max(axis=1))

    descend(tree, vectors, wanted, verify)
    assert (best == exact.max(axis=1)).all()
    assert seen.mean() < 0.6  # rows of other clusters were not looked at


def test_best_rows_with_ties():
    scores = np.array([[5, 9, 9, NONE, 1], [NONE] * 5])
    ids = np.array([3, 8, 2, 1, 4])
    best, names = take_best(scores, ids, np.array([[9, NONE, NONE], [4, 3, NONE]]), np.array([[5, NO_ID, NO_ID], [1, 2, NO_ID]]))
    assert best.tolist() == [[9, 9, 9], [4, 3, NONE]]
    assert names.tolist() == [[2, 5, 8], [1, 2, NO_ID]]


def test_bytes_round_trip():
    wide = Queries(np.array([[1 << 40, -5]]), np.array([1]), np.array([2]), np.array([[3]]), np.array([[4]]))
    again = from_bytes(Queries, to_bytes(wide))
    assert again.vectors.tolist() == [[1 << 40, -5]] and again.below.tolist() == [[4]]


def test_query_equals_sql(spark):
    path = "/root/testdata/sf0.01"
    from smelter.llm.queries import ORACLE

    con = connect(path)
    want = sorted(con.sql(f"SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ({ORACLE['op13_cover_tree_negatives']})").fetchall())
    assert got(op13_cover_tree_negatives(spark, path)) == want != []
