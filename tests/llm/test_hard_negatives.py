import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import hard_negatives as H
from affinity.llm.store import Store

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, tile int, anchor string, v int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], c, "k", 1, "a", 2)
                                  for k, v, c in rows], SCHEMA)


def plain(rows, every=10, k=5):
    kept = {}
    for i, v, c in rows:
        if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own = (c, [math.floor(256 * float(np.float32(x))) for x in v])
            kept[i] = min(kept.get(i, own), own)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (c, v) in kept.items():
        if a % every:
            continue
        scored = sorted((-dot(v, w), b, d == c) for b, (d, w) in kept.items() if b != a)
        for p, b, _ in [s for s in scored if s[2]][:k]:
            fit = [s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p]
            out += [(a, b, r, i, -p, -s) for r, (s, i, _) in enumerate(fit[:k], 1)]
    return sorted(out)


def mine(df, every=10, **kw):
    return H.hard_negatives(df, F.col("vec_id") % every == 0, **kw)


def result(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def random_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 0.3, (4, dim))
    return [(int(k), (base[rng.integers(4)] + rng.normal(0, 0.1, dim)).astype(np.float32).tolist(), int(rng.integers(0, 4)))
            for k in rng.permutation(n)]


@pytest.mark.parametrize("n, dim, size", [(400, 8, None), (300, 64, 20), (250, 1, 30)])
def test_equals_brute_force(spark, n, dim, size):
    rows = random_rows(n, dim, dim)
    assert result(mine(frame(spark, rows), size=size)) == plain(rows)


def test_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 7)
    rows = random_rows(200, 6, 3)
    assert result(mine(frame(spark, rows), size=50)) == plain(rows)


def test_awkward_rows(spark):
    rows = random_rows(150, 16, 1)
    same = rows[0][1]
    rows += [(1000 + k, same, k % 3) for k in range(120)]  # a common vector: ties everywhere
    rows += rows[:9] + [(rows[3][0], rows[4][1], 0)]
    rows += [(None, same, 1), (2000, None, 1), (2010, [None] * 16, 1), (2020, [math.nan] * 16, 1), (2030, [-math.inf] * 16, 1),
             (2040, same, None), (2050, same[:5], 1), (2060, [], 2), (2070, [-x for x in same], 3)]
    assert result(mine(frame(spark, rows), size=40)) == plain(rows)
    assert mine(frame(spark, rows).where("false")).isEmpty()
    lone = [(10, [0.5, 0.5], 1), (20, [0.5, 0.5], 2), (30, [-0.5, -0.5], 2), (31, [-0.5, -0.4], 1), (40, [0.0, 0.0], 3), (41, [0.0, 0.0], 3)]
    assert result(mine(frame(spark, lone))) == plain(lone)
    with pytest.raises(Exception, match="not taken"):
        mine(frame(spark, [(1, [1e9], 1), (10, [1.0], 1)])).collect()


def test_common_vector_fills_many_tiles(spark):
    rows = frame(spark, [(k, [0.25, 0.5, 0.125], 1) for k in range(600)])
    own = rows.selectExpr("vec_id AS key", "cast(label AS bigint) AS label", "transform(embedding, x -> cast(256 * x AS bigint)) AS v", "false AS anchor")
    sizes = [r["count"] for r in H.tiles(own, 600, Store(spark, "t"), 40).groupBy("tile").count().collect()]
    assert sum(sizes) == 600 and len(sizes) >= 12 and max(sizes) <= 120


def test_tree_prunes_boxes_that_cannot_hold_a_result(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (60, 16))
    v = centres[rng.integers(0, 60, 6000)] + rng.integers(-4, 5, (6000, 16))
    keys, labels = np.arange(6000), rng.integers(0, 3, 6000)
    tree = H.Tree(keys, labels, v)
    for low, high in tree.levels:
        assert (low <= high).all()
    assert len(tree.levels[-1][0]) == 1 and (tree.levels[-1][0][0] == v.min(0)).all() and np.diff(tree.edges).max() <= H.LEAF
    seen = []
    rows = H.Tree.rows
    monkeypatch.setattr(H.Tree, "rows", lambda self, leaves: seen.append(len(leaves)) or rows(self, leaves))
    got = tree.search(7, int(labels[7]), v[7], [(-np.inf, np.inf)], 5, True)[0]
    score = v @ v[7]
    want = sorted((-score[i], i) for i in keys if i != 7 and labels[i] == labels[7])[:5]
    assert [(-s, i) for s, i in zip(*got)] == want and sum(seen) * H.LEAF < 2000


@pytest.mark.parametrize("scale", [100, 40_000, 60_000_000])  # floats, doubles, integers
def test_anchors_side_by_side(monkeypatch, scale):
    monkeypatch.setattr(H, "AT_ONCE", 7)
    rng = np.random.default_rng(4)
    centres = rng.integers(-scale, scale, (20, 9))
    v = centres[rng.integers(0, 20, 1500)] + rng.integers(-4, 5, (1500, 9))
    v[::3] = v[0]  # ties everywhere
    keys, labels = rng.permutation(1500), rng.integers(0, 3, 1500)
    tree = H.Tree(keys, labels, v)
    own = np.arange(0, 60, 3)
    every = [sorted((int(-(v[j] @ v[a])), int(keys[j]), int(labels[j])) for j in range(1500)) for a in own]
    for same in (True, False):
        lows, tops = np.full((len(own), 3), H.MOST), np.full((len(own), 3), H.LEAST)  # the last window is none
        lows[:, 0], tops[:, 0] = H.LEAST, H.MOST
        for r, s in enumerate(every):
            lows[r, 1], tops[r, 1] = -s[900][0], -s[5][0]
        got = tree.search_all(keys[own], labels[own], v[own], lows, tops, 5, same)
        want = []
        for w in range(2):
            for r, (a, scored) in enumerate(zip(own, every)):
                fit = [s for s in scored if (s[2] == labels[a] and s[1] != keys[a] if same else s[2] != labels[a]) and lows[r, w] <= -s[0] <= tops[r, w]]
                want += [(r, w, -s, i) for s, i, _ in fit[:5]]
        assert sorted(zip(*(c.tolist() for c in got))) == sorted(want)


def test_side_by_side_leaves_out_boxes_that_cannot_serve(monkeypatch):
    rng = np.random.default_rng(5)
    v = np.repeat(rng.integers(-200, 200, (30, 16)), 400, axis=0) + rng.integers(-2, 3, (12000, 16))
    tree = H.Tree(np.arange(12000), np.zeros(12000, int), v)
    taken = []
    monkeypatch.setattr(H.np, "nonzero", lambda x, f=np.nonzero: taken.append(x.size) or f(x))
    at, _, _, key = tree.search_all(np.array([7, 9000]), np.zeros(2, int), v[[7, 9000]], np.full((2, 1), H.LEAST), np.full((2, 1), H.MOST), 5, True)
    monkeypatch.undo()
    for r, a in enumerate((7, 9000)):
        score = v @ v[a]
        assert key[at == r].tolist() == sorted((i for i in range(12000) if i != a), key=lambda i: (-score[i], i))[:5]
    assert sum(taken) < 12000  # of 24000 pairs


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    rows = con.sql(H.ORACLE_SQL).fetchall()
    assert len(rows) and result(H.query(spark, d)) == sorted(rows)
