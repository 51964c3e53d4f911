import hashlib
import math

import duckdb
import numpy as np
import pytest

from affinity.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string, salt int, v int"


def frame(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], c, "c", "e", 1, 2)
                                  for k, v, c in rows], SCHEMA)


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, sha) of each row, by the definition."""
    kept = [(k, [math.floor(256 * float(np.float32(x))) for x in v], c) for k, v, c in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts)) * parts
    kept = [(k, v + [0] * (width - len(v)), c) for k, v, c in kept]
    step = width // parts
    first = {}
    for k, v, _ in kept:
        first[k] = min(first.get(k, v), v)
    start = sorted(first, key=lambda k: (k is None, k))[:entries]
    books = [[first[k][p * step:(p + 1) * step] for k in start] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            got = {}
            for _, v, _ in kept:
                x = v[p * step:(p + 1) * step]
                got.setdefault(nearest(x, book)[1], []).append(x)
            books[p] = [[sum(c) // len(c) for c in zip(*got[i])] if i in got else e for i, e in enumerate(book)]
    out = []
    for k, v, c in kept:
        at = [nearest(v[p * step:(p + 1) * step], books[p]) for p in range(parts)]
        out.append((k, "".join(f"{i:02x}" for _, i in at), sum(d for d, _ in at), c))
    total = {}
    for _, _, e, c in out:
        total[c] = total.get(c, 0) + e
    flat = [x for b in books for e in b for x in e]
    sha = hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()
    return sorted(((k, code, e, total[c], sha) for k, code, e, c in out), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def random_rows(n, dim, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    return [(int(k), (rng.integers(0, 3) + rng.normal(0, spread, dim)).astype(np.float32).tolist(), int(rng.integers(0, 5)))
            for k in rng.permutation(n * 3)[:n]]


@pytest.mark.parametrize("dim, chunk", [(64, 4096), (32, 37), (16, 100)])
def test_codes_match_brute_force(spark, dim, chunk):
    rows = random_rows(300, dim, dim)
    assert result(V.vector_codes(frame(spark, rows), chunk=chunk)) == plain(rows)


def test_awkward_rows(spark):
    rows = random_rows(120, 32, 1)
    rows += rows[:5] + [(None, rows[7][1], None), (None, rows[8][1], None), (rows[9][0], rows[10][1], None)]
    rows += [(5000, None, 1), (5001, [None] * 32, 1), (5002, [math.nan] * 32, 1), (5003, [math.inf] * 32, 1),
             (5004, [0.5] * 20, 2), (5005, [], None)] + [(6000 + k, rows[0][1], 3) for k in range(50)]
    assert result(V.vector_codes(frame(spark, rows), chunk=50)) == plain(rows)
    few = [(None, [0.1, 0.2], None), (4, [0.3], 1), (4, [-0.3], 1)]
    assert result(V.vector_codes(frame(spark, few))) == plain(few)
    empty = V.vector_codes(frame(spark, rows).where("false"))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.isEmpty()
    with pytest.raises(Exception, match="not taken"):
        V.vector_codes(frame(spark, [(1, [1e9] * 16, 1)])).collect()


def test_trees_cover_their_points_and_add_up():
    rng = np.random.default_rng(0)
    points, part = rng.integers(-150, 150, (2000, 4)), rng.integers(0, 3, 2000)
    f = V.cover_forest(points, part, 4)
    assert sorted(f.order) == list(range(2000)) and (f.points == points[f.order]).all()
    for k in range(len(f.start)):
        own = f.points[f.start[k]:f.stop[k]]
        assert not len(own) or V.squared(own, f.points[f.centre[k]]).max() == f.radius[k]
        kids = range(f.child[k], f.child[k] + f.children[k])
        if f.children[k]:
            assert [f.start[c] for c in kids] + [f.stop[k]] == [f.start[k]] + [f.stop[c] for c in kids]
            centres = f.points[f.centre[list(kids)]]
            gap = V.squared(centres[:, None], centres[None])[np.triu_indices(len(centres), 1)]
            assert (4 * f.radius[list(kids)] <= f.radius[k]).all() and (4 * gap > f.radius[k]).all()
        else:
            assert len(own) <= V.LEAF or f.radius[k] == 0


def test_whole_subtrees_are_assigned_without_comparing_points():
    rng = np.random.default_rng(1)
    centres = rng.integers(-1000, 1000, (40, 4))
    points = centres[rng.integers(0, 40, 8000)] + rng.integers(-3, 4, (8000, 4))
    f = V.cover_forest(points, np.zeros(8000, np.int64), 1)
    books = centres[None]
    start, stop, entry, taken = V.assign(f, books)
    got = np.full(8000, -1)
    for s, e, k in zip(start, stop, entry):
        got[f.order[s:e]] = k
    gap = V.squared(points[:, None], centres[None])
    assert (got == gap.argmin(1)).all() and taken < 8000 * 40 / 20


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    rows = con.sql(V.ORACLE_SQL).fetchall()
    assert len(rows) and result(V.query(spark, d)) == sorted(rows, key=str)
