import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import als, evaluation as E
from affinity.operators.topk_product import top_products
from affinity.sources.scratch import Run

FACTORS = "features array<float>"


@pytest.fixture
def run(spark):
    with Run(spark) as r:
        yield r


def frames(spark, u, v):
    users = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(u)], f"user_id int, {FACTORS}")
    items = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], f"book_id int, {FACTORS}")
    return users, items


def plain(u, v, k, seen=()):
    out = {}
    score = (u.astype(np.float32).astype(np.float64) @ v.astype(np.float32).astype(np.float64).T).astype(np.float32)
    for i in range(len(u)):
        order = [j for j in np.lexsort((np.arange(len(v)), -score[i])) if (i, j) not in seen][:k]
        out.update({(i, r): (int(j), float(score[i, j])) for r, j in enumerate(order, 1)})
    return out


def lists(df):
    return {(r.user_id, r["rank"]): (r.book_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("k, block, chunk", [(5, 16, 7), (40, 64, 1000), (500, 4096, 16384)])
def test_equals_brute_force(spark, run, k, block, chunk):
    rng = np.random.default_rng(k)
    u, v = rng.normal(size=(30, 6)), rng.normal(size=(300, 6)) * rng.exponential(size=(300, 1))
    got, _ = top_products(*frames(spark, u, v), k, run, block=block, chunk=chunk)
    assert lists(got) == plain(u, v, k)


def test_ties_go_to_the_smaller_item_and_zero_factors_are_scored(spark, run):
    u = np.array([[1.0, 0.0], [0.0, 0.0], [-1.0, 0.0]])
    v = np.array([[2.0, 0.0]] * 9 + [[0.0, 1.0]] * 9)
    got, _ = top_products(*frames(spark, u, v), 4, run, block=2)
    assert lists(got) == plain(u, v, 4)


def test_seen_items_are_left_out_while_scoring(spark, run):
    rng = np.random.default_rng(8)
    u, v = rng.normal(size=(12, 4)), rng.normal(size=(200, 4))
    seen = {(i, j) for i in range(12) for j in rng.choice(200, 20 * i if i < 10 else 200 - (i == 10), replace=False)}
    frame = spark.createDataFrame([(int(i), int(j)) for i, j in seen] + [(99, 1), (3, 999)], "user_id int, book_id int")
    got, _ = top_products(*frames(spark, u, v), 6, run, frame.union(frame), block=16, chunk=5)
    got = lists(got)
    assert got == plain(u, v, 6, seen)
    assert sum(i == 10 for i, _ in got) == 1 and not any(i == 11 for i, _ in got)  # one unseen item left, none


def test_blocks_below_the_bound_are_not_scored(spark, run):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(2000, 8))
    v *= (1 / (1 + np.arange(2000)) / np.linalg.norm(v, axis=1))[:, None]
    u = rng.normal(size=(50, 8))
    got, scored = top_products(*frames(spark, u, v), 5, run, block=32)
    assert lists(got) == plain(u, v, 5)
    assert scored.agg(F.sum("n_scored")).first()[0] < 50 * 2000 / 5 and scored.agg(F.min("n_scored")).first()[0] >= 32


def test_what_is_written_does_not_grow_with_users_times_blocks(spark):
    rng = np.random.default_rng(6)
    u, v = rng.normal(size=(40, 5)), rng.normal(size=(320, 5))
    with Run(spark) as run:
        got, _ = top_products(*frames(spark, u, v), 3, run, block=4, chunk=25)
        assert lists(got) == plain(u, v, 3)
        kept = [p for p in os.listdir(run.path.removeprefix("file:")) if not p.startswith(("_", "."))]
        assert sum(spark.read.parquet(f"{run.path}/{p}").count() for p in kept) <= 2 * 40 + 320  # not 40 users x 80 blocks


def test_equal_scores_and_signed_zeros_over_several_blocks(spark, run):
    u = np.array([[1.0, -1.0], [0.0, -0.0], [1e-30, 1e-30], [-3.0, 0.5]])
    v = np.array([[1.0, 1.0], [-0.0, 0.0], [2.0, 2.0], [1e-30, 0.0]] * 5)
    got, _ = top_products(*frames(spark, u, v), 7, run, block=3, chunk=2)
    assert lists(got) == plain(u, v, 7)


def test_few_flags_of_many_are_found():
    from affinity.operators.topk_product import _true
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 9, 64, 1000, 4099):
        for share in (0, 0.01, 0.5, 1):
            flags = rng.random(n) < share
            assert np.array_equal(_true(flags), np.flatnonzero(flags))


def test_nobody_and_nothing(spark, run):
    users, items = frames(spark, np.ones((2, 2)), np.ones((3, 2)))
    assert top_products(users.where("false"), items, 3, run)[0].isEmpty()
    got, scored = top_products(users, items.where("false"), 3, run)
    assert got.isEmpty() and {r.n_scored for r in scored.collect()} == {0}


def test_lists_equal_those_of_mllib_and_no_product_is_planned(spark, run):
    rnd = random.Random(1)
    rows = [(u, b, float(rnd.randint(1, 5))) for u in range(80) for b in rnd.sample(range(400), 30)]
    train = spark.createDataFrame(rows, "user_id int, book_id int, value float")
    users = spark.createDataFrame([(u,) for u in range(0, 90, 2)], "user_id int")  # some unknown
    for kind in ("explicit", "implicit"):
        model = als.fit(spark, train, kind, rank=6, reg=0.1, max_iter=4, seed=42)
        mine = als.recommend(model, users, 20, run)
        want = lists(E.ranked_from_arrays(model.recommendForUserSubset(users, 20)))
        got = lists(mine)
        assert set(got) == set(want)
        for key, (item, score) in got.items():
            assert score == pytest.approx(want[key][1], rel=1e-4, abs=1e-6)
            near = [want.get((key[0], key[1] + d), (None, score + 1))[1] for d in (-1, 1)]
            if all(abs(score - s) > 1e-5 * max(1, abs(score)) for s in near):  # no tie beside it
                assert item == want[key][0]
        assert "CartesianProduct" not in mine._jdf.queryExecution().toString()
    seen = train.select("user_id", "book_id")
    unseen = als.recommend_unseen(model, users, seen, 20, run)
    assert unseen.join(seen, ["user_id", "book_id"]).isEmpty() and unseen.agg(F.max("rank")).first()[0] == 20
