import random

import pytest

from affinity.operators import als
from affinity.operators.registry import FitRegistry, matrix_digest


@pytest.fixture
def train(spark):
    rnd = random.Random(2)
    rows = [(u, b, float(rnd.randint(1, 5))) for u in range(30) for b in rnd.sample(range(40), 12)]
    return spark.createDataFrame(rows, "user_id int, book_id int, value float")


def factors(model):
    return sorted((r.id, tuple(r.features)) for r in model.itemFactors.collect())


def test_each_configuration_and_matrix_is_fitted_once(spark, train, tmp_path):
    path = str(tmp_path / "models")
    reg = FitRegistry(spark, path)
    ask = lambda r, rank, m: r.model({"rank": rank}, m, lambda: als.fit(spark, m, "explicit", rank, 0.1, 2, 42))
    first = ask(reg, 2, train)
    assert factors(ask(reg, 2, train.repartition(5))) == factors(first) and reg.fits == 1
    ask(reg, 3, train)
    changed = train.selectExpr("user_id", "book_id", "if(user_id = 3 AND value = 1, 2, value) AS value")
    ask(reg, 2, changed)
    ask(reg, 2, train.union(train.limit(1)))
    assert reg.fits == 4
    later = FitRegistry(spark, path)  # another run: reads what the first one saved
    assert factors(ask(later, 2, train)) == factors(first) and later.fits == 0


def test_a_fit_that_fails_is_tried_again(spark, train, tmp_path):
    reg = FitRegistry(spark, str(tmp_path / "m"))
    with pytest.raises(ZeroDivisionError):
        reg.model({"a": 1}, train, lambda: 1 // 0)
    assert reg.model({"a": 1}, train, lambda: als.fit(spark, train, "explicit", 2, 0.1, 1, 42)).rank == 2 and reg.fits == 2


def test_threads_that_ask_for_one_key_share_its_fit(spark, train, tmp_path):
    reg = FitRegistry(spark, str(tmp_path / "m"))
    fit = lambda: als.fit(spark, train, "explicit", 2, 0.1, 1, 42)
    found = als.run_parallel([lambda: reg.model({"a": 1}, train, fit) for _ in range(4)], 4)
    assert reg.fits == 1 and all(m is found[0] for m in found)


def test_second_grid_stage_does_not_refit_a_point_of_the_first(spark, tmp_path):
    from affinity.config import Config
    from affinity.operators import prep, tuning
    from affinity.sources.tables import INTERACTION_SCHEMA

    rnd = random.Random(5)
    rows = [(u, b, 1, rnd.randint(1, 5), 0) for u in range(80) for b in rnd.sample(range(90), 42)]
    cfg = Config(min_interactions=40, sample_fraction=1.0, als_rank=2, als_tune_iter=1, top_k=5,
                 implicit_stage1_grid={"rank": [2], "regParam": [0.1, 1.0]},
                 implicit_stage2_grid={"alpha": [1.0, 10.0], "beta": [40.0]})
    p = prep.prepare(spark.createDataFrame(rows, INTERACTION_SCHEMA), cfg).cache()
    reg = FitRegistry(spark, str(tmp_path / "m"))
    table = tuning.implicit_grid(spark, p, cfg, registry=reg).collect()
    assert len(table) == 4 and reg.fits == 3
    same = [r for r in table if (r.alpha, r.beta) == (10.0, 40.0)]
    assert len({(r.reg, r.map) for r in same}) == len({r.reg for r in same})
    p.unpersist()


def test_digest_does_not_see_the_order(spark, train):
    assert matrix_digest(train) == matrix_digest(train.orderBy("value").repartition(3))
    assert matrix_digest(train.where("false"))[0] == 0
