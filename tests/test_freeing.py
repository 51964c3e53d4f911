"""Shuffle files and cached blocks go while a long query runs, not at its end."""

import time

from affinity.operators import als, prep
from affinity.operators.registry import FitRegistry
from affinity.session import free_shuffles, shuffles_freed
from affinity.sources.scratch import Run
from conftest import interactions_df
from test_als import two_tastes


def shuffles(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def cached(spark):
    return {r.name() for r in spark.sparkContext._jsc.getPersistentRDDs().values()}


def until(what, seconds=15):
    end = time.time() + seconds
    while not what() and time.time() < end:
        time.sleep(0.5)
    return what()


def factors_held(spark):
    """Whether factors of a fit are still cached (asking refers to them for a while, so it is asked once)."""
    for _ in range(4):
        free_shuffles(spark)
        time.sleep(0.5)
    return bool({"userFactors", "itemFactors"} & cached(spark))


def test_shuffles_go_while_the_block_runs(spark):
    free_shuffles(spark)
    with shuffles_freed(spark, every=0.3):
        time.sleep(1)
        before = shuffles(spark)
        for i in range(3):
            spark.range(100).repartition(3 + i).collect()
        assert until(lambda: shuffles(spark) <= before, 120)  # collections are as far apart as the session is large
    with shuffles_freed(spark, every=60), shuffles_freed(spark, every=60):
        pass  # one thread for both, ended by the outer one


def test_a_registry_does_not_hold_the_fitted_model(spark, tmp_path):
    train, _ = two_tastes(spark)
    reg = FitRegistry(spark, str(tmp_path / "m"))
    model = reg.model({"a": 1}, train, lambda: als.fit(spark, train, "implicit", 2, 0.1, 2, 42))
    assert not factors_held(spark)
    assert model.rank == 2 and model.userFactors.count() == 60


def test_a_model_is_evaluated_from_its_files(spark, monkeypatch):
    from affinity.config import Config
    rows = [(u, (u * 7 + b) % 90, 1, 1 + b % 5, 0) for u in range(80) for b in range(42)]
    cfg = Config(min_interactions=40, sample_fraction=1.0, als_rank=2, als_iter=2, top_k=5)
    seen = []
    plain = als.evaluate_model

    def look(model, *a):
        seen.append(factors_held(spark))
        return plain(model, *a)

    with Run(spark) as run:
        p = run.keep(prep.prepare(interactions_df(spark, rows), cfg, keep=run.keep), "prepared")
        monkeypatch.setattr(als, "evaluate_model", look)
        table = als.two_model_protocol(spark, p, "implicit", cfg, parallelism=1).collect()
    assert seen == [False, False] and {r.split for r in table} == {"tuning", "test"}
