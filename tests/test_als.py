import random

from pyspark.sql import functions as F

from affinity.operators import als


def two_tastes(spark, seed=3):
    """Users 0-29 like items 0-19 and dislike 20-39; users 30-59 the opposite."""
    rnd = random.Random(seed)
    rows, held = [], []
    for u in range(60):
        mine = range(0, 20) if u < 30 else range(20, 40)
        other = range(20, 40) if u < 30 else range(0, 20)
        liked = rnd.sample(list(mine), 12)
        disliked = rnd.sample(list(other), 6)
        for i in liked[:10]:
            rows.append((u, i, 5.0))
        for i in disliked[:4]:
            rows.append((u, i, 1.0))
        held += [(u, i, 5.0) for i in liked[10:]] + [(u, i, 1.0) for i in disliked[4:]]
    schema = "user_id int, book_id int, value float"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(held, schema)


def test_implicit_recommendations_stay_in_group(spark):
    train, _ = two_tastes(spark)
    liked = train.where("value > 3")
    model = als.fit(spark, liked, "implicit", rank=4, reg=0.1, max_iter=10, seed=42)
    recs = als.recommend(model, liked.select("user_id").distinct(), 5)
    rows = recs.collect()
    assert len(rows) == 60 * 5
    assert sorted({r.rank for r in rows}) == [1, 2, 3, 4, 5]
    inside = sum(1 for r in rows if (r.user_id < 30) == (r.book_id < 20))
    assert inside / len(rows) > 0.9


def test_explicit_rmse_beats_constant(spark):
    train, held = two_tastes(spark)
    model = als.fit(spark, train, "explicit", rank=4, reg=0.1, max_iter=10, seed=42)
    r = als.rmse(model, held.withColumnRenamed("value", "rating")).collect()[0]
    mean = train.agg(F.avg("value")).collect()[0][0]
    const = held.agg(F.sqrt(F.avg(F.pow(F.col("value") - F.lit(mean), 2)))).collect()[0][0]
    assert r.rmse < const


def test_model_roundtrip(spark, tmp_path):
    train, _ = two_tastes(spark)
    model = als.fit(spark, train.where("value > 3"), "implicit", rank=4, reg=0.1, max_iter=5, seed=42)
    path = str(tmp_path / "m")
    als.save_model(model, path)
    loaded = als.load_model(path)
    users = train.select("user_id").distinct()
    a = {(r.user_id, r.rank): r.book_id for r in als.recommend(model, users, 3).collect()}
    b = {(r.user_id, r.rank): r.book_id for r in als.recommend(loaded, users, 3).collect()}
    assert a == b


def test_confidence_offset(spark):
    from affinity.sources.tables import INTERACTION_SCHEMA
    df = spark.createDataFrame([(1, 1, 1, 5, 1), (1, 2, 1, 0, 0)], INTERACTION_SCHEMA)
    base = {r.book_id: r.value for r in als.matrix(df, "combined", 10, 20, 5).collect()}
    shifted = {r.book_id: r.value for r in als.matrix(df, "combined", 10, 20, 5, confidence_offset=-1).collect()}
    assert base == {1: 56.0, 2: 11.0} and shifted == {1: 55.0, 2: 10.0}


def test_grids_and_protocol(spark):
    from affinity.config import Config
    from affinity.operators import prep, tuning
    from affinity.sources.tables import INTERACTION_SCHEMA
    rnd = random.Random(5)
    rows = []
    for u in range(120):
        group = range(0, 60) if u % 2 else range(60, 120)
        for b in rnd.sample(list(group), 45):
            rows.append((u, b, 1, rnd.randint(1, 5), rnd.randint(0, 1)))
    df = spark.createDataFrame(rows, INTERACTION_SCHEMA)
    cfg = Config(min_interactions=40, sample_fraction=1.0, als_rank=4, als_iter=3, als_tune_iter=3, top_k=10,
                 implicit_stage1_grid={"rank": [2, 4], "regParam": [0.1]},
                 implicit_stage2_grid={"alpha": [1.0, 10.0], "beta": [20.0]},
                 explicit_grid={"rank": [2], "regParam": [0.1, 1.0]}, combined_grid={"rating_weight": [1.0, 5.0]})
    p = prep.prepare(df, cfg).persist()
    imp = tuning.implicit_grid(spark, p, cfg).collect()
    s1 = [r for r in imp if r.stage == 1]
    s2 = [r for r in imp if r.stage == 2]
    best = max(s1, key=lambda r: (r.map, -r.rank, -r.reg))
    assert len(s1) == 2 and len(s2) == 2 and all(r.rank == best.rank and r.reg == best.reg for r in s2)
    exp = tuning.explicit_grid(spark, p, cfg).collect()
    assert len(exp) == 2 and all(r.rmse is not None and r.rmse > 0 for r in exp)
    ev = {r.split: r for r in als.two_model_protocol(spark, p, "combined", cfg).collect()}
    assert set(ev) == {"tuning", "test"}
    assert all(0 <= r.map <= r.ndcg <= 1 and r.kind == "combined" for r in ev.values())
    p.unpersist()


def test_recommend_unseen_exact(spark):
    import numpy as np
    train, _ = two_tastes(spark)
    liked = train.where("value > 3")
    model = als.fit(spark, liked, "implicit", rank=4, reg=0.1, max_iter=5, seed=42)
    k = 5
    got = {}
    for r in als.recommend_unseen(model, liked.select("user_id"), liked, k).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.book_id))
    uf = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    itf = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    seen = {}
    for r in liked.collect():
        seen.setdefault(r.user_id, set()).add(r.book_id)
    for u, recs in got.items():
        scores = sorted(((-float(np.float32(uf[u] @ itf[i])), i) for i in itf if i not in seen[u]))
        expect_top = [i for _, i in scores[:k]]
        got_items = [b for _, b in sorted(recs)]
        assert not set(got_items) & seen[u]
        assert len(got_items) == k
        assert set(got_items) == set(expect_top) or abs(scores[k - 1][0] - scores[k][0]) < 1e-4


def _counted_input(spark, monkeypatch):
    """The catalog's interactions, each row counted whenever it is made."""
    from affinity.plans import catalog
    from affinity.sources.tables import INTERACTION_SCHEMA
    made, draw = spark.sparkContext.accumulator(0), random.Random(2)
    rows = [(u, b, 1, draw.randint(0, 5), 0) for u in range(40) for b in draw.sample(range(200), 45)]

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, INTERACTION_SCHEMA).mapInArrow(count, INTERACTION_SCHEMA)
    monkeypatch.setattr(catalog, "_inter", lambda *_: df)
    return catalog, made, len(rows)


def test_input_of_a_fit_is_made_once(spark, monkeypatch):
    from affinity.sources.scratch import Run
    catalog, made, n = _counted_input(spark, monkeypatch)
    with Run(spark) as run:
        assert catalog._written(spark, "", run).count() == n
    assert made.value == n


def test_popularity_beside_the_models_reads_the_written_table(spark, monkeypatch):
    catalog, made, n = _counted_input(spark, monkeypatch)
    expect = sorted(tuple(r) for r in catalog.q_popularity_eval(spark, "").select("split", "map", "ndcg").collect())
    before = made.value
    monkeypatch.setattr(catalog.als, "two_model_protocol", lambda *_: spark.createDataFrame([], als.EVAL_SCHEMA))
    got = sorted(tuple(r) for r in catalog._model_table(spark, "").where("model = 'popularity'").drop("model").collect())
    assert got == expect and got
    assert made.value - before == n


def test_signals_are_made_before_the_join(spark):
    from affinity.sources import fx_interactions
    from conftest import SF001
    node = fx_interactions(spark, SF001)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    moved = node.left().output().mkString(",")
    assert "is_read#" in moved and "l_discount" not in moved and "l_returnflag" not in moved, moved
