import hashlib
import random

from pyspark.sql import functions as F

from affinity.config import Config
from affinity.functions.hashing import bernoulli, hex_threshold
from affinity.operators import prep
from conftest import interactions_df


def brute_roles(rows, cfg: Config, split_of):
    """Pure-Python roles: order rows of each user by md5 key, last holdout rows
    holdout, the history rows before them history."""
    by_user = {}
    for r in rows:
        by_user.setdefault(r[0], []).append(r)
    out = {}
    for u, rs in by_user.items():
        if len(rs) < cfg.min_interactions:
            continue
        split = split_of(u)
        seed = cfg.seed_tuning if split == "tuning" else cfg.seed_test
        ordered = sorted(rs, key=lambda r: (hashlib.md5(f"order|{seed}|{u}|{r[1]}".encode()).hexdigest(), r[1]))
        n = len(ordered)
        for rn, r in enumerate(ordered, start=1):
            if split == "train":
                role = "train"
            elif rn > n - cfg.holdout_size:
                role = "holdout"
            elif rn > n - cfg.reserved:
                role = "history"
            else:
                role = "train"
            out[(u, r[1])] = (split, role)
    return out


def test_activity_filter_edges(spark):
    rows = []
    for u, n in ((1, 4), (2, 5), (3, 6)):  # min - 1, min, min + 1
        rows += [(u, b, 1, 0, 0) for b in range(n)]
    df = interactions_df(spark, rows)
    got = sorted(r.user_id for r in prep.active_users(df, 5).collect())
    assert got == [2, 3]
    assert prep.filter_active(df, 5).count() == 11
    counts = {r.user_id: r.n_interactions for r in prep.user_activity(df).collect()}
    assert counts == {1: 4, 2: 5, 3: 6}


def test_hash_sample_independent_of_partitioning(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("int").alias("user_id"))
    pred = bernoulli("sample", 42, 0.3, "user_id")
    a = {r.user_id for r in df.repartition(3).where(pred).collect()}
    b = {r.user_id for r in df.repartition(11).where(pred).collect()}
    assert a == b
    assert 0.25 < len(a) / 5000 < 0.35
    # Same draw as plain md5 in Python.
    cut = hex_threshold(0.3)
    expect = {u for u in range(5000) if hashlib.md5(f"sample|42|{u}".encode()).hexdigest()[:8] < cut}
    assert a == expect


def test_split_weights(spark):
    cfg = Config()
    df = spark.range(0, 20000).select(F.col("id").cast("int").alias("user_id"))
    counts = {r.split: r["count"] for r in df.select(prep.split_column(cfg).alias("split")).groupBy("split").count().collect()}
    assert set(counts) == {"train", "tuning", "test"}
    assert abs(counts["train"] / 20000 - 0.6) < 0.02
    assert abs(counts["tuning"] / 20000 - 0.2) < 0.02


def _random_rows(n_users, seed, hot_rows=0):
    rnd = random.Random(seed)
    rows = []
    for u in range(n_users):
        n = rnd.randint(5, 70)
        for b in rnd.sample(range(2000), n):
            rows.append((u, b, rnd.randint(0, 1), rnd.randint(0, 5), rnd.randint(0, 1)))
    if hot_rows:
        for b in range(hot_rows):
            rows.append((n_users, 10_000 + b, 1, 0, 0))
    return rows


def test_roles_match_bruteforce_with_hot_user(spark):
    cfg = Config(min_interactions=12, sample_fraction=1.0, history_size=3, holdout_size=5,
                 split_weights=(0.2, 0.4, 0.4))
    rows = _random_rows(60, 7, hot_rows=6000)
    df = interactions_df(spark, rows)
    got = {(r.user_id, r.book_id): (r.split, r.role) for r in prep.prepare(df, cfg).collect()}
    split_of = {r.user_id: r.split for r in df.select("user_id").distinct()
                .select("user_id", prep.split_column(cfg).alias("split")).collect()}
    expect = brute_roles(rows, cfg, split_of.get)
    assert got == expect


def test_roles_when_fewer_rows_than_reserved(spark):
    # n < history + holdout: the study's rule still applies (rn > n - 20 -> holdout).
    cfg = Config(min_interactions=1, sample_fraction=1.0, history_size=10, holdout_size=20,
                 split_weights=(0.0, 1.0, 0.0))
    rows = [(1, b, 1, 0, 0) for b in range(25)] + [(2, b, 1, 0, 0) for b in range(12)]
    got = {(r.user_id, r.book_id): (r.split, r.role) for r in prep.prepare(interactions_df(spark, rows), cfg).collect()}
    assert got == brute_roles(rows, cfg, lambda u: "tuning")


def test_role_invariants_over_seeds(spark):
    rows = _random_rows(200, 3)
    df = interactions_df(spark, rows).persist()
    for seed in (42, 7, 99):
        cfg = Config(min_interactions=40, sample_fraction=0.8, sample_seed=seed, split_seed=seed)
        p = prep.prepare(df, cfg).persist()
        # roles partition the kept rows exactly
        kept_users = {r.user_id for r in prep.active_users(df, 40).collect()}
        sampled = df.where(prep.sample_predicate(0.8, seed)).where(F.col("user_id").isin(list(kept_users)))
        assert p.count() == sampled.count()
        assert p.select("user_id", "book_id").distinct().count() == p.count()
        # every evaluated user: exactly 10 history and 20 holdout rows
        per = (p.where(F.col("split") != "train").groupBy("user_id")
               .agg(F.count_if(F.col("role") == "history").alias("h"), F.count_if(F.col("role") == "holdout").alias("o"))
               .collect())
        assert per and all(r.h == 10 and r.o == 20 for r in per)
        # train-split users keep every row as train; a user has one split
        assert p.where((F.col("split") == "train") & (F.col("role") != "train")).count() == 0
        assert p.groupBy("user_id").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0
        p.unpersist()
    df.unpersist()


def test_split_tables_and_train_union(spark):
    cfg = Config(min_interactions=40, sample_fraction=1.0)
    rows = _random_rows(150, 11)
    p = prep.prepare(interactions_df(spark, rows), cfg).persist()
    t = prep.split_tables(p)
    total = sum(v.count() for v in t.values())
    assert total == p.count()  # zero rows discarded
    tu = prep.train_union(p)
    assert tu.count() == t["train"].count()
    assert {r.source for r in tu.select("source").distinct().collect()} <= {"train", "tuning", "test"}
    fit = prep.fit_rows(p, "tuning")
    assert fit.count() == t["train"].count() + t["tuning_history"].count()
    p.unpersist()


def test_prepare_table_roundtrip(spark):
    cfg = Config(min_interactions=40, sample_fraction=1.0)
    df = interactions_df(spark, _random_rows(80, 5))
    lazy = {tuple(r) for r in prep.prepare(df, cfg).collect()}
    stored = {tuple(r) for r in prep.prepare_table(df, cfg).collect()}
    assert lazy == stored


def test_prepare_independent_of_partitioning(spark):
    cfg = Config(min_interactions=40, sample_fraction=0.7)
    rows = _random_rows(120, 21)
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            df = interactions_df(spark, rows).repartition(int(parts))
            results.append({tuple(r) for r in prep.prepare(df, cfg).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] and results[0]


def test_kept_intermediates_give_the_same_rows(spark):
    from affinity.sources.scratch import Run
    cfg = Config(min_interactions=40, sample_fraction=0.7)
    df = interactions_df(spark, _random_rows(80, 5))
    lazy = sorted(tuple(r) for r in prep.prepare(df, cfg).collect())
    with Run(spark) as run:
        assert lazy == sorted(tuple(r) for r in prep.prepare(df, cfg, keep=run.keep).collect())
    assert lazy


def test_order_key_is_not_moved_through_the_join(spark):
    cfg = Config(min_interactions=1, sample_fraction=1.0)
    plan = prep.prepare(interactions_df(spark, _random_rows(5, 5)), cfg)._jdf.queryExecution().optimizedPlan()
    joins, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Join":
            joins.append(node.left().output().mkString(","))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert len(joins) == 2 and all("user_id" in j for j in joins)
    assert not any("_k#" in j for j in joins), joins


def test_hashes_of_a_row_are_made_once(spark):
    from affinity.sources.scratch import Run
    cfg = Config(min_interactions=40, sample_fraction=0.7)
    kept = {}
    with Run(spark) as run:
        def keep(df, name):
            kept[name] = df._jdf.queryExecution().optimizedPlan().toString()
            return run.keep(df, name)
        out = prep.prepare(interactions_df(spark, _random_rows(80, 5)), cfg, keep=keep)
        read = out._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in kept["sampled"] and "md5" not in kept["cuts"]
    assert read.count("md5") == read.count("unhex") == 1  # the order of candidates
