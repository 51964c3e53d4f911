"""The written study: what it counts, what its buckets save, and hot users."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from affinity.config import FIXTURE, Config
from affinity.operators import evaluation as EV, prep, profile as PR, signals as SG, study as ST
from affinity.plans import catalog
from affinity.sources.bucketed import forget, open_bucketed
from affinity.sources.scratch import Run
from conftest import SF001, SF01, interactions_df
from test_plans import executed_plan


def rows_of(df):
    return sorted(df.collect(), key=str)


@pytest.fixture(scope="module")
def study(spark):
    with Run(spark) as run:
        yield (*ST.write_study(catalog._inter(spark, SF01), FIXTURE, f"{run.path}/splits", run), f"{run.path}/splits")


def test_rows_are_those_of_prepare_in_both_readings(spark, study):
    want = rows_of(catalog._prepared(spark, SF01))
    assert rows_of(study[0].rows) == want and rows_of(study[0].by_user) == want


def test_reports_of_the_write_equal_those_of_a_scan(spark, study):
    p, seen = catalog._prepared(spark, SF01), study[1]
    train = prep.train_of(p)
    assert rows_of(ST.accounting(seen)) == rows_of(PR.split_accounting(p))
    assert rows_of(ST.coverage(seen, "train", F.col("role") == "train")) == rows_of(PR.tagged_coverage({"train": train}))
    assert rows_of(ST.coverage(seen, "sampled")) == rows_of(PR.tagged_coverage({"sampled": p}))
    assert rows_of(ST.model_coverage(seen)) == rows_of(SG.model_coverage(train))
    assert rows_of(ST.initial_rating_weight(seen, 10.0)) == rows_of(SG.initial_rating_weight(train, 10.0))
    assert "FileScan" not in executed_plan(ST.accounting(seen))


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_no_shuffle_by_user(spark, study, broadcast):
    s, before = study[0], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        with Run(spark) as run:
            lists = ST.write_lists(catalog._own_lists(s.rows, s.by_user), FIXTURE, f"{run.path}/lists", run)
            users = ST.evaluate_lists(lists, catalog._read_holdout(s.by_user))
            plan = executed_plan(users).split("== Initial Plan ==")[0]
            want = EV.evaluate_users(catalog._own_lists(s.rows, s.by_user), catalog._read_holdout(s.by_user), keys=("split",))
            assert rows_of(users.select(*want.columns)) == rows_of(want)
            again = open_bucketed(spark, f"{run.path}/lists")  # no partitions
            assert rows_of(spark.table(again)) == rows_of(lists)
            forget(spark, again)
        assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan, plan
        assert ("SortMergeJoin" in plan) == (broadcast == "-1")
        assert "Exchange" not in executed_plan(catalog._fit_data(s.rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_opened_again_from_the_files(spark, study):
    again = ST.open_study(spark, study[2])
    assert rows_of(again.by_user) == rows_of(study[0].by_user)
    plan = executed_plan(again.by_user.where("role = 'holdout'").groupBy("user_id").count())
    assert "Bucketed: true" in plan and "Exchange" not in plan
    again.close()
    assert not spark.catalog.tableExists(again.name) and study[0].rows.count() > 0


def test_hot_user_is_dealt_to_many_tasks_and_files(spark):
    cfg = Config(min_interactions=1, sample_fraction=1.0, split_weights=(0.0, 1.0, 0.0), split_buckets=4, deal_rows=1000)
    rows = [(1, b, 1, b % 6, 0) for b in range(20_000)] + [(u, b, 1, 0, 1) for u in range(2, 40) for b in range(40)]
    with Run(spark) as run:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            study, profile = ST.write_study(interactions_df(spark, rows), cfg, f"{run.path}/s", run)
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        per_file = study.rows.where("role = 'train' AND user_id = 1").groupBy(F.input_file_name()).count().collect()
        assert len(per_file) >= 5 and max(r["count"] for r in per_file) < 10_000
        assert sum(r["count"] for r in per_file) == 20_000 - cfg.reserved
        assert sum(r.n_rows for r in profile.collect()) == len(rows) == study.by_user.count()
        assert study.by_user.where("user_id = 1 AND role <> 'train'").groupBy("user_id").count().collect()[0]["count"] == cfg.reserved


def test_nulls_and_empty_input(spark):
    cfg = Config(min_interactions=1, sample_fraction=1.0, split_weights=(1.0, 0.0, 0.0), split_buckets=2)
    with_nulls = spark.createDataFrame([(1, 1, None, None, None), (1, 2, 1, 5, None)],
                                       "user_id int, book_id int, is_read int, rating int, is_reviewed int")
    with Run(spark) as run:
        _, profile = ST.write_study(with_nulls, cfg, f"{run.path}/a", run)
        assert [tuple(r) for r in profile.collect()] == [("train", "train", 2, 1, 1, 0, 1, 1, 5)]
        study, profile = ST.write_study(interactions_df(spark, []), cfg, f"{run.path}/b", run)
        assert profile.count() == 0 and study.rows.count() == 0 and study.by_user.count() == 0
        assert ST.accounting(profile).count() == 0 and ST.coverage(profile, "all").first().n_rows == 0
        name = study.name
    assert not spark.catalog.tableExists(name)


def test_repeated_queries_agree_with_the_plan_queries(spark):
    q = E.queries()
    assert rows_of(q["study_ranking_eval"](spark, SF001)) == rows_of(q["ranking_eval"](spark, SF001))
    assert rows_of(q["study_fit_data"](spark, SF001)) == rows_of(q["fit_data"](spark, SF001))
