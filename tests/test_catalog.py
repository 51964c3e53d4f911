import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_check import compare, duck


def test_registry_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60 and len(sql) >= 50


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert {r.split for r in rows} <= {"tuning", "test"}
    assert df.columns[:3] == ["split", "map", "ndcg"]


FAST = ["interactions", "holdout_roles", "signal_coverage", "user_activity_stats", "popularity_topk",
        "popularity_eval_users", "ranking_eval", "split_user_overlap", "dataset_summary", "combined_confidence",
        "minhash_signatures", "lsh_reduction", "stability_gap", "sample_drift"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_sf0001(spark, name):
    con = duck(SF001)
    r = compare(spark, con, SF001, name, E.queries()[name], E.oracle_sql()[name])
    assert r["status"] == "ok", r


def test_every_oracle_sql_runs_and_names_match_spark(spark):
    con = duck(SF001)
    qs = E.queries()
    for name, sql in E.oracle_sql().items():
        cols = [d[0] for d in con.sql(sql).description]
        spark_cols = qs[name](spark, SF001).columns
        assert sorted(cols) == sorted(spark_cols), (name, cols, spark_cols)
