import math

import pytest
from pyspark.sql import functions as F

from affinity.operators import evaluation as E
from affinity.operators import popularity as P
from conftest import interactions_df


def test_golden_popularity_formula(spark):
    # Published top row: avg 4.4984466166553005, 13414 reads -> 42.75348053544129.
    df = spark.createDataFrame([(943, 13414, 4.4984466166553005)], "book_id int, read_count long, avg_rating double")
    got = df.select((F.col("avg_rating") * F.log(F.col("read_count").cast("double"))).alias("s")).collect()[0].s
    assert got == pytest.approx(42.75348053544129, abs=1e-12)


def test_scores_need_both_signals_and_ln1_is_zero(spark):
    rows = [(1, 10, 1, 5, 0),                      # item 10: one read, rated 5 -> ln(1) = 0
            (1, 11, 1, 0, 0), (2, 11, 1, 0, 0),    # item 11: reads, no rating -> excluded
            (1, 12, 0, 4, 0),                      # item 12: rating, no read -> excluded
            (1, 13, 1, 4, 0), (2, 13, 1, 2, 0), (3, 13, 1, 0, 0)]
    s = {r.book_id: r for r in P.popularity_scores(interactions_df(spark, rows)).collect()}
    assert set(s) == {10, 13}
    assert s[10].popularity_score == 0.0
    assert s[13].read_count == 3 and s[13].avg_rating == 3.0
    assert s[13].popularity_score == pytest.approx(3.0 * math.log(3))


def test_topk_tie_break(spark):
    scores = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 1.0), (4, 0.5)], "book_id int, popularity_score double")
    top = [(r.rank, r.book_id) for r in P.top_k(scores, 3).orderBy("rank").collect()]
    assert top == [(1, 1), (2, 2), (3, 3)]


K = 10


def _rank_cases(spark):
    # users: 1 hit at rank 1, 2 hit at rank 2, 3 hit at rank k, 4 several hits, 5 none
    top = spark.createDataFrame([(r, 100 + r) for r in range(1, K + 1)], "rank int, book_id int")
    hold = [(1, 101), (1, 500), (2, 102), (3, 100 + K), (4, 103), (4, 105), (4, 999), (5, 777)]
    holdout = spark.createDataFrame(hold, "user_id int, book_id int")
    return top, holdout


def test_rank_cases_global_list(spark):
    top, holdout = _rank_cases(spark)
    per = {r.user_id: r for r in E.evaluate_users(top, holdout).collect()}
    assert per[1].ap == 1.0 and per[1].ndcg == 1.0
    assert per[2].ap == 0.5 and per[2].ndcg == pytest.approx(0.63093, abs=1e-5)
    assert per[3].ap == pytest.approx(1 / K) and per[3].ndcg == pytest.approx(1 / math.log2(K + 1))
    assert per[4].best_rank == 3 and per[4].n_hits == 2 and per[4].n_holdout == 3
    assert per[5].best_rank is None and per[5].ap == 0.0 and per[5].ndcg == 0.0
    s = E.summarize(E.evaluate_users(top, holdout)).collect()[0]
    assert s.n_users == 5 and s.n_user_hits == 4 and s.n_item_hits == 5
    assert s.map == pytest.approx(round((1 + 0.5 + 1 / K + 1 / 3) / 5, 6))
    for r in per.values():
        assert r.ap <= r.ndcg <= 1.0


def test_global_list_equals_replicated_per_user_lists(spark):
    top, holdout = _rank_cases(spark)
    users = holdout.select("user_id").distinct()
    per_user_recs = users.crossJoin(top)  # test-only: tiny
    a = sorted(tuple(r) for r in E.evaluate_users(top, holdout).collect())
    b = sorted(tuple(r) for r in E.evaluate_users(per_user_recs, holdout)
               .select("user_id", "n_holdout", "n_hits", "best_rank", "ap", "ndcg").collect())
    assert a == b


def test_empty_holdout_user_kept_with_zero(spark):
    recs = spark.createDataFrame([(1, 1, 50), (1, 2, 51)], "user_id int, rank int, book_id int")
    holdout = spark.createDataFrame([(1, 51), (2, 60)], "user_id int, book_id int")  # user 2 has no recs
    per = {r.user_id: r for r in E.evaluate_users(recs, holdout).collect()}
    assert per[2].ap == 0.0 and per[2].n_hits == 0
    assert per[1].best_rank == 2


def test_best_config_comparison_gap(spark):
    t = spark.createDataFrame(
        [("a", "tuning", 0.2, 0.3), ("a", "test", 0.25, 0.35), ("b", "tuning", 0.3, 0.4), ("b", "test", 0.2, 0.3),
         ("c", "tuning", 0.3, 0.1), ("c", "test", 0.1, 0.1)],
        "variant string, split string, map double, ndcg double")
    assert E.best_config(t, "variant").collect()[0].variant == "b"  # tie with c broken by name
    cmp = {r.variant: r for r in E.model_comparison(t, "variant", "a").collect()}
    assert cmp["a"].map_lift_pct == 0.0 and cmp["b"].map_lift_pct == pytest.approx(-20.0)
    gap = {r.variant: r.map_gap for r in E.stability_gap(t, "variant").collect()}
    assert gap == {"a": 0.05, "b": -0.1, "c": -0.2}


def test_metrics_long_typed(spark):
    s = spark.createDataFrame([("test", 0.1, 0.2, 5, 3, 7, 0.6, 1.4)],
                              "split string, map double, ndcg double, n_users long, n_user_hits long, "
                              "n_item_hits long, user_hit_rate double, item_hit_rate double")
    m = {r.metric: r.value for r in E.metrics_long(s).collect()}
    assert m["test_map"] == 0.1 and m["test_n_users"] == 5.0 and len(m) == 7


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 9), st.lists(st.integers(0, 30), min_size=1, max_size=12, unique=True),
                       min_size=1, max_size=6),
       st.lists(st.tuples(st.integers(0, 11), st.integers(0, 30)), min_size=1, max_size=40, unique=True))
def test_evaluator_matches_bruteforce(spark, lists, holdout):
    recs = spark.createDataFrame([(u, r + 1, b) for u, items in lists.items() for r, b in enumerate(items)] or
                                 [(99, 1, 99)], "user_id int, rank int, book_id int")
    hold = spark.createDataFrame(holdout, "user_id int, book_id int")
    got = {r.user_id: r for r in E.evaluate_users(recs, hold).collect()}
    users = {u for u, _ in holdout}
    assert set(got) == users
    for u in users:
        items = [b for uu, b in holdout if uu == u]
        ranks = [lists[u].index(b) + 1 for b in items if b in lists.get(u, [])]
        best = min(ranks) if ranks else None
        assert got[u].n_holdout == len(items) and got[u].n_hits == len(ranks) and got[u].best_rank == best
        assert got[u].ap == pytest.approx(1 / best if best else 0.0)
        assert got[u].ndcg == pytest.approx(1 / math.log2(best + 1) if best else 0.0)
