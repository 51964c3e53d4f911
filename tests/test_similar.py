import random

import pytest
from pyspark.sql import functions as F

from affinity.config import FIXTURE
from affinity.operators import segments as SEG
from affinity.operators import similar as S
from affinity.operators.numbering import dense_numbers
from affinity.sources.scratch import Run
from test_segments import exact_pairs, planted_series, readers_df


@pytest.fixture
def run(spark):
    with Run(spark) as r:
        yield r


def found(df):
    return {(r.book_id_1, r.book_id_2): r.jaccard_similarity for r in df.collect()}


def mixed_sets(seed=3, n=50):
    rnd = random.Random(seed)
    sets = {i: set(rnd.sample(range(300), rnd.choice([1, 2, 5, 20, 60, 150]))) for i in range(n)}
    sets |= {1000 + i: set(rnd.sample(sorted(sets[i]), max(1, len(sets[i]) * 4 // 5))) for i in range(n)}
    return sets | {2000: set(range(300)), 2001: set(range(300)), 2002: {299}}


@pytest.mark.parametrize("distance", [0.1, 0.5, 0.9, 1.0])
def test_jaccard_pairs_miss_nothing(spark, run, distance):
    sets = mixed_sets()
    assert found(S.jaccard_pairs(readers_df(spark, sets), 1, distance, run, chunk=7)) == exact_pairs(sets, distance)


def test_strict_threshold_and_qualified_items_only(spark, run):
    sets = {1: {1, 2, 3}, 2: {2, 3, 4}, 3: {1, 2, 3}, 4: {1, 2}}
    df = readers_df(spark, sets)
    assert found(S.jaccard_pairs(df, 3, 0.5, run)) == {(1, 3): 1.0}
    assert found(S.jaccard_pairs(df, 9, 0.5, run)) == {}
    assert found(S.jaccard_pairs(df.where("false"), 1, 0.5, run)) == {}


def test_no_pair_is_generated_that_fails_the_prefix_bounds(spark, run):
    sets = mixed_sets(5)
    t = 0.5
    pairs = SEG.reader_pairs(readers_df(spark, sets))
    counts = SEG.qualified_items(pairs, 1)
    index = S.prefix_index(pairs, counts, t, run, span=16).collect()
    freq = {}
    for us in sets.values():
        for u in us:
            freq[u] = freq.get(u, 0) + 1
    number = {u: i for i, u in enumerate(sorted(freq, key=lambda u: (freq[u], u)))}
    want = set()
    for b, us in sets.items():
        n = len(us)
        for place, x in enumerate(sorted(number[u] for u in us)[:n - -(-n // 2) + 1], 1):
            want.add((x, b, n, place))
    assert {(r.number, r.book_id, r.n, r.place) for r in index} == want
    by = {}
    for x, b, n, place in want:
        by.setdefault(x, []).append((b, n, place))
    allowed = {(min(a, b), max(a, b)) for here in by.values() for a, n1, p1 in here for b, n2, p2 in here
               if a != b and min(n1, n2) >= t * max(n1, n2) and 3 * (1 + min(n1 - p1, n2 - p2)) >= n1 + n2}
    table = spark.createDataFrame(index)
    cand = {(r.book_id_1, r.book_id_2) for r in S.prefix_candidates(table, table, t).collect()}
    assert cand == allowed and set(exact_pairs(sets, 0.5)) <= cand and len(cand) < len(sets) * (len(sets) - 1) / 8


def test_hot_reader_is_split_over_tasks(spark, run):
    """One reader of every item: its pairs come out of many tasks."""
    index = spark.range(1200).selectExpr("cast(7 AS bigint) AS number", "cast(id AS int) AS book_id", "cast(1 AS bigint) AS n", "cast(1 AS bigint) AS place")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        a = index.select("number", F.col("book_id").alias("book_id_1"))
        b = index.select("number", F.col("book_id").alias("book_id_2"))
        per_task = [r["count"] for r in S._sub_buckets(a, b, ["number"], 100).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 1200 ** 2 and len(per_task) > 4 and max(per_task) < 0.5 * sum(per_task)
        assert S.prefix_candidates(index, index, 0.5, 100).count() == 1200 * 1199 // 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_item_is_numbered_in_runs(spark, run):
    sets = {1: set(range(5000)), 2: set(range(10, 5010)), 3: {4, 5}}
    pairs = SEG.reader_pairs(readers_df(spark, sets))
    plan = S.prefix_index(pairs, SEG.qualified_items(pairs, 1), 0.9, run, span=100)
    rows = plan.collect()
    assert sum(r.book_id == 1 for r in rows) == 501 and {r.place for r in rows if r.book_id == 1} == set(range(1, 502))
    assert "windowspecdefinition(book_id#" in plan._jdf.queryExecution().toString()
    assert found(S.jaccard_pairs(readers_df(spark, sets), 1, 0.1, run)) == {(1, 2): round(4990 / 5010, 6)}


@pytest.mark.parametrize("k, start", [(1, 1), (10, 2), (10_000, 8)])
def test_topk_equals_the_exact_top(spark, run, k, start):
    sets = mixed_sets(11)
    top, _ = S.topk_pairs(readers_df(spark, sets), 1, 0.9, k, run, start=start, growth=3)
    want = sorted(((-s, a, b) for (a, b), s in exact_pairs(sets, 0.9).items()))[:k]
    assert sorted((-s, a, b) for (a, b), s in found(top).items()) == want


def test_topk_verifies_far_fewer_pairs_than_there_are(spark, run):
    sets = planted_series() | {100 + i: s for i, s in planted_series(2).items()}
    n = len(sets)
    top, rounds = S.topk_pairs(readers_df(spark, sets), 30, 0.9, 10, run)
    want = sorted(((-s, a, b) for (a, b), s in exact_pairs(sets, 0.9).items()))[:10]
    assert sorted((-s, a, b) for (a, b), s in found(top).items()) == want
    bounds = [r["bound"] for r in rounds]
    assert bounds == sorted(bounds) and sum(r["verified"] for r in rounds) < n * (n - 1) / 2 / 20
    work = S.topk_work(readers_df(spark, sets), 30, 0.9, 10, run).first()
    assert work.all_pairs == n * (n - 1) // 2 and work.pairs_verified == sum(r["verified"] for r in rounds)


def test_topk_of_nothing(spark, run):
    df = readers_df(spark, {1: {1}, 2: {2}})
    assert S.topk_pairs(df, 1, 0.5, 5, run)[0].isEmpty()
    assert S.topk_pairs(df.where("false"), 1, 0.5, 5, run)[0].isEmpty()


def test_reader_vectors_number_the_vocabulary(spark, run):
    sets = mixed_sets(7)
    pairs = SEG.reader_pairs(readers_df(spark, sets))
    rows = S.reader_vectors(pairs, run, span=32).collect()
    freq = {}
    for us in sets.values():
        for u in us:
            freq[u] = freq.get(u, 0) + 1
    index = {u: i for i, u in enumerate(sorted(freq, key=lambda u: (-freq[u], u)))}
    got = {}
    for r in rows:
        assert r.n_tokens == len(r.indices) <= 32 and list(r.indices) == sorted(r.indices)
        assert all(x // 32 == r.chunk for x in r.indices)
        got.setdefault(r.book_id, set()).update(r.indices)
    assert got == {b: {index[u] for u in us} for b, us in sets.items()}


@pytest.mark.parametrize("partitions", [1, 7])
def test_dense_numbers_are_the_order(spark, run, partitions):
    df = spark.range(2000).select((F.xxhash64("id") % 50).alias("x"), "id").repartition(partitions)
    rows = dense_numbers(df, [F.col("x").desc(), F.col("id")], run).collect()
    assert [r.number for r in sorted(rows, key=lambda r: (-r.x, r.id))] == list(range(2000))
    assert dense_numbers(df.where("false"), [F.col("x"), F.col("id")], run).isEmpty()


def test_bands_follow_from_the_threshold():
    assert S.choose_bands(1.0 - FIXTURE.jaccard_distance, 0.95) == (FIXTURE.num_hash_tables, 1)
    for s in (0.2, 0.5, 0.8, 0.95):
        tables, rows = S.choose_bands(s, 0.95)
        assert 1 - (1 - s ** rows) ** tables >= 0.95 and tables * rows <= 64
    assert S.choose_bands(0.05, 0.95)[1] == 1


def test_more_hashes_a_table_keep_the_recall_with_fewer_candidates(spark):
    sets = planted_series()
    df = readers_df(spark, sets)
    tables, rows = S.choose_bands(0.5, 0.95)
    assert rows > 1 and set(exact_pairs(sets, 0.5)) == set(found(SEG.lsh_pairs(df, 30, tables, 42, 0.5, rows)))
    pairs = SEG.reader_pairs(readers_df(spark, mixed_sets()))
    many = SEG.lsh_candidates(SEG.minhash_signatures(pairs, tables, 42)).count()
    few = SEG.lsh_candidates(SEG.minhash_signatures(pairs, tables, 42, rows)).count()
    assert few < many


def test_recall_estimate_counts_the_sampled_items_pairs(spark, run):
    sets = mixed_sets(13)
    df = readers_df(spark, sets)
    pairs = SEG.reader_pairs(df)
    counts = SEG.qualified_items(pairs, 1)
    some = run.keep(SEG.lsh_pairs(df, 1, 1, 42, 0.8), "some")
    r = S.recall_estimate(some, pairs, counts, 0.8, 0.4, 42, run).first()
    sample = {x.book_id for x in S.recall_sample(counts, 0.4, 42).collect()}
    true = {p for p in exact_pairs(sets, 0.8) if set(p) & sample}
    hit = true & set(found(some))
    assert (r.sampled_items, r.true_pairs, r.found_pairs) == (len(sample), len(true), len(hit))
    assert r.recall == round(len(hit) / len(true), 6) and 0 <= r.recall_low < r.recall < r.recall_high <= 1
    whole = S.recall_estimate(S.jaccard_pairs(df, 1, 0.8, run), pairs, counts, 0.8, 0.4, 42, run).first()
    assert whole.recall == 1.0
    none = S.recall_estimate(some, pairs, counts, 0.8, 0.0, 42, run).first()
    assert (none.sampled_items, none.true_pairs, none.recall, none.recall_low) == (0, 0, None, None)


def test_bucket_membership_holds_every_candidate(spark):
    sets = mixed_sets(17)
    sig = SEG.minhash_signatures(SEG.reader_pairs(readers_df(spark, sets)), 3, 42)
    buckets = {}
    for r in SEG.lsh_buckets(sig).collect():
        buckets.setdefault((r.hash_table, r.signature, r.bucket_size), []).append(r.book_id)
    assert all(len(b) == size > 1 for (_, _, size), b in buckets.items())
    pairs = {(a, c) for b in buckets.values() for a in b for c in b if a < c}
    assert pairs == {(r.book_id_1, r.book_id_2) for r in SEG.lsh_candidates(sig).collect()}
