import random
from itertools import combinations

from pyspark.sql import functions as F

from affinity.operators import segments as SEG


def readers_df(spark, sets: dict[int, set[int]]):
    rows = [(u, b, 1) for b, us in sets.items() for u in us]
    return spark.createDataFrame(rows, "user_id int, book_id int, is_read int")


def exact_pairs(sets, max_distance):
    out = {}
    for a, b in combinations(sorted(sets), 2):
        inter = len(sets[a] & sets[b])
        if not inter:
            continue
        dist = 1.0 - inter / len(sets[a] | sets[b])
        if dist < max_distance:
            out[(a, b)] = round(1.0 - dist, 6)
    return out


def test_jaccard_exact_strict_threshold(spark):
    sets = {1: {1, 2, 3}, 2: {2, 3, 4}, 3: {1, 2, 3}}  # d(1,2)=0.5, d(1,3)=0
    got = {(r.book_id_1, r.book_id_2): r.jaccard_similarity
           for r in SEG.lsh_pairs(readers_df(spark, sets), 1, 5, 42, 0.5).collect()}
    assert got == {(1, 3): 1.0}  # distance exactly 0.5 dropped, no self / duplicate pairs
    got = {(r.book_id_1, r.book_id_2) for r in SEG.lsh_pairs(readers_df(spark, sets), 1, 20, 42, 0.51).collect()}
    assert (1, 3) in got


def planted_series(seed=1):
    rnd = random.Random(seed)
    sets = {}
    item = 0
    for c in range(3):  # 3 clusters of 4 items sharing >= 90% of 60 readers
        core = set(rnd.sample(range(c * 1000, c * 1000 + 500), 60))
        for _ in range(4):
            s = set(core)
            for u in rnd.sample(sorted(core), 3):
                s.discard(u)
            sets[item] = s
            item += 1
    for _ in range(30):  # random items
        sets[item] = set(rnd.sample(range(5000, 9000), rnd.randint(40, 80)))
        item += 1
    return sets


def test_lsh_subset_of_exact_and_recall(spark):
    sets = planted_series()
    got = {(r.book_id_1, r.book_id_2): r.jaccard_similarity
           for r in SEG.lsh_pairs(readers_df(spark, sets), 30, 5, 42, 0.5).collect()}
    exact = exact_pairs(sets, 0.5)
    assert set(got) <= set(exact)
    assert all(got[p] == exact[p] for p in got)  # similarity is exact, only recall is approximate
    planted = {p for p in exact if p[0] < 12 and p[1] < 12}
    assert len(planted) == 18 and planted <= set(got)


def test_signatures_and_candidates(spark):
    sets = planted_series()
    df = readers_df(spark, sets)
    pairs = SEG.reader_pairs(df)
    sig = SEG.minhash_signatures(pairs, 5, 42)
    assert sig.count() == 5 * len(sets)
    cand = {(r.book_id_1, r.book_id_2) for r in SEG.lsh_candidates(sig).collect()}
    assert all(a < b for a, b in cand)
    q = {r.book_id: r.n_readers for r in SEG.qualified_items(pairs, 60).collect()}
    assert all(n >= 60 for n in q.values())


def test_reduction_topk_bands(spark):
    sets = planted_series()
    df = readers_df(spark, sets)
    found = SEG.lsh_pairs(df, 30, 5, 42, 0.5)
    counts = SEG.qualified_items(SEG.reader_pairs(df), 30)
    red = SEG.lsh_reduction(counts, found).collect()[0]
    assert red.n_items == 42 and red.all_pairs == 42 * 41 // 2 and red.low_yield
    top = SEG.top_pairs(found, 5).orderBy("rank").collect()
    sims = [r.jaccard_similarity for r in top]
    assert sims == sorted(sims, reverse=True) and [r.rank for r in top] == [1, 2, 3, 4, 5]
    item_map = spark.createDataFrame([(i, i + 1000000) for i in range(42)], "book_id_csv int, book_id int")
    seg = SEG.segment_topk(found, item_map, 5).collect()
    assert all(r.external_id_1 == r.book_id_1 + 1000000 for r in seg)
    bands = {r.band: r.n_pairs for r in SEG.similarity_bands(SEG.top_pairs(found, 100)).collect()}
    assert sum(bands.values()) == found.count()


def mllib_lsh_pairs(readers, min_readers, num_tables, seed, max_distance,
                    num_features=1 << 30):
    """The same pairs by MLlib, for comparison: it needs each item's whole reader set in one row."""
    from pyspark.ml.feature import HashingTF, MinHashLSH

    pairs = SEG.reader_pairs(readers)
    counts = SEG.qualified_items(pairs, min_readers)
    qp = pairs.join(counts.select("book_id"), "book_id", "left_semi")
    tokens = qp.groupBy("book_id").agg(F.collect_list(F.col("user_id").cast("string")).alias("user_tokens"))
    vec = HashingTF(inputCol="user_tokens", outputCol="features", numFeatures=num_features, binary=True).transform(tokens)
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=num_tables, seed=seed).fit(vec)
    j = model.approxSimilarityJoin(vec, vec, max_distance, distCol="jaccard_dist")
    return (j.where(F.col("datasetA.book_id") < F.col("datasetB.book_id"))
            .select(F.col("datasetA.book_id").alias("book_id_1"), F.col("datasetB.book_id").alias("book_id_2"),
                    F.round(F.lit(1.0) - F.col("jaccard_dist"), 6).alias("jaccard_similarity")))


def test_mllib_route_agrees_on_similarity(spark):
    sets = planted_series()
    df = readers_df(spark, sets)
    native = {(r.book_id_1, r.book_id_2): r.jaccard_similarity for r in SEG.lsh_pairs(df, 30, 5, 42, 0.5).collect()}
    ml = {(r.book_id_1, r.book_id_2): r.jaccard_similarity
          for r in mllib_lsh_pairs(df, 30, 5, 42, 0.5).collect()}
    exact = exact_pairs(sets, 0.5)
    assert set(ml) <= set(exact) and all(ml[p] == exact[p] for p in ml)
    common = set(ml) & set(native)
    assert common and all(ml[p] == native[p] for p in common)


def test_reader_sets_bounded_chunks(spark):
    sets = {1: set(range(0, 250)), 2: set(range(100, 110))}
    pairs = SEG.reader_pairs(readers_df(spark, sets))
    counts = SEG.qualified_items(pairs, 1)
    rows = SEG.reader_sets(pairs, counts, chunk_size=100).collect()
    by_item = {}
    for r in rows:
        assert r.n_tokens == len(r.user_tokens) and r.n_tokens <= 2 * 100
        assert [int(x) for x in r.user_tokens] == sorted(int(x) for x in r.user_tokens)
        by_item.setdefault(r.book_id, set()).update(int(x) for x in r.user_tokens)
    assert by_item == sets
    assert len([r for r in rows if r.book_id == 1]) == 3  # ceil(250 / 100) chunks


def test_banded_candidates_keep_every_feasible_pair(spark):
    rnd = random.Random(9)
    sets = {i: set(rnd.sample(range(400), rnd.choice([5, 20, 60, 150, 300]))) for i in range(40)}
    pairs = SEG.reader_pairs(readers_df(spark, sets))
    counts = SEG.qualified_items(pairs, 1)
    sig = SEG.minhash_signatures(pairs, 5, 42)
    for dist in (0.5, 0.8):
        allc = {(r.book_id_1, r.book_id_2) for r in SEG.lsh_candidates(sig).collect()}
        band = {(r.book_id_1, r.book_id_2) for r in SEG.banded_candidates(sig, counts, dist).collect()}
        assert all(r.n1 == len(sets[r.book_id_1]) and r.n2 == len(sets[r.book_id_2])
                   for r in SEG.banded_candidates(sig, counts, dist).collect())
        feasible = {(a, b) for a, b in allc
                    if min(len(sets[a]), len(sets[b])) / max(len(sets[a]), len(sets[b])) >= 1 - dist}
        assert feasible <= band <= allc
        assert len(band) < len(allc)


def test_hot_bucket_and_hot_probe_are_split(spark):
    """One signature shared by every item: its pairs come out of many tasks, and none is lost."""
    n = 1200
    sig = spark.range(n).selectExpr("cast(id as int) AS book_id", "0 AS hash_table", "cast(7 as bigint) AS signature")
    sig = sig.union(spark.range(n, 3 * n).selectExpr("cast(id as int)", "0", "cast(id as bigint)"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        a = sig.withColumnRenamed("book_id", "book_id_1")
        b = sig.withColumnRenamed("book_id", "book_id_2")
        per_task = [r["count"] for r in SEG._bucket_join(a, b, ["hash_table", "signature"], 100)
                    .groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == n * (n - 1) // 2
        assert len(per_task) > 4 and max(per_task) < 0.5 * sum(per_task)
        assert SEG.lsh_candidates(sig, 100).count() == n * (n - 1) // 2
        # one hot item: 3,000 readers, 60 candidates
        sets = {0: set(range(3000))} | {i: set(range(i, 3000 + i)) for i in range(1, 61)}
        pairs = SEG.reader_pairs(readers_df(spark, sets))
        cand = spark.createDataFrame([(0, i) for i in range(1, 61)], "book_id_1 int, book_id_2 int")
        got = {(r.book_id_1, r.book_id_2): r.jaccard_similarity for r in SEG.verify_pairs(
            cand, pairs, SEG.qualified_items(pairs, 1), 0.5).collect()}
        assert got == {(0, i): round((3000 - i) / (3000 + i), 6) for i in range(1, 61)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_co_readers_by_pairing_and_by_probing(spark):
    """Many candidates with large audiences are counted from the readers' side, hot readers are probed; few are probed."""
    rnd = random.Random(4)
    sets = {i: set(rnd.sample(range(300), 120)) | {1000, 1001} for i in range(24)}
    pairs = SEG.reader_pairs(readers_df(spark, sets)).cache()
    every = [(a, b, len(sets[a]), len(sets[b])) for a in sets for b in sets if a < b]
    for chosen, most, probes in ((every, 1024, False), (every, 20, True), (every[:2], 1024, True)):
        cand = spark.createDataFrame(chosen, "book_id_1 int, book_id_2 int, n1 long, n2 long")
        co = SEG.co_readers(cand, pairs, most)
        assert {tuple(r) for r in co.collect()} == {(*c, len(sets[c[0]] & sets[c[1]])) for c in chosen}
        assert ("Generate" in co._jdf.queryExecution().optimizedPlan().toString()) == probes
    pairs.unpersist()
