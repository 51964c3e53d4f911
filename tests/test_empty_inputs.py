"""Every non-MLlib operator runs on empty inputs (no ANSI division errors,
no empty-collection failures)."""

from pyspark.sql import functions as F

from affinity.config import Config
from affinity.operators import evaluation as E, popularity as P, prep, profile as PR, segments as SEG, signals as SG
from conftest import interactions_df


def test_operators_on_empty_inputs(spark):
    e = interactions_df(spark, [])
    cfg = Config(min_interactions=1, sample_fraction=1.0)
    p = prep.prepare(e, cfg)
    train = prep.train_of(p)
    frames = [
        p, prep.train_union(p), prep.split_users(p), prep.filter_active(e, 5),
        PR.coverage(e), PR.signal_breakdown({"x": e}), PR.rating_histogram(e), PR.user_activity_stats(e),
        PR.size_check(p, "holdout", 20), PR.split_user_overlap(p), PR.split_table_stats(p),
        PR.readiness(p, F.col("rating") > 0), PR.activity_summary(e, 5, F.lit(True)), PR.sample_drift(e, F.lit(True)),
        PR.user_split_shares(p), PR.split_accounting(p), PR.dataset_summary(p),
        SG.explicit_matrix(train), SG.confidence_levels(train, 10, 20, 5), SG.model_coverage(train),
        SG.initial_rating_weight(train, 10), P.popularity_topk(train, 10), P.popularity_coverage(train),
    ]
    top = P.popularity_topk(train, 10).select("rank", "book_id")
    hold = p.where("role = 'holdout'").select("split", "user_id", "book_id")
    frames += [E.evaluate(top, hold, keys=("split",)), E.metrics_long(E.evaluate(top, hold, keys=("split",)))]
    readers = e.select("user_id", "book_id", "is_read")
    pairs = SEG.reader_pairs(readers)
    counts = SEG.qualified_items(pairs, 1)
    found = SEG.lsh_pairs(readers, 1, 5, 42, 0.5)
    frames += [SEG.reader_sets(pairs, counts, 16), SEG.minhash_signatures(pairs, 5, 42), found,
               SEG.lsh_reduction(counts, found), SEG.top_pairs(found, 10), SEG.similarity_bands(SEG.top_pairs(found, 10))]
    for df in frames:
        df.collect()
    assert SEG.lsh_reduction(counts, found).collect()[0].n_items == 0
