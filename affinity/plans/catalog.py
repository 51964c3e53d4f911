"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Inputs are the fixture views over the driver tables (``affinity.sources.
fixtures``) at fixture-scale parameters (``affinity.config.FIXTURE``).  Each
query is the library operator applied to whole tables; the matching DuckDB
SQL is in ``affinity.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.config import FIXTURE, SAMPLED
from affinity.functions.metrics import r6
from affinity.operators import als, evaluation as E, popularity as P, prep, profile as PR
from affinity.operators.registry import FitRegistry
from affinity.operators import segments as SEG, signals as SG, similar as SIM, study as ST, tuning as T
from affinity.session import free_shuffles
from affinity.sources.fixtures import fx_interaction_lines
from affinity.sources.scratch import Run
from affinity.sources.sinks import write_csv_lines
from affinity.sources.tables import INTERACTION_SCHEMA, ingest_interactions_csv, ingest_report
from affinity.sources import fx_interactions, fx_item_map, fx_readers

CFG = FIXTURE
Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- inputs
def _inter(spark, sf):
    return fx_interactions(spark, sf)


def _prepared(spark, sf):
    """The prepared split table as a plan: nothing is written while a query is
    built (``jobs.preprocess`` writes it once for a study)."""
    return prep.prepare(_inter(spark, sf), CFG)


def _written(spark, sf, run):
    """The prepared table written once, for queries whose fits and evaluations read it many times."""
    out = run.keep(prep.prepare(_inter(spark, sf), CFG, keep=run.keep), "prepared")
    free_shuffles(spark)  # those of the input
    return out


def _protocol(spark, sf, kind, **options):
    with Run(spark) as run:
        return als.two_model_protocol(spark, _written(spark, sf, run), kind, CFG, **options)


def _grid(spark, sf, grid):
    with Run(spark) as run:
        return grid(spark, _written(spark, sf, run), CFG, registry=FitRegistry(spark, f"{run.path}/models"))


def _study(spark, sf):
    """The study written once, bucketed by user, with the profile of its write;
    the files go with the application."""
    run = Run(spark)
    return ST.write_study(_inter(spark, sf), CFG, f"{run.path}/splits", run)


def _train(spark, sf):
    return prep.train_of(_prepared(spark, sf))


def _active(spark, sf):
    return prep.filter_active(_inter(spark, sf), CFG.min_interactions)


def _sampled(spark, sf):
    return prep.sample_users(_active(spark, sf), SAMPLED.sample_fraction, SAMPLED.sample_seed)


def _holdout_both(prepared):
    return prepared.where(F.col("role") == "holdout").select("split", *prep.INTERACTION_COLS)


# ---------------------------------------------------------------- preparation
def q_interactions(spark, sf):
    return _inter(spark, sf)


def q_ingest_report(spark, sf):
    """A CSV of the interactions with damaged lines, written and taken in again."""
    with Run(spark) as run:
        path = f"{run.path}/interactions.csv"
        write_csv_lines(fx_interaction_lines(spark, sf), [f.name for f in INTERACTION_SCHEMA], path)
        out = ingest_report(*ingest_interactions_csv(spark, path))
        return spark.createDataFrame(out.collect(), out.schema)  # a row for each outcome


def q_item_id_map(spark, sf):
    return fx_item_map(spark, sf)


def q_user_activity(spark, sf):
    return prep.user_activity(_inter(spark, sf))


def q_active_user_filter(spark, sf):
    return _active(spark, sf)


def q_activity_summary(spark, sf):
    return PR.activity_summary(_inter(spark, sf), SAMPLED.min_interactions,
                               prep.sample_predicate(SAMPLED.sample_fraction, SAMPLED.sample_seed))


def q_user_sample(spark, sf):
    return _sampled(spark, sf)


def q_user_split(spark, sf):
    return prep.split_users(_prepared(spark, sf))


def q_holdout_roles(spark, sf):
    return _prepared(spark, sf)


def q_train_union(spark, sf):
    return prep.train_union(_prepared(spark, sf))


def q_split_accounting(spark, sf):
    return PR.split_accounting(_prepared(spark, sf))


def q_sample_drift(spark, sf):
    return PR.sample_drift(_active(spark, sf), prep.sample_predicate(SAMPLED.sample_fraction, SAMPLED.sample_seed))


def q_user_split_shares(spark, sf):
    return PR.user_split_shares(_prepared(spark, sf))


# ---------------------------------------------------------------- the written study
def q_write_profile(spark, sf):
    """Rows and signals of each split table, counted by the tasks that write them."""
    with Run(spark) as run:
        return ST.write_study(_inter(spark, sf), CFG, f"{run.path}/splits", run)[1]  # nine rows at most, none of the files is read


def q_study_fit_data(spark, sf):
    """``fit_data`` from the written study."""
    return _fit_data(_study(spark, sf)[0].rows)


def q_study_ranking_eval(spark, sf):
    """``ranking_eval`` from the written study and written lists, both bucketed by user: they meet without a shuffle."""
    run = Run(spark)
    study, _ = ST.write_study(_inter(spark, sf), CFG, f"{run.path}/splits", run)
    lists = ST.write_lists(_own_lists(study.rows, study.by_user), CFG, f"{run.path}/lists", run)
    return E.summarize(ST.evaluate_lists(lists, _read_holdout(study.by_user)), keys=("split",))


# ---------------------------------------------------------------- profiles
def q_split_table_stats(spark, sf):
    return PR.split_table_stats(_prepared(spark, sf))


def q_signal_coverage(spark, sf):
    p = _prepared(spark, sf)
    return PR.tagged_coverage({"all": _inter(spark, sf), "sampled": p, "train": prep.train_of(p)})


def q_signal_breakdown(spark, sf):
    p = _prepared(spark, sf)
    return PR.signal_breakdown({"sampled": p, "train": prep.train_of(p)})


def q_rating_histogram(spark, sf):
    return PR.rating_histogram(_train(spark, sf))


def q_user_activity_stats(spark, sf):
    return PR.user_activity_stats(_train(spark, sf))


def q_history_size_check(spark, sf):
    return PR.size_check(_prepared(spark, sf), "history", CFG.history_size)


def q_holdout_size_check(spark, sf):
    return PR.size_check(_prepared(spark, sf), "holdout", CFG.holdout_size)


def q_split_user_overlap(spark, sf):
    return PR.split_user_overlap(_prepared(spark, sf))


def q_explicit_readiness(spark, sf):
    return PR.readiness(_prepared(spark, sf), F.col("rating") > 0)


def q_implicit_readiness(spark, sf):
    return PR.readiness(_prepared(spark, sf), F.col("is_read") == 1,
                        extra={"train_read_only": F.col("is_reviewed") == 0,
                               "train_read_reviewed": F.col("is_reviewed") == 1})


def q_dataset_summary(spark, sf):
    return PR.dataset_summary(_prepared(spark, sf))


# ---------------------------------------------------------------- signals
def q_explicit_matrix(spark, sf):
    return SG.explicit_matrix(_train(spark, sf))


def q_implicit_confidence(spark, sf):
    return SG.add_confidence(_train(spark, sf), CFG.alpha, CFG.beta)


def q_combined_confidence(spark, sf):
    return SG.build_combined_confidence(_train(spark, sf), CFG.alpha, CFG.beta, CFG.rating_weight)


def q_confidence_levels(spark, sf):
    return SG.confidence_levels(_train(spark, sf), CFG.alpha, CFG.beta, CFG.rating_weight)


def q_model_coverage(spark, sf):
    return SG.model_coverage(_train(spark, sf))


def _fit_data(p):
    out = None
    for split in ("tuning", "test"):
        part = (SG.build_combined_confidence(prep.fit_rows(p, split), CFG.alpha, CFG.beta, CFG.rating_weight)
                .select(F.lit(split).alias("fit"), "*"))
        out = part if out is None else out.unionByName(part)
    return out


def q_fit_data(spark, sf):
    return _fit_data(_prepared(spark, sf))


def q_initial_rating_weight(spark, sf):
    return SG.initial_rating_weight(_train(spark, sf), CFG.alpha)


# ---------------------------------------------------------------- popularity + evaluation
def _rounded_scores(df):
    return df.withColumn("avg_rating", r6(F.col("avg_rating"))).withColumn(
        "popularity_score", r6(F.col("popularity_score")))


def q_popularity_scores(spark, sf):
    return _rounded_scores(P.popularity_scores(_train(spark, sf)))


def q_popularity_topk(spark, sf):
    top = P.popularity_topk(_train(spark, sf), CFG.top_k)
    return _rounded_scores(top).select("rank", "book_id", "read_count", "avg_rating", "popularity_score")


def q_popularity_coverage(spark, sf):
    return P.popularity_coverage(_train(spark, sf))


def _per_user_out(per):
    return per.select("split", "user_id", "n_holdout", "n_hits", F.col("best_rank").cast("double").alias("best_rank"),
                      r6(F.col("ap")).alias("ap"), r6(F.col("ndcg")).alias("ndcg"))


def _popularity_users(p, holdout_rule=None):
    top = P.popularity_topk(prep.train_of(p), CFG.top_k).select("rank", "book_id")
    hold = _holdout_both(p)
    if holdout_rule is not None:
        hold = hold.where(holdout_rule)
    return E.evaluate_users(top, hold, keys=("split",))


def q_popularity_eval_users(spark, sf):
    return _per_user_out(_popularity_users(_prepared(spark, sf)))


def q_popularity_eval(spark, sf):
    return E.summarize(_popularity_users(_prepared(spark, sf)), keys=("split",))


def _own_list_users(spark, sf):
    """Per-user lists: each evaluated user's own history and holdout items by
    popularity, judged on the read holdout items."""
    p = _prepared(spark, sf)
    return E.evaluate_users(_own_lists(p, p), _read_holdout(p), keys=("split",))


def _own_lists(p, by_user):
    own = by_user.where(F.col("role").isin("history", "holdout"))
    return E.own_item_lists(P.popularity_scores(prep.train_of(p)), own, keys=("split",))


def _read_holdout(p):
    return _holdout_both(p).where(F.col("is_read") == 1)


def q_ranking_eval_users(spark, sf):
    return _per_user_out(_own_list_users(spark, sf))


def q_ranking_eval(spark, sf):
    return E.summarize(_own_list_users(spark, sf), keys=("split",))


def q_holdout_labels(spark, sf):
    return (_holdout_both(_prepared(spark, sf)).groupBy("split", "user_id")
            .agg(F.count(F.lit(1)).alias("n_holdout")))


def q_metrics_long(spark, sf):
    return E.metrics_long(q_popularity_eval(spark, sf))


def _variant_table(spark, sf):
    """Metrics of the three score variants from one aggregate of train."""
    p = _prepared(spark, sf)
    lists = P.variant_topk(prep.train_of(p), CFG.top_k)
    hold = _holdout_both(p).withColumn("variant", F.explode(F.array(*[F.lit(v) for v in P.VARIANTS])))
    joined = hold.join(lists, ["variant", "book_id"], "left").groupBy("variant", "split", "user_id").agg(
        F.count(F.lit(1)).alias("n_holdout"), F.count("rank").alias("n_hits"), F.min("rank").alias("best_rank"))
    return E.summarize(E.with_metrics(joined), keys=("variant", "split"))


def q_best_config(spark, sf):
    return E.best_config(_variant_table(spark, sf), "variant").select("variant", "map", "ndcg")


def q_model_comparison(spark, sf):
    return E.model_comparison(_variant_table(spark, sf), "variant", baseline="product")


def q_stability_gap(spark, sf):
    return E.stability_gap(_variant_table(spark, sf), "variant")


# ---------------------------------------------------------------- segments
def _reader_pairs(spark, sf):
    return SEG.reader_pairs(fx_readers(spark, sf))


def _qualified(spark, sf):
    pairs = _reader_pairs(spark, sf)
    counts = SEG.qualified_items(pairs, CFG.min_readers)
    return pairs.join(counts.select("book_id"), "book_id", "left_semi"), counts


def _lsh(spark, sf, run):
    return SEG.lsh_pairs(fx_readers(spark, sf), CFG.min_readers, CFG.num_hash_tables, CFG.minhash_seed,
                         CFG.jaccard_distance, run=run)


def q_reader_pairs(spark, sf):
    return _reader_pairs(spark, sf)


def q_qualified_items(spark, sf):
    return _qualified(spark, sf)[1]


def q_reader_sets(spark, sf):
    qp, counts = _qualified(spark, sf)
    return (SEG.reader_sets(qp, counts, CFG.reader_chunk)
            .select("book_id", "chunk", "n_tokens", F.array_join("user_tokens", " ").alias("user_tokens")))


def q_reader_vectors(spark, sf):
    """Sparse reader vectors over a vocabulary that is numbered where it lies."""
    qp, _ = _qualified(spark, sf)
    return (SIM.reader_vectors(qp, Run(spark), CFG.vector_span)
            .select("book_id", "chunk", "n_tokens", F.array_join(F.col("indices").cast("array<string>"), " ").alias("indices")))


def q_minhash_signatures(spark, sf):
    qp, _ = _qualified(spark, sf)
    return SEG.minhash_signatures(qp, CFG.num_hash_tables, CFG.minhash_seed)


def q_lsh_candidates(spark, sf):
    """Every pair that shares a signature (the verifier of ``lsh_pairs`` sees
    those of them whose reader counts can reach the threshold)."""
    qp, _ = _qualified(spark, sf)
    return SEG.lsh_candidates(SEG.minhash_signatures(qp, CFG.num_hash_tables, CFG.minhash_seed))


def q_lsh_buckets(spark, sf):
    qp, _ = _qualified(spark, sf)
    return SEG.lsh_buckets(SEG.minhash_signatures(qp, CFG.num_hash_tables, CFG.minhash_seed))


def q_lsh_pairs(spark, sf):
    return _lsh(spark, sf, Run(spark))  # the result reads from it: it goes with the application


def q_jaccard_pairs(spark, sf):
    """Every pair under the distance, by the prefix index."""
    return SIM.jaccard_pairs(fx_readers(spark, sf), CFG.min_readers, CFG.jaccard_distance, Run(spark))


def q_lsh_reduction(spark, sf):
    """Size of the hashed result, and its recall on a hash-chosen set of items."""
    with Run(spark) as run:
        qp, counts = (run.keep(df, name) for df, name in zip(_qualified(spark, sf), ("pairs", "counts")))
        found = run.keep(_lsh(spark, sf, run), "found")
        out = SEG.with_recall(SEG.lsh_reduction(counts, found),
                              SIM.recall_estimate(found, qp, counts, CFG.jaccard_distance, CFG.recall_fraction, CFG.minhash_seed, run))
        return spark.createDataFrame(out.collect(), out.schema)  # one row


def _top_similar(spark, sf):
    """The exact top pairs (k rows); nothing of the search stays on disk."""
    with Run(spark) as run:
        return SIM.topk_pairs(fx_readers(spark, sf), CFG.min_readers, CFG.jaccard_distance, CFG.top_k, run)[0]


def q_segment_topk(spark, sf):
    return SEG.segment_topk(_top_similar(spark, sf), fx_item_map(spark, sf), CFG.top_k)


def q_segment_topk_work(spark, sf):
    with Run(spark) as run:
        out = SIM.topk_work(fx_readers(spark, sf), CFG.min_readers, CFG.jaccard_distance, CFG.top_k, run)
        return spark.createDataFrame(out.collect(), out.schema)  # one row


def q_similarity_bands(spark, sf):
    return SEG.similarity_bands(SEG.top_pairs(_top_similar(spark, sf), CFG.top_k))


# ---------------------------------------------------------------- ALS (rows-only checks)
def _rank(kind):
    return CFG.als_explicit_rank if kind == "explicit" else CFG.als_rank


def _recs(spark, sf, kind):
    run = Run(spark)  # the result reads from it: it goes with the application
    p = _written(spark, sf, run)
    fit_df = als.matrix(prep.fit_rows(p, "tuning"), kind, CFG.alpha, CFG.beta, CFG.rating_weight)
    model = als.fit(spark, fit_df, kind, _rank(kind), CFG.als_reg, CFG.als_iter, CFG.als_seed,
                    CFG.checkpoint_interval, CFG.als_blocks)
    users = prep.holdout_of(p, "tuning").where(als.holdout_rule(kind))
    return als.recommend(model, users, CFG.top_k, run)


def q_als_explicit_recs(spark, sf):
    return _recs(spark, sf, "explicit")


def q_als_implicit_recs(spark, sf):
    return _recs(spark, sf, "implicit")


def q_als_combined_recs(spark, sf):
    return _recs(spark, sf, "combined")


def q_als_explicit_rmse(spark, sf):
    run = Run(spark)  # the result reads from it: it goes with the application
    p = _written(spark, sf, run)
    fit_df = als.matrix(prep.fit_rows(p, "tuning"), "explicit", CFG.alpha, CFG.beta, CFG.rating_weight)
    model = als.fit(spark, fit_df, "explicit", _rank("explicit"), CFG.als_reg, CFG.als_iter, CFG.als_seed,
                    CFG.checkpoint_interval, CFG.als_blocks)
    return als.rmse(model, prep.holdout_of(p, "tuning"))


def q_als_explicit_eval(spark, sf):
    return _protocol(spark, sf, "explicit", with_rmse=True)


def q_als_implicit_eval(spark, sf):
    return _protocol(spark, sf, "implicit")


def q_als_combined_eval(spark, sf):
    return _protocol(spark, sf, "combined")


def q_als_implicit_eval_unseen(spark, sf):
    """Quirk option Q10: lists without already-seen items (exact)."""
    return _protocol(spark, sf, "implicit", exclude_seen=True)


def q_als_combined_eval_offset(spark, sf):
    """Quirk option Q9: MLlib receives c - 1 so the fitted weight is exactly c."""
    return _protocol(spark, sf, "combined", confidence_offset=-1.0)


def q_als_explicit_tune(spark, sf):
    return _grid(spark, sf, T.explicit_grid)


def q_als_implicit_tune(spark, sf):
    return _grid(spark, sf, T.implicit_grid)


def q_als_combined_tune(spark, sf):
    return _grid(spark, sf, T.combined_grid)


def q_als_model_roundtrip(spark, sf):
    """Fit, save to the shared folder, load back and recommend from the loaded model."""
    run = Run(spark)  # the result reads from it: it goes with the application
    p = _written(spark, sf, run)
    fit_df = als.matrix(prep.fit_rows(p, "tuning"), "combined", CFG.alpha, CFG.beta, CFG.rating_weight)
    model = als.fit(spark, fit_df, "combined", CFG.als_rank, CFG.als_reg, CFG.als_iter, CFG.als_seed,
                    CFG.checkpoint_interval, CFG.als_blocks)
    path = f"{run.path}/als-model"
    als.save_model(model, path)
    loaded = als.load_model(path)
    return als.recommend(loaded, prep.holdout_of(p, "tuning"), CFG.top_k, run)


def _als_facts(spark, sf, kind):
    """What holds of a fitted model whatever its factors are, as (metric, value)."""
    run = Run(spark)  # the result reads from it: it goes with the application
    p = _written(spark, sf, run)
    fit_df = als.matrix(prep.fit_rows(p, "tuning"), kind, CFG.alpha, CFG.beta, CFG.rating_weight)
    model = als.fit(spark, fit_df, kind, _rank(kind), CFG.als_reg, CFG.als_iter, CFG.als_seed,
                    CFG.checkpoint_interval, CFG.als_blocks)
    path = f"{run.path}/als-model"
    als.save_model(model, path)
    holdout = prep.holdout_of(p, "tuning").where(als.holdout_rule(kind))
    recs = als.recommend(model, holdout, CFG.top_k, run)
    loaded = als.recommend(als.load_model(path), holdout, CFG.top_k, run)
    lists = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"),
                                        F.countDistinct("book_id").alias("items"))
    per = lists.agg(F.count(F.lit(1)).alias("eval_users"), F.min("n").alias("shortest_list"), F.max("n").alias("longest_list"),
                    F.count_if((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("items") != F.col("n"))).alias("broken_lists"))
    names = per.columns
    out = per.selectExpr(f"stack({len(names)}, " + ", ".join(f"'{n}', CAST({n} AS BIGINT)" for n in names) + ") AS (metric, value)")

    def count(name, df):
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(F.lit(name).alias("metric"), "value")

    same = ["user_id", "rank", "book_id", "score"]
    out = out.unionByName(count("items_outside_fit", recs.join(fit_df.select("book_id").distinct(), "book_id", "left_anti")))
    out = out.unionByName(count("rows_changed_by_save", recs.select(*same).exceptAll(loaded.select(*same))))
    if kind == "explicit":
        out = out.unionByName(als.rmse(model, holdout).select(F.lit("scored_rows").alias("metric"), F.col("n_scored").alias("value")))
    return out


def q_als_explicit_facts(spark, sf):
    return _als_facts(spark, sf, "explicit")


def q_als_implicit_facts(spark, sf):
    return _als_facts(spark, sf, "implicit")


def q_als_combined_facts(spark, sf):
    return _als_facts(spark, sf, "combined")


def _model_table(spark, sf):
    """Metric rows of popularity and the three ALS models on both splits."""
    with Run(spark) as run:
        p = _written(spark, sf, run)
        out = E.summarize(_popularity_users(p), keys=("split",)).select(F.lit("popularity").alias("model"), "split", "map", "ndcg")
        out = spark.createDataFrame(out.collect(), out.schema)  # a row for each split
        for kind in als.KINDS:
            out = out.unionByName(als.two_model_protocol(spark, p, kind, CFG).select(F.lit(kind).alias("model"), "split", "map", "ndcg"))
    return out


def q_als_model_comparison(spark, sf):
    """Every model against popularity, explicit and implicit ALS on the test split."""
    return E.model_comparison(_model_table(spark, sf), "model", ["popularity", "explicit", "implicit"])


def q_als_stability_gap(spark, sf):
    return E.stability_gap(_model_table(spark, sf), "model")


def q_als_best_configs(spark, sf):
    """Best row of each tuning table: least RMSE (explicit), greatest MAP (others)."""
    out = None
    with Run(spark) as run:
        p, models = _written(spark, sf, run), FitRegistry(spark, f"{run.path}/models")
        for kind, grid, metric, most in (("explicit", T.explicit_grid, "rmse", False), ("implicit", T.implicit_grid, "map", True),
                                         ("combined", T.combined_grid, "map", True)):
            best = E.best_config(grid(spark, p, CFG, registry=models), ["rank", "reg", "alpha", "beta", "rating_weight"], metric, None, most)
            best = best.select(F.lit(kind).alias("kind"), "*")
            out = best if out is None else out.unionByName(best)
    return out


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
