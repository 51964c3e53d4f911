"""The study's batch jobs, composed from the operators.

Each job reads what the previous one wrote (Parquet under ``base``), like the
study's scripts, and writes small results as single CSV files:

    preprocess   interactions CSV -> Parquet -> split table (split, role partitions)
    analyze      profiles / checks of the split table
    popularity   top-k list + evaluation metrics
    segments     MinHash-LSH similar pairs + top-k pairs with external ids
    als_tune     tuning grid for one model kind
    als_final    two-model protocol for one model kind, models saved

Command line: ``python -m affinity.jobs <job> --base DIR [...]``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.config import PUBLISHED, Config
from affinity.operators import als, evaluation as E, popularity as P, prep, profile as PR
from affinity.operators import segments as SEG, similar as SIM, study as ST, tuning as T
from affinity.session import persisted
from affinity.sources import read_item_map_csv, write_parquet, write_small_csv
from affinity.sources.scratch import Run
from affinity.sources.tables import ingest_interactions_csv, ingest_report

SPLITS_DIR = "splits"
RESULTS_DIR = "results"
PROFILE = "write_profile"


def _p(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def splits(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(_p(base, SPLITS_DIR))


def preprocess(spark: SparkSession, interactions_csv: str, base: str, cfg: Config = PUBLISHED) -> DataFrame:
    """CSV -> Parquet, lines that can't be taken to a reject table beside it,
    then the split table, bucketed by user.  The reports by table come from the
    counters of that write.  Returns the dataset summary of what was written."""
    raw_path, reject_path = _p(base, "interactions_raw.parquet"), _p(base, "interactions_rejects.parquet")
    rows, rejects = ingest_interactions_csv(spark, interactions_csv)
    write_parquet(rows, raw_path)
    write_parquet(rejects, reject_path)
    write_small_csv(ingest_report(spark.read.parquet(raw_path), spark.read.parquet(reject_path)),
                    _p(base, RESULTS_DIR, "ingest_report"))
    with Run(spark) as run:
        _, profile = ST.write_study(spark.read.parquet(raw_path), cfg, _p(base, SPLITS_DIR), run)
    write_small_csv(profile, _p(base, RESULTS_DIR, PROFILE))
    summary = PR.dataset_summary(splits(spark, base))
    write_small_csv(summary, _p(base, RESULTS_DIR, "preprocess_summary"))
    return summary


def analyze(spark: SparkSession, base: str, cfg: Config = PUBLISHED) -> dict[str, DataFrame]:
    """Profiles and checks of the split table, one small CSV each; those of
    rows by table come from the counters of its write and scan nothing."""
    p = splits(spark, base)
    profile = spark.read.option("header", True).schema(ST.PROFILE_SCHEMA).csv(_p(base, RESULTS_DIR, PROFILE))
    train = prep.train_of(p)
    out = {
        "split_table_stats": PR.split_table_stats(p),
        "user_split_shares": PR.user_split_shares(p),
        "split_user_overlap": PR.split_user_overlap(p),
        "user_activity_stats": PR.user_activity_stats(train),
        "signal_coverage": ST.coverage(profile, "sampled").unionByName(ST.coverage(profile, "train", F.col("role") == "train")),
        "split_accounting": ST.accounting(profile),
        "model_coverage": ST.model_coverage(profile),
        "initial_rating_weight": ST.initial_rating_weight(profile, cfg.alpha),
        "rating_histogram": PR.rating_histogram(train),
        "signal_breakdown": PR.signal_breakdown({"train": train}),
        "history_size_check": PR.size_check(p, "history", cfg.history_size),
        "holdout_size_check": PR.size_check(p, "holdout", cfg.holdout_size),
        "explicit_readiness": PR.readiness(p, F.col("rating") > 0),
        "implicit_readiness": PR.readiness(p, F.col("is_read") == 1),
        "dataset_summary": PR.dataset_summary(p),
    }
    for name, df in out.items():
        write_small_csv(df, _p(base, RESULTS_DIR, "analysis", name))
    return out


def popularity(spark: SparkSession, base: str, cfg: Config = PUBLISHED) -> DataFrame:
    """Top-k list from train, evaluated on both holdouts; metrics in long form."""
    p = splits(spark, base)
    hold = p.where(F.col("role") == "holdout").select("split", *prep.INTERACTION_COLS)
    path = _p(base, RESULTS_DIR, "popularity_baseline")
    with persisted(P.popularity_topk(prep.train_of(p), cfg.top_k)) as top:  # k rows, for the list and its evaluation
        write_small_csv(top.select("rank", "book_id", "read_count", "avg_rating", "popularity_score"),
                        _p(base, RESULTS_DIR, "popularity_top"))
        metrics = E.metrics_long(E.evaluate(top.select("rank", "book_id"), hold, keys=("split",)))
        write_small_csv(metrics, path)
    return spark.read.option("header", True).schema(metrics.schema).csv(path)


def segments(spark: SparkSession, base: str, item_map_csv: str | None = None, cfg: Config = PUBLISHED) -> DataFrame:
    """Similar item pairs of the train readers: the hashed pairs with their size
    and recall, and the exact top-k (with external ids when a map is given)."""
    train = prep.train_of(splits(spark, base))
    found_path = _p(base, "segments", "similar_pairs.parquet")
    write_parquet(SEG.lsh_pairs(train, cfg.min_readers, cfg.num_hash_tables, cfg.minhash_seed,
                                cfg.jaccard_distance), found_path)
    found = spark.read.parquet(found_path)
    pairs = SEG.reader_pairs(train)
    counts = SEG.qualified_items(pairs, cfg.min_readers)
    with Run(spark) as run:
        qp = pairs.join(counts.select("book_id"), "book_id", "left_semi")
        recall = SIM.recall_estimate(found, qp, counts, cfg.jaccard_distance, cfg.recall_fraction, cfg.minhash_seed, run)
        write_small_csv(SEG.with_recall(SEG.lsh_reduction(counts, found), recall), _p(base, RESULTS_DIR, "segments_reduction"))
        best, _ = SIM.topk_pairs(train, cfg.min_readers, cfg.jaccard_distance, cfg.top_k, run)
    if item_map_csv:
        top = SEG.segment_topk(best, read_item_map_csv(spark, item_map_csv), cfg.top_k)
    else:
        top = SEG.top_pairs(best, cfg.top_k)
    write_small_csv(top, _p(base, RESULTS_DIR, "segments_top"))
    return top


def als_tune(spark: SparkSession, base: str, kind: str, cfg: Config = PUBLISHED) -> DataFrame:
    grid = {"explicit": T.explicit_grid, "implicit": T.implicit_grid, "combined": T.combined_grid}[kind]
    table = grid(spark, splits(spark, base), cfg)
    write_small_csv(table, _p(base, RESULTS_DIR, f"als_{kind}_tuning"))
    return table


def als_final(spark: SparkSession, base: str, kind: str, cfg: Config = PUBLISHED) -> DataFrame:
    """Two-model protocol; both models saved under ``base/models``."""
    p = splits(spark, base)

    def one(split):
        model, r = als.run_split(spark, p, kind, split, cfg)
        als.save_model(model, _p(base, "models", f"als_{kind}_model_{split}"))
        return r

    rows = [r for part in als.run_parallel([lambda s=s: one(s) for s in ("tuning", "test")], 2) for r in part]
    cols = [c.split()[0] for c in als.EVAL_SCHEMA.split(", ")]
    table = spark.createDataFrame([tuple(r.asDict().get(c) for c in cols) for r in rows], als.EVAL_SCHEMA)
    write_small_csv(table, _p(base, RESULTS_DIR, f"als_{kind}_final"))
    return table


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="affinity.jobs")
    ap.add_argument("job", choices=["preprocess", "analyze", "popularity", "segments", "als_tune", "als_final"])
    ap.add_argument("--base", required=True, help="output root (shared storage)")
    ap.add_argument("--input", help="interactions CSV (preprocess)")
    ap.add_argument("--item-map", help="item-id map CSV (segments)")
    ap.add_argument("--kind", choices=list(als.KINDS), help="ALS model kind")
    args = ap.parse_args(argv)
    if args.job == "preprocess" and not args.input:
        ap.error("preprocess needs --input")
    if args.job in ("als_tune", "als_final") and not args.kind:
        ap.error(f"{args.job} needs --kind")
    spark = SparkSession.builder.appName(f"affinity-{args.job}").getOrCreate()
    if args.job == "preprocess":
        preprocess(spark, args.input, args.base)
    elif args.job == "analyze":
        analyze(spark, args.base)
    elif args.job == "popularity":
        popularity(spark, args.base)
    elif args.job == "segments":
        segments(spark, args.base, args.item_map)
    elif args.job == "als_tune":
        als_tune(spark, args.base, args.kind)
    else:
        als_final(spark, args.base, args.kind)


if __name__ == "__main__":
    main()
