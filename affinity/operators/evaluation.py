"""One ranking evaluator for every recommender.

Input recommendations are either per user ``(user_id, rank, book_id)`` or one
global list ``(rank, book_id)`` given to every user (the popularity
baseline).  A global list is joined to the holdout by item only, so no
users × list product is ever built.

Per user: best (lowest) rank among holdout items, number of holdout items and
of hits.  "MAP" = 1/best_rank, "NDCG" = 1/log2(best_rank + 1), 0 without a
hit.  Popularity counts item hits; ALS counts users with a hit — both are
reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.metrics import best_hit_ndcg, r6, reciprocal_rank


def ranked_from_arrays(recs: DataFrame, array_col: str = "recommendations", item_field: str = "book_id") -> DataFrame:
    """``(user_id, array<struct<item, score>>)`` -> ``(user_id, rank, book_id, score)``
    with a 1-based rank from the array position (``posexplode``)."""
    return (recs.select("user_id", F.posexplode(array_col).alias("_pos", "_rec"))
            .select("user_id", (F.col("_pos") + 1).cast("int").alias("rank"),
                    F.col(f"_rec.{item_field}").cast("int").alias("book_id"),
                    F.col("_rec.rating").cast("double").alias("score")))


def best_ranks(recs: DataFrame, holdout: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per (keys…, user): ``n_holdout, n_hits, best_rank`` (null without a hit).

    ``keys`` are extra grouping columns present in both inputs (e.g. ``split``)."""
    hold = holdout.select(*keys, "user_id", F.col("book_id").cast("int").alias("book_id"))
    if "user_id" not in recs.columns:
        # Global list: usually k rows, which Spark broadcasts by their measured size.
        top = recs.select(F.col("book_id").cast("int").alias("book_id"), "rank")
        joined = hold.join(top, "book_id", "left")
        return (joined.groupBy(*keys, "user_id")
                .agg(F.count(F.lit(1)).alias("n_holdout"), F.count("rank").alias("n_hits"),
                     F.min("rank").alias("best_rank")))
    # Per-user lists hold each item once: one left join of the holdout to the
    # lists on (user, item), then one aggregate (users without hits stay, 0).
    ranked = recs.select(*keys, "user_id", F.col("book_id").cast("int").alias("book_id"), "rank")
    return (hold.join(ranked, [*keys, "user_id", "book_id"], "left")
            .groupBy(*keys, "user_id")
            .agg(F.count(F.lit(1)).alias("n_holdout"), F.count("rank").alias("n_hits"),
                 F.min("rank").alias("best_rank")))


def evaluate_users(recs: DataFrame, holdout: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per-user metrics: ``best_rank, n_holdout, n_hits, ap, ndcg``."""
    return with_metrics(best_ranks(recs, holdout, keys))


def with_metrics(per: DataFrame) -> DataFrame:
    """Add ``ap`` and ``ndcg`` of ``best_rank``."""
    return (per.withColumn("ap", reciprocal_rank(F.col("best_rank")))
               .withColumn("ndcg", best_hit_ndcg(F.col("best_rank"))))


def summarize(per_user: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Means and hit counts (one aggregate; null-safe means)."""
    agg = per_user.groupBy(*keys).agg(
        F.coalesce(F.avg("ap"), F.lit(0.0)).alias("_map"),
        F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("_ndcg"),
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(F.col("best_rank").isNotNull()).alias("n_user_hits"),
        F.coalesce(F.sum("n_hits"), F.lit(0)).cast("bigint").alias("n_item_hits"),
    )
    return agg.select(*keys, r6(F.col("_map")).alias("map"), r6(F.col("_ndcg")).alias("ndcg"),
                      "n_users", "n_user_hits", "n_item_hits",
                      r6(F.col("n_user_hits") / F.nullif(F.col("n_users"), F.lit(0))).alias("user_hit_rate"),
                      r6(F.col("n_item_hits") / F.nullif(F.col("n_users"), F.lit(0))).alias("item_hit_rate"))


def evaluate(recs: DataFrame, holdout: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return summarize(evaluate_users(recs, holdout, keys), keys)


def metrics_long(summary: DataFrame, key: str = "split") -> DataFrame:
    """Typed long form ``(metric, value double)`` of a summary table:
    ``<key>_<name>`` per metric (the study's metric CSV, without strings)."""
    names = ["map", "ndcg", "n_users", "n_user_hits", "n_item_hits", "user_hit_rate", "item_hit_rate"]
    pairs = ", ".join(f"concat({key}, '_{n}'), CAST({n} AS DOUBLE)" for n in names)
    return summary.selectExpr(f"stack({len(names)}, {pairs}) as (metric, value)")


def best_config(table: DataFrame, config_col: str | list[str], metric: str = "map", split: str | None = "tuning",
                maximize: bool = True) -> DataFrame:
    """Row of the best configuration (argmax / argmin of ``metric``), ties by
    the configuration's columns."""
    t = table if split is None else table.where(F.col("split") == split)
    order = F.col(metric).desc() if maximize else F.col(metric).asc()
    names = [config_col] if isinstance(config_col, str) else config_col
    return t.orderBy(order, *[F.col(c).asc() for c in names]).limit(1)


def model_comparison(table: DataFrame, config_col: str, baseline: str | list[str], split: str = "test") -> DataFrame:
    """Per configuration: map / ndcg and % lift over the baseline's row (from a
    window over the small metric table); several baselines get columns each."""
    t = table.where(F.col("split") == split).select(config_col, "map", "ndcg")
    everything = Window.partitionBy()

    def lift(metric, name):
        base = F.max(F.when(F.col(config_col) == name, F.col(metric))).over(everything)
        return r6(F.lit(100.0) * (F.col(metric) / F.nullif(base, F.lit(0.0)) - 1))

    if isinstance(baseline, str):
        lifts = [lift(m, baseline).alias(f"{m}_lift_pct") for m in ("map", "ndcg")]
    else:
        lifts = [lift(m, b).alias(f"{m}_lift_vs_{b}_pct") for b in baseline for m in ("map", "ndcg")]
    return t.select(config_col, "map", "ndcg", *lifts)


def stability_gap(table: DataFrame, config_col: str) -> DataFrame:
    """metric(test) - metric(tuning) per configuration (conditional pivot)."""
    def on(split, m):
        return F.max(F.when(F.col("split") == split, F.col(m)))
    return (table.groupBy(config_col)
            .agg(on("tuning", "map").alias("map_tuning"), on("test", "map").alias("map_test"),
                 on("tuning", "ndcg").alias("ndcg_tuning"), on("test", "ndcg").alias("ndcg_test"))
            .withColumn("map_gap", r6(F.col("map_test") - F.col("map_tuning")))
            .withColumn("ndcg_gap", r6(F.col("ndcg_test") - F.col("ndcg_tuning"))))


def own_item_lists(scores: DataFrame, rows: DataFrame, keys: tuple[str, ...] = (), score_col: str = "popularity_score") -> DataFrame:
    """Per-user lists ``(keys…, user_id, rank, book_id)``: each user's own items
    by score, highest first, ties by item.  Equi-join on the item only; items
    without a score are not listed."""
    order = Window.partitionBy(*keys, "user_id").orderBy(F.round(F.col(score_col), 9).desc(), F.col("book_id"))
    listed = rows.select(*keys, "user_id", "book_id").join(scores.select("book_id", score_col), "book_id")
    return listed.select(*keys, "user_id", F.row_number().over(order).alias("rank"), "book_id")
