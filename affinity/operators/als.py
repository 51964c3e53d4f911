"""ALS recommenders (explicit, implicit, combined confidence) on MLlib.

The solver is MLlib's; this module builds the training matrices, fixes the
reproducibility knobs (seed, checkpointing into the shared folder), produces
top-k lists for the evaluated users only, and runs the study's two-model
protocol: fit(train + tuning history) -> tuning holdout, fit(train + test
history) -> test holdout.

Top-k scoring is ``topk_product``: items in blocks by falling norm, each user
scored only against the blocks that can still reach their list.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from affinity.config import Config
from affinity.functions.metrics import r6
from affinity.operators import evaluation as E
from affinity.operators import prep
from affinity.operators import signals as SG
from affinity.operators.registry import FitRegistry
from affinity.operators.topk_product import top_products
from affinity.session import checkpoint_dir, free_shuffles, persisted, shuffles_freed
from affinity.sources.scratch import Run

KINDS = ("explicit", "implicit", "combined")


def matrix(rows: DataFrame, kind: str, alpha: float, beta: float, w: float,
           confidence_offset: float = 0.0) -> DataFrame:
    """Training matrix ``(user_id, book_id, value)`` for a model kind.

    MLlib weights an implicit entry as ``1 + alpha_als * value`` (alpha_als = 1
    by default), so a confidence that already holds the "1 +" is shifted by
    one.  The study keeps that (default offset 0); ``confidence_offset=-1``
    hands MLlib ``c - 1`` so the fitted weight is exactly ``c``."""
    if kind == "explicit":
        return SG.explicit_matrix(rows).select("user_id", "book_id", F.col("rating").cast("float").alias("value"))
    if kind == "implicit":
        conf = SG.add_confidence(rows, alpha, beta)
    elif kind == "combined":
        conf = SG.build_combined_confidence(rows, alpha, beta, w)
    else:
        raise ValueError(kind)
    value = F.col("confidence").cast("float") + F.lit(float(confidence_offset)).cast("float")
    return conf.select("user_id", "book_id", value.cast("float").alias("value"))


def holdout_rule(kind: str):
    """Holdout rows each model is judged on (the study differs per model)."""
    return {"explicit": F.col("rating") > 0, "implicit": F.col("is_read") == 1, "combined": F.lit(True)}[kind]


def estimator(kind: str, rank: int, reg: float, max_iter: int, seed: int, checkpoint_interval: int = 2,
              blocks: int = 10) -> ALS:
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol="user_id", itemCol="book_id",
               ratingCol="value", implicitPrefs=(kind != "explicit"), coldStartStrategy="drop",
               nonnegative=False, checkpointInterval=checkpoint_interval, seed=seed,
               numUserBlocks=blocks, numItemBlocks=blocks)


def fit(spark, train_matrix: DataFrame, kind: str, rank: int, reg: float, max_iter: int, seed: int,
        checkpoint_interval: int = 2, blocks: int = 10) -> ALSModel:
    checkpoint_dir(spark)  # lineage cuts go to the shared folder
    with shuffles_freed(spark):  # MLlib removes at most one of an implicit fit's four shuffles between checkpoints
        return estimator(kind, rank, reg, max_iter, seed, checkpoint_interval, blocks).fit(train_matrix)


def settled(model: ALSModel, run: Run) -> ALSModel:
    """The model written to ``run`` and read back.  The fitted one holds its cached
    factors and the shuffles since the last checkpoint; these go once nothing refers to it."""
    path = f"{run.path}/model-{uuid.uuid4().hex}"
    save_model(model, path)
    return load_model(path)


def _factors(model: ALSModel, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    wanted = users.select("user_id").distinct()
    return (model.userFactors.select(F.col("id").alias("user_id"), "features").join(wanted, "user_id", "left_semi"),
            model.itemFactors.select(F.col("id").alias("book_id"), "features"))


def recommend(model: ALSModel, users: DataFrame, k: int, run: Run | None = None) -> DataFrame:
    """Top-k per user of ``users`` as ``(user_id, rank, book_id, score)``, ties by
    item; users the model does not know have none.  Intermediates belong to
    ``run`` (its own, to the end of the application, if none is given)."""
    return top_products(*_factors(model, users), k, run or Run(users.sparkSession))[0]


def recommend_unseen(model: ALSModel, users: DataFrame, seen: DataFrame, k: int, run: Run | None = None) -> DataFrame:
    """Top-k per user among items the user has not seen (the study keeps seen
    items; this is the optional fix).  Seen items are left out while scoring, so
    lists hold k items at most however much a user has seen."""
    return top_products(*_factors(model, users), k, run or Run(users.sparkSession), seen)[0]


def rmse(model: ALSModel, holdout: DataFrame) -> DataFrame:
    """RMSE over rated holdout rows the model can score (unknown ids dropped)."""
    pred = (model.transform(holdout.where(F.col("rating") > 0).select("user_id", "book_id", "rating"))
            .where(F.col("prediction").isNotNull() & ~F.isnan("prediction")))
    return pred.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2))).alias("rmse"),
                    F.count(F.lit(1)).alias("n_scored"))


def evaluate_model(model: ALSModel, holdout: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """Summary row of the ranking metrics for one fitted model (``seen``:
    optionally drop already-seen items from the lists, exactly)."""
    spark = holdout.sparkSession
    with Run(spark) as run:
        recs = recommend(model, holdout, k, run) if seen is None else recommend_unseen(model, holdout, seen, k, run)
        out = E.evaluate(recs, holdout)
        return spark.createDataFrame(out.collect(), out.schema)  # one metric row


def fit_matrix(prepared: DataFrame, kind: str, split: str, alpha: float, beta: float, w: float,
               confidence_offset: float = 0.0) -> DataFrame:
    """Training matrix of the model for ``split``: train + that split's history."""
    return matrix(prep.fit_rows(prepared, split), kind, alpha, beta, w, confidence_offset)


def run_split(spark, prepared: DataFrame, kind: str, split: str, cfg: Config, rank: int | None = None,
              reg: float | None = None, max_iter: int | None = None, alpha: float | None = None,
              beta: float | None = None, w: float | None = None, with_rmse: bool | None = None,
              exclude_seen: bool = False, fit_df: DataFrame | None = None, confidence_offset: float = 0.0,
              registry: FitRegistry | None = None, run: Run | None = None):
    """Fit on train + ``split`` history and evaluate on ``split`` holdout.
    Returns ``(model, summary DataFrame)``; the summary is one row.  With a
    ``registry`` the same configuration and matrix is fitted once; with a ``run``
    the model is held by its files, to the run's end, while it is evaluated."""
    rank = rank or (cfg.als_explicit_rank if kind == "explicit" else cfg.als_rank)
    reg = cfg.als_reg if reg is None else reg
    max_iter = max_iter or cfg.als_iter
    alpha = cfg.alpha if alpha is None else alpha
    beta = cfg.beta if beta is None else beta
    w = cfg.rating_weight if w is None else w
    if fit_df is None:  # build and cache this point's matrix for the fit's many passes
        with persisted(fit_matrix(prepared, kind, split, alpha, beta, w, confidence_offset)) as cached:
            return run_split(spark, prepared, kind, split, cfg, rank, reg, max_iter, alpha, beta, w,
                             with_rmse, exclude_seen, cached, confidence_offset, registry, run)

    def fitted():
        model = fit(spark, fit_df, kind, rank, reg, max_iter, cfg.als_seed, cfg.checkpoint_interval, cfg.als_blocks)
        return model if run is None else settled(model, run)

    model = fitted() if registry is None else registry.model(
        {"kind": kind, "rank": rank, "reg": float(reg), "iterations": max_iter, "seed": cfg.als_seed, "blocks": cfg.als_blocks},
        fit_df, fitted)
    if registry is not None or run is not None:
        free_shuffles(spark)  # those of the fit, which is not referred to any more
    holdout = prep.holdout_of(prepared, split).where(holdout_rule(kind))
    seen = prep.fit_rows(prepared, split) if exclude_seen else None
    summary = evaluate_model(model, holdout, cfg.top_k, seen).select(F.lit(split).alias("split"), "*")
    row = {"kind": kind, "rank": rank, "reg": float(reg), "max_iter": max_iter,
           "alpha": None if kind == "explicit" else float(alpha),
           "beta": None if kind == "explicit" else float(beta),
           "rating_weight": float(w) if kind == "combined" else None}
    row.update(summary.collect()[0].asDict())  # one metric row
    if with_rmse if with_rmse is not None else kind == "explicit":
        row["rmse"] = rmse(model, holdout).select(r6(F.col("rmse")).alias("rmse")).collect()[0]["rmse"]
    return model, [Row(**row)]


EVAL_SCHEMA = ("kind string, rank int, reg double, max_iter int, alpha double, beta double, rating_weight double, "
               "split string, map double, ndcg double, n_users bigint, n_user_hits bigint, n_item_hits bigint, "
               "user_hit_rate double, item_hit_rate double, rmse double")


def run_parallel(tasks, parallelism: int):
    """Run independent fits concurrently (like ``TrainValidationSplit``'s
    ``parallelism``): each task submits its own Spark jobs from a thread."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        return list(pool.map(lambda t: t(), tasks))


def two_model_protocol(spark, prepared: DataFrame, kind: str, cfg: Config, parallelism: int = 2,
                       **params) -> DataFrame:
    """The study's final evaluation: one model per evaluation split, one row
    per split with the configuration it ran.  The two fits are independent
    and run concurrently."""
    with Run(spark) as run, shuffles_freed(spark):
        tasks = [lambda s=split: run_split(spark, prepared, kind, s, cfg, run=run, **params)[1] for split in ("tuning", "test")]
        rows = [r for part in run_parallel(tasks, parallelism) for r in part]
    cols = [c.split()[0] for c in EVAL_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.asDict().get(c) for c in cols) for r in rows], EVAL_SCHEMA)


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
