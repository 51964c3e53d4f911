"""Activity filter, user sample, user split and per-user roles.

Output of ``prepare``: one table ``(user_id, book_id, is_read, rating,
is_reviewed, split, role)`` for the sampled active users.  ``split`` is
train / tuning / test per user; ``role`` is train / history / holdout per
row.  The study's five tables are filters of it (``split_tables``).

Scale notes
-----------
* Sample and split are hash predicates on ``user_id``: map-side, no join.
* The activity count and the role cut come from one partial aggregate on
  ``(user_id, level)`` — skew-safe because of map-side combine — joined back
  to the rows once (AQE picks broadcast or shuffle by measured size and
  splits a hot user's partition).
* Only the few rows at or above a user's cut level (about R..4R rows for
  R = history + holdout) go through the per-user window, so a user holding a
  third of all rows never lands in one sort task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.config import Config
from affinity.functions.hashing import bernoulli, hash_key, top_level, weighted_bucket

INTERACTION_COLS = ["user_id", "book_id", "is_read", "rating", "is_reviewed"]
SPLITS = ("train", "tuning", "test")
ROLES = ("train", "history", "holdout")

#: Writes a table under a name and reads it back (``sources.scratch.Run.keep``).
Keep = Callable[[DataFrame, str], DataFrame]

# Hash-domain tags (keep the draws independent of each other).
SAMPLE_TAG = "sample"
SPLIT_TAG = "split"
ORDER_TAG = "order"


def user_activity(interactions: DataFrame) -> DataFrame:
    """Interactions per user: ``(user_id, n_interactions)``."""
    return interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_interactions"))


def active_users(interactions: DataFrame, min_interactions: int) -> DataFrame:
    """Users with at least ``min_interactions`` rows (HAVING on a partial aggregate)."""
    return (user_activity(interactions)
            .where(F.col("n_interactions") >= min_interactions)
            .select("user_id"))


def filter_active(interactions: DataFrame, min_interactions: int) -> DataFrame:
    """Rows of active users (left-semi join on user_id)."""
    return interactions.join(active_users(interactions, min_interactions), "user_id", "left_semi")


def sample_predicate(fraction: float, seed: int):
    """User-level Bernoulli sample as a column predicate on ``user_id``."""
    return bernoulli(SAMPLE_TAG, seed, fraction, "user_id")


def sample_users(interactions: DataFrame, fraction: float, seed: int) -> DataFrame:
    return interactions.where(sample_predicate(fraction, seed))


def split_column(cfg: Config):
    """train / tuning / test per user from the split weights."""
    return weighted_bucket(SPLIT_TAG, cfg.split_seed, list(SPLITS), list(cfg.split_weights), "user_id")


def order_seed(cfg: Config):
    """Per-split seed of the random order (tuning and test are drawn apart)."""
    return F.when(F.col("split") == "tuning", F.lit(cfg.seed_tuning)).otherwise(F.lit(cfg.seed_test))


def order_key(cfg: Config):
    return hash_key(ORDER_TAG, order_seed(cfg), "user_id", "book_id")


def keyed_rows(rows: DataFrame, cfg: Config) -> DataFrame:
    """Add the per-split random-order key ``_k`` and its level ``_lvl``."""
    return (rows
            .withColumn("_k", order_key(cfg))
            .withColumn("_lvl", top_level(F.col("_k"))))


def role_cuts(keyed: DataFrame, reserved: int) -> DataFrame:
    """Per user: ``_n`` rows and ``_cut``, the deepest key level still holding
    ``min(_n, reserved)`` rows.  Built from per-(user, level) counts — a
    partial aggregate with at most 33 output rows per user — so a hot user
    costs one map-side combine, not one sort task."""
    hist = keyed.groupBy("user_id", "_lvl").agg(F.count(F.lit(1)).alias("_c"))
    deeper_first = Window.partitionBy("user_id").orderBy(F.col("_lvl").desc())
    whole_user = Window.partitionBy("user_id")
    hist = (hist.withColumn("_cum", F.sum("_c").over(deeper_first))
                .withColumn("_n", F.sum("_c").over(whole_user)))
    return (hist.groupBy("user_id")
            .agg(F.first("_n").alias("_n"),
                 F.max(F.when(F.col("_cum") >= F.least(F.col("_n"), F.lit(reserved)),
                              F.col("_lvl"))).alias("_cut")))


def assign_roles(keyed: DataFrame, cfg: Config, min_interactions: int = 0, keep: Keep | None = None) -> DataFrame:
    """Add ``role`` to keyed rows (``keyed_rows``); keep active users only.
    With ``keep`` the cuts are written once for both joins below.

    Semantics (per tuning/test user, rows in random order by the hashed key):
    the last ``holdout`` rows are holdout, the ``history`` rows before them are
    history, everything else is train.  Train-split users keep all rows as train.
    """
    reserved = cfg.reserved
    per_user = role_cuts(keyed, reserved).where(F.col("_n") >= min_interactions)
    if keep is not None:
        per_user = keep(per_user, "cuts")
    joined = keyed.drop("_k").join(per_user, "user_id")  # inner = activity filter
    is_cand = (F.col("split") != "train") & (F.col("_lvl") >= F.col("_cut"))

    out_cols = INTERACTION_COLS + ["split", "role"]
    rest = joined.where(~is_cand).withColumn("role", F.lit("train")).select(*out_cols)

    # the key, a hash of the ids, is made again for candidates instead of moved through the join;
    # its 16 bytes sort as its hex digits do and are half as long in the shuffle
    from_end = Window.partitionBy("user_id").orderBy(F.unhex(order_key(cfg)).desc(), F.col("book_id").desc())
    pos = F.row_number().over(from_end)
    cand = (joined.where(is_cand)
            .withColumn("_pos", pos)
            .withColumn("role", F.when(F.col("_pos") <= cfg.holdout_size, F.lit("holdout"))
                        .when(F.col("_pos") <= reserved, F.lit("history"))
                        .otherwise(F.lit("train")))
            .select(*out_cols))
    return rest.unionByName(cand)


def prepare(interactions: DataFrame, cfg: Config, materialize: bool = False, keep: Keep | None = None) -> DataFrame:
    """Activity filter + user sample + user split + roles.

    With ``materialize`` the sampled, keyed rows are written once to the shared
    checkpoint folder and both passes of the role assignment (histogram, then
    join) read that copy instead of re-reading the raw input: the sample
    predicate hashes ``user_id`` and cannot prune Parquet row groups, so two
    raw scans would cost twice the raw size.  With ``keep`` (``Run.keep``) the
    sampled rows with their split and level, but without keys, and the users'
    cuts are written instead: the interactions, which may be a join and an
    aggregate, are made once, and so are the hashes of a row."""
    rows = sample_users(interactions.select(*INTERACTION_COLS), cfg.sample_fraction, cfg.sample_seed)
    keyed = keyed_rows(rows.withColumn("split", split_column(cfg)), cfg)
    if keep is not None:
        keyed = keep(keyed.drop("_k"), "sampled")
    elif materialize:
        from affinity.sources.sinks import materialize as _mat
        keyed = _mat(keyed.sparkSession, keyed, f"sampled-{uuid.uuid4().hex}")
    return assign_roles(keyed, cfg, cfg.min_interactions, keep)


def prepare_table(interactions: DataFrame, cfg: Config, path: str | None = None) -> DataFrame:
    """``prepare`` written once as Parquet partitioned by (split, role) under
    the shared checkpoint folder (or ``path``) and read back: downstream
    readers of one role prune to its directories."""
    from affinity.session import scratch_path
    from affinity.sources.sinks import write_splits
    spark = interactions.sparkSession
    path = path or scratch_path(spark, f"prepared-{uuid.uuid4().hex}")
    prepared = prepare(interactions, cfg, materialize=True)
    write_splits(prepared, path)
    # known schema (partition columns last): no footer inference on read-back
    return spark.read.schema(prepared.schema).parquet(path).select(*INTERACTION_COLS, "split", "role")


def split_users(prepared: DataFrame) -> DataFrame:
    """One row per sampled user: ``(user_id, split)``."""
    return prepared.select("user_id", "split").distinct()


def split_tables(prepared: DataFrame) -> dict[str, DataFrame]:
    """The study's five tables as filters of the prepared table."""
    cols = INTERACTION_COLS
    p = prepared
    return {
        "train": p.where(F.col("role") == "train").select(*cols),
        "tuning_history": p.where((F.col("split") == "tuning") & (F.col("role") == "history")).select(*cols),
        "tuning_holdout": p.where((F.col("split") == "tuning") & (F.col("role") == "holdout")).select(*cols),
        "test_history": p.where((F.col("split") == "test") & (F.col("role") == "history")).select(*cols),
        "test_holdout": p.where((F.col("split") == "test") & (F.col("role") == "holdout")).select(*cols),
    }


def train_union(prepared: DataFrame) -> DataFrame:
    """Final train table = train users' rows ∪ tuning extras ∪ test extras
    (``unionByName`` of the three contributions, tagged by source split)."""
    contrib = [prepared.where((F.col("split") == s) & (F.col("role") == "train"))
               .select(*INTERACTION_COLS, F.col("split").alias("source")) for s in SPLITS]
    out = contrib[0]
    for c in contrib[1:]:
        out = out.unionByName(c)
    return out


def history_of(prepared: DataFrame, split: str) -> DataFrame:
    return prepared.where((F.col("split") == split) & (F.col("role") == "history")).select(*INTERACTION_COLS)


def holdout_of(prepared: DataFrame, split: str) -> DataFrame:
    return prepared.where((F.col("split") == split) & (F.col("role") == "holdout")).select(*INTERACTION_COLS)


def train_of(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("role") == "train").select(*INTERACTION_COLS)


def fit_rows(prepared: DataFrame, split: str) -> DataFrame:
    """Rows a model for ``split`` is fitted on: all train rows plus that
    split's history (one filter of the prepared table — the union of the study
    without a second scan)."""
    cond = (F.col("role") == "train") | ((F.col("split") == split) & (F.col("role") == "history"))
    return prepared.where(cond).select(*INTERACTION_COLS)
