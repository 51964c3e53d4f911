"""The study's split tables: written once, bucketed by user, counted on the way.

``write_study`` writes the prepared rows partitioned by (split, role) and
bucketed by user.  The same files are read in two ways:

* ``by_user`` -- by bucket.  For history and holdout rows, of which a user has
  ``history_size + holdout_size`` at most: their joins, groups and windows by
  user need no shuffle, and no bucket can be hot.
* ``rows`` -- as plain Parquet, split by size.  For train rows, where one user
  may hold a third of the table: the rows of a user with more than ``deal_rows`` go to
  several tasks of the write and so to several files of the bucket, and the plain scan
  deals these out again.

The counters of the reports by table (rows, signals, ratings) are observed in
the tasks that write the files, so these reports scan nothing.  The observed node is the
last before the write, in the stage of its own: Spark adds a task's counters
when its output is committed to the stage, once for each partition, however often it was tried.

Defined results: null flags and ratings count as rows without the signal; a
table without rows does not appear; an empty input gives an empty profile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from affinity.config import Config
from affinity.functions.metrics import r6
from affinity.functions.signals import any_signal, has_rating
from affinity.operators import prep
from affinity.operators.evaluation import with_metrics
from affinity.operators.profile import SIGNALS, pct
from affinity.operators.signals import COMBINED_RULE
from affinity.sources.bucketed import forget, open_bucketed, write_bucketed

PROFILE_SCHEMA = ("split string, role string, n_rows bigint, n_rated bigint, n_read bigint, n_reviewed bigint, "
                  "n_rated_and_read bigint, n_any bigint, sum_rating bigint")
COUNTS = [c.split()[0] for c in PROFILE_SCHEMA.split(", ")[2:]]


@dataclass
class Study:
    """A written study; ``close`` takes its table out of the catalog, the files stay."""
    rows: DataFrame
    by_user: DataFrame
    name: str

    def close(self) -> None:
        forget(self.rows.sparkSession, self.name)


def counters(split: str, role: str) -> list:
    """The counters of one table as aggregates over all rows."""
    here = (F.col("split") == split) & (F.col("role") == role)
    read = F.col("is_read") == 1
    rules = [F.lit(True), has_rating(), read, F.col("is_reviewed") == 1, has_rating() & read, any_signal(COMBINED_RULE)]
    out = [F.count_if(here & r) for r in rules]
    return [*out, F.coalesce(F.sum(F.when(here & has_rating(), F.col("rating"))), F.lit(0)).cast("bigint")]


def dealt(rows: DataFrame, sizes: DataFrame, buckets: int, deal_rows: int) -> DataFrame:
    """Rows in the tasks that write them: a bucket each, and a bucket's train
    rows of a user with more than ``deal_rows`` in as many tasks as that needs.
    ``sizes`` are the ``(user_id, _n)`` of such users."""
    tasks = F.coalesce(F.ceil(F.col("_n") / F.lit(deal_rows)), F.lit(1))
    part = F.when(F.col("role") == "train", F.pmod(F.xxhash64("book_id"), tasks)).otherwise(0)
    return (rows.join(sizes, "user_id", "left").withColumn("_part", part)
            .withColumn("_bucket", F.pmod(F.hash("user_id"), F.lit(buckets)))
            .repartition("_bucket", "_part").select(*rows.columns))


def write_study(interactions: DataFrame, cfg: Config, path: str, scratch) -> tuple[Study, DataFrame]:
    """Prepare, write and count in one write; returns the study and its profile
    (a row for each table, ``PROFILE_SCHEMA``).  ``scratch`` is a ``Run``: it holds the
    sampled, keyed rows, and the study closes with it."""
    spark = interactions.sparkSession
    rows = prep.sample_users(interactions.select(*prep.INTERACTION_COLS), cfg.sample_fraction, cfg.sample_seed)
    keyed = scratch.keep(prep.keyed_rows(rows.withColumn("split", prep.split_column(cfg)), cfg), "keyed")
    sizes = keyed.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cfg.deal_rows)
    out = dealt(prep.assign_roles(keyed, cfg, cfg.min_interactions), sizes, cfg.split_buckets, cfg.deal_rows)
    tables = [(s, r) for s in prep.SPLITS for r in prep.ROLES]
    seen = Observation()
    marked = out.observe(seen, *[c.alias(f"{s}_{r}_{k}") for s, r in tables for k, c in zip(COUNTS, counters(s, r))])
    name = write_bucketed(marked, path, "user_id", cfg.split_buckets, ("split", "role"))
    study = _study(spark, path, name, out)
    scratch.at_close(study.close)
    got = seen.get
    found = [(s, r, *[got.get(f"{s}_{r}_{k}") or 0 for k in COUNTS]) for s, r in tables]
    profile = spark.createDataFrame([x for x in found if x[2]], PROFILE_SCHEMA)
    return study, profile


def write_lists(lists: DataFrame, cfg: Config, path: str, scratch) -> DataFrame:
    """Per-user lists ``(user_id, rank, book_id)``, each item once and ranks
    from 1 without gaps, as one row ``(user_id, items)`` a user in the buckets
    of the study.  A row is as long as a list, so no bucket can be hot.  The
    table goes with ``scratch``."""
    spark = lists.sparkSession
    rows = (lists.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", "book_id"))).alias("r"))
            .select("user_id", F.col("r.book_id").alias("items")))
    bucket = F.pmod(F.hash("user_id"), F.lit(cfg.split_buckets))
    name = write_bucketed(rows.withColumn("_bucket", bucket).repartition("_bucket").drop("_bucket"), path, "user_id", cfg.split_buckets)
    scratch.at_close(lambda: forget(spark, name))
    return spark.table(name)


def evaluate_lists(lists: DataFrame, holdout: DataFrame) -> DataFrame:
    """``evaluation.evaluate_users`` of written lists: a holdout row's rank is
    its item's place in the user's list, and the join is by user alone, which
    is what both tables are bucketed by (a user is in one split)."""
    place = F.nullif(F.array_position("items", F.col("book_id")), F.lit(0)).cast("int")
    ranked = holdout.select("split", "user_id", "book_id").join(lists, "user_id", "left").withColumn("rank", place)
    return with_metrics(ranked.groupBy("split", "user_id").agg(
        F.count(F.lit(1)).alias("n_holdout"), F.count("rank").alias("n_hits"), F.min("rank").alias("best_rank")))


def _study(spark: SparkSession, path: str, name: str, like: DataFrame) -> Study:
    cols = [*prep.INTERACTION_COLS, "split", "role"]
    return Study(spark.read.schema(like.schema).parquet(path).select(*cols), spark.table(name).select(*cols), name)


def open_study(spark: SparkSession, path: str) -> Study:
    """A study that an earlier session wrote."""
    name = open_bucketed(spark, path)
    return _study(spark, path, name, spark.table(name))


# ---------------------------------------------------------------- reports from the profile (at most nine rows)
def accounting(profile: DataFrame) -> DataFrame:
    """Rows by (split, role) and their share of all rows of that role."""
    of_role = F.sum("n_rows").over(Window.partitionBy("role"))
    return profile.select("split", "role", "n_rows", pct(F.col("n_rows"), of_role).alias("pct_of_role"))


def coverage(profile: DataFrame, name: str, rule=None) -> DataFrame:
    """Signal coverage of the tables that ``rule`` takes, as one dataset."""
    cols = ["n_rows", *[f"n_{s}" for s in SIGNALS]]
    t = (profile if rule is None else profile.where(rule)).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in cols])
    return t.select(F.lit(name).alias("dataset"), *cols, *[pct(F.col(f"n_{s}"), F.col("n_rows")).alias(f"pct_{s}") for s in SIGNALS])


def model_coverage(profile: DataFrame) -> DataFrame:
    """Train rows kept by each model's inclusion rule and share of all of them."""
    t = profile.where("role = 'train'").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "n_rated", "n_read", "n_any")])
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("bigint").alias("n"))
                     for m, c in (("explicit", "n_rated"), ("implicit", "n_read"), ("combined", "n_any"))])
    return (t.select("n_rows", F.explode(rows).alias("r"))
            .select("r.model", F.col("r.n").alias("n_rows"), pct(F.col("r.n"), F.col("n_rows")).alias("pct")))


def initial_rating_weight(profile: DataFrame, alpha: float) -> DataFrame:
    """``w0 = alpha / mean rating`` over rated train rows."""
    mean = F.col("s") / F.nullif(F.col("n"), F.lit(0))
    return (profile.where("role = 'train'").agg(F.sum("sum_rating").alias("s"), F.sum("n_rated").alias("n"))
            .select(r6(mean).alias("mean_rating"), F.lit(float(alpha)).alias("alpha"), r6(F.lit(float(alpha)) / mean).alias("w0")))
