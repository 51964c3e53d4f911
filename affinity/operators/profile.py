"""One-pass profiles and validation checks of the interaction and split tables.

Each profile is a single aggregate (conditional counts) instead of one job per
counter; results are small DataFrames, never driver-side loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.metrics import r6
from affinity.functions.signals import has_rating

SIGNALS = ("rated", "read", "reviewed", "rated_and_read")


def table_name():
    """Name of the study table a prepared row belongs to."""
    return (F.when(F.col("role") == "train", F.lit("train"))
            .otherwise(F.concat_ws("_", F.col("split"), F.col("role"))))


def pct(num, den):
    return r6(F.lit(100.0) * num / F.nullif(den, F.lit(0)))


def coverage(df: DataFrame) -> DataFrame:
    """One row: n_rows and how many rows carry each signal, plus percentages."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(has_rating()).alias("n_rated"),
        F.count_if(F.col("is_read") == 1).alias("n_read"),
        F.count_if(F.col("is_reviewed") == 1).alias("n_reviewed"),
        F.count_if(has_rating() & (F.col("is_read") == 1)).alias("n_rated_and_read"),
    )
    return counts.select("*", *[pct(F.col(f"n_{s}"), F.col("n_rows")).alias(f"pct_{s}") for s in SIGNALS])


def tagged_coverage(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        part = coverage(df).select(F.lit(name).alias("dataset"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def signal_breakdown(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per (is_read, is_reviewed, has_rating) cell, per dataset."""
    out = None
    for name, df in frames.items():
        part = (df.groupBy("is_read", "is_reviewed", has_rating().alias("has_rating"))
                .agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(name).alias("dataset"), "*"))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("dataset", "is_read", "is_reviewed", "has_rating")


def rating_histogram(df: DataFrame) -> DataFrame:
    """Rated rows per star value with their share and the overall mean.
    Totals come from a window over the (at most 5-row) histogram."""
    hist = df.where(has_rating()).groupBy("rating").agg(F.count(F.lit(1)).alias("n_ratings"))
    everything = Window.partitionBy()
    tot = F.sum("n_ratings").over(everything)
    mean = F.sum(F.col("rating") * F.col("n_ratings")).over(everything) / tot
    return (hist.select("rating", "n_ratings", pct(F.col("n_ratings"), tot).alias("pct"),
                        r6(mean).alias("mean_rating"))
            .orderBy("rating"))


#: Low bits of a value that the first level of the quantile histogram leaves out.
LEVEL_BITS = 16


def exact_quantiles(counts: DataFrame, col: str, qs: list[float], bits: int = LEVEL_BITS) -> DataFrame:
    """One row ``(n, min, max, mean, q0, q1, ...)`` of an integer column, the
    quantiles exact (the least value that has a share of q at or below it).

    From a histogram of values in two levels: the values above their low
    ``bits`` make a few buckets with running sums, each quantile falls into one
    of them, and only those buckets' values get running sums of their own.  No
    sort of the rows, none of all values; a running sum has at most as many rows as
    there are buckets, or values of a bucket."""
    hist = (counts.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("bigint").alias("v"))
            .agg(F.count(F.lit(1)).alias("c")).withColumn("b", F.shiftright("v", bits)))
    up_to = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    level = (hist.groupBy("b").agg(F.sum("c").alias("c"))
             .select("b", "c", (F.sum("c").over(up_to) - F.col("c")).alias("before"), F.sum("c").over(everything).alias("n")))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(float(q)))).alias("k"))
                                 for i, q in enumerate(qs)]))
    hit = (level.withColumn("w", wanted).where((F.col("before") < F.col("w.k")) & (F.col("w.k") <= F.col("before") + F.col("c")))
           .select("b", "before", F.col("w.i").alias("i"), F.col("w.k").alias("k")))  # a row for each quantile
    within = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = hist.join(F.broadcast(hit), "b").withColumn("cum", F.col("before") + F.sum("c").over(within))
    found = at.where((F.col("cum") >= F.col("k")) & (F.col("cum") - F.col("c") < F.col("k"))).select("i", "v")
    whole = hist.agg(F.sum("c").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum(F.col("v") * F.col("c")).alias("s"))
    none = F.lit(None).cast("bigint")
    rows = (whole.select("n", "lo", "hi", "s", F.lit(None).cast("int").alias("i"), none.alias("v"))
            .unionByName(found.select(none.alias("n"), none.alias("lo"), none.alias("hi"), none.alias("s"), "i", "v")))
    return rows.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.max("lo").alias("min"), F.max("hi").alias("max"),
                    (F.max("s") / F.max("n")).alias("mean"),
                    *[F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"q{i}") for i in range(len(qs))])


def distribution_stats(counts: DataFrame, col: str) -> DataFrame:
    """min / p25 / median / mean / p75 / max of a per-group count column, all exact."""
    return exact_quantiles(counts, col, [0.25, 0.5, 0.75]).select(
        "min", F.col("q0").alias("p25"), F.col("q1").alias("median"), r6(F.col("mean")).alias("mean"),
        F.col("q2").alias("p75"), "max")


def user_activity_stats(train: DataFrame) -> DataFrame:
    per_user = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return distribution_stats(per_user, "n")


def size_check(prepared: DataFrame, role: str, expected: int) -> DataFrame:
    """Per evaluation split: min / max / mean rows per user in ``role`` and
    whether every user has exactly ``expected``."""
    per_user = (prepared.where((F.col("role") == role) & (F.col("split") != "train"))
                .groupBy("split", "user_id").agg(F.count(F.lit(1)).alias("n")))
    return (per_user.groupBy("split")
            .agg(F.min("n").alias("min"), F.max("n").alias("max"), r6(F.avg("n")).alias("mean"),
                 F.count(F.lit(1)).alias("n_users"))
            .withColumn("all_expected", (F.col("min") == expected) & (F.col("max") == expected))
            .withColumn("expected", F.lit(expected).cast("bigint")))


def split_user_overlap(prepared: DataFrame) -> DataFrame:
    """Overlap counts.  ``split_*`` compare the user splits (0 by construction);
    ``table_*`` compare users present in the train table with users of the
    history tables — every evaluated user with extras is in both (the study's
    check counted the latter)."""
    flags = prepared.groupBy("user_id").agg(
        F.max(F.when(F.col("split") == "train", 1).otherwise(0)).alias("s_train"),
        F.max(F.when(F.col("split") == "tuning", 1).otherwise(0)).alias("s_tuning"),
        F.max(F.when(F.col("split") == "test", 1).otherwise(0)).alias("s_test"),
        F.max(F.when(F.col("role") == "train", 1).otherwise(0)).alias("t_train"),
        F.max(F.when((F.col("split") == "tuning") & (F.col("role") == "history"), 1).otherwise(0)).alias("t_tuning"),
        F.max(F.when((F.col("split") == "test") & (F.col("role") == "history"), 1).otherwise(0)).alias("t_test"),
    )
    agg = flags.agg(
        F.count_if((F.col("s_tuning") == 1) & (F.col("s_train") == 1)).alias("split_tuning_in_train"),
        F.count_if((F.col("s_test") == 1) & (F.col("s_train") == 1)).alias("split_test_in_train"),
        F.count_if((F.col("s_tuning") == 1) & (F.col("s_test") == 1)).alias("split_tuning_in_test"),
        F.count_if((F.col("t_tuning") == 1) & (F.col("t_train") == 1)).alias("table_tuning_in_train"),
        F.count_if((F.col("t_test") == 1) & (F.col("t_train") == 1)).alias("table_test_in_train"),
        F.count_if((F.col("t_tuning") == 1) & (F.col("t_test") == 1)).alias("table_tuning_in_test"),
    )
    names = agg.columns
    stack = "stack({}, {}) as (check, n_users)".format(
        len(names), ", ".join(f"'{n}', {n}" for n in names))
    return agg.selectExpr(stack)


def split_table_stats(prepared: DataFrame) -> DataFrame:
    """Rows / distinct users / distinct items of each of the five tables.
    Distinct counts are two-level aggregates (no Expand of the input)."""
    t = prepared.withColumn("table", table_name())
    users = (t.groupBy("table", "user_id").agg(F.count(F.lit(1)).alias("_r"))
             .groupBy("table").agg(F.sum("_r").alias("n_rows"), F.count(F.lit(1)).alias("n_users")))
    books = (t.groupBy("table", "book_id").agg(F.count(F.lit(1)).alias("_r"))
             .groupBy("table").agg(F.count(F.lit(1)).alias("n_books")))
    return users.join(books, "table").select("table", F.col("n_rows").cast("bigint").alias("n_rows"),
                                             "n_users", "n_books")


def readiness(prepared: DataFrame, rule, extra: dict | None = None) -> DataFrame:
    """Rows / users kept by a model's inclusion ``rule`` in each table and in
    the two fit sets (train + that split's history).  One per-user partial
    aggregate of conditional counts, then conditional counts over users."""
    kept = prepared.where(rule)
    is_train = F.col("role") == "train"
    sets = {
        "train": is_train,
        "tuning_history": (F.col("split") == "tuning") & (F.col("role") == "history"),
        "tuning_holdout": (F.col("split") == "tuning") & (F.col("role") == "holdout"),
        "test_history": (F.col("split") == "test") & (F.col("role") == "history"),
        "test_holdout": (F.col("split") == "test") & (F.col("role") == "holdout"),
    }
    sets["fit_tuning"] = is_train | sets["tuning_history"]
    sets["fit_test"] = is_train | sets["test_history"]
    for name, cond in (extra or {}).items():
        sets[name] = is_train & cond
    names = list(sets)
    per_user = kept.groupBy("user_id").agg(*[F.count_if(c).alias(f"_{i}") for i, c in enumerate(sets.values())])
    agg = per_user.agg(*[F.sum(f"_{i}").cast("bigint").alias(f"r{i}") for i in range(len(names))],
                       *[F.count_if(F.col(f"_{i}") > 0).alias(f"u{i}") for i in range(len(names))])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("table"), F.coalesce(F.col(f"r{i}"), F.lit(0)).alias("n_rows"),
                                        F.col(f"u{i}").alias("n_users")) for i, n in enumerate(names)]))
    out = agg.select(rows.alias("x")).select("x.table", "x.n_rows", "x.n_users")
    # A study table with no kept row does not appear (as in a GROUP BY);
    # fit sets and extra counts are always reported.
    study_tables = ["train", "tuning_history", "tuning_holdout", "test_history", "test_holdout"]
    keep = (F.col("n_rows") > 0) | ~F.col("table").isin(*study_tables)
    return out.where(keep).withColumn("ready", F.col("n_rows") > 0)


def activity_summary(interactions: DataFrame, min_interactions: int, sampled: Column) -> DataFrame:
    """Rows, users and integer mean rows per user at each preparation stage:
    raw, active users, and active users that ``sampled`` (a predicate on
    ``user_id``) keeps.  One per-user count gives all three."""
    users = interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    active = F.col("_n") >= min_interactions
    stages = {"raw": F.lit(True), "active": active, "sampled": active & sampled}
    agg = users.agg(*[f.alias(f"{name}_{kind}") for name, rule in stages.items() for kind, f in (
        ("rows", F.coalesce(F.sum(F.when(rule, F.col("_n"))), F.lit(0)).cast("bigint")), ("users", F.count_if(rule)))])
    rows = F.array(*[F.struct(F.lit(name).alias("stage"), F.col(f"{name}_rows").alias("n_rows"),
                              F.col(f"{name}_users").alias("n_users")) for name in stages])
    return agg.select(F.inline(rows)).withColumn(
        "avg_per_user", F.floor(F.col("n_rows") / F.nullif(F.col("n_users"), F.lit(0))).cast("bigint"))


def sample_drift(active: DataFrame, sampled: Column) -> DataFrame:
    """Signal coverage before and after the user sample (a predicate on
    ``user_id``), and the difference: conditional counts of one pass."""
    rules = {"rated": has_rating(), "read": F.col("is_read") == 1, "reviewed": F.col("is_reviewed") == 1,
             "rated_and_read": has_rating() & (F.col("is_read") == 1)}
    agg = active.agg(F.count(F.lit(1)).alias("n"), F.count_if(sampled).alias("s"),
                     *[F.count_if(r).alias(f"n_{k}") for k, r in rules.items()],
                     *[F.count_if(r & sampled).alias(f"s_{k}") for k, r in rules.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("signal"), pct(F.col(f"n_{k}"), F.col("n")).alias("pct_active"),
                              pct(F.col(f"s_{k}"), F.col("s")).alias("pct_sample")) for k in rules])
    return agg.select(F.inline(rows)).withColumn("diff", r6(F.col("pct_sample") - F.col("pct_active")))


def user_split_shares(prepared: DataFrame) -> DataFrame:
    """Users per split and share of all sampled users (window total over 3 rows)."""
    per = (prepared.groupBy("user_id", "split").agg(F.count(F.lit(1)).alias("_r"))
           .groupBy("split").agg(F.count(F.lit(1)).alias("n_users")))
    return per.select("split", "n_users", pct(F.col("n_users"), F.sum("n_users").over(Window.partitionBy())).alias("pct"))


def split_accounting(prepared: DataFrame) -> DataFrame:
    """Rows by (split, role) and their share of all rows of that role."""
    per = prepared.groupBy("split", "role").agg(F.count(F.lit(1)).alias("n_rows"))
    tot = prepared.groupBy("role").agg(F.count(F.lit(1)).alias("_tot"))
    return per.join(tot, "role").select("split", "role", "n_rows", pct(F.col("n_rows"), F.col("_tot")).alias("pct_of_role"))


def dataset_summary(prepared: DataFrame) -> DataFrame:
    """Long-form summary (metric, value) of the prepared dataset: one per-user
    partial aggregate, then counts over users (no distinct-count Expand)."""
    is_train = F.col("role") == "train"
    hist = lambda s: (F.col("split") == s) & (F.col("role") == "history")
    hold = lambda s: (F.col("split") == s) & (F.col("role") == "holdout")
    read = F.col("is_read") == 1
    per_user = prepared.groupBy("user_id").agg(
        F.max(F.when(F.col("split") == "train", 1).otherwise(0)).alias("s_train"),
        F.max(F.when(F.col("split") == "tuning", 1).otherwise(0)).alias("s_tuning"),
        F.max(F.when(F.col("split") == "test", 1).otherwise(0)).alias("s_test"),
        F.count_if(is_train).alias("train_rows"),
        F.count_if(hist("tuning")).alias("tuning_history_rows"),
        F.count_if(hold("tuning")).alias("tuning_holdout_rows"),
        F.count_if(hist("test")).alias("test_history_rows"),
        F.count_if(hold("test")).alias("test_holdout_rows"),
        F.count_if(is_train & has_rating()).alias("explicit_train_rows"),
        F.count_if((is_train | hist("tuning")) & has_rating()).alias("explicit_fit_rows"),
        F.count_if(hold("tuning") & has_rating()).alias("_eh_tuning"),
        F.count_if(hold("test") & has_rating()).alias("_eh_test"),
        F.count_if(is_train & read).alias("implicit_train_rows"),
        F.count_if((is_train | hist("tuning")) & read).alias("implicit_fit_rows"),
        F.count_if(hold("tuning") & read).alias("_ih_tuning"),
        F.count_if(hold("test") & read).alias("_ih_test"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    sums = ["train_rows", "tuning_history_rows", "tuning_holdout_rows", "test_history_rows", "test_holdout_rows",
            "explicit_train_rows", "explicit_fit_rows", "implicit_train_rows", "implicit_fit_rows", "total_rows"]
    agg = per_user.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if(F.col("s_train") == 1).alias("train_users"),
        F.count_if(F.col("s_tuning") == 1).alias("tuning_users"),
        F.count_if(F.col("s_test") == 1).alias("test_users"),
        *[F.sum(c).alias(c) for c in sums],
        F.count_if(F.col("_eh_tuning") > 0).alias("explicit_eval_users_tuning"),
        F.count_if(F.col("_eh_test") > 0).alias("explicit_eval_users_test"),
        F.count_if(F.col("_ih_tuning") > 0).alias("implicit_eval_users_tuning"),
        F.count_if(F.col("_ih_test") > 0).alias("implicit_eval_users_test"),
    )
    names = agg.columns
    stack = "stack({}, {}) as (metric, value)".format(
        len(names), ", ".join(f"'{n}', CAST({n} AS BIGINT)" for n in names))
    return agg.selectExpr(stack)
