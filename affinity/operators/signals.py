"""Feedback signals -> training matrices (explicit, implicit, combined)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions import signals as S
from affinity.functions.metrics import r6


IMPLICIT_RULE = {"is_read": 1.0}
COMBINED_RULE = S.combined_weights(1.0, 1.0, 1.0)


def explicit_matrix(df: DataFrame) -> DataFrame:
    """Rated rows only (rating 0 = not rated): ``(user_id, book_id, rating)``."""
    return df.where(S.has_rating()).select("user_id", "book_id", "rating")


def add_confidence(df: DataFrame, alpha: float, beta: float) -> DataFrame:
    """Implicit matrix: read rows, ``confidence = 1 + a*is_read + b*is_reviewed``
    (an integer when the weights are)."""
    kind = "int" if float(alpha).is_integer() and float(beta).is_integer() else "float"
    return (df.where(S.any_signal(IMPLICIT_RULE))
            .select("user_id", "book_id", S.weighted_confidence(S.implicit_weights(alpha, beta), kind).alias("confidence")))


def build_combined_confidence(df: DataFrame, alpha: float, beta: float, w: float) -> DataFrame:
    """Combined matrix: any-signal rows, ``1 + a*read + b*reviewed + w*rating`` (float)."""
    weights = S.combined_weights(alpha, beta, w)
    return (df.where(S.any_signal(COMBINED_RULE))
            .select(F.col("user_id").cast("int").alias("user_id"),
                    F.col("book_id").cast("int").alias("book_id"),
                    S.weighted_confidence(weights).cast("float").alias("confidence")))


def confidence_levels(train: DataFrame, alpha: float, beta: float, w: float) -> DataFrame:
    """Rows per confidence value for the implicit and combined matrices."""
    imp = (add_confidence(train, alpha, beta)
           .select(F.lit("implicit").alias("model"), F.col("confidence").cast("double").alias("confidence")))
    comb = (build_combined_confidence(train, alpha, beta, w)
            .select(F.lit("combined").alias("model"), F.col("confidence").cast("double").alias("confidence")))
    return (imp.unionByName(comb).groupBy("model", "confidence")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def model_coverage(train: DataFrame) -> DataFrame:
    """Rows kept by each model's inclusion rule (one pass) and share of all rows."""
    agg = train.agg(F.count(F.lit(1)).alias("_tot"),
                    F.count_if(S.has_rating()).alias("explicit"),
                    F.count_if(S.any_signal(IMPLICIT_RULE)).alias("implicit"),
                    F.count_if(S.any_signal(COMBINED_RULE)).alias("combined"))
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("n_rows")) for m in
                               ("explicit", "implicit", "combined")]))
    return (agg.select("_tot", rows.alias("r"))
            .select("r.model", "r.n_rows",
                    r6(F.lit(100.0) * F.col("r.n_rows") / F.nullif(F.col("_tot"), F.lit(0))).alias("pct")))


def initial_rating_weight(train: DataFrame, alpha: float) -> DataFrame:
    """``w0 = alpha / mean rating`` over rated train rows."""
    return (train.where(S.has_rating())
            .agg(F.avg("rating").alias("_m"))
            .select(r6(F.col("_m")).alias("mean_rating"), F.lit(float(alpha)).alias("alpha"),
                    r6(F.lit(float(alpha)) / F.col("_m")).alias("w0")))
