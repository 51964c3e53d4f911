"""Ranking-metric expressions over a best-hit rank (null = no hit).

"MAP" is the reciprocal rank of the best hit and "NDCG" is 1/log2(best+1),
exactly as defined by the study; both are 0 for a user without a hit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reciprocal_rank(best_rank: Column) -> Column:
    return F.when(best_rank.isNotNull(), F.lit(1.0) / best_rank).otherwise(F.lit(0.0))


def best_hit_ndcg(best_rank: Column) -> Column:
    return F.when(best_rank.isNotNull(), F.lit(1.0) / F.log2(best_rank + 1)).otherwise(F.lit(0.0))


def r6(c: Column) -> Column:
    """Round a double to 6 places (report precision, engine-stable)."""
    return F.round(c.cast("double"), 6)
