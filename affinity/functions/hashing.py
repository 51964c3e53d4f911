"""Deterministic hash keys for sampling, splitting and ordering.

``rand(seed)``, ``sample`` and ``randomSplit`` give different answers on a
different partition layout, so data roles here come from ``md5`` of
``tag|seed|ids``.  The first 8 hex digits are a uniform 32-bit value; a
Bernoulli draw with probability f is ``prefix < hex(floor(f * 2**32))``, a plain
string comparison that Spark and DuckDB evaluate identically.  Distinct tags
keep sample, split, order and MinHash draws independent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 1 << 32


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def hash_key(tag: str, seed, *cols) -> Column:
    """md5 hex of ``tag|seed|c1|c2...`` (all rendered as strings)."""
    parts = [F.lit(tag), _c(seed).cast("string")] + [
        (F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hex_threshold(fraction: float) -> str:
    """8-hex-digit cut for a Bernoulli probability (``ffffffff`` + 1 caps at 1)."""
    v = int(fraction * TWO_32)
    if v >= TWO_32:
        return "g"  # sorts after every hex digit: always true
    return format(max(v, 0), "08x")


def bernoulli(tag: str, seed, fraction: float, *cols) -> Column:
    """True with probability ``fraction``, decided by the hashed ids only."""
    return F.substring(hash_key(tag, seed, *cols), 1, 8) < F.lit(hex_threshold(fraction))


def weighted_bucket(tag: str, seed, labels: Sequence[str], weights: Sequence[float], *cols) -> Column:
    """Label chosen by cumulative weight cuts of the hashed value (like
    ``randomSplit`` weights, normalised)."""
    total = float(sum(weights))
    prefix = F.substring(hash_key(tag, seed, *cols), 1, 8)
    acc = 0.0
    expr = None
    for label, w in zip(labels[:-1], weights[:-1]):
        acc += w / total
        cond = prefix < F.lit(hex_threshold(acc))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(labels[-1]) if expr is None else expr.otherwise(F.lit(labels[-1]))


def hash60(tag: str, seed, *cols) -> Column:
    """First 60 bits of ``md5(tag|seed|ids)`` as a non-negative bigint: a
    fixed-width value, so ``min`` over it plans as a codegen'd HashAggregate."""
    return F.conv(F.substring(hash_key(tag, seed, *cols), 1, 15), 16, 10).cast("bigint")


def prefix_value(key: Column) -> Column:
    """First 32 bits of an md5 hex key as a bigint in [0, 2**32)."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def top_level(key: Column) -> Column:
    """Number of leading one-bits of the key's 32-bit prefix (0..32).

    Monotone in the key, and geometric: about half of all keys have level 0,
    a quarter level 1, ...  Counting rows per (group, level) is a tiny partial
    aggregate from which the level holding a group's k largest keys follows
    exactly (see ``operators.prep.assign_roles``).  The first hex digit tells the
    level of 15 keys in 16; only the others are converted."""
    w = F.lit(TWO_32 - 1) - prefix_value(key)
    deep = F.when(w == 0, F.lit(32)).otherwise(F.lit(32) - F.length(F.bin(w))).cast("int")
    first = F.substring(key, 1, 1)
    return (F.when(first < "8", F.lit(0)).when(first < "c", F.lit(1)).when(first < "e", F.lit(2))
            .when(first < "f", F.lit(3)).otherwise(deep))
