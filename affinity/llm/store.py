"""Intermediate tables under the shared checkpoint folder.

A written table cuts lineage so that a lost executor costs a re-read, not a
re-run.  Tables that no later step reads are dropped at once."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from affinity.session import scratch_path


class Store:
    """A folder of its own for one run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        self.count = 0

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write and reread with the known schema (an empty table has no files with one)."""
        self.count += 1
        path = f"{self.path}/{self.count:03d}-{name}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stored_at = path
        return out

    def release(self) -> None:
        """Let Spark's cleaner remove shuffles and broadcasts of finished steps now:
        it acts on what the driver has collected as garbage, by default every
        half hour, and one run here has many short steps."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of the filter for each key, and most bits of it: 2**26 are 2**20 rows to broadcast.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 22, 1 << 26


def possibly_in(df: DataFrame, column: str, other: DataFrame, name: str = "maybe", n: int | None = None) -> DataFrame:
    """``df`` with a flag that is true wherever ``column`` is in the one column
    of ``other`` and seldom elsewhere.  The bits behind it are broadcast.  Given
    ``n``, the most rows of ``other``, they grow with it, and for more keys than
    MOST_BITS serve the flag comes from a join by key, so that the filter never
    stops filtering; else there are LEAST_BITS whatever the input."""
    keys = other.select(F.col(other.columns[0]).alias("__k"))
    n = 0 if n is None else n
    if n * BITS_EACH > MOST_BITS:
        keys = keys.distinct()
        return df.join(keys, F.col(column).eqNullSafe(keys["__k"]), "left").withColumn(name, F.col("__k").isNotNull()).drop("__k")
    bits_in_all = max(LEAST_BITS, 1 << (max(1, n * BITS_EACH) - 1).bit_length())
    slot = lambda c: F.xxhash64(c).bitwiseAND(F.lit(bits_in_all - 1))
    bits = keys.select(slot(F.col("__k")).alias("__s")).groupBy(F.shiftright("__s", 6).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(__s & 63 as int))")).alias("__bits"))
    d = df.withColumn("__s", slot(F.col(column)))
    d = d.join(F.broadcast(bits), F.shiftright("__s", 6) == F.col("__word"), "left")
    return d.withColumn(name, F.expr("coalesce((shiftright(__bits, cast(__s & 63 as int)) & 1) = 1, false)")).drop("__s", "__word", "__bits")
