"""Scans with explicit schemas (no inference pass over the raw CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# user_id, book_id, is_read 0/1, rating 0-5 (0 = not rated), is_reviewed 0/1
INTERACTION_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("book_id", T.IntegerType(), False),
    T.StructField("is_read", T.IntegerType(), False),
    T.StructField("rating", T.IntegerType(), False),
    T.StructField("is_reviewed", T.IntegerType(), False),
])

# internal sequential item id -> external item id
ITEM_MAP_SCHEMA = T.StructType([
    T.StructField("book_id_csv", T.IntegerType(), False),
    T.StructField("book_id", T.IntegerType(), False),
])


def read_interactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Interaction CSV with a header row, typed by INTERACTION_SCHEMA."""
    return spark.read.schema(INTERACTION_SCHEMA).option("header", True).csv(path)


#: Column that holds a line the CSV reader could not take.
CORRUPT = "_corrupt_record"
# Fixed values of the interaction table: what a column may hold.
RANGES = {"is_read": (0, 1), "rating": (0, 5), "is_reviewed": (0, 1)}


def ingest_interactions_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of an interaction CSV with a header row.

    The header must be the schema's (else the read fails, naming the columns).
    A line is rejected whole, with the first reason that applies:
    ``malformed`` (wrong number of fields, or a field that is no number; an
    empty ``user_id`` or ``book_id`` too), ``missing`` (another empty field),
    ``out_of_range`` (a flag that is not 0 or 1, a rating outside 0..5).
    ``rejects`` is ``(reason, line)``; rows and rejects together are all lines."""
    fields = [T.StructField(f.name, f.dataType, True) for f in INTERACTION_SCHEMA]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])
    names = [f.name for f in fields]
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    empty = F.lit(False)
    for c in names:
        empty = empty | F.col(c).isNull()
    outside = F.lit(False)
    for c, (lo, hi) in RANGES.items():
        outside = outside | ~F.col(c).between(lo, hi)
    reason = (F.when(F.col(CORRUPT).isNotNull() | F.col("user_id").isNull() | F.col("book_id").isNull(), "malformed")
              .when(empty, "missing").when(outside, "out_of_range"))
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]))
    told = raw.withColumn("reason", reason)
    return told.where(F.col("reason").isNull()).select(*names), told.where(F.col("reason").isNotNull()).select("reason", line.alias("line"))


def ingest_report(rows: DataFrame, rejects: DataFrame) -> DataFrame:
    """``(outcome, n_lines)``: lines accepted and lines rejected by reason."""
    return (rows.select(F.lit("accepted").alias("outcome")).unionByName(rejects.select(F.col("reason").alias("outcome")))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("n_lines")))


def read_item_map_csv(spark: SparkSession, path: str) -> DataFrame:
    """Item-id map CSV (``book_id_csv,book_id``) with a header row."""
    return spark.read.schema(ITEM_MAP_SCHEMA).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
