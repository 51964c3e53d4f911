"""Interaction-shaped views over the driver tables (FIXTURES.md §2).

The same definitions are written as SQL in ``affinity.plans.oracle`` so the
DuckDB oracle sees identical inputs.  All three are plain scans + aggregates:
filters and projections reach the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.sources.tables import read_table

# Fixed values of the fixture definitions.
READ_FLAGS = ("A", "R")                      # l_returnflag values that mean "read"
RATED_DISCOUNT_BELOW = 0.09                  # read lines with a smaller discount carry a rating
REVIEWED_TAX_FROM = 0.07                     # l_tax at or above this means "reviewed"
READER_EVENTS = ("view", "click", "purchase")  # event types that mean "read"
ITEM_MAP_OFFSET = 1000000                    # external id = internal id + offset


def fx_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, book_id, is_read, rating, is_reviewed), one row per pair.

    lineitem ⋈ orders on the order key, then one aggregate on (customer, part).
    The signals are made in the scan, so the join moves three small numbers a line.
    """
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    is_read = F.col("l_returnflag").isin(*READ_FLAGS)
    rating = F.when(is_read & (F.col("l_discount") < RATED_DISCOUNT_BELOW),
                    F.lit(1) + (F.col("l_linenumber") - 1) % 5).otherwise(0)
    reviewed = F.when(F.col("l_tax") >= REVIEWED_TAX_FROM, 1).otherwise(0)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.when(is_read, 1).otherwise(0).alias("is_read"), rating.alias("rating"),
        reviewed.alias("is_reviewed"))
    return (
        li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").cast("int").alias("user_id"),
                 F.col("l_partkey").cast("int").alias("book_id"))
        .agg(*[F.max(c).cast("int").alias(c) for c in ("is_read", "rating", "is_reviewed")])
    )


def fx_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, book_id, is_read) from the events table, item = props.k."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    return (
        ev.groupBy(F.col("user_id").cast("int").alias("user_id"),
                   F.get_json_object("props", "$.k").cast("int").alias("book_id"))
        .agg(F.max(F.when(F.col("event_type").isin(*READER_EVENTS), 1).otherwise(0))
             .cast("int").alias("is_read"))
    )


def fx_item_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id_csv, book_id): internal id -> external id."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("book_id_csv"),
        (F.col("p_partkey") + ITEM_MAP_OFFSET).cast("int").alias("book_id"))


def fx_interaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line): the interactions as CSV lines, some of them damaged by their ids:
    a field too few, a word for a number, an empty flag, a rating out of range."""
    u, b = F.col("user_id"), F.col("book_id")
    text = lambda *cols: F.concat_ws(",", *[c.cast("string") for c in cols])
    rest = (F.col("is_read"), F.col("rating"), F.col("is_reviewed"))
    line = (F.when((u + b) % 97 == 0, text(u, b, rest[0]))
            .when((u + b) % 89 == 0, text(u, F.lit("book"), *rest))
            .when((u + b) % 83 == 0, text(u, b, F.lit(""), rest[1], rest[2]))
            .when((u + b) % 79 == 0, text(u, b, rest[0], F.lit(6), rest[2]))
            .otherwise(text(u, b, *rest)))
    return fx_interactions(spark, sf_dir).select(line.alias("line"))
