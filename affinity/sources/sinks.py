"""Sinks: Parquet tables, small single-file CSV reports, lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import checkpoint_dir


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_splits(prepared: DataFrame, path: str) -> None:
    """One write of the prepared table, partitioned by (split, role): the five
    split tables of the study are directory prefixes of it."""
    write_parquet(prepared, path, ["split", "role"])


def write_csv_lines(lines: DataFrame, header: list[str], path: str) -> None:
    """One text column as CSV files, each with the header line first."""
    lines.select(F.col(lines.columns[0]).alias(",".join(header))).write.mode("overwrite").option(
        "header", True).option("quote", "").option("sep", "\u0001").csv(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """Single CSV file with a header, for results that are small by
    construction (top-k lists, metric rows).  The input runs once."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def materialize(spark: SparkSession, df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut lineage.  With a name: write Parquet under the shared checkpoint
    folder and read it back; without: reliable ``checkpoint()`` (never local)."""
    base = checkpoint_dir(spark)
    if name is None:
        return df.checkpoint(eager=True)
    path = base.rstrip("/") + "/" + name
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer inference
