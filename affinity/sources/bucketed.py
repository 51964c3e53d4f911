"""Parquet tables bucketed by a key, and opened again from their files alone.

Bucketing lives in the catalog, not in the files.  A record beside them holds
it, so another session (the next job of a study) registers the same files and
joins, groups and windows on the key need no shuffle there either.  Without
the catalog the files are an ordinary Parquet table whose scan splits them by size.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RECORD = "_buckets.json"


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{RECORD}")
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def table_name() -> str:
    return f"affinity_buckets_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` under ``path``, each partition in ``buckets`` buckets of
    ``key`` sorted by it; returns the name it has in the catalog."""
    spark, name = df.sparkSession, table_name()
    writer = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    p, fs = _file(spark, path)
    out = fs.create(p, True)
    out.write(json.dumps({"schema": df.schema.jsonValue(), "key": key, "buckets": buckets, "partition_by": list(partition_by)}).encode())
    out.close()
    return name


def open_bucketed(spark: SparkSession, path: str) -> str:
    """Register the files of an earlier ``write_bucketed``; returns the name."""
    p, fs = _file(spark, path)
    raw = fs.open(p)
    spec = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(raw, "UTF-8"))
    raw.close()
    name, schema = table_name(), StructType.fromJson(spec["schema"])
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"PARTITIONED BY ({', '.join(spec['partition_by'])})" if spec["partition_by"] else ""
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet {by} CLUSTERED BY (`{spec['key']}`) "
              f"SORTED BY (`{spec['key']}`) INTO {int(spec['buckets'])} BUCKETS LOCATION '{path}'")
    if by:
        spark.catalog.recoverPartitions(name)
    return name


def forget(spark: SparkSession, name: str) -> None:
    """Take the table out of the catalog; its files stay (the path is its own)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
