"""Intermediate tables of one run under the shared checkpoint folder.

A run has a folder of its own with an owner record that every new table
renews.  The folder goes when the run closes (for lazily read results: when the
application ends), and a run that was killed leaves a folder whose record is
not renewed any more: the next run removes it once the record has expired.
"""

from __future__ import annotations

import atexit
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from affinity.session import checkpoint_dir

PREFIX = "affinity-run-"
OWNER = "_owner.json"
#: Seconds after which a folder whose record was not renewed belongs to no live run.
EXPIRY = 24 * 3600.0


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


class Run:
    """``keep`` tables, then ``close``; also a context manager."""

    def __init__(self, spark: SparkSession, expiry: float = EXPIRY):
        self.spark, self.expiry, self.count, self.closed = spark, expiry, 0, False
        self.endings = []
        self.base = checkpoint_dir(spark).rstrip("/")
        sweep(spark)
        self.path = f"{self.base}/{PREFIX}{uuid.uuid4().hex}"
        self.renew()
        atexit.register(self.close)

    def renew(self) -> None:
        """Write the owner record: which application, and until when the folder is its."""
        path, fs = _fs(self.spark, f"{self.path}/{OWNER}")
        out = fs.create(path, True)
        out.write(json.dumps({"app": self.spark.sparkContext.applicationId, "expires": time.time() + self.expiry}).encode())
        out.close()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back with its known schema: lineage ends here, and a lost executor costs a re-read."""
        self.count += 1
        path = f"{self.path}/{self.count:03d}-{name}"
        df.write.mode("overwrite").parquet(path)
        self.renew()
        return self.spark.read.schema(df.schema).parquet(path)

    def at_close(self, ending) -> None:
        """Something to do before the folder goes, such as taking a table out of the catalog."""
        self.endings.append(ending)

    def close(self) -> None:
        if not self.closed:
            self.closed = True
            atexit.unregister(self.close)
            if self.spark.sparkContext._jsc is not None:  # None: the application has ended, the next run sweeps
                for ending in self.endings:
                    ending()
                path, fs = _fs(self.spark, self.path)
                fs.delete(path, True)

    def __enter__(self) -> "Run":
        return self

    def __exit__(self, *_) -> None:
        self.close()


def sweep(spark: SparkSession, now: float | None = None) -> list[str]:
    """Remove the folders of runs whose record has expired; returns their names.
    A folder whose record can't be read (its run has just begun) stays."""
    base, fs = _fs(spark, checkpoint_dir(spark))
    gone = []
    for status in fs.listStatus(base) if fs.exists(base) else []:
        name = status.getPath().getName()
        if not name.startswith(PREFIX):
            continue
        record = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), OWNER)
        try:
            raw = fs.open(record)
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(raw, "UTF-8")
            raw.close()
            expires = json.loads(text)["expires"]
        except Exception:  # gone meanwhile, or not yet written
            continue
        if expires < (time.time() if now is None else now):
            fs.delete(status.getPath(), True)
            gone.append(name)
    return gone
