"""Fitted models by what they were fitted from.

A model's key is a digest of its configuration and of its training matrix, so
a comparison, a grid's second stage or a later run that asks for the same fit
gets the saved model.  The matrix enters by its row count and two
order-independent sums of row hashes (one pass, one row), so a changed row, and
any other parameter, is another key and is fitted anew.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Callable
from concurrent.futures import Future

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def matrix_digest(matrix: DataFrame) -> list:
    """What tells one training matrix from another, whatever its order and partitions."""
    row = F.struct(*matrix.columns)
    sums = [F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return list(matrix.agg(F.count(F.lit(1)), *sums).first())


class FitRegistry:
    """Models under ``path``, one folder for each key, with a record of the configuration."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fits = 0
        self._lock, self._open = threading.Lock(), {}

    def key(self, config: dict, matrix: DataFrame) -> str:
        said = json.dumps([sorted(config.items()), matrix_digest(matrix)], default=str)
        return hashlib.sha256(said.encode()).hexdigest()

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def model(self, config: dict, matrix: DataFrame, fit: Callable[[], ALSModel]) -> ALSModel:
        """The saved model of this configuration and matrix, or ``fit()``'s, saved.
        Threads that ask for the same key wait for the first one's fit.  What is
        held is the model as read back: the fitted one, with its cached factors and the
        shuffles of its last iterations, is let go."""
        key = self.key(config, matrix)
        with self._lock:
            mine = key not in self._open
            turn = self._open.setdefault(key, Future())
        if not mine:
            return turn.result()
        try:
            turn.set_result(self._load_or_fit(f"{self.path}/{key}", config, fit))
        except BaseException as e:
            with self._lock:
                del self._open[key]  # the next one to ask tries again
            turn.set_exception(e)
        return turn.result()

    def _load_or_fit(self, path: str, config: dict, fit: Callable[[], ALSModel]) -> ALSModel:
        if self._exists(f"{path}/record/_SUCCESS"):  # written last: a fit that was cut short has none
            return ALSModel.load(f"{path}/model")
        with self._lock:
            self.fits += 1
        fit().write().overwrite().save(f"{path}/model")
        record = [(k, str(v)) for k, v in sorted(config.items())]
        self.spark.createDataFrame(record, "name string, value string").coalesce(1).write.mode("overwrite").json(f"{path}/record")
        return ALSModel.load(f"{path}/model")
