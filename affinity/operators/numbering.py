"""Dense numbers for the rows of a distributed order.

``row_number()`` over everything would sort in one task.  Here the rows are
dealt by ranges of the order, sorted within them, and written once; a row's
number is its place in its range plus the sizes of the ranges before, which
are as many numbers as there are partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.sources.scratch import Run

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, place in the partition below


def dense_numbers(df: DataFrame, order: list[Column], run: Run, name: str = "number") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in ``order``, which must be a total order of the rows."""
    placed = run.keep(df.repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn("_m", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_m", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))  # a row for each partition
    offsets = sizes.select("_p", F.coalesce(before, F.lit(0)).alias("_before"))
    return (placed.withColumn("_p", part).join(F.broadcast(offsets), "_p")
            .withColumn(name, F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
            .drop("_p", "_m", "_before"))
