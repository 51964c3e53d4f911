"""Row-wise Arrow maps over a text column, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text that a Python step takes at once; one longer text is a piece of its own.
PIECE = 2 << 20


def pieces(sizes: list[int], limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to at most ``limit``, one index at least."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def text_pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, list[str]]]:
    """Index ranges of a text column and their texts; only one range at a time becomes Python strings."""
    for i, j in pieces(pc.binary_length(column).to_pylist(), limit):
        yield i, j, column.slice(i, j - i).to_pylist()


def map_texts(df: DataFrame, text: str, keep: list[str], added: str | T.StructType,
              step: Callable[[list[str]], list[list]]) -> DataFrame:
    """``keep`` columns of every row beside the columns of ``added``.

    ``step`` gets a list of whole texts (null: empty) and returns one list of
    values for each added column, or None for no rows at all.  Other columns of
    ``df`` are never read, so clashing names there don't matter."""
    added = T._parse_datatype_string(added) if isinstance(added, str) else added
    d = df.select(*[F.col(k) for k in keep], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    out = T.StructType(d.schema.fields[:-1] + added.fields)
    arrow = to_arrow_schema(added)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, texts in text_pieces(b.column(n)):
                cols = step(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(i, j - i) for k in range(n)]
                    + [pa.array(c, f.type) for c, f in zip(cols, arrow)],
                    names=keep + arrow.names)

    return d.mapInArrow(run, out)


def gather_texts(df: DataFrame, text: str, out: str, start: Callable[[], object],
                 step: Callable[[object, list[str]], None],
                 finish: Callable[[object], Iterator[pa.RecordBatch] | list[list]]) -> DataFrame:
    """One accumulator for each task: ``start()``, ``step(acc, texts)`` for each
    piece, ``finish(acc)`` gives the columns of its rows."""
    schema = T._parse_datatype_string(out)
    arrow = to_arrow_schema(schema)
    d = df.select(F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = start()
        for b in batches:
            for _, _, texts in text_pieces(b.column(0)):
                step(acc, texts)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(finish(acc), arrow)], names=arrow.names)

    return d.mapInArrow(run, schema)
