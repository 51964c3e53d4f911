"""Hard negatives: for each anchor and positive the best rows of another label
whose inner product with the anchor lies in a window below the positive's.

*Packing.*  Rows are packed sort-tile-recursively: slabs by the first
component, within them tiles by the second (equal components are parted by a
hash of the key, so a common vector fills many tiles), and within a tile
halves by one component after another down to leaves.  Nodes over the leaves
hold the least and greatest value of each component, and so an interval for
the inner product with any anchor.

*Search.*  An anchor's queue is ordered by the intervals' upper ends.  It takes
the best boxes first, opens those that may still hold a result, and leaves out
the ones outside the score windows or strictly below a full list's last score
(an equal one may hold a smaller key).  A task takes ``AT_ONCE`` anchors side by
side: boxes of a few hundred rows in the order of the highest upper end, each
against the anchors it can still serve, as one product of matrices.  The first search is within the anchor's
own tile; its fifth score then keeps the anchor from tiles whose box is lower.
Next come the positives in all tiles that are left, then the negatives in the
tiles that meet a window.

*Spark.*  Tiles are rows with a tile number, dealt out by it.  The tiles' boxes
(at most ``MAX_TILES``) go to the tasks that send each anchor to the tiles it
needs.  Many anchors are cut into blocks, so a task holds one tile and at most
about ``BLOCK`` anchors.  Best lists of tiles are merged by rank.

Defined results: rows with a null key, null label, null vector, or a null, NaN
or infinite component take no part; shorter vectors end in zeros; components
of 2**26 or more after scaling are refused with an error; rows that share a
key (repeated rows) are one row, the least by label and vector; ties in score
go to the smaller key; an anchor without positives, and a positive without a
negative in its window, give no rows; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from affinity.llm import vectors
from affinity.llm.store import Store

#: Rows of a leaf, nodes under a node.
LEAF, FAN = 32, 8
#: Rows of a tile: as many as make WANTED tiles, between these bounds, until there are MAX_TILES tiles.
SMALLEST, LARGEST, WANTED, MAX_TILES = 512, 65536, 64, 65536
#: Anchors that a task searches one tile for.
BLOCK = 65536
#: Anchors searched side by side, the level of the boxes they share.
AT_ONCE, SHARED = 512, 1
#: No bound of a window.
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Tree:
    """A packed R-tree over the rows of one tile."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, v: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        order = np.argsort(keys, kind="stable")
        edges = np.array([0, len(keys)])
        for c in np.argsort(np.min(v, 0) - np.max(v, 0), kind="stable") if len(keys) else ():  # the widest components first
            if np.diff(edges).max() <= leaf:
                break
            slab = np.searchsorted(edges, np.arange(len(order)), "right")
            order = order[np.lexsort((v[order, c], slab))]
            edges = np.unique(np.concatenate([edges, (edges[:-1] + edges[1:]) // 2]))
        while np.diff(edges).max(initial=0) > leaf:  # more halvings than components
            edges = np.unique(np.concatenate([edges, (edges[:-1] + edges[1:]) // 2]))
        self.keys, self.labels, self.edges = keys[order], labels[order], edges
        exact = len(v) and int(np.abs(v).max()) ** 2 * v.shape[1] < 1 << 52
        self.v = v[order].astype(np.float64) if exact else v[order]  # float products of such numbers are exact, and faster
        self.levels = []
        low, high, at = self.v, self.v, edges[:-1]
        while len(low):
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            self.levels.append((low, high))
            if len(low) == 1:
                break
            at = np.arange(0, len(low), fan)
        self.fan = fan

    def interval(self, level: int, first: int, last: int, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product with up - down for nodes first to last."""
        low, high = (x[first:last] for x in self.levels[level])
        return low @ up - high @ down, high @ up - low @ down

    def rows(self, leaves: list[int]) -> np.ndarray:
        if len(leaves) == 1:
            return np.arange(self.edges[leaves[0]], self.edges[leaves[0] + 1])
        return np.concatenate([np.arange(self.edges[k], self.edges[k + 1]) for k in leaves])

    def search(self, key: int, label: int, vector: np.ndarray, windows: list[tuple[float, float]], k: int,
               same: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (low, high) the best k (score, key) of the rows with the
        same label (without ``key``) or of those with another, best first."""
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        if not self.levels:
            return best
        need = [low for low, _ in windows]
        vector = vector.astype(self.v.dtype)
        up, down = np.maximum(vector, 0), np.maximum(-vector, 0)
        queue: list[tuple[float, int, int, float]] = []

        def put(level: int, first: int, last: int) -> None:
            low, high = self.interval(level, first, last, up, down)
            live = np.zeros(len(low), bool)
            for n, (_, top) in zip(need, windows):
                live |= (high >= n) & (low <= top)
            for j in np.flatnonzero(live).tolist():
                heapq.heappush(queue, (-high[j], level, first + j, low[j]))

        put(len(self.levels) - 1, 0, 1)
        width = 1
        while queue:
            leaves = []
            while queue and len(leaves) < width:
                high, level, node, low = heapq.heappop(queue)
                if not any(-high >= n and low <= top for n, (_, top) in zip(need, windows)):
                    continue
                if level:
                    put(level - 1, node * self.fan, min((node + 1) * self.fan, len(self.levels[level - 1][0])))
                else:
                    leaves.append(node)
            if not leaves:
                break
            width *= 2  # the first boxes set the bar, then more are scored at once
            at = self.rows(leaves)
            fit = (self.labels[at] == label) & (self.keys[at] != key) if same else self.labels[at] != label
            score = self.v[at] @ vector
            for w, (_, top) in enumerate(windows):
                own = np.flatnonzero(fit & (score >= need[w]) & (score <= top))
                if len(own):
                    s = np.concatenate([best[w][0], score[own].astype(np.int64)])
                    i = np.concatenate([best[w][1], self.keys[at[own]]])
                    first = np.lexsort((i, -s))[:k]
                    best[w] = s[first], i[first]
                    if len(first) == k:
                        need[w] = max(need[w], s[first[-1]])
        return best


    def search_all(self, keys: np.ndarray, labels: np.ndarray, vectors_: np.ndarray, lows: np.ndarray, tops: np.ndarray, k: int,
                   same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``search`` for anchors side by side, windows a row each (low above top: none): (anchor's row, window, score, key)."""
        out = [self._search_some(at, keys[at:at + AT_ONCE], labels[at:at + AT_ONCE], vectors_[at:at + AT_ONCE], lows[at:at + AT_ONCE],
                                 tops[at:at + AT_ONCE], k, same) for at in range(0, len(keys) if self.levels else 0, AT_ONCE)]
        return tuple(np.concatenate([o[c] for o in out] or [np.empty(0, np.int64)]) for c in range(4))

    def _search_some(self, start, keys, labels, vector, lows, tops, k, same):
        # Products and sums of such numbers are exact in floats, and so are the intervals' differences.
        most = 2 * int(np.abs(vector).max(initial=0)) * int(np.abs(self.v).max(initial=0)) * max(1, vector.shape[1])
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        vector, rows = vector.astype(kind), self.v.astype(kind, copy=False)
        lows, tops, windows = lows.astype(kind), tops.astype(kind), lows.shape[1]
        need = lows.copy()
        level = min(SHARED, len(self.levels) - 1)
        up, down = np.maximum(vector, 0), np.maximum(-vector, 0)
        low, high = (x.astype(kind, copy=False).T for x in self.levels[level])
        least, most = up @ low - down @ high, up @ high - down @ low
        per = self.fan ** level
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))] * windows  # (anchor, score, key), best first
        for node in np.argsort(-most.max(0), kind="stable").tolist():
            live = ((most[:, node, None] >= need) & (least[:, node, None] <= tops)).any(1)
            own = np.flatnonzero(live)
            if not len(own):
                continue
            some = slice(self.edges[node * per], self.edges[min((node + 1) * per, len(self.edges) - 1)])
            score = vector[own] @ rows[some].T
            fit = self.labels[some] == labels[own, None]
            fit = fit & (self.keys[some] != keys[own, None]) if same else ~fit
            for w in range(windows):
                good = fit & (score >= need[own, w, None]) & (score <= tops[own, w, None])
                if good.sum() > 4 * k * len(own):  # only what can be among the best of this box
                    held = np.where(good, score, kind(-np.inf) if kind != np.int64 else LEAST)
                    good &= held >= np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k, None]
                r, c = np.nonzero(good)
                if len(r):
                    a, s, i = (np.concatenate(x) for x in zip(found[w], (own[r], score[r, c].astype(np.int64), self.keys[some][c])))
                    order = np.lexsort((i, -s, a))
                    a = a[order]
                    first = np.searchsorted(a, a)
                    kept = np.arange(len(a)) - first < k
                    found[w] = a[kept], s[order[kept]], i[order[kept]]
                    full = np.flatnonzero((np.arange(len(a)) - first) == k - 1)  # an anchor's k-th
                    need[a[full], w] = np.maximum(need[a[full], w], s[order[full]].astype(kind))
        return (np.concatenate([f[0] for f in found]) + start, np.repeat(np.arange(windows), [len(f[0]) for f in found]),
                np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found]))


def _bounds(lists: pd.Series, nothing: int, beyond: int) -> np.ndarray:
    """Windows' bounds, an anchor a row: null is ``nothing``, rows that have fewer end in ``beyond``."""
    column = pa.array(lists, pa.list_(pa.int64()))
    size = pc.list_value_length(column).to_numpy()
    out = np.full((len(column), size.max(initial=0)), beyond, np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().fill_null(nothing).to_numpy()
    return out


def tiles(rows: DataFrame, n: int, store: Store, size: int) -> DataFrame:
    """``rows`` (key, label, v) with their tile, stored."""
    count = max(1, min(MAX_TILES, -(-n // size)))
    slabs = int(np.ceil(np.sqrt(count)))
    per = -(-count // slabs)
    part = lambda seed: F.shiftrightunsigned(F.xxhash64("key", F.lit(seed)), 11) / F.lit(float(1 << 53))
    at = lambda i: F.coalesce(F.get("v", F.lit(i)), F.lit(0)).cast("double") + part(i)
    cuts = lambda c, m: F.percentile_approx(c, [k / m for k in range(1, m)], 10 * max(m, 1000)) if m > 1 else F.array().cast("array<double>")
    spots = rows.select(at(0).alias("x"), at(1).alias("y"))
    xs = spots.agg(cuts("x", slabs).alias("x")).first()["x"] or []  # at most 256 numbers, and as many for each slab
    below = lambda c, bounds: F.size(F.filter(bounds, lambda b: b < c))
    wall = F.array(*[F.lit(b) for b in xs]) if xs else F.array().cast("array<double>")
    ys = spots.withColumn("slab", below(F.col("x"), wall)).groupBy("slab").agg(cuts("y", per).alias("ys"))
    placed = rows.withColumn("slab", below(at(0), wall)).join(F.broadcast(store.keep(ys, "cuts")), "slab")
    return store.keep(placed.select("key", "label", "v", "anchor", (F.col("slab") * per + below(at(1), F.col("ys"))).cast("int").alias("tile")), "tiles")


def _arrow(column: pd.Series, width: int) -> np.ndarray:
    return vectors.matrix(pa.array(column, pa.list_(pa.int64())), width)


def _tree(held: pd.DataFrame, width: int) -> Tree:
    return Tree(held.key.to_numpy(np.int64), held.label.to_numpy(np.int64), _arrow(held.v, width))


def _home(tiled: DataFrame, width: int, k: int) -> DataFrame:
    """A row (tile, low, high) for each tile's box, and (tile, key, bound) for each anchor with k positives in its own tile."""

    def run(key, held: pd.DataFrame) -> pd.DataFrame:
        tree = _tree(held, width)
        low, high = tree.levels[-1]
        out = [(key[0], low[0].astype(np.int64), high[0].astype(np.int64), None, None)]
        own = held[held.anchor]
        names = own.key.to_numpy(np.int64)
        lows, tops = (np.full((len(own), 1), x) for x in (LEAST, MOST))
        at, _, score, _ = tree.search_all(names, own.label.to_numpy(np.int64), _arrow(own.v, width), lows, tops, k, True)
        rank = np.arange(len(at)) - np.searchsorted(at, at)  # an anchor's scores stand together, the best first
        out += [(key[0], None, None, names[a], s) for a, s in zip(at[rank == k - 1], score[rank == k - 1])]
        return pd.DataFrame(out, columns=["tile", "low", "high", "key", "bound"]).astype({"key": "Int64", "bound": "Int64"})

    return tiled.groupBy("tile").applyInPandas(run, "tile int, low array<bigint>, high array<bigint>, key bigint, bound bigint")


def _sent(anchors: DataFrame, boxes: tuple, width: int) -> DataFrame:
    """Anchors (key, label, v, lows, tops) to each tile whose box meets one of their windows."""
    names, low, high = boxes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                v = vectors.matrix(some.column(2), width)
                up, down = np.maximum(v, 0), np.maximum(-v, 0)
                least, most = up @ low.T - down @ high.T, up @ high.T - down @ low.T
                meets = np.zeros(least.shape, bool)
                for r, (lows, tops) in enumerate(zip(some.column(3).to_pylist(), some.column(4).to_pylist())):
                    for a, b in zip(lows, tops):
                        meets[r] |= (most[r] >= (-np.inf if a is None else a)) & (least[r] <= (np.inf if b is None else b))
                row, tile = np.nonzero(meets)
                took = some.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(names[tile], pa.int32())] + took.columns, names=["tile"] + took.schema.names)

    schema = "tile int, key bigint, label bigint, v array<bigint>, lows array<bigint>, tops array<bigint>"
    return anchors.mapInArrow(run, schema)


def _searched(tiled: DataFrame, anchors: DataFrame, boxes: tuple, width: int, blocks: int, k: int, same: bool) -> DataFrame:
    """(anchor, top, score, key): best k of each tile for each window of each anchor."""
    sent = _sent(anchors, boxes, width).withColumn("blk", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
    held = tiled.select("tile", "key", "label", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("blk"))

    def run(key, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame({c: pd.Series(dtype="Int64") for c in ("anchor", "top", "score", "key")})
        names, lows, tops = asked.key.to_numpy(np.int64), _bounds(asked.lows, LEAST, MOST), _bounds(asked.tops, MOST, LEAST)
        at, window, score, other = _tree(held, width).search_all(
            names, asked.label.to_numpy(np.int64), _arrow(asked.v, width), lows, tops, k, same)
        top = tops[at, window]
        return pd.DataFrame({"anchor": names[at], "top": pd.array(top, "Int64"), "score": score, "key": other}).assign(
            top=lambda d: d.top.mask(top == MOST))

    return held.groupBy("tile", "blk").cogroup(sent.groupBy("tile", "blk")).applyInPandas(
        run, "anchor bigint, top bigint, score bigint, key bigint")


def hard_negatives(df: DataFrame, anchor: Column, vector: str = "embedding", key: str = "vec_id", label: str = "label",
                   scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   size: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is true for the rows that are anchors; the window of a positive
    of score p holds the scores s with low * p <= 100 * s <= high * p."""
    store = Store(df.sparkSession, "negatives")
    rows = df.where(vectors.whole(vector) & F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).cast("bigint").alias("key"), F.col(label).cast("bigint").alias("label"),
        vectors.floors(vector, scale).alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    one = rows.groupBy("key").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("key", "r.*")
    rows = store.keep(one, "rows")
    n, m, width = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("v"))).first()
    width = max(1, width or 0)
    size = size or max(SMALLEST, min(LARGEST, -(-n // WANTED)))
    blocks = max(1, -(-m // BLOCK))
    tiled = tiles(rows, n, store, size)
    home = store.keep(_home(tiled, width, positives), "home")
    found = home.where("low IS NOT NULL").select("tile", "low", "high").toPandas()  # a row for each tile
    boxes = (found.tile.to_numpy(np.int64), *(np.array(found[c].tolist(), np.int64).reshape(-1, width) for c in ("low", "high")))
    asking = tiled.where("anchor").select("key", "label", "v")
    bound = home.where("key IS NOT NULL").select("key", "bound")
    everything = F.lit(None).cast("bigint")
    first = asking.join(bound, "key", "left").select("key", "label", "v", F.array("bound").alias("lows"), F.array(everything).alias("tops"))
    good = _searched(tiled, first, boxes, width, blocks, positives, True)
    ranked = lambda d, by, k: d.withColumn("rank", F.row_number().over(
        Window.partitionBy(*by).orderBy(F.col("score").desc(), "key"))).where(F.col("rank") <= k)
    good = store.keep(ranked(good, ["anchor"], positives).select("anchor", F.col("key").alias("positive"), F.col("score").alias("p")), "positives")
    # Integer bounds of the window: low * p <= 100 * s <= high * p.
    least, top = F.expr(f"-floor(cast(-{low} * p AS decimal(38, 0)) / 100)").cast("bigint"), F.expr(
        f"floor(cast({high} * p AS decimal(38, 0)) / 100)").cast("bigint")
    windows = good.select("anchor", least.alias("least"), top.alias("top")).where("least <= top").groupBy("anchor").agg(
        F.sort_array(F.collect_set(F.struct("top", "least"))).alias("w"))  # as many as positives at most
    second = asking.join(windows, asking.key == windows.anchor).select(
        "key", "label", "v", F.col("w.least").alias("lows"), F.col("w.top").alias("tops"))
    bad = _searched(tiled, second, boxes, width, blocks, negatives, False)
    bad = ranked(bad, ["anchor", "top"], negatives)
    out = good.withColumn("top", top).join(bad, ["anchor", "top"])
    return out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      F.col("key").alias("negative_id"), F.col("p").alias("positive_score"), F.col("score").alias("negative_score"))


QUERY = "op12_hard_negatives"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(df.withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH k AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM k a JOIN k b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b, s.b AS other, p.score AS ps, s.score AS ns,
             row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT a AS anchor_id, b AS positive_id, r::INTEGER AS rank, other AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE r <= 5
"""
