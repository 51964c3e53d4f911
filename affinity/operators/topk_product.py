"""Top-k inner products per user without the users x items product as a table.

Items are numbered by falling norm and cut into blocks.  Users are dealt to
chunks, at least as many as there are cores; a chunk is one task, which holds
its users with their lists and reads the blocks one after the other.  By
Cauchy-Schwarz no item of a block scores above |user| * (greatest norm of the
block), so a user with a full list is scored only against blocks that can
still reach its last score, which rises from block to block.

A (user, block) score is a float product first; what comes within its rounding
error of the list is scored again in double.  Factors travel packed, some
``PACK`` bytes a row, and an item is sent once to each chunk: what is shuffled is the
items times the chunks, and no partial list ever.  A chunk holds at most ``USERS``
users, so a task's memory is bounded by their lists and one block.  Items a
user has seen come to the task with the block they lie in and are left out
while scoring: no list is ever longer than k, however much a user has seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.numbering import dense_numbers
from affinity.sources.scratch import Run

#: Items of a block, users of a chunk (fewer if lists are long), users that are scored at once.
ITEMS, USERS, AT_ONCE = 4096, 65536, 256
#: Users that are worth a chunk of their own; numbers in the lists of a chunk; bytes of factors in a packed row.
SHARE, LISTS, PACK = 1024, 1 << 23, 4096
#: Relative slack of the norm bound over float scores, and of a float product for each factor.
SLACK, ROUNDING = 1e-5, 1.2e-7

NOTHING = np.iinfo(np.int64).min  # a free place in a list
_USERS, _SEEN, _ITEMS = range(3)  # what a packed row holds, in the order of arrival
_LISTS = "user_id int, books array<int>, scores array<float>, n_scored bigint"


def _norm(c: str = "features"):
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, id, features or another id) -> (at, ids, values): rows of one ``at`` together, as bytes."""
    for batch in batches:
        at = batch.column(0).to_numpy(zero_copy_only=False)
        ids = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
        last = batch.column(2)
        flat = last.flatten() if pa.types.is_list(last.type) else last
        values = flat.to_numpy(zero_copy_only=False)
        values = values.astype(np.float32 if pa.types.is_list(last.type) else np.int32).reshape(len(ids), -1 if len(ids) else 1)
        order = np.argsort(at, kind="stable")
        at, ids, values = at[order], ids[order], values[order]
        step = max(1, PACK // (4 * max(values.shape[1], 1)))
        out = []
        ends = [*(np.flatnonzero(np.diff(at)) + 1), len(at)]
        for a, b in zip([0, *ends[:-1]], ends):
            out += [(at[i], ids[i:min(i + step, b)].tobytes(), values[i:min(i + step, b)].tobytes()) for i in range(a, b, step)]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()),
                                          pa.array([x[2] for x in out], pa.binary())], ["at", "ids", "vals"])


def _packed(df: DataFrame) -> DataFrame:
    return df.mapInArrow(_pack, "at int, ids binary, vals binary")


def _keys(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """One number for (score, item), in the order of the lists: greater scores above, then smaller ids."""
    bits = (score + np.float32(0)).view(np.int32)
    bits = bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))
    return (bits.astype(np.int64) << 32) | (0x7FFFFFFF - ids.astype(np.int64))


def _scores(keys: np.ndarray) -> np.ndarray:
    bits = (keys >> 32).astype(np.int32)
    return (bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))).view(np.float32)


def _true(flags: np.ndarray) -> np.ndarray:
    """Places of the flags that hold, few of many: eight are looked at as one number."""
    whole = len(flags) // 8 * 8
    words = np.flatnonzero(flags[:whole].view(np.uint64))
    word, place = np.nonzero(flags[:whole].reshape(-1, 8)[words])
    return np.concatenate([words[word] * 8 + place, whole + np.flatnonzero(flags[whole:])])


class _Chunk:
    """The users of a chunk and their lists so far."""

    def __init__(self, ids: np.ndarray, features: np.ndarray, k: int):
        order = np.argsort(ids)
        self.ids, self.features, self.k = ids[order], features[order], k
        self.exact = self.features.astype(np.float64)
        self.norm = np.sqrt((self.exact ** 2).sum(axis=1))
        self.lists = np.full((len(ids), k), NOTHING)
        self.least = np.full(len(ids), NOTHING)  # last key of each list
        self.scored = np.zeros(len(ids), np.int64)

    def meet(self, ids: np.ndarray, features: np.ndarray, seen_user: np.ndarray, seen_item: np.ndarray) -> None:
        """Score a block of items against the users it can still reach."""
        exact = features.astype(np.float64)
        limit = np.sqrt((exact ** 2).sum(axis=1)).max()
        bound = np.where(self.least == NOTHING, -np.inf, _scores(self.least).astype(np.float64))
        active = np.flatnonzero((bound == -np.inf) | (self.norm * limit * (1 + SLACK) + 1e-30 >= bound))
        self.scored[active] += len(ids)
        slack = self.norm * limit * ROUNDING * (features.shape[1] + 2) + 1e-30
        by_id = np.argsort(ids)
        row = np.searchsorted(self.ids, seen_user)
        col = by_id[np.searchsorted(ids, seen_item, sorter=by_id)] if len(seen_item) else seen_item
        across = np.ascontiguousarray(features.T)
        for at in range(0, len(active), AT_ONCE):
            own = active[at:at + AT_ONCE]
            near = self.features[own] @ across
            if len(row):
                mine = (row >= own[0]) & (row <= own[-1])
                place = np.searchsorted(own, row[mine])
                held = own[place] == row[mine]
                near[place[held], col[mine][held]] = -np.inf
            reach = bound[own] - slack[own]
            free = np.flatnonzero(bound[own] == -np.inf)
            if len(free) and self.k < len(ids):  # no list yet: what can be among the best of this block
                kth = np.partition(near[free], len(ids) - self.k, axis=1)[:, len(ids) - self.k]
                reach[free] = kth - 2 * slack[own[free]]
            good = near >= np.nan_to_num(reach, nan=-np.inf)[:, None].astype(np.float32)
            r, c = np.divmod(_true(good.reshape(-1)), len(ids))
            r, c = r[near[r, c] > -np.inf], c[near[r, c] > -np.inf]
            key = _keys(np.einsum("ij,ij->i", self.exact[own[r]], exact[c]).astype(np.float32), ids[c])
            better = key > self.least[own[r]]
            self.merge(own[r[better]], key[better])

    def merge(self, users: np.ndarray, key: np.ndarray) -> None:
        """Put keys into their users' lists (``users`` ascending)."""
        if len(users):
            rows, first, n = np.unique(users, return_index=True, return_counts=True)
            width = n.max()
            both = np.full((len(rows), self.k + width), NOTHING)
            both[:, :self.k] = self.lists[rows]
            both[np.repeat(np.arange(len(rows)), n), self.k + np.arange(len(users)) - np.repeat(first, n)] = key
            best = np.partition(both, width, axis=1)[:, width:]
            self.lists[rows], self.least[rows] = best, best[:, 0]

    def out(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.ids), AT_ONCE * 4):
            some = slice(at, at + AT_ONCE * 4)
            keys = -np.sort(-self.lists[some], axis=1) if self.k else self.lists[some]
            held = keys != NOTHING
            ends = pa.array(np.concatenate([[0], held.sum(axis=1).cumsum()]), pa.int32())
            keys = keys[held]
            books = (0x7FFFFFFF - (keys & 0xFFFFFFFF)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[some], pa.int32()), pa.ListArray.from_arrays(ends, pa.array(books)),
                 pa.ListArray.from_arrays(ends, pa.array(_scores(keys))), pa.array(self.scored[some])],
                ["user_id", "books", "scores", "n_scored"])


def _lists(k: int):
    """Packed rows, sorted by chunk, block and kind -> the lists of the chunk's users."""

    def runs(batches):
        """Runs of rows with equal (chunk, block, kind), over the ends of batches."""
        key, ids, values = None, [], []
        for batch in batches:
            for *at, i, v in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if at != key:
                    if key is not None:
                        yield key, np.frombuffer(b"".join(ids), np.int32), b"".join(values)
                    key, ids, values = at, [], []
                ids.append(i)
                values.append(v)
        if key is not None:
            yield key, np.frombuffer(b"".join(ids), np.int32), b"".join(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, nothing = None, None, np.empty(0, np.int32)
        seen = nothing, nothing
        for (at, _, kind), ids, values in runs(batches):
            if at != chunk:
                if held is not None:
                    yield from held.out()
                chunk, held, seen = at, None, (nothing, nothing)
            if kind == _USERS:
                held = _Chunk(ids, np.frombuffer(values, np.float32).reshape(len(ids), -1), k)
            elif kind == _SEEN:
                seen = ids, np.frombuffer(values, np.int32)
            elif held is not None:
                held.meet(ids, np.frombuffer(values, np.float32).reshape(len(ids), -1), *seen)
                seen = nothing, nothing
        if held is not None:
            yield from held.out()

    return run


def top_products(users: DataFrame, items: DataFrame, k: int, run: Run, seen: DataFrame | None = None,
                 block: int = ITEMS, chunk: int = USERS) -> tuple[DataFrame, DataFrame]:
    """``users`` (user_id, features), ``items`` (book_id, features), ``seen`` (user_id,
    book_id) -> lists ``(user_id, rank, book_id, score)``, best first, ties by item,
    and ``(user_id, n_scored)``: how many items each user was scored against."""
    spark = users.sparkSession
    users = run.keep(users.select("user_id", "features"), "users")
    items = dense_numbers(items.select("book_id", "features", _norm().alias("norm")), [F.col("norm").desc(), F.col("book_id")], run)
    items = items.select(F.floor(F.col("number") / F.lit(block)).cast("int").alias("blk"), "book_id", "features")
    n = users.count()
    most = max(1, min(chunk, LISTS // max(k, 1)))
    chunks = max(1, -(-n // most), min(spark.sparkContext.defaultParallelism, -(-n // SHARE)))
    at = F.pmod(F.xxhash64("user_id"), F.lit(chunks)).cast("int")

    def rows(packed: DataFrame, chunk, blk, kind: int) -> DataFrame:
        return packed.select(chunk.alias("chunk"), blk.cast("int").alias("blk"), F.lit(kind).alias("kind"), "ids", "vals")

    everywhere = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    stream = rows(_packed(users.select(at, "user_id", "features")), F.col("at"), F.lit(-1), _USERS).unionByName(
        rows(_packed(items), everywhere, F.col("at"), _ITEMS))
    if seen is not None:
        seen = (seen.select("user_id", "book_id").distinct().join(users.select("user_id"), "user_id", "left_semi")
                .join(items.select("book_id", "blk"), "book_id"))
        # the pair of chunk and block as one number while packing: blocks beyond 2^31 / chunks would need more items than ids
        own = _packed(seen.select((F.col("blk") * F.lit(chunks) + at).cast("int"), "user_id", "book_id"))
        stream = stream.unionByName(rows(own, F.pmod("at", F.lit(chunks)), F.floor(F.col("at") / F.lit(chunks)), _SEEN))
    stream = stream.repartitionById(chunks, F.col("chunk")).sortWithinPartitions("chunk", "blk", "kind")
    lists = run.keep(stream.mapInArrow(_lists(k), _LISTS), "lists")
    ranked = lists.select("user_id", F.posexplode(F.arrays_zip("books", "scores")).alias("pos", "one")).select(
        "user_id", (F.col("pos") + 1).alias("rank"), F.col("one.books").alias("book_id"), F.col("one.scores").cast("double").alias("score"))
    return ranked, lists.select("user_id", "n_scored")
