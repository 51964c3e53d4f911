"""Near duplicates by SimHash fingerprints, found with a Gray-order hierarchical index.

*Fingerprint.*  Bit b is 1 if it is set in over half of the XXH64 values (seed
42) of a text's three-word shingles, repeats included.

*Index.*  Distinct fingerprints sorted by Gray rank (neighbours in that order
differ in one bit) are cut into groups of consecutive ranks.  A node of the
index covers a run of them and holds the bits that all of them share: a
pattern and a mask.  Masks only gain bits on the way down, so the differences
between two nodes' patterns under both masks add up on the way, and a pair of
nodes is left, with everything below, as soon as they exceed the radius.

*Two orders.*  Of at most r differing bits, either the high half holds at most
r // 2, or the low half at most (r - 1) // 2.  So one index has the high half
first and the other the low half, and each leaves a pair of nodes as soon as
its first half has more: with radius 2, one difference in the first order and
none in the second.  A fingerprint then reaches as many groups as their nodes
have bits, not the square of it.

*Join.*  The groups' nodes (at most ``MAX_GROUPS``, 16 bytes each) are the
upper part of the index and go to every task.  A fingerprint goes to the
groups behind its own whose node it is near enough; a group that many
fingerprints reach takes them in blocks.  Each group then builds the lower
part and runs down both sides at once.  A task returns a spanning forest of
the links it has found, so connectivity is whole and a family of near copies
makes no more edges than it has members.

Defined results: null, empty or wordless text has fingerprint zero and is
linked like any other; fewer than three words are one shingle; repeated rows
and rows that share a key each get a row; rows with a null key take part, the
component is the least key reached (null if there is none); an empty table
gives an empty result; only the key and the text column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from affinity.llm.graph import connected_components
from affinity.llm.rows import map_texts
from affinity.llm.store import Store

U64 = np.uint64
ALL = U64(0xFFFFFFFFFFFFFFFF)
HIGH = U64(0xFFFFFFFF00000000)
#: Distinct fingerprints of a group, until there are MAX_GROUPS groups; then groups grow.
GROUP = 2048
MAX_GROUPS = 65536
#: Fingerprints that a task runs down one group at once.
BLOCK = 65536
#: Nodes under a node.
FAN = 4
#: Node pairs that are compared at once.
FRONT = 1 << 18
#: Shingles whose bits are counted at once.
BITS = 1 << 16


def shingle_hashes(text: str, width: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``width`` words, or of the whole sequence if there are fewer."""
    words = text.encode().lower().split()  # bytes: only A-Z change, and only \x20 and \x09-\x0D part words
    if not words:
        return np.empty(0, U64)
    line = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - width + 1)
    start = np.concatenate([[0], end[:n - 1] + 1]).tolist()
    stop = end[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[i:j], seed) for i, j in zip(start, stop)), U64, n)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes, as a signed number."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BITS):
        part = hashes[at:at + BITS]
        total += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp) of every row, fp the 64 bits as a signed number."""
    return map_texts(docs, text, [key], "fp bigint", lambda texts: [[majority(shingle_hashes(t)) for t in texts]])


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    r = fp.copy()
    for k in (1, 2, 4, 8, 16, 32):
        r ^= r >> U64(k)
    return r


class GrayIndex:
    """Levels of (pattern, mask) nodes over items in Gray order; level 0 are the items."""

    def __init__(self, pattern: np.ndarray, mask: np.ndarray | None = None):
        self.order = np.argsort(gray_rank(pattern), kind="stable")
        pattern = pattern[self.order]
        mask = np.full(len(pattern), ALL) if mask is None else mask[self.order]
        self.levels = [(pattern & mask, mask)]
        while len(pattern := self.levels[-1][0]) > 1:
            mask, at = self.levels[-1][1], np.arange(0, len(pattern), FAN)
            ones, some = np.bitwise_and.reduceat(pattern, at), np.bitwise_or.reduceat(pattern, at)
            shared = np.bitwise_and.reduceat(mask, at) & ~(ones ^ some)
            self.levels.append((ones & shared, shared))

    def below(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``node``, child) for all children on the level below."""
        first = node * FAN
        count = np.minimum(first + FAN, len(self.levels[level - 1][0])) - first
        which = np.repeat(np.arange(len(node)), count)
        return which, first[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)


def near(x: GrayIndex, y: GrayIndex, radius: int, high: int = 64, itself: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of item numbers whose shared bits differ in at most ``radius``, of
    them ``high`` in the high half, in pieces; with ``itself`` (x is y) each
    pair of different items once."""
    if not len(x.order) or not len(y.order):
        return
    todo = [(len(x.levels) - 1, len(y.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        a, b, i, j = todo.pop()
        if len(i) > FRONT:
            half = len(i) // 2
            todo += [(a, b, i[:half], j[:half]), (a, b, i[half:], j[half:])]
            continue
        (px, mx), (py, my) = x.levels[a], y.levels[b]
        apart = (px[i] ^ py[j]) & mx[i] & my[j]
        live = (np.bitwise_count(apart) <= radius) & (np.bitwise_count(apart & HIGH) <= high)
        if itself:
            live &= (i < j) | (i == j) & (a > 0)
        i, j = i[live], j[live]
        if not len(i):
            continue
        if a == 0 and b == 0:
            yield x.order[i], y.order[j]
            continue
        if a >= b:
            which, i = x.below(a, i)
            j, a = j[which], a - 1
        if b > a or (itself and b > 0):
            which, j = y.below(b, j)
            i, b = i[which], b - 1
        todo.append((a, b, i, j))


class Forest:
    """Links of a task, kept as a star for each set of connected values."""

    def __init__(self):
        self.a, self.b, self.size = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.size += len(a)
        if self.size > 4 * FRONT:
            self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        node, at = np.unique(np.concatenate(self.a + self.b), return_inverse=True)
        i, j = at[:len(at) // 2], at[len(at) // 2:]
        root = np.arange(len(node))
        while True:
            low = np.minimum(root[i], root[j])
            new = root.copy()
            for end in (i, j):
                np.minimum.at(new, root[end], low)
                np.minimum.at(new, end, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        tied = root != np.arange(len(node))
        self.a, self.b = [node[tied]], [node[root[tied]]]
        self.size = int(tied.sum())
        return self.a[0], self.b[0]


def turned(fp: Column) -> Column:
    """The halves of a fingerprint exchanged."""
    return F.shiftleft(fp, 32).bitwiseOR(F.shiftrightunsigned(fp, 32))


def gray_groups(fps: DataFrame, store: Store, parts: int) -> DataFrame:
    """(fp, grp): ``parts`` runs of the Gray order of about equal size."""
    rank = F.col("fp")
    for k in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, k))
    dealt = fps.select("fp", rank.bitwiseXOR(F.lit(-1 << 63)).alias("rank")).repartitionByRange(parts, "rank")
    return store.keep(dealt.select("fp", F.spark_partition_id().alias("grp")), "groups")


def links(groups: DataFrame, store: Store, radius: int, high: int = 64, block: int = BLOCK) -> DataFrame:
    """(a, b) links between different fingerprints with at most ``high``
    differences in the high half, a spanning forest from each task."""
    top = groups.groupBy("grp").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("some")).orderBy("grp").toPandas()
    ids = top.grp.to_numpy(np.int64)  # at most MAX_GROUPS rows
    ones, some = (top[c].to_numpy(np.int64).view(U64) for c in ("ones", "some"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = GrayIndex(ones, ~(ones ^ some))
        for batch in batches:
            fp, own = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
            for i, j in near(GrayIndex(fp.view(U64)), upper, radius, high):
                far = ids[j] > own[i]  # pairs of groups are met once, from the lower one
                yield pa.RecordBatch.from_arrays([pa.array(ids[j][far], pa.int32()), pa.array(fp[i][far])], names=["grp", "fp"])

    asked = store.keep(groups.select("fp", "grp").mapInArrow(route, "grp int, fp bigint"), "asked")
    sizes = asked.groupBy("grp").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sizes = store.keep(sizes, "sizes")  # a row for each group
    asked = asked.join(F.broadcast(sizes), "grp").select(
        "grp", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("blk"), "fp")
    held = groups.join(F.broadcast(sizes), "grp", "left").select(
        "grp", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("blk"), "fp")

    def search(key, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        mine, others = held.fp.to_numpy(np.int64), asked.fp.to_numpy(np.int64)
        index, found = GrayIndex(mine.view(U64)), Forest()
        if key[1] == 0:
            for i, j in near(index, index, radius, high, itself=True):
                found.add(mine[i], mine[j])
        for i, j in near(GrayIndex(others.view(U64)), index, radius, high):
            found.add(others[i], mine[j])
        a, b = found.reduce()
        return pd.DataFrame({"a": a, "b": b})

    return held.groupBy("grp", "blk").cogroup(asked.groupBy("grp", "blk")).applyInPandas(search, "a bigint, b bigint")


def simhash_components(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = 2, group: int = GROUP,
                       most: int = MAX_GROUPS, block: int = BLOCK) -> DataFrame:
    """(key, fingerprint, component_id) of every row."""
    store = Store(docs.sparkSession, "simhash")
    rows = store.keep(fingerprints(docs, text, key).select(F.col(key).alias("key"), "fp"), "rows")
    classes = store.keep(rows.groupBy("fp").agg(F.min("key").alias("key")), "classes")
    parts = max(1, min(most, -(-classes.count() // group)))
    first = gray_groups(classes.select("fp"), store, parts)
    second = gray_groups(classes.select(turned(F.col("fp")).alias("fp")), store, parts)
    edges = links(first, store, radius, radius // 2, block)
    if radius > 0:
        swapped = links(second, store, radius, (radius - 1) // 2, block)
        edges = edges.union(swapped.select(turned(F.col("a")), turned(F.col("b"))))
    edges = store.keep(edges, "edges")
    labels = connected_components(edges, store)
    own = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "key", F.coalesce("label", "fp").alias("label"))
    least = own.groupBy("label").agg(F.min("key").alias("component_id"))
    member = store.keep(own.join(least, "label").select("fp", "component_id"), "member")
    store.drop(first, second, classes, edges, labels)
    return rows.join(member, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERY = "op11_simhash_join"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = None  # XXH64 has no SQL form; tested against a brute-force version
