"""Vector codes by product quantisation, codebooks by Lloyd rounds over cover trees.

Vectors are cut into equal consecutive parts, and each part position has a
codebook of at most 256 entries.

*Cover trees.*  A task deals its rows into chunks and builds one tree for each
part position of a chunk.  Points below a node lie within its radius of its
centre; a node's children have at most half the radius and centres farther
apart than that.  The points stand in tree order beside their cumulative sums,
so the sum and the count of a whole subtree are two differences.  The trees
are written once as a table and serve every round; no point is dealt out.

*Rounds.*  A node carries the entries that can be nearest to a point below it.
By the triangle inequality an entry is out when it is farther from the centre
than the nearest one by more than twice the radius.  If one is left, the
subtree goes to it as a whole; otherwise its children descend with what is
left, and at a leaf the points are compared exactly.  Ties go to the lower
index.  A task returns sums and counts for each (part, entry), which Spark
adds; the driver sees parts * entries rows a round.

Defined results: rows whose vector is null or holds null, NaN or infinite
components are dropped; shorter vectors, and widths that the parts don't
divide, end in zeros; components of 2**26 or more after scaling are refused
with an error; repeated rows each get a row; a key seeds an entry once, by its
least vector, a null key after all others; fewer keys than entries make a
shorter codebook; rows with a null label form one label; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from affinity.llm import vectors
from affinity.llm.store import Store

#: Rows of a chunk, which has a tree for each part position.
CHUNK = 4096
#: Points of a leaf at most, unless they are all equal.
LEAF = 8
#: Salts of a label in the last join.
SALTS = 32


@dataclass
class Forest:
    """Cover trees over points in tree order; the roots stand first, one for each part position."""

    points: np.ndarray  # [n, d] in tree order
    order: np.ndarray   # row that a point is of
    centre: np.ndarray  # place of a node's centre among the points
    radius: np.ndarray  # greatest squared distance of a point below from the centre
    start: np.ndarray   # points below: start to stop
    stop: np.ndarray
    child: np.ndarray   # children: child to child + children; leaves have none
    children: np.ndarray

    FIELDS = ("points", "order", "centre", "radius", "start", "stop", "child", "children")
    ARROW = ", ".join(f"{f} binary" for f in FIELDS)

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, f), "<i8" if f == "radius" else "<i4").tobytes() for f in self.FIELDS]

    @classmethod
    def unpacked(cls, raw: list[bytes], width: int) -> "Forest":
        own = [np.frombuffer(b, "<i8" if f == "radius" else "<i4").astype(np.int64) for f, b in zip(cls.FIELDS, raw)]
        return cls(own[0].reshape(-1, width), *own[1:])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(-1)


def cover_forest(points: np.ndarray, part: np.ndarray, parts: int, leaf: int = LEAF) -> Forest:
    """One cover tree for each part position, all built level by level at once."""
    at = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[at], np.arange(parts + 1))
    nodes = {f: [] for f in ("centre", "radius", "start", "stop", "child", "children")}
    start, stop, centre = edge[:-1], edge[1:], at[np.minimum(edge[:-1], len(at) - 1)]  # centre: a point, for now
    made = 0
    while len(start):
        size = stop - start
        owner = np.repeat(np.arange(len(start)), size)
        place = np.repeat(start, size) + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        far = squared(points[at[place]], points[centre[owner]])
        radius = np.zeros(len(start), np.int64)
        np.maximum.at(radius, owner, far)
        inner = (size > leaf) & (radius > 0)
        made += len(start)
        # Children: the centre itself, then again and again the first point that none is near enough to.
        mine = np.flatnonzero(inner[owner])
        place, owner, far = place[mine], owner[mine], far[mine]
        child = np.full(len(place), -1)
        child_centre, child_owner, total = [centre[inner]], [np.flatnonzero(inner)], int(inner.sum())
        number = np.cumsum(inner) - 1
        close = 4 * far <= radius[owner]
        child[close] = number[owner[close]]
        left = np.flatnonzero(~close)
        while len(left):
            head = np.concatenate([[True], owner[left][1:] != owner[left][:-1]])
            new = left[head]
            group = np.cumsum(head) - 1
            child_centre.append(at[place[new]])
            child_owner.append(owner[new])
            gap = squared(points[at[place[left]]], points[at[place[new]]][group])
            close = 4 * gap <= radius[owner[left]]
            child[left[close]] = total + group[close]
            total += len(new)
            left = left[~close]
        child_centre, child_owner = np.concatenate(child_centre), np.concatenate(child_owner)
        rank = np.argsort(child_owner, kind="stable")  # a node's children stand together
        new_name = np.empty(total, np.int64)
        new_name[rank] = np.arange(total)
        child = new_name[child]
        sort = np.argsort(child, kind="stable")  # owners ascend with children, so each stays in its range
        at[place] = at[place][sort]
        count = np.bincount(child, minlength=total)
        kids = np.bincount(child_owner, minlength=len(start))
        first = np.cumsum(kids) - kids
        for name, value in (("centre", centre), ("radius", radius), ("start", start), ("stop", stop),
                            ("child", made + first), ("children", kids)):
            nodes[name].append(value)
        begin = start[child_owner[rank]]
        within = np.cumsum(count) - count
        begin = begin + within - within[first[child_owner[rank]]] if total else begin
        start, stop, centre = begin, begin + count, child_centre[rank]
    back = np.empty(len(at), np.int64)
    back[at] = np.arange(len(at))
    own = {k: np.concatenate(v) for k, v in nodes.items()}
    own["centre"] = back[own["centre"]] if len(at) else own["centre"]
    return Forest(points[at], at, **own)


def assign(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The nearest entry of every point of every part: (start, stop, entry) of
    ranges of points in tree order, and how many point-entry distances were taken.
    ``books`` is [parts, entries, d]."""
    parts, entries, _ = books.shape
    node = np.repeat(np.arange(parts), entries)
    entry = np.tile(np.arange(entries), parts)
    part, taken = node.copy(), 0
    out = [[], [], []]

    def lowest(group: np.ndarray, gap: np.ndarray, which: np.ndarray):
        head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        best = np.minimum.reduceat(gap * entries + which, head)  # the lower index wins a tie
        return head, best // entries, best % entries

    keep = (forest.stop > forest.start)[node]
    node, entry, part = node[keep], entry[keep], part[keep]
    while len(node):
        gap = squared(forest.points[forest.centre[node]], books[part, entry])
        taken += len(gap)
        head, least, first = lowest(node, gap, entry)
        size = np.diff(np.concatenate([head, [len(node)]]))
        of = np.repeat(np.arange(len(head)), size)
        reach = np.sqrt(least) + 2 * np.sqrt(forest.radius[node[head]])
        point = forest.radius[node[head]] == 0
        stay = np.where(point[of], entry == first[of], np.sqrt(gap) <= reach[of] * (1 + 1e-9))
        node, entry, part, of = node[stay], entry[stay], part[stay], of[stay]
        single = np.bincount(of, minlength=len(head)) == 1
        whole = single[of]
        for o, v in zip(out, (forest.start[node[whole]], forest.stop[node[whole]], entry[whole])):
            o.append(v)
        leaf = ~whole & (forest.children[node] == 0)
        if leaf.any():
            n, e, p = node[leaf], entry[leaf], part[leaf]
            size = forest.stop[n] - forest.start[n]
            of = np.repeat(np.arange(len(n)), size)
            place = forest.start[n][of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            sort = np.argsort(place, kind="stable")
            of, place = of[sort], place[sort]
            gap = squared(forest.points[place], books[p[of], e[of]])
            taken += len(gap)
            head, _, first = lowest(place, gap, e[of])
            for o, v in zip(out, (place[head], place[head] + 1, first)):
                o.append(v)
        down = ~whole & ~leaf
        node, entry, part = node[down], entry[down], part[down]
        kids = forest.children[node]
        of = np.repeat(np.arange(len(node)), kids)
        below = forest.child[node][of] + np.arange(len(of)) - np.repeat(np.cumsum(kids) - kids, kids)
        sort = np.argsort(below, kind="stable")
        node, entry, part = below[sort], entry[of][sort], part[of][sort]
    start, stop, entry = (np.concatenate(o) if o else np.empty(0, np.int64) for o in out)
    return start, stop, entry, taken


def forests(rows: DataFrame, width: int, parts: int, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of ``rows`` (key, label, v): keys, labels and trees."""
    schema = f"keys array<{dict(rows.dtypes)['key']}>, labels array<{dict(rows.dtypes)['label']}>, {Forest.ARROW}"
    step = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                some = batch.slice(at, chunk)
                n = some.num_rows
                points = vectors.matrix(some.column(2), width).reshape(n, parts, step)
                forest = cover_forest(points.transpose(1, 0, 2).reshape(-1, step), np.repeat(np.arange(parts), n), parts)
                forest.order %= n
                lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), some.column(k)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(lists + [pa.array([b], pa.binary()) for b in forest.packed()],
                                                 names=["keys", "labels", *Forest.FIELDS])

    return rows.select("key", "label", "v").mapInArrow(run, schema)


def _each(batches: Iterator[pa.RecordBatch], names: list[str], step: int) -> Iterator[tuple]:
    for batch in batches:
        for k in range(batch.num_rows):
            raw = [batch.column(batch.schema.get_field_index(f))[k].as_py() for f in Forest.FIELDS]
            yield Forest.unpacked(raw, step), *(batch.column(batch.schema.get_field_index(x))[k].values for x in names)


def lloyd_sums(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, total): count and sum of the points that each entry is nearest to."""
    parts, entries, step = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts * entries, step), np.int64), np.zeros(parts * entries, np.int64)
        for (forest,) in _each(batches, [], step):
            start, stop, entry, _ = assign(forest, books)
            sums = np.concatenate([np.zeros((1, step), np.int64), np.cumsum(forest.points, axis=0)])
            to = start // (len(forest.order) // parts) * entries + entry
            np.add.at(total, to, sums[stop] - sums[start])
            np.add.at(count, to, stop - start)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used // entries, pa.int32()), pa.array(used % entries, pa.int32()),
                                          pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
                                         names=["part", "entry", "n", "total"])

    out = trees.select(*Forest.FIELDS).mapInArrow(run, "part int, entry int, n bigint, total array<bigint>")
    return out.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.get("total", F.lit(i))) for i in range(step)]).alias("total"))


def encode(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(key, label, code, error) of every row."""
    parts, _, step = books.shape
    kinds = {f.name: f.dataType.elementType.simpleString() for f in trees.schema.fields[:2]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest, keys, labels in _each(batches, ["keys", "labels"], step):
            n = len(forest.order) // parts
            start, stop, entry, _ = assign(forest, books)
            sort = np.argsort(start)
            entry = np.repeat(entry[sort], (stop - start)[sort])
            part = np.arange(parts * n) // n
            codes, error = np.empty((n, parts), np.uint8), np.zeros(n, np.int64)
            codes[forest.order, part] = entry
            np.add.at(error, forest.order, squared(forest.points, books[part, entry]))
            yield pa.RecordBatch.from_arrays([keys, labels, pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array(error)], names=["key", "label", "code", "error"])

    return trees.mapInArrow(run, f"key {kinds['keys']}, label {kinds['labels']}, code string, error bigint")


def seeds(rows: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """Codebooks that start as the vectors of the smallest keys, [parts, entries or fewer, width / parts]."""
    keys = [r.key for r in rows.select("key").distinct().orderBy(F.col("key").asc_nulls_last()).limit(entries).collect()]
    first = rows.where(F.col("key").isin([k for k in keys if k is not None]) | (F.col("key").isNull() if None in keys else F.lit(False)))
    found = {r.key: r.v for r in first.groupBy("key").agg(F.min("v").alias("v")).collect()}
    books = np.zeros((len(keys), width), np.int64)
    for k, key in enumerate(keys):
        books[k, :len(found[key])] = found[key]
    return books.reshape(len(keys), parts, width // parts).transpose(1, 0, 2)


def fit(trees: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks after so many Lloyd rounds; entries that no part is nearest to stay."""
    for _ in range(rounds):
        books = books.copy()
        for r in lloyd_sums(trees, books).collect():  # parts * entries rows at most
            books[r.part, r.entry] = [t // r.n for t in r.total]
    return books


def vector_codes(df: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", scale: int = 256,
                 parts: int = 16, entries: int = 64, rounds: int = 2, chunk: int = CHUNK) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every row that has a whole vector."""
    store = Store(df.sparkSession, "codes")
    rows = df.where(vectors.whole(vector)).select(F.col(key).alias("key"), F.col(label).alias("label"),
                                                  vectors.floors(vector, scale).alias("v"))
    width = max(1, -(-vectors.widest(rows, "v") // parts)) * parts
    trees = store.keep(forests(rows, width, parts, chunk), "trees")
    books = seeds(rows, width, parts, entries)
    books = fit(trees, books, rounds) if books.size else books
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = store.keep(encode(trees, books), "coded")
    store.drop(trees)
    # A label may hold a third of all rows: its rows are dealt over SALTS keys.
    each = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("at"))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("key", "code"), F.lit(SALTS)).cast("int"))
    out = salted.join(each, salted.label.eqNullSafe(each.of) & (salted.salt == each["at"]))
    return out.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


QUERY = "op13_vector_codes"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _rounds_sql(rounds: int) -> str:
    """Assignments (p, vec_id, x, e) and codebooks (p, e, x) of each round."""
    out = []
    for k in range(rounds + 1):
        out.append(f"""
a{k} AS MATERIALIZED (SELECT p, vec_id, any_value(x) AS x, min(g) AS g, arg_min(e, g * 64 + e) AS e FROM (
  SELECT t.p, t.vec_id, t.x, b.e, list_sum(list_transform(list_zip(t.x, b.x), lambda q: (q[1] - q[2]) * (q[1] - q[2])))::BIGINT AS g
  FROM t JOIN b{k} b ON b.p = t.p) GROUP BY p, vec_id)""")
        if k < rounds:
            out.append(f"""
s{k} AS (SELECT p, e, i, sum(x[i + 1]) AS s, count(*) AS n FROM a{k}, range(0, (SELECT w FROM d)) r(i) GROUP BY p, e, i),
m{k} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM s{k} GROUP BY p, e),
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON m.p = b.p AND m.e = b.e)""")
    return ",".join(out)


ORACLE_SQL = f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS (SELECT max(len(v)) // 16 AS w FROM k),
t AS MATERIALIZED (SELECT k.vec_id, p.p, k.v[p.p * d.w + 1:(p.p + 1) * d.w] AS x FROM k, d, range(0, 16) p(p)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT 64),
b0 AS MATERIALIZED (SELECT t.p, f.e, t.x FROM t JOIN f ON f.vec_id = t.vec_id),
{_rounds_sql(2).strip()},
c AS (SELECT vec_id, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(g)::BIGINT AS error FROM a2 GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM c JOIN k ON k.vec_id = c.vec_id, h
"""
