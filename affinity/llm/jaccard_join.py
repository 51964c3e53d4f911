"""N-gram Jaccard self-join by parity sketches.

A document is its set of distinct five-word shingles, as 64-bit hashes.  Sets
A and B with Jaccard similarity t or more differ in at most
k = (|A| + |B|) (1 - t) / (1 + t) shingles.

*Parity sketch.*  Shingles are dealt by hash into m parts and XORed within
each: a differing shingle changes one part at most, so the Hamming distance of
the sketches (counted in parts or, with one-bit shingles, in bits) is a lower
bound of the symmetric difference.

*Size bands.*  Band j holds sizes 2**j to 2**(j+1) - 1 and fixes m.  A document
enters its own band's scheme, and the scheme below if a partner can be there.

*Pigeonhole.*  With at most k parts different, two sketches of m > k parts
share m - k.  Under any fixed order of part values, the first k + 1 of each
then share one.  The order puts parts of many shingles first (empty ones
last): their values are the rarest, so a passage that thousands of documents
share makes no bucket by itself.

*Join and verify.*  Equal sets collapse to a class first.  In star rounds every
class is paired with one class of the commonest other component of each of
its buckets, another one every time; of those whose bit sketches' Hamming
distance allows it, the nearest are verified on the whole texts.  Buckets that hold one component only go.  Rounds go
on while many of their pairs are links.  What is then left in a bucket across
components is paired, in blocks, under the same bound, and verified from the
nearest to the farthest, leaving out pairs that meanwhile are connected.  No
link between components is left unverified, and no group is expanded into all
pairs.

Set equality and intersections are by 64-bit hashes of shingles.

Defined results: null, empty or wordless text has no shingles and is a
component of its own; fewer than five words are one shingle; repeated rows
are equal sets; rows with a null key take part, their component is the least
key reached (null if there is none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from affinity.llm import words
from affinity.llm.graph import connected_components
from affinity.llm.rows import map_texts, pieces
from affinity.llm.store import Store, possibly_in

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Rows of a bucket that one task compares with as many others.
BLOCK = 2048
#: Leads that a class is verified with in a star round after the first, nearest first.
NEAREST = 4
#: Star rounds go on while more than one in so many of their pairs is a link.
YIELD = 2


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw, starts = words.joined(texts)
    buf = words.lower_ascii(raw)
    s, e = words.spans(~_SPACE[buf])
    doc = np.searchsorted(starts, s, "right") - 1
    h = words.word_hashes(buf, s, e)
    count = np.bincount(doc, minlength=len(texts))
    win, first = words.window_hashes(h, doc, width)
    edge = np.searchsorted(doc[first], np.arange(len(texts) + 1))
    word_edge = np.concatenate([[0], np.cumsum(count)])
    out = []
    for i, n in enumerate(count):
        if n >= width:
            out.append(np.unique(win[edge[i]:edge[i + 1]]))
        elif n:
            own = h[word_edge[i]:word_edge[i + 1]]
            out.append(words.window_hashes(own, np.zeros(n, np.int64), int(n))[0])
        else:
            out.append(np.empty(0, U64))
    return out


def class_id(s: np.ndarray) -> int:
    """One 64-bit name for equal sets."""
    with np.errstate(over="ignore"):
        return int(words.mix(np.array([words.mix(s).sum(dtype=U64) + U64(len(s)) * U64(0xD6E8FEB86659FD93)], U64)).view(np.int64)[0])


class Scheme:
    """Numbers that follow from the threshold alone: similar means den * inter >= num * union."""

    def __init__(self, num: int = 80, den: int = 100):
        self.num, self.den = num, den

    def differ(self, total: int) -> int:
        """Most shingles by which similar sets of this total size differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def largest(self, n: int) -> int:
        return n * self.den // self.num

    def smallest(self, n: int) -> int:
        return -(-n * self.num // self.den)

    def parts(self, band: int) -> int:
        top = (2 << band) - 1
        k = self.differ(top + self.largest(top))
        return k + 1 + max(1, k // 4)

    def entries(self, n: int) -> Iterator[tuple[int, int]]:
        """(band, prefix length): the own band, and lower ones where a smaller partner can be."""
        band = n.bit_length() - 1
        yield band, self.differ(n + self.largest(n)) + 1
        for low in range(band - 1, max(self.smallest(n), 1).bit_length() - 2, -1):
            yield low, self.differ(n + (2 << low) - 1) + 1


def part_values(s: np.ndarray, band: int, m: int, prefix: int) -> np.ndarray:
    """The first ``prefix`` part values of the set, in the common order; the band is in the low six bits."""
    h = words.mix(s ^ U64(band + 1))
    part = ((h >> U64(32)) * U64(m)) >> U64(32)
    order = np.argsort(part, kind="stable")
    part, h = part[order], h[order]
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    size = np.diff(np.concatenate([at, [len(part)]]))
    name = part[at]
    value = np.bitwise_xor.reduceat(h, at)
    if len(at) < min(prefix, m):  # empty parts come last, by number
        empty = np.setdiff1d(np.arange(m, dtype=U64), name)[:min(prefix, m) - len(at)]
        name, value = np.concatenate([name, empty]), np.concatenate([value, np.zeros(len(empty), U64)])
        size = np.concatenate([size, np.zeros(len(empty), size.dtype)])
    value = words.mix(value + words.mix(name * U64(64) + U64(band)) + size.astype(U64))
    key = np.lexsort((np.where(size > 0, value, name), -size))[:prefix]
    return ((value[key] & ~U64(63)) | U64(band)).view(np.int64)


def bit_sketch(s: np.ndarray, band: int) -> np.ndarray:
    """One-bit shingles XORed into four bits for each size of the band, 64 at least: few of them meet, so the bound is close."""
    bits = max(64, 8 << band)
    at = (words.mix(s + U64(77)) >> U64(64 - (bits.bit_length() - 1))).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(">i8").astype(np.int64)


def _sketches(docs: DataFrame, text: str, key: str, width: int, scheme: Scheme) -> DataFrame:
    """(key, n, class, values, sketches): part values and sketches only where a task first sees a class."""
    fields = "n bigint, class bigint, values array<bigint>, sketches array<struct<band:int,bits:array<bigint>>>"
    seen: set[int] = set()

    def step(texts):
        cols = [[], [], [], []]
        for s in shingle_sets(texts, width):
            name = class_id(s) if len(s) else None
            values = sketches = None
            if name is not None and name not in seen:
                seen.add(name)
                entries = list(scheme.entries(len(s)))
                values = np.concatenate([part_values(s, b, scheme.parts(b), p) for b, p in entries])
                sketches = [{"band": b, "bits": bit_sketch(s, b)} for b, _ in entries]
            for c, v in zip(cols, (len(s), name, values, sketches)):
                c.append(v)
        return cols

    return map_texts(docs, text, [key], fields, step)


def _verify(pairs: DataFrame, docs: DataFrame, where: DataFrame, text: str, key: str, width: int, scheme: Scheme,
            store: Store, size: int) -> DataFrame:
    """Those of ``size`` pairs (a, b) of classes that are similar; ``where`` has a document's key for each class."""
    at = store.keep(pairs.join(where.select(F.col("class").alias("a"), F.col("key").alias("ka")), "a").join(
        where.select(F.col("class").alias("b"), F.col("key").alias("kb")), "b"), "at")
    own = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # Each side's texts alone: in a star the second side is a few leads.
    left, right = (possibly_in(own, "k", at.select(F.col(k).alias("k")), n=size).where("maybe").select(
        F.col("k").alias(k), F.col("t").alias(t)) for k, t in (("ka", "ta"), ("kb", "tb")))
    d = at.join(left, at.ka.eqNullSafe(left.ka)).select("a", "b", "kb", "ta")
    d = d.join(right, d.kb.eqNullSafe(right.kb)).select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.add(pc.binary_length(batch.column(2)), pc.binary_length(batch.column(3))).to_pylist()
            for i, j in pieces(size):
                a, b, ta, tb = (batch.column(k).slice(i, j - i).to_pylist() for k in range(4))
                texts = list(dict.fromkeys(ta + tb))
                sets = dict(zip(texts, shingle_sets(texts, width)))
                names = {t: class_id(s) for t, s in sets.items()}
                found = []
                for na, nb, x, y in zip(a, b, ta, tb):
                    if names[x] == na and names[y] == nb:  # another row of the same key may be another text
                        x, y = sets[x], sets[y]
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        if scheme.den * both >= scheme.num * (len(x) + len(y) - both):
                            found.append((na, nb))
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])

    return d.mapInArrow(run, "a bigint, b bigint").distinct()


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, num: int = 80,
                       den: int = 100) -> DataFrame:
    """(key, n_shingles, component_id, n_links) of every row; n_links counts the links of its
    class that were verified (enough to connect, not all there are)."""
    spark = docs.sparkSession
    store, scheme = Store(spark, "jaccard"), Scheme(num, den)
    sketched = store.keep(_sketches(docs, text, key, width, scheme).withColumnRenamed(key, "key"), "sketched")
    names = sketched.where("class IS NOT NULL")
    where = names.groupBy("class").agg(F.min("key").alias("key"), F.min("n").alias("n"))
    rows = names.select("class", F.explode("values").alias("value"))
    # Buckets with at least two classes.
    buckets = rows.selectExpr("value", "class", "min(class) OVER (PARTITION BY value) AS least",
                              "max(class) OVER (PARTITION BY value) AS most").where("least <> most").select("value", "class").distinct()
    buckets = store.keep(buckets, "buckets")
    store.release()
    known = store.keep(names.where("sketches IS NOT NULL").groupBy("class").agg(F.first("sketches").alias("s")).join(
        buckets.select("class").distinct(), "class", "left_semi").join(where.select("class", "n"), "class").select(
        "class", "n", F.expr("""transform(s, x -> struct(x.band, x.bits, transform(sequence(0, 15),
            k -> aggregate(filter(x.bits, (b, i) -> i % 16 = k), 0L, (p, q) -> p ^ q)) AS fold))""").alias("sketches")), "bits")
    limit = F.expr(f"(x.n + y.n) * {den - num} div {den + num}")
    apart = F.aggregate(F.zip_with("x.bits", "y.bits", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, c: s + c)
    # The same bound from the sketch folded to 16 numbers, which are compared without a loop.
    coarse = sum((F.bit_count(F.col(f"x.f{i}").bitwiseXOR(F.col(f"y.f{i}"))) for i in range(1, 16)),
                 F.bit_count(F.col("x.f0").bitwiseXOR(F.col("y.f0"))))
    mine = "filter(sketches, x -> x.band = cast(value & 63 as int))[0]"
    links, tried, labels = [], [], None

    def linked():
        out = links[0]
        for more in links[1:]:
            out = out.union(more)
        return out

    def with_label(d, node, name):
        if labels is None:
            return d.withColumn(name, F.col(node))
        own = labels.select(F.col("node").alias(node), F.col("label").alias(name))
        return d.join(own, node, "left").withColumn(name, F.coalesce(name, node))

    def verified(pairs):
        """Verify pairs; labels then join all that is linked.  Returns how many links there are."""
        nonlocal labels
        size = pairs.count()
        if size == 0 and labels is not None:
            return 0
        tried.append(pairs)
        links.append(store.keep(_verify(pairs, docs, where, text, key, width, scheme, store, size), "links"))
        new = links[-1].count()
        if new or labels is None:
            labels = connected_components(linked(), store)
        store.release()
        return new

    turn = 0
    while True:
        # Each class beside one of its bucket's commonest component, another one every round; the nearest are verified.
        own = with_label(buckets, "class", "label").withColumn("size", F.expr("count(*) OVER (PARTITION BY value, label)"))
        own = own.withColumn("lead", F.expr(f"max(struct(size, xxhash64(class, {turn}), class, label)) OVER (PARTITION BY value)"))
        stars = own.where("label <> lead.label").groupBy("class", F.col("lead.class").alias("lead")).agg(F.min("value").alias("value"))
        x = stars.join(known, "class").selectExpr("lead", f"struct(class, n, {mine}.bits AS bits) AS x", "value")
        d = x.join(known.select(F.col("class").alias("lead"), F.col("n").alias("ln"), "sketches"), "lead").selectExpr(
            "x", f"struct(lead AS class, ln AS n, {mine}.bits AS bits) AS y").where(apart <= limit)
        best = d.select(F.col("x.class").alias("a"), F.col("y.class").alias("b"), (apart / (limit + 1)).alias("far")).withColumn(
            "place", F.expr("row_number() OVER (PARTITION BY a ORDER BY far, b)")).where(F.col("place") <= (NEAREST if turn else 1)).select("a", "b")
        best = store.keep(best, "best")
        new = verified(best)
        if YIELD * new <= best.count():
            break
        turn += 1

    # What is left within buckets across components, where the folded sketches are near enough, and then the sketches.
    mixed = F.expr("min(label) OVER (PARTITION BY value) <> max(label) OVER (PARTITION BY value)")
    own = store.keep(with_label(buckets, "class", "label").withColumn("mixed", mixed).where("mixed").drop("mixed"), "own")
    wide = own.groupBy("value").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = own.join(wide, "value").join(known, "class").selectExpr(
        "value", "class", "label", "n", "blocks", "cast(pmod(xxhash64(class), blocks) as int) AS own", f"{mine}.fold AS fold").selectExpr(
        "value", "class", "label", "n", "blocks", "own", *(f"fold[{i}] AS f{i}" for i in range(16)))
    spread = member.select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).selectExpr(
        "*", "least(own, other) AS lo", "greatest(own, other) AS hi")
    x, y = spread.where("own = lo").alias("x"), spread.where("own = hi").alias("y")
    near = x.join(y, (F.col("x.value") == F.col("y.value")) & (F.col("x.lo") == F.col("y.lo")) & (F.col("x.hi") == F.col("y.hi"))
                  & (F.col("x.label") != F.col("y.label")) & ((F.col("x.own") != F.col("y.own")) | (F.col("x.class") < F.col("y.class")))
                  & (F.least("x.n", "y.n") * den >= F.greatest("x.n", "y.n") * num) & (coarse <= limit))
    near = near.select(F.least("x.class", "y.class").alias("b"), F.greatest("x.class", "y.class").alias("a"), "x.value").groupBy("a", "b").agg(
        F.min("value").alias("value"))
    x = store.keep(near, "coarse").join(known, F.col("a") == F.col("class")).selectExpr("b", f"struct(class, n, {mine}.bits AS bits) AS x", "value")
    near = x.join(known.select(F.col("class").alias("b"), F.col("n").alias("bn"), "sketches"), "b").selectExpr(
        "x", f"struct(b AS class, bn AS n, {mine}.bits AS bits) AS y").where(apart <= limit).select(
        F.col("x.class").alias("a"), F.col("y.class").alias("b"), (apart / (limit + 1)).alias("far"))
    near = store.keep(near, "near")  # else the pairs tried before would be left out below the aggregate, bucket by bucket
    known_pairs = tried[0]
    for t in tried[1:]:
        known_pairs = known_pairs.union(t)
    near = store.keep(near.join(known_pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                                ["a", "b"], "left_anti"), "near")
    done = 0.0
    for upto in (0.85, 1.0):
        live = with_label(with_label(near.where((F.col("far") >= done) & (F.col("far") < upto)), "a", "la"), "b", "lb").where("la <> lb")
        done = upto
        live = store.keep(live.select("a", "b"), "live")
        verified(live)
    pairs = linked().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    degree = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).groupBy("class").agg(F.count("*").alias("n_links"))
    classes = where.select("class", "key").join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "label", F.coalesce("label", "class"))
    first = classes.groupBy("label").agg(F.min("key").alias("component_id"))
    member = store.keep(classes.join(first, "label").join(degree, "class", "left").select("class", "component_id", "n_links"), "member")
    store.drop(buckets, known, near, own)
    out = sketched.select("key", "n", "class").join(member, "class", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"))


QUERY = "op2_jaccard_join"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""
