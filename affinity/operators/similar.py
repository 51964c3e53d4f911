"""Exact similar-item pairs by a prefix-filtered inverted index.

Readers are numbered from the rarest (fewest items) to the most active one,
and each item's readers stand in that order.  Two items whose Jaccard
similarity is at least t share one of their first ``n - ceil(t n) + 1`` readers, so
only these prefixes are indexed, and an item meets few others: rare readers
come first, and a reader of everything stands at the end of each list.  Of
two items that meet at a reader, the join keeps those whose sizes and places
there still allow t:

    min(n1, n2) >= t max(n1, n2)
    1 + min(n1 - r1, n2 - r2) >= t / (1 + t) (n1 + n2)

(the first reader that two items share passes the second bound if they are
similar, whatever later ones do).  Pairs are then verified by co-reader counts.

Places within an item come in two levels, by runs of reader numbers, so a hot
item's readers are never sorted in one task; a hot reader's items are cut into
sub-buckets.  Nothing is collected but single bounds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.hashing import bernoulli
from affinity.functions.metrics import r6
from affinity.operators import segments as SEG
from affinity.operators.numbering import dense_numbers
from affinity.sources.scratch import Run

#: Reader numbers of a run: an item has at most this many readers in one sort.
SPAN = 4096
#: Slack of the float bounds: they only ever let more pairs through.
EPS = 1e-9


def reader_numbers(pairs: DataFrame, run: Run) -> DataFrame:
    """``(user_id, n_items, number)``: readers from the rarest on, ties by id."""
    freq = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))
    return dense_numbers(freq, [F.col("n_items"), F.col("user_id")], run)


def vocabulary(pairs: DataFrame, run: Run) -> DataFrame:
    """``(user_id, n_items, index)``: readers from the most active on, ties by id."""
    freq = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))
    return dense_numbers(freq, [F.col("n_items").desc(), F.col("user_id")], run, "index")


def reader_vectors(pairs: DataFrame, run: Run, span: int = SPAN) -> DataFrame:
    """Sparse 0/1 reader vectors in chunks: ``(book_id, chunk, n_tokens, indices)``.
    Chunk c holds the vocabulary indices from ``c * span`` on, ascending, so a
    row is bounded whatever an item's audience, and the vocabulary stays a table."""
    at = pairs.join(vocabulary(pairs, run).select("user_id", "index"), "user_id")
    chunk = F.floor(F.col("index") / F.lit(span)).cast("int")
    return at.groupBy("book_id", chunk.alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_tokens"), F.array_sort(F.collect_list("index")).alias("indices"))


def prefix_length(n: Column, t: float) -> Column:
    """Readers of a set of ``n`` that two sets of similarity ``t`` can't both miss."""
    return (n - F.ceil(n * F.lit(t) - F.lit(EPS)) + 1).cast("bigint")


def prefix_index(pairs: DataFrame, counts: DataFrame, t: float, run: Run, span: int = SPAN) -> DataFrame:
    """``(number, book_id, n, place)`` for the prefix of every item at similarity
    ``t``: reader numbers with their place (from 1) among the item's readers."""
    at = (pairs.join(reader_numbers(pairs, run).select("user_id", "number"), "user_id")
          .join(counts.select("book_id", F.col("n_readers").alias("n")), "book_id")
          .select("book_id", "n", "number", F.floor(F.col("number") / F.lit(span)).alias("run")))
    at = run.keep(at, "numbered")
    runs = at.groupBy("book_id", "n", "run").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("book_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    runs = (runs.select("book_id", "n", "run", F.coalesce(before, F.lit(0)).alias("before"))
            .where(F.col("before") < prefix_length(F.col("n"), t)).drop("n"))  # runs behind the prefix are never sorted
    place = F.col("before") + F.row_number().over(Window.partitionBy("book_id", "run").orderBy("number"))
    return (at.join(runs, ["book_id", "run"]).select("number", "book_id", "n", place.alias("place"))
            .where(F.col("place") <= prefix_length(F.col("n"), t)))


def _sizes_fit(t: float) -> Column:
    return F.least("n1", "n2") >= F.greatest("n1", "n2") * F.lit(t) - F.lit(EPS)


def _sub_buckets(a: DataFrame, b: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """Join on ``keys``; a key with more than ``chunk`` rows in ``a`` is cut into
    sub-buckets by item hash, and its rows of ``b`` are copied to each."""
    sizes = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > chunk).select(
        *keys, F.ceil(F.col("_c") / chunk).cast("int").alias("_n"))
    subs = F.coalesce("_n", F.lit(1))
    a = a.join(sizes, keys, "left").withColumn("_sub", F.pmod(F.xxhash64("book_id_1"), subs).cast("int")).drop("_n")
    b = b.join(sizes, keys, "left").withColumn("_sub", F.explode(F.sequence(F.lit(0), subs - 1))).drop("_n")
    return a.join(b, [*keys, "_sub"])


def prefix_candidates(left: DataFrame, right: DataFrame, t: float, chunk: int = SEG.BUCKET_CHUNK,
                      once: bool = True) -> DataFrame:
    """Distinct pairs ``(book_id_1, book_id_2, n1, n2)`` that meet in their
    prefixes under both bounds.  With ``once`` each pair of a self-join comes
    with the smaller id first; otherwise ids of ``left`` come first."""
    size = lambda c: SEG.size_band(F.col(c), t)
    a = left.select("number", F.col("book_id").alias("book_id_1"), F.col("n").alias("n1"), F.col("place").alias("p1"))
    a = a.withColumn("band", size("n1"))
    b = right.select("number", F.col("book_id").alias("book_id_2"), F.col("n").alias("n2"), F.col("place").alias("p2"))
    b = b.withColumn("band", F.explode(F.array(size("n2") - 1, size("n2"), size("n2") + 1)))
    reach = F.lit(1) + F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2"))
    met = _sub_buckets(a, b, ["number", "band"], chunk).where(
        ((F.col("book_id_1") < F.col("book_id_2")) if once else (F.col("book_id_1") != F.col("book_id_2")))
        & _sizes_fit(t) & (reach >= (F.col("n1") + F.col("n2")) * F.lit(t / (1.0 + t)) - F.lit(EPS)))
    return met.select("book_id_1", "book_id_2", "n1", "n2").distinct()


def jaccard_pairs(readers: DataFrame, min_readers: int, max_distance: float, run: Run,
                  chunk: int = SEG.BUCKET_CHUNK) -> DataFrame:
    """All pairs of qualified items with Jaccard distance < ``max_distance``:
    ``(book_id_1, book_id_2, jaccard_similarity)``, none missed.  ``max_distance``
    is below or at 1: items without a common reader are no pair."""
    pairs = SEG.reader_pairs(readers)
    counts = SEG.qualified_items(pairs, min_readers)
    qp = run.keep(pairs.join(counts.select("book_id"), "book_id", "left_semi"), "pairs")
    counts = run.keep(SEG.qualified_items(qp, min_readers), "counts")
    t = max(1.0 - max_distance, 0.0)
    index = run.keep(prefix_index(qp, counts, t, run), "index")
    return SEG.verify_pairs(run.keep(prefix_candidates(index, index, t, chunk), "candidates"), qp, counts, max_distance)


# ---------------------------------------------------------------- recall of the hashed pairs
RECALL_TAG = "recall"
#: Two-sided 95 % normal quantile.
Z95 = 1.959963984540054


def choose_bands(min_similarity: float, recall: float, max_hashes: int = 64) -> tuple[int, int]:
    """(tables, hashes a table): the most selective tables that find a pair at
    ``min_similarity`` with probability ``recall`` from at most ``max_hashes`` hashes.
    More hashes a table make fewer candidates but need more tables; one hash a
    table is taken if nothing else fits."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = min_similarity ** rows
        if hit >= 1.0:
            tables = 1
        elif hit <= 0.0:
            break
        else:
            tables = math.ceil(math.log(1.0 - recall) / math.log(1.0 - hit))
        if best is None or tables * rows <= max_hashes:
            best = tables, rows
        else:
            break
    return best or (max_hashes, 1)


def recall_sample(counts: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Items whose hash falls in the sample: ``(book_id, n_readers)``."""
    return counts.where(bernoulli(RECALL_TAG, seed, fraction, "book_id"))


def recall_estimate(found: DataFrame, pairs: DataFrame, counts: DataFrame, max_distance: float, fraction: float,
                    seed: int, run: Run) -> DataFrame:
    """One row ``(sampled_items, true_pairs, found_pairs, recall, recall_low, recall_high)``:
    the sampled items are joined exactly against all items, and ``found`` is held
    against the pairs that come out.  The interval is Wilson's, at 95 %, over
    the pairs of the sample; all are null without a true pair."""
    t = max(1.0 - max_distance, 0.0)
    index = run.keep(prefix_index(pairs, counts, t, run), "index")
    sample = recall_sample(counts, fraction, seed).select("book_id")
    met = prefix_candidates(index.join(sample, "book_id", "left_semi"), index, t, once=False)
    met = met.select(F.least("book_id_1", "book_id_2").alias("book_id_1"), F.greatest("book_id_1", "book_id_2").alias("book_id_2")).distinct()
    met = run.keep(met, "sampled")
    true = SEG.verify_pairs(met, pairs, counts, max_distance).select("book_id_1", "book_id_2")
    hits = true.join(found.select("book_id_1", "book_id_2", F.lit(1).alias("_hit")), ["book_id_1", "book_id_2"], "left")
    one = hits.agg(F.count(F.lit(1)).alias("true_pairs"), F.count("_hit").alias("found_pairs"))
    n, p = F.col("true_pairs").cast("double"), F.col("found_pairs") / F.nullif(F.col("true_pairs"), F.lit(0))
    mid = (p + F.lit(Z95 ** 2) / (2 * n)) / (1 + F.lit(Z95 ** 2) / n)
    half = F.lit(Z95) / (1 + F.lit(Z95 ** 2) / n) * F.sqrt(p * (1 - p) / n + F.lit(Z95 ** 2) / (4 * n * n))
    low, high = (F.when(F.col("true_pairs") > 0, r6(x)) for x in (mid - half, mid + half))
    sampled = sample.agg(F.count(F.lit(1)).alias("sampled_items"))
    return SEG.with_recall(sampled, one.select("true_pairs", "found_pairs", r6(p).alias("recall"), low.alias("recall_low"),
                                               high.alias("recall_high")))


# ---------------------------------------------------------------- top pairs
def met_counts(own: DataFrame, t: float, chunk: int = SEG.BUCKET_CHUNK) -> DataFrame:
    """Pairs that meet in the given prefixes, with the greatest similarity they can still have:
    ``(book_id_1, book_id_2, n1, n2, met, best)``.

    ``met`` counts the readers that both prefixes hold.  Whatever else the two share
    stands behind their last meeting in both lists, and behind the whole prefix
    of the item whose prefix ends first."""
    ends = own.groupBy("book_id").agg(F.max("number").alias("end"), F.count(F.lit(1)).alias("seen"))
    own = own.join(ends, "book_id")
    side = lambda k: own.select("number", F.col("book_id").alias(f"book_id_{k}"), F.col("n").alias(f"n{k}"),
                                F.col("place").alias(f"p{k}"), F.col("end").alias(f"end{k}"), F.col("seen").alias(f"seen{k}"))
    band = lambda c: SEG.size_band(F.col(c), t)
    a = side(1).withColumn("band", band("n1"))
    b = side(2).withColumn("band", F.explode(F.array(band("n2") - 1, band("n2"), band("n2") + 1)))
    met = _sub_buckets(a, b, ["number", "band"], chunk).where(
        (F.col("book_id_1") < F.col("book_id_2")) & _sizes_fit(t))
    one = met.groupBy("book_id_1", "book_id_2", "n1", "n2", "end1", "end2", "seen1", "seen2").agg(
        F.count(F.lit(1)).alias("met"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    rest = F.least(F.col("n1") - F.when(F.col("end1") <= F.col("end2"), F.col("seen1")).otherwise(F.col("p1")),
                   F.col("n2") - F.when(F.col("end2") <= F.col("end1"), F.col("seen2")).otherwise(F.col("p2")))
    most = F.col("met") + rest
    return one.select("book_id_1", "book_id_2", "n1", "n2", "met", (most / (F.col("n1") + F.col("n2") - most)).alias("best"))


def topk_pairs(readers: DataFrame, min_readers: int, max_distance: float, k: int, run: Run, start: int = 8,
               growth: int = 8) -> tuple[DataFrame, list[dict]]:
    """The k best pairs of all (similarity rounded to 6 desc, ids asc) with
    distance < ``max_distance``, and a record of the work of each round.

    Rounds look ever deeper into the prefixes: places up to ``start``, then ``growth``
    times as many, ...  Each verifies the 2k pairs that have met most for their
    size; the k-th best similarity so far is a bound that only rises, and the
    prefixes that it allows only shrink.  When they have been seen whole, the
    pairs that can still reach the bound are verified, and no others."""
    spark = readers.sparkSession
    pairs = SEG.reader_pairs(readers)
    counts = SEG.qualified_items(pairs, min_readers)
    qp = run.keep(pairs.join(counts.select("book_id"), "book_id", "left_semi"), "pairs")
    counts = run.keep(SEG.qualified_items(qp, min_readers), "counts")
    t = max(1.0 - max_distance, 0.0)
    index = run.keep(prefix_index(qp, counts, t, run), "index")
    out = "book_id_1", "book_id_2", "jaccard_similarity"
    top, seen, rounds, depth = None, None, [], start

    def verify(met: DataFrame) -> int:
        """Verify pairs; the top k (that many rows on the driver) and the bound follow."""
        nonlocal top, t
        good = SEG.verify_pairs(met.select("book_id_1", "book_id_2", "n1", "n2"), qp, counts, max_distance).select(*out)
        best = SEG.top_pairs(good if top is None else good.unionByName(top), k).select(*out)
        rows = best.collect()
        top = spark.createDataFrame(rows, best.schema)
        if len(rows) >= k:  # similarities are rounded, ties are told apart by their ids: half a unit of slack and more
            t = max(t, min(r.jaccard_similarity for r in rows) - 1e-6)
        return met.count()

    while True:
        own = index.where(F.col("place") <= F.least(F.lit(depth), prefix_length(F.col("n"), t)))
        met = met_counts(own, t).where(F.col("best") >= F.lit(t - EPS))
        met = run.keep(met if seen is None else met.join(seen, ["book_id_1", "book_id_2"], "left_anti"), "met")
        near = F.col("met") / (F.col("n1") + F.col("n2") - F.col("met"))
        first = run.keep(met.orderBy(near.desc(), "book_id_1", "book_id_2").limit(2 * k), "first")
        done = {"depth": depth, "bound": t, "met": met.count(), "verified": verify(first)}
        deepest = index.agg(F.max(F.least("place", prefix_length(F.col("n"), t)))).first()[0] or 0
        ids = first.select("book_id_1", "book_id_2")
        if depth >= deepest:
            left = met.where(F.col("best") >= F.lit(t - EPS)).join(ids, ["book_id_1", "book_id_2"], "left_anti")
            done["verified"] += verify(run.keep(left, "left"))
            return top, rounds + [done]
        rounds.append(done)
        seen = ids if seen is None else seen.unionByName(ids)
        depth *= growth


def topk_work(readers: DataFrame, min_readers: int, max_distance: float, k: int, run: Run) -> DataFrame:
    """One row on the search for the top k: rounds, pairs verified in all of them,
    all pairs there are, and the bound that the last round ended with."""
    top, rounds = topk_pairs(readers, min_readers, max_distance, k, run)
    counts = SEG.qualified_items(SEG.reader_pairs(readers), min_readers)
    n = F.count(F.lit(1))
    return counts.agg((n * (n - 1) / 2).cast("bigint").alias("all_pairs")).select(
        F.lit(len(rounds)).alias("rounds"), F.lit(sum(r["verified"] for r in rounds)).cast("bigint").alias("pairs_verified"),
        "all_pairs", F.lit(round(rounds[-1]["bound"], 6)).alias("last_bound"))
