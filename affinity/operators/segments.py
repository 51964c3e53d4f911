"""Market segments: items with the same audience, by MinHash LSH.

Reader pairs -> qualified items -> K MinHash signatures per item (one partial
aggregate of K ``min`` over hashed readers; no per-item reader arrays) ->
candidate pairs by equi-join on (table, signature), hot buckets cut into
sub-buckets -> exact verification by co-reader counts -> strict distance filter.

Similarity is always exact (computed from reader counts); only recall is
approximate, as with MLlib, which verifies on the vectors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.hashing import hash60, prefix_value
from affinity.functions.metrics import r6
from affinity.sources.scratch import Run

MINHASH_TAG = "minhash"


def reader_pairs(df: DataFrame) -> DataFrame:
    """Distinct (user_id, book_id) with is_read = 1."""
    return df.where(F.col("is_read") == 1).select("user_id", "book_id").distinct()


def qualified_items(pairs: DataFrame, min_readers: int) -> DataFrame:
    """Items with at least ``min_readers`` readers: ``(book_id, n_readers)``."""
    return (pairs.groupBy("book_id").agg(F.count(F.lit(1)).alias("n_readers"))
            .where(F.col("n_readers") >= min_readers))


def qualified_pairs(pairs: DataFrame, min_readers: int) -> DataFrame:
    return pairs.join(qualified_items(pairs, min_readers).select("book_id"), "book_id", "left_semi")


CHUNK_TAG = "chunk"


def reader_chunk(n_chunks: Column) -> Column:
    """Hash chunk of a reader among ``n_chunks``."""
    return F.pmod(prefix_value(F.md5(F.concat_ws("|", F.lit(CHUNK_TAG), F.col("user_id").cast("string")))), n_chunks)


def reader_sets(pairs: DataFrame, counts: DataFrame, chunk_size: int) -> DataFrame:
    """Item -> reader tokens in hash chunks of about ``chunk_size``:
    ``(book_id, chunk, n_tokens, user_tokens array<string>)``, tokens sorted by
    user id, so no row (or task) holds the whole audience of a hot item.
    ``counts`` is ``(book_id, n_readers)`` (``qualified_items``)."""
    n_chunks = F.ceil(F.col("n_readers") / F.lit(chunk_size)).cast("bigint")
    return (pairs.join(counts.select("book_id", "n_readers"), "book_id")
            .withColumn("chunk", reader_chunk(n_chunks).cast("int"))
            .groupBy("book_id", "chunk")
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.array_sort(F.collect_list("user_id")).alias("_u"))
            .select("book_id", "chunk", "n_tokens",
                    F.transform("_u", lambda u: u.cast("string")).alias("user_tokens")))


def minhash_signatures(pairs: DataFrame, num_tables: int, seed: int, rows: int = 1) -> DataFrame:
    """``(book_id, hash_table, signature)``: per table k the smallest 60-bit
    ``md5(minhash|seed|k|user)`` prefix over the item's readers.  All K minima come
    from one ``groupBy(book_id)`` with map-side partial aggregation, then the
    small per-item row is unpivoted.  With ``rows`` > 1 a table's signature is the
    hash of that many minima: two items share it only if all are equal."""
    least = [F.min(hash60(MINHASH_TAG, seed, F.lit(k), "user_id")) for k in range(num_tables * rows)]
    mins = [(least[k] if rows == 1 else hash60(MINHASH_TAG, seed, *least[k * rows:(k + 1) * rows])).alias(f"s{k}")
            for k in range(num_tables)]
    per_item = pairs.groupBy("book_id").agg(*mins)
    stack = "stack({}, {}) as (hash_table, signature)".format(
        num_tables, ", ".join(f"{k}, s{k}" for k in range(num_tables)))
    return per_item.selectExpr("book_id", stack)


# Items of one bucket that a task pairs with the bucket's others.
BUCKET_CHUNK = 500


def _bucket_join(left: DataFrame, right: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """Equi-join of two item lists on a bucket's keys.  A bucket of more than
    ``chunk`` left items is cut into that many sub-buckets by item hash and its
    right items are copied to each: skew handling by bytes cannot see a bucket
    that is small but has a huge number of pairs."""
    sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > chunk).select(
        *keys, F.ceil(F.col("_c") / chunk).cast("int").alias("_n"))
    subs = F.coalesce("_n", F.lit(1))
    a = left.join(sizes, keys, "left").withColumn("_sub", F.pmod(F.xxhash64("book_id_1"), subs).cast("int")).drop("_n")
    b = right.join(sizes, keys, "left").withColumn("_sub", F.explode(F.sequence(F.lit(0), subs - 1))).drop("_n")
    return a.join(b, [*keys, "_sub"]).where(F.col("book_id_1") < F.col("book_id_2"))


def lsh_candidates(signatures: DataFrame, chunk: int = BUCKET_CHUNK) -> DataFrame:
    """Distinct item pairs (a < b) sharing a signature in at least one table."""
    a = signatures.select("hash_table", "signature", F.col("book_id").alias("book_id_1"))
    b = signatures.select("hash_table", "signature", F.col("book_id").alias("book_id_2"))
    return _bucket_join(a, b, ["hash_table", "signature"], chunk).select("book_id_1", "book_id_2").distinct()


def size_band(n_col, min_similarity: float):
    """Reader-count band of width ln(1/s): two items whose smaller/larger reader
    count ratio is at least s lie in the same or adjacent bands (J <= min/max,
    so other pairs can never reach similarity s).  The width is widened by
    1e-9 relative so float rounding cannot split a feasible pair."""
    width = band_width(min_similarity)
    if width is None:
        return F.lit(0).cast("bigint")
    if width <= 0.0:  # s = 1: every feasible pair has equal counts
        return n_col.cast("bigint")
    return F.floor(F.log(n_col.cast("double")) / F.lit(width)).cast("bigint")


def band_width(min_similarity: float) -> float | None:
    """ln(1/s), widened by 1e-9 relative; None when there is no size bound."""
    if min_similarity <= 0.0:
        return None
    return math.log(1.0 / min_similarity) * (1.0 + 1e-9)


def banded_candidates(signatures: DataFrame, counts: DataFrame, max_distance: float, chunk: int = BUCKET_CHUNK) -> DataFrame:
    """Candidate pairs (a < b) sharing a signature *and* a reader-count band
    (or adjacent bands).  Exact for the verified result: the pairs dropped
    here fail the size bound.  A bucket of items with very different audience
    sizes (e.g. everything one heavy reader touched) does not enumerate its
    hopeless pairs; the rest of a hot bucket is cut into sub-buckets."""
    banded = signatures.join(counts.select("book_id", "n_readers"), "book_id").withColumn(
        "band", size_band(F.col("n_readers"), 1.0 - max_distance))
    a = banded.select("hash_table", "signature", "band", F.col("book_id").alias("book_id_1"),
                      F.col("n_readers").alias("n1"))
    b = banded.select("hash_table", "signature",
                      F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
                      F.col("book_id").alias("book_id_2"), F.col("n_readers").alias("n2"))
    # reader counts ride along (functionally dependent on the ids) for the verifier
    return _bucket_join(a, b, ["hash_table", "signature", "band"], chunk).select(
        "book_id_1", "book_id_2", "n1", "n2").distinct()


# Readers of a probe item that meet all its candidates in one key.
PROBE_CHUNK = 256
# A reader of more items is probed, not paired with itself.
PAIRED_ITEMS = 1024


def co_readers(sized: DataFrame, pairs: DataFrame, most: int = PAIRED_ITEMS) -> DataFrame:
    """``(book_id_1, book_id_2, n1, n2, co)``: readers that both items of a candidate have, where there are any.

    Probing costs a row for each candidate and reader of its smaller item, so
    many candidates of items with large audiences repeat each audience over and over.
    Pairing the items of each reader costs the square of what readers have read,
    whatever the number of candidates, and is counted where it is made.  The
    cheaper of the two is taken; readers of more than ``most`` items are probed in any case."""
    per_reader = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("_d"))
    hot = per_reader.where(F.col("_d") > most).select("user_id")
    paired = F.sum(F.when(F.col("_d") <= most, F.col("_d").cast("double") * F.col("_d") / 2))
    cost, n_hot = per_reader.agg(F.coalesce(paired, F.lit(0.0)), F.count_if(F.col("_d") > most)).first()
    probed = sized.agg(F.coalesce(F.sum(F.least("n1", "n2").cast("double")), F.lit(0.0))).first()[0]
    if probed <= cost:
        return _probed(sized, pairs).groupBy("book_id_1", "book_id_2", "n1", "n2").agg(F.count(F.lit(1)).alias("co"))
    rows = pairs.select("user_id", "book_id")
    cold = rows.join(hot, "user_id", "left_anti") if n_hot else rows
    met = (cold.withColumnRenamed("book_id", "book_id_1").join(cold.withColumnRenamed("book_id", "book_id_2"), "user_id")
           .where(F.col("book_id_1") < F.col("book_id_2")).groupBy("book_id_1", "book_id_2").agg(F.count(F.lit(1)).alias("co")))
    out = sized.select("book_id_1", "book_id_2", "n1", "n2").join(met, ["book_id_1", "book_id_2"])
    if not n_hot:
        return out
    more = _probed(sized, rows.join(hot, "user_id", "left_semi")).groupBy("book_id_1", "book_id_2", "n1", "n2").agg(F.count(F.lit(1)).alias("co"))
    return out.unionByName(more).groupBy("book_id_1", "book_id_2", "n1", "n2").agg(F.sum("co").alias("co"))


def _probed(sized: DataFrame, pairs: DataFrame) -> DataFrame:
    """A row for each candidate and co-reader: the smaller reader set of each pair
    is joined to the reader pairs and probed against the other item."""
    small_first = F.col("n1") <= F.col("n2")
    oriented = sized.select(
        "book_id_1", "book_id_2", "n1", "n2",
        F.when(small_first, F.col("book_id_1")).otherwise(F.col("book_id_2")).alias("_probe"),
        F.when(small_first, F.col("book_id_2")).otherwise(F.col("book_id_1")).alias("_other"))
    # A probe item's readers go to hash chunks, its candidates to each of them, so
    # that a hot item's candidates times its readers are many keys, not one.
    n_chunks = F.ceil(F.least("n1", "n2") / F.lit(PROBE_CHUNK)).cast("bigint")
    sizes = oriented.select("_probe", n_chunks.alias("_n")).distinct()
    probes = oriented.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks - 1)))
    readers = (pairs.select(F.col("book_id").alias("_probe"), "user_id").join(sizes, "_probe")
               .select("_probe", "user_id", reader_chunk(F.col("_n")).cast("bigint").alias("_chunk")))
    other_reads = pairs.select(F.col("book_id").alias("_other"), "user_id")
    return (probes.join(readers, ["_probe", "_chunk"])
            .join(other_reads, ["_other", "user_id"], "left_semi"))


def verify_pairs(candidates: DataFrame, pairs: DataFrame, counts: DataFrame, max_distance: float) -> DataFrame:
    """Exact Jaccard of candidate pairs, kept when distance < ``max_distance``.

    A size filter first drops pairs that cannot reach the threshold
    (J <= min/max), co-reader counts (``co_readers``) decide on the others."""
    min_sim = 1.0 - max_distance
    if not {"n1", "n2"} <= set(candidates.columns):
        c1 = counts.select(F.col("book_id").alias("book_id_1"), F.col("n_readers").alias("n1"))
        c2 = counts.select(F.col("book_id").alias("book_id_2"), F.col("n_readers").alias("n2"))
        candidates = candidates.select("book_id_1", "book_id_2").join(c1, "book_id_1").join(c2, "book_id_2")
    sized = candidates.where(F.least("n1", "n2") / F.greatest("n1", "n2") >= F.lit(min_sim - 1e-9))
    co = co_readers(sized, pairs)
    dist = F.lit(1.0) - F.col("co").cast("double") / (F.col("n1") + F.col("n2") - F.col("co")).cast("double")
    return (co.withColumn("jaccard_dist", dist)
            .where(F.col("jaccard_dist") < F.lit(float(max_distance)))
            .select("book_id_1", "book_id_2", F.round(F.lit(1.0) - F.col("jaccard_dist"), 6).alias("jaccard_similarity")))


def lsh_buckets(signatures: DataFrame) -> DataFrame:
    """Bucket membership: ``(hash_table, signature, book_id, bucket_size)`` for
    buckets of two items at least.  The pairs of a bucket follow from it, so a
    hot bucket of m items is m rows here, not m squared."""
    sizes = signatures.groupBy("hash_table", "signature").agg(F.count(F.lit(1)).alias("bucket_size")).where(
        F.col("bucket_size") > 1)
    return signatures.join(sizes, ["hash_table", "signature"]).select("hash_table", "signature", "book_id", "bucket_size")


def lsh_pairs(readers: DataFrame, min_readers: int, num_tables: int, seed: int, max_distance: float,
              rows: int = 1, run: Run | None = None) -> DataFrame:
    """End-to-end native similar-item pairs.  With a ``run`` the reader pairs and
    the candidates, which several passes read, are written once."""
    keep = (lambda df, name: df) if run is None else run.keep
    pairs = reader_pairs(readers)
    counts = qualified_items(pairs, min_readers)
    qp = keep(pairs.join(counts.select("book_id"), "book_id", "left_semi"), "pairs")
    counts = keep(qualified_items(qp, min_readers), "counts")
    cand = keep(banded_candidates(minhash_signatures(qp, num_tables, seed, rows), counts, max_distance), "candidates")
    return verify_pairs(cand, qp, counts, max_distance)


def lsh_reduction(n_items: DataFrame, found: DataFrame, low_yield_below: int = 100) -> DataFrame:
    """Pairs found vs all n(n-1)/2 item pairs (two counts, one tagged union)."""
    tagged = (n_items.select(F.lit(1).alias("_i"), F.lit(0).alias("_p"))
              .unionByName(found.select(F.lit(0).alias("_i"), F.lit(1).alias("_p"))))
    agg = tagged.agg(F.sum("_i").cast("bigint").alias("n_items"), F.sum("_p").cast("bigint").alias("n_pairs"))
    agg = agg.select(F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"))
    allp = (F.col("n_items") * (F.col("n_items") - 1) / 2).cast("bigint")
    return (agg.select("n_items", "n_pairs", allp.alias("all_pairs"))
            .withColumn("pair_ratio", F.round(F.col("n_pairs") / F.nullif(F.col("all_pairs"), F.lit(0)), 9))
            .withColumn("reduction_pct", r6(F.lit(100.0) * (F.lit(1.0) - F.col("n_pairs") / F.nullif(F.col("all_pairs"), F.lit(0)))))
            .withColumn("low_yield", F.col("n_pairs") < low_yield_below))


def top_pairs(found: DataFrame, k: int) -> DataFrame:
    """Best k pairs by similarity desc, ids asc."""
    top = found.orderBy(F.col("jaccard_similarity").desc(), F.col("book_id_1"), F.col("book_id_2")).limit(k)
    w = Window.orderBy(F.col("jaccard_similarity").desc(), F.col("book_id_1"), F.col("book_id_2"))
    return top.withColumn("rank", F.row_number().over(w))


def with_recall(reduction: DataFrame, recall: DataFrame) -> DataFrame:
    """The reduction row beside the recall row (one row each)."""
    return reduction.withColumn("_one", F.lit(1)).join(F.broadcast(recall.withColumn("_one", F.lit(1))), "_one").drop("_one")


def segment_topk(found: DataFrame, item_map: DataFrame, k: int) -> DataFrame:
    """Top-k pairs with both external ids.  The map is only semi-joined to the
    k-row list (broadcast), never broadcast itself."""
    top = top_pairs(found, k)
    ids = top.select(F.col("book_id_1").alias("book_id_csv")).unionByName(
        top.select(F.col("book_id_2").alias("book_id_csv")))
    small_map = item_map.join(F.broadcast(ids), "book_id_csv", "left_semi")  # <= 2k rows
    m1 = small_map.select(F.col("book_id_csv").alias("book_id_1"), F.col("book_id").alias("external_id_1"))
    m2 = small_map.select(F.col("book_id_csv").alias("book_id_2"), F.col("book_id").alias("external_id_2"))
    return (top.join(F.broadcast(m1), "book_id_1", "left").join(F.broadcast(m2), "book_id_2", "left")
            .select("rank", "book_id_1", "book_id_2", "jaccard_similarity", "external_id_1", "external_id_2"))


# Fixed band edges of the study's similarity histogram.
BAND_EDGES = ((0.90, "0.90-1.00"), (0.85, "0.85-0.90"), (0.80, "0.80-0.85"))


def similarity_bands(top: DataFrame) -> DataFrame:
    band = None
    for lo, label in BAND_EDGES:
        cond = F.col("jaccard_similarity") >= lo
        band = F.when(cond, F.lit(label)) if band is None else band.when(cond, F.lit(label))
    band = band.otherwise(F.lit("below-0.80"))
    return top.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n_pairs"))
