"""Removal of repeated substrings by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of ``WINDOW`` bytes over it also starts earlier (in a
document of smaller id, or earlier in the same one).  Equal windows have equal
anchors (``anchors``), so they meet under their anchor's key:

1. One scan gives the anchor ranges of each document: key, hash of all bytes of
   the range's windows (its context), place.  Ranges that repeat within a piece
   of the scan are repeats already; the least stays.
2. Dealt by key and sorted, a range whose context came before is a repeat as a
   whole.  The least range of each context is kept if its key has another one.
3. The bytes of those contexts only are read again and dealt by key.  A task
   takes them in shards.  Each shard's suffixes are sorted once and give its
   multi-string transform.  The shards' transforms are then merged by iterative
   interleave refinement: an interleave of shard numbers, at first shard by
   shard, is stably dealt by the transforms' symbols, so that after h rounds it
   is in the order of the first h symbols.  The round in which two neighbours
   part is their common prefix, so after WINDOW / SYMBOL rounds the blocks left
   are the repeated intervals of WINDOW bytes; no merged suffix is sorted again.
   In each interval all but the earliest window are repeats.
4. A key with more than UNIT bytes of contexts (a passage with other bytes
   around it in very many documents) is not merged in one task: its contexts are
   dealt on by the hashes of their windows, so equal windows still meet, as rows
   without bytes.  Those that repeat within a batch are repeats already; the
   least stays.  The rest are compared in order, one row at a time.

A symbol is SYMBOL bytes (its 64-bit hash, numbered within a task), a string's
suffixes at distance SYMBOL form a chain.  Equality of contexts and symbols is
by 64-bit hash.

Documents are told apart by id and text: repeated rows are one document, rows
with one id and different texts are in the order of the texts' hashes.  A null
id comes before all others.  Null or empty text has no bytes; texts under
WINDOW bytes lose nothing; an empty table gives an empty result; other columns
are unread.  Ids must be integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from affinity.llm import words
from affinity.llm.anchors import WINDOW, Ranges
from affinity.llm.rows import text_pieces
from affinity.llm.store import Store, possibly_in

SYMBOL = 20
#: Suffixes that a task merges at once, up to twice as many (a key of more than UNIT goes by its windows); shards of a merge.
UNIT, SHARDS = 60_000, 4
_ORDER = ["doc", "h", "first"]
_FOUND = "kind int, key bigint, doc bigint, h bigint, first int, last int"


def _documents(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t")).select(
        "doc", F.xxhash64("t").alias("h"), "t")


def _batch(cols, names, types) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _equal_to_last(*columns: np.ndarray) -> np.ndarray:
    """Whether a row's values are those of the row before; a repeated row's ranges are one range."""
    out = np.ones(len(columns[0]), bool)
    out[:1] = False
    for c in columns:
        out[1:] &= c[1:] == c[:-1]
    return out


def _scan(d: DataFrame) -> DataFrame:
    """Anchor ranges; kind 0 where an equal range of the same piece is earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, h = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j, texts in text_pieces(b.column(2)):
                buf, starts = words.joined(texts)
                r = Ranges(buf, starts)
                own, oh = doc[i:j][r.doc], h[i:j][r.doc]
                order = np.lexsort((r.first, oh, own, r.context, r.key))
                key, context = r.key[order], r.context[order]
                own, oh, first, last = own[order], oh[order], r.first[order], r.last[order]
                again = np.zeros(len(order), bool)
                again[1:] = (key[1:] == key[:-1]) & (context[1:] == context[:-1])
                at = np.flatnonzero(~(again & _equal_to_last(own, oh, first)))
                yield _batch([np.where(again, 0, 1)[at], key.view(np.int64)[at], context.view(np.int64)[at], own[at], oh[at], first[at], last[at]],
                             ["kind", "key", "context", "doc", "h", "first", "last"],
                             [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()])

    return d.mapInArrow(run, "kind int, key bigint, context bigint, doc bigint, h bigint, first int, last int")


def _compare(ranges: DataFrame) -> DataFrame:
    """Kind 0: repeats as a whole; kind 1: least of its context where the key has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # last range seen: key, context, whether it was given out, and its row
        for b in batches:
            if not b.num_rows:
                continue
            kind, key, context = (b.column(k).to_numpy() for k in range(3))
            rest = [b.column(k).to_numpy() for k in range(3, 7)]
            if before is not None:  # it goes in front of this batch, so neighbours are compared across batches
                key, context = np.concatenate([before[0], key]), np.concatenate([before[1], context])
                rest = [np.concatenate([x, y]) for x, y in zip(before[2], rest)]
                kind = np.concatenate([[1], kind])
            n = len(key)
            same_key = np.zeros(n + 1, bool)
            same_key[1:n] = key[1:] == key[:-1]
            same = np.zeros(n, bool)
            same[1:] = same_key[1:n] & (context[1:] == context[:-1])
            new = ~same
            # A context's first range is given out once its key is known to have another context.
            other = np.zeros(n, bool)
            other[1:] = same_key[1:n] & ~same[1:]  # a further context begins
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            out = other.copy()
            out[first[np.flatnonzero(other) - 1]] = True
            # Locally found repeats (kind 0) are repeats in any case.
            repeat = (same | (kind == 0)) & ~(same & _equal_to_last(*rest[:3]))
            if before is not None:
                repeat[0] = False
                out[0] &= not before[3]
            at = np.flatnonzero(repeat | (out & (kind == 1)))
            yield _batch([np.where(repeat[at], 0, 1), key[at], *(x[at] for x in rest)], ["kind", "key", "doc", "h", "first", "last"],
                         [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()])
            k = first[-1]  # the last context's first range stands for it
            given = bool(out[k]) or (k == 0 and before is not None and before[3])
            before = (key[k:k + 1], context[k:k + 1], [x[k:k + 1] for x in rest], given)

    return ranges.mapInArrow(run, _FOUND)


def interleave(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' transforms after ``rounds`` refinements, and the blocks of equal first ``rounds`` symbols."""
    z = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t) for t in transforms])
    block = np.zeros(len(z), np.int64)
    symbol = np.empty(len(z), transforms[0].dtype)
    for _ in range(rounds):
        for i, t in enumerate(transforms):
            symbol[z == i] = t
        order = np.argsort(symbol, kind="stable")
        z, block, s = z[order], block[order], symbol[order]
        part = np.zeros(len(z), np.int64)
        part[1:] = (s[1:] != s[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(part)
    return z, block


def repeated_windows(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, offset, block) of every window of the contexts; equal windows have equal blocks."""
    # One place behind each context, so that every chain has an end of its own.
    raw = np.frombuffer(b"".join(c + b"\0" for c in contexts), np.uint8)
    size = np.array([len(c) + 1 for c in contexts], np.int64)
    base = np.concatenate([[0], np.cumsum(size)])
    # Symbol numbers: 1 and up; 0 ends a chain (fewer than SYMBOL bytes left) and stands before its head.
    owner = np.repeat(np.arange(len(contexts)), size)
    offset = np.arange(len(raw)) - base[owner]
    left = size[owner] - 1 - offset
    h = raw.astype(np.uint64)
    value = np.zeros(len(raw), np.uint64)
    for k in range(SYMBOL):
        value[:len(raw) - k] = value[:len(raw) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:] + np.uint64(1)
    whole = left >= SYMBOL
    _, number = np.unique(words.mix(value[whole]), return_inverse=True)
    symbol = np.zeros(len(raw), np.int64)
    symbol[whole] = number + 1
    kind = np.uint16 if number.size == 0 or number.max() < 65_000 else np.uint32
    shard_of = np.arange(len(contexts)) * min(SHARDS, len(contexts)) // len(contexts)
    cut = np.searchsorted(shard_of, np.arange(shard_of[-1] + 2))
    transforms, sorted_nodes = [], []
    longest = int(-(-size.max() // SYMBOL))
    for i in range(len(cut) - 1):
        a, b = base[cut[i]], base[cut[i + 1]]
        order = _sorted_suffixes(symbol[a:b], left[a:b] >= SYMBOL, longest)
        sorted_nodes.append(order + a)
        back = order - SYMBOL
        has = offset[a:b][order] >= SYMBOL
        t = np.zeros(len(order), kind)
        t[has] = symbol[a:b][back[has]]
        transforms.append(t)
    z, block = interleave(transforms, WINDOW // SYMBOL)
    node = np.empty(len(z), np.int64)
    for i, s in enumerate(sorted_nodes):
        node[z == i] = s
    keep = left[node] >= WINDOW
    node, block = node[keep], block[keep]
    return owner[node], offset[node], block


def _sorted_suffixes(symbol: np.ndarray, goes_on: np.ndarray, longest: int) -> np.ndarray:
    """Positions in the order of their chains of symbols, equal ones by position.

    Ends sort first among themselves by position, so a symbol's occurrences
    stay in the order of what follows them."""
    n = len(symbol)
    rank = symbol.astype(np.int64)
    step, order = SYMBOL, np.arange(n)
    covered = 1
    following = np.where(goes_on, np.arange(n) + step, n)  # n: beyond the end
    while covered < longest + 1:
        ext = np.append(rank + 1, 0)
        pair = rank * (int(rank.max()) + 2) + ext[np.minimum(following, n)]
        order = np.argsort(pair, kind="stable")
        p = pair[order]
        new = np.zeros(n, np.int64)
        new[1:] = p[1:] != p[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        following = np.append(following, n)[np.minimum(following, n)]
        covered *= 2
    return np.argsort(rank, kind="stable")


def window_keys(context: bytes, key: int) -> np.ndarray:
    """64-bit hash of each window of a context, under its key."""
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(context, np.uint8), WINDOW)
    return words.mix(words.mix((view.astype(np.uint64) + np.uint64(1)) @ words.powers(WINDOW)) ^ np.uint64(key & (1 << 64) - 1)).view(np.int64)


def _windows(key: list[int], doc: list[int], h: list[int], first: list[int], context: list[bytes]) -> list[tuple]:
    """Rows (key, doc, h, first, last, bytes) of the contexts' windows: null bytes
    for the least of each in these contexts; empty bytes, and a key that
    spreads them, for the others, which are repeats."""
    each = [window_keys(c, k) for c, k in zip(context, key)]
    owner = np.repeat(np.arange(len(each)), [len(e) for e in each])
    w = np.concatenate(each)
    start = np.concatenate([f + np.arange(len(e)) for f, e in zip(first, each)])
    d, t = np.array(doc, np.int64)[owner], np.array(h, np.int64)[owner]
    order = np.lexsort((start, t, d, w))
    w, d, t, start = w[order], d[order], t[order], start[order]
    later = np.zeros(len(w), bool)
    later[1:] = w[1:] == w[:-1]
    out = [(*x, None) for x in zip(*(c[~later].tolist() for c in (w, d, t, start, start)))]
    d, t, start = d[later], t[later], start[later]
    order = np.lexsort((start, t, d))
    d, t, start = d[order], t[order], start[order]
    at = np.flatnonzero(~(_equal_to_last(d, t) & _equal_to_last(start - np.arange(len(start)))))
    end = start[np.append(at[1:], len(start))[:len(at)] - 1]
    return out + [(*x, b"") for x in zip(*(c.tolist() for c in (t[at], d[at], t[at], start[at], end)))]


def _merge(contexts: DataFrame) -> DataFrame:
    """Window ranges (doc, h, first, last) that an earlier equal window makes repeats."""
    names, types = ["kind", "key", "doc", "h", "first", "last"], [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    unit = UNIT

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        """Rows are (key, doc, h, first, last, bytes) in the order of key, doc, h, first."""
        context, offset, block = repeated_windows([r[5] for r in rows])
        first = np.array([r[3] for r in rows], np.int64)
        # Equal windows have one key; rows are in document order within a key, so the least (context, offset) is the earliest.
        order = np.lexsort((offset, context, block))
        context, offset, block = context[order], offset[order], block[order]
        repeat = np.zeros(len(block), bool)
        repeat[1:] = block[1:] == block[:-1]
        c, s = context[repeat], offset[repeat] + first[context[repeat]]
        order = np.lexsort((s, c))
        c, s = c[order], s[order]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (s[1:] != s[:-1] + 1)
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(c))[:len(at)] - 1
        return _batch([np.zeros(len(at), int), [rows[k][0] for k in c[at]], [rows[k][1] for k in c[at]], [rows[k][2] for k in c[at]],
                       s[at], s[end]], names, types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, window = [], 0, None
        for b in batches:
            known = []  # repeats by windows
            for r in zip(*(b.column(k).to_pylist() for k in range(6))):
                if not r[5]:
                    if r[5] is not None or r[0] == window:
                        known.append((0, *r[:5]))
                    if r[5] is None:
                        window = r[0]
                    continue
                if held >= unit and r[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r[5])
            if known:
                yield _batch(list(zip(*known)), names, types)
        if rows:
            yield solve(rows)

    return contexts.mapInArrow(run, _FOUND)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every row; kept is what is left as bytes (it may cut a character)."""
    spark = docs.sparkSession
    store = Store(spark, "repeats")
    d = _documents(docs, text, key)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = _scan(d).repartition(n, "key").sortWithinPartitions("key", "context", *_ORDER)
    found = store.keep(_compare(ranges), "found")
    store.release()
    # Bytes of the contexts that must be compared.
    edges = found.where("kind = 1")
    wide = edges.groupBy("key").agg(F.sum(F.col("last") - F.col("first") + WINDOW).alias("n")).where(F.col("n") > UNIT)
    edges = possibly_in(edges, "key", wide.select("key"), "wide")
    edges = edges.groupBy("doc", "h").agg(F.collect_list(F.struct("key", "first", "last", "wide")).alias("edges"))
    edges = store.keep(edges, "edges")
    own = possibly_in(d, "h", edges.select("h")).where("maybe").dropDuplicates(["doc", "h"])
    texts = own.join(edges, ["doc", "h"]).select("doc", "h", "t", "edges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, texts in text_pieces(b.column(2)):
                rows, spread = [], []
                for doc, h, t, some in zip(*(b.column(k).slice(i, j - i).to_pylist() for k in (0, 1)), texts, b.column(3).slice(i, j - i).to_pylist()):
                    raw = t.encode("utf-8", "surrogatepass")
                    for x in some:
                        own = raw[x["first"]:x["last"] + WINDOW]
                        if x["wide"]:
                            spread.append((x["key"], doc, h, x["first"], own))
                        else:
                            rows.append((x["key"], doc, h, x["first"], x["last"], own))
                rows += _windows(*map(list, zip(*spread))) if spread else []
                if rows:
                    yield _batch(list(zip(*rows)), ["key", "doc", "h", "first", "last", "bytes"],
                                 [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()])

    contexts = texts.mapInArrow(cut, "key bigint, doc bigint, h bigint, first int, last int, bytes binary")
    more = _merge(contexts.repartition(n, "key").sortWithinPartitions("key", *_ORDER))
    marks = found.where("kind = 0").select("doc", "h", "first", "last").union(more.select("doc", "h", "first", "last"))
    marks = store.keep(marks.groupBy("doc", "h").agg(F.collect_list(F.struct("first", "last")).alias("marks")), "marks")
    store.drop(found, edges)

    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("doc"),
                       F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    rows = possibly_in(rows, "h", marks.select("h"))
    whole = rows.where("NOT maybe").select("id", F.octet_length("t").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                                           F.lit(0).cast("long").alias("n_spans"), F.encode("t", "utf-8").alias("kept"))
    some = rows.where("maybe").join(marks, ["doc", "h"], "left").select("id", "t", "marks")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], [], []]
            for t, marked in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = t.encode("utf-8", "surrogatepass")
                gone = spans_of(marked or [])
                for c, v in zip(out, (len(raw), sum(y - x for x, y in gone), len(gone), without(raw, gone))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(
                out, (pa.int64(), pa.int64(), pa.int64(), pa.binary())))], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    kept = some.mapInArrow(strip, whole.schema)
    return whole.union(kept).withColumnRenamed("id", key)


def spans_of(marked: list[dict]) -> list[tuple[int, int]]:
    """Maximal removed runs of window ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((m["first"], m["last"] + WINDOW) for m in marked):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def without(raw: bytes, gone: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in gone for x in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


QUERY = "op9_suffix_dedup"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = None
