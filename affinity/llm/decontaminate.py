"""Benchmark decontamination with a broadcast hash set of test n-grams.

Benchmark items become windows of ``width`` normalised words (an item of fewer
words is one window).  The sorted window hashes are broadcast; every document
is scanned as arrays of word and window hashes; a hash hit is verified against
the window's words before it counts.  Hit words are removed from the text as
spans, or the document as a whole.

The benchmark's windows are a written table, counted first.  Up to ``block`` of
them are broadcast whole.  Of a larger benchmark only a filter of ``FILTER`` bits
is: one scan of the documents lists the windows that pass it, these are joined
with the table by hash and words (each window of the table under ``SALTS`` keys,
so that a passage of many documents is dealt out), and only documents that list
any are read again to cut their hits.  Neither what is broadcast nor the number
of scans grows with the benchmark.

Defined results: null or wordless texts have no words and are never
contaminated; null or wordless items have no windows; repeated documents are
judged one by one; repeated item rows count as one item id; the
words of an item with a null id are hit, but it is not listed; empty tables give
an empty result or no hits.  Work is per row: hot sources and groups of copies
add no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from affinity.llm import words
from affinity.llm.rows import map_texts, text_pieces
from affinity.llm.store import Store

#: Bits of the filter's address (2**26 bits are 8 MB), copies of a window among the keys of the join.
FILTER, SALTS = 26, 16

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True  # digits, a-z, every byte of a non-ASCII character


def _tokens(texts):
    raw, starts = words.joined(texts)
    buf = words.lower_ascii(raw)
    s, e = words.spans(_WORD[buf])
    doc = np.searchsorted(starts, s, "right") - 1
    return raw, buf, starts, s, e, doc


def benchmark_windows(benchmark: DataFrame, text: str = "text", key: str = "item_id", width: int = 10) -> DataFrame:
    """(hash, width, words, item) of every distinct window of every item."""

    def step(texts):
        _, buf, _, s, e, doc = _tokens(texts)
        h = words.word_hashes(buf, s, e)
        rows = [[] for _ in texts]
        count = np.bincount(doc, minlength=len(texts))
        for w in sorted({int(min(width, n)) for n in count if n}):
            own = set(np.flatnonzero((count == w) if w < width else (count >= width)).tolist())
            wh, first = words.window_hashes(h, doc, w)
            for x, i in zip(wh.view(np.int64).tolist(), first.tolist()):
                if int(doc[i]) in own:
                    rows[doc[i]].append({"hash": x, "width": w, "words": b" ".join(
                        buf[s[k]:e[k]].tobytes() for k in range(i, i + w))})
        return [rows]

    found = map_texts(benchmark, text, [key], "w array<struct<hash:bigint,width:int,words:binary>>", step)
    return found.select(F.col(key).alias("item"), F.inline("w")).distinct()


class _Windows:
    """One broadcast block: sorted hashes by width, words to verify, items."""

    def __init__(self, rows):
        self.widths = sorted({r["width"] for r in rows})
        self.words: dict[tuple[int, int], dict[bytes, list]] = {}
        for r in rows:
            self.words.setdefault((r["width"], r["hash"]), {}).setdefault(bytes(r["words"]), []).append(r["item"])
        self.hashes = {w: np.sort(np.array([h for v, h in self.words if v == w], np.int64).view(np.uint64)) for w in self.widths}
        self.coarse = {w: np.zeros(1 << 20, bool) for w in self.widths}
        for w in self.widths:
            self.coarse[w][(self.hashes[w] >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, buf, s, e, doc, h):
        """(first word, width, items) of every verified occurrence."""
        for w in self.widths:
            wh, first = words.window_hashes(h, doc, w)
            some = np.flatnonzero(self.coarse[w][(wh >> np.uint64(44)).astype(np.int64)])
            some = some[np.isin(wh[some], self.hashes[w])]
            for x, i in zip(wh[some].view(np.int64).tolist(), first[some].tolist()):
                text = b" ".join(buf[s[k]:e[k]].tobytes() for k in range(i, i + w))
                items = self.words[w, x].get(text)
                if items:
                    yield i, w, items


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  item_text: str = "text", item_key: str = "item_id", width: int = 10,
                  block: int = 200_000) -> DataFrame:
    """``keep`` columns of every document beside n_words, n_hit, items (sorted
    distinct item ids as strings), clean_text (hit spans cut out)."""
    store = Store(docs.sparkSession, "benchmark")
    windows = store.keep(benchmark_windows(benchmark, item_text, item_key, width), "windows")
    row = docs.select(F.struct(*keep).alias("__row"), F.col(text).alias("__of"))  # clashing names go through as one
    if windows.count() <= block:
        return _scan(row, windows).select("__row.*", *OUT)
    listed = store.keep(_list(row, windows).withColumn("__id", F.monotonically_increasing_id()), "listed")
    table = windows.groupBy("hash", "width", "words").agg(F.collect_set(F.col("item").cast("string")).alias("items"))
    table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = listed.select("__id", F.pmod("__id", F.lit(SALTS)).cast("int").alias("salt"), F.inline("found"))
    hits = each.join(table, ["hash", "width", "words", "salt"]).groupBy("__id").agg(
        F.collect_list(F.struct("first", "width")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    some = listed.where(F.size("found") > 0).select("__id", "__row", "__text").join(hits, "__id", "left")
    none = listed.where(F.size("found") == 0).select("__row", "n_words", F.lit(0).cast("long").alias("n_hit"),
                                                     F.array().cast("array<string>").alias("items"), F.col("__text").alias("clean_text"))
    return none.unionByName(_cut_hits(some)).select("__row.*", *OUT)


OUT = ["n_words", "n_hit", "items", "clean_text"]
ADDED = "n_words long, n_hit long, items array<string>, clean_text string"


def _scan(row: DataFrame, windows: DataFrame) -> DataFrame:
    """All windows of the benchmark in each task."""
    sent = row.sparkSession.sparkContext.broadcast([r.asDict() for r in windows.collect()])
    known: list[_Windows] = []  # made once in a worker's copy of this function

    def step(texts):
        if not known:
            known.append(_Windows(sent.value))
        _, buf, _, s, e, doc = split = _tokens(texts)
        marks: dict[int, list] = {}
        items: dict[int, set] = {}
        for i, w, found in known[0].hits(buf, s, e, doc, words.word_hashes(buf, s, e)):
            marks.setdefault(int(doc[i]), []).append((i, w))
            items.setdefault(int(doc[i]), set()).update(str(x) for x in found if x is not None)
        return _results(texts, split, marks, [sorted(items.get(k, ())) for k in range(len(texts))])

    return map_texts(row, "__of", ["__row"], ADDED, step)


def _results(texts, split, marks: dict[int, list], items: list) -> list[list]:
    """The columns of ADDED from the verified windows (first word of the batch, width) of each text."""
    raw, _, starts, s, e, doc = split
    hit = np.zeros(len(s) + 1, np.int64)  # +1 where a window starts, -1 behind its end
    for own in marks.values():
        for i, w in own:
            hit[i] += 1
            hit[i + w] -= 1
    mark = np.cumsum(hit[:-1]) > 0
    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
    clean, n_hit = [], []
    for k, t in enumerate(texts):
        own = mark[edge[k]:edge[k + 1]]
        n_hit.append(int(own.sum()))
        clean.append(_cut(raw, starts[k], starts[k + 1] - 1, s[edge[k]:edge[k + 1]], e[edge[k]:edge[k + 1]], own) if n_hit[-1] else t)
    return [np.diff(edge).tolist(), n_hit, items, clean]


def _list(row: DataFrame, windows: DataFrame) -> DataFrame:
    """Texts, their numbers of words and the windows that pass the filter."""
    slot = F.shiftrightunsigned("hash", 64 - FILTER)
    bits = windows.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits"))
    rows = bits.toArrow()  # 2 ** (FILTER - 6) rows at most
    passed = np.zeros(1 << (FILTER - 6), np.int64)
    passed[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())  # as many as a window has words
    sent = row.sparkSession.sparkContext.broadcast(passed.view(np.uint64))

    def step(texts):
        _, buf, _, s, e, doc = _tokens(texts)
        h, known = words.word_hashes(buf, s, e), sent.value
        edge = np.searchsorted(doc, np.arange(len(texts) + 1))
        found = [[] for _ in texts]
        for w in widths:
            wh, first = words.window_hashes(h, doc, w)
            at = wh >> np.uint64(64 - FILTER)
            some = np.flatnonzero((known[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1))
            for x, i in zip(wh[some].view(np.int64).tolist(), first[some].tolist()):
                found[doc[i]].append({"hash": x, "width": w, "first": i - int(edge[doc[i]]),
                                      "words": b" ".join(buf[s[k]:e[k]].tobytes() for k in range(i, i + w))})
        return [texts, np.diff(edge).tolist(), found]

    return map_texts(row, "__of", ["__row"], "__text string, n_words long, found array<struct<hash:bigint,width:int,first:int,words:binary>>", step)


def _cut_hits(some: DataFrame) -> DataFrame:
    """The columns of ADDED from joined windows (first word of the text, width)."""
    schema = T.StructType([some.schema["__row"], *T._parse_datatype_string(ADDED).fields])
    types = [f.type for f in to_arrow_schema(schema)][1:]

    def run(batches):
        for batch in batches:
            for i, j, texts in text_pieces(batch.column(1)):
                split = _tokens(texts)
                edge = np.searchsorted(split[5], np.arange(len(texts) + 1))
                marks = {k: [(int(edge[k]) + x["first"], x["width"]) for x in own or ()]
                         for k, own in enumerate(batch.column(2).slice(i, j - i).to_pylist())}
                cols = _results(texts, split, marks, [x or [] for x in batch.column(3).slice(i, j - i).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *[pa.array(c, t) for c, t in zip(cols, types)]], names=schema.names)

    return some.select("__row", "__text", "hits", "items").mapInArrow(run, schema)


def _cut(raw, start, end, s, e, own) -> str:
    """The text without the runs of hit words and what stands between them."""
    a, b = words.spans(own)
    at, parts = start, []
    for i, j in zip(a, b):
        parts.append(raw[at:s[i]].tobytes())
        at = e[j - 1]
    parts.append(raw[at:end].tobytes())
    return b"".join(parts).decode("utf-8", "surrogatepass")


QUERY = "op5_benchmark_decontamination"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return d.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n,
               unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS g
        FROM bw WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
              unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
       FROM dw, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, item_id, i, n FROM dg JOIN win USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
        FROM hit GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
