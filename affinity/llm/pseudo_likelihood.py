"""Masked pseudo-likelihood scores from a bidirectional window network.

Every token is predicted from the two tokens on either side of it, never from
itself: h = tanh(sum of one embedding per side and distance), then a softmax
over the most frequent tokens and classes of the others, and one in the class.  A document's score is the sum
of log p(token | both sides) over all its tokens.

Vocabulary: word counts over the whole corpus, a Spark table of every word.  The
most frequent ``SIZE - 33`` words (ties in word order) have a token each and are
broadcast.  Every other word is spelled: the network predicts its length (32
tokens, the last for that length or more), and a table of byte pairs, counted
over all such words of the corpus, its bytes in turn.  So no word is outside
the vocabulary and words of equal length differ.  Beside another word the
network sees a spelled one by its length only.

Memory: a block is ``LEAST`` to ``MOST`` tokens up to a full stop.  Where the
whole block stands in another document too, that document predicts each of its
tokens from the rest of the block, with weight ``RECALL`` beside the network's
1 - RECALL.  Block hashes of all documents are counted and joined as tables; a
document never remembers itself.  Thus a text that occurs twice scores apart
from one that occurs once.  ``network_log_likelihood`` is the sum without it.

Training: in each round every task starts from the same weights and takes one
pass of mini-batch gradient steps over its documents, masking a share of the
places (by a hash of text and place together).  The texts are encoded once, as ids.  The rounds take the hash's
range in turn, so by default two rounds of a half predict every token of every
document once, and the second starts from the average of all tasks.  The
tasks' weights are averaged by the number of tokens masked, chunk by chunk, as
Spark rows; the driver holds one set of weights.  The network's size is fixed;
the word table and the memory grow with the corpus.  The weights depend on how
the table is split into tasks; the scores' meaning doesn't.

Defined results: null, empty or wordless text has no tokens, log_likelihood 0
and a null perplexity; texts are scored whole; repeated rows train and score as
often as they occur, and each is another document to the other; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from affinity.llm import words as hashes
from affinity.llm.rows import gather_texts, map_texts, pieces
from affinity.llm.store import Store

WIDTH, HIDDEN, BY_LENGTH = 2, 16, 32
#: Token ids below HEAD are predicted at once, the others as a class and in it.
HEAD, CLASSES, EACH = 64, 16, 128
SIZE = HEAD + CLASSES * EACH
SIDES = [k for k in range(-WIDTH, WIDTH + 1) if k]
#: What is predicted first for each token id: the token or its class.
GROUP = np.array([i if i < HEAD else HEAD + (i - HEAD) // EACH for i in range(SIZE)], np.uint8)
#: Numbers within it have a power of e that can be summed in float32 as they are.
SAFE = 60
LEAST, MOST, RECALL = 8, 32, 0.5
#: A block in more than 1 / COMMON of all places is known from a broadcast list of fewer than COMMON hashes.
COMMON = 1 << 16


def tokens(text: str) -> list[str]:
    return text.lower().replace(".", " . ").replace(",", " , ").split()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of every word of the corpus."""

    def step(acc: Counter, texts: list[str]) -> None:
        for t in texts:
            acc.update(tokens(t))

    rows = gather_texts(docs, text, "word string, n long", Counter, step, lambda acc: [list(acc.keys()), list(acc.values())])
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text: str = "text", counts: DataFrame | None = None) -> dict[str, int]:
    """The most frequent words of the corpus and their token ids."""
    counts = word_counts(docs, text) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(SIZE - BY_LENGTH - 1)
    return {r["word"]: i + BY_LENGTH + 1 for i, r in enumerate(top.collect())}


def spelling(counts: DataFrame, known: dict[str, int]) -> np.ndarray:
    """log p(byte | byte before it) in words without a token of their own, by
    their counts; a word's first byte follows byte 0.  256 x 256 whatever the corpus."""
    sent = counts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65536, np.int64)
        for b in batches:
            rare = [(w, n) for w, n in zip(*(b.column(k).to_pylist() for k in range(2))) if w not in sent.value]
            if rare:
                pair, sizes = _pairs([w for w, _ in rare])
                np.add.at(total, pair, np.repeat([n for _, n in rare], sizes))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["pair", "n"])

    found = np.full(65536, 0.5)
    for r in counts.select("word", "n").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        found[r["pair"]] += r["n"]
    found = found.reshape(256, 256)
    return np.log(found / found.sum(1, keepdims=True)).ravel().astype(np.float32)


def _pairs(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(byte before) * 256 + byte for all bytes of the words, and the bytes of each."""
    buf = np.frombuffer(("\0" + "\0".join(some)).encode("utf-8", "surrogatepass"), np.uint8)
    gap = np.flatnonzero(buf == 0)
    if len(gap) == len(some):
        sizes = np.diff(np.append(gap, len(buf))) - 1
    else:  # some word holds a zero
        sizes = np.fromiter((len(w.encode("utf-8", "surrogatepass")) for w in some), np.int64, len(some))
        gap = np.cumsum(sizes + 1) - sizes - 1
    pair = buf[:-1].astype(np.uint16) * np.uint16(256) + buf[1:]  # of each byte and the one before it
    return np.delete(pair, gap[1:] - 1), sizes


def spelled(some: list[str], pairs: np.ndarray) -> np.ndarray:
    """log p(word | its length); beyond BY_LENGTH each further character is another one with a half."""
    if not some:
        return np.empty(0)
    pair, sizes = _pairs(some)
    p = np.add.reduceat(pairs[pair].astype(np.float64), np.cumsum(sizes) - sizes)
    for k in np.flatnonzero(sizes >= BY_LENGTH).tolist():
        p[k] -= max(0, len(some[k]) - BY_LENGTH + 1) * np.log(2)
    return p


def blocks(words_: list[str]) -> list[tuple[int, int]]:
    """Places where the blocks of a text begin and end: LEAST tokens or more up
    to a full stop, at most MOST; what is left at the end joins the last one."""
    out, at, n, stop = [], 0, len(words_), -1
    while at < n:
        if stop < at + LEAST - 1:  # the first one that can end this block
            try:
                stop = words_.index(".", at + LEAST - 1)
            except ValueError:
                stop = n
        end = min(at + MOST, n, stop + 1)
        if n - end < LEAST:
            end = n
        out.append((at, end))
        at = end
    return out


def block_hash(words_: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(words_).encode("utf-8", "surrogatepass")) - (1 << 63)


def _ids(lists: list[list[str]], known: dict[str, int]) -> tuple[list[np.ndarray], list[str], list[int]]:
    """Ids of the tokens of each text, all spelled words, and where those of each text begin and end."""
    every = list(chain.from_iterable(lists))
    ids = np.fromiter(map(known.get, every, repeat(0)), np.uint16, len(every))
    none = ids == 0
    rare = list(compress(every, none.tolist()))
    ids[none] = np.minimum(np.fromiter(map(len, rare), np.int64, len(rare)), BY_LENGTH)
    edge = np.cumsum([0, *map(len, lists)])
    return np.split(ids, edge[1:-1]) if lists else [], rare, np.concatenate([[0], np.cumsum(none)])[edge].tolist()


def token_ids(lists: list[list[str]], known: dict[str, int]) -> list[np.ndarray]:
    """Ids of the tokens of each text; a spelled word's is its length, BY_LENGTH at most."""
    return _ids(lists, known)[0]


def padded(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, WIDTH zeros around each text, and the number of tokens of each."""
    gap = np.zeros(WIDTH, np.uint16)
    parts = [gap]
    for x in ids:
        parts += (x, gap)
    return np.concatenate(parts), np.fromiter(map(len, ids), np.int64, len(ids))


def encode(docs: DataFrame, known: dict[str, int], pairs: np.ndarray, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every text as the network reads it, written once: the columns to keep as
    one (names may clash), ids (16 bits each), the log p of its spelled words
    (32 bits each), its blocks' hashes and ends, a hash of the text."""
    sent = docs.sparkSession.sparkContext.broadcast((known, pairs))

    def step(texts):
        own, table = sent.value
        lists = [tokens(t) for t in texts]
        ids, rare, edge = _ids(lists, own)
        p = spelled(rare, table).astype(np.float32)
        parts = [blocks(each) for each in lists]
        return [[x.tobytes() for x in ids], [p[i:j].tobytes() for i, j in zip(edge, edge[1:])],
                [[block_hash(each[i:j]) for i, j in part] for each, part in zip(lists, parts)], [[j for _, j in part] for part in parts],
                [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts]]

    row = docs.select(F.struct(*keep).alias("__row"), F.col(text).alias("__of"))
    return map_texts(row, "__of", ["__row"], "ids binary, spelled binary, hashes array<bigint>, ends array<int>, own bigint", step)


def _runs(batch: pa.RecordBatch, column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded size, by the bytes of a column."""
    for i, j in pieces(pc.binary_length(batch.column(column)).to_pylist(), limit):
        yield batch.slice(i, j - i)


def _arrays(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def places(sizes: np.ndarray) -> np.ndarray:
    """Where the tokens are in the array of ``padded``."""
    begin = np.cumsum(sizes + WIDTH) - sizes
    return np.repeat(begin, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Network:
    """Weights in one float32 vector; the parts are views of it.  A softmax's
    bias stands beside its weights, for a last column of ones beside h."""

    def __init__(self, flat: np.ndarray | None = None, seed: int = 5):
        shapes = [(len(SIDES), SIZE, HIDDEN), (HIDDEN,), (HEAD + CLASSES, HIDDEN + 1), (CLASSES, EACH, HIDDEN + 1)]
        total = sum(int(np.prod(s)) for s in shapes)
        self.flat, at, parts = np.empty(total, np.float32) if flat is None else flat, 0, []
        for s in shapes:
            n = int(np.prod(s))
            parts.append(self.flat[at:at + n].reshape(s))
            at += n
        self.embed, self.bias, self.head, self.tail = parts
        self.top, self.top_bias = self.head[:, :HIDDEN], self.head[:, HIDDEN]
        self.low, self.low_bias = self.tail[:, :, :HIDDEN], self.tail[:, :, HIDDEN]
        if flat is None:
            start, at = (np.random.default_rng(seed).standard_normal(total) * 0.1).astype(np.float32), 0
            for part in (self.embed, self.bias, self.top, self.top_bias, self.low, self.low_bias):
                part[...] = start[at:at + part.size].reshape(part.shape)
                at += part.size

    def near(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of all embeddings together that the places see, a line for each side."""
        return ids[at + np.array(SIDES)[:, None]] + np.arange(len(SIDES))[:, None] * SIZE

    def seen(self, near: np.ndarray) -> np.ndarray:
        """h of the places that see the rows."""
        every = self.embed.reshape(-1, HIDDEN)
        h = every.take(near[0], 0)
        one = np.empty_like(h)
        for rows in near[1:]:
            h += every.take(rows, 0, out=one, mode="clip")
        h += self.bias
        return np.tanh(h, out=h)

    def hidden(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.seen(self.near(ids, at))

    def by_class(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """An order of the places by what the first softmax says of their tokens, that, the tokens, and the ranges of the classes."""
        own = ids[at]
        group = GROUP.take(own)
        order = np.argsort(group, kind="stable")
        group, own = group.take(order), own.take(order)
        edge = np.searchsorted(group, np.arange(HEAD, HEAD + CLASSES + 1)).tolist()
        return order, group, own, [(c, i, j) for c, (i, j) in enumerate(zip(edge, edge[1:])) if i < j]

    def in_top(self, h: np.ndarray) -> np.ndarray:
        """What the first softmax is taken of, a column for each row of ``h`` (``_with_one``)."""
        return self.head @ h.T

    def in_class(self, h: np.ndarray, own: np.ndarray, classes: list) -> tuple[np.ndarray, np.ndarray]:
        """The same of the second softmax for the places that have a class, all classes in one table, and the tokens' rows in it."""
        begin = classes[0][1]
        x = np.empty((EACH, len(h) - begin), np.float32)
        for c, i, j in classes:
            np.matmul(self.tail[c], h[i:j].T, out=x[:, i - begin:j - begin])
        return x, (own[begin:] - HEAD) % EACH

    def log_p(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log p of the tokens at the places, each from both its sides."""
        order, group, own, classes = self.by_class(ids, at)
        h = _with_one(self.hidden(ids, at[order]))
        p = _log_softmax_at(self.in_top(h), group)
        if classes:
            p[classes[0][1]:] += _log_softmax_at(*self.in_class(h, own, classes))
        out = np.empty(len(at), np.float32)
        out[order] = p
        return out

    def step(self, ids: np.ndarray, at: np.ndarray, rate: float) -> None:
        """One gradient step on the mean log-likelihood of the places."""
        order, group, own, classes = self.by_class(ids, at)
        n, rate = len(at), np.float32(rate / len(at))
        near = self.near(ids, at[order])
        h = self.seen(near)
        one = _with_one(h)
        g, scale = _residual(self.in_top(one), group)
        dh = g.T @ self.top
        dh *= scale[:, None]
        self.head -= g @ (one * (rate * scale)[:, None])
        if classes:
            begin = classes[0][1]
            every, scale = _residual(*self.in_class(one, own, classes))
            scaled, more = one[begin:] * (rate * scale)[:, None], np.empty((n - begin, HIDDEN), np.float32)
            for c, i, j in classes:
                i, j = i - begin, j - begin
                r = every[:, i:j]
                np.matmul(r.T, self.low[c], out=more[i:j])
                self.tail[c] -= r @ scaled[i:j]
            more *= scale[:, None]
            dh[begin:] += more
        dh *= 1 - h * h
        dh *= rate
        self.bias -= np.ones(n, np.float32) @ dh
        near = near.astype(np.uint16).ravel()
        order = np.argsort(near, kind="stable")
        s = near.take(order)
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        dh = dh.take(np.tile(np.arange(n), len(SIDES)).take(order), 0)
        # Two numbers as a complex one: the same sums in half the steps.
        every, rows = self.embed.reshape(-1, HIDDEN), s.take(first)
        every[rows] = every.take(rows, 0) - np.add.reduceat(dh.view(np.complex64), first, axis=0).view(np.float32)


def _with_one(h: np.ndarray) -> np.ndarray:
    """``h`` and a column of ones."""
    out = np.empty((len(h), HIDDEN + 1), np.float32)
    out[:, :HIDDEN] = h
    out[:, HIDDEN] = 1
    return out


def _safe(x: np.ndarray) -> None:
    """Lower the columns by their greatest number unless all numbers are SAFE; a softmax stays the same."""
    if not (x.min() > -SAFE and x.max() < SAFE):
        x -= x.max(0)


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the rows ``at``, a column each."""
    _safe(x)
    own = x[at, np.arange(len(at))]
    return own - np.log(np.exp(x, out=x).sum(0))


def _residual(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Softmax less one in the rows ``at``, up to a factor for each column, and the factors."""
    _safe(x)
    np.exp(x, out=x)
    total = x.sum(0)
    x[at, np.arange(len(at))] -= total
    return x, 1 / total


def chosen(own: np.ndarray, sizes: np.ndarray, turn: int, masked: float) -> np.ndarray:
    """Which tokens of the texts a round masks: its share of the range of a hash
    of the text's hash and place, so 1 / masked rounds together take every token."""
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = hashes.mix((np.repeat(own.astype(np.uint64), sizes) << np.uint64(32)) + inside.astype(np.uint64)) >> np.uint64(32)
    share = int(np.ceil(masked * 2**32))
    return (at - np.uint64(turn * share % 2**32)) % np.uint64(2**32) < np.uint64(share)


def train(encoded: DataFrame, rounds: int = 2, masked: float = 0.5, rate: float = 1.5, batch: int = 2048, chunks: int = 64) -> Network:
    """Average of the tasks' networks over ``encode``'s rows after each round; a
    ``masked`` share of all places is predicted in each, another one each time
    (``chosen``).  A step has ``batch`` places, fewer at the end of a part."""
    spark = encoded.sparkSession
    net = Network()
    width = -(-len(net.flat) // chunks)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(net.flat)

        def run(batches: Iterator[pa.RecordBatch], turn=turn) -> Iterator[pa.RecordBatch]:
            own, done = Network(sent.value.copy()), 0
            for b in batches:
                for part in _runs(b, 0):
                    ids, sizes = padded(_arrays(part.column(0), np.uint16))
                    pick = places(sizes)[chosen(np.array(part.column(1).to_pylist()), sizes, turn, masked)]
                    for i in range(0, len(pick), batch):
                        at = pick[i:i + batch]
                        own.step(ids, at, rate * len(at) / batch)
                    done += len(pick)
            if done:
                flat = own.flat
                yield pa.RecordBatch.from_arrays([pa.array(range(chunks), pa.int32()), pa.array([done] * chunks, pa.int64()), pa.array(
                    [flat[k * width:(k + 1) * width].tobytes() for k in range(chunks)], pa.binary())], names=["chunk", "n", "part"])

        rows = encoded.select("ids", "own").mapInArrow(run, "chunk int, n long, part binary")

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list] = {}
            for b in batches:
                for c, m, part in zip(*(b.column(k).to_pylist() for k in range(3))):
                    x = np.frombuffer(part, np.float32).astype(np.float64) * m
                    own = total.setdefault(c, [0, 0.0])
                    own[0] += m
                    own[1] = own[1] + x
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(
                [(x / m).astype(np.float32).tobytes() for m, x in total.values()], pa.binary())], names=["chunk", "part"])

        parts = rows.repartition(min(n, chunks), "chunk").mapInArrow(mean, "chunk int, part binary").collect()
        if parts:
            net = Network(np.frombuffer(b"".join(r["part"] for r in sorted(parts, key=lambda r: r["chunk"])), np.float32).copy())
    return net


def score(encoded: DataFrame, net: Network, block: int = 1 << 13) -> DataFrame:
    """The columns kept by ``encode`` beside n_tokens, n_recalled (tokens in
    blocks that another document holds too), network_log_likelihood,
    log_likelihood (natural log) and perplexity."""
    spark = encoded.sparkSession
    sent = spark.sparkContext.broadcast(net.flat)
    schema = T.StructType([encoded.schema["__row"], *T._parse_datatype_string(
        "n_tokens bigint, network_log_likelihood double, blocks array<struct<hash:bigint,k:bigint,gain:double>>").fields])
    kinds = [f.type for f in to_arrow_schema(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(sent.value)
        for b in batches:
            for part in _runs(b, 1):
                ids, sizes = padded(_arrays(part.column(1), np.uint16))
                at = places(sizes)
                p = np.empty(len(at))
                for i in range(0, len(at), block):
                    p[i:i + block] = network.log_p(ids, at[i:i + block])
                p[ids[at] <= BY_LENGTH] += np.concatenate([*_arrays(part.column(2), np.float32), np.empty(0, np.float32)])
                gain = np.concatenate([[0.0], np.cumsum(np.logaddexp(np.log(RECALL), np.log(1 - RECALL) + p) - p)])
                edge = np.concatenate([[0], np.cumsum(sizes)])
                total = np.concatenate([[0.0], np.cumsum(p)])
                total = total[edge[1:]] - total[edge[:-1]]
                own, ends = part.column(3), part.column(4)
                many = pc.list_value_length(ends).to_numpy()
                end = ends.flatten().to_numpy() + np.repeat(edge[:-1], many)
                first = np.concatenate([[0], end[:-1]])  # a text's first block begins where the text before ends
                rows = pa.StructArray.from_arrays([own.flatten(), pa.array(end - first), pa.array(gain[end] - gain[first])], names=["hash", "k", "gain"])
                found = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, kinds[1]), pa.array(total, kinds[2]), found.cast(kinds[3])], names=schema.names)

    store = Store(spark, "pseudo")
    found = encoded.select("__row", "ids", "spelled", "hashes", "ends").mapInArrow(run, schema)
    found = store.keep(found.withColumn("__id", F.monotonically_increasing_id()), "found")
    each = found.select("__id", F.inline("blocks"))
    shared = each.groupBy("hash").agg(F.count("*").alias("n"), F.min("__id").alias("__a"), F.max("__id").alias("__b"))
    shared = store.keep(shared.where("__a < __b").select("hash", "n"), "shared")  # in two documents or more
    least = (found.agg(F.sum(F.size("blocks"))).first()[0] or 0) // COMMON + 1
    common = F.broadcast(shared.where(F.col("n") > least).select("hash", F.lit(True).alias("__common")))
    each = each.join(common, "hash", "left")
    rest = each.where("__common IS NULL").join(shared.where(F.col("n") <= least).select("hash"), "hash", "left_semi")
    more = each.where("__common").select("__id", "k", "gain").unionByName(rest.select("__id", "k", "gain"))
    more = more.groupBy("__id").agg(F.sum("k").alias("__k"), F.sum("gain").alias("__gain"))
    rows = found.select("__id", "__row", "n_tokens", "network_log_likelihood").join(more, "__id", "left")
    log_p = F.col("network_log_likelihood") + F.coalesce("__gain", F.lit(0.0))
    return rows.select("__row.*", "n_tokens", F.coalesce("__k", F.lit(0)).alias("n_recalled"), "network_log_likelihood", log_p.alias("log_likelihood"),
                       F.when(F.col("n_tokens") > 0, F.exp(-log_p / F.col("n_tokens"))).alias("perplexity"))


def pseudo_likelihood(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The corpus's words, its spelling, the encoded texts, the network trained on them, their scores."""
    store = Store(docs.sparkSession, "pseudo")
    counts = store.keep(word_counts(docs, text), "counts")
    known = vocabulary(docs, text, counts)
    encoded = store.keep(encode(docs, known, spelling(counts, known), text, keep), "encoded")
    return score(encoded, train(encoded))


QUERY = "op6_pseudo_likelihood"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = None
