"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 / -1 bits.  For each bit a binary n-gram
classifier separates the languages with +1 from those with -1: its weight of
an n-gram is the log ratio of the n-gram's mean share in the two sides.  The
n-grams (1 to 3 letters or blanks, case folded) are hashed into ``BUCKETS``.  A
text's margin for a bit is the mean weight of its n-grams, in units of what
texts of that side have on average.

Decoding is loss-weighted: the distance to a codeword is the logistic loss of
the margins against its bits, each bit weighted by how well its sides are set
apart; the nearest codeword wins.  ``score`` is its share of exp(-distance);
``ambiguous`` says that the runner-up is nearly as close.

Up to seven languages get the exhaustive code (all 2**(L-1) - 1 splits); more
get the best of a fixed number of seeded random codes.

Training counts n-grams over all training texts: one bounded table per
language (``BUCKETS`` counts), summed by Spark.  ``max_languages`` bounds what
the driver holds; more labels than that are an error, not a cut.

Defined results: null text or one without letters is ``und`` with score 0; so
is every text if nothing can be learned; a single language is always predicted,
with score 1; texts with a null label are never trained on; repeated rows count
each time; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from affinity.llm.rows import map_texts

BUCKETS = 1 << 14
_TABLE: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _TABLE[0]


def ngram_counts(text: str) -> np.ndarray | None:
    """Hashed counts of 1- to 3-grams, or None for a text without letters."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[c]
    if not letter.any():
        return None
    c = np.concatenate([[32], np.where(letter, c, 32), [32]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:]
    three = two[:-1] * np.uint32(0x85EBCA6B) + c[2:]
    out = np.zeros(BUCKETS, np.int64)
    for h, salt in ((c, 1), (two, 2), (three, 3)):
        h = (h + np.uint32(salt)) * np.uint32(0xC2B2AE35)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)
        out += np.bincount(h >> np.uint32(32 - 14), minlength=BUCKETS)
    return out


def codewords(n: int, bits: int = 63, tries: int = 64, seed: int = 7) -> np.ndarray:
    """n rows of +1 / -1."""
    if n <= 7:
        cols = [(1, *c) for c in itertools.product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(cols, np.int8).reshape(-1, n).T
    rng = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(tries):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        least = min(int((code[i] != code[j]).sum()) for i, j in itertools.combinations(range(n), 2)) if n < 200 else 0
        if least > far:
            best, far = code, least
    return best


class Model:
    """Codewords, bit classifiers and bit weights from the languages' n-gram counts."""

    def __init__(self, counts: dict[str, np.ndarray], sharpness: float = 4.0, margin: float = 1.0):
        self.languages = sorted(counts)
        self.margin = margin
        self.code = codewords(len(self.languages)) if self.languages else np.zeros((0, 0), np.int8)
        share = np.array([(counts[x] + 0.5) / (counts[x] + 0.5).sum() for x in self.languages]).reshape(-1, BUCKETS)
        bits = self.code.shape[1]
        self.weight = np.zeros((BUCKETS, bits))
        self.scale, self.trust = np.ones(bits), np.ones(bits)
        for b in range(bits):
            up = self.code[:, b] > 0
            self.weight[:, b] = np.log(share[up].mean(0)) - np.log(share[~up].mean(0))
            expected = (share @ self.weight[:, b]) * self.code[:, b]
            self.scale[b] = max(np.abs(expected).mean(), 1e-9)
            self.trust[b] = max(expected.min() / self.scale[b], 0.05)
        self.trust *= sharpness / max(self.trust.sum(), 1e-9) * max(bits, 1) / 2
        self.sharpness = sharpness

    def predict(self, counts: np.ndarray | None) -> tuple[str, float, bool]:
        if counts is None or not self.languages:
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        z = (counts @ self.weight) / counts.sum() / self.scale
        loss = np.logaddexp(0, -self.sharpness * self.code * z) @ self.trust
        order = np.argsort(loss, kind="stable")
        p = np.exp(loss[order[0]] - loss)
        return self.languages[order[0]], float(1 / p.sum()), bool(loss[order[1]] - loss[order[0]] < self.margin)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_languages: int = 1000) -> Model:
    """Fit on every row with a label and a letter."""
    d = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[str, np.ndarray] = {}
        for b in batches:
            texts, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            for t, x in zip(texts, labels):
                n = ngram_counts(t)
                if n is not None:
                    if x in acc:
                        acc[x] += n
                    else:
                        acc[x] = n
        for x, n in acc.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                                             names=["l", "bucket", "n"])

    total = d.mapInArrow(run, "l string, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n"))
    arrow = total.limit((max_languages + 1) * BUCKETS).toArrow()
    counts: dict[str, np.ndarray] = {}
    for x in arrow.column("l").unique().to_pylist():
        own = arrow.filter(pc.equal(arrow.column("l"), x))
        counts[x] = np.zeros(BUCKETS, np.int64)
        counts[x][own.column("bucket").to_numpy()] = own.column("n").to_numpy()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    return Model(counts)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns beside lang_pred, score and ambiguous."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def step(texts):
        return [list(c) for c in zip(*(sent.value.predict(ngram_counts(t)) for t in texts))] or [[], [], []]

    return map_texts(docs, text, list(keep), "lang_pred string, score double, ambiguous boolean", step)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


QUERY = "op1_language_id"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


ORACLE_SQL = None
