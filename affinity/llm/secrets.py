"""Secret scan: fixed patterns plus a battery of randomness tests.

Base kinds (``assign``, ``access``, ``hex``) are patterns.  The method adds the
kind ``random``: tokens with letters and digits that no pattern names, but that
look drawn at random (tokens of letters only or digits only never count).  Of a
token that a pattern names in part, what is left beside it is tested.  For each candidate token the encoding is inferred
(hex, base32, lower or upper base36, base62, base64) and three tests of its
symbols against that alphabet are made:

* chi-squared uniformity over equal bins of the alphabet,
* a runs test of symbols below and above the alphabet's middle,
* lag-one serial correlation of symbol numbers.

A token that any of them rejects (at ``alpha`` over the three) is not random.
For the rest, the likelihood of its symbol pairs under the corpus's own pair
frequencies against that of uniform draws of the encoding gives a p-value of "ordinary text"
(a likelihood ratio exceeds 1/p with probability p at most).  It falls with
length by itself; false discoveries are controlled at rate ``q`` by
Benjamini-Hochberg within each length band, over all candidates of the corpus.

Three scans: pair counts (all texts), candidates' p-values as counts by
(band, bin), and the final one with the thresholds broadcast.  What is gathered
is bounded: 64 x 64 pairs, bands x bins.

Defined results: null is empty text with no spans; empty tables give empty
results; repeated documents are scanned one by one; other columns are unread.
"""

from __future__ import annotations

import math
import re
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from affinity.llm.rows import gather_texts, map_texts

KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[A-Za-z]")
_NEEDS = ("passw", "secret", "token", "api")

#: Alphabets in order of size; the first that holds all symbols of a token is its encoding.
ALPHABETS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz", "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
}
BANDS = (16, 24, 32, 64)  # lengths at which a band begins
BIN = 0.25  # width of a bin of -log10 p
BINS = 400

# Symbol classes of the pair model: letters and digits by themselves, the rest of base64 as one, other bytes as one.
_CLASS = np.full(256, 63, np.uint16)
for _i, _c in enumerate(ALPHABETS["base62"]):
    _CLASS[ord(_c)] = _i
for _c in "+/_-=":
    _CLASS[ord(_c)] = 62
#: Upper case, lower case, digits, the rest of base64, everything else.
GROUPS = ((0, 26), (26, 52), (52, 62), (62, 63), (63, 64))
_GROUP = np.array([g for g, (a, b) in enumerate(GROUPS) for _ in range(a, b)])
#: Ordinary names mix groups more often than prose: its rate of changes is taken as this at least.
LEAST_CHANGE = 0.05


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in _NEEDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def encoding(token: str) -> str:
    body = token.rstrip("=")
    for name, symbols in ALPHABETS.items():
        if set(body) <= set(symbols):
            return name
    return "base64"


def battery(token: str) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation, each against random draws of the inferred alphabet."""
    symbols = ALPHABETS[encoding(token)]
    x = np.array([symbols.find(c) for c in token.rstrip("=") if c in symbols], float)
    n, k = len(x), len(symbols)
    if n < 8:
        return 0.0, 0.0, 0.0
    bins = int(max(2, min(k, n // 5)))
    edges = np.floor(np.arange(bins + 1) * k / bins)
    expect = n * np.diff(edges) / k
    chi = float((((np.histogram(x, edges)[0]) - expect) ** 2 / expect).sum())
    free = bins - 1
    # Wilson-Hilferty: the cube root of chi-squared over its degrees is nearly normal.
    uniform = 1 - NormalDist().cdf(((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)))
    high = x >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if a and b:
        mean = 1 + 2 * a * b / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        run_p = 2 * (1 - NormalDist().cdf(abs(runs - mean) / math.sqrt(var)))
    else:
        run_p = 2.0 ** (1 - n)
    y = x - x.mean()
    var = float((y * y).sum())
    r = float((y[1:] * y[:-1]).sum()) / var if var else 1.0
    return uniform, run_p, 2 * (1 - NormalDist().cdf(abs(r + 1 / n) * math.sqrt(n)))


def is_random(token: str, alpha: float) -> bool:
    return min(battery(token)) >= alpha / 3


def score(token: str, model: tuple[np.ndarray, float], alpha: float) -> float:
    """-log10 of the token's p-value of ordinary text; 0 if the battery says it isn't random.

    Ordinary text stays in its group of symbols or changes it, and then takes a
    symbol of the group by the one before; uniform draws take any symbol."""
    pairs, change = model
    symbols = ALPHABETS[encoding(token)]
    c = _CLASS[np.frombuffer(token.rstrip("=").encode(), np.uint8)]
    groups = len({_GROUP[_CLASS[ord(x)]] for x in symbols})
    gain = float(pairs[c[:-1], c[1:]].sum()) + (len(c) - 1) * math.log10(len(symbols))
    if groups > 1:
        changes = int((_GROUP[c[1:]] != _GROUP[c[:-1]]).sum())
        gain += changes * math.log10(change / (groups - 1)) + (len(c) - 1 - changes) * math.log10(1 - change)
    return -gain if gain < 0 and is_random(token, alpha) else 0.0


def candidates(text: str) -> list[tuple[int, int]]:
    """Tokens of 16 or more symbols with a letter and a digit."""
    if not any(d in text for d in "0123456789"):
        return []
    return [(m.start(), m.end()) for m in CANDIDATE.finditer(text) if _DIGIT.search(m[0]) and _LETTER.search(m[0])]


def unnamed(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Candidates outside the base spans: of one that they overlap, the pieces
    beside them that are candidates, without signs at the cut."""
    out = []
    for a, b in candidates(text):
        over = [(x, y) for x, y, _ in base if a < y and x < b]
        if not over:
            out.append((a, b))
            continue
        at = a
        for x, y in [*over, (b, b)]:
            i, j = at, x
            while a < i < j and text[i] in "+/_=-":
                i += 1
            while i < j < b and text[j - 1] in "+/_=-":
                j -= 1
            out += [(i + c, i + d) for c, d in candidates(text[i:j])] if i < j else []
            at = max(at, y)
    return out


def band(length: int) -> int:
    return sum(length >= b for b in BANDS) - 1


def pair_model(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, float]:
    """log10 P(next symbol | symbol, group of the next) over all texts, smoothed
    by five uniform counts a symbol, and how often letters and digits change
    their group; 64 x 64 whatever the corpus."""

    def step(acc, texts):
        c = _CLASS[np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), np.uint8)]
        if len(c) > 1:
            acc += np.bincount(c[:-1] * np.uint16(64) + c[1:], minlength=4096)

    def finish(acc):
        at = np.flatnonzero(acc)
        return [at.tolist(), acc[at].tolist()]

    rows = gather_texts(docs, text, "pair int, n long", lambda: np.zeros(4096, np.int64), step, finish)
    count = np.full(4096, 5.0)
    for r in rows.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        count[r["pair"]] += r["n"]
    count = count.reshape(64, 64)
    named = count[:62, :62]
    change = float(named[_GROUP[:62, None] != _GROUP[None, :62]].sum() / named.sum())
    for a, b in GROUPS:  # given that the next symbol is of this group
        count[:, a:b] /= count[:, a:b].sum(1, keepdims=True)
    return np.log10(count), min(max(change, LEAST_CHANGE), 0.5)


def thresholds(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", q: float = 0.01, alpha: float = 0.001) -> list[float]:
    """For each length band the least -log10 p that Benjamini-Hochberg admits (infinite: none)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def step(acc, texts):
        for t in texts:
            for a, b in unnamed(t, base_spans(t)):
                token = t[a:b]
                p = score(token, sent.value, alpha)
                acc[band(b - a), min(BINS - 1, int(p / BIN))] += 1

    def finish(acc):
        i, j = np.nonzero(acc)
        return [i.tolist(), j.tolist(), acc[i, j].tolist()]

    rows = gather_texts(docs, text, "band int, bin int, n long", lambda: np.zeros((len(BANDS), BINS), np.int64), step, finish)
    count = np.zeros((len(BANDS), BINS), np.int64)
    for r in rows.groupBy("band", "bin").agg(F.sum("n").alias("n")).collect():
        count[r["band"], r["bin"]] = r["n"]
    out = []
    for row in count:
        m, above = int(row.sum()), np.cumsum(row[::-1])[::-1]
        # A bin's least value stands for all of it, so its p-value is never understated.
        good = [j * BIN for j in range(1, BINS) if above[j] and 10 ** (-j * BIN) <= q * above[j] / m]
        out.append(min(good) if good else math.inf)
    return out


def scan_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), q: float = 0.01,
                 alpha: float = 0.001, mask: str = "[SECRET]") -> DataFrame:
    """``keep`` columns of every document beside base and all spans
    (array of struct(start, end, kind), code points, end exclusive) and
    masked_text."""
    model = pair_model(docs, text)
    least = thresholds(docs, model, text, q, alpha)
    sent = docs.sparkSession.sparkContext.broadcast((model, least))

    def step(texts):
        known, limit = sent.value
        base, spans, masked = [], [], []
        for t in texts:
            own = base_spans(t)
            more = [(a, b, "random") for a, b in unnamed(t, own) if (p := score(t[a:b], known, alpha)) > 0 and p >= limit[band(b - a)]]
            both = sorted(own + more, key=lambda x: (x[0], KINDS.index(x[2])))
            base.append(own)
            spans.append(both)
            masked.append(masked_text(t, both, mask) if both else t)
        as_rows = lambda found: [[{"start": a, "end": b, "kind": k} for a, b, k in x] for x in found]
        return [as_rows(base), as_rows(spans), masked]

    kind = "array<struct<start:bigint,end:bigint,kind:string>>"
    return map_texts(docs, text, list(keep), f"base {kind}, spans {kind}, masked_text string", step)


def masked_text(text: str, found, mask: str) -> str:
    """Spans that touch or overlap become one mask."""
    parts, at = [], 0
    for a, b, _ in found:
        if a >= at:
            parts += [text[at:a], mask]
        at = max(at, b)
    return "".join(parts) + text[at:]


QUERY = "op3_secret_scan"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return d.select("doc_id", count("assign"), count("access"), count("hex"),
                    F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"))


#: The randomness battery has no SQL form; tests hold the query against a plain version of it.
ORACLE_SQL = None
