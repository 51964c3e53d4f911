"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

A text becomes symbols (code points, blanks as U+2581, one blank put before
it).  An agenda holds the adjacent symbol pairs whose join is a piece, ordered
by score, then from the left; the best is merged until none is left.  Short
segments are merged side by side, one merge in each at a time.  Symbols that
are no piece become byte pieces.

No piece crosses the point between a symbol and a following U+2581, nor one
beside a code point that occurs in no longer piece, so the text is cut there
first and every distinct segment of an Arrow batch is encoded once.  Each
batch's new segments are checked against the sentencepiece library: the
library encodes them all in one text, and all ids must be equal.  A batch that
differs is taken from the library whole and counted in ``n_differing`` of its rows.

Defined results: null is empty text, which is the begin and end ids alone;
long texts cost n log n in the agenda; repeated rows and other columns have no
influence; an empty table gives an empty result.  The model file is a
parameter; executors read it from the same path.
"""

from __future__ import annotations

import heapq
import re
import struct
from itertools import repeat
from operator import add

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from affinity.llm.rows import map_texts

BLANK = "▁"
#: Segments that a worker remembers between batches, in each of two generations.
REMEMBERED = 200_000
NO_PIECE = float("-inf")
#: Segments of at most so many code points are merged side by side, those of about one length together.
WIDTHS = (8, 12, 20, 40)


def packed(ids: list[int]) -> bytes:
    """Little-endian 32 bits each; for a few ids quicker than an array."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Vocabulary:
    """Pieces, scores and byte pieces of a model, read through the library."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        special = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.ids = {sp.id_to_piece(i): i for i in range(size) if i not in special}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece holds a blank behind another symbol: texts can't be cut at blanks")
        # Code points that are alone in their piece, of those that texts hold often.
        self.alone = [c for c in "\n\t\r" if c not in inside]
        alone = "".join(map(re.escape, self.alone))
        not_alone = f"[^{BLANK}{alone}]"
        self.segments = re.compile(f"{BLANK}+{not_alone}*|{not_alone}+" + (f"|[{alone}]" if alone else ""))
        pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        # Last marks that no piece joins to a letter before them: a segment's ids are those of its body and of the mark.
        self.marks = {m: None for m in ".,;:!?" if not any(p[1] == m and p[0].isalpha() for p in pairs)}
        self.marks = {m: np.array(self.agenda(m), "<u4").tobytes() for m in self.marks}
        self._tables(sorted(inside))
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def agenda(self, segment: str) -> list[int]:
        """Ids of one segment by merging the best pair first."""
        symbols = self.merged(list(segment)) if len(segment) > 40 else self.merged_short(list(segment))
        try:
            return [self.ids[s] for s in symbols]
        except KeyError:  # some symbol is no piece
            out = []
        for s in symbols:
            found = self.ids.get(s)
            if found is not None:
                out.append(found)
            else:
                out += [self.bytes[b] for b in s.encode("utf-8")]
        return out

    def _tables(self, inside: list[str]) -> None:
        """Symbols as numbers: code points that occur in longer pieces, then those pieces; and which two make a third."""
        symbols = {c: i for i, c in enumerate([*inside, *(p for p in self.ids if len(p) > 1)])}
        self.number = np.full(0x110000, -1, np.int32)
        self.number[list(map(ord, inside))] = range(len(inside))
        self.id_of = np.array([self.ids.get(s, -1) for s in symbols], np.int64)
        made = sorted((symbols[p[:i]] * len(symbols) + symbols[p[i:]], symbols[p], self.scores[p]) for p in symbols if len(p) > 1
                      for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols)
        self.pair, self.whole = (np.array([m[k] for m in made] + [-1], np.int64) for k in range(2))
        self.score = np.array([m[2] for m in made] + [NO_PIECE])

    def _joined(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score and the number of the piece that two symbols make."""
        key = a.astype(np.int64) * len(self.id_of) + b
        at = np.searchsorted(self.pair[:-1], key)
        at[self.pair[at] != key] = len(self.pair) - 1
        return self.score[at], self.whole[at]

    def agendas(self, segments: list[str]) -> list[bytes]:
        """``agenda`` of each segment as bytes: one merge in every segment at a time."""
        out = [b""] * len(segments)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        code = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4")
        number, begin = self.number[code], np.cumsum(sizes) - sizes
        plain = np.ones(len(segments), bool)
        plain[np.repeat(np.arange(len(segments)), sizes)[number < 0]] = False
        least = 0
        for width in WIDTHS:
            some = np.flatnonzero(plain & (sizes > least) & (sizes <= width))
            least = width
            if len(some):
                self._side_by_side(some, sizes[some], number, begin[some], width, out)
        for k in np.flatnonzero(~plain | (sizes > least)).tolist():
            out[k] = packed(self.agenda(segments[k]))
        for k in [k for k in np.flatnonzero(plain & (sizes <= least)).tolist() if not out[k]]:  # some symbol is no piece
            out[k] = packed(self.agenda(segments[k]))
        return out

    def _side_by_side(self, some: np.ndarray, sizes: np.ndarray, number: np.ndarray, begin: np.ndarray, width: int, out: list[bytes]) -> None:
        """Merge segments ``some``, a row each; ``out`` gets their ids, unless a symbol has none."""
        n, place = len(some), np.arange(width)
        held = place < sizes[:, None]
        symbol = np.where(held, number[np.minimum(begin[:, None] + place, len(number) - 1)], -1).ravel()
        right = np.tile(np.arange(1, width + 1), (n, 1)).ravel()  # places in the row; beyond its end: none
        left = np.tile(np.arange(-1, width - 1), (n, 1)).ravel()
        end = sizes.copy()
        score, whole = np.full(n * width, NO_PIECE), np.full(n * width, -1)
        pairs = np.flatnonzero(held[:, 1:].ravel())
        pairs += pairs // (width - 1)  # places in rows of ``width``
        score[pairs], whole[pairs] = self._joined(symbol[pairs], symbol[pairs + 1])
        row = np.arange(n)
        while len(row):
            i = score.reshape(n, width)[row].argmax(1)  # the leftmost of equals
            live = score[row * width + i] > NO_PIECE
            row, i = row[live], i[live]
            at = row * width
            j, piece = right[at + i], whole[at + i]
            after = right[at + j]
            symbol[at + i], symbol[at + j] = piece, -1
            score[at + i] = score[at + j] = NO_PIECE
            right[at + i] = after
            more = np.flatnonzero(after < end[row])
            own, next_ = (at + i)[more], (at + after)[more]
            left[next_] = i[more]
            score[own], whole[own] = self._joined(piece[more], symbol[next_])
            more = np.flatnonzero(left[at + i] >= 0)
            before = (at + left[at + i])[more]
            score[before], whole[before] = self._joined(symbol[before], piece[more])
        kept = symbol.reshape(n, width) >= 0
        ids = np.where(kept, self.id_of[symbol.reshape(n, width)], 0)
        raw = ids[kept].astype("<u4").tobytes()
        edge = np.concatenate([[0], 4 * np.cumsum(kept.sum(1))]).tolist()
        for k, good, a, b in zip(some.tolist(), (ids >= 0).all(1).tolist(), edge, edge[1:]):
            if good:
                out[k] = raw[a:b]

    def merged_short(self, symbols: list[str]) -> list[str]:
        """The agenda as a list by place: its best entry, the leftmost of equals, is merged."""
        score = self.scores.get
        agenda = list(map(score, map(add, symbols, symbols[1:]), repeat(NO_PIECE)))
        last = len(agenda)
        while last:
            best = max(agenda)
            if best == NO_PIECE:
                break
            i = agenda.index(best)
            piece = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            last -= 1
            if i < last:
                agenda[i] = score(piece + symbols[i + 1], NO_PIECE)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + piece, NO_PIECE)
        return symbols

    def merged(self, symbols: list[str]) -> list[str]:
        """The agenda as a heap over linked symbols."""
        n = len(symbols)
        scores = self.scores
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            s = scores.get(symbols[i] + symbols[i + 1])
            if s is not None:
                heap.append((-s, i, i + 1, symbols[i] + symbols[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, j, piece = heapq.heappop(heap)
            if right[i] != j or symbols[i] is None or symbols[j] is None or len(symbols[i]) + len(symbols[j]) != len(piece):
                continue  # one side was merged meanwhile
            symbols[i], symbols[j] = piece, None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                s = scores.get(piece + symbols[k])
                if s is not None:
                    heapq.heappush(heap, (-s, i, k, piece + symbols[k]))
            k = left[i]
            if k >= 0:
                s = scores.get(symbols[k] + piece)
                if s is not None:
                    heapq.heappush(heap, (-s, k, i, symbols[k] + piece))
        return [s for s in symbols if s is not None]

    def agrees(self, segments: list[str]) -> bool:
        """Whether the library gives the same ids for the segments, one on each line of one text."""
        if "\n" not in self.alone:
            return all(self.library.encode(x[1:].replace(BLANK, " ")) == np.frombuffer(self.known[x], "<u4").tolist()
                       for x in segments if x[0] == BLANK and len(x) > 1)
        line = np.array(self.agenda("\n"), "<u4").tobytes()
        ours = np.array(self.agenda(BLANK), "<u4").tobytes() + line + b"".join(self.known[x] + line for x in segments)
        text = "\n" + "".join(x + "\n" for x in segments).replace(BLANK, " ")
        return np.array(self.library.encode(text), "<u4").tobytes() == ours

    def encode(self, texts: list[str]) -> tuple[list[bytes], bool]:
        """Little-endian 32-bit ids of each text (no begin or end), and whether the library agreed."""
        cut = [self.segments.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        new = set().union(*cut).difference(known)
        for x in [x for x in new if x in old]:
            known[x] = old[x]
        new = [x for x in new if x not in known]
        marked = [x for x in new if x[-1] in self.marks and x[-2:-1].isalpha()]
        bodies = {x[:-1] for x in marked}.union(new).difference(marked)
        for x in [x for x in bodies if x in old]:
            known[x] = old[x]
        bodies = [x for x in bodies if x not in known]
        known.update(zip(bodies, self.agendas(bodies)))
        for x in marked:
            known[x] = known[x[:-1]] + self.marks[x[-1]]
        agreed = not new or self.agrees(new)
        if not agreed:
            self.known, self.old = {}, {}
            return [np.array(self.library.encode(t), "<u4").tobytes() for t in texts], False
        return [b"".join(map(known.__getitem__, c)) for c in cut], True


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per worker process and path."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def round_trip(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns beside ids (little-endian 32-bit, with begin and end), decoded and n_differing."""

    def step(texts):
        v = vocabulary(model)
        begin, end = (np.array([x], "<u4").tobytes() for x in (v.begin, v.end))
        ids, agreed = v.encode(texts)
        ids = [begin + x + end for x in ids]
        decoded = [v.library.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
        return [ids, decoded, [0 if agreed else 1] * len(texts)]

    return map_texts(docs, text, list(keep), "ids binary, decoded string, n_differing int", step)


def digests(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``round_trip`` as counts and SHA-256, without its texts."""

    d = round_trip(docs, model, text, keep)
    return d.select(*keep, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERY = "op8_sentencepiece_bpe"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path())


ORACLE_SQL = None
