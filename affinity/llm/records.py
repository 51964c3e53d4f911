"""Token ids as length-delimited binary records with an offset index.

File format, all numbers little-endian:

    record  = u32 length | u32 masked crc32 of the 4 length bytes
              | payload (length bytes) | u32 masked crc32 of the payload
    payload = u8 width (2 or 4 bytes an id) | zstd frame of the ids

    masked(c) = ((c >> 15 | c << 17) + 0xA282EAD8) modulo 2**32

Records lie in shard files in ascending key order, shards in ascending key
ranges.  The index is a Parquet table of its own (key, shard, offset, length,
n_tokens, start), so a reader can shuffle rows of the index and seek.

A shard file is named after the task attempt that wrote it and index rows name
the file, so a lost executor's or a speculative attempt's leftovers are never
read.  The index is written out before anything reads it back.

Defined results: null is empty text, which is the end id alone; repeated rows
are records of their own, next to each other; a null key sorts first; an empty
table has an empty index and result; other columns are unread.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from affinity.llm.rows import map_texts
from affinity.session import scratch_path

MASK = 0xA282EAD8
#: Chunks of text that a worker remembers between batches, in each of two generations.
REMEMBERED = 600_000


def masked(data: bytes) -> bytes:
    c = zlib.crc32(data)
    return ((((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF).to_bytes(4, "little")


def pack(ids: np.ndarray) -> bytes:
    """A record's payload."""
    import zstandard

    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(ids.astype(f"<u{width}").tobytes())


def unpack(payload: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[1:]), f"<u{payload[0]}").astype("<u4")


def frame(payload: bytes) -> bytes:
    head = len(payload).to_bytes(4, "little")
    return head + masked(head) + payload + masked(payload)


def read_record(file) -> bytes:
    """The payload at the file's position; both checksums must hold."""
    head, check = file.read(4), file.read(4)
    if masked(head) != check:
        raise ValueError("record length is damaged")
    payload = file.read(int.from_bytes(head, "little"))
    if masked(payload) != file.read(4):
        raise ValueError("record payload is damaged")
    return payload


class Encoder:
    """The tokenizers library over distinct chunks of text.

    The vocabulary drops white space between words, folds case, and takes runs of
    letters, single digits and runs of other symbols by themselves, so a text's
    ids are those of its chunks between blanks and line ends, in any case of
    ASCII letters.  Where full stops and commas are a text's only symbols and
    never stand together, they are chunks too.  New chunks are encoded in one
    text with a special token between them; a text that could hold a special
    token is encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.mark_id, self.mark = max((i, t.content) for i, t in self.library.get_added_tokens_decoder().items())
        words = self.library.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(words.values()) + 3, bool)
        self.ends_word[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def alone(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def chunks(self, text: str) -> list[bytes] | None:
        if "<|" in text:
            return None
        t = text.encode("utf-8", "surrogatepass").lower()
        if not t.translate(None, _LATIN) and not any(x in t for x in _TOGETHER):
            t = t.replace(b".", b" . ").replace(b",", b" , ")
        return t.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.chunks(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        new = set().union(*(x for x in cut if x is not None)).difference(known)
        for c in [c for c in new if c in old]:
            known[c] = old[c]
        self.add([c for c in new if c not in known])
        return [self.alone(t) if x is None else b"".join(map(known.__getitem__, x)) for t, x in zip(texts, cut)]

    def add(self, chunks: list[bytes], step: int = 2000) -> None:
        """Encode chunks: a word of letters alone ends with the one id that ends
        a word, so blanks part them; others are parted by the special token."""
        letters = [c for c in chunks if not c.translate(None, _LETTERS) and b"\xc3\x97" not in c and b"\xc3\xb7" not in c]
        rest = list(set(chunks).difference(letters))
        for some, between in ((letters, " "), (rest, self.mark)):
            groups = [some[i:i + step] for i in range(0, len(some), step)]
            texts = [between.encode().join(g).decode("utf-8", "surrogatepass") for g in groups]
            for group, e in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                if between == " ":
                    ends = np.flatnonzero(self.ends_word[ids]) + 1
                    begins, skip = ends[:-1], 0
                else:
                    ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
                    begins, skip = ends[:-1], 1
                if len(ends) != len(group):
                    raise ValueError("chunks and ids don't match")
                data = ids.tobytes()
                for c, a, b in zip(group, [0, *(4 * (begins + skip)).tolist()], (4 * ends).tolist()):
                    self.known[c] = data[a:b]


_LETTERS = bytes([195, *range(97, 123), *range(128, 192)])
# Bytes of folded Latin-1 letters, digits, blanks, full stops and commas; symbols that must not be cut apart.
_LATIN = bytes([32, 44, 46, 195, *range(48, 58), *range(97, 123), *range(128, 192)])
_TOGETHER = (b"..", b",,", b".,", b",.", b"\xc3\x97", b"\xc3\xb7")

_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def encode_payloads(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, payload) of every document, the end id appended."""

    def step(texts):
        end = np.array([end_id], "<u4").tobytes()
        ids = [np.frombuffer(x + end, "<u4") for x in encoder(tokenizer).encode(texts)]
        return [[len(x) for x in ids], [pack(x) for x in ids]]

    return map_texts(docs, text, [key], "n_tokens bigint, payload binary", step)


def _open(base: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(base if "://" in base or base.startswith(("file:", "hdfs:")) else "file://" + os.path.abspath(base))


def write_records(payloads: DataFrame, keys: DataFrame, path: str, key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Write shards and index under ``path``; returns the index as read back.  ``keys``: a table with the same keys.

    ``path`` is a folder that driver and executors share.  Keys are dealt by
    range, so one shard is one task's memory at a time: a record, not a shard."""
    spark = payloads.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([payloads.schema[key]] + T._parse_datatype_string(
        "shard int, file string, offset bigint, length bigint, n_tokens bigint, start_in_shard bigint").fields)
    names = schema.names
    types = [f.type for f in to_arrow_schema(schema)]
    where = payloads.columns.index(key), payloads.columns.index("n_tokens"), payloads.columns.index("payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId()
        fs, root = _open(path)
        file = f"shard-{shard:06d}-{task.taskAttemptId()}.rec"
        out, offset, start = None, 0, 0
        for b in batches:
            counts, data = (b.column(k).to_pylist() for k in where[1:])
            if not counts:
                continue
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{file}")
            offsets, lengths, starts = [], [], []
            for k, p in zip(counts, data):
                record = frame(p)
                out.write(record)
                offsets.append(offset)
                lengths.append(len(record))
                starts.append(start)
                offset += len(record)
                start += k
            m = len(counts)
            yield pa.RecordBatch.from_arrays([b.column(where[0])] + [pa.array(c, t) for c, t in zip(
                ([shard] * m, [file] * m, offsets, lengths, counts, starts), types[1:])], names=names)
        if out is not None:
            out.close()

    # Bounds from the keys alone: dealing by range would run the encoding once more to sample it.
    bounds = keys.select(F.percentile_approx(key, [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    shard = F.lit(0)
    if bounds:
        shard = F.coalesce(F.size(F.filter(F.lit(sorted(set(bounds))), lambda b: b < F.col(key))), F.lit(0))
    dealt = payloads.repartitionById(n, shard.cast("int")).sortWithinPartitions(F.col(key).asc_nulls_first(), "payload")
    rows = dealt.mapInArrow(run, schema)
    rows.write.mode("overwrite").parquet(f"{path}/written")
    written = spark.read.schema(schema).parquet(f"{path}/written")
    # Tokens before each shard: one row a shard.
    totals = written.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return written.join(totals, "shard").select(
        key, "shard", "file", "offset", "length", "n_tokens", (F.col("before") + F.col("start_in_shard")).alias("start"))


def read_records(index: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of the index beside the record's ids as little-endian 32-bit numbers, in any order of index rows."""
    d = index.select(*keep, F.col("file").alias("__file"), F.col("offset").alias("__offset"))
    schema = T.StructType(d.schema.fields[:-2] + [T.StructField("ids", T.BinaryType())])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(path)
        name, file = None, None
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                out = []
                for f, o in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist()):
                    if f != name:
                        if file is not None:
                            file.close()
                        name, file = f, fs.open_input_file(f"{root}/{f}")
                    file.seek(o)
                    out.append(unpack(read_record(file)).tobytes())
                yield pa.RecordBatch.from_arrays([part.column(k) for k in range(n)] + [pa.array(out, pa.binary())], names=schema.names)
        if file is not None:
            file.close()

    return d.mapInArrow(run, schema)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERY = "op7_token_records"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, f"records-{uuid.uuid4().hex}")
    index = write_records(encode_payloads(docs, tokenizer_path(), end_id=1), docs, path)
    back = read_records(index, path, ["doc_id", "start"])
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


ORACLE_SQL = None
