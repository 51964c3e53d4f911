import io
import random
import uuid
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from affinity.llm import records as R
from affinity.session import scratch_path
from cases import docs, texts


def test_frame_round_trip_and_damage():
    ids = np.array([0, 1, 70_000, 49_407], "<u4")
    data = R.frame(R.pack(ids))
    assert R.unpack(R.read_record(io.BytesIO(data))).tolist() == ids.tolist()
    for at in (0, 5, 10, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            R.read_record(io.BytesIO(bytes(bad)))


def test_encoder_equals_the_library():
    library, e = Tokenizer.from_file(R.tokenizer_path()), R.Encoder(R.tokenizer_path())
    rng = random.Random(8)
    pieces = [" ", "\n", "\t", "é", "é", "<|endoftext|>", "<|", "a", "Foo", "Σ", "İ", "'s", "\x1c", "1", "日", "!", "\xa0", "\x85", "\r", ".", ",", "...", "×", "»", "word. ", "word, "]
    some = [t or "" for t in texts()] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(4000)]
    for t, x in zip(some, e.encode(some)):
        assert np.frombuffer(x, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_files_hold_all_documents_in_order(spark):
    some = texts()
    ids = list(range(100, 100 + len(some)))
    random.Random(9).shuffle(ids)
    d = docs(spark, some, ids).repartition(3)
    path = scratch_path(spark, f"test-records-{uuid.uuid4().hex}")
    index = R.write_records(R.encode_payloads(d, R.tokenizer_path(), 1), d, path, partitions=5)
    rows = sorted(R.read_records(index, path, ["doc_id", "start", "n_tokens", "shard", "offset"]).collect())
    library = Tokenizer.from_file(R.tokenizer_path())
    at, text = 0, dict(zip(ids, some))
    for r in rows:
        want = np.array([*library.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.start, r.n_tokens, zlib.crc32(r.ids)) == (at, len(want), zlib.crc32(want.tobytes()))
        at += len(want)
    assert len(rows) == len(some) and len({r["shard"] for r in rows}) > 1
    assert [(r["shard"], r["offset"]) for r in rows] == sorted((r["shard"], r["offset"]) for r in rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    d = docs(spark, ["b", "a", "c"], [5, 5, None])
    path = scratch_path(spark, f"test-records-{uuid.uuid4().hex}")
    index = R.write_records(R.encode_payloads(d, R.tokenizer_path(), 1), d, path, partitions=2)
    rows = sorted(index.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 5, 5] and [r["start"] for r in rows] == [0, 2, 4]
    none = d.limit(0)
    index = R.write_records(R.encode_payloads(none, R.tokenizer_path(), 1), none, path + "-none", partitions=2)
    assert R.read_records(index, path + "-none", ["doc_id"]).count() == 0
