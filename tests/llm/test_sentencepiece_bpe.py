import hashlib
import random

import numpy as np
import pytest

from affinity.llm import sentencepiece_bpe as B
from cases import docs, texts


@pytest.fixture(scope="module")
def vocabulary():
    return B.vocabulary(B.model_path())


def test_ids_equal_the_library(vocabulary):
    rng = random.Random(6)
    odd = texts() + ["".join(rng.choice(" \n\tab▁é<s>0x 日,.!Thereon") for _ in range(rng.randrange(60))) for _ in range(1500)]
    odd = [t or "" for t in odd]
    ids, agreed = vocabulary.encode(odd)
    assert agreed
    for t, x in zip(odd, ids):
        assert np.frombuffer(x, "<u4").tolist() == vocabulary.library.encode(t), t


def test_both_agendas_agree(vocabulary):
    rng = random.Random(7)
    for _ in range(500):
        s = list("▁" + "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 60))))
        assert vocabulary.merged(list(s)) == vocabulary.merged_short(list(s))


def test_segments_side_by_side(vocabulary, monkeypatch):
    rng = random.Random(8)
    some = ["▁" + "".join(rng.choice("etaoinshrABé.0日\U0001f600ß") for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    some += ["\n", "▁", "a", "é", "▁" * 39, "e" * 40, "e" * 41, "ا" * 7]
    want = [np.array(vocabulary.agenda(s), "<u4").tobytes() for s in some]
    alone = []
    agenda = vocabulary.agenda
    monkeypatch.setattr(vocabulary, "agenda", lambda s: alone.append(s) or agenda(s))
    assert vocabulary.agendas(some) == want and vocabulary.agendas([]) == []
    assert not [s for s in alone if set(s) <= set("▁etaoinshrABé") and len(s) <= 40]


def test_round_trip(spark):
    some = texts()
    lib = B.vocabulary(B.model_path()).library
    for r in B.digests(docs(spark, some), B.model_path()).collect():
        ids = [lib.bos_id(), *lib.encode(some[r.doc_id] or ""), lib.eos_id()]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert B.digests(docs(spark, some).limit(0), B.model_path()).count() == 0
