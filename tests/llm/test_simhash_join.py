import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from affinity.llm import simhash_join as S
from cases import docs, edited, sentences, texts


def plain_fingerprint(text):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids, fps):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = {}
    for k, c in zip(ids, label):
        least[c] = k if least.get(c) is None else least[c] if k is None else min(k, least[c])
    return [least[c] for c in label]


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"group": 4, "block": 3}])
def test_components_match_brute_force(spark, sizes):
    base = sentences(9, 300)
    some = texts() + [edited(base, k) for k in range(150, 300, 7)] + [sentences(s, 40) for s in range(100, 110)]
    ids = list(range(len(some)))
    random.Random(1).shuffle(ids)
    fps = [plain_fingerprint(t) for t in some]
    want = sorted(((k, f"{f:016x}", c) for k, f, c in zip(ids, fps, plain_components(ids, fps))), key=str)
    assert result(S.simhash_components(docs(spark, some, ids), **sizes)) == want
    assert len({c for _, _, c in want}) < len(want)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_both_orders_together_find_every_link(spark, radius, monkeypatch):
    rng = np.random.default_rng(radius)
    base = rng.integers(-1 << 63, 1 << 63, 12)
    fps = [int(b) for b in base]
    for f in list(fps):
        for _ in range(12):
            for b in rng.choice(64, rng.integers(1, radius + 2), replace=False):
                f ^= (1 << int(b)) - (1 << 64 if b == 63 else 0)
            fps.append(f)
    df = spark.createDataFrame([(i, str(f)) for i, f in enumerate(fps)], "doc_id bigint, text string")
    monkeypatch.setattr(S, "fingerprints", lambda docs, text, key: docs.select("doc_id", F.col("text").cast("bigint").alias("fp")))
    got = {r.doc_id: r.component_id for r in S.simhash_components(df, radius=radius, group=16).collect()}
    unsigned = [f % (1 << 64) for f in fps]
    label = list(range(len(fps)))
    for _ in fps:
        for i in range(len(fps)):
            label[i] = min(label[j] for j in range(len(fps)) if (unsigned[i] ^ unsigned[j]).bit_count() <= radius)
            label[i] = label[label[i]]
        if all(label[i] == label[j] for i in range(len(fps)) for j in range(i) if (unsigned[i] ^ unsigned[j]).bit_count() <= radius):
            break
    assert got == dict(enumerate(label))


def test_null_and_shared_keys_and_empty_table(spark):
    some = ["a b c d", "a b c d", "x y z w v", None, "", "q"]
    ids = [None, 5, None, 7, 7, 3]
    fps = [plain_fingerprint(t) for t in some]
    want = sorted(((k, f"{f:016x}", c) for k, f, c in zip(ids, fps, plain_components(ids, fps))), key=str)
    assert result(S.simhash_components(docs(spark, some, ids))) == want
    empty = S.simhash_components(docs(spark, ["a"]).where("false"))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"] and empty.isEmpty()


def test_hashes_are_those_of_spark(spark):
    line = "one two three"
    assert S.shingle_hashes("One\x0btwo \n THREE").view(np.int64).tolist() == [
        spark.range(1).select(F.xxhash64(F.lit(line))).first()[0]]
    assert len(S.shingle_hashes("é\x85é b\xa0c d e")) == 2 and not len(S.shingle_hashes(" \x0c "))


@pytest.mark.parametrize("spread", [64, 12, 5])
def test_index_finds_all_pairs_within_the_radius(spread):
    rng = np.random.default_rng(spread)
    bits = rng.choice(64, spread, replace=False).astype(np.uint64)
    draw = lambda n: np.unique((rng.integers(0, 2, (n, spread)).astype(np.uint64) << bits).sum(1, dtype=np.uint64))
    a, b = draw(300), draw(500)
    gap = np.bitwise_count(a[:, None] ^ b[None])
    assert {(i, j) for x, y in S.near(S.GrayIndex(a), S.GrayIndex(b), 2) for i, j in zip(x, y)} == set(zip(*np.nonzero(gap <= 2)))
    high = np.bitwise_count((a[:, None] ^ b[None]) >> np.uint64(32))
    assert {(i, j) for x, y in S.near(S.GrayIndex(a), S.GrayIndex(b), 2, 1) for i, j in zip(x, y)} == set(
        zip(*np.nonzero((gap <= 2) & (high <= 1))))
    own = np.triu(np.bitwise_count(b[:, None] ^ b[None]) <= 2, 1)
    found = [tuple(sorted(p)) for x, y in S.near(S.GrayIndex(b), S.GrayIndex(b), 2, itself=True) for p in zip(x, y)]
    assert len(found) == len(set(found)) and set(found) == set(zip(*np.nonzero(own)))


def test_index_leaves_whole_groups_unvisited(monkeypatch):
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 1 << 63, 4096).astype(np.uint64))
    seen = []
    count = np.bitwise_count
    monkeypatch.setattr(S.np, "bitwise_count", lambda x: seen.append(len(x)) or count(x))
    index = S.GrayIndex(fps)
    list(S.near(index, index, 2, 1, itself=True))
    pairs = sum(seen[::2])  # the whole and its high half are counted for each pair of nodes
    assert pairs < len(fps) ** 2 / 20


def test_a_family_makes_no_more_edges_than_members(spark):
    from affinity.llm.store import Store

    fps = [0] + [1 << i for i in range(60)] + [1 << i | 1 << j for i in range(60) for j in range(i)]
    store = Store(spark, "t")
    groups = S.gray_groups(spark.createDataFrame([(f,) for f in fps], "fp bigint"), store, 7)
    edges = S.links(groups, store, 2)
    assert groups.select("grp").distinct().count() > 3 and edges.count() < 8 * len(fps)
    comp = S.connected_components(store.keep(edges), store)
    assert comp.count() == len(fps) and comp.select("label").distinct().count() == 1
