import random
import re

import numpy as np
import pytest

from affinity.llm import jaccard_join as J
from cases import docs, texts, words


def brute(some):
    sets = []
    for t in some:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(some)))
    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                label[y] = x
    return [len(s) for s in sets], [find(i) for i in range(len(some))]


def corpus():
    """Random texts of many sizes with chains of edits around the threshold, and a passage in many texts."""
    rng = random.Random(11)
    passage = words(99, 60)
    some = texts()
    for k in range(60):
        n = rng.choice([3, 5, 6, 8, 12, 20, 33, 64, 90, 150, 300])
        base = words(1000 + k, n).split()
        some.append(" ".join(base))
        for _ in range(rng.randrange(5)):
            w = list(base)
            for _ in range(rng.randrange(1 + max(1, n // 25))):
                at = rng.randrange(len(w))
                w[at:at + rng.randrange(2)] = [f"e{rng.randrange(50)}"]
            some.append(" ".join(w))
            if rng.random() < 0.5:
                base = w
        some.append(" ".join(words(5000 + k, 90).split() + passage.split()))
    return some


def test_components_match_brute_force(spark):
    some = corpus()
    sizes, labels = brute(some)
    got = {r.doc_id: r for r in J.jaccard_components(docs(spark, some).repartition(5)).collect()}
    assert [got[i].n_shingles for i in range(len(some))] == sizes
    assert [got[i].component_id for i in range(len(some))] == labels
    assert len(set(labels)) < len(some) - 50


def test_blocks_give_the_same(spark, monkeypatch):
    some = corpus()[:120] + [words(7, 80) + f" tail{i} tail{i + 1}" for i in range(40)]
    monkeypatch.setattr(J, "BLOCK", 4)
    monkeypatch.setattr(J, "YIELD", 0)
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs(spark, some)).collect()}
    assert [got[i] for i in range(len(some))] == brute(some)[1]


def test_prefixes_share_a_part_value():
    """The pigeonhole itself: sets at the threshold always share one of their first part values in a common band."""
    rng, scheme = np.random.default_rng(3), J.Scheme()
    for _ in range(1500):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, n // 5 + 1)))
        add = int(rng.integers(0, n // 4 + 1))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 80 * (len(a) + len(b) - both):
            continue
        values = [{int(v) for band, p in scheme.entries(len(s)) for v in J.part_values(s, band, scheme.parts(band), p)} for s in (a, b)]
        assert values[0] & values[1], (len(a), len(b), both)
        band = min(len(a), len(b)).bit_length() - 1
        far = sum(bin(int(x) ^ int(y) & (2**64 - 1)).count("1") if False else bin((int(x) ^ int(y)) & (2**64 - 1)).count("1")
                  for x, y in zip(J.bit_sketch(a, band), J.bit_sketch(b, band)))
        assert far <= len(a) + len(b) - 2 * both <= scheme.differ(len(a) + len(b))


@pytest.mark.parametrize("ids", [[None, 4, 4, 9], [3, 2, 1, None]])
def test_null_and_repeated_keys(spark, ids):
    t = words(3, 50)
    rows = J.jaccard_components(docs(spark, [t, t, t + " end", None], ids)).collect()
    least = min(i for i in ids[:3] if i is not None)
    assert len(rows) == 4
    assert sorted(r.component_id for r in rows if r.n_shingles) == [least] * 3
    assert [r.component_id for r in rows if not r.n_shingles] == [ids[3]]


def test_empty_table(spark):
    assert J.jaccard_components(docs(spark, [None]).limit(0)).count() == 0
    assert J.jaccard_components(docs(spark, ["", None])).count() == 2
