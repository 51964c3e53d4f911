import hashlib
import random

import pytest

import __spark_entry__ as E
from affinity.llm import suffix_dedup as S
from cases import docs, sentences, texts, words

SF = "/root/testdata/sf0.001"


def brute(rows):
    """rows: (id, bytes) in document order -> {id: (n, removed, spans, kept)}"""
    seen, out = set(), {}
    for key, raw in rows:
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s:s + 100]
            if w in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(w)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key] = len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone) if not g)
    return out


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "UNIT", 3000)
    rng = random.Random(12)
    passage = words(77, 60)
    some = texts() + [sentences(100 + i, 60) + passage[: rng.randrange(90, len(passage))] + sentences(200 + i, 30) for i in range(30)]
    base = sentences(300, 200)
    for i in range(25):
        at = rng.randrange(len(base))
        some.append(base[:at] + f"<{i}>" + base[at:])
    some += ["ab" * 400, "xyz" * 70, "é" * 90, "q" * 99, "q" * 100, "q" * 101]
    ids = list(range(len(some)))
    rng.shuffle(ids)
    want = brute(sorted((i, (t or "").encode()) for i, t in zip(ids, some)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(docs(spark, some, ids).repartition(4)).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 20_000


def test_query_on_the_small_table(spark):
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = brute(rows)
    for r in E.queries()["op9_suffix_dedup"](spark, SF).collect():
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("seed", range(5))
def test_merged_transforms_find_equal_windows(seed):
    rng = random.Random(seed)
    base = bytes(rng.choice(b"abc ") for _ in range(500))
    contexts = []
    for _ in range(rng.randint(1, 40)):
        a = rng.randint(0, 300)
        c = bytearray(base[a:a + rng.randint(100, 152)])
        if rng.random() < 0.5:
            c[rng.randrange(len(c))] = 66
        contexts.append(bytes(c))
    got, want = {}, {}
    for c, o, b in zip(*S.repeated_windows(contexts)):
        got.setdefault(int(b), []).append((int(c), int(o)))
    for i, c in enumerate(contexts):
        for o in range(len(c) - 99):
            want.setdefault(c[o:o + 100], []).append((i, o))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_nulls_repeated_rows_and_empty_table(spark):
    t = sentences(5, 60)
    rows = S.remove_repeats(docs(spark, [t, t, t, None, ""], [None, 3, 3, 4, 5])).collect()
    assert sorted((r.doc_id is not None, r.n_removed == r.n_bytes) for r in rows if r.n_bytes) == [(False, False), (True, True), (True, True)]
    assert S.remove_repeats(docs(spark, [t]).limit(0)).count() == 0


def test_equal_rows_without_another_copy_keep_their_text(spark):
    t, u = sentences(6, 60), sentences(7, 60)
    some = [t, t, u, t + u, u]
    ids = [1, 1, 2, 3, 2]
    want = brute(sorted({(i, x.encode()) for i, x in zip(ids, some)}))
    for parts in (1, 5):
        rows = S.remove_repeats(docs(spark, some, ids).repartition(parts)).collect()
        assert len(rows) == 5
        for r in rows:
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id]
    assert want[1][1] == want[2][1] == 0 and want[3][1] > 0


def test_a_key_with_many_contexts_is_not_merged_in_one_task(spark, monkeypatch):
    """A passage of fewer than 100 bytes, and one of more, with other bytes around them in every document."""
    short, long = words(8, 40)[:60], words(9, 60)[:130]
    some = [f"{words(400 + i // 2, 30)} {p} {words(500 + i % 7, 30)}" for i in range(60) for p in (short, long)]
    want = brute((i, t.encode()) for i, t in enumerate(some))
    monkeypatch.setattr(S, "UNIT", 1000)
    merged = docs(spark, some).sparkSession.sparkContext.accumulator(0)
    plain = S.repeated_windows

    def counted(contexts):
        if sum(map(len, contexts)) > 2 * 1000 + 200:
            merged.add(1)
        return plain(contexts)

    monkeypatch.setattr(S, "repeated_windows", counted)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(docs(spark, some).repartition(4)).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 1000
    assert not merged.value
