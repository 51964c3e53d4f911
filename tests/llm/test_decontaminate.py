import re

import pytest

from affinity.llm import decontaminate as D
from affinity.llm.decontaminate import decontaminate
from cases import docs, sentences, texts


def tokens(t):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items):
    w = tokens(text)
    hit, found = set(), set()
    for k, item in items:
        x = tokens(item)
        n = min(10, len(x))
        for i in range(len(x) - n + 1) if n else ():
            for j in range(len(w) - n + 1):
                if w[j:j + n] == x[i:i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(k))
    return len(w), len(hit), sorted(found)


ITEMS = [(7, sentences(20, 40)), (10, sentences(21, 10)), (2, "short item é"), (2, "short item é"), (3, None), (4, " .,!"), (5, sentences(20, 12))]


@pytest.mark.parametrize("block", [200_000, 7])
def test_matches_brute_force(spark, block):
    p = sentences(20, 40)
    some = texts()[:16] + [p, p.upper(), "x " + p[:150] + " y " + p, "a SHORT--item É! b", "a short, item é! b", sentences(21, 10) + " " + sentences(21, 10)]
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate(docs(spark, some), bench, block=block).collect()}
    for i, t in enumerate(some):
        assert (got[i].n_words, got[i].n_hit, list(got[i].items)) == brute(t, ITEMS), i
        if not got[i].n_hit:
            assert got[i].clean_text == (t or "")
        else:
            assert brute(got[i].clean_text, ITEMS)[1] == 0
    assert got[16].clean_text.strip(" .\n") == ""


def test_empty_tables(spark):
    d, bench = docs(spark, ["one two", None]), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert {r.n_hit for r in decontaminate(d, bench.limit(0)).collect()} == {0}
    assert decontaminate(d.limit(0), bench).count() == 0


def test_a_large_benchmark_is_joined_not_broadcast(spark):
    """50 blocks of windows: two Python steps over documents (list, cut), no windows on the driver."""
    items = [(i, sentences(300 + i, 60)) for i in range(40)] + ITEMS
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    some = [sentences(300 + i, 60)[:200] + " own words " + sentences(20, 40) for i in range(0, 40, 7)] + [sentences(20, 40)] * 30 + texts()[:12]
    d = docs(spark, some)
    windows = D.benchmark_windows(bench).count()
    far = decontaminate(d, bench, block=windows // 50)
    plan = far._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # the cut; the listing is a written table
    near = decontaminate(d, bench)
    rows = lambda x: sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.clean_text) for r in x.collect())
    assert rows(far) == rows(near) and sum(r[2] > 0 for r in rows(far)) >= 36


def test_clashing_names(spark):
    d = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id int, text string, items string, n_words int")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for block in (200_000, 7):
        r = decontaminate(d, bench, keep=("doc_id", "items"), block=block).first()
        assert tuple(r) == (1, "x", 2, 0, [], "a b")
