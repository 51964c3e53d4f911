import random

import numpy as np
import pytest

import __spark_entry__ as E
from affinity.llm import language as L
from cases import docs

SF = "/root/testdata/sf0.01"
WORDS = {"aa": "the of and to in is that it was for".split(), "bb": "der die und das ist nicht ein mit auf für".split(),
         "cc": "le la les des une est que pas dans sur".split(), "dd": "él los las una que con por para como más".split()}


def corpus(spark, n=30):
    rng = random.Random(1)
    rows = [(i * 4 + k, " ".join(rng.choice(w) for _ in range(40)), lang) for i in range(n) for k, (lang, w) in enumerate(WORDS.items())]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), rows


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12])
def test_codewords_differ_and_split(n):
    code = L.codewords(n)
    assert len({tuple(r) for r in code.tolist()}) == n
    assert all(-1 in c and 1 in c for c in code.T.tolist())
    if 2 < n <= 7:
        least = min(int((a != b).sum()) for i, a in enumerate(code) for b in code[:i])
        assert least == 2 ** (n - 2)


def test_counts_match_a_plain_version():
    def plain(text):
        c = [ord(x) if x.isalpha() else 32 for x in text.lower()]
        c = [32, *c, 32]
        c = [x for i, x in enumerate(c) if not i or x != 32 or c[i - 1] != 32]
        return sum(max(0, len(c) - k) for k in range(3))
    for t in ("Hello, World!", "é1é", "a", "日本 語"):
        assert L.ngram_counts(t).sum() == plain(t)
    assert L.ngram_counts("12 .,") is None and L.ngram_counts("") is None


def test_learns_and_flags(spark):
    d, rows = corpus(spark)
    model = L.train(d)
    other, test = corpus(spark, 5)
    got = {r.doc_id: r for r in L.identify(other, model).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 and not got[i].ambiguous for i, _, lang in test)
    odd = docs(spark, [None, "", "123 .,", "the der la él"])
    r = {r.doc_id: r for r in L.identify(odd, model).collect()}
    assert [r[i].lang_pred for i in range(3)] == ["und"] * 3 and r[0].score == 0
    assert r[3].score < min(x.score for x in got.values())


def test_one_language_none_and_empty(spark):
    d, _ = corpus(spark, 2)
    one = L.train(d.where("lang = 'aa'"))
    assert {(r.lang_pred, r.score) for r in L.identify(d, one).collect()} == {("aa", 1.0)}
    none = L.train(d.limit(0))
    assert {r.lang_pred for r in L.identify(d, none).collect()} == {"und"}
    assert L.identify(d.limit(0), one).count() == 0
    with pytest.raises(ValueError):
        L.train(d, max_languages=2)


def test_query_held_out_accuracy(spark):
    got = E.queries()["op1_language_id"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 150 < len(held) < 350
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
