import hashlib

import numpy as np

import __spark_entry__ as E
import corpus_pipeline as C
from affinity.llm.sentencepiece_bpe import model_path, vocabulary
from cases import edited, sentences

SF = "/root/testdata/sf0.001"


def test_stages_on_planted_cases(spark, tmp_path):
    a, b = sentences(1, 300), sentences(2, 300)
    item = sentences(3, 30)
    rows = [(1, a, "en", "s", len(a), True), (2, a, "en", "s", len(a), True), (3, edited(a, 113), "en", "s", 0, None),
            (4, b + "\n" + item, "en", "s", 0, None), (5, sentences(4, 200) + "\ntoken = abcdef0123456789.", "en", "s", 0, None),
            (6, "too short", "en", "s", 9, None), (7, None, None, None, None, None), (None, sentences(5, 100), "en", "s", 0, None),
            (8, sentences(6, 200), "en", "s", 7, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean"
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, schema)
    seen = {}
    for name, f in C.STAGES[:-1]:
        docs = f(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
        out = str(tmp_path / f.__name__)
        docs.write.parquet(out)
        docs = spark.read.parquet(out)
        seen[f.__name__] = {r.doc_id: r for r in docs.collect()}
    key = lambda d: sorted(d, key=lambda i: (i is None, i))
    assert key(seen["quality"]) == [1, 2, 3, 4, 5, 8, None]
    assert key(seen["near_copies"]) == [1, 4, 5, 8, None]
    assert item[:60] not in seen["benchmark"][4].text and seen["benchmark"][4].text.startswith(b)
    assert "abcdef0123456789" not in seen["secrets"][5].text
    for stage in seen.values():
        assert stage[8].text == rows[-1][1] and all(r.n_chars == len(r.text) for r in stage.values())
    lib = vocabulary(model_path()).library
    for r in C.pieces(spark, docs, str(tmp_path)).collect():
        ids = [lib.bos_id(), *lib.encode(seen["secrets"][r.doc_id].text), lib.eos_id()]
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in C.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in C.STAGES:
        docs = f(spark, docs, SF)
    assert sorted(docs.collect()) == sorted(E.queries()["pipeline"](spark, SF).collect())


def test_every_query_is_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert {x for x in E.oracle_sql() if x.startswith("op")} == {
        "op2_jaccard_join", "op5_benchmark_decontamination", "op10_quality_rules", "op12_hard_negatives", "op13_vector_codes"}


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    a, b, c, d = (sentences(20 + i, 200) for i in range(4))
    rows = [(1, a), (1, a), (2, edited(a, 113)), (2, c), (None, b), (None, b), (None, edited(b, 113)), (None, d), (3, d), (4, "x"), (4, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id bigint, text string, lang string").repartition(3)
    got = C.near_copies(spark, docs, SF)
    assert got.columns == docs.columns
    got = [(r.doc_id, r.text) for r in got.collect()]
    (of_b,) = [x for x in got if x[0] is None]
    assert of_b[1] in (b, edited(b, 113))
    assert sorted(map(str, got)) == sorted(map(str, [(1, a), (2, c), of_b, (3, d), (4, "x"), (4, None), (4, "")]))
