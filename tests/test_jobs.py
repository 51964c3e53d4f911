import random

from affinity import jobs
from affinity.config import Config


def test_jobs_end_to_end(spark, tmp_path):
    rnd = random.Random(4)
    lines = ["user_id,book_id,is_read,rating,is_reviewed"]
    for u in range(90):
        group = range(0, 60) if u % 2 else range(60, 120)
        for b in rnd.sample(list(group), 45):
            read = 1 if rnd.random() < 0.8 else 0
            lines.append(f"{u},{b},{read},{rnd.randint(1, 5) if read and rnd.random() < 0.7 else 0},{rnd.randint(0, 1)}")
    csv = tmp_path / "inter.csv"
    csv.write_text("\n".join([*lines, "1,2,3", "1,2,1,9,0"]))
    item_map = tmp_path / "map.csv"
    item_map.write_text("book_id_csv,book_id\n" + "\n".join(f"{i},{i + 5000}" for i in range(120)))
    base = str(tmp_path / "out")
    cfg = Config(min_interactions=40, sample_fraction=1.0, top_k=10, min_readers=5, jaccard_distance=0.8,
                 als_rank=4, als_iter=3, als_tune_iter=2, combined_grid={"rating_weight": [1.0, 5.0]})
    summary = {r.metric: r.value for r in jobs.preprocess(spark, str(csv), base, cfg).collect()}
    assert summary["total_users"] == 90 and summary["tuning_holdout_rows"] == 20 * summary["tuning_users"]
    report = {r.outcome: int(r.n_lines) for r in spark.read.option("header", True).csv(base + "/results/ingest_report").collect()}
    assert report == {"accepted": len(lines) - 1, "malformed": 1, "out_of_range": 1}
    assert spark.read.parquet(base + "/interactions_rejects.parquet").count() == 2
    jobs.main(["analyze", "--base", base])  # CLI path (published sizes; checks just run)
    out = jobs.analyze(spark, base, cfg)
    assert all(r.all_expected for r in out["holdout_size_check"].collect())
    assert {r.dataset: r.n_rows for r in out["signal_coverage"].collect()} == {"sampled": summary["total_rows"], "train": summary["train_rows"]}
    m = {r.metric: r.value for r in jobs.popularity(spark, base, cfg).collect()}
    assert 0 <= m["test_map"] <= m["test_ndcg"] <= 1
    top = jobs.segments(spark, base, str(item_map), cfg).collect()
    assert top and all(r.external_id_1 == r.book_id_1 + 5000 for r in top)
    reduction = spark.read.option("header", True).csv(base + "/results/segments_reduction").first()
    assert int(reduction.n_items) > 0 and reduction.recall is not None
    assert jobs.als_tune(spark, base, "combined", cfg).count() == 2
    fin = jobs.als_final(spark, base, "implicit", cfg).collect()
    assert {r.split for r in fin} == {"tuning", "test"}
    assert (tmp_path / "out" / "models" / "als_implicit_model_test").exists()
    assert spark.read.option("header", True).csv(base + "/results/popularity_baseline").count() == 14
