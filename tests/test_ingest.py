import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from affinity.operators import profile as PR
from affinity.session import checkpoint_dir
from affinity.sources import scratch
from affinity.sources.tables import ingest_interactions_csv, ingest_report

HEADER = "user_id,book_id,is_read,rating,is_reviewed"


def csv(tmp_path, *lines, header=HEADER):
    path = tmp_path / "in.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_bad_lines_are_told_apart(spark, tmp_path):
    path = csv(tmp_path, "1,2,1,5,0", "1,3,0,0,0", "x,3,0,0,0", "4,5,1,3", "4,5,1,3,0,9", "6,7,,1,0", ",8,1,1,1", "9,9,2,1,0",
               "9,8,1,6,0", "9,7,1,-1,0", "9,6,1,1.5,0", "2147483648,1,1,1,1")
    rows, rejects = ingest_interactions_csv(spark, path)
    assert sorted(map(tuple, rows.collect())) == [(1, 2, 1, 5, 0), (1, 3, 0, 0, 0)]
    got = {r.line: r.reason for r in rejects.collect()}
    assert got == {"x,3,0,0,0": "malformed", "4,5,1,3": "malformed", "4,5,1,3,0,9": "malformed", "6,7,,1,0": "missing",
                   ",8,1,1,1": "malformed", "9,9,2,1,0": "out_of_range", "9,8,1,6,0": "out_of_range", "9,7,1,-1,0": "out_of_range",
                   "9,6,1,1.5,0": "malformed", "2147483648,1,1,1,1": "malformed"}
    report = {r.outcome: r.n_lines for r in ingest_report(rows, rejects).collect()}
    assert report == {"accepted": 2, "malformed": 6, "missing": 1, "out_of_range": 3}


def test_header_is_checked_and_an_empty_file_is_no_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        ingest_interactions_csv(spark, csv(tmp_path, "1,2,1,5,0", header="user_id,item,is_read,rating,is_reviewed"))[0].collect()
    rows, rejects = ingest_interactions_csv(spark, csv(tmp_path))
    assert rows.isEmpty() and rejects.isEmpty()


@pytest.mark.parametrize("sql", ["id", "id * id", "cast(1000000 * log(1 + id) AS bigint)", "id % 7", "(id % 3) * 70000", "cast(sqrt(id) AS bigint) - 500"])
def test_quantiles_are_exact_on_a_million_values(spark, sql):
    df = spark.range(1_000_000).selectExpr(f"{sql} AS n")
    qs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    r = PR.exact_quantiles(df, "n", qs).first()
    v = df.toPandas()
    want = duckdb.sql("SELECT " + ", ".join(f"quantile_disc(n, {q})" for q in qs) + " FROM v").fetchall()[0]
    assert tuple(r)[4:] == want and (r.n, r.min, r.max) == (len(v), v.n.min(), v.n.max()) and r["mean"] == pytest.approx(v.n.mean())


def test_quantiles_of_few_rows(spark):
    one = PR.exact_quantiles(spark.createDataFrame([(5,), (None,)], "n bigint"), "n", [0.25, 0.5]).first()
    assert tuple(one) == (1, 5, 5, 5.0, 5, 5)
    none = PR.distribution_stats(spark.createDataFrame([], "n bigint"), "n").first()
    assert tuple(none) == (None,) * 6


def test_quantile_plan_has_no_global_sort_of_values(spark):
    df = PR.exact_quantiles(spark.range(1000).withColumnRenamed("id", "n"), "n", [0.5])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "windowspecdefinition(b#" in plan and "windowspecdefinition(i#" in plan


def folders(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    return {d for d in os.listdir(base) if d.startswith(scratch.PREFIX)}, base


def test_a_run_leaves_no_files(spark):
    before, _ = folders(spark)
    with scratch.Run(spark) as run:
        t = run.keep(spark.range(10), "t")
        assert t.agg(F.sum("id")).first()[0] == 45 and len(folders(spark)[0] - before) == 1
    assert folders(spark)[0] == before
    with pytest.raises(ZeroDivisionError), scratch.Run(spark) as run:
        run.keep(spark.range(1), "t")
        1 / 0
    assert folders(spark)[0] == before


def test_a_killed_runs_folder_goes_with_the_next_run_and_a_live_one_stays(spark):
    _, base = folders(spark)
    live = scratch.Run(spark)
    live.keep(spark.range(3), "t")
    killed = scratch.PREFIX + "killed"
    for name, record in ((killed, {"app": "x", "expires": 1.0}), (scratch.PREFIX + "begun", None)):
        os.makedirs(f"{base}/{name}/001-t", exist_ok=True)
        if record:
            with open(f"{base}/{name}/{scratch.OWNER}", "w") as f:
                json.dump(record, f)
    later = scratch.Run(spark)
    names, _ = folders(spark)
    assert killed not in names and scratch.PREFIX + "begun" in names
    assert live.path.rsplit("/", 1)[1] in names
    live.close()
    later.close()
    later.close()  # closing twice is no error


def test_registered_small_results_leave_no_files(spark):
    from affinity.plans import catalog

    before, _ = folders(spark)
    sf = "/root/testdata/sf0.001"
    assert sum(r.n_lines for r in catalog.q_ingest_report(spark, sf).collect()) == catalog.q_interactions(spark, sf).count()
    catalog.q_segment_topk(spark, sf).collect()
    catalog.q_lsh_reduction(spark, sf).collect()
    assert folders(spark)[0] == before
