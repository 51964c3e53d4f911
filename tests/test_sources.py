
from affinity.sources import (materialize, read_interactions_csv, read_item_map_csv, write_parquet,
                              write_small_csv, write_splits)
from conftest import interactions_df


def test_csv_to_parquet_roundtrip(spark, tmp_path):
    rows = [(1, 10, 1, 5, 0), (2, 11, 0, 0, 1)]
    csv = tmp_path / "inter.csv"
    csv.write_text("user_id,book_id,is_read,rating,is_reviewed\n" + "\n".join(",".join(map(str, r)) for r in rows))
    df = read_interactions_csv(spark, str(csv))
    assert [tuple(r) for r in df.orderBy("user_id").collect()] == rows
    assert dict(df.dtypes)["rating"] == "int"
    write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_item_map_csv(spark, tmp_path):
    p = tmp_path / "map.csv"
    p.write_text("book_id_csv,book_id\n0,1000000\n1,1000001\n")
    assert [tuple(r) for r in read_item_map_csv(spark, str(p)).orderBy("book_id_csv").collect()] == [(0, 1000000), (1, 1000001)]


def test_small_csv_is_one_file(spark, tmp_path):
    write_small_csv(spark.range(20), str(tmp_path / "ok"))
    assert spark.read.option("header", True).csv(str(tmp_path / "ok")).count() == 20
    assert len(list((tmp_path / "ok").glob("part-*.csv"))) == 1


def test_write_splits_partitioned(spark, tmp_path):
    df = interactions_df(spark, [(1, 1, 1, 0, 0), (2, 2, 1, 3, 1)])
    from pyspark.sql import functions as F
    p = df.withColumn("split", F.lit("tuning")).withColumn("role", F.when(F.col("user_id") == 1, "history").otherwise("holdout"))
    write_splits(p, str(tmp_path / "s"))
    assert (tmp_path / "s" / "split=tuning" / "role=history").exists()
    back = spark.read.parquet(str(tmp_path / "s")).where("role = 'holdout'")
    assert back.count() == 1


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS x")
    m = materialize(spark, df)
    assert m.count() == 100
    n = materialize(spark, df, "mat-test")
    assert sorted(r.x for r in n.collect())[:3] == [0, 2, 4]


def test_scale_conf():
    from affinity.session import scale_conf
    c = scale_conf(100 * (1 << 40), 8000)  # 100 TB on 8,000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409600  # 256 MB per partition before coalescing
    small = scale_conf(1 << 30, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # at least 3 waves
