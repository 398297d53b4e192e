from pyspark.sql import functions as F

from pairlake.streaming import log

SCHEMA = "id long, k string, v double, ts timestamp"


def land(spark, path, rows):
    spark.createDataFrame(rows, "id long, k string, v double, ts string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(path)


def test_dedup_over_runs_is_first_wins(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    land(spark, src, [(1, "a", 1.0, "2024-01-01"), (2, "a", 2.0, "2024-01-01"), (3, "b", 1.0, "2024-01-02")])
    run = lambda: log.into_folder(log.deduplicated(log.landed(spark, src, SCHEMA), ["k"]), out, "t", mark).awaitTermination()
    run()
    land(spark, src, [(4, "b", 1.0, "2024-01-02"), (5, "c", 1.0, "2024-01-03")])
    run()
    assert sorted(x.k for x in spark.read.parquet(f"{out}/t").collect()) == ["a", "b", "c"]


def test_late_rows_and_windows(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    run = lambda: log.into_folder(log.windowed_counts(log.landed(spark, src, SCHEMA), "ts", ["k"]), out, "t", mark).awaitTermination()
    land(spark, src, [(1, "a", 1.0, "2024-01-01 00:10:00"), (2, "a", 1.0, "2024-01-01 00:50:00")])
    run()
    land(spark, src, [(3, "a", 1.0, "2024-01-01 06:00:00")])
    run()
    land(spark, src, [(4, "a", 1.0, "2024-01-01 00:20:00"), (5, "a", 1.0, "2024-01-01 09:00:00")])
    run()
    got = {str(x.start)[11:13]: x.n for x in spark.read.parquet(f"{out}/t").collect()}
    assert got["00"] == 2


def test_running_means(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    run = lambda: log.into_folder(log.running_means(log.landed(spark, src, SCHEMA), "k", "v"), out, "t", mark, mode="update").awaitTermination()
    latest = lambda: {x.k: (x.n, x["mean"]) for x in spark.read.parquet(f"{out}/t").orderBy("batch").collect()}
    land(spark, src, [(1, "a", 1.0, "2024-01-01"), (2, "a", None, "2024-01-01"), (3, "b", 5.0, "2024-01-01")])
    run()
    assert latest() == {"a": (1, 1.0), "b": (1, 5.0)}
    land(spark, src, [(4, "a", 3.0, "2024-01-01")])
    run()
    assert latest() == {"a": (2, 2.0), "b": (1, 5.0)}
