"""Recordings of frames are made after their keys have met."""

from pyspark.sql import functions as F

from hushwire.plans import catalogue

DATA = "/root/testdata/sf0.001"


def test_no_frame_is_shuffled(spark):
    plan = catalogue.stereo(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Exchange" in plan and "transform" not in plan[plan.index("Exchange") :]


def test_frames_of_keys_that_come_twice(spark, tmp_path):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    orders.unionByName(orders.where("o_orderkey % 3 = 0")).write.parquet(f"{tmp_path}/orders.parquet")
    frames = spark.sql(catalogue._FRAMES.format(n=catalogue._STEPS).replace("FROM orders", "FROM {t}"), t=catalogue.table(spark, str(tmp_path), "orders"))
    want = frames.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", F.col("a").cast("float").alias("a"), F.col("b").cast("float").alias("b")))).alias("f"))
    want = {r["id"]: [[x["a"] for x in r["f"]], [x["b"] for x in r["f"]]] for r in want.collect()}
    got = {r["id"]: r["channels"] for r in catalogue.stereo(spark, str(tmp_path)).collect()}
    assert got == want and len(got) > 100


def test_tasks_grow_with_the_recordings(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "RECORDINGS", 100)
    assert catalogue.stereo(spark, DATA).rdd.getNumPartitions() == 15
