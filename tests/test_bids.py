from pyspark.sql import functions as F

from adlake.operators import bids


def test_empty_log_percentiles(spark):
    out = bids.price_percentiles(spark.createDataFrame([], "p double"), "p").first()
    assert set(out.asDict().values()) == {0.0}


def test_rounds_and_latency(spark):
    df = spark.createDataFrame([("l", 1, 5), ("l", 2, 9), ("l", 3, 9)], "lineage string, r int, score int")
    assert tuple(bids.best_round(df, "lineage", "r", "score").first()) == ("l", 2, 9)
    t = spark.createDataFrame([("a", 2, float(i)) for i in range(200)], "cfg string, b int, ms double")
    r = bids.latency_summary(t, ["cfg"], "ms", "b", F.lit(10.0)).first()
    assert (r["p99_latency"], r["throughput"], r["mean_latency"]) == (198.0, 40.0, 99.5)
