"""Bucketed stores: what joins on the key shuffle."""

import uuid

import pytest
from pyspark.sql import functions as F

from adlake.operators import embedding as em
from adlake.operators.optimizers import SGD
from adlake.sources.bucketed import BucketedTable


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def store(spark):
    made = BucketedTable(spark, f"store_{uuid.uuid4().hex[:8]}", ["token_id"], 8)
    made.save(em.new_table(spark.range(500).select(F.col("id").alias("token_id")), 4, init="uniform"))
    yield made
    made.drop()


def exchanges(df):
    """The inputs of the exchanges of the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Exchange " in line and "AQEShuffleRead" not in line]


def test_lookups_shuffle_the_requests_only(spark, store, no_broadcast):
    requests = spark.range(3000).select(F.col("id").alias("request"), (F.col("id") * 7 % 600).alias("token_id"))
    found = em.lookup(requests, store.load(), 4, init="uniform")
    plan = exchanges(found)
    assert len(plan) == 1 and "embedding" not in plan[0]
    plain = em.lookup(requests, spark.createDataFrame(store.load().collect(), store.load().schema), 4, init="uniform")
    assert len(exchanges(plain)) == 2
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_pushes_rewrite_the_store_from_itself(spark, store, no_broadcast):
    grads = spark.createDataFrame([(3, [1.0] * 4), (999, [1.0] * 4)], "token_id long, grad array<double>")
    before = {r.token_id: r.embedding for r in store.load().collect()}
    moved = em.apply_gradients(store.load(), grads, SGD(lr=0.5), 4, "uniform")
    assert len(exchanges(moved)) == 1
    after = {r.token_id: r.embedding for r in store.save(moved).collect()}
    assert len(after) == 501 and after[3] == pytest.approx([x - 0.5 for x in before[3]]) and after[4] == before[4]


def test_two_stores_join_without_a_shuffle(spark, store, no_broadcast):
    other = BucketedTable(spark, f"{store.name}_other", ["token_id"], 8)
    assert not other.exists()
    facts = other.save(spark.range(0, 800, 2).select(F.col("id").alias("token_id"), (F.col("id") * 2).alias("twice")))
    joined = store.load().join(facts, "token_id")
    assert exchanges(joined) == [] and joined.count() == 250
    other.drop()
