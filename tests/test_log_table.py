"""Versions of changed rows against a dictionary."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from adlake.session import shared_folder
from adlake.sources.versions import LogTable

SCHEMA = "token_id long, embedding array<float>, update_count double, steps int"


@pytest.fixture
def store(spark):
    return LogTable(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}", shards=3)


def frame(spark, rows):
    return spark.createDataFrame([(k, [float(x) for x in v], float(c), 1) for k, (v, c) in rows.items()], SCHEMA)


def content(df):
    return {r.token_id: (list(r.embedding), r.update_count) for r in df.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], rel=1e-5) and got[k][1] == pytest.approx(want[k][1], rel=1e-9)


def size(store, version):
    fs, where = store._fs(store.path(version))
    return fs.getContentSummary(where).getLength()


def test_any_version_reads_as_it_was(spark, store):
    """Random changes, removals, returns of removed keys, decay and a compaction on the way."""
    draw, state, history = random.Random(2), {}, {}
    version = 0
    for step in range(9):
        version += 1
        changed = {draw.randrange(40): ([draw.random(), draw.random()], draw.randint(1, 9)) for _ in range(12)}
        removed = set() if step == 0 else set(draw.sample(range(45), 4))
        factor = draw.choice([1.0, 0.5])
        store.append(frame(spark, changed), version, {"step": step}, factor, spark.createDataFrame([(k,) for k in removed], "token_id long") if removed else None)
        state = {k: v for k, v in (state | changed).items() if k not in removed}
        state = {k: ([x * factor for x in v], c * factor) for k, (v, c) in state.items()}
        history[version] = dict(state)
        if step == 5:
            assert store.compact() == version + 1
            version += 1
            history[version] = dict(state)
            assert store.info(version) == {"step": 5}
    for v, want in history.items():
        close(content(store.load(v)), want)
    close(content(store.load()), state)
    keys = spark.createDataFrame([(k,) for k in (0, 1, 2, 999)], "token_id long")
    close(content(store.load(keys=keys)), {k: v for k, v in state.items() if k in (0, 1, 2)})
    assert [v for v, _ in store.chain()] == [7, 8, 9, 10]
    assert store.vacuum() == [1, 2, 3, 4, 5, 6] and store.versions() == [7, 8, 9, 10]
    close(content(store.load(8)), history[8])
    with pytest.raises(FileNotFoundError):
        store.load(3)
    assert store.delete(9) and store.versions() == [7, 8]
    close(content(store.load()), history[8])


def test_bytes_of_a_step_follow_from_its_keys(spark, store):
    base = spark.range(20000).select(
        F.col("id").alias("token_id"), F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: F.rand(1).cast("float") + i).alias("embedding"), F.lit(1.0).alias("update_count"), F.lit(0).alias("steps")
    )
    store.append(base, 1)
    few = base.where("token_id < 20").withColumn("update_count", F.lit(2.0))
    store.append(few, 2, factor=0.9)
    assert size(store, 2) < size(store, 1) / 50
    got = store.load().agg(F.count("*"), F.sum("update_count")).first()
    assert got[0] == 20000 and got[1] == pytest.approx(0.9 * (19980 + 40))


def test_keys_are_read_without_a_shuffle_of_the_base(spark, store):
    store.append(frame(spark, {k: ([k], 1) for k in range(100)}), 1)
    store.append(frame(spark, {k: ([-k], 2) for k in range(5)}), 2)
    keys = spark.range(3).select(F.col("id").alias("token_id"))
    plan = store.load(keys=keys)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.rindex("LeftAnti") :] if "LeftAnti" in plan else plan
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in scan
    close(content(store.load(keys=keys)), {k: ([-k], 2.0) for k in range(3)})


def test_torn_and_empty_versions(spark, store):
    with pytest.raises(FileNotFoundError):
        store.load()
    store.append(frame(spark, {1: ([1.0], 1)}), 1)
    store.append(frame(spark, {}), 2, factor=0.5)
    close(content(store.load()), {1: ([0.5], 0.5)})
    frame(spark, {1: ([9.0], 9)}).write.parquet(store.path(3))  # data without the mark of a saved version
    assert store.versions() == [1, 2] and content(store.load())[1][0] == [0.5]
    store.append(frame(spark, {2: ([2.0], 1)}), 3)
    close(content(store.load()), {1: ([0.5], 0.5), 2: ([2.0], 1.0)})
