import math
import uuid

import pytest
from pyspark.sql import functions as F

from adlake.operators import embedding as em
from adlake.operators import optimizers as opt
from adlake.operators import training as tr
from adlake.session import shared_folder
from adlake.sources.versions import VersionedTable


def arrays(spark, w, g, optimizer, steps=1, grads=None):
    """Several steps on one row; returns the weights after each."""
    df = spark.createDataFrame([(w,)], "embedding array<double>")
    for s, first in optimizer.states.items():
        df = df.withColumn(s, F.array_repeat(F.lit(float(first)), len(w)))
    out = []
    for t in range(1, steps + 1):
        df = opt.step_arrays(df.withColumn("steps", F.lit(t)).withColumn("grad", F.array(*[F.lit(float(x)) for x in g])), optimizer)
        out.append(df.first()["embedding"])
    return out


def test_sgd_plain_and_momentum(spark):
    w, g = [1.0, 2.0, 3.0], [0.1, 0.2, 0.3]
    assert arrays(spark, w, g, opt.SGD(lr=0.1))[0] == pytest.approx([0.99, 1.98, 2.97])
    one, two = arrays(spark, w, g, opt.SGD(lr=0.1, momentum=0.9), steps=2)
    assert two == pytest.approx([a - 0.1 * 1.9 * b for a, b in zip(one, g)])
    nesterov = arrays(spark, w, g, opt.SGD(lr=0.1, momentum=0.9, nesterov=True, dampening=0.5, weight_decay=0.1))[0]
    want = []
    for a, b in zip(w, g):
        d = b + 0.1 * a
        want.append(a - 0.1 * (d + 0.9 * 0.5 * d))
    assert nesterov == pytest.approx(want)


@pytest.mark.parametrize("amsgrad", [False, True])
def test_adam_three_steps(spark, amsgrad):
    got = arrays(spark, [0.5], [0.2], opt.Adam(lr=0.1, weight_decay=0.01, amsgrad=amsgrad), steps=3)
    w, m, v, top = 0.5, 0.0, 0.0, 0.0
    for t in range(1, 4):
        m, v = 0.9 * m + 0.1 * 0.2, 0.999 * v + 0.001 * 0.04
        vh = v / (1 - 0.999**t)
        top = max(top, vh)
        w -= 0.1 * (m / (1 - 0.9**t)) / (math.sqrt(top if amsgrad else vh) + 1e-8) + 0.1 * 0.01 * w
        assert got[t - 1] == pytest.approx([w])


def test_ftrl_gives_exact_zeros(spark):
    got = arrays(spark, [0.01] * 4, [0.001] * 4, opt.FTRL(l1=1.0), steps=10)
    assert got[-1] == [0.0] * 4
    scalar = spark.createDataFrame([(0.0, 0.5, 0.0, 0.0)], "w double, g double, z double, n double")
    r = opt.step_scalars(scalar, opt.FTRL(alpha=0.1, beta=1.0, l1=0.1, l2=0.2)).first()
    assert r["w"] == pytest.approx(-(0.5 - 0.1) / (0.2 + (1 + 0.5) / 0.1))


def test_apply_touches_only_pushed_tokens(spark):
    optimizer = opt.Adagrad(lr=0.1)
    table = em.new_table(spark.range(1000).select(F.col("id").alias("token_id")), 2, optimizer, "uniform")
    before = {r["token_id"]: r for r in table.collect()}
    pushed = spark.createDataFrame([(10, [1.0, 1.0]), (50, [1.0, -1.0]), (5000, [2.0, 2.0])], "token_id long, grad array<double>")
    after = {r["token_id"]: r for r in em.apply_gradients(table, pushed, optimizer, 2, "uniform").collect()}
    assert len(after) == 1001 and after[5000]["update_count"] == 2.0
    for t, r in before.items():
        same = after[t]["embedding"] == r["embedding"] and after[t]["acc"] == r["acc"]
        assert same == (t not in (10, 50)) and after[t]["update_count"] == (2.0 if t in (10, 50) else 1.0)
    step = 0.1 / (math.sqrt(1.1) + 1e-10)
    assert after[10]["embedding"] == pytest.approx([x - step for x in before[10]["embedding"]], rel=1e-5)


def test_random_start_is_fixed_and_centred(spark):
    df = spark.range(300).select(F.col("id").alias("token_id"))
    for init, spread in (("uniform", 0.1 / math.sqrt(3)), ("normal", 0.1)):
        a = df.select(em.initial_embedding(F.col("token_id"), 16, init, 0.1, 4).alias("e"))
        assert a.collect() == a.repartition(3).collect() or sorted(map(str, a.collect())) == sorted(map(str, a.repartition(3).collect()))
        values = [x for r in a.collect() for x in r["e"]]
        mean = sum(values) / len(values)
        std = math.sqrt(sum((x - mean) ** 2 for x in values) / len(values))
        assert abs(mean) < 0.01 and std == pytest.approx(spread, rel=0.1)
    with pytest.raises(ValueError):
        em.initial_embedding(F.lit(1), 2, "ones")


def test_counts_prune_decay(spark):
    table = spark.range(1, 11).select(F.col("id").alias("token_id"), F.array(F.lit(2.0).cast("float")).alias("embedding"), F.col("id").cast("double").alias("update_count"))
    assert tuple(em.prune_report(table, 5).first()) == (4, 6)
    assert em.prune(table, 5).count() == 6
    half = em.decay_table(table, 0.5)
    assert half.where("embedding[0] = 1.0 and update_count = token_id / 2").count() == 10
    assert half.schema["embedding"].dataType == table.schema["embedding"].dataType
    with pytest.raises(ValueError):
        em.decay_table(table, 0.0)
    stats = em.count_stats(table, 1).first()
    assert (stats["tokens"], stats["median_count"], stats["bytes"]) == (10, 5.5, 40)
    assert [r["token_id"] for r in em.most_updated(table, 3).collect()] == [10, 9, 8]


def test_weights_sum_to_batch_size(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 2.0), (1, None), (1, float("nan")), (1, 1.0), (2, 0.0)], "b int, w double")
    out = em.normalised_weights(df, ["b"], "w")
    sums = {r["b"]: r["s"] for r in out.groupBy("b").agg(F.sum("weight_norm").alias("s")).collect()}
    assert sums == {1: pytest.approx(5.0), 2: 0.0}


def test_batches_are_repeatable(spark, rows):
    df = spark.range(1000)
    a = em.shuffled_batches(df, "id", 32, 250, seed=1)
    assert rows(a) == rows(em.shuffled_batches(df.repartition(5), "id", 32, 250, seed=1))
    assert rows(a) != rows(em.shuffled_batches(df, "id", 32, 250, seed=2))
    sizes = a.groupBy("bucket", "batch").count()
    assert sizes.agg(F.max("count")).first()[0] == 32 and sizes.agg(F.sum("count")).first()[0] == 1000


def test_task_shapes_and_losses(spark):
    assert tr.task_shape("binary_classification").activation == "sigmoid"
    assert tr.task_shape("multiclass", num_classes=4).output_dim == 4
    assert tr.task_shape("multi_label", ["a", "b"]).output_dim == 2
    assert tr.task_shape("regression", ["a"]).loss == "mse"
    df = spark.createDataFrame([([0.2, 0.7, 0.1], 1, [1, 0, 0])], "p array<double>, y int, m array<int>")
    r = df.select(tr.loss_column("multiclass", F.col("p"), F.col("y")), tr.loss_column("multi_label", F.col("p"), F.col("m"))).first()
    assert r[0] == pytest.approx(-math.log(0.7))
    assert r[1] == pytest.approx(-(math.log(0.2) + math.log(0.3) + math.log(0.9)) / 3)
    with pytest.raises(ValueError):
        tr.task_shape("ranking")


@pytest.fixture
def samples(spark):
    """Two tokens decide the label; one feature is multi-valued."""
    data = [(i, [i % 2, 7], 100 + i % 3, float(i % 5), i % 2) for i in range(120)]
    return spark.createDataFrame(data, "sid long, tags array<long>, site long, x double, label int")


def model(**kw):
    return tr.EmbeddingModel("sid", {"tags": F.col("tags"), "site": F.col("site")}, ["x"], "label", dim=3, learning_rate=0.2, **kw)


def test_gradient_matches_finite_difference(spark, samples):
    m = model()
    table = em.new_table(samples.select(F.explode(F.flatten(F.array("tags", F.array("site")))).alias("token_id")), 3, m.optimizer, "uniform", 0.1)
    weights = m.first_weights()
    table = spark.createDataFrame(table.collect(), table.schema)

    def loss(t):
        s = tr.score(samples, t, m, weights)
        return s.agg(F.avg(tr.loss_column(m.task, F.col("prediction"), F.col("label")))).first()[0]

    scored = tr.score(samples, table, m, weights)
    needed = scored.select("sid", F.col("tags").alias("_s_tags"), F.col("site").alias("_s_site"), (F.col("prediction") - F.col("label")).alias("_error"))
    grads = {r["token_id"]: r["grad"] for r in tr.token_gradients(needed, m, weights, 120).collect()}
    eps = 1e-2
    for token in (1, 7, 101):
        moved = [
            table.withColumn("embedding", F.when(F.col("token_id") == token, F.transform("embedding", lambda x, i: F.when(i == 0, x + s * eps).otherwise(x)).cast("array<float>")).otherwise(F.col("embedding")))
            for s in (1, -1)
        ]
        assert grads[token][0] == pytest.approx((loss(moved[0]) - loss(moved[1])) / (2 * eps), rel=2e-2, abs=1e-5)


def test_days_learn_resume_and_skip_empty(spark, samples):
    store = VersionedTable(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}", shards=2)
    days = [("d1", samples), ("d2", samples), ("d3", samples.where("false")), ("d4", samples)]
    first = tr.train_days(days[:2], model(), store, steps_per_day=2, decay=0.999)
    assert [r["batches"] for r in first] == [2, 2] and store.versions() == [1, 2, 3, 4]
    # a step of an unfinished day is not resumed from
    store.save(store.load(4), 5, {"day": "d3", "complete": False, "weights": [0.0]})
    rest = tr.train_days(days, model(), store, steps_per_day=2)
    assert [r["day"] for r in rest] == ["d3", "d4"] and rest[0]["samples"] == 0
    assert first[0]["loss"] > first[1]["loss"] > rest[1]["loss"]
    totals = tr.training_totals(first + rest)
    assert totals["samples"] == 720 and totals["days"] == 4
    assert store.info(store.latest())["day"] == "d4"
    counts = {r["token_id"]: r["update_count"] for r in store.load().select("token_id", "update_count").collect()}
    assert counts[7] > 4


def test_mllib_task(spark, samples):
    task = tr.TrainingTask("logistic_regression", "label", ["x"], ["site"], {"maxIter": 5}, 0.25, 3)
    fitted, scored = tr.fit_task(samples, task, "sid")
    assert 10 < scored.count() < 60 and "prediction" in scored.columns and fitted.stages[-1].getLabelCol() == "label"
    with pytest.raises(ValueError):
        tr.fit_task(samples, tr.TrainingTask("tarot", "label", ["x"]), "sid")


def test_stored_task_scores_like_the_fitted_one(spark, samples):
    task = tr.TrainingTask("logistic_regression", "label", ["x"], ["site"], {"maxIter": 5}, 0.25, 3)
    fitted, _ = tr.fit_task(samples, task, "sid")
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    tr.store_model(fitted, path)
    got = tr.stored_scores(samples.drop("label"), path)
    assert got.columns == ["sid", "tags", "site", "x", "prediction", "probability"]
    want = {r.sid: r.probability for r in fitted.transform(samples).collect()}
    assert {r.sid: r.probability for r in got.collect()} == want


def test_null_lists_and_tokens_lose_nothing(spark):
    from adlake.operators import embedding

    df = spark.createDataFrame([(1, [3, None], 5), (2, None, 6), (3, [4], None)], "id long, a array<long>, b long")
    got = embedding.sample_tokens(df, "id", {"a": F.col("a"), "b": F.col("b")})
    assert sorted(map(tuple, got.collect())) == [(1, "a", 0), (1, "a", 3), (1, "b", 5), (2, "b", 6), (3, "a", 4), (3, "b", 0)]


def test_missing_numbers_lose_no_rows(spark):
    from adlake.operators import training

    df = spark.range(200).select("id", F.when(F.col("id") % 5 != 0, F.col("id") * 1.0).alias("x"), (F.col("id") % 2).alias("y"))
    task = training.TrainingTask("logistic_regression", "y", ["x"])
    _, held_out = training.split_by_hash(df, "id", task.validation_split, task.seed)
    _, scored = training.fit_task(df, task, "id")
    assert scored.count() == held_out.count() and scored.where("prediction IS NULL").count() == 0


def test_models_that_cannot_be_are_refused(spark):
    for wrong in ({"task": "ranking", "target": "y"}, {"task": "multiclass", "targets": ["y", "z"]}, {"task": "regression"}):
        with pytest.raises(ValueError):
            tr.EmbeddingModel("id", {}, [], **wrong)
    assert tr.EmbeddingModel("id", {}, [], "y", task="multiclass", num_classes=4).outputs == 4
    assert tr.EmbeddingModel("id", {}, [], task="multi_label", targets=["a", "b"]).first_weights() == [[0.0], [0.0]]


def test_pooling_shuffles_tokens_not_vectors(spark, monkeypatch):
    """With a table that is broadcast, the only exchange is that of the tokens."""
    monkeypatch.setattr(em, "POOL_ROWS", 30)
    tokens = spark.createDataFrame([(s, f, t) for s in range(20) for f in ("x", "y") for t in range(s % 4 + 1)], "sample long, feature string, token_id long")
    table = spark.createDataFrame([(t, [float(t), 1.0]) for t in range(3)], "token_id long, embedding array<double>")
    pooled = em.mean_pool(tokens, F.broadcast(table), "sample", 2)
    plan = pooled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION" in plan
    means = {(r.sample, r.feature): (r.embedding, r.tokens) for r in pooled.collect()}
    assert means[3, "x"] == ([0.75, 0.75], 4) and len(means) == 40


@pytest.mark.parametrize("sent", [64 << 20, 0])
def test_pooling_never_shuffles_sums(spark, monkeypatch, sent):
    """Also where Spark would not broadcast the table: the last exchange deals tokens by sample, and the sums stay where they are formed."""
    monkeypatch.setattr(em, "SENT_BYTES", sent)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tokens = spark.createDataFrame([(s, f, t) for s in range(20) for f in ("x", "y") for t in range(s % 4 + 1)], "sample long, feature string, token_id long")
        table = spark.createDataFrame([(t, [float(t), 1.0]) for t in range(3)], "token_id long, embedding array<double>")
        pooled = em.mean_pool(tokens, table, "sample", 2)
        plan = pooled._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Exchange" in line and "feature#" in line] and "REPARTITION_BY_NUM" in plan
        assert ("BroadcastHashJoin" in plan) == (sent > 0)
        means = {(r.sample, r.feature): (r.embedding, r.tokens) for r in pooled.collect()}
        assert means[3, "x"] == ([0.75, 0.75], 4) and means[2, "y"] == ([1.0, 1.0], 3) and len(means) == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_assembling_does_not_shuffle_means(spark):
    """Few tokens, so few parts: the samples come to the means, not the means to the samples."""
    tokens = spark.createDataFrame([(s, f, s % 3) for s in range(20) for f in ("x", "y")], "sample long, feature string, token_id long")
    table = spark.createDataFrame([(t, [float(t), 1.0]) for t in range(3)], "token_id long, embedding array<double>")
    samples = spark.range(20).withColumnRenamed("id", "sample").withColumn("d", F.lit(1.0))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = em.assemble(em.mean_pool(tokens, table, "sample", 2), samples, "sample", ["x", "y"], ["d"], 2)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan
        assert {r["sample"]: r.inputs for r in out.collect()}[4] == [1.0, 1.0, 1.0, 1.0, 1.0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
