"""Multi-output steps and mini-batch training against numpy."""

import math
import uuid
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.operators import embedding as em
from adlake.operators import minibatch as mb
from adlake.operators import optimizers as opt
from adlake.operators import training as tr
from adlake.session import shared_folder
from adlake.sources.versions import LogTable

DIM = 3


@pytest.fixture(scope="module")
def samples(spark):
    """Tokens, one of them in nearly all rows, decide class and labels; weights with NULL; some rows without a label."""
    rows = []
    for i in range(180):
        tags = [i % 6, 7] if i % 9 else ([] if i % 2 else None)
        y = None if i % 31 == 5 else i % 3
        rows.append((i, tags, 100 + i % 4, (i % 5) / 5, y, i % 2, int(i % 3 == 0), float(i % 7), None if i % 11 == 0 else 0.5 + i % 3))
    return spark.createDataFrame(rows, "sid long, tags array<long>, site long, x double, y int, a int, b int, v double, w double")


def model(task, **kw):
    names = {"multiclass": {"target": "y", "num_classes": 3}, "multi_label": {"targets": ["a", "b"]}, "regression": {"targets": ["x", "v"]},
             "binary_classification": {"target": "a"}}[task]
    return tr.EmbeddingModel("sid", {"tags": F.col("tags"), "site": F.col("site")}, ["x"], task=task, dim=DIM, learning_rate=0.2, **names, **kw)


class Twin:
    """The same training, sample by sample."""

    def __init__(self, spark, m, tokens):
        first = spark.createDataFrame([(t,) for t in tokens], "token_id long").select(
            "token_id", em.initial_embedding(F.col("token_id"), DIM, m.init, m.scale, m.seed).alias("e")
        )
        self.first = {r.token_id: np.array(r.e, np.float32) for r in first.collect()}
        self.m, self.table, self.count = m, {}, defaultdict(lambda: 1.0)
        self.acc = defaultdict(lambda: np.full(DIM, m.optimizer.initial))
        self.layer = np.array(m.rows_of(m.first_weights()))

    def vector(self, t):
        return self.table.get(t, self.first[t]).astype(float)

    def target(self, r):
        values = [r[c] for c in self.m.target_columns]
        return None if any(v is None for v in values) else values

    def step(self, rows, weights):
        n, layer_grad, grads, losses = 0, np.zeros_like(self.layer), defaultdict(lambda: np.zeros(DIM)), []
        sized = []
        for r, w in zip(rows, weights):
            lists = {"site": [r.site], "tags": r.tags or []}
            x = np.concatenate([np.mean([self.vector(t) for t in lists[f]], axis=0) if lists[f] else np.zeros(DIM) for f in ("site", "tags")] + [[r.x, 1.0]])
            z, y = self.layer @ x, self.target(r)
            if self.m.task == "multiclass":
                p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            else:
                p = z if self.m.task == "regression" else 1 / (1 + np.exp(-z))
            if y is None:
                error = np.zeros(len(z))
            else:
                n += 1
                if self.m.task == "multiclass":
                    error, loss = p - np.eye(3)[y[0]], -math.log(p[y[0]])
                elif self.m.task == "regression":
                    error, loss = 2 * (p - y) / len(p), float(np.mean((p - y) ** 2))
                else:
                    error, loss = (p - y) / len(p), float(np.mean(-(np.array(y) * np.log(p) + (1 - np.array(y)) * np.log(1 - p))))
                losses.append(loss * w)
            sized.append((lists, x, error * w))
        for lists, x, error in sized:
            layer_grad += np.outer(error, x) / n
            for k, f in enumerate(("site", "tags")):
                for t in lists[f]:
                    grads[t] += error @ self.layer[:, k * DIM : (k + 1) * DIM] / len(lists[f]) / n
        self.layer = self.layer - self.m.learning_rate * layer_grad
        for t, g in grads.items():
            self.acc[t] = self.acc[t] + g * g
            self.table[t] = (self.vector(t) - self.m.optimizer.lr * g / (np.sqrt(self.acc[t]) + self.m.optimizer.eps)).astype(np.float32)
            self.count[t] += 1
        return n, sum(losses) / n

    def decay(self, factor):
        self.table = {t: (v.astype(float) * factor).astype(np.float32) for t, v in self.table.items()}
        for t in self.table:
            self.count[t] *= factor


TOKENS = [*range(8), *range(100, 104)]


@pytest.mark.parametrize("task", ["multiclass", "multi_label", "regression", "binary_classification"])
def test_one_step_of_every_task(spark, samples, task):
    m = model(task)
    twin = Twin(spark, m, TOKENS)
    rows = samples.collect()
    n, loss = twin.step(rows, [1.0] * len(rows))
    empty = spark.createDataFrame([], "token_id bigint, embedding array<float>, update_count double, steps int, acc array<double>")
    got = tr.train_step(samples, empty, m, m.first_weights())
    assert (got.samples, got.loss) == (n, pytest.approx(loss))
    assert np.allclose(m.rows_of(got.weights), twin.layer, atol=1e-9)
    table = {r.token_id: r for r in got.table.collect()}
    assert table.keys() == twin.table.keys()
    for t, r in table.items():
        assert np.allclose(r.embedding, twin.table[t], atol=1e-6) and np.allclose(r.acc, twin.acc[t], atol=1e-9)
    got.release()


def test_days_in_batches_equal_the_sequential_run(spark, samples):
    """Weights normalised inside a batch, decay at the end of a day, a stop in the middle of a day, compaction on the way."""
    m = model("multiclass", weight="w")
    store = LogTable(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}", shards=2)
    days = [("d1", samples.where("sid < 100")), ("d2", samples.where("false")), ("d3", samples.where("sid >= 90"))]
    results = mb.train_batches(days[:1], m, store, 32, decay=0.9, compact_every=3)
    assert [r["samples"] <= 32 for r in results] == [True] * 4 and [r["batch"] for r in results] == [0, 1, 2, 3]
    results += mb.train_batches(days, m, store, 32, decay=0.9, compact_every=3)
    assert mb.train_batches(days, m, store, 32) == []
    twin, want = Twin(spark, m, TOKENS), []
    for day in ("d1", "d3"):
        written = spark.read.parquet(f"{store.root}/days/{day}").collect()
        for b in sorted({r["_batch"] for r in written}):
            rows = [r for r in written if r["_batch"] == b]
            w = np.array([1.0 if r.w is None else r.w for r in rows])
            w = w / w.sum() * len(w)
            assert [r["weight_norm"] for r in rows] == pytest.approx(w.tolist())
            want.append(twin.step(rows, w))
        twin.decay(0.9)
    assert [r["samples"] for r in results] == [n for n, _ in want]
    assert [r["loss"] for r in results] == pytest.approx([x for _, x in want], rel=1e-5)
    got = {r.token_id: r for r in store.load().collect()}
    assert got.keys() == twin.table.keys()
    for t, r in got.items():
        assert np.allclose(r.embedding, twin.table[t], atol=1e-5) and r.update_count == pytest.approx(twin.count[t])
    assert np.allclose(store.info(store.latest())["weights"], twin.layer, atol=1e-6)


def test_a_stopped_day_goes_on_where_it_stopped(spark, samples, monkeypatch):
    m = model("multi_label", optimizer=opt.SGD(lr=0.3))
    whole = LogTable(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}", shards=2)
    broken = LogTable(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}", shards=2)
    full = mb.train_batches([("d1", samples)], m, whole, 64)
    step, calls = mb.train_step, []

    def stops(*args):
        if len(calls) == 2:
            raise RuntimeError("an executor is lost")
        calls.append(1)
        return step(*args)

    monkeypatch.setattr(mb, "train_step", stops)
    with pytest.raises(RuntimeError):
        mb.train_batches([("d1", samples)], m, broken, 64)
    monkeypatch.setattr(mb, "train_step", step)
    rest = mb.train_batches([("d1", samples.limit(3))], m, broken, 64)  # the day as it was written counts
    assert [r["batch"] for r in rest] == [r["batch"] for r in full][2:]
    assert rest[-1]["loss"] == pytest.approx(full[-1]["loss"])


def test_batches_are_numbered_through(spark):
    rows = mb.numbered_batches(spark.range(100).withColumnRenamed("id", "sid"), "sid", 8).groupBy("_batch").count().collect()
    assert sorted(r["_batch"] for r in rows) == list(range(13)) and sum(r["count"] for r in rows) == 100
