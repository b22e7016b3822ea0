"""Incremental training on keyed embedding tables, losses, training metrics, MLlib tasks and batch scoring.

A step is a Spark job: tokens join the table, pooled embeddings and dense columns give a score per sample, and
gradients are sums per token. Only the dense layer (as many numbers as the model has inputs) passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import FMClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.feature import FeatureHasher, Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import FMRegressor, GBTRegressor, LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.operators.embedding import (
    apply_gradients,
    assemble,
    decay_table,
    labelled_tokens,
    mean_pool,
    sample_tokens,
)
from adlake.operators.optimizers import Adagrad, Optimizer
from adlake.sources.versions import VersionedTable

CLIP = 1e-7

# Losses --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TaskShape:
    output_dim: int
    activation: str
    loss: str


def task_shape(task: str, targets: Sequence[str] = ("label",), num_classes: int | None = None) -> TaskShape:
    if task == "binary_classification":
        return TaskShape(1, "sigmoid", "binary_crossentropy")
    if task == "multiclass":
        return TaskShape(num_classes or 2, "softmax", "sparse_categorical_crossentropy")
    if task == "multi_label":
        return TaskShape(len(targets), "sigmoid", "binary_crossentropy")
    if task == "regression":
        return TaskShape(len(targets), "linear", "mse")
    raise ValueError(f"unknown task {task!r}")


def _clipped(p: Column) -> Column:
    return F.when(p < CLIP, F.lit(CLIP)).when(p > 1 - CLIP, F.lit(1 - CLIP)).otherwise(p)


def binary_crossentropy(p: Column, y: Column) -> Column:
    q = _clipped(p)
    return -(y * F.log(q) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q))


def loss_column(task: str, prediction: Column, target: Column) -> Column:
    """Loss of one sample. Multi-valued predictions and targets are arrays; ``regressions`` is regression with several targets."""
    if task == "binary_classification":
        return binary_crossentropy(prediction, target.cast("double"))
    if task == "regression":
        return F.pow(target.cast("double") - prediction, F.lit(2.0))
    if task == "regressions":
        each = F.zip_with(prediction, target, lambda p, y: F.pow(y.cast("double") - p, F.lit(2.0)))
        return F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / F.size(each)
    if task == "multiclass":
        return -F.log(_clipped(F.element_at(prediction, target.cast("int") + 1)))
    if task == "multi_label":
        each = F.zip_with(prediction, target, lambda p, y: binary_crossentropy(p, y.cast("double")))
        return F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / F.size(each)
    raise ValueError(f"unknown task {task!r}")


def training_metrics(batches: DataFrame, day: str, number: str, loss: str, size: str, weighted: str | None = None, alpha: float = 0.01, recent: int = 100) -> DataFrame:
    """Per day: samples, batches, weighted samples, sample-weighted mean loss, EMA and mean of the last batches.

    ``number`` counts the batches of a day from 1. The EMA is a weighted sum with weights known from the number, so it
    is an ordinary aggregate: no series is collected.
    """
    last = batches.groupBy(day).agg(F.max(number).alias("_last"))
    rows = batches.join(last, day)
    age = F.col("_last") - F.col(number)
    fade = F.pow(F.lit(1 - alpha), age)
    share = F.when(F.col(number) == 1, fade).otherwise(F.lit(alpha) * fade)
    return rows.groupBy(day).agg(
        F.sum(size).alias("total_samples"),
        F.count("*").alias("batch_count"),
        F.sum(F.col(weighted) if weighted else F.col(size).cast("double")).alias("weighted_samples"),
        (F.sum(F.col(loss) * F.col(size)) / F.sum(size)).alias("avg_loss"),
        F.sum(F.col(loss) * share).alias("ema_loss"),
        F.avg(F.when(age < recent, F.col(loss))).alias("recent_avg_loss"),
    )


# Embedding model ------------------------------------------------------------------------------

Layer = list[float] | list[list[float]]


@dataclass(frozen=True)
class EmbeddingModel:
    """Mean-pooled embeddings of sparse features and dense columns under a linear layer with one or several outputs.

    ``sparse`` maps a feature to its token column (BIGINT or ARRAY<BIGINT>). The layer has one list of numbers per output: one per
    input and a bias at the end; with a single output it is that list alone. ``targets`` names several target columns (multi_label, regression);
    a multiclass target holds the class from 0 to ``num_classes`` - 1.
    """

    sample_id: str
    sparse: Mapping[str, Column]
    dense: Sequence[str]
    target: str = ""
    task: str = "binary_classification"
    dim: int = 8
    weight: str | None = None
    learning_rate: float = 0.1
    optimizer: Optimizer = field(default_factory=lambda: Adagrad(lr=0.1))
    init: str = "uniform"
    scale: float = 0.1
    seed: int = 0
    targets: Sequence[str] = ()
    num_classes: int | None = None

    def __post_init__(self):
        if not self.target_columns:
            raise ValueError("a model needs a target")
        if self.task in ("binary_classification", "multiclass") and len(self.target_columns) > 1:
            raise ValueError(f"task {self.task!r} has one target")
        if self.outputs < 1:
            raise ValueError("a model needs an output")

    @property
    def target_columns(self) -> list[str]:
        return list(self.targets) or ([self.target] if self.target else [])

    @property
    def shape(self) -> TaskShape:
        return task_shape(self.task, self.target_columns, self.num_classes)

    @property
    def outputs(self) -> int:
        return self.shape.output_dim

    @property
    def single(self) -> bool:
        """Whether predictions are numbers and not arrays."""
        return self.task == "binary_classification" or (self.task == "regression" and self.outputs == 1)

    @property
    def inputs(self) -> int:
        return len(self.sparse) * self.dim + len(self.dense)

    def first_weights(self) -> Layer:
        """Small fixed numbers of both signs, so that embeddings receive a gradient from the first step."""
        rows = [[0.1 if (i + o) % 2 == 0 else -0.1 for i in range(self.inputs)] + [0.0] for o in range(self.outputs)]
        return rows[0] if self.single else rows

    def rows_of(self, weights: Layer) -> list[list[float]]:
        """One list per output."""
        return [list(weights)] if self.single else [list(r) for r in weights]

    def target_value(self) -> Column:
        """The target of a sample, an array where predictions are arrays over targets; NULL if any part of it is."""
        columns = [F.col(c).cast("double") for c in self.target_columns]
        if self.single or self.task == "multiclass":
            return columns[0]
        known = F.lit(True)
        for c in columns:
            known = known & c.isNotNull()
        return F.when(known, F.array(*columns))


def score(samples: DataFrame, table: DataFrame, model: EmbeddingModel, weights: Layer) -> DataFrame:
    """Add ``inputs`` and ``prediction`` to every sample."""
    tokens = sample_tokens(samples, model.sample_id, model.sparse)
    pooled = mean_pool(tokens, table, model.sample_id, model.dim, init=model.init, scale=model.scale, seed=model.seed)
    ready = assemble(pooled, samples, model.sample_id, list(model.sparse), model.dense, model.dim)

    def logit(row: Sequence[float]) -> Column:
        layer = F.array(*[F.lit(float(w)) for w in row[:-1]])
        return F.aggregate(F.zip_with("inputs", layer, lambda x, w: x * w), F.lit(float(row[-1])), lambda a, x: a + x)

    logits = [logit(row) for row in model.rows_of(weights)]
    return ready.withColumn("_logits", F.array(*logits)).withColumn("prediction", activated(model, F.col("_logits"))).drop("_logits")


def activated(model: EmbeddingModel, logits: Column) -> Column:
    """Predictions from logits: one number, or one per output."""
    kind = model.shape.activation
    if kind == "softmax":
        # Logits less their largest, so that no exponential is beyond a double.
        powers = F.transform(logits, lambda z: F.exp(z - F.array_max(logits)))
        return F.transform(powers, lambda e: e / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))
    values = F.transform(logits, lambda z: F.lit(1.0) / (F.lit(1.0) + F.exp(-z))) if kind == "sigmoid" else logits
    return F.get(values, 0) if model.single else values


def errors(model: EmbeddingModel, prediction: Column, target: Column) -> Column:
    """Derivative of the loss of a sample by each logit, an array; NULL without a target."""
    if model.single:
        error = prediction - target
        return F.when(error.isNotNull(), F.array(error * 2 if model.task == "regression" else error))
    if model.task == "multiclass":
        return F.when(target.isNotNull(), F.transform(prediction, lambda p, i: p - F.when(i == target.cast("int"), 1.0).otherwise(0.0)))
    share = (2.0 if model.task == "regression" else 1.0) / model.outputs
    return F.when(target.isNotNull(), F.zip_with(prediction, target, lambda p, y: (p - y) * F.lit(share)))


@dataclass
class StepResult:
    table: DataFrame
    weights: Layer
    samples: int
    weighted_samples: float
    loss: float
    cached: DataFrame | None = None

    def release(self) -> None:
        """Free the cached samples once the table has been written."""
        if self.cached is not None:
            self.cached.unpersist()


def train_step(samples: DataFrame, table: DataFrame, model: EmbeddingModel, weights: Layer) -> StepResult:
    """One synchronous gradient step over ``samples``. The returned table is a plan; write it before the next step.

    The gradient of the layer is one vector of inputs times outputs, summed in a vector buffer, so the plan does not widen with the model.
    """
    scored = score(samples, table, model, weights).withColumn("_target", model.target_value())
    w = F.coalesce(F.col(model.weight).cast("double"), F.lit(1.0)) if model.weight else F.lit(1.0)
    named = "regressions" if model.task == "regression" and not model.single else model.task
    loss = F.when(F.col("_target").isNotNull(), loss_column(named, F.col("prediction"), F.col("_target")))
    needed = scored.select(
        model.sample_id,
        *[c.alias(f"_s_{f}") for f, c in model.sparse.items()],
        F.concat("inputs", F.array(F.lit(1.0))).alias("_inputs"),
        F.transform(errors(model, F.col("prediction"), F.col("_target")), lambda e: e * w).alias("_error"),
        (loss * w).alias("_loss"),
        w.alias("_w"),
    ).persist()
    taught = needed.where("_error IS NOT NULL")  # a sample without a label teaches nothing
    facts = taught.agg(F.count("*").alias("n"), F.coalesce(F.sum("_w"), F.lit(0.0)).alias("w"), F.coalesce(F.avg("_loss"), F.lit(0.0)).alias("loss")).first()
    n = facts["n"]
    if n == 0:
        needed.unpersist()
        return StepResult(table, weights, 0, 0.0, 0.0)
    products = F.flatten(F.transform("_error", lambda e: F.transform("_inputs", lambda x: x * e)))
    summed = taught.select(array_to_vector(products).alias("v")).agg(Summarizer.sum(F.col("v")).alias("g")).first()["g"].toArray()
    size = model.inputs + 1
    moved = [
        [a - model.learning_rate * float(g) / n for a, g in zip(row, summed[o * size : (o + 1) * size])]
        for o, row in enumerate(model.rows_of(weights))
    ]
    grads = token_gradients(needed, model, weights, n)
    updated = apply_gradients(
        table, grads, model.optimizer, model.dim, model.init, model.scale, model.seed
    )
    return StepResult(updated, moved[0] if model.single else moved, n, float(facts["w"]), float(facts["loss"]), needed)


def token_gradients(needed: DataFrame, model: EmbeddingModel, weights: Layer, n: int) -> DataFrame:
    """(token_id, grad). All tokens of a mean share its gradient, so one number per (token, feature, output) is summed and only
    then spread over the layer's weights: the shuffle carries no embeddings."""
    features, rows_of_layer = sorted(model.sparse), model.rows_of(weights)
    outputs = range(len(rows_of_layer))
    error = F.col("_error") if needed.schema["_error"].dataType.typeName() == "array" else F.array("_error")
    cells = []
    for f in features:
        c = F.col(f"_s_{f}")
        tokens = c if needed.schema[f"_s_{f}"].dataType.typeName() == "array" else F.array(c)
        share = F.lit(1.0) / F.size(tokens) / F.lit(float(n))
        parts = [(F.coalesce(F.get(error, o), F.lit(0.0)) * share).alias(f"part{o}") for o in outputs]
        cells.append(labelled_tokens(tokens, f, *parts))
    rows = needed.select(F.explode(F.concat(*cells)).alias("_t")).select("_t.*")
    sums = [
        F.coalesce(F.sum(F.when(F.col("feature") == f, F.col(f"part{o}"))), F.lit(0.0)).alias(f"_p{o}_{f}") for f in features for o in outputs
    ]
    summed = rows.groupBy("token_id").agg(*sums)
    grad = []
    for i in range(model.dim):
        terms = [F.col(f"_p{o}_{f}") * F.lit(float(rows_of_layer[o][k * model.dim + i])) for k, f in enumerate(features) for o in outputs]
        grad.append(sum(terms[1:], terms[0]))
    return summed.select("token_id", F.array(*grad).alias("grad"))


def train_days(
    days: Iterable[tuple[str, DataFrame]],
    model: EmbeddingModel,
    store: VersionedTable,
    steps_per_day: int = 1,
    decay: float = 1.0,
) -> list[dict[str, Any]]:
    """Train day by day: steps, decay, one saved version per step. A resume starts after the last complete day.

    Every step's table is written before the next one reads it, so lineage stays one step long and a lost executor costs
    at most that step. A day without samples yields a zero row and keeps the model.
    """
    spark = store.spark
    finished = [v for v in store.versions() if store.info(v)["complete"]]
    if finished:
        version = finished[-1]
        info = store.info(version)
        table, weights, done = store.load(version), info["weights"], info["day"]
    else:
        empty = "token_id bigint, embedding array<float>, update_count double, steps int"
        states = "".join(f", {s} array<double>" for s in model.optimizer.states)
        table, weights, done, version = spark.createDataFrame([], empty + states), model.first_weights(), "", 0
    results = []
    for day, samples in days:
        if day <= done:
            continue
        total = {"day": day, "samples": 0, "batches": 0, "weighted_samples": 0.0, "loss": 0.0}
        loss_sum = 0.0
        for step in range(steps_per_day):
            result = train_step(samples, table, model, weights)
            if result.samples == 0:
                break
            weights, last = result.weights, step == steps_per_day - 1
            after = decay_table(result.table, decay) if last and decay != 1.0 else result.table
            version += 1
            store.save(after, version, {"day": day, "complete": last, "weights": weights})
            result.release()
            table = store.load(version)
            loss_sum += result.loss * result.samples
            total["samples"] += result.samples
            total["weighted_samples"] += result.weighted_samples
            total["batches"] += 1
        if total["samples"]:
            total["loss"] = loss_sum / total["samples"]
            done = day
        results.append(total)
    return results


def training_totals(results: Sequence[Mapping[str, Any]]) -> dict[str, Any]:
    samples = sum(r["samples"] for r in results)
    return {
        "days": len(results),
        "samples": samples,
        "batches": sum(r["batches"] for r in results),
        "weighted_samples": math.fsum(r["weighted_samples"] for r in results),
        "loss": math.fsum(r["loss"] * r["samples"] for r in results) / samples if samples else 0.0,
    }


# MLlib tasks ----------------------------------------------------------------------------------

LEARNERS = {
    "linear_regression": LinearRegression,
    "logistic_regression": LogisticRegression,
    "gbt_classifier": GBTClassifier,
    "gbt_regressor": GBTRegressor,
    "fm_classifier": FMClassifier,
    "fm_regressor": FMRegressor,
}


@dataclass(frozen=True)
class TrainingTask:
    learner: str
    target: str
    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    hyperparameters: Mapping[str, Any] = field(default_factory=dict)
    validation_split: float = 0.2
    seed: int = 0
    hash_features: int = 1 << 18


def split_by_hash(df: DataFrame, id_column: str, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(training, validation) by a hash of the id: the same rows on every run and retry, whatever the partitions."""
    place = F.pmod(F.xxhash64(F.col(id_column), F.lit(seed)), F.lit(10_000))
    limit = int(round(share * 10_000))
    return df.where(place >= limit), df.where(place < limit)


def fit_task(df: DataFrame, task: TrainingTask, id_column: str) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows with a label; returns the model and the scored validation rows.

    Missing numbers become the mean of the training rows, in fitting and in scoring, so no row is lost.
    """
    if task.learner not in LEARNERS:
        raise ValueError(f"unknown learner {task.learner!r}")
    train, held_out = split_by_hash(df, id_column, task.validation_split, task.seed)
    stages: list = []
    inputs = [f"_filled_{c}" for c in task.numeric]
    if inputs:
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(f'CAST(`{c}` AS DOUBLE) AS `_number_{c}`' for c in task.numeric)} FROM __THIS__"))
        stages.append(Imputer(inputCols=[f"_number_{c}" for c in task.numeric], outputCols=inputs))
    if task.categorical:
        # hashing needs no list of categories, which could outgrow the driver
        stages.append(
            FeatureHasher(
                inputCols=list(task.categorical), categoricalCols=list(task.categorical), outputCol="hashed",
                numFeatures=task.hash_features,
            )
        )
        inputs.append("hashed")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    stages.append(LEARNERS[task.learner](featuresCol="features", labelCol=task.target, **task.hyperparameters))
    model = Pipeline(stages=stages).fit(train.where(F.col(task.target).isNotNull()))
    return model, model.transform(held_out)


def store_model(model: PipelineModel, path: str) -> None:
    """Write a fitted task to a folder that all executors share."""
    model.write().overwrite().save(path)


def stored_scores(df: DataFrame, path: str) -> DataFrame:
    """Score rows with a stored task; the columns it fills and assembles are dropped again."""
    scored = PipelineModel.load(path).transform(df)
    kept = [c for c in ("prediction", "probability") if c in scored.columns]
    return scored.select(*df.columns, *kept)


def linear_score(df: DataFrame, weights: Mapping[str, float], bias: float = 0.0, output: str = "score") -> DataFrame:
    """Σ w·x + b from a small weight map, as plain arithmetic."""
    terms = [F.col(c) * F.lit(float(w)) for c, w in weights.items()]
    return df.withColumn(output, sum(terms, F.lit(float(bias))))


def sparse_scores(tokens: DataFrame, weights: DataFrame, sample_id: str) -> DataFrame:
    """Score per sample from one weight per token: Σ w over its tokens, unknown tokens 0."""
    known = weights.select(F.col("token_id").alias("_token"), "w")
    joined = tokens.join(known, F.col("token_id") == F.col("_token"), "left")
    return joined.groupBy(sample_id).agg(F.coalesce(F.sum("w"), F.lit(0.0)).alias("score"))

