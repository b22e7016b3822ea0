"""Day-by-day training in mini-batches on a log of changed rows.

A day is written once, partitioned by batch, with sample weights normalised inside each batch. A step reads the folder of its
batch, the rows of its tokens, and appends the rows it changed as a version; the layer travels in the version's facts. So a step costs what
its batch costs, and a run that stops resumes after its last step.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.embedding import normalised_weights, sample_tokens, shuffled_batches
from adlake.operators.training import EmbeddingModel, train_step
from adlake.sources.versions import LogTable

WEIGHT = "weight_norm"


def numbered_batches(samples: DataFrame, sample_id: str, batch_size: int, seed: int = 0) -> DataFrame:
    """Add ``_batch``, numbered from 0 over all buckets of the shuffle, whose ids must be unique. The last batch of each bucket may be short."""
    placed = shuffled_batches(samples, sample_id, batch_size, seed=seed)
    counts = placed.groupBy(F.col("bucket").alias("_bucket")).agg((F.max("batch") + 1).alias("_n"))  # one row per bucket
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_bucket", before.alias("_before"))
    joined = placed.join(offsets, F.col("bucket") == F.col("_bucket"))
    return joined.select(*samples.columns, (F.col("_before") + F.col("batch")).cast("int").alias("_batch"))


def write_day(samples: DataFrame, model: EmbeddingModel, folder: str, batch_size: int, seed: int = 0, default_weight: float = 1.0) -> None:
    """The samples of a day as ``{folder}/_batch=N``, with ``weight_norm`` if the model has a weight. A batch is one task."""
    rows = numbered_batches(samples, model.sample_id, batch_size, seed)
    if model.weight:
        rows = normalised_weights(rows, ["_batch"], model.weight, default_weight, WEIGHT)
    rows.repartition("_batch").write.mode("overwrite").partitionBy("_batch").parquet(folder)


def batches_of(store: LogTable, folder: str) -> int | None:
    """Number of batches of a day that is written; None if it is not."""
    fs, where = store._fs(folder)
    if not store._exists(f"{folder}/_SUCCESS"):
        return None
    return sum(s.getPath().getName().startswith("_batch=") for s in fs.listStatus(where))


def train_batches(
    days: Iterable[tuple[str, DataFrame]],
    model: EmbeddingModel,
    store: LogTable,
    batch_size: int,
    decay: float = 1.0,
    seed: int = 0,
    compact_every: int = 100,
    default_weight: float = 1.0,
) -> list[dict[str, Any]]:
    """Train day by day, batch by batch; one row per step: day, batch, samples, weighted_samples, loss.

    ``decay`` scales the table after the last batch of a day. After ``compact_every`` steps the log gets a new base. A resume goes on after the last step
    saved, in the middle of a day too: the day's batches are read as they were written. A day without samples yields no row.
    """
    spark, versions = store.spark, store.versions()
    version = versions[-1] if versions else 0
    state = store.info(version) if versions else {"day": "", "batch": -1, "complete": True, "weights": model.first_weights()}
    weights = state["weights"]
    stepped = replace(model, weight=WEIGHT) if model.weight else model
    results = []
    for day, samples in days:
        if day < state["day"] or (day == state["day"] and state["complete"]):
            continue
        folder = f"{store.root}/days/{day}"
        count = batches_of(store, folder)
        if count is None:
            write_day(samples, model, folder, batch_size, seed, default_weight)
            count = batches_of(store, folder)
        done = state["batch"] + 1 if day == state["day"] else 0
        for number in range(done, count):
            batch = spark.read.parquet(f"{folder}/_batch={number}")
            result = train_step(batch, touched_rows(batch, model, store), stepped, weights)
            weights, version, last = result.weights, version + 1, number == count - 1
            state = {"day": day, "batch": number, "complete": last, "weights": weights}
            store.append(result.table, version, state, decay if last else 1.0)
            result.release()
            results.append({"day": day, "batch": number, "samples": result.samples, "weighted_samples": result.weighted_samples, "loss": result.loss})
            if len(store.chain()) > compact_every:
                version = store.compact()
                store.vacuum()
    return results


def touched_rows(batch: DataFrame, model: EmbeddingModel, store: LogTable) -> DataFrame:
    """The rows of the table that a batch needs."""
    tokens = sample_tokens(batch, model.sample_id, model.sparse).select("token_id").distinct()
    if store.versions():
        return store.load(keys=tokens)
    states = "".join(f", {s} array<double>" for s in model.optimizer.states)
    return store.spark.createDataFrame([], "token_id bigint, embedding array<float>, update_count double, steps int" + states)
