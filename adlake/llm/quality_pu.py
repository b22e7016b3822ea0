"""Quality classifier from positives and unlabelled texts: non-negative unbiased risk, with an estimated class prior.

Trusted positives are rows labelled good; the unlabelled side is a sample of all documents. With prior p, the risk of
the unlabelled side less p times the positives' share of it estimates the risk on bad texts; where it falls below zero
the model overfits, and the step goes the other way. The prior is the smallest ratio of the two score tails of a first
model that tells positives from unlabelled texts.

The model is a small network over measures of a text (case, marks, repeats, word shapes). Training takes at most
``POSITIVES`` and ``UNLABELLED`` rows in hash order of their ids; scoring is one pass over all rows without a shuffle.

Defined cases: NULL and empty texts are scored on zero measures; rows whose id is NULL are scored and not held out;
repeated rows score alike; without positives every score is 0; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import Powers, Rolling, byte_codes, flat_bytes, lower_ascii, slices, words_of
from adlake.llm.toxicity import remainder, sigmoid

POSITIVES = 2000
UNLABELLED = 4000
HIDDEN = 16
STEPS = 1500
BATCH = 256
RATE = 0.01
DECAY = 1e-3
SEED = 5
STEP_BYTES = 1 << 20
TAIL = 0.3  # least share of positives in a tail that the prior is read from

UPPER, DIGIT, MARK, SYMBOL, BANG, HIGH = range(6)


def byte_kinds() -> np.ndarray:
    """Kind of each byte value; 255 for any other."""
    kinds = np.full(256, 255, np.uint8)
    kinds[65:91] = UPPER
    kinds[48:58] = DIGIT
    kinds[[ord(c) for c in ".,;:?"]] = MARK
    kinds[[ord(c) for c in "#*$%&|<>@=_~^{}[]\\/+"]] = SYMBOL
    kinds[ord("!")] = BANG
    kinds[128:] = HIGH
    return kinds


def measures(texts: pa.Array, powers: Powers, codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """A row of measures for each text."""
    data, offsets = flat_bytes(texts)
    rows, lengths = len(offsets) - 1, np.diff(offsets)
    starts, ends, first = words_of(data, offsets)
    words = np.diff(first)
    row = np.repeat(np.arange(rows), words)
    kind, row_of = kinds[data], np.repeat(np.arange(rows), lengths)
    per_byte = [np.bincount(row_of[kind == k], minlength=rows) for k in range(6)]
    lines = np.bincount(row_of[data == 10], minlength=rows)
    hashes = Rolling(lower_ascii(data), powers, codes)(starts, ends)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    long = np.bincount(row, ends - starts > 20, rows)
    bare = np.bincount(row, ends - starts == 1, rows)
    order = np.lexsort((hashes, row))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][fresh], minlength=rows)
    letters = np.bincount(row, ends - starts, rows)
    w, b = np.maximum(words, 1), np.maximum(lengths, 1)
    return np.column_stack(
        [
            np.log1p(words), letters / w, per_byte[UPPER] / b, per_byte[DIGIT] / b, per_byte[MARK] / w,
            per_byte[SYMBOL] / w, per_byte[BANG] / w, per_byte[HIGH] / b, lines / w,
            np.bincount(row, again, rows) / w, distinct / w, np.log1p(distinct) - np.log1p(words), long / w, bare / w,
        ]
    )


@dataclass
class Net:
    """One hidden layer over standardised measures."""

    mean: np.ndarray
    scale: np.ndarray
    params: list[np.ndarray]

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.params[0] + self.params[1])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.params[2] + self.params[3][0]

    def gradients(self, x: np.ndarray, pull: np.ndarray) -> list[np.ndarray]:
        """Of the sum of ``pull * logit``."""
        z, h = np.clip((x - self.mean) / self.scale, -8, 8), self.hidden(x)
        back = pull[:, None] * self.params[2] * (1 - h**2)
        return [z.T @ back, back.sum(0), h.T @ pull, np.array([pull.sum()])]


def new_net(x: np.ndarray) -> Net:
    draw = np.random.default_rng(SEED)
    sizes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), (1,)]
    return Net(x.mean(0), x.std(0) + 1e-6, [draw.normal(0, 0.3, s) if len(s) == 2 or s == (HIDDEN,) else np.zeros(s) for s in sizes])


class Steps:
    """Gradient steps scaled by running moments."""

    def __init__(self, params: list[np.ndarray]):
        self.n, self.m, self.v = 0, [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def take(self, params: list[np.ndarray], grads: list[np.ndarray]) -> None:
        self.n += 1
        for p, g, m, v in zip(params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**self.n)) / (np.sqrt(v / (1 - 0.99**self.n)) + 1e-8)


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> Net:
    """Minimise prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)]) with the logistic loss."""
    draw, net = np.random.default_rng(SEED), new_net(unlabelled)
    pace = Steps(net.params)
    for _ in range(steps):
        p = positive[draw.integers(0, len(positive), min(BATCH, len(positive)))]
        u = unlabelled[draw.integers(0, len(unlabelled), min(BATCH, len(unlabelled)))]
        gp, gu = net.logits(p), net.logits(u)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        if negative >= 0:
            pull_p = prior * (sigmoid(gp) - 1) - prior * sigmoid(gp)
            pull_u = sigmoid(gu)
        else:  # only undo the negative part
            pull_p, pull_u = prior * sigmoid(gp), -sigmoid(gu)
        grads = [a + b for a, b in zip(net.gradients(p, pull_p / len(p)), net.gradients(u, pull_u / len(u)), strict=True)]
        pace.take(net.params, [g + DECAY * w for g, w in zip(grads, net.params, strict=True)])
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest ratio of unlabelled to positive tails: good texts alone fill the tail where the ratio is smallest.

    Every row is ranked by a first model that was trained on the other half of the rows.
    """
    draw, ratios = np.random.default_rng(SEED), []
    positive, unlabelled = (x[draw.permutation(len(x))] for x in (positive, unlabelled))
    for half in (0, 1):
        first = fit_pu(positive[half::2], unlabelled[half::2], 0.5, STEPS // 5)
        p, u = (np.sort(first.logits(x[1 - half :: 2])) for x in (positive, unlabelled))
        cuts = np.quantile(p, np.linspace(0, 1 - TAIL, 20))
        tail_p = 1 - np.searchsorted(p, cuts) / len(p)
        tail_u = 1 - np.searchsorted(u, cuts) / len(u)
        ratios.append(np.min(tail_u / tail_p))
    return float(np.clip(np.mean(ratios), 0.05, 0.95))


def measured(rows: DataFrame) -> np.ndarray:
    """Measures of few rows, computed in tasks; sorted, so that reruns train alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes, kinds = Powers(), byte_codes(), byte_kinds()
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                x = measures(batch.column("text"), powers, codes, kinds)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x.tolist())], ["doc_id", "x"])

    got = rows.select("doc_id", "text").mapInArrow(run, "doc_id bigint, x array<double>").collect()
    return np.array(sorted((r.doc_id, *r.x) for r in got))[:, 1:] if got else np.zeros((0, 14))


def sampled(docs: DataFrame, ids: DataFrame, most: int) -> np.ndarray:
    """Measures of at most ``most`` of the documents in ``ids``, first in hash order; the broadcast is that small."""
    some = ids.where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(some), "doc_id")
    return measured(found)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column) -> tuple[Net | None, float]:
    """(model, class prior)"""
    good = labels.where(allowed & (F.col("quality") == 1)).select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    positive = sampled(docs, good, POSITIVES)
    unlabelled = sampled(docs, docs.select(F.col("doc_id").cast("bigint").alias("doc_id")), UNLABELLED)
    if len(positive) < 2 or len(unlabelled) < 2:
        return None, 0.0
    prior = estimate_prior(positive, unlabelled)
    return fit_pu(positive, unlabelled, prior), prior


def score(docs: DataFrame, net: Net | None, threshold: float) -> DataFrame:
    parts = None if net is None else (net.mean, net.scale, net.params)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes, kinds = Powers(), byte_codes(), byte_kinds()
        model = None if shared.value is None else Net(*shared.value)
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                x = measures(batch.column("text"), powers, codes, kinds)
                p = np.zeros(len(x)) if model is None else sigmoid(model.logits(x))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, threshold: float = 0.3) -> DataFrame:
    """Scores of all documents by a model that has seen no label of the held-out fold."""
    net, _ = fit(docs, labels, remainder(F.col("doc_id"), folds) != held)
    flagged = docs.withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), folds) == held, F.lit(False)))
    return score(flagged, net, threshold)
