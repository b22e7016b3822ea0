"""Toxicity: a bag of subword embeddings, averaged, into a linear softmax; all of it trained jointly in numpy.

Subwords are byte 3- to 5-grams of lower-cased words with their borders, hashed into ``2**BITS`` embedding rows, so an
unseen misspelling shares most vectors with the spelling it comes from. A text is cut into windows of ``WINDOW`` words;
each window is one averaged bag, and the worst window is the text's score, so length does not thin a passage out. The
worst windows of the present model are what each epoch trains on, after some epochs on whole texts.

Training uses at most ``PER_CLASS`` labelled rows of either class, taken in hash order of the ids; everything else covers
all rows. Scoring is one pass without a shuffle.

Defined cases: NULL and empty texts get the score of an empty bag; rows whose id is NULL are scored and not held out;
repeated rows score alike; without labels of both classes every score is the share of toxic labels (0 without labels);
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import Powers, byte_codes, byte_grams, flat_bytes, lower_ascii, slices, words_of

BITS = 18
DIM = 8
GRAMS = (3, 4, 5)
WINDOW = 8
FEWEST = 80  # a window with fewer subwords is filled up with empty ones
PER_CLASS = 800
WHOLE_EPOCHS = 4
EPOCHS = 8
BATCHES = 24
RATE = 0.5
SEED = 11
STEP_BYTES = 1 << 19


@dataclass
class Bags:
    """Subword numbers by bag, the first subword of each bag, and the first bag of each text (one more entry each)."""

    grams: np.ndarray
    firsts: np.ndarray
    texts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.maximum(np.diff(self.firsts), FEWEST)


def bags_of(texts: pa.Array, powers: Powers, codes: np.ndarray) -> Bags:
    data, offsets = flat_bytes(texts)
    rows = len(offsets) - 1
    data = lower_ascii(data)
    starts, _, first_word = words_of(data, offsets)
    hashes, places = byte_grams(data, offsets, GRAMS, powers, codes)
    row_of_word = np.repeat(np.arange(rows), np.diff(first_word))
    word = np.searchsorted(starts + 2 * row_of_word + 1, places + 1, "right") - 1
    row = row_of_word[word]
    bags = np.maximum(1, np.diff(first_word) // WINDOW)
    texts_at = np.concatenate([[0], np.cumsum(bags)])
    bag = texts_at[row] + np.minimum((word - first_word[row]) // WINDOW, bags[row] - 1)
    order = np.argsort(bag, kind="stable")
    firsts = np.searchsorted(bag[order], np.arange(texts_at[-1] + 1))
    return Bags((hashes[order] >> np.uint64(64 - BITS)).astype(np.int32), firsts, texts_at)


@dataclass
class Model:
    vectors: np.ndarray  # (2**BITS, DIM)
    weights: np.ndarray  # of the toxic class less those of the other: a softmax over two classes
    bias: float

    def subword_scores(self) -> np.ndarray:
        """The linear layer applied to each vector: averaging and the layer commute."""
        return (self.vectors @ self.weights).astype(np.float32)


def bag_logits(bags: Bags, scores: np.ndarray, bias: float) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(scores[bags.grams], dtype=np.float64)])
    return (sums[bags.firsts[1:]] - sums[bags.firsts[:-1]]) / bags.counts + bias


def worst_bags(bags: Bags, logits: np.ndarray) -> np.ndarray:
    """The first bag with the highest logit, per text."""
    highest = np.maximum.reduceat(logits, bags.texts[:-1])
    hit = np.flatnonzero(logits == np.repeat(highest, np.diff(bags.texts)))
    return hit[np.searchsorted(hit, bags.texts[:-1])]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(bags: Bags, toxic: np.ndarray) -> Model:
    """Joint gradient steps on vectors and linear layer, each with a step size of its own (sum of squared gradients).

    Both classes weigh the same in all.
    """
    draw = np.random.default_rng(SEED)
    vectors = draw.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    weights, bias = draw.normal(0, 1, DIM).astype(np.float32), -1.0
    weigh = np.where(toxic == 1, len(toxic) / (2 * toxic.sum()), len(toxic) / (2 * (1 - toxic).sum()))
    seen, seen_weights = np.full(1 << BITS, 1e-8, np.float32), 1e-8
    for epoch in range(WHOLE_EPOCHS + EPOCHS):
        if epoch < WHOLE_EPOCHS:
            first, last = bags.firsts[bags.texts[:-1]], bags.firsts[bags.texts[1:]]
        else:
            worst = worst_bags(bags, bag_logits(bags, Model(vectors, weights, bias).subword_scores(), bias))
            first, last = bags.firsts[worst], bags.firsts[worst + 1]
        for batch in np.array_split(draw.permutation(len(toxic)), BATCHES):
            if not len(batch):
                continue
            begins, ends = first[batch], last[batch]
            sizes = ends - begins
            row = np.repeat(np.arange(len(batch)), sizes)
            grams = bags.grams[np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
            means = np.stack([np.bincount(row, vectors[grams, k], len(batch)) for k in range(DIM)], 1)
            means /= np.maximum(sizes, FEWEST)[:, None]
            error = weigh[batch] * (sigmoid(means @ weights + bias) - toxic[batch]) / len(batch)
            pull = np.bincount(grams, (error / np.maximum(sizes, FEWEST))[row], 1 << BITS)
            hit = np.flatnonzero(pull)
            step = pull[hit, None] * weights
            seen[hit] += (step**2).mean(1)
            vectors[hit] -= (RATE * step / np.sqrt(seen[hit])[:, None]).astype(np.float32)
            step = means.T @ error
            seen_weights += float((step**2).mean())
            weights = (weights - RATE * step / np.sqrt(seen_weights)).astype(np.float32)
            bias -= RATE * float(error.sum())
    return Model(vectors, weights, bias)


def remainder(key: Column, by: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % by


def sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int) -> list:
    """(text, label) of at most ``per_class`` labelled rows of either class, in hash order of their ids."""
    usable = labels.where(allowed & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("_label")).distinct()
    picked = [
        usable.where(F.col("_label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)
    ]
    wanted = picked[0].unionByName(picked[1])
    # At most 2 * per_class rows, so the broadcast is bounded.
    found = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
    return sorted((r["doc_id"], r["text"] or "", r["_label"]) for r in found.collect())


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, per_class: int = PER_CLASS) -> Model | float:
    """A model, or the share of toxic labels if there is only one class."""
    rows = sample(docs, labels, "toxic", allowed, per_class)
    toxic = np.array([r[2] for r in rows], np.float64)
    if len(np.unique(toxic)) < 2:
        return float(toxic.mean()) if len(toxic) else 0.0
    powers, codes = Powers(), byte_codes()
    texts = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.large_string())], ["text"])
    parts = [bags_of(b.column("text"), powers, codes) for b in slices(texts, "text", STEP_BYTES)]
    grams, firsts, ends = [], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    for p in parts:
        grams.append(p.grams)
        ends.append(p.texts[1:] + ends[-1][-1])
        firsts.append(p.firsts[1:] + firsts[-1][-1])
    return train(Bags(np.concatenate(grams), np.concatenate(firsts), np.concatenate(ends)), toxic)


def score(docs: DataFrame, model: Model | float, threshold: float) -> DataFrame:
    """doc_id, held_out as given, score and predicted, for (doc_id, held_out, text)."""
    constant = model if isinstance(model, float) else None
    table, bias = (None, 0.0) if constant is not None else (model.subword_scores(), model.bias)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes, scores = Powers(), byte_codes(), shared.value
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                if constant is not None:
                    p = np.full(batch.num_rows, constant)
                else:
                    bags = bags_of(batch.column("text"), powers, codes)
                    p = sigmoid(np.maximum.reduceat(bag_logits(bags, scores, bias), bags.texts[:-1]))
                predicted = pa.array((p >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(p), predicted],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, threshold: float = 0.7) -> DataFrame:
    """Scores of all documents by a model that has seen no label of the held-out fold."""
    model = fit(docs, labels, remainder(F.col("doc_id"), folds) != held)
    flagged = docs.withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), folds) == held, F.lit(False)))
    return score(flagged, model, threshold)
