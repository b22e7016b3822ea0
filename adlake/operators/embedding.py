"""Keyed embedding tables: (token_id, embedding, update_count, steps, optimizer state)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.optimizers import Optimizer, step_arrays
from adlake.operators.running import RANGE_ROWS, exact_percentiles, with_group_totals

_TWO_53 = float(1 << 53)
POOL_ROWS = 100_000  # tokens that one task pools
SENT_BYTES = 64 << 20  # of vectors that go whole to every executor


def _uniform(token: Column, position: Column, seed: int) -> Column:
    """A number in (0, 1) fixed by token, position and seed."""
    bits = F.pmod(F.xxhash64(token, position, F.lit(seed)), F.lit(1 << 53))
    return (bits.cast("double") + F.lit(0.5)) / F.lit(_TWO_53)


def initial_embedding(token: Column, dim: int, init: str = "zeros", scale: float = 0.01, seed: int = 0) -> Column:
    """First embedding of a token. Random forms depend on (token, position, seed) only, so retries agree."""
    positions = F.sequence(F.lit(1), F.lit(dim))
    if init == "zeros":
        return F.array_repeat(F.lit(0.0).cast("float"), dim)
    if init == "uniform":
        values = F.transform(positions, lambda i: (_uniform(token, i, seed) * 2 - 1) * F.lit(scale))
    elif init == "normal":
        values = F.transform(
            positions,
            lambda i: F.sqrt(F.lit(-2.0) * F.log(_uniform(token, i, seed)))
            * F.cos(F.lit(2 * 3.141592653589793) * _uniform(token, i, seed + 1))
            * F.lit(scale),
        )
    else:
        raise ValueError(f"unknown initialiser {init!r}")
    return values.cast("array<float>")


def lookup(requests: DataFrame, table: DataFrame, dim: int, token: str = "token_id", init: str = "zeros", scale: float = 0.01, seed: int = 0) -> DataFrame:
    """Add ``embedding`` to every request row; unknown tokens get their first embedding."""
    stored = table.select(F.col("token_id").alias("_token"), F.col("embedding").alias("_stored"))
    joined = requests.join(stored, requests[token] == F.col("_token"), "left")
    first = initial_embedding(F.col(token), dim, init, scale, seed)
    return joined.select(*requests.columns, F.coalesce("_stored", first).alias("embedding"))


def combine_vectors(rows: DataFrame, keys: Sequence[str], vector: str, dim: int, average: bool = False) -> DataFrame:
    """Element-wise sum (or mean) per key.

    One aggregate per position: a vector stays one row, and sums are combined before the shuffle, so a token that
    occurs in very many rows costs one row per input partition.
    """
    agg = F.avg if average else F.sum
    cells = [agg(F.col(vector)[i].cast("double")).alias(f"_c{i}") for i in range(dim)]
    summed = rows.groupBy(*keys).agg(*cells, F.count("*").alias("contributions"))
    return summed.select(*keys, F.array(*[F.col(f"_c{i}") for i in range(dim)]).alias(vector), "contributions")


def new_table(tokens: DataFrame, dim: int, optimizer: Optimizer | None = None, init: str = "zeros", scale: float = 0.01, seed: int = 0) -> DataFrame:
    """Table rows for distinct tokens, with update count 1."""
    states = optimizer.states if optimizer else {}
    return tokens.select("token_id").distinct().select(
        "token_id",
        initial_embedding(F.col("token_id"), dim, init, scale, seed).alias("embedding"),
        F.lit(1.0).alias("update_count"),
        F.lit(0).alias("steps"),
        *[F.array_repeat(F.lit(float(v)), dim).alias(s) for s, v in states.items()],
    )


def apply_gradients(
    table: DataFrame,
    grads: DataFrame,
    optimizer: Optimizer,
    dim: int,
    init: str = "zeros",
    scale: float = 0.01,
    seed: int = 0,
) -> DataFrame:
    """Merge one combined gradient per token (``token_id, grad``) into the table.

    New tokens start from their first embedding with count 1; every token with a gradient gets one step and count + 1;
    the other rows stay untouched.
    """
    pushed = grads.select(F.col("token_id").alias("_token"), "grad")
    joined = table.join(pushed, table["token_id"] == F.col("_token"), "full_outer")
    token = F.coalesce("token_id", "_token")
    touched = F.when(F.col("grad").isNotNull(), 1).otherwise(0)
    ready = joined.select(
        token.alias("token_id"),
        F.coalesce("embedding", initial_embedding(token, dim, init, scale, seed)).alias("embedding"),
        (F.coalesce("update_count", F.lit(1.0)) + touched).alias("update_count"),
        (F.coalesce("steps", F.lit(0)) + touched).alias("steps"),
        *[F.coalesce(F.col(s), F.array_repeat(F.lit(float(v)), dim)).alias(s) for s, v in optimizer.states.items()],
        "grad",
    )
    return step_arrays(ready, optimizer).drop("grad")


def count_updates(counts: DataFrame, pushes: DataFrame) -> DataFrame:
    """(token_id, update_count) after a set of pushes: new tokens start at 1, each push adds 1."""
    added = pushes.groupBy(F.col("token_id").alias("_token")).agg(F.count("*").alias("_pushes"))
    joined = counts.select("token_id", "update_count").join(added, F.col("token_id") == F.col("_token"), "full_outer")
    return joined.select(
        F.coalesce("token_id", "_token").alias("token_id"),
        (F.coalesce("update_count", F.lit(1.0)) + F.coalesce("_pushes", F.lit(0))).alias("update_count"),
    )


def decay_table(table: DataFrame, factor: float, states: Sequence[str] = ()) -> DataFrame:
    """Scale embeddings and counts (and named optimizer accumulators) by a factor in (0, 1]."""
    if not 0 < factor <= 1:
        raise ValueError("the factor must be above 0 and at most 1")
    scaled = {
        c: F.transform(c, lambda x: x * F.lit(factor)).cast(table.schema[c].dataType) for c in ["embedding", *states]
    }
    return table.withColumns({**scaled, "update_count": F.col("update_count") * F.lit(factor)})


def prune(table: DataFrame, min_count: float) -> DataFrame:
    """Keep rows with at least ``min_count`` updates; their state goes with them."""
    return table.where(F.col("update_count") >= min_count)


def prune_report(table: DataFrame, min_count: float) -> DataFrame:
    below = F.col("update_count") < min_count
    return table.agg(F.count_if(below).alias("removed"), F.count_if(~below).alias("kept"))


def below_count(table: DataFrame, threshold: float) -> DataFrame:
    return table.where(F.col("update_count") < threshold)


def at_least_count(table: DataFrame, threshold: float) -> DataFrame:
    return table.where(F.col("update_count") >= threshold)


def most_updated(table: DataFrame, k: int) -> DataFrame:
    return table.select("token_id", "update_count").orderBy(F.desc("update_count"), "token_id").limit(k)


def count_stats(table: DataFrame, dim: int) -> DataFrame:
    """Spread of update counts and the size of the table in bytes (4 per embedding value)."""
    c = F.col("update_count")
    stats = table.agg(
        F.count("*").alias("tokens"),
        F.min(c).alias("min_count"),
        F.max(c).alias("max_count"),
        F.avg(c).alias("mean_count"),
        F.stddev_pop(c).alias("std_count"),
        (F.count("*") * dim * 4).alias("bytes"),
    )
    median = exact_percentiles(table, [], "update_count", {"m": 0.5}).select("m")
    return stats.withColumn("median_count", median.scalar())


# Samples -------------------------------------------------------------------------------------


def sample_tokens(samples: DataFrame, sample_id: str, features: Mapping[str, Column]) -> DataFrame:
    """(sample_id, feature, token_id): one row per token of every sparse feature; arrays are unfolded.

    ``features`` maps a name to a BIGINT or ARRAY<BIGINT> column. One pass over the samples.
    """
    types = samples.select(*[c.alias(n) for n, c in features.items()]).schema
    cells = []
    for name, c in features.items():
        tokens = c if types[name].dataType.typeName() == "array" else F.array(c)
        cells.append(labelled_tokens(tokens, name))
    rows = samples.select(sample_id, F.explode(F.concat(*cells)).alias("_t"))
    return rows.select(sample_id, "_t.feature", "_t.token_id")


def labelled_tokens(tokens: Column, feature: str, *extra: Column) -> Column:
    """Array of (feature, token_id, extra…) structs. A NULL token is token 0; a NULL list has no tokens."""
    filled = F.coalesce(tokens, F.array().cast("array<bigint>"))
    return F.transform(
        filled, lambda t: F.struct(F.lit(feature).alias("feature"), F.coalesce(t, F.lit(0)).cast("bigint").alias("token_id"), *extra)
    )


def unique_tokens(tokens: DataFrame, per_feature: bool = False) -> DataFrame:
    return tokens.select(*(["feature"] if per_feature else []), "token_id").distinct()


def mean_pool(tokens: DataFrame, table: DataFrame, sample_id: str, dim: int, **init) -> DataFrame:
    """Mean embedding per (sample, feature).

    Tokens are dealt by sample before they get their vectors. A table of up to ``SENT_BYTES`` is broadcast, so no vector is shuffled. With a
    larger one tokens get their vectors first and are dealt with them, unknown tokens without; neither shuffles sums, which are wider.
    The parts are small, for the means of a sample are much wider than its tokens.
    """
    # with fewer parts than other shuffles have, a later join on the sample would shuffle the means
    parts = max(int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tokens.count() // POOL_ROWS))
    if table.limit(SENT_BYTES // (4 * dim) + 1).count() <= SENT_BYTES // (4 * dim):
        found = lookup(tokens.repartition(parts, sample_id), F.broadcast(table), dim, **init)
    else:
        stored = table.select(F.col("token_id").alias("_token"), F.col("embedding").alias("_stored"))
        dealt = tokens.join(stored, tokens["token_id"] == F.col("_token"), "left").drop("_token").repartition(parts, sample_id)
        first = initial_embedding(F.col("token_id"), dim, **init)
        found = dealt.select(*tokens.columns, F.coalesce("_stored", first).alias("embedding"))
    pooled = combine_vectors(found, [sample_id, "feature"], "embedding", dim, average=True)
    return pooled.withColumnRenamed("contributions", "tokens")


def assemble(
    pooled: DataFrame, samples: DataFrame, sample_id: str, features: Sequence[str], dense: Sequence[str], dim: int, fill: float = 0.0
) -> DataFrame:
    """Add ``inputs``: pooled embeddings in feature-name order, zeros where a sample has no token, then dense columns in
    name order, ``fill`` where they are NULL or NaN. A sample has one pooled row per feature, so the grouping is small whatever the data."""
    zeros = F.array_repeat(F.lit(0.0), dim)
    slots = [F.first(F.when(F.col("feature") == f, F.col("embedding")), ignorenulls=True).alias(f"_{f}") for f in sorted(features)]
    wide = pooled.groupBy(F.col(sample_id).alias("_sample")).agg(*slots)
    joined = samples.join(wide, samples[sample_id] == F.col("_sample"), "left")
    numbers = [F.coalesce(F.nanvl(F.col(d).cast("double"), F.lit(None)), F.lit(float(fill))) for d in sorted(dense)]
    parts = [F.coalesce(F.col(f"_{f}"), zeros) for f in sorted(features)]
    if numbers:
        parts.append(F.array(*numbers))
    return joined.select(*samples.columns, F.concat(*parts).alias("inputs"))


def normalised_weights(df: DataFrame, batch: Sequence[str], weight: str, default: float = 1.0, output: str = "weight_norm") -> DataFrame:
    """Weights with NULL and NaN set to the default, scaled so that they sum to the size of the batch."""
    w = F.col(weight).cast("double")
    filled = df.withColumn("_w", F.when(w.isNull() | F.isnan(w), F.lit(float(default))).otherwise(w))
    totals = with_group_totals(filled, batch, {"_sum": F.sum("_w"), "_rows": F.count("*")})
    value = F.when(F.col("_sum") > 0, F.try_divide(F.col("_w"), F.col("_sum")) * F.col("_rows")).otherwise(F.col("_w"))
    return totals.withColumn(output, value).drop("_w", "_sum", "_rows")


def shuffled_batches(
    df: DataFrame,
    id_column: str,
    batch_size: int,
    bucket_rows: int = RANGE_ROWS,
    seed: int = 0,
    hash_with: str = "xxhash64",
) -> DataFrame:
    """Deterministic shuffle: rows fall into hash buckets, and batches are cut inside a bucket in hash order.

    Adds ``bucket`` and ``batch``. The number of buckets follows from the number of rows, and buckets are even because
    unique ids are hashed, so one bucket fits a task at any size. The last batch of each bucket may be short.
    """
    buckets = max(1, -(-df.count() // bucket_rows))
    if hash_with == "md5":
        key = F.md5(F.concat(F.col(id_column).cast("string"), F.lit(str(seed))))
        bucket = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % buckets
    else:
        key = F.xxhash64(F.col(id_column), F.lit(seed))
        bucket = F.pmod(F.xxhash64(F.col(id_column), F.lit(seed + 1)), F.lit(buckets))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("_key", id_column))
    hashed = df.withColumn("bucket", bucket.cast("int")).withColumn("_key", key)
    return hashed.withColumn("batch", F.floor((place - 1) / batch_size).cast("int")).drop("_key")
