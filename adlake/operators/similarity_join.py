"""Similarity joins with a bound: only pairs that can reach it leave a task.

Profiles meet block against block. Sets use an index: tokens stand in one global order by the number of entities that have them, and of each
set only as many of its rarest tokens enter the index as any partner above the bound must share one of. Small sets travel with their index rows
and are compared where they meet. Rows are copied for tokens that very many entities index, and not otherwise. Positions in large sets are
running sums over ranges, so an entity with very many tokens is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators import entity_similarity as es
from adlake.operators.running import attach, running_sums
from adlake.session import cut_lineage, drop_table

HEAVY = 4096  # entities of an index token that one task joins with the others of the token
SLACK = 1e-9  # of bounds, for rounding
CARRIED = 64  # tokens of a set that travels with its index rows


def _rows(profile: DataFrame, entity: str, token: str, *more: Column) -> DataFrame:
    """(entity, token, …) of rows with a token, with ``df``, the number of entities that have the token."""
    rows = profile.where(F.col(token).isNotNull() & F.col(entity).isNotNull())
    rows = cut_lineage(rows.select(F.col(entity).alias("entity"), F.col(token).alias("token"), *more))
    return attach(rows, rows.groupBy("token").agg(F.count("*").alias("df")), ["token"])


def joined_on_token(left: DataFrame, right: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """Rows of ``left`` (columns with the suffix _x) and ``right`` (_y) with the same token and different entities.

    A token with more than ``heavy`` rows on the left is split: its left rows fall into parts, and its right rows go to each of these.
    """
    counts = left.groupBy("token").agg(F.count("*").alias("_n")).where(F.col("_n") > heavy)
    parts = cut_lineage(counts.select(F.col("token").alias("_heavy"), F.ceil(F.col("_n") / heavy).cast("int").alias("_parts")))

    def dealt(rows: DataFrame, salt: Column, suffix: str) -> DataFrame:
        known = rows.join(parts, F.col("token") == F.col("_heavy"), "left").drop("_heavy")
        names = [F.col(c).alias(f"{c}_{suffix}") for c in rows.columns if c != "token"]
        return known.withColumn("_parts", F.coalesce("_parts", F.lit(1))).select("token", *names, salt.alias("_salt"))

    x = dealt(left, F.pmod(F.xxhash64("entity"), F.col("_parts")).cast("int"), "x")
    y = dealt(right, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)), "y")
    return x.join(y, ["token", "_salt"]).where(F.col("entity_x") != F.col("entity_y")).drop("_salt")


# --- cosine


def weighted_index(profile: DataFrame, entity: str, token: str, score: str) -> DataFrame:
    """(entity, token, score, norm, w, before, upto, after) of every row, written.

    ``w`` is the share of the row in the unit vector; ``before``, ``upto`` and ``after`` are the norms of what stands before the token
    in the order of falling frequency, of that with the token, and of what comes after it.
    """
    rows = _rows(profile, entity, token, F.col(score).cast("double").alias("score")).where("score != 0")
    norms = rows.groupBy("entity").agg(F.sqrt(F.sum(F.col("score") * F.col("score"))).alias("norm"))
    unit = attach(rows, norms, ["entity"]).withColumn("w", F.col("score") / F.col("norm"))
    squared = running_sums(unit.withColumn("_sq", F.col("w") * F.col("w")), ["entity"], [F.desc("df"), F.asc("token")], {"_cum": "_sq"})

    def root(square: Column) -> Column:
        return F.sqrt(F.greatest(square, F.lit(0.0)))

    return cut_lineage(
        squared.select(
            "entity", "token", "score", "norm", "w", root(F.col("_cum") - F.col("_sq")).alias("before"), root(F.col("_cum")).alias("upto"),
            root(F.lit(1.0) - F.col("_cum")).alias("after"),
        )
    )


def cosine_at_least(
    profile: DataFrame, entity: str, token: str = "token", score: str = "score", threshold: float = 0.5, heavy: int = HEAVY
) -> DataFrame:
    """(a, b, cosine) with a < b: all pairs with a cosine of ``threshold`` or more, which must be above 0.

    ``profile`` has one row per (entity, token). Rows with a NULL entity or token are left out, as are entities of norm 0. Profiles meet block
    against block, and pairs below the threshold do not leave the task. ``heavy`` is the most entities of a block.
    """
    if not threshold > 0:
        raise ValueError("the threshold must be above 0")
    pairs = _products(profile, entity, token, score, heavy, least=float(threshold))
    return pairs.where((F.col("a") < F.col("b")) & (F.col("cosine") >= F.lit(float(threshold))))


def nearest_k(
    profile: DataFrame, entity: str, k: int, token: str = "token", score: str = "score", start: float = 0.5, heavy: int = HEAVY
) -> DataFrame:
    """(a, b, cosine, rank): the ``k`` most similar entities of every entity with a positive cosine; equals by the smaller id.

    Of every two blocks of profiles only pairs that are among the ``k`` best of one of the two there leave the task. The result is exact and does
    not depend on ``start``, a threshold of an earlier form. ``heavy`` is the most entities of a block.
    """
    pairs = _products(profile, entity, token, score, heavy, best=k).where("a < b")
    return _ranked(es.mirrored(pairs, "cosine"), k)


def _products(profile: DataFrame, entity: str, token: str, score: str, heavy: int, **bounds) -> DataFrame:
    """(a, b, cosine) of rows with a token and a score, as far as the bounds leave them."""
    rows = profile.where(F.col(token).isNotNull() & F.col(entity).isNotNull())
    rows = cut_lineage(rows.select(F.col(entity).alias("entity"), F.col(token).alias("token"), F.col(score).cast("double").alias("value")).where("value != 0"))
    size = min(heavy, es.ENTITIES_PER_BLOCK)
    products = es.weighted_products(rows, "entity", "token", "value", es.norm(), entities_per_block=size, **bounds)
    drop_table(rows)
    return products.select("a", "b", (F.col("product") / (F.col("weight_a") * F.col("weight_b"))).alias("cosine"))


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each ``a``; Spark cuts to k rows before the shuffle as well."""
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    return pairs.where("cosine > 0").withColumn("rank", place).where(F.col("rank") <= k)


# --- sets


def _jaccard() -> Column:
    return F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared"))


def _sized(sets: DataFrame, entity: str, token: str) -> DataFrame:
    """(entity, token, df, size) of distinct rows, written."""
    rows = _rows(sets.select(entity, token).distinct(), entity, token)
    return cut_lineage(attach(rows, rows.groupBy("entity").agg(F.count("*").alias("size")), ["entity"]))


def placed_sets(sized: DataFrame) -> DataFrame:
    """(entity, token, size, place) of sized rows, written; places count from 1, rare tokens first."""
    placed = running_sums(sized.withColumn("_one", F.lit(1)), ["entity"], [F.asc("df"), F.asc("token")], {"place": "_one"})
    return cut_lineage(placed.select("entity", "token", "size", "place"))


def shared_counts(pairs: DataFrame, sized: DataFrame) -> DataFrame:
    """(a, b, size_a, size_b, shared) of given pairs that share a token, block against block."""
    rows = cut_lineage(sized.select("entity", "token", F.lit(1.0).alias("_one")))
    pairs = cut_lineage(pairs)
    shared = es.products_of(pairs, rows, "entity", "token", "_one")
    drop_table(rows)
    drop_table(pairs)
    sizes = cut_lineage(sized.select("entity", "size").distinct())
    of_a, of_b = (sizes.select(F.col("entity").alias(c), F.col("size").alias(f"size_{c}")) for c in "ab")
    return shared.join(of_a, "a").join(of_b, "b").select("a", "b", "size_a", "size_b", F.round("product").cast("long").alias("shared"))


def _counted(met: DataFrame) -> DataFrame:
    """(a, b, size_a, size_b, shared) of met rows that carry both sets."""
    ordered = F.col("entity_x") < F.col("entity_y")
    sizes = [F.when(ordered, F.col(f"size_{p}")).otherwise(F.col(f"size_{q}")).alias(n) for n, p, q in (("size_a", "x", "y"), ("size_b", "y", "x"))]
    shared = F.size(F.array_intersect("tokens_x", "tokens_y")).cast("long").alias("shared")
    return met.select(F.least("entity_x", "entity_y").alias("a"), F.greatest("entity_x", "entity_y").alias("b"), *sizes, shared)


def _near_sets(sets: DataFrame, entity: str, token: str, asks: Column, holds: Column, meets: Column, enough: Column, heavy: int) -> DataFrame:
    """(a, b, size_a, size_b, shared) of pairs that meet on an index token, pass ``meets`` and then share ``enough``.

    Sets of up to ``CARRIED`` tokens travel with their index rows and are compared where they meet, so only pairs of the result leave a
    task. Pairs with a larger set are formed first and counted block against block.
    """
    sized = _sized(sets, entity, token)
    ordered = F.sort_array(F.collect_list(F.struct("df", "token")))
    carried = cut_lineage(sized.where(F.col("size") <= CARRIED).groupBy("entity").agg(ordered.alias("_t")).select("entity", F.col("_t.token").alias("tokens")))
    entries = carried.select("entity", F.size("tokens").alias("size"), "tokens", F.posexplode("tokens").alias("_pos", "token"))
    entries = entries.withColumn("place", F.col("_pos") + 1).drop("_pos")
    found = _counted(joined_on_token(entries.where(asks), entries.where(holds), heavy).where(meets)).where(enough).distinct()
    if sized.where(F.col("size") > CARRIED).isEmpty():
        return found
    placed = placed_sets(sized)
    met = joined_on_token(placed.where(asks), placed.where(holds), heavy).where(meets & (F.greatest("size_x", "size_y") > CARRIED))
    pairs = met.select(F.least("entity_x", "entity_y").alias("a"), F.greatest("entity_x", "entity_y").alias("b")).distinct()
    return found.unionByName(shared_counts(pairs, sized).where(enough))


def overlap_at_least(sets: DataFrame, entity: str, token: str, threshold: float, heavy: int = HEAVY) -> DataFrame:
    """(a, b, overlap) with a < b: all pairs whose overlap coefficient |A ∩ B| / min(|A|, |B|) is ``threshold`` or more.

    The coefficient bounds no ratio of sizes, so the index is one-sided: a set of n tokens looks up the rarest n - ceil(t n) + 1 of its own among
    all tokens of sets of its size or larger. One of these must be shared, or fewer than t n tokens are.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")

    def need(size: str) -> Column:
        return F.ceil(F.col(size) * F.lit(float(threshold)) - F.lit(SLACK))

    asks = F.col("place") <= F.col("size") - need("size") + 1
    smaller = (F.col("size_x") < F.col("size_y")) | ((F.col("size_x") == F.col("size_y")) & (F.col("entity_x") < F.col("entity_y")))
    most = F.least("place_x", "place_y") + F.least(F.col("size_x") - F.col("place_x"), F.col("size_y") - F.col("place_y"))
    value = F.col("shared") / F.least("size_a", "size_b")
    enough = value >= F.lit(float(threshold) - SLACK)
    found = _near_sets(sets, entity, token, asks, F.lit(True), smaller & (most >= need("size_x")), enough, heavy)
    return found.select("a", "b", value.alias("overlap"))


def jaccard_at_least(sets: DataFrame, entity: str, token: str, threshold: float, heavy: int = HEAVY) -> DataFrame:
    """(a, b, jaccard) with a < b: all pairs with a Jaccard similarity of ``threshold`` or more, by prefixes on both sides."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    t = F.lit(float(threshold))
    prefix = F.col("place") <= F.col("size") - F.ceil(F.col("size") * t - F.lit(SLACK)) + 1
    sizes = F.least("size_x", "size_y") + F.lit(SLACK) >= t * F.greatest("size_x", "size_y")
    most = F.least("place_x", "place_y") + F.least(F.col("size_x") - F.col("place_x"), F.col("size_y") - F.col("place_y"))
    reach = most * (1 + t) + F.lit(SLACK) >= t * (F.col("size_x") + F.col("size_y"))
    meets = (F.col("entity_x") < F.col("entity_y")) & sizes & reach
    found = _near_sets(sets, entity, token, prefix, prefix, meets, _jaccard() >= F.lit(float(threshold) - SLACK), heavy)
    return found.select("a", "b", _jaccard().alias("jaccard"))


# --- approximate


def banded_minhash(
    sets: DataFrame, entity: str, token: str, threshold: float, bands: int = 16, rows: int = 3, seed: int = 7, hash_with: str = "xxhash64", heavy: int = HEAVY
) -> DataFrame:
    """(a, b, jaccard) with a < b: pairs with a Jaccard similarity of ``threshold`` or more that agree in all minima of some band.

    A pair of similarity s is found with a probability of 1 - (1 - s^rows)^bands. Sets of up to ``CARRIED`` tokens are hashed and compared as
    arrays, so neither minima nor candidates are shuffled for them; minima of larger sets are combined before the shuffle. A bucket is named by 64
    bits of its minima. Buckets with very many entities are split like heavy tokens.
    """
    data = sets.where(F.col(token).isNotNull() & F.col(entity).isNotNull()).select(F.col(entity).alias("entity"), F.col(token).alias("token")).distinct()
    data = cut_lineage(data)
    sized = cut_lineage(attach(data, data.groupBy("entity").agg(F.count("*").alias("size")), ["entity"]))
    small, large = sized.where(F.col("size") <= CARRIED), sized.where(F.col("size") > CARRIED)

    def hashed(token: Column, i: int) -> Column:
        if hash_with == "md5":
            return F.md5(F.concat(token.cast("string"), F.lit(f"-{seed + i}")))
        return F.xxhash64(token, F.lit(seed + i))

    def keyed(minima: DataFrame) -> DataFrame:
        keys = [F.xxhash64(F.lit(b), *[F.col(f"h{b * rows + r}") for r in range(rows)]) for b in range(bands)]
        return minima.select("entity", F.explode(F.array(*keys)).alias("token"))

    def minimum(i: int) -> Column:
        return F.array_min(F.transform("tokens", lambda t: hashed(t, i))).alias(f"h{i}")

    carried = cut_lineage(small.groupBy("entity").agg(F.first("size").alias("size"), F.collect_list("token").alias("tokens")))
    of_small = carried.select("entity", *[minimum(i) for i in range(bands * rows)])
    of_large = large.groupBy("entity").agg(*[F.min(hashed(F.col("token"), i)).alias(f"h{i}") for i in range(bands * rows)])
    entries = cut_lineage(keyed(of_small).unionByName(keyed(of_large)))
    shared = entries.groupBy("token").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("token").alias("_token"))
    entries = cut_lineage(entries.join(shared, F.col("token") == F.col("_token"), "left_semi"))
    enough = _jaccard() >= F.lit(float(threshold) - SLACK)
    with_sets = entries.join(carried, "entity")
    sizes = F.least("size_x", "size_y") + F.lit(SLACK) >= F.lit(float(threshold)) * F.greatest("size_x", "size_y")
    found = _counted(joined_on_token(with_sets, with_sets, heavy).where((F.col("entity_x") < F.col("entity_y")) & sizes)).where(enough).distinct()
    if not large.isEmpty():
        sized_entries = entries.join(sized.select("entity", "size").distinct(), "entity")
        met = joined_on_token(sized_entries, sized_entries, heavy).where((F.col("entity_x") < F.col("entity_y")) & (F.greatest("size_x", "size_y") > CARRIED))
        pairs = met.select(F.col("entity_x").alias("a"), F.col("entity_y").alias("b")).distinct()
        found = found.unionByName(shared_counts(pairs, sized).where(enough))
    return found.select("a", "b", _jaccard().alias("jaccard"))
