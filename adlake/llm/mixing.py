"""Mixing sources to target sizes by entropy balancing.

Documents get rates r = exp(lambda of their source), the rates closest to one in relative entropy (words as weights) that
meet the word total of every source. The convex dual, sum over sources of S exp(lambda) - T lambda, is minimised by
Newton steps; each step is one distributed aggregation of the tilted word counts. Rates are then rounded into whole
copies.

All decisions are made on counts of documents per (source, size). Within a source, sizes in falling order form one line
of documents, and copies are dealt out evenly along it, so neighbours of nearly equal size make up for each other. What
is still missing or too much is settled on the smallest documents, whose sizes fit into the gap. Documents of one
(source, size) are interchangeable; salted ranks decide which of them get the extra copy, so a hot cell is many groups.

Defined cases: NULL text has size 0 and is never taken; a NULL source is a source of its own, the last one; repeated
rows count as documents of their own; sources without words get target 0; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import SPACE_CLASS, SPACES, WORD_CLASS, row_count_partitions
from adlake.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SALTS = 64  # least number of rank groups of a cell
ROWS_PER_SALT = 1_000_000
TOLERANCE = 1e-13
MAX_STEPS = 60


def word_count(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"{SPACE_CLASS}+"))).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size) with ``target``: ``share`` of all words by weight, none above ``cap`` times its size.

    Sources at their cap are those with the least size per weight. So with sources in that order, the level (words per
    weight) of the sources from one on follows from running sums, and the first source under its cap sets it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    named = sizes.withColumn("_w", F.array(*[F.lit(float(w)) for w in weights])[place])
    full = F.lit(float(cap)) * F.col("source_size")
    by_ratio = Window.orderBy(full / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    level = (total - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / F.sum("_w").over(after)
    leveled = named.withColumn("_level", level).withColumn("_full", full)
    under = F.when(F.col("_level") * F.col("_w") <= F.col("_full"), F.col("_level"))
    at = F.coalesce(F.max(under).over(Window.partitionBy()), F.lit(float("inf")))
    return leveled.withColumn("target", F.least(F.col("_full"), at * F.col("_w"))).drop("_w", "_level", "_full")


def newton(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, source_size, target, rate): rates exp(lambda) with lambda at the minimum of the dual.

    Gradient and curvature of a source are both its tilted word count less or without the target, as rates share one
    lambda. Steps are at most 2, which keeps the convex iteration from overshooting when it starts far away.
    """
    dual = cut_lineage(wanted.withColumn("lam", F.lit(0.0)))
    for _ in range(MAX_STEPS):
        state = dual.select(F.col("source").alias("_s"), "lam")
        tilted = cells.join(state, F.col("source").eqNullSafe(F.col("_s")))
        moment = tilted.groupBy("source").agg(F.sum(F.col("n") * F.col("size") * F.exp("lam")).alias("_m"))
        moment = moment.withColumnRenamed("source", "_s")
        step = F.least(F.greatest((F.col("target") - F.col("_m")) / F.col("_m"), F.lit(-2.0)), F.lit(2.0))
        stepped = dual.join(moment, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn(
            "_step", F.when((F.col("_m") > 0) & (F.col("target") > 0), step).otherwise(0.0)
        )
        dual = cut_lineage(
            stepped.select("source", "source_size", "target", (F.col("lam") + F.col("_step")).alias("lam"), "_step")
        )
        if dual.where(F.abs("_step") > TOLERANCE).isEmpty():
            break
    rate = F.when(F.col("target") > 0, F.least(F.lit(float(CAP)), F.round(F.exp("lam"), 9))).otherwise(0.0)
    return dual.select("source", "source_size", "target", rate.alias("rate"))


def cell_copies(cells: DataFrame, rates: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, size, n) with ``base`` copies for all its documents and ``extra`` documents that get one more."""
    of = rates.select(F.col("source").alias("_s"), "source_size", "target", "rate")
    known = cells.join(of, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    falling = Window.partitionBy("source").orderBy(F.desc("size"))
    upto = F.sum("n").over(falling.rowsBetween(Window.unboundedPreceding, 0))
    part = F.col("rate") - F.floor("rate")

    def dealt(rank: Column) -> Column:
        return F.floor(rank * part + 0.5)

    first = known.withColumn("_upto", upto).withColumn("_base", F.floor("rate"))
    first = first.withColumn("_extra", dealt(F.col("_upto")) - dealt(F.col("_upto") - F.col("n")))
    taken = F.sum(F.col("size") * (F.col("n") * F.col("_base") + F.col("_extra"))).over(Window.partitionBy("source"))
    gap = F.round(F.col("target") - taken).cast("long")
    # Copies that documents of the cell can still take or give, one for each document.
    room = F.when(F.col("_gap") > 0, F.col("n") * (cap - F.col("_base")) - F.col("_extra")).otherwise(
        F.col("n") * F.col("_base") + F.col("_extra")
    )
    rising = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    settled = first.withColumn("_gap", gap).withColumn("_room", F.when(F.col("size") > 0, room).otherwise(0))
    settled = settled.withColumn("_before", F.coalesce(F.sum(F.col("size") * F.col("_room")).over(rising), F.lit(0)))
    left = F.greatest(F.abs("_gap") - F.col("_before"), F.lit(0))
    fits = F.when(F.col("size") > 0, F.least(F.col("_room"), F.floor(left / F.col("size")))).otherwise(0)
    total = F.col("n") * F.col("_base") + F.col("_extra") + F.signum("_gap").cast("long") * fits
    done = settled.withColumn("_total", total.cast("long"))
    base = F.floor(F.col("_total") / F.col("n"))
    return done.select(
        "source", "size", "source_size", "target", base.alias("base"), (F.col("_total") - base * F.col("n")).alias("extra")
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    sized = cut_lineage(docs.select(F.col(key).alias("doc_id"), "source", word_count(F.col(text)).alias("size")))
    cells = cut_lineage(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    wanted = targets(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, cap)
    copies = cell_copies(cells, newton(cells, wanted), cap)
    salts = row_count_partitions(sized.count(), ROWS_PER_SALT, SALTS)
    return deal(sized, copies, salts)


def deal(sized: DataFrame, copies: DataFrame, salts: int) -> DataFrame:
    """Rank the documents of a cell by (salt, doc_id); the first ``extra`` of them get one copy more."""
    salted = sized.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    cell = ["source", "size", "_salt"]
    counts = salted.groupBy(*cell).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source", "size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    plan = starts.join(
        copies.withColumnsRenamed({"source": "_s", "size": "_z"}),
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")),
    ).select(*[F.col(c).alias(f"_{c}") for c in ("source", "size")], F.col("_salt").alias("_p"), "_start",
             "source_size", "target", "base", "extra")
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy(*cell).orderBy("doc_id")) - 1)
    met = (F.col("source").eqNullSafe(F.col("_source"))) & (F.col("size") == F.col("_size")) & (F.col("_salt") == F.col("_p"))
    number = F.col("base") + (F.col("_start") + F.col("_rank") < F.col("extra")).cast("long")
    return ranked.join(plan, met).select(
        "doc_id", "size", "source_size", "target", number.alias("copies"), (number * F.col("size")).alias("taken")
    )


def keep(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with as many rows of each document as the mix takes copies.

    Rows that repeat an id all take the larger number of copies among them.
    """
    taken = mix(docs, text, key).groupBy("doc_id").agg(F.max("copies").alias("_copies")).where("_copies > 0")
    joined = docs.join(taken.withColumnRenamed("doc_id", "_id"), docs[key].eqNullSafe(F.col("_id")))
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return joined.select(*docs.columns, copies.alias("_copy")).select(*docs.columns)
