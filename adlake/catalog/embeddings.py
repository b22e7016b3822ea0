"""Embedding tables, optimizers, samples and training."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table, view
from adlake.functions.scalar import token_id
from adlake.operators import embedding as em
from adlake.operators import optimizers as opt
from adlake.operators import training as tr
from adlake.session import intermediate_folder
from adlake.sources.bucketed import BucketedTable
from adlake.sources.versions import VersionedTable

DIM = 64


def _cells(df, column, digits=5):
    """(token_id, pos, value): arrays as rows, so that both engines can be compared cell by cell."""
    return df.select("token_id", F.posexplode(column).alias("pos", "value")).select(
        "token_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("value").cast("double"), digits).alias("value")
    )


def _requests(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", (F.col("user_id") * 7).alias("token_id"))


@query(
    "emb_lookup",
    """SELECT r.event_id, r.user_id * 7 AS token_id, CASE WHEN e.vec_id IS NULL THEN 0.0 ELSE round(CAST(e.embedding[1] AS DOUBLE), 6) END AS e0,
  CASE WHEN e.vec_id IS NULL THEN 0.0 ELSE round(CAST(e.embedding[64] AS DOUBLE), 6) END AS e63 FROM events r LEFT JOIN embeddings e ON e.vec_id = r.user_id * 7""",
)
def _(spark, sf_dir):
    out = em.lookup(_requests(spark, sf_dir), view(spark, sf_dir, "embedding_store"), DIM)
    first, last = F.col("embedding")[0].cast("double"), F.col("embedding")[DIM - 1].cast("double")
    return out.select("event_id", "token_id", F.round(first, 6).alias("e0"), F.round(last, 6).alias("e63"))


@query("emb_lookup_random")
def _(spark, sf_dir):
    """Unknown tokens get a random start that depends on the token only."""
    tokens = _requests(spark, sf_dir).select("token_id").distinct()
    return em.lookup(tokens, view(spark, sf_dir, "embedding_store"), DIM, init="normal", seed=3)


# every embedding contributes a gradient to the token of its label
_GRADS = """g AS (SELECT label AS token_id, i - 1 AS pos, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) AS r(i)),
sums AS (SELECT token_id, pos, sum(v) AS s, avg(v) AS m, count(*) AS n FROM g GROUP BY 1, 2)"""


def _grads(spark, sf_dir, average=False):
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").cast("bigint").alias("token_id"), "embedding")
    return em.combine_vectors(rows, ["token_id"], "embedding", DIM, average)


@query(
    "gradient_sum",
    f"WITH {_GRADS} SELECT CAST(token_id AS BIGINT) AS token_id, pos, round(s, 5) AS value FROM sums",
)
def _(spark, sf_dir):
    return _cells(_grads(spark, sf_dir), "embedding")


@query(
    "gradient_mean",
    f"WITH {_GRADS} SELECT CAST(token_id AS BIGINT) AS token_id, pos, round(m, 6) AS value FROM sums",
)
def _(spark, sf_dir):
    return _cells(_grads(spark, sf_dir, True), "embedding", 6)


_STORE = "p AS (SELECT vec_id AS token_id, i - 1 AS pos, CAST(embedding[i] AS DOUBLE) AS w FROM embeddings, range(1, 65) AS r(i))"


def _step(spark, sf_dir, optimizer):
    """One step of the whole store: tokens below 10 have a gradient, the rest stay."""
    store = view(spark, sf_dir, "embedding_store").withColumn("steps", F.lit(0))
    for s, first in optimizer.states.items():
        store = store.withColumn(s, F.array_repeat(F.lit(first), DIM))
    store = store.withColumn("embedding", F.col("embedding").cast("array<double>"))
    grads = _grads(spark, sf_dir).select("token_id", F.col("embedding").alias("grad"))
    return em.apply_gradients(store, grads, optimizer, DIM)


@query(
    "sgd_step",
    f"""WITH {_GRADS}, {_STORE} SELECT p.token_id, p.pos, round(CASE WHEN s IS NULL THEN w ELSE w - 0.05 * (s + 0.01 * w) END, 5) AS value
FROM p LEFT JOIN sums s ON s.token_id = p.token_id AND s.pos = p.pos""",
)
def _(spark, sf_dir):
    return _cells(_step(spark, sf_dir, opt.SGD(lr=0.05, momentum=0.9, weight_decay=0.01)), "embedding")


@query(
    "adagrad_step",
    f"""WITH {_GRADS}, {_STORE} SELECT p.token_id, p.pos, round(CASE WHEN s IS NULL THEN w ELSE w - 0.05 * s / (sqrt(0.1 + s * s) + 1e-10) END, 5) AS value
FROM p LEFT JOIN sums s ON s.token_id = p.token_id AND s.pos = p.pos""",
)
def _(spark, sf_dir):
    return _cells(_step(spark, sf_dir, opt.Adagrad(lr=0.05)), "embedding")


@query(
    "adam_step",
    f"""WITH {_GRADS}, {_STORE} SELECT p.token_id, p.pos, round(CASE WHEN s IS NULL THEN w ELSE
  w - 0.01 * s / (sqrt(s * s) + 1e-8) - 0.01 * 0.02 * w END, 5) AS value
FROM p LEFT JOIN sums s ON s.token_id = p.token_id AND s.pos = p.pos""",
)
def _(spark, sf_dir):
    return _cells(_step(spark, sf_dir, opt.Adam(lr=0.01, weight_decay=0.02)), "embedding")


# Several steps, one row per part: states, bias correction and decay only show from the second step on.
_STEPS = """x AS (SELECT l_partkey AS feature, avg(l_discount) - 0.05 AS g1, avg(l_tax) - 0.04 AS g2, avg(l_quantity) / 1000 - 0.025 AS g3
  FROM lineitem GROUP BY 1)"""


def _steps(spark, sf_dir, optimizer, n, digits=9):
    """Momentum on short decimals ends in ties at few digits, so it is compared on more."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("feature")).agg(
        (F.avg("l_discount") - 0.05).alias("g1"),
        (F.avg("l_tax") - 0.04).alias("g2"),
        (F.avg("l_quantity") / 1000 - 0.025).alias("g3"),
    )
    state = rows.withColumns({"w": F.lit(1.0), **{k: F.lit(v) for k, v in optimizer.states.items()}})
    for k in range(1, n + 1):
        state = opt.step_scalars(state.withColumn("steps", F.lit(k)), optimizer, grad=f"g{k}")
    return state.select("feature", F.round("w", digits).alias("w"))


@query(
    "sgd_momentum",
    f"""WITH {_STEPS}, c AS (SELECT feature, g2, g3, 0.8 * (g1 + 0.1) AS v1 FROM x), d AS (SELECT *, 1.0 - 0.05 * v1 AS w1 FROM c),
e AS (SELECT *, 0.9 * v1 + 0.8 * (g2 + 0.1 * w1) AS v2 FROM d), f AS (SELECT *, w1 - 0.05 * v2 AS w2 FROM e)
SELECT feature, round(w2 - 0.05 * (0.9 * v2 + 0.8 * (g3 + 0.1 * w2)), 12) AS w FROM f""",
)
def _(spark, sf_dir):
    return _steps(spark, sf_dir, opt.SGD(lr=0.05, momentum=0.9, dampening=0.2, weight_decay=0.1), 3, 12)


@query(
    "sgd_nesterov",
    f"""WITH {_STEPS}, a AS (SELECT feature, g2, g1 AS v1, 1.0 - 0.05 * (g1 + 0.9 * g1) AS w1 FROM x), b AS (SELECT *, 0.9 * v1 + g2 AS v2 FROM a)
SELECT feature, round(w1 - 0.05 * (g2 + 0.9 * v2), 12) AS w FROM b""",
)
def _(spark, sf_dir):
    return _steps(spark, sf_dir, opt.SGD(lr=0.05, momentum=0.9, nesterov=True), 2, 12)


_ADAM = f"""WITH {_STEPS}, a AS (SELECT *, 0.1 * g1 AS m1, 0.01 * g1 * g1 AS v1 FROM x),
b AS (SELECT *, 0.9 * m1 + 0.1 * g2 AS m2, 0.99 * v1 + 0.01 * g2 * g2 AS v2 FROM a),
c AS (SELECT *, 0.9 * m2 + 0.1 * g3 AS m3, 0.99 * v2 + 0.01 * g3 * g3 AS v3 FROM b),
h AS (SELECT feature, m1 / (1 - 0.9) AS p1, v1 / (1 - 0.99) AS q1, m2 / (1 - pow(0.9, 2)) AS p2, v2 / (1 - pow(0.99, 2)) AS q2,
  m3 / (1 - pow(0.9, 3)) AS p3, v3 / (1 - pow(0.99, 3)) AS q3 FROM c)"""


@query(
    "adam_three_steps",
    f"""{_ADAM}, w1 AS (SELECT *, 1.0 - 0.01 * p1 / (sqrt(q1) + 0.001) - 0.0002 AS w FROM h),
w2 AS (SELECT * REPLACE (w - 0.01 * p2 / (sqrt(q2) + 0.001) - 0.0002 * w AS w) FROM w1)
SELECT feature, round(w - 0.01 * p3 / (sqrt(q3) + 0.001) - 0.0002 * w, 9) AS w FROM w2""",
)
def _(spark, sf_dir):
    return _steps(spark, sf_dir, opt.Adam(lr=0.01, beta2=0.99, eps=0.001, weight_decay=0.02), 3)


@query(
    "adam_amsgrad",
    f"""{_ADAM} SELECT feature, round(1.0 - 0.01 * (p1 / (sqrt(q1) + 0.001) + p2 / (sqrt(greatest(q1, q2)) + 0.001)
  + p3 / (sqrt(greatest(q1, q2, q3)) + 0.001)), 9) AS w FROM h""",
)
def _(spark, sf_dir):
    return _steps(spark, sf_dir, opt.Adam(lr=0.01, beta2=0.99, eps=0.001, amsgrad=True), 3)


@query(
    "adagrad_decayed",
    f"""WITH {_STEPS}, a AS (SELECT *, g1 + 0.1 AS d1 FROM x), b AS (SELECT *, 0.1 + d1 * d1 AS n1 FROM a), c AS (SELECT *, 1.0 - 0.05 * d1 / (sqrt(n1) + 1e-10) AS w1 FROM b),
d AS (SELECT *, g2 + 0.1 * w1 AS d2 FROM c) SELECT feature, round(w1 - 0.05 * d2 / (sqrt(n1 + d2 * d2) + 1e-10), 9) AS w FROM d""",
)
def _(spark, sf_dir):
    return _steps(spark, sf_dir, opt.Adagrad(lr=0.05, weight_decay=0.1), 2)


@query(
    "ftrl_step",
    """WITH x AS (SELECT l_partkey AS feature, (avg(l_discount) - 0.05) * sqrt(0.9::DOUBLE) AS g1, (avg(l_tax) - 0.04) * sqrt(0.8::DOUBLE) AS g2 FROM lineitem GROUP BY 1),
s1 AS (SELECT feature, g1 * g1 AS n, g1 AS z, g2 FROM x),
w1 AS (SELECT feature, n, z, g2, CASE WHEN abs(z) <= 0.002 THEN 0.0 ELSE -(z - sign(z) * 0.002) / (0.1 + (1.0 + sqrt(n)) / 0.05) END AS w FROM s1),
s2 AS (SELECT feature, n + g2 * g2 AS n, z + g2 - (sqrt(n + g2 * g2) - sqrt(n)) / 0.05 * w AS z FROM w1)
SELECT feature, round(CASE WHEN abs(z) <= 0.002 THEN 0.0 ELSE -(z - sign(z) * 0.002) / (0.1 + (1.0 + sqrt(n)) / 0.05) END, 8) AS w,
  round(z, 8) AS z, round(n, 8) AS n FROM s2""",
)
def _(spark, sf_dir):
    """Two steps on scalar weights, one row per part."""
    ftrl = opt.FTRL(alpha=0.05, beta=1.0, l1=0.002, l2=0.1)
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("feature")).agg(
        ((F.avg("l_discount") - 0.05) * F.sqrt(F.lit(0.9))).alias("g1"),
        ((F.avg("l_tax") - 0.04) * F.sqrt(F.lit(0.8))).alias("g2"),
    )
    zero = F.lit(0.0)
    start = rows.withColumns({"w": zero, "z": zero, "n": zero})
    once = opt.step_scalars(start, ftrl, grad="g1")
    twice = opt.step_scalars(once, ftrl, grad="g2")
    return twice.select("feature", *[F.round(c, 8).alias(c) for c in ("w", "z", "n")])


@query(
    "ftrl_sparsity",
    """SELECT avg(CASE WHEN abs(g) <= 0.01003 THEN 1.0 ELSE 0.0 END) AS sparsity, count(*) AS weights FROM
(SELECT avg(l_discount) - 0.05 AS g FROM lineitem GROUP BY l_partkey) t""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg((F.avg("l_discount") - 0.05).alias("g"))
    start = rows.withColumns({"w": F.lit(0.0), "z": F.lit(0.0), "n": F.lit(0.0)})
    return opt.zero_share(opt.step_scalars(start, opt.FTRL(l1=0.01003)), "w")


@query(
    "update_counts",
    """WITH c AS (SELECT vec_id AS token_id, CAST(label + 1 AS DOUBLE) AS c FROM embeddings), u AS (SELECT user_id * 3 AS token_id, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(c.token_id, u.token_id) AS token_id, coalesce(c, 1.0) + coalesce(n, 0) AS update_count FROM c FULL JOIN u ON c.token_id = u.token_id""",
)
def _(spark, sf_dir):
    pushes = table(spark, sf_dir, "events").select((F.col("user_id") * 3).alias("token_id"))
    return em.count_updates(view(spark, sf_dir, "embedding_store"), pushes)


@query(
    "emb_decay",
    """SELECT vec_id AS token_id, CAST((label + 1) * 0.5 AS DOUBLE) AS update_count, round(CAST(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 0.5)) AS DOUBLE), 4) AS total
FROM embeddings""",
)
def _(spark, sf_dir):
    out = em.decay_table(view(spark, sf_dir, "embedding_store"), 0.5)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return out.select("token_id", F.round("update_count", 6).alias("update_count"), F.round(total, 4).alias("total"))


@query("emb_prune", "SELECT vec_id AS token_id, CAST(label + 1 AS DOUBLE) AS update_count FROM embeddings WHERE label + 1 >= 5")
def _(spark, sf_dir):
    return em.prune(view(spark, sf_dir, "embedding_store"), 5).select("token_id", "update_count")


@query(
    "emb_prune_report",
    "SELECT count(*) FILTER (WHERE label + 1 < 5) AS removed, count(*) FILTER (WHERE label + 1 >= 5) AS kept FROM embeddings",
)
def _(spark, sf_dir):
    return em.prune_report(view(spark, sf_dir, "embedding_store"), 5)


@query(
    "emb_top_k",
    "SELECT vec_id AS token_id, CAST(label + 1 AS DOUBLE) AS update_count FROM embeddings ORDER BY update_count DESC, vec_id LIMIT 25",
)
def _(spark, sf_dir):
    return em.most_updated(view(spark, sf_dir, "embedding_store"), 25)


@query(
    "emb_thresholds",
    """SELECT count(*) FILTER (WHERE label + 1 < 4) AS below, count(*) FILTER (WHERE label + 1 >= 4) AS at_least FROM embeddings""",
)
def _(spark, sf_dir):
    store = view(spark, sf_dir, "embedding_store")
    below = em.below_count(store, 4).agg(F.count("*").alias("n")).scalar()
    return em.at_least_count(store, 4).agg(F.count("*").alias("at_least")).select(below.alias("below"), "at_least")


@query(
    "emb_count_stats",
    """SELECT count(*) AS tokens, min(label + 1.0)::DOUBLE AS min_count, max(label + 1.0)::DOUBLE AS max_count, round(avg(label + 1), 8) AS mean_count,
  round(stddev_pop(label + 1), 8) AS std_count, count(*) * 256 AS bytes, quantile_cont(CAST(label + 1 AS DOUBLE), 0.5) AS median_count FROM embeddings""",
)
def _(spark, sf_dir):
    out = em.count_stats(view(spark, sf_dir, "embedding_store"), DIM)
    return out.withColumns({"mean_count": F.round("mean_count", 8), "std_count": F.round("std_count", 8)})


@query(
    "emb_versions_roundtrip",
    """SELECT vec_id AS token_id, CAST(label + 1 AS DOUBLE) AS update_count, round(CAST(embedding[1] AS DOUBLE), 6) AS e0 FROM embeddings WHERE label < 7""",
)
def _(spark, sf_dir):
    """Save two versions, delete the first, load the latest."""
    store = VersionedTable(spark, f"{intermediate_folder(spark)}/emb-{uuid.uuid4().hex}", shards=4)
    rows = view(spark, sf_dir, "embedding_store")
    store.save(rows, 1, {"day": "2024-01-01"})
    store.save(store.load(1).where("update_count < 8"), 2, {"day": "2024-01-02"})
    store.delete(1)
    if store.versions() != [2]:
        raise AssertionError(store.versions())
    return store.load().select("token_id", "update_count", F.round(F.col("embedding")[0].cast("double"), 6).alias("e0"))


# Samples -------------------------------------------------------------------------------------
# An order is a sample; its line items' parts and suppliers are multi-valued sparse features, one token per row.

_TOKENS = """tok AS (SELECT l_orderkey AS sample, 'part' AS feature, l_partkey AS token_id FROM lineitem
  UNION ALL SELECT l_orderkey, 'supp', l_suppkey FROM lineitem)"""


def _tokens(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sample"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
    )
    return rows.unpivot(["sample"], ["part", "supp"], "feature", "token_id")


@query(
    "sample_tokens",
    """WITH tok AS (SELECT 'word_length' AS feature, unnest(list_transform(string_split(text, ' '), lambda w: length(w))) AS token_id FROM documents
  UNION ALL SELECT 'length', n_chars FROM documents)
SELECT feature, CAST(token_id AS BIGINT) AS token_id, count(*) AS n FROM tok GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """One list-valued and one single-valued feature of whole documents."""
    lengths = F.transform(F.split("text", " "), lambda w: F.length(w).cast("bigint"))
    tokens = em.sample_tokens(
        table(spark, sf_dir, "documents"), "doc_id", {"word_length": lengths, "length": F.col("n_chars")}
    )
    return tokens.groupBy("feature", "token_id").agg(F.count("*").alias("n"))


@query(
    "unique_tokens",
    f"WITH {_TOKENS} SELECT 'all' AS feature, count(DISTINCT token_id) AS n FROM tok UNION ALL SELECT feature, count(DISTINCT token_id) FROM tok GROUP BY 1",
)
def _(spark, sf_dir):
    tokens = _tokens(spark, sf_dir)
    overall = em.unique_tokens(tokens).agg(F.lit("all").alias("feature"), F.count("*").alias("n"))
    return overall.unionByName(em.unique_tokens(tokens, True).groupBy("feature").agg(F.count("*").alias("n")))


_MEANS = ", ".join(f"round(avg(coalesce(CAST(e.embedding[{i + 1}] AS DOUBLE), 0.0)), 5) AS e{i}" for i in range(DIM))


@query(
    "mean_pooling",
    f"""WITH {_TOKENS} SELECT sample, feature, count(*) AS tokens, {_MEANS} FROM tok LEFT JOIN embeddings e ON e.vec_id = token_id GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    out = em.mean_pool(_tokens(spark, sf_dir), view(spark, sf_dir, "embedding_store"), "sample", DIM)
    return out.select("sample", "feature", "tokens", *[F.round(F.col("embedding")[i], 5).alias(f"e{i}") for i in range(DIM)])


@query(
    "assembled_inputs",
    f"""WITH {_TOKENS}, pool AS (SELECT sample, feature, avg(coalesce(CAST(e.embedding[1] AS DOUBLE), 0.0)) AS e0 FROM tok LEFT JOIN embeddings e
  ON e.vec_id = token_id GROUP BY 1, 2), q AS (SELECT l_orderkey AS sample, max(l_quantity) AS quantity FROM lineitem GROUP BY 1)
SELECT q.sample, CAST(129 AS INTEGER) AS width, round(a.e0, 5) AS part_e0, round(b.e0, 5) AS supp_e0, quantity FROM q
JOIN pool a ON a.sample = q.sample AND a.feature = 'part' JOIN pool b ON b.sample = q.sample AND b.feature = 'supp'""",
)
def _(spark, sf_dir):
    pooled = em.mean_pool(_tokens(spark, sf_dir), view(spark, sf_dir, "embedding_store"), "sample", DIM)
    samples = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sample")).agg(
        F.max("l_quantity").alias("quantity")
    )
    out = em.assemble(pooled, samples, "sample", ["supp", "part"], ["quantity"], DIM)
    x = F.col("inputs")
    return out.select(
        "sample", F.size(x).alias("width"), F.round(x[0], 5).alias("part_e0"), F.round(x[64], 5).alias("supp_e0"), x[128].alias("quantity")
    )


@query(
    "weight_norm",
    """SELECT l_orderkey, l_linenumber, round(w / sum(w) OVER (PARTITION BY l_orderkey) * count(*) OVER (PARTITION BY l_orderkey), 8) AS weight_norm
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN 1.0 ELSE l_quantity END AS w FROM lineitem) t""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("w")
    )
    out = em.normalised_weights(rows, ["l_orderkey"], "w")
    return out.select("l_orderkey", "l_linenumber", F.round("weight_norm", 8).alias("weight_norm"))


@query(
    "shuffled_batches",
    """WITH k AS (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '5') AS h FROM orders),
b AS (SELECT o_orderkey, h, CAST(CAST('0x' || substr(h, 1, 8) AS BIGINT) % (SELECT CAST(ceil(count(*) / 1000.0) AS BIGINT) FROM orders) AS INTEGER) AS bucket
  FROM k)
SELECT o_orderkey, bucket, CAST((row_number() OVER (PARTITION BY bucket ORDER BY h, o_orderkey) - 1) // 256 AS INTEGER) AS batch FROM b""",
)
def _(spark, sf_dir):
    return em.shuffled_batches(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 256, 1000, 5, "md5")


@query(
    "training_metrics",
    """WITH b AS (SELECT CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS i, value * sqrt(2::DOUBLE) AS loss, user_id % 30 + 1 AS size FROM events),
m AS (SELECT *, max(i) OVER (PARTITION BY day) AS n FROM b)
SELECT day, CAST(sum(size) AS BIGINT) AS total_samples, count(*) AS batch_count, CAST(sum(size) AS DOUBLE) AS weighted_samples,
  round(sum(loss * size) / sum(size), 6) AS avg_loss,
  round(sum(loss * CASE WHEN i = 1 THEN pow(0.99, n - 1) ELSE 0.01 * pow(0.99, n - i) END), 6) AS ema_loss,
  round(avg(loss) FILTER (WHERE n - i < 100), 6) AS recent_avg_loss FROM m GROUP BY day""",
)
def _(spark, sf_dir):
    """Events of a day stand in for its batches, numbered by running sums of 1."""
    from adlake.operators.running import running_sums

    rows = table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("day"), "event_id", (F.col("value") * F.sqrt(F.lit(2.0))).alias("loss"), (F.col("user_id") % 30 + 1).alias("size"), F.lit(1).alias("one")
    )
    numbered = running_sums(rows, ["day"], [F.asc("event_id")], {"number": "one"})
    out = tr.training_metrics(numbered, "day", "number", "loss", "size")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_loss", "ema_loss", "recent_avg_loss")})


@query(
    "weighted_losses",
    """WITH s AS (SELECT l_returnflag, l_discount * 9 + 0.05 AS p, CASE WHEN l_tax > 0.04 THEN 1.0 ELSE 0.0 END AS y, l_quantity / 25 AS w FROM lineitem),
c AS (SELECT *, least(greatest(p, 1e-7), 1 - 1e-7) AS q FROM s)
SELECT l_returnflag, round(avg(-(y * ln(q) + (1 - y) * ln(1 - q)) * w), 8) AS bce, round(avg(pow(y - p, 2) * w), 8) AS mse,
  round(avg(-ln(CASE WHEN y = 1 THEN q ELSE least(greatest(1 - p, 1e-7), 1 - 1e-7) END)), 8) AS cross_entropy FROM c GROUP BY 1""",
)
def _(spark, sf_dir):
    p, y, w = F.col("p"), F.col("y"), F.col("w")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        (F.col("l_discount") * 9 + 0.05).alias("p"),
        F.when(F.col("l_tax") > 0.04, 1.0).otherwise(0.0).alias("y"),
        (F.col("l_quantity") / 25).alias("w"),
    )
    return rows.groupBy("l_returnflag").agg(
        F.round(F.avg(tr.loss_column("binary_classification", p, y) * w), 8).alias("bce"),
        F.round(F.avg(tr.loss_column("regression", p, y) * w), 8).alias("mse"),
        F.round(F.avg(tr.loss_column("multiclass", F.array(1 - p, p), y)), 8).alias("cross_entropy"),
    )


# Training and scoring ------------------------------------------------------------------------


def _model():
    return tr.EmbeddingModel(
        sample_id="doc_id",
        sparse={"lang": token_id("lang", "string"), "source": token_id("source", "string")},
        dense=["size"],
        target="label",
        dim=4,
        learning_rate=0.5,
    )


@query("train_days")
def _(spark, sf_dir):
    """Three days of incremental training on labelled documents; one result row per day."""
    rows = view(spark, sf_dir, "training_rows").withColumn("size", F.log1p("n_chars") / 10)
    days = [(f"2024-01-0{d + 1}", rows.where(F.col("doc_id") % 3 == d)) for d in range(3)]
    store = VersionedTable(spark, f"{intermediate_folder(spark)}/train-{uuid.uuid4().hex}", shards=4)
    results = tr.train_days(days, _model(), store, decay=0.99)
    schema = "day string, samples bigint, batches bigint, weighted_samples double, loss double"
    return spark.createDataFrame(results, schema)


@query("fit_and_score")
def _(spark, sf_dir):
    """An MLlib task on labelled documents; scored validation rows."""
    rows = view(spark, sf_dir, "training_rows")
    task = tr.TrainingTask("logistic_regression", "label", ["n_chars"], ["lang", "source"], {"maxIter": 10}, 0.2, 1)
    _, scored = tr.fit_task(rows, task, "doc_id")
    return scored.select("doc_id", "label", "prediction")


@query(
    "linear_score",
    """SELECT l_orderkey, l_linenumber, round(0.5 * l_quantity - 0.001 * l_extendedprice + 3 * l_discount + 1.25, 6) AS score FROM lineitem""",
)
def _(spark, sf_dir):
    weights = {"l_quantity": 0.5, "l_extendedprice": -0.001, "l_discount": 3.0}
    out = tr.linear_score(table(spark, sf_dir, "lineitem"), weights, 1.25)
    return out.select("l_orderkey", "l_linenumber", F.round("score", 6).alias("score"))


@query(
    "sparse_score",
    f"""WITH {_TOKENS}, w AS (SELECT l_partkey AS token_id, avg(l_discount) - 0.05 AS w FROM lineitem GROUP BY 1)
SELECT sample, round(coalesce(sum(w), 0.0), 7) AS score FROM tok LEFT JOIN w USING (token_id) GROUP BY 1""",
)
def _(spark, sf_dir):
    weights = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("token_id")).agg(
        (F.avg("l_discount") - 0.05).alias("w")
    )
    out = tr.sparse_scores(_tokens(spark, sf_dir), weights, "sample")
    return out.withColumn("score", F.round("score", 7))


@query(
    "emb_lookup_bucketed",
    """SELECT r.event_id, r.user_id * 7 AS token_id, CASE WHEN e.vec_id IS NULL THEN 0.0 ELSE round(CAST(e.embedding[1] AS DOUBLE), 6) END AS e0,
  CASE WHEN e.vec_id IS NULL THEN 0.0 ELSE round(CAST(e.embedding[64] AS DOUBLE), 6) END AS e63 FROM events r LEFT JOIN embeddings e ON e.vec_id = r.user_id * 7""",
)
def _(spark, sf_dir):
    """Lookups in a store that lies in buckets of its tokens: only requests shuffle."""
    store = BucketedTable(spark, f"emb_{uuid.uuid4().hex[:12]}", ["token_id"], 16)
    out = em.lookup(_requests(spark, sf_dir), store.save(view(spark, sf_dir, "embedding_store")), DIM)
    first, last = F.col("embedding")[0].cast("double"), F.col("embedding")[DIM - 1].cast("double")
    return out.select("event_id", "token_id", F.round(first, 6).alias("e0"), F.round(last, 6).alias("e63"))
