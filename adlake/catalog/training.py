"""Training steps with several outputs, mini-batches, and tables kept as logs of changes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table, view
from adlake.operators import minibatch as mb
from adlake.operators import training as tr
from adlake.operators.optimizers import SGD
from adlake.session import cut_lineage, intermediate_folder
from adlake.sources.versions import LogTable

# One step on orders: customers and priorities as tokens, price and day as dense inputs, fixed embeddings and layer.
_DIM, _LR = 2, 0.5
_CUSTOMER, _PRIORITY = "o_custkey", "10000000 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT)"
_DENSE = ["day(o_orderdate) / 31e0", "o_totalprice / 500000e0"]
_CLASS = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"
_LABELS = ["CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END", "CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END", "CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END"]


def _layer(outputs: int) -> list[list[float]]:
    return [[((o * 5 + i * 3) % 7 - 3) / 10 for i in range(2 * _DIM + 3)] for o in range(outputs)]


def _first(token: str, i: int) -> str:
    return f"CAST(CAST((({token} * 7 + {i * 3}) % 11 - 5) / 10e0 AS FLOAT) AS DOUBLE)"


def _step_sql(multiclass: bool) -> str:
    """Samples with inputs x0…x5, errors e0…e2 of the outputs, and n samples."""
    xs = [_first("p", i) for i in range(_DIM)] + [_first("q", i) for i in range(_DIM)] + _DENSE
    logits = [" + ".join([f"{w} * x{i}" for i, w in enumerate(row[:-1])] + [str(row[-1])]) for row in _layer(3)]
    if multiclass:
        errors = [f"exp(z{o}) / (exp(z0) + exp(z1) + exp(z2)) - CASE WHEN y0 = {o} THEN 1 ELSE 0 END" for o in range(3)]
        labels = f"{_CLASS} AS y0"
    else:
        errors = [f"(1 / (1 + exp(-z{o})) - y{o}) / 3" for o in range(3)]
        labels = ", ".join(f"{label} AS y{o}" for o, label in enumerate(_LABELS))
    return f"""s AS (SELECT *, {_CUSTOMER} AS p, {_PRIORITY} AS q, {labels} FROM orders),
x AS (SELECT *, {", ".join(f"{x} AS x{i}" for i, x in enumerate(xs))} FROM s),
z AS (SELECT *, {", ".join(f"{z} AS z{o}" for o, z in enumerate(logits))} FROM x),
e AS (SELECT *, {", ".join(f"{e} AS e{o}" for o, e in enumerate(errors))}, 1 AS x6, count(*) OVER () AS n FROM z)"""


def _tokens_sql(multiclass: bool) -> str:
    sums = ", ".join(f"sum(e{o} / n) AS s{o}" for o in range(3))
    grads = [
        "CASE f " + " ".join(f"WHEN {f} THEN {' + '.join(f's{o} * {_layer(3)[o][f * _DIM + i]}' for o in range(3))}" for f in range(2)) + " END" for i in range(_DIM)
    ]
    cells = ", ".join(f"round(CAST(CAST({_first('token_id', i)} - {_LR} * ({g}) AS FLOAT) AS DOUBLE), 5) AS v{i}" for i, g in enumerate(grads))
    return f"""WITH {_step_sql(multiclass)}, t AS (SELECT p AS token_id, 0 AS f, {sums} FROM e GROUP BY 1 UNION ALL SELECT q, 1, {sums} FROM e GROUP BY 1)
SELECT token_id, {cells}, CAST(2.0 AS DOUBLE) AS update_count FROM t"""


def _layer_sql(multiclass: bool) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {o} AS output, {i} AS input, round({w} - {_LR} * avg(e{o} * x{i}), 8) AS weight FROM e" for o, row in enumerate(_layer(3)) for i, w in enumerate(row)
    )
    return f"WITH {_step_sql(multiclass)} SELECT CAST(output AS INTEGER) AS output, CAST(input AS INTEGER) AS input, weight FROM ({rows}) AS r"


def _step(spark, sf_dir, multiclass: bool) -> tr.StepResult:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(_CUSTOMER).alias("p"), F.expr(_PRIORITY).alias("q"), *[F.expr(d).alias(f"d{i}") for i, d in enumerate(_DENSE)],
        F.expr(_CLASS).alias("status"), *[F.expr(label).alias(f"y{o}") for o, label in enumerate(_LABELS)],
    )
    task = {"task": "multiclass", "target": "status", "num_classes": 3} if multiclass else {"task": "multi_label", "targets": ["y0", "y1", "y2"]}
    model = tr.EmbeddingModel(
        "o_orderkey", {"customer": F.col("p"), "priority": F.col("q")}, ["d0", "d1"], dim=_DIM, learning_rate=_LR, optimizer=SGD(lr=_LR), **task
    )
    tokens = rows.select(F.explode(F.array("p", "q")).alias("token_id")).distinct()
    store = cut_lineage(
        tokens.select(
            "token_id", F.array(*[F.expr(_first("token_id", i)).cast("float") for i in range(_DIM)]).alias("embedding"), F.lit(1.0).alias("update_count"), F.lit(0).alias("steps")
        )
    )
    return tr.train_step(rows, store, model, _layer(3))


def _after(spark, sf_dir, multiclass):
    result = _step(spark, sf_dir, multiclass)
    out = cut_lineage(result.table)
    result.release()
    return out.select("token_id", *[F.round(F.col("embedding")[i].cast("double"), 5).alias(f"v{i}") for i in range(_DIM)], "update_count")


def _layer_after(spark, sf_dir, multiclass):
    result = _step(spark, sf_dir, multiclass)
    result.release()
    rows = [(o, i, float(w)) for o, row in enumerate(result.weights) for i, w in enumerate(row)]
    return spark.createDataFrame(rows, "output int, input int, weight double").withColumn("weight", F.round("weight", 8))


@query("multiclass_step_tokens", _tokens_sql(True))
def _(spark, sf_dir):
    """Embeddings after one step with a softmax over three classes."""
    return _after(spark, sf_dir, True)


@query("multiclass_step_layer", _layer_sql(True))
def _(spark, sf_dir):
    """The layer after the same step."""
    return _layer_after(spark, sf_dir, True)


@query("multilabel_step_tokens", _tokens_sql(False))
def _(spark, sf_dir):
    """Embeddings after one step with three labels."""
    return _after(spark, sf_dir, False)


@query("multilabel_step_layer", _layer_sql(False))
def _(spark, sf_dir):
    """The layer after the same step."""
    return _layer_after(spark, sf_dir, False)


@query("train_minibatch")
def _(spark, sf_dir):
    """Two days of training on labelled documents in mini-batches, with weights; one row per step."""
    rows = view(spark, sf_dir, "training_rows").withColumn("size", F.log1p("n_chars") / 10)
    rows = rows.withColumns({"lang": F.xxhash64("lang"), "source": F.xxhash64("source"), "w": F.lit(0.5) + F.col("label")})
    model = tr.EmbeddingModel("doc_id", {"lang": F.col("lang"), "source": F.col("source")}, ["size"], "label", dim=4, weight="w")
    size = max(64, rows.count() // 8)
    days = [(f"2024-01-0{d + 1}", rows.where(F.col("doc_id") % 2 == d)) for d in range(2)]
    store = LogTable(spark, f"{intermediate_folder(spark)}/batches-{uuid.uuid4().hex}", shards=4)
    results = mb.train_batches(days, model, store, size, decay=0.99)
    return spark.createDataFrame(results, "day string, batch int, samples bigint, weighted_samples double, loss double")


@query(
    "log_table_roundtrip",
    """SELECT vec_id AS token_id,
  round(0.5e0 * CASE WHEN label % 3 = 1 THEN label + 101 WHEN label % 3 = 2 AND vec_id % 2 = 0 THEN label + 201 ELSE label + 1 END, 6) AS update_count,
  round(CAST(CAST(CAST(embedding[1] AS DOUBLE) * 0.5 AS FLOAT) AS DOUBLE), 6) AS e0
FROM embeddings WHERE NOT (label % 3 = 0 AND vec_id % 2 = 1)""",
)
def _(spark, sf_dir):
    """A base, changes of some tokens, decay with further changes, removals, and a compaction; then the newest version of every token."""
    store = LogTable(spark, f"{intermediate_folder(spark)}/log-{uuid.uuid4().hex}", shards=4)
    rows = view(spark, sf_dir, "embedding_store")
    label, even = F.col("update_count") - 1, F.col("token_id") % 2 == 0
    store.append(rows, 1, {"day": "2024-01-01"})
    store.append(rows.where(label % 3 == 1).withColumn("update_count", F.col("update_count") + 100), 2)
    store.append(rows.where((label % 3 == 2) & even).withColumn("update_count", F.col("update_count") + 200), 3, factor=0.5)
    store.append(rows.where("false"), 4, removed=rows.where((label % 3 == 0) & ~even).select("token_id"))
    store.compact()
    store.vacuum()
    if store.versions() != [5]:
        raise AssertionError(store.versions())
    return store.load().select("token_id", F.round("update_count", 6).alias("update_count"), F.round(F.col("embedding")[0].cast("double"), 6).alias("e0"))


@query(
    "stored_model_scores",
    """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS w, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity, round(b + w * l_quantity, 3) AS prediction FROM lineitem, m""",
)
def _(spark, sf_dir):
    """A fitted task is stored, loaded again and scores all rows."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    model, _ = tr.fit_task(rows, tr.TrainingTask("linear_regression", "l_extendedprice", ["l_quantity"], validation_split=0.0), "l_orderkey")
    path = f"{intermediate_folder(spark)}/model-{uuid.uuid4().hex}"
    tr.store_model(model, path)
    scored = tr.stored_scores(rows.drop("l_extendedprice"), path)
    return scored.withColumn("prediction", F.round("prediction", 3))
