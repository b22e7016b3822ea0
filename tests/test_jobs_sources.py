import datetime as dt
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.catalog.aggregates import METRICS, flagship, rounded
from adlake.catalog.registry import view
from adlake.operators.aggregate import Aggregation, bucket_aggregate
from adlake.plans import jobs
from adlake.session import cut_lineage, drop_intermediate, intermediate_folder, shared_folder
from adlake.sources import ranges, tables
from adlake.sources.ranges import TimeRange
from adlake.sources.tables import ColumnSpec, Source
from adlake.streaming.hourly import stream_aggregate

SF = "/root/testdata/sf0.001"


def test_range_bounds(spark):
    r = TimeRange("2024-01-05", "2024-01-07")
    assert r.lower(3) == dt.datetime(2024, 1, 4, 21) and r.upper() == dt.datetime(2024, 1, 8)
    assert r.days(3) == ["2024-01-04", "2024-01-05", "2024-01-06", "2024-01-07"]
    assert TimeRange("2024-01-05", "2024-01-07 00:00:00").days() == ["2024-01-05", "2024-01-06"]
    assert len(TimeRange("2025-01-01", "2025-01-05").days()) == 5
    assert ranges.lookback_hours([3600, 5000]) == 2 and ranges.lookback_hours([]) == 0
    assert TimeRange().predicate("x") is None


def test_time_filter_reaches_the_scan(spark):
    source = Source(path=f"{SF}/events.parquet", time_column="ts")
    df = tables.read_source(spark, source, TimeRange("2024-01-05", "2024-01-06"), columns=["ts"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_partition_pruning_from_the_range(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(10).select(F.col("id"), F.expr("date_add(date'2024-01-01', int(id))").cast("timestamp_ntz").alias("ts"))
    tables.write_table(days.withColumn("dt", F.date_format("ts", "yyyy-MM-dd")), path, partition_by=["dt"])
    source = Source(path=path, partition_cols=("dt",), time_column="ts")
    df = tables.read_source(spark, source, TimeRange("2024-01-03", "2024-01-04"), lookback_hours=1)
    assert sorted(r["id"] for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    two = tables.read_days(spark, path, [f"{path}/dt=2024-01-03", f"{path}/dt=2024-01-09"], {"id": "n"})
    assert {(r["n"], str(r["dt"])) for r in two.collect()} == {(2, "2024-01-03"), (8, "2024-01-09")}


def test_catalog_table_partitions(spark):
    name = f"t_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    spark.range(4).withColumn("dt", F.lit("2024-01-01")).write.partitionBy("dt").option("path", path).saveAsTable(name)
    try:
        assert tables.partition_columns(spark, name) == ["dt"]
        got = tables.read_source(spark, Source(path=name, format="table"), TimeRange("2024-01-02", "2024-01-03"))
        assert got.count() == 0
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_csv_with_declared_and_inferred_types(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    tables.write_table(spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string"), path, "csv")
    inferred = tables.read_source(spark, Source(path=path, format="csv"))
    assert dict(inferred.dtypes) == {"a": "int", "b": "double", "c": "string"}
    declared = Source(path=path, format="csv", columns={"a": ColumnSpec("long"), "b": ColumnSpec("string", provides=("f",)), "c": ColumnSpec("string")})
    assert dict(tables.read_source(spark, declared).dtypes)["a"] == "bigint" and declared.features() == {"f": ["b"]}
    for bad in (("xml", "append"), ("csv", "merge")):
        with pytest.raises(ValueError):
            tables.write_table(inferred, path, *bad)
    with pytest.raises(ValueError):
        tables.read_source(spark, Source(path=path, format="xml"))


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.range(3)
    tables.write_table(df, path)
    tables.write_table(df, path, mode="append")
    tables.write_table(df, path, mode="ignore")
    assert spark.read.parquet(path).count() == 6


def test_delta_needs_its_jar(spark, tmp_path):
    with pytest.raises(Exception, match="delta"):
        tables.read_source(spark, Source(path=str(tmp_path), format="delta")).count()


def test_merge_schema_newest_file_path_date_markers(spark, tmp_path):
    a, b = tmp_path / "dt=2024-01-01", tmp_path / "dt=2024-01-02"
    spark.range(2).coalesce(1).write.parquet(str(a))
    spark.range(3).withColumn("x", F.lit("v")).coalesce(1).write.parquet(str(b))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.StringType())])
    both = tables.read_declared(spark, str(tmp_path), schema, "declared_view")
    assert spark.table("declared_view").count() == 5 and both.where("x is null").count() == 2
    dated = tables.with_path_date(spark.read.parquet(str(a), str(b)))
    assert {str(r["date"]) for r in dated.collect()} == {"2024-01-01", "2024-01-02"}
    inventory = tables.file_inventory(spark.read.parquet(str(a), str(b)))
    assert inventory.count() == 2 and inventory.agg(F.sum("rows")).first()[0] == 5
    marked = tables.days_marked(spark, str(tmp_path))
    assert {r["day"] for r in marked.collect()} == {"2024-01-01", "2024-01-02"}
    tables.require_days(marked, "day", "2024-01-01", "2024-01-03")
    with pytest.raises(FileNotFoundError, match="2024-01-03"):
        tables.require_days(marked, "day", "2024-01-01", "2024-01-04")
    for i, name in enumerate(("caps_1.csv", "caps_2.csv")):
        (tmp_path / name).write_text("a\n")
        os.utime(tmp_path / name, (time.time() - 100 * i,) * 2)
    assert tables.newest_file(spark, f"{tmp_path}/caps_*.csv").endswith("caps_1.csv")


def test_cut_lineage_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None, [1.0], dt.datetime(2024, 1, 1))], "a int, b string, c array<double>, d timestamp_ntz")
    assert cut_lineage(df).collect() == df.collect() and cut_lineage(df).dtypes == df.dtypes


def test_shared_folder_follows_the_setting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("adlake.session.configured_folder", lambda _: str(tmp_path))
    assert shared_folder(spark) == str(tmp_path)
    assert cut_lineage(spark.range(3)).count() == 3
    assert os.path.isdir(intermediate_folder(spark)) and str(tmp_path) in intermediate_folder(spark)
    drop_intermediate(spark)
    assert not os.path.exists(intermediate_folder(spark))


SPEC = {
    "sources": {
        "logs": {
            "path": "{root}/logs", "time_column": "auction_timestamp",
            "columns": {"rtb_id": {"dtype": "string", "provides": ["bidder"]}, "auction_winner_price": {"dtype": "double"}},
        },
        "rolled": {"path": "{root}/rolled", "partition_cols": ["date", "hour"]},
    },
    "features": {"bidder": {"case": "uppercase"}},
    "jobs": {
        "roll": {
            "type": "etl",
            "input": {"source": "logs", "filter_expr": "is_tpd_winner", "date_range": {"from": "2024-01-05", "to": "2024-01-25"}},
            "params": {
                "group_by": ["rtb_id", "req_pub_app_store_id"], "time_column": "auction_timestamp",
                "aggregations": [
                    {"source_col": "auction_winner_price", "agg_func": "sum", "output_col": METRICS[0]},
                    {"source_col": "*", "agg_func": "count", "output_col": METRICS[1]},
                ],
                "rolling_windows": [
                    {"name": "1h", "lookback_seconds": 3600, "apply_to": METRICS},
                    {"name": "3h", "lookback_seconds": 10800, "apply_to": METRICS},
                ],
                "dedupe_by": ["event_id"], "dedupe_order": ["auction_timestamp"],
            },
            "output": {"path": "{root}/rolled", "partition_by": ["date", "hour"]},
        },
        "map": {"type": "mapping", "input": {"source": "logs", "mappings": [{"source_col": "rtb_id", "feature": "bidder"}]}},
        "enrich": {
            "type": "enrichment", "input": {"source": "logs"},
            "params": {
                "group_by": ["rtb_id", "req_pub_app_store_id", "date", "hour"],
                "aggregations": [{"source_col": "*", "agg_func": "count", "output_col": "n"}],
                "feature_joins": [{
                    "source": "rolled", "columns": ["hourly_win_count_3h"], "fill_na": 0,
                    "keys": {"rtb_id": "rtb_id", "req_pub_app_store_id": "req_pub_app_store_id", "date": "date", "hour": "hour"},
                }],
            },
        },
        "figure": {
            "type": "visualization", "input": {"source": "logs"},
            "params": {"derived": {"p": "auction_winner_price + 1"}, "figure": {"kind": "histogram", "columns": ["p"], "bins": 5}},
        },
        "fit": {
            "type": "training", "input": {"source": "logs", "filter_expr": "auction_winner_price is not null"},
            "params": {"learner": "linear_regression", "target": "auction_winner_price", "numeric": ["minute"], "id_column": "event_id", "hyperparameters": {"maxIter": 2}},
        },
    },
}


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    logs = view(spark, SF, "auction_logs").withColumn("minute", F.minute("auction_timestamp"))
    logs.write.parquet(f"{root}/logs")
    return root


def test_spec_reproduces_the_flagship(spark, root, rows):
    jobs.run_job(spark, SPEC, "roll", values={"root": root})
    saved = spark.read.option("basePath", f"{root}/rolled").parquet(f"{root}/rolled")
    want = flagship(spark, SF)
    columns = [c for c in want.columns if c not in ("date", "hour")]
    assert rows(rounded(saved), *columns) == rows(want, *columns) and want.count() > 50
    enriched = jobs.run_job(spark, SPEC, "enrich", "2024-01-06", "2024-01-06", {"root": root})
    day = spark.read.parquet(f"{root}/logs").where("to_date(auction_timestamp) = DATE '2024-01-06'")
    assert enriched.agg(F.sum("n")).first()[0] == day.count() > 0


def test_other_job_types(spark, root):
    assert {r["bidder"] for r in jobs.run_job(spark, SPEC, "map", values={"root": root}).collect()} <= {f"RTB_{i}" for i in range(5)}
    figure = jobs.run_job(spark, SPEC, "figure", values={"root": root})
    assert figure.agg(F.sum("count")).first()[0] == spark.read.parquet(f"{root}/logs").where("auction_winner_price is not null").count()
    assert "prediction" in jobs.run_job(spark, SPEC, "fit", values={"root": root}).columns


def test_spec_problems_are_listed():
    bad = {
        "sources": {"s": {"path": "p", "columns": {"a": {"dtype": "int", "provides": ["nope"]}, "b": {"dtype": "int"}}}},
        "features": {"f": {}},
        "jobs": {
            "x": {"type": "etl", "input": {"source": "t"}},
            "y": {"type": "mapping", "input": {"source": "s", "mappings": [{"source_col": "b", "feature": "f"}, {"source_col": "z", "feature": "f"}, {"source_col": "a", "feature": "g"}]},
                  "params": {"feature_joins": [{"source": "u"}]}},
        },
    }
    with pytest.raises(jobs.SpecError) as e:
        jobs.check_spec(bad)
    assert str(e.value).count(";") == 5


def test_lookback_feeds_the_first_hours(spark):
    """Trimming before the windows would lose the first rows' history."""
    logs = view(spark, SF, "auction_logs").where("is_tpd_winner")
    params = jobs.EtlParams(
        ["rtb_id"], "auction_timestamp", aggregations=[Aggregation("*", "count", "n")], rolling_windows=[jobs.Rolling("3h", 10800, ["n"])]
    )
    when = TimeRange("2024-01-10 06:00:00", "2024-01-12 06:00:00")
    wide = ranges.within(logs, "auction_timestamp", when, params.lookback)
    out = jobs.etl(wide, params, when)
    whole = jobs.etl(logs, params, when)
    assert sorted(map(str, out.collect())) == sorted(map(str, whole.collect()))
    assert out.agg(F.sum("n_3h")).first()[0] > 0


def test_stream_equals_batch(spark, tmp_path, rows):
    source = spark.read.parquet(f"{SF}/events.parquet")
    source.orderBy("ts").repartitionByRange(4, "ts").write.parquet(str(tmp_path / "in"))
    aggregations = [Aggregation("value", "sum", "total"), Aggregation("*", "count", "n", "value > 20")]
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    agg = stream_aggregate(stream, ["event_type"], aggregations, "ts", "hour", "40 days")
    query = (
        agg.writeStream.outputMode("complete").format("memory").queryName("hourly_stream").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    batch = bucket_aggregate(source, ["event_type"], aggregations, "ts")
    columns = ["time_bucket", "event_type", "n"]
    got = spark.table("hourly_stream")
    assert rows(got, *columns) == rows(batch, *columns)
    assert got.agg(F.sum("total")).first()[0] == pytest.approx(batch.agg(F.sum("total")).first()[0])
    with pytest.raises(ValueError):
        stream_aggregate(stream, [], [Aggregation("value", "count_distinct", "d")], "ts")


def test_only_day_partitions_are_pruned(spark, tmp_path):
    """A table partitioned by something else first keeps all its rows."""
    rows = spark.range(80).select(
        "id", F.lit("click").alias("event_type"), F.lit("2024-01-02").alias("dt"), F.expr("timestamp_ntz'2024-01-02 03:00:00'").alias("ts")
    )
    path = str(tmp_path / "t")
    rows.write.partitionBy("event_type", "dt").parquet(path)
    source = tables.Source(path=path, partition_cols=("event_type", "dt"), time_column="ts")
    assert tables.read_source(spark, source, TimeRange("2024-01-01", "2024-01-03")).count() == 80
    assert tables.read_source(spark, source, TimeRange("2024-01-03", "2024-01-04")).count() == 0
    bare = tables.Source(path=path, partition_cols=("event_type",), time_column="ts")
    assert tables.read_source(spark, bare, TimeRange("2024-01-01", "2024-01-03")).count() == 80


def test_missing_days_are_all_named(spark):
    have = spark.createDataFrame([("2024-01-05",)], "d string")
    with pytest.raises(FileNotFoundError, match="35 days: 2024-01-01 to 2024-01-04, 2024-01-06 to 2024-02-05"):
        tables.require_days(have, "d", "2024-01-01", "2024-02-06")


def test_intermediate_tables_leave_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {os.path.basename(f) for f in files if os.path.basename(f).startswith("shuffle_")}

    before, setting = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, None)
    table = cut_lineage(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().join(spark.range(10).repartition(3), F.col("k") == F.col("id")))
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and table.count() == 10 and spark.conf.get(setting, None) == was
