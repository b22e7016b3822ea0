"""Sources, scans and sinks."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table, view
from adlake.functions.scalar import date_text
from adlake.operators.aggregate import Aggregation
from adlake.session import cut_lineage, intermediate_folder
from adlake.sources import ranges, tables
from adlake.sources.ranges import TimeRange
from adlake.sources.tables import Source
from adlake.streaming.hourly import stream_aggregate


def _events(sf_dir):
    return Source(path=f"{sf_dir}/events.parquet", time_column="ts")


@query(
    "scan_time_range",
    """SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-10 12:00:00' AND event_type <> 'error'""",
)
def _(spark, sf_dir):
    when = TimeRange("2024-01-05 06:00:00", "2024-01-10 12:00:00")
    return tables.read_source(
        spark, _events(sf_dir), when, filter_expr="event_type <> 'error'", columns=["event_id", "ts", "value"]
    )


@query(
    "scan_whole_end_day",
    """SELECT event_type, count(*) AS n, max(ts) AS last_ts FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-11' GROUP BY event_type""",
)
def _(spark, sf_dir):
    rows = tables.read_source(spark, _events(sf_dir), TimeRange("2024-01-05", "2024-01-10"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))


@query(
    "scan_lookback",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-04 21:00:00' AND ts < TIMESTAMP '2024-01-08' GROUP BY 1""",
)
def _(spark, sf_dir):
    hours = ranges.lookback_hours([3600, 10800])
    rows = tables.read_source(spark, _events(sf_dir), TimeRange("2024-01-05", "2024-01-07"), hours)
    return rows.groupBy(date_text("ts").alias("day")).agg(F.count("*").alias("n"))


@query(
    "scan_required_columns",
    """SELECT rtb_id, auction_winner_price, auction_timestamp FROM auction_logs WHERE is_tpd_winner""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    wanted = tables.required_columns(
        group_by=["rtb_id"],
        aggregations=[Aggregation("auction_winner_price", "sum", "s"), Aggregation("*", "count", "n")],
        time_columns=["auction_timestamp"],
    )
    return view(spark, sf_dir, "auction_logs").where("is_tpd_winner").select(*wanted)


@query(
    "partitioned_roundtrip",
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
WHERE ts >= TIMESTAMP '2024-01-04 22:00:00' AND ts < TIMESTAMP '2024-01-09' GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """Write by day, read the days of a widened range back with pruned partitions."""
    source = Source(path=_by_day(spark, sf_dir), partition_cols=("dt",), time_column="ts")
    rows = tables.read_source(spark, source, TimeRange("2024-01-05", "2024-01-08"), lookback_hours=2)
    day = F.col("dt").cast("string").alias("dt")
    return rows.groupBy(day, "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "formats_roundtrip",
    """SELECT f.format, count(*) AS n, round(sum(c_acctbal), 2) AS total, count(DISTINCT c_mktsegment) AS segments
FROM customer, (VALUES ('parquet'), ('csv'), ('json'), ('orc')) AS f(format) GROUP BY f.format""",
)
def _(spark, sf_dir):
    """Write in every format and read each back by its file ending."""
    source = table(spark, sf_dir, "customer")
    root = f"{intermediate_folder(spark)}/customer-{uuid.uuid4().hex}"
    out = None
    for kind in ("parquet", "csv", "json", "orc"):
        tables.write_table(source, f"{root}.{kind}", kind)
        back = tables.read_by_extension(spark, f"{root}.{kind}", source.schema)
        part = back.agg(
            F.lit(kind).alias("format"),
            F.count("*").alias("n"),
            F.round(F.sum("c_acctbal"), 2).alias("total"),
            F.count_distinct("c_mktsegment").alias("segments"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "missing_days",
    """SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '2023-12-28', DATE '2024-02-04', INTERVAL 1 DAY) AS s(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
)
def _(spark, sf_dir):
    return tables.missing_days(table(spark, sf_dir, "events"), "ts", "2023-12-28", "2024-02-05")


@query(
    "date_spine_fill",
    """SELECT CAST(d AS DATE) AS day, n FROM generate_series(DATE '2023-12-28', DATE '2024-02-05', INTERVAL 1 DAY) AS s(d)
LEFT JOIN (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1) e ON e.day = CAST(d AS DATE)""",
)
def _(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return ranges.fill_days(daily, "day", "2023-12-28", "2024-02-05")


@query("hour_from_timestamp", "SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.hour("ts").alias("hour")).agg(F.count("*").alias("n"))


def _by_day(spark, sf_dir):
    """Events written by day; returns the folder."""
    path = f"{intermediate_folder(spark)}/events-{uuid.uuid4().hex}"
    tables.write_table(table(spark, sf_dir, "events").withColumn("dt", date_text("ts")), path, partition_by=["dt"])
    return path


@query(
    "read_days",
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, round(sum(value), 4) AS total FROM events
WHERE CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-09') GROUP BY 1""",
)
def _(spark, sf_dir):
    """Two day folders of one table, with a renamed column."""
    path = _by_day(spark, sf_dir)
    days = tables.read_days(spark, path, [f"{path}/dt=2024-01-05", f"{path}/dt=2024-01-09"], {"value": "price"})
    day = F.col("dt").cast("string").alias("dt")
    return days.groupBy(day).agg(F.count("*").alias("n"), F.round(F.sum("price"), 4).alias("total"))


@query("path_dates", "SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf_dir):
    """Dates that are only in the file paths."""
    files = spark.read.option("recursiveFileLookup", True).parquet(_by_day(spark, sf_dir))
    return tables.with_path_date(files).groupBy("date").agg(F.count("*").alias("n"))


@query(
    "catalog_partitions",
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' GROUP BY 1""",
)
def _(spark, sf_dir):
    """A catalog table: its first partition column is looked up and pruned by the days of the range."""
    name, path = f"events_{uuid.uuid4().hex}", f"{intermediate_folder(spark)}/events-{uuid.uuid4().hex}"
    by_day = table(spark, sf_dir, "events").withColumn("dt", date_text("ts"))
    by_day.hint("rebalance", "dt").write.partitionBy("dt").option("path", path).saveAsTable(name)
    rows = tables.read_source(spark, Source(path=name, format="table"), TimeRange("2024-01-05", "2024-01-06"))
    counts = cut_lineage(rows.groupBy("dt").agg(F.count("*").alias("n")))
    spark.sql(f"DROP TABLE {name}")  # its files stay in the shared folder until that is dropped
    return counts


@query(
    "merged_schema",
    """SELECT CASE WHEN event_id % 2 = 0 THEN event_type END AS event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""",
)
def _(spark, sf_dir):
    """Files with and without a column under one declared schema."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    root = f"{intermediate_folder(spark)}/merge-{uuid.uuid4().hex}"
    events.where("event_id % 2 = 0").write.parquet(f"{root}/part=0")
    events.where("event_id % 2 <> 0").drop("event_type").write.parquet(f"{root}/part=1")
    rows = tables.read_declared(spark, root, "event_id bigint, event_type string, value double")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("newest_file", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey % 2 = 1 GROUP BY 1")
def _(spark, sf_dir):
    """Of two saved lists the one changed last is read."""
    root = f"{intermediate_folder(spark)}/lists-{uuid.uuid4().hex}"
    customers = table(spark, sf_dir, "customer")
    for part in (0, 1):
        customers.where(F.col("c_custkey") % 2 == part).write.csv(f"{root}/list_{part}", header=True)
        time.sleep(0.01)
    newest = tables.newest_file(spark, f"{root}/list_*/*.csv")
    rows = tables.read_by_extension(spark, newest, customers.schema)
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "stream_hourly",
    """SELECT date_trunc('hour', ts) AS time_bucket, event_type, round(sum(value), 4) AS total, count(*) AS n FROM events GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """The hourly sums as a stream. A closing row far ahead moves the watermark past every real hour, so all come out."""
    root = f"{intermediate_folder(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    closing = last.select(*[F.col("ts") if c == "ts" else F.lit(None).cast(t).alias(c) for c, t in events.dtypes])
    closing.write.parquet(f"{root}/closing")
    schema = events.schema
    data = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    end = spark.readStream.schema(schema).parquet(f"{root}/closing")
    sums = [Aggregation("value", "sum", "total"), Aggregation("*", "count", "n")]
    hourly = stream_aggregate(data.unionByName(end), ["event_type"], sums, "ts", "hour", "1 hour")
    running = (
        hourly.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    )
    running.awaitTermination()
    out = spark.read.schema(hourly.schema).parquet(f"{root}/out").where("event_type IS NOT NULL")
    return out.withColumn("total", F.round("total", 4))


@query("file_inventory")
def _(spark, sf_dir):
    return tables.file_inventory(table(spark, sf_dir, "lineitem"))


@query("estimated_rows")
def _(spark, sf_dir):
    return tables.estimate_rows(tables.file_inventory(table(spark, sf_dir, "lineitem")), 10_000_000)


@query("footer_rows", "SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1")
def _(spark, sf_dir):
    """Rows by partition from the footers of a partitioned copy; no column is read."""
    path = f"{intermediate_folder(spark)}/footers-{uuid.uuid4().hex}"
    tables.write_table(table(spark, sf_dir, "lineitem"), path, partition_by=["l_linenumber"])
    return tables.footer_rows(spark, path, ["l_linenumber"])
