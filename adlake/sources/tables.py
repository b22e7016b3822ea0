"""Table readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.sources.ranges import TimeRange, date_spine, within

READ_FORMATS = ("table", "parquet", "csv", "json", "orc", "delta")
WRITE_FORMATS = ("parquet", "delta", "csv", "json", "orc")
DAY_NAMES = ("dt", "ds", "day", "date")
WRITE_MODES = ("overwrite", "append", "error", "ignore")
EXTENSION_FORMATS = {"parquet": "parquet", "csv": "csv", "json": "json", "jsonl": "json", "orc": "orc"}


@dataclass(frozen=True)
class ColumnSpec:
    """Declared column. ``provides`` lists features that can be made from it."""

    dtype: str
    nullable: bool = True
    format: str | None = None
    provides: tuple[str, ...] = ()


@dataclass(frozen=True)
class Source:
    """A physical table. ``columns`` may be empty, then the stored schema is used as it is."""

    path: str
    format: str = "parquet"
    columns: Mapping[str, ColumnSpec] = field(default_factory=dict)
    partition_cols: tuple[str, ...] = ()
    time_column: str | None = None
    day_column: str | None = None  # partition column that holds the day, if its type and name do not tell

    def features(self) -> dict[str, list[str]]:
        """Feature -> columns that can provide it."""
        out: dict[str, list[str]] = {}
        for name, spec in self.columns.items():
            for feature in spec.provides:
                out.setdefault(feature, []).append(name)
        return out

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, T._parse_datatype_string(spec.dtype), spec.nullable)
                for name, spec in self.columns.items()
            ]
        )


def read_source(
    spark: SparkSession,
    source: Source,
    time_range: TimeRange | None = None,
    lookback_hours: int = 0,
    filter_expr: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Scan with the time range widened by ``lookback_hours``.

    A partition column that holds days is pruned by the list of days the range touches: Spark cannot know that ``dt`` is
    the date of the time column, so the list is spelled out. Other partition columns are left alone.
    """
    if source.format not in READ_FORMATS:
        raise ValueError(f"unknown source format {source.format!r}")
    if source.format == "table":
        df = spark.table(source.path)
        partitions = partition_columns(spark, source.path)
    else:
        reader = spark.read.format(source.format)
        if source.format == "csv":
            reader = reader.option("header", True)
        if source.columns and source.format in ("csv", "json"):
            reader = reader.schema(source.schema())
        elif source.format == "csv":
            reader = reader.option("inferSchema", True)
        df = reader.load(source.path)
        partitions = list(source.partition_cols)
    if time_range is not None:
        day = source.day_column or day_partition(df, partitions)
        if day is not None and time_range.start and time_range.end:
            df = df.where(F.col(day).cast("string").isin(time_range.days(lookback_hours)))
        if source.time_column:
            df = within(df, source.time_column, time_range, lookback_hours)
    if filter_expr:
        df = df.where(filter_expr)
    return df.select(*columns) if columns else df


def required_columns(
    group_by: Sequence[str] = (),
    aggregations: Sequence = (),
    dedupe_by: Sequence[str] = (),
    rolling: Sequence[str] = (),
    time_columns: Sequence[str] = (),
    available: Sequence[str] | None = None,
) -> list[str]:
    """Columns a job touches, in first-use order. Columns produced by the job itself are not in ``available``."""
    wanted = [*group_by, *(a.source_col for a in aggregations if a.source_col != "*"), *dedupe_by, *rolling, *time_columns]
    unique = list(dict.fromkeys(wanted))
    return unique if available is None else [c for c in unique if c in available]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def day_partition(df: DataFrame, partitions: Sequence[str]) -> str | None:
    """The first partition column that is a date, or text with a name that says so."""
    for name in partitions:
        kind = df.schema[name].dataType
        if isinstance(kind, T.DateType) or (isinstance(kind, T.StringType) and name.lower() in DAY_NAMES):
            return name
    return None


def read_by_extension(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Format from the file name; Parquet when there is no known ending."""
    ending = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    kind = EXTENSION_FORMATS.get(ending, "parquet")
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    elif schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_days(
    spark: SparkSession, base: str, paths: Sequence[str], renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Several partition folders of one table; ``basePath`` keeps the partition columns."""
    df = spark.read.option("basePath", base).parquet(*paths)
    return df.withColumnsRenamed(dict(renames)) if renames else df


def read_declared(spark: SparkSession, path: str, schema: T.StructType | str, view: str | None = None) -> DataFrame:
    """Declared schema over files whose schemas differ; optionally published as a temp view."""
    df = spark.read.schema(schema).option("mergeSchema", True).parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def missing_days(present: DataFrame, date_column: str, first: str, end: str) -> DataFrame:
    """Days of [first, end) that ``present`` does not have."""
    spine = date_spine(present.sparkSession, first, end).where(F.col("day") < F.lit(end).cast("date"))
    have = present.select(F.col(date_column).cast("date").alias("day")).distinct()
    return spine.join(have, "day", "left_anti")


def days_marked(spark: SparkSession, base: str, partition: str = "dt", marker: str = "_SUCCESS") -> DataFrame:
    """Days whose folder holds the success marker. Readers hide such names, so the folder is listed; it has one entry
    per day."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{partition}=*/{marker}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    days = [(status.getPath().getParent().getName().split("=", 1)[1],) for status in found or ()]
    return spark.createDataFrame(days, "day string")


def require_days(present: DataFrame, date_column: str, first: str, end: str) -> None:
    """Raise unless every day of [first, end) is there. The message has all missing days, as ranges."""
    place = F.row_number().over(Window.orderBy("day"))
    lost = missing_days(present, date_column, first, end).withColumn("run", F.date_sub("day", place))
    runs = lost.groupBy("run").agg(F.min("day").alias("a"), F.max("day").alias("b"), F.count("*").alias("n")).orderBy("a").collect()
    if runs:
        spans = [str(r["a"]) if r["n"] == 1 else f"{r['a']} to {r['b']}" for r in runs]
        raise FileNotFoundError(f"no complete data for {sum(r['n'] for r in runs)} days: {', '.join(spans)}")


def newest_file(spark: SparkSession, pattern: str) -> str:
    """Path of the file changed last. The content column is not selected, so no file is read."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    path = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()["path"]
    if path is None:
        raise FileNotFoundError(pattern)
    return path


def with_path_date(df: DataFrame, column: str = "date", pattern: str = r"(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """Date taken from the path of the file that a row came from."""
    return df.withColumn(column, F.to_date(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)))


def file_inventory(df: DataFrame) -> DataFrame:
    """Path, size and rows of every file behind ``df``. Empty files have no rows and do not show."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count("*").alias("rows"))


def footer_rows(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows of a Parquet table, in all or by partition columns, from the footers of its files: no column is read.

    Spark pushes this aggregate into its version-2 reader, which this asks for in a session of its own, so that the caller's settings stay.
    """
    session = spark.newSession()
    v1 = [f for f in session.conf.get("spark.sql.sources.useV1SourceList").split(",") if f.strip() != "parquet"]
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).groupBy(*by).agg(F.count("*").alias("rows"))


def estimate_rows(inventory: DataFrame, all_bytes: int) -> DataFrame:
    """Rows behind ``all_bytes`` from known rows per byte, else one row per 100 bytes."""
    known = inventory.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    per_byte = F.when(F.col("bytes") > 0, F.try_divide(F.col("rows"), F.col("bytes")))
    return known.select((F.coalesce(per_byte, F.lit(0.01)) * F.lit(all_bytes)).cast("long").alias("estimated_rows"))


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Partitioned write. A rebalance groups the rows of a partition value into few files and splits large values over
    several tasks, so one hot partition value does not end in one file."""
    if format not in WRITE_FORMATS:
        raise ValueError(f"unknown output format {format!r}")
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
