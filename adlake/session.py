"""Session settings and intermediate tables in a shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. All of them can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators assume (UTC, adaptive execution)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, name: str = "adlake") -> SparkSession:
    """A session for tests and the local benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def configured_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may go without:
    there a temporary folder is shared by definition.
    """
    if configured := configured_folder(spark):
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where a result is read more than once. It is computed once, a lost executor costs no recomputation of what
    came before, every later read sees the same rows, and the reader knows the true size of the table.
    """
    path = f"{intermediate_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go when it ends, not when the driver next collects garbage. Only for plans that run once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def drop_table(table: DataFrame) -> None:
    """Delete the files of a table from :func:`cut_lineage` that nothing reads any more."""
    spark = table.sparkSession
    inside = f"/adlake-{spark.sparkContext.applicationId}/"
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        if inside in f"{folder}/":
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def intermediate_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/adlake-{spark.sparkContext.applicationId}"


def drop_intermediate(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no result that reads them is needed any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(intermediate_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
