"""Keyed tables that lie in buckets of their key, so that joins on it move the other side only."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from adlake.session import intermediate_folder


class BucketedTable:
    """A table in the catalog, bucketed and sorted by its keys; versions of it are tables of their own.

    A join on the keys reads each bucket where the other side's rows of the same hash are brought to: lookups, pushes of gradients and
    enrichment shuffle requests, not the store. Two stores with the same keys and number of buckets join without any shuffle. Choose the
    number so that a bucket fits a task, and at least ``spark.sql.shuffle.partitions``, or Spark prefers its own number.
    Files lie in the shared folder unless ``folder`` says where.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], buckets: int = 200, folder: str | None = None):
        self.spark, self.name, self.keys, self.buckets = spark, name, list(keys), buckets
        self.folder = (folder or f"{intermediate_folder(spark)}/bucketed").rstrip("/")

    def save(self, table: DataFrame) -> DataFrame:
        """Replace the content by ``table``, which may be a plan over the present content, and return it.

        The new content is written beside the old one, and only then takes its name. One task per bucket writes one file of it.
        """
        part, path = f"{self.name}_{uuid.uuid4().hex[:12]}", f"{self.folder}/{self.name}-{uuid.uuid4().hex}"
        dealt = table.repartition(self.buckets, *self.keys)
        writer = dealt.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", path)
        writer.format("parquet").saveAsTable(part)
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")
        self.spark.sql(f"ALTER TABLE `{part}` RENAME TO `{self.name}`")
        return self.load()

    def load(self) -> DataFrame:
        return self.spark.table(self.name)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def drop(self) -> None:
        """Forget the table; its files stay until the shared folder is cleared."""
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")
