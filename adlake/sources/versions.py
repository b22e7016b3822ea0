"""Versioned table folders: one folder per version, with a one-row metadata table beside the data; whole tables or changes."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType


class VersionedTable:
    """Versions ``{root}/v=N/data`` split by token hash, with ``{root}/v=N/meta``.

    A version counts as saved once its metadata is there; the data are written first, so a job that dies half-way
    leaves no version behind.
    """

    def __init__(self, spark: SparkSession, root: str, shards: int = 8, key: str = "token_id"):
        self.spark, self.root, self.shards, self.key = spark, root.rstrip("/"), shards, key

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def path(self, version: int, part: str = "data") -> str:
        return f"{self.root}/v={version}/{part}"

    def save(self, table: DataFrame, version: int, info: Mapping | None = None) -> None:
        """Write data by shard, then metadata. The mark of an earlier save goes first, so no torn version looks saved.

        A rebalance gives each shard as many tasks as its size needs, not one.
        """
        fs, meta_path = self._fs(self.path(version, "meta"))
        fs.delete(meta_path, True)
        shard = F.pmod(F.xxhash64(self.key), F.lit(self.shards)).cast("int")
        data = table.withColumn("shard", shard).hint("rebalance", "shard")
        data.write.mode("overwrite").partitionBy("shard").parquet(self.path(version))
        meta = self.spark.range(1).select(
            F.lit(version).alias("version"),
            F.lit(self.shards).alias("shards"),
            F.lit(json.dumps(dict(info or {}), sort_keys=True)).alias("info"),
        )
        meta.coalesce(1).write.mode("overwrite").parquet(self.path(version, "meta"))

    def versions(self) -> list[int]:
        return self._versions_in(self.root)

    def _versions_in(self, folder: str) -> list[int]:
        fs, root = self._fs(folder)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("v=") and self._exists(self.path(int(name[2:]), "meta") + "/_SUCCESS"):
                found.append(int(name[2:]))
        return sorted(found)

    def _exists(self, path: str) -> bool:
        fs, where = self._fs(path)
        return fs.exists(where)

    def latest(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def load(self, version: int | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no version under {self.root}")
        return self.spark.read.parquet(self.path(version)).drop("shard")

    def info(self, version: int) -> dict:
        return json.loads(self.spark.read.parquet(self.path(version, "meta")).first()["info"])

    def delete(self, version: int) -> bool:
        fs, where = self._fs(f"{self.root}/v={version}")
        return fs.delete(where, True)


class LogTable(VersionedTable):
    """Versions that hold changed rows only: a base with the whole table now and then, and deltas with touched keys.

    A read takes, for every key, the newest row up to its version. Deltas are folded among themselves first, combined before the shuffle;
    the base only loses the keys that a delta has, so it is neither sorted nor grouped. A factor that scales the whole table (decay) is kept
    as a number beside the delta and applied on read. A removed key is a row without values. Bytes of a step follow from its
    keys; :meth:`compact` writes a new base, and :meth:`vacuum` deletes what no later read needs.
    """

    def __init__(self, spark: SparkSession, root: str, shards: int = 8, key: str = "token_id", scaled: Sequence[str] = ("embedding", "update_count")):
        super().__init__(spark, root, shards, key)
        self.scaled = tuple(scaled)

    def path(self, version: int, part: str = "data") -> str:
        """``{root}/data/v=N`` and ``{root}/meta/v=N``, so that one scan reads several versions with their number as a column."""
        return f"{self.root}/{part}/v={version}"

    def versions(self) -> list[int]:
        return self._versions_in(f"{self.root}/meta")

    def save(self, table: DataFrame, version: int, info: Mapping | None = None) -> None:
        """The whole table as a base."""
        self._write(table.withColumn("_gone", F.lit(False)), version, info, True, 1.0)

    def _write(self, rows: DataFrame, version: int, info: Mapping | None, base: bool, factor: float) -> None:
        """Rows and their facts; the schema is kept too, as a version without rows has no file that says it."""
        super().save(rows, version, {**(info or {}), "_base": base, "_factor": float(factor), "_schema": rows.schema.json()})

    def append(
        self, changed: DataFrame, version: int, info: Mapping | None = None, factor: float = 1.0, removed: DataFrame | None = None
    ) -> None:
        """Whole rows of the keys that changed, and the keys (a column named like the key) that are removed.

        ``factor`` scales the table as of this version, its own rows included. Without an earlier version the rows are a base.
        """
        if not self.versions():
            if removed is not None:
                changed = changed.join(removed.select(self.key), self.key, "left_anti")
            self._write(changed.withColumn("_gone", F.lit(False)), version, info, True, factor)
            return
        rows = changed.withColumn("_gone", F.lit(False))
        if removed is not None:
            gone = removed.select(self.key).distinct().withColumn("_gone", F.lit(True))
            rows = rows.join(gone.select(self.key), self.key, "left_anti").unionByName(gone, allowMissingColumns=True)
        self._write(rows, version, info, False, factor)

    def info(self, version: int) -> dict:
        return {k: v for k, v in super().info(version).items() if not k.startswith("_")}

    def chain(self, version: int | None = None) -> list[tuple[int, float]]:
        """The versions a read of ``version`` needs, a base first, each with the factor its rows are scaled by."""
        found = [v for v in self.versions() if version is None or v <= version]
        if not found or version is not None and found[-1] != version:
            raise FileNotFoundError(f"no version {version} under {self.root}")
        out, factor = [], 1.0
        for v in reversed(found):
            info = super().info(v)
            factor *= info["_factor"]
            out.append((v, factor))
            if info["_base"]:
                return out[::-1]
        raise FileNotFoundError(f"no base at or before version {found[-1]} under {self.root}")

    def load(self, version: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The table as of ``version``, or only its rows of ``keys`` (distinct, a column named like the key).

        With few keys Spark broadcasts them, and the table is read without a shuffle.
        """
        chain = self.chain(version)
        base, deltas = chain[0], chain[1:]
        rows = self._scaled(self._read([base[0]], keys).drop("_v"), F.lit(base[1]), base[1] != 1.0).where("NOT _gone")
        if deltas:
            changes = self._read([v for v, _ in deltas], keys)
            values = [c for c in changes.columns if c not in (self.key, "_v")]
            newest = changes.groupBy(self.key).agg(F.max_by(F.struct(*values, "_v"), "_v").alias("_r")).select(self.key, "_r.*")
            factors = F.create_map(*[F.lit(x) for pair in deltas for x in pair])
            newest = self._scaled(newest, F.element_at(factors, F.col("_v")), any(f != 1.0 for _, f in deltas)).drop("_v")
            touched = changes.select(F.col(self.key).alias("_touched")).distinct()
            kept = rows.join(touched, F.col(self.key) == F.col("_touched"), "left_anti")
            rows = kept.unionByName(newest.where("NOT _gone"))
        return rows.drop("_gone")

    def _read(self, versions: Sequence[int], keys: DataFrame | None) -> DataFrame:
        """Rows of some versions with their number ``_v``."""
        schema = StructType.fromJson(json.loads(super().info(versions[-1])["_schema"])).add("v", IntegerType()).add("shard", IntegerType())
        paths = [self.path(v) for v in versions]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths).drop("shard")
        rows = rows.withColumn("_v", F.col("v").cast("int")).drop("v")
        return rows if keys is None else rows.join(keys.select(self.key), self.key, "left_semi")

    def _scaled(self, rows: DataFrame, factor, needed: bool) -> DataFrame:
        if not needed:
            return rows
        out = {}
        for c in self.scaled:
            kind = rows.schema[c].dataType
            is_array = kind.typeName() == "array"
            out[c] = (F.transform(c, lambda x: x * factor) if is_array else F.col(c) * factor).cast(kind)
        return rows.withColumns(out)

    def compact(self, version: int | None = None) -> int:
        """Write the table as of the latest version (or ``version``, which must be the latest) as a base, as the next version; its number."""
        latest = self.latest()
        if version not in (None, latest):
            raise ValueError("only the latest version can be compacted")
        self.save(self.load(latest), latest + 1, self.info(latest))
        return latest + 1

    def delete(self, version: int) -> bool:
        """Delete ``version`` and all later ones, which build on it."""
        found = [v for v in self.versions()[::-1] if v >= version]
        for v in found:
            self._remove(v)
        return bool(found)

    def _remove(self, version: int) -> None:
        """The mark of a saved version goes first, so that a half-deleted one is no version."""
        for part in ("meta", "data"):
            fs, where = self._fs(self.path(version, part))
            fs.delete(where, True)

    def vacuum(self) -> list[int]:
        """Delete the versions before the last base; returns their numbers."""
        first = self.chain()[0][0]
        old = [v for v in self.versions() if v < first]
        for v in old:
            self._remove(v)
        return old
