"""Base-table access.

Tables are read lazily with ``spark.read.parquet``; every report selects only
the columns it needs, so Catalyst prunes the Parquet ``ReadSchema`` and pushes
filters into the scan.  A catalog-backed source is available for clusters that
register the tables in a metastore instead of passing a folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the driver's table names.
TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class ParquetTables:
    """Tables stored as ``<base_dir>/<name>.parquet`` (a file or a folder of parts)."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        return os.path.exists(self.path(name)) if "://" not in self.base_dir else True

    def register(self, names=TABLE_NAMES) -> None:
        """Register the tables as temp views (for ``spark.sql``)."""
        for name in names:
            if self.exists(name):
                self.table(name).createOrReplaceTempView(name)


class SpreadTables:
    """Wraps a source so that fact scans are hash-partitioned on their join key.

    A Parquet file is split by row group, so a small fact table stored as one
    row group is read by a single task and every operator fused into that scan
    stage (joins, pricing) runs single-threaded.  The caller asks for this with
    a partition count; large inputs do not need it.
    """

    FACT_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}

    def __init__(self, inner, partitions: int):
        self.inner = inner
        self.partitions = partitions

    def table(self, name: str) -> DataFrame:
        df = self.inner.table(name)
        key = self.FACT_KEYS.get(name)
        return df.repartition(self.partitions, key) if key else df

    def raw(self, name: str) -> DataFrame:
        """The table as stored, for scans that aggregate right away (min/max, counts)."""
        return self.inner.table(name)


class CatalogTables:
    """Tables already registered in the session catalog (``db.name`` or bare names)."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark = spark
        self.database = database

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}" if self.database else name)
