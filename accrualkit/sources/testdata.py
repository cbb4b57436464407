"""Base tables of the generated test data (one Parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


class BaseTables:
    """Lazy, memoised Parquet readers for ``<sf_dir>/<name>.parquet``.

    Reading is lazy: nothing is scanned until an action, and Catalyst
    prunes each scan to the columns and row groups a query needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in BASE_TABLES:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BASE_TABLES:
            raise AttributeError(name)
        return self[name]
