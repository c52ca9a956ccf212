"""Logical source name → physical location.

The reference addresses sources as ``source(schema, table)`` with an optional
``identifier`` alias; here a catalog maps the same logical names to Parquet
paths (or table names) chosen by the deployment.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Catalog:
    spark: SparkSession
    paths: dict[str, str] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)
    # sources whose text addresses are stored as canonical lower-case text
    canonical_text: set[str] = field(default_factory=set)

    def path(self, name: str) -> str:
        name = self.aliases.get(name, name)
        if name not in self.paths:
            raise KeyError(f"source {name!r} is not in the catalog")
        return self.paths[name]

    def read(self, name: str) -> DataFrame:
        """Scan a source. Filters and projections applied later reach the scan."""
        p = self.path(name)
        if "/" in p or p.endswith(".parquet"):
            return self.spark.read.parquet(p)
        return self.spark.table(p)

    def stores_canonical(self, name: str) -> bool:
        return name in self.canonical_text or self.aliases.get(name, name) in self.canonical_text

    def has(self, name: str) -> bool:
        return self.aliases.get(name, name) in self.paths
