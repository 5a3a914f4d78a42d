"""Publishing stored tables: written beside, checked, then swapped.

A published table ``db.name`` is a view of one version, the plain table ``db.name__<version>``. Replacing a
view is one step in the catalogue, so a reader finds the old version or the new one and never a missing table.
A version is published only when all tables of its set were written and checked; after a failure nothing has
changed. The version before stays for queries that have begun, older ones are dropped.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Of stored tables and of the copies they are made from, which are written once and read a few times.
CODEC = "zstd"


class NotPublished(RuntimeError):
    """A stored copy is not what was to be stored."""


class Publication:
    """One version of a set of tables."""

    def __init__(self, spark: SparkSession, version: str | None = None):
        self.spark = spark
        # Names of later versions sort behind.
        self.version = version or f"v{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"
        self.written: dict[str, int] = {}  # full name -> rows

    def beside(self, full_name: str) -> str:
        return f"{full_name}__{self.version}"

    def write(self, df: DataFrame, full_name: str) -> DataFrame:
        """Store ``df`` beside the published table and return the stored copy."""
        seen = Observation()
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        self.written[full_name] = -1
        observed.write.format("parquet").option("compression", CODEC).saveAsTable(self.beside(full_name))
        self.written[full_name] = seen.get["rows"]
        stored = self.spark.table(self.beside(full_name))
        self._check(df, stored, full_name)
        return stored

    def _check(self, df: DataFrame, stored: DataFrame, full_name: str) -> None:
        rows = stored.count()
        if rows != self.written[full_name]:
            raise NotPublished(f"{full_name}: {self.written[full_name]} rows were written, {rows} are stored")
        shape = [[(f.name, f.dataType) for f in x.schema] for x in (df, stored)]
        if shape[0] != shape[1]:
            raise NotPublished(f"{full_name}: columns differ: {shape[0]}, stored {shape[1]}")

    def publish(self) -> None:
        """Point every published name to this version."""
        for full_name in self.written:
            self._make_room(full_name)
            self.spark.sql(f"CREATE OR REPLACE VIEW {full_name} AS SELECT * FROM {self.beside(full_name)}")
        for full_name in self.written:
            for old in versions(self.spark, full_name)[:-2]:
                self.spark.sql(f"DROP TABLE IF EXISTS {old}")

    def _make_room(self, full_name: str) -> None:
        """A plain table of that name, from before there were versions, becomes one."""
        if self.spark.catalog.tableExists(full_name) and self.spark.catalog.getTable(full_name).tableType != "VIEW":
            self.spark.sql(f"ALTER TABLE {full_name} RENAME TO {full_name}__before")

    def discard(self) -> None:
        """Remove what was written; published tables stay as they are."""
        for full_name in self.written:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.beside(full_name)}")
        self.written.clear()


def versions(spark: SparkSession, full_name: str) -> list[str]:
    """The stored versions of a published name, oldest first."""
    database, name = full_name.rsplit(".", 1)
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").collect()
    before = f"{name}__before"
    names = sorted((r["tableName"] for r in found if r["tableName"].startswith(f"{name}__")), key=lambda n: (n != before, n))
    return [f"{database}.{n}" for n in names]
