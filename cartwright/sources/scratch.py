"""Shared storage for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the context's checkpoint folder, else
    ``_scratch`` under the warehouse folder. All of them are shared by driver and executors;
    a machine's own temporary folder is never used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = current.get() if current.isDefined() else None
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise ValueError("set spark.checkpoint.dir or spark.sql.warehouse.dir")
        root = f"{warehouse.rstrip('/')}/_scratch"
    return root


class Scratch:
    """Tables written under one fresh folder of the shared scratch space.

    The folder is removed by ``release``, and at the latest when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, codec: str | None = None):
        """``codec`` compresses the tables; by default as the session does."""
        self.spark, self.codec = spark, codec
        self.path = f"{(root or scratch_root(spark)).rstrip('/')}/cartwright-{uuid.uuid4().hex}"
        self._ends_with_session = False
        self._staged: dict[str, tuple[str, DataFrame]] = {}  # path: name and scan

    def _folder(self):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a scan of the copy: lineage ends here."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path, compression=self.codec)
        if not self._ends_with_session:
            system, folder = self._folder()
            system.deleteOnExit(folder)
            self._ends_with_session = True
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._staged[path] = name, staged
        return staged

    def drop(self, *staged: DataFrame) -> None:
        """Remove staged tables that nothing reads any more: whatever was made of them is staged itself."""
        self._remove([path for path, (_, scan) in self._staged.copy().items() if any(scan is df for df in staged)])

    def drop_named(self, name: str) -> None:
        """Remove the tables staged as ``name``, once nothing reads them any more."""
        self._remove([path for path, (given, _) in self._staged.copy().items() if given == name])

    def _remove(self, paths: list[str]) -> None:
        system, _ = self._folder()
        for path in paths:
            system.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)
            del self._staged[path]

    def release(self) -> None:
        """Remove this object's own folder, once nothing reads its tables any more."""
        system, folder = self._folder()
        system.delete(folder, True)
