"""Step boundaries: tables written to shared storage and read back.

A staged table is computed once, survives the loss of any executor, and gives
the readers after it true file sizes, so that Spark's own size check decides
what may be broadcast.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir, or set on the context.

    Only a local-mode session (tests) may fall back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


class Workspace:
    """A fresh folder below the shared root that holds one run's staged tables."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._staged: dict[int, tuple[DataFrame, str]] = {}

    @cached_property
    def path(self) -> str:
        """Resolved when first needed: what stages nothing needs no shared folder."""
        return f"{shared_root(self.spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"

    def stage(self, frame: DataFrame, name: str) -> DataFrame:
        return self._written(frame, name, {})

    def stage_packed(self, frame: DataFrame, name: str) -> DataFrame:
        """For wide tables that stay until the end: less disk than the session's codec, for some CPU."""
        return self._written(frame, name, {"compression": "zstd"})

    def _written(self, frame: DataFrame, name: str, options: dict[str, str]) -> DataFrame:
        target = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        frame.write.mode("overwrite").options(**options).parquet(target)
        staged = self.spark.read.schema(frame.schema).parquet(target)
        self._staged[id(staged)] = staged, target
        return staged

    def drop(self, *frames: DataFrame) -> None:
        """Delete staged tables that nothing reads any more; other frames are left alone."""
        for frame in frames:
            _, target = self._staged.pop(id(frame), (None, None))
            if target:
                self._delete(target)

    def close(self) -> None:
        """Delete this run's staged tables; frames that read them end here."""
        if "path" in self.__dict__:
            self._delete(self.path)
        self._staged.clear()

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *exc_info) -> None:
        self.close()
