"""Intermediate tables in the shared folder, so that a lost executor costs no recomputation."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
#: Rows of a few short columns that are sent to every executor at most (about 20 MB there).
BROADCAST_ROWS = 250_000
#: Rows of one partition where rows are dealt out, about.
PART_ROWS = 250_000


def row_parts(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows, so that a task of a larger table is no larger; where there are
    few rows, up to one for each core."""
    few = min(spark.sparkContext.defaultParallelism, -(-rows * 10 // PART_ROWS))
    return max(1, few, -(-rows // PART_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A local session without that setting gets one folder of its own, since driver and executors
    are then one process. On a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="tillroll-")
    return _LOCAL[context.applicationId]


class Workspace:
    """Writes a DataFrame once as Parquet and hands back a reader of it.

    Unlike a cached or checkpointed plan, the stored table is columnar, so each later use reads
    only the columns it needs, and it outlives the executors that wrote it.

    The folder goes when the workspace is closed: at the end of a `with` block, or else when the
    driver's process ends, since results that are read lazily need it until then.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/tillroll-{uuid.uuid4().hex}"
        atexit.register(self.close)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("errorifexists").parquet(self.path(name))
        return self.read(name, frame)

    def store_small(self, frame: DataFrame, name: str) -> DataFrame:
        """The same for what is joined with much larger tables: rows are counted, and up to
        BROADCAST_ROWS of them go to every executor, so that the larger table stays where it is."""
        stored = self.store(frame, name)
        return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def close(self) -> None:
        """Removes the folder; a session that is gone, or a folder that is, is no error."""
        atexit.unregister(self.close)
        with contextlib.suppress(Exception):
            hadoop = self.spark._jvm.org.apache.hadoop.fs
            path = hadoop.Path(self.folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()
