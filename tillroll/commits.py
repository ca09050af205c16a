"""A numbered commit log in a folder that all drivers share.

Entry N is the file N.json, and whoever creates it has made commit N: the file system lets one
writer create a name, whatever their clocks say. A writer that finds N taken reads the log again
and tries N + 1, or gives up if it asked for the log as it knew it. Readers take the entry with
the highest number; an entry without its closing line (its writer died, or is still at it) is no
commit, and its number stays unused.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("committed_at", T.StringType()),
        T.StructField("facts", T.MapType(T.StringType(), T.StringType())),
        T.StructField("closed", T.BooleanType()),
    ]
)
_DIGITS = 12


class CommitConflict(RuntimeError):
    """Someone else committed since the log was read."""


@dataclass(frozen=True)
class Commit:
    number: int
    id: str
    facts: dict[str, str] = field(default_factory=dict)


class CommitLog:
    """The commits below one folder. `facts` of a commit are text values of its writer's choice."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._root = self._hadoop.Path(self.folder)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The numbers taken, in order."""
        if not self._files.exists(self._root):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._root)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def newest(self) -> Commit | None:
        for number in reversed(self.numbers()):
            if commit := self._read(number):
                return commit
        return None

    def head(self) -> int:
        """The highest number taken, nought in an empty log."""
        return max(self.numbers(), default=0)

    def entries(self) -> DataFrame:
        """number, id, committed_at (by the writer's clock; it decides nothing), facts."""
        if not self.numbers():
            frame = self.spark.createDataFrame([], SCHEMA)
        else:
            frame = self.spark.read.schema(SCHEMA).json(f"{self.folder}/*.json")
        return frame.filter(F.col("closed")).drop("closed")

    def commit(self, id_: str, facts: dict[str, str] | None = None, after: int | None = None) -> Commit:
        """The next commit. With `after`, only if no number beyond it is taken; else it raises
        CommitConflict. Without, conflicts move the commit to a later number."""
        number = self.head() + 1
        while after is None or number == after + 1:
            if self._create(number, id_, facts or {}):
                return Commit(number, id_, facts or {})
            number = max(number, self.head()) + 1
        raise CommitConflict(f"{self.folder}: number {number - 1} is taken, {after} was the last one known")

    def remove_uncommitted(self, parent: str, older_than_hours: float) -> list[str]:
        """Removes the folders below parent, one for each id, that no commit names and that had
        no file written for so long; their names. A folder still being written is younger.

        Ages are taken from the file system's own clock.
        """
        root = self._hadoop.Path(parent)
        if not self._files.exists(root):
            return []
        names = {status.getPath().getName() for status in self._files.listStatus(root) if status.isDirectory()}
        open_ = sorted(names - {row.id for row in self.entries().select("id").collect()})
        limit = self._now() - older_than_hours * 3_600_000
        gone = [name for name in open_ if self._newest_file(self._hadoop.Path(root, name)) <= limit]
        # A commit made meanwhile is seen here, since its folder was complete before it.
        committed = {row.id for row in self.entries().select("id").collect()}
        gone = [name for name in gone if name not in committed]
        for name in gone:
            self._files.delete(self._hadoop.Path(root, name), True)
        return gone

    def _now(self) -> int:
        probe = self._hadoop.Path(self._root, f".{uuid.uuid4().hex}")
        self._files.create(probe, False).close()
        try:
            return self._files.getFileStatus(probe).getModificationTime()
        finally:
            self._files.delete(probe, False)

    def _newest_file(self, folder) -> int:
        newest = self._files.getFileStatus(folder).getModificationTime()
        files = self._files.listFiles(folder, True)
        while files.hasNext():
            newest = max(newest, files.next().getModificationTime())
        return newest

    def _path(self, number: int):
        return self._hadoop.Path(f"{self.folder}/{number:0{_DIGITS}d}.json")

    def _create(self, number: int, id_: str, facts: dict[str, str]) -> bool:
        at = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
        entry = {"number": number, "id": id_, "committed_at": at, "facts": facts, "closed": True}
        data = bytearray(json.dumps(entry).encode() + b"\n")
        return self._create_linked(number, data) if self._is_local() else self._create_new(number, data)

    def _create_new(self, number: int, data: bytearray) -> bool:
        """Stores that refuse to create a name twice: HDFS, and object stores with such a put."""
        try:
            out = self._files.create(self._path(number), False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName() or self._files.exists(self._path(number)):
                return False
            raise
        try:
            out.write(data)
        finally:
            out.close()
        return True

    def _is_local(self) -> bool:
        return self._files.getUri().getScheme() == "file"

    def _create_linked(self, number: int, data: bytearray) -> bool:
        """A local or mounted folder: there the file system looks before it creates, which two
        writers can do at once. A hard link of a finished file is made by one of them."""
        jvm = self.spark._jvm
        self._files.mkdirs(self._root)
        place = jvm.java.nio.file.Path.of(self._files.makeQualified(self._path(number)).toUri())
        own = place.resolveSibling(f".{uuid.uuid4().hex}")
        jvm.java.nio.file.Files.write(own, data, self.spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 0))
        try:
            jvm.java.nio.file.Files.createLink(place, own)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        finally:
            jvm.java.nio.file.Files.delete(own)
        return True

    def _read(self, number: int) -> Commit | None:
        stream = self._files.open(self._path(number))
        try:
            text = bytes(stream.readAllBytes()).decode(errors="replace")
        finally:
            stream.close()
        try:
            entry = json.loads(text)
        except ValueError:
            return None
        return Commit(entry["number"], entry["id"], entry["facts"]) if entry.get("closed") else None
