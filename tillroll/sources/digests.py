"""SHA-256 of whole files, each by one task, whatever its size.

Small files are single cells of Spark's binary reader. Larger ones are rows of a data source of
this module: a partition is one file, and its task streams the bytes through the digest.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Files beyond this size are streamed.
LARGEST_CELL = 64 << 20
#: Bytes that a task holds of a streamed file.
CHUNK = 4 << 20


class FilePartition(InputPartition):
    def __init__(self, file: str, name: str, path: str):
        self.file, self.name, self.path = file, name, path


def opened(path: str) -> BinaryIO:
    """A file by a path as Hadoop names it: local or mounted ones by themselves, others by the
    file system of their scheme."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return open(path[len(parts.scheme) + 1 :] if parts.scheme else path, "rb")
    from pyarrow import fs

    store, own = fs.FileSystem.from_uri(path)
    return store.open_input_stream(own)


def streamed(path: str, chunk: int = CHUNK) -> str:
    """The SHA-256 of a file, of which `chunk` bytes are held."""
    digest = hashlib.sha256()
    with opened(path) as stream:
        while piece := stream.read(chunk):
            digest.update(piece)
    return digest.hexdigest()


class DigestReader(DataSourceReader):
    def __init__(self, files: list[list[str]]):
        self.files = files

    def partitions(self) -> list[FilePartition]:
        return [FilePartition(*file) for file in self.files]

    def read(self, partition: FilePartition) -> Iterator[tuple[str, str, str]]:
        yield partition.file, partition.name, streamed(partition.path)


class FileDigests(DataSource):
    """Option `files`: JSON lists of a file's identity, its name and the path to open it by."""

    @classmethod
    def name(cls) -> str:
        return "tillroll_file_digests"

    def schema(self) -> str:
        return "file string, name string, sha256 string"

    def reader(self, schema) -> DigestReader:
        return DigestReader(json.loads(self.options["files"]))


def _resolved(spark: SparkSession, path: str) -> str:
    """The path behind a mount point of the Hadoop configuration."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).resolvePath(own).toString()


def file_digests(spark: SparkSession, paths: list[str], largest_cell: int = LARGEST_CELL) -> DataFrame:
    """Full path, name and SHA-256 of every file. A file's identity is its path: files of one name
    in several folders are several files. Empty files, which hold no lines, are left out. Only the
    names of large files reach the driver. Large files need this package on the executors."""
    files = spark.read.format("binaryFile").load(paths)
    identity = F.col("_metadata.file_path")
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))
    cells = files.filter(F.col("length") <= largest_cell).select(
        identity.alias("file"), name.alias("name"), F.sha2("content", 256).alias("sha256")
    )
    large = files.filter(F.col("length") > largest_cell).select(identity.alias("file"), name.alias("name"), "path")
    listed = [[row.file, row.name, _resolved(spark, row.path)] for row in large.collect()]
    if not listed:
        return cells
    spark.dataSource.register(FileDigests)
    return cells.unionByName(spark.read.format(FileDigests.name()).option("files", json.dumps(listed)).load())
