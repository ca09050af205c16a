"""Digests of files of any size, in bounded memory."""

import hashlib
import tracemalloc

import pytest

from scenarios import PARAMS
from test_run import NEW, OLD, write_csv
from tillroll.sources import digests, ingest


def test_small_and_large_files_have_the_digest_of_hashlib(spark, tmp_path):
    wanted = {}
    for name, size in (("empty", 0), ("one", 1), ("at the limit", 1000), ("a b+c%20é", 1001), ("large", 70_000)):
        data = bytes(i * 7 % 256 for i in range(size))
        (tmp_path / name).write_bytes(data)
        wanted[name] = hashlib.sha256(data).hexdigest()
    found = digests.file_digests(spark, [str(tmp_path)], largest_cell=1000)
    del wanted["empty"]
    assert {r["name"]: r.sha256 for r in found.collect()} == wanted
    all_cells = digests.file_digests(spark, [str(tmp_path)])
    assert sorted(map(tuple, all_cells.collect())) == sorted(map(tuple, found.collect()))


def test_a_file_is_streamed_in_bounded_memory(tmp_path):
    path = tmp_path / "sparse"
    with path.open("wb") as out:
        out.truncate(64 << 20)
    tracemalloc.start()
    digest = digests.streamed(f"file:{path}", chunk=1 << 20)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert digest == hashlib.sha256(bytes(64 << 20)).hexdigest()
    assert peak < 4 << 20


def test_a_file_beyond_two_gigabytes(spark, tmp_path):
    path = tmp_path / "beyond.bin"
    with path.open("wb") as out:
        out.truncate((1 << 31) + 12_345)  # a sparse file: its blocks are not stored
        out.seek((1 << 31) + 100)
        out.write(b"the end")
    wanted = hashlib.sha256()
    with path.open("rb") as stream:
        while piece := stream.read(1 << 24):
            wanted.update(piece)
    (row,) = digests.file_digests(spark, [str(path)]).collect()
    assert (row["name"], row.sha256) == ("beyond.bin", wanted.hexdigest())


def test_each_large_file_is_a_task(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}").write_bytes(bytes(2000))
    found = digests.file_digests(spark, [str(tmp_path)], largest_cell=0)
    streamed = spark.read.format(digests.FileDigests.name()).option("files", '[["a", "a", "x"], ["b", "b", "y"]]')
    assert streamed.load().rdd.getNumPartitions() == 2
    assert found.count() == 3


def test_a_load_refuses_a_large_file_whose_digest_differs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digests.file_digests, "__defaults__", (100,))
    row = ("536365", "85123A", "x", "6", "2010-12-01 08:26:00", "2.55", "17850", "France")
    paths = {sheet: write_csv(tmp_path / f"{k}.csv", [(2, *row)] * 3) for k, sheet in enumerate((OLD, NEW))}
    good = {p: hashlib.sha256(open(p, "rb").read()).hexdigest() for p in paths.values()}
    root = str(tmp_path / "store")
    assert ingest.load(spark, paths, root, PARAMS.batches, expected=good).count() == 6
    assert {r.sha256 for r in ingest.load_log(spark, root).collect()} == set(good.values())
    with pytest.raises(ingest.LoadError, match="in 1 files"):
        ingest.load(spark, paths, root, PARAMS.batches, expected=good | {paths[OLD]: "0" * 64})
