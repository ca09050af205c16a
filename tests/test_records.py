"""CSV with line breaks inside cells: the same rows from one task a file and from many."""

import random

import pytest
from pyspark.sql import functions as F

from test_run import HOSTILE, NEW, OLD, PARAMS, write_csv
from tillroll.schemas import SOURCE_TITLES
from tillroll.sources import ingest, records
from tillroll.workspace import Workspace

CELLS = [
    *HOSTILE, "", '"', '""', '"\n"', "\n", "\n\n\n", 'a,"b",c', "x" * 90, "line one\nline two\n\nline four",
    'ends with "', '\n"starts', ",", ",\n,", "crlf\r\ninside", "tab\t", "日本\n語",
]


def rows_of(seed, n):
    own = random.Random(seed)
    return [
        (i + 2, f"{500000 + i}", own.choice(CELLS), own.choice(CELLS), "6", "2010-12-01 08:26:00", "2.55", "",
         own.choice(CELLS))
        for i in range(n)
    ]


@pytest.fixture
def small_splits(spark):
    """Sets the bytes of a split; undone at the end."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def cells(frame):
    titles = [ingest.ROW_TITLE, *SOURCE_TITLES.values()]
    rows = frame.select(*[F.col(f"`{t}`").cast("string").alias(t) for t in titles]).collect()
    return sorted(map(tuple, rows), key=lambda r: int(r[0]))


@pytest.mark.parametrize("split", [60, 333, 2000])
def test_the_same_rows_from_many_splits(spark, tmp_path, small_splits, split):
    path = write_csv(tmp_path / "lines.csv", rows_of(split, 120))
    whole = cells(ingest.read_csv(spark, path))
    assert len(whole) == 120
    small_splits(split)
    frame = ingest.read_csv(spark, path)
    assert ingest.FILE_TITLE in frame.columns
    assert cells(frame) == whole
    lines = records._lines(spark, path)
    assert lines.rdd.getNumPartitions() > 2


def test_the_cells_are_those_that_were_written(spark, tmp_path, small_splits):
    own = [r for r in rows_of(1, 80) if "\r" not in "".join(map(str, r))]
    path = write_csv(tmp_path / "lines.csv", own)
    small_splits(100)
    read = cells(ingest.read_csv(spark, path))
    assert read == [tuple(str(c) if c != "" else None for c in row) for row in own]


def test_lines_are_numbered_across_splits_and_blank_lines(spark, tmp_path, small_splits):
    titles = ",".join(SOURCE_TITLES.values())
    own = random.Random(3)
    for name in ("one", "two"):
        body = ""
        for i in range(70):
            text = own.choice(("plain", '"two\nlines"', '"a\n\nb"', "plain"))
            body += f"536365,85123A,{text},{i},2010-12-01 08:26:00,2.55,17850,France\n" + own.choice(("", "", "\n"))
        (tmp_path / f"{name}.csv").write_text(titles + "\n" + body)
    small_splits(150)
    frame = ingest.read_csv(spark, f"{tmp_path}/*.csv")
    got = frame.select(ingest.FILE_TITLE, ingest.ROW_TITLE, "Quantity").collect()
    assert len(got) == 140 and all(int(r.Quantity) == r[1] - 2 for r in got)
    assert len({(r[0], r[1]) for r in got}) == 140


def test_a_cell_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {k}" for k in range(400))
    own = [(2, "500001", "A", long, "1", "2010-12-01 08:26:00", "1.00", "", "France"),
           (3, "500002", "B", "after", "1", "2010-12-01 08:26:00", "1.00", "", "France")]
    path = write_csv(tmp_path / "lines.csv", own)
    small_splits(200)
    assert [r[3] for r in cells(ingest.read_csv(spark, path))] == [long, "after"]


def test_lines_without_breaks_are_not_put_together(spark, tmp_path, small_splits):
    own = [(i + 2, "500001", "A", f'say "{i}"', "1", "2010-12-01 08:26:00", "1.00", "", "France") for i in range(90)]
    path = write_csv(tmp_path / "lines.csv", own)
    small_splits(300)
    with Workspace(spark) as workspace:
        found = records.records(spark, path, workspace)
        assert spark.read.parquet(workspace.path("marked")).isEmpty()
        assert sorted(r.number for r in found.collect()) == list(range(1, 92))


def test_quotes_that_do_not_balance_are_refused(spark, tmp_path, small_splits):
    path = tmp_path / "lines.csv"
    path.write_text(",".join(SOURCE_TITLES.values()) + "\n" + '1,2,5" tile,4,5,6,7,8\n' * 31)
    small_splits(100)
    with pytest.raises(records.QuoteError, match="lines.csv"):
        ingest.read_csv(spark, str(path))


def test_batches_of_large_files(spark, tmp_path, small_splits):
    paths = {sheet: write_csv(tmp_path / f"{k}.csv", rows_of(k, 60)) for k, sheet in enumerate((OLD, NEW))}

    def batches():
        read = ingest.read_batches(spark, paths, PARAMS.batches)
        return sorted(map(str, read.collect()))

    whole = batches()
    small_splits(400)
    assert batches() == whole
