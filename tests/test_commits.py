"""The commit log: one order for all writers, whatever their clocks, and no half-made commits."""

import os
import threading
import time
import uuid
from pathlib import Path

import pytest

from scenarios import PARAMS, raw_of
from test_run import full_base, log_of
from tillroll import commits
from tillroll.commits import CommitConflict, CommitLog
from tillroll.plans import publish
from tillroll.reference_data import non_product_codes
from tillroll.sources import ingest


@pytest.fixture(params=["linked", "created"])
def log(request, spark, tmp_path, monkeypatch):
    """Both ways to make an entry: a hard link, and a create that refuses to overwrite."""
    if request.param == "created":
        monkeypatch.setattr(CommitLog, "_is_local", lambda self: False)
    return CommitLog(spark, f"{tmp_path}/log")


def test_numbers_ids_and_facts(log):
    assert log.newest() is None and log.head() == 0 and log.entries().isEmpty()
    assert log.commit("a", {"tables": "x,y"}).number == 1
    assert log.commit("b").number == 2
    assert log.newest().id == "b"
    assert [(r.number, r.id, r.facts) for r in log.entries().orderBy("number").collect()] == [
        (1, "a", {"tables": "x,y"}), (2, "b", {}),
    ]


def test_many_writers_at_once_get_a_number_each(spark, tmp_path):
    numbers, threads = [], []

    def write(k):
        own = CommitLog(spark, f"{tmp_path}/log")
        numbers.extend((own.commit(f"{k}.{i}").number, f"{k}.{i}") for i in range(8))

    for k in range(5):
        threads.append(threading.Thread(target=write, args=(k,)))
        threads[-1].start()
    for thread in threads:
        thread.join()
    log = CommitLog(spark, f"{tmp_path}/log")
    assert sorted(n for n, _ in numbers) == list(range(1, 41))
    assert {(r.number, r.id) for r in log.entries().collect()} == set(numbers)


def test_a_number_is_never_given_twice(log):
    log.commit("a")
    assert not log._create(1, "b", {})
    assert log.newest().id == "a"
    stale = log.numbers
    log.numbers = lambda: []  # a writer that has not seen the first entry
    assert log.commit("b").number == 2
    log.numbers = stale
    assert [r.id for r in log.entries().orderBy("number").collect()] == ["a", "b"]


def test_a_commit_may_be_refused(log):
    log.commit("a", after=0)
    for known in (0, 2):
        with pytest.raises(CommitConflict):
            log.commit("b", after=known)
    assert log.commit("b", after=1).number == 2
    assert log.entries().count() == 2


def test_an_entry_without_an_end_is_no_commit(log):
    log.commit("a")
    for number, text in ((2, ""), (3, '{"number": 3, "id": "c", "fa')):
        Path(f"{log.folder}/{number:012d}.json").write_text(text)
    assert log.newest().id == "a" and log.head() == 3
    assert [r.id for r in log.entries().collect()] == ["a"]
    assert log.commit("d").number == 4
    assert log.newest().id == "d"


def test_clocks_decide_nothing(log, monkeypatch):
    log.commit("right clock")
    monkeypatch.setattr(commits.time, "gmtime", lambda: time.struct_time((1999, 1, 1, 0, 0, 0, 4, 1, 0)))
    log.commit("clock is behind")
    assert log.newest().id == "clock is behind"
    times = [r.committed_at for r in log.entries().orderBy("number").collect()]
    assert times[1] < times[0]


def test_folders_without_a_commit_go_when_they_are_old(log, tmp_path):
    runs = tmp_path / "runs"
    for name, hours in (("committed", 50), ("refused", 50), ("at work", 0)):
        (runs / name / "table").mkdir(parents=True)
        (runs / name / "table" / "part").write_text("x")
        for path in (runs / name / "table" / "part", runs / name):
            then = time.time() - hours * 3600
            os.utime(path, (then, then))
    os.utime(runs / "at work", (0, 0))  # the folder is old, a file in it is not
    log.commit("committed")
    assert log.remove_uncommitted(str(runs), 24) == ["refused"]
    assert sorted(p.name for p in runs.iterdir()) == ["at work", "committed"]
    assert log.remove_uncommitted(f"{tmp_path}/nothing", 24) == []


def test_two_runs_that_publish_at_once(spark, tmp_path):
    root, codes, lines = str(tmp_path), non_product_codes(spark), full_base()
    raw, registry, done = raw_of(spark, lines), log_of(spark, len(lines)), []

    def run(after):
        try:
            done.append(publish.process(raw, codes, registry, PARAMS, root, after=after).run_id)
        except CommitConflict:
            done.append(None)

    threads = [threading.Thread(target=run, args=(after,)) for after in (None, None)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    listed = publish.published(spark, root).orderBy("number").collect()
    assert [r.number for r in listed] == [1, 2] and {r.run_id for r in listed} == set(done)
    assert publish.current(spark, root).run_id == listed[-1].run_id

    done.clear()
    threads = [threading.Thread(target=run, args=(after,)) for after in (2, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(x is None for x in done) == [False, True]
    assert publish.published(spark, root).count() == 3
    assert {p.name for p in (tmp_path / "runs").iterdir()} > {r.run_id for r in listed}
    (refused,) = publish.remove_unpublished(spark, root, older_than_hours=0)
    assert refused not in {r.run_id for r in publish.published(spark, root).collect()}
    assert publish.current(spark, root).table("customer").count() == 25


def test_a_reader_sees_committed_loads_only(spark, tmp_path, monkeypatch):
    raw = raw_of(spark, full_base()[:5])
    digests = spark.createDataFrame([("f", "f", "0" * 64)], "file string, name string, sha256 string")
    root = str(tmp_path)
    with pytest.raises(LookupError):
        ingest.current_raw(spark, root)
    ingest.register(raw, digests, root)

    def broken(*_):
        raise OSError("the driver dies")

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", broken)
        with pytest.raises(OSError):
            ingest.register(raw.limit(1), digests, root)
    assert ingest.current_raw(spark, root).count() == 5
    assert [r.number for r in ingest.load_log(spark, root).collect()] == [1]
    assert len(ingest.remove_unloaded(spark, root, older_than_hours=0)) == 1
    assert ingest.current_raw(spark, root).count() == 5


def test_nothing_published(spark, tmp_path):
    with pytest.raises(LookupError):
        publish.current(spark, f"{tmp_path}/{uuid.uuid4().hex}")
