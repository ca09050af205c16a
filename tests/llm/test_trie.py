"""The prefix trie against a plain version, with small shards, blocks and queues."""

import binascii
import hashlib
import random
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tillroll.llm import oracles, trie
from tillroll.workspace import Workspace

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """The contract, said plainly."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = binascii.crc32(str(c).encode()) % 4
        family = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(family, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
            if d:
                children[built[c][: d - 1]].add(built[c][:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    out = []
    for node, own_ in members.items():
        ends = ",".join(str(c) for c in own_ if len(built[c]) == len(node))
        out.append(
            (
                own_[0], len(node), members[node[:-1]][0] if node else None, len(own_), len(children[node]),
                leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def talk(seed, n, words=3, convs=None):
    """Conversations of few distinct turns, so that many share openings."""
    own = random.Random(seed)
    rows = []
    for c in convs or range(n):
        for turn in range(own.randint(1, 7)):
            text = " ".join(own.choices(("so", "why", "yes\tno", "well"), k=own.randint(1, words)))
            rows.append((c, turn, own.choice(("user", "assistant")), text))
    own.shuffle(rows)
    return rows


def found(spark, rows, **small):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, trie.conversation_trie(frame, **small).collect()), key=str)


@pytest.mark.parametrize("shard", [4, 50, 1 << 15])
def test_as_by_brute_force(spark, shard):
    rows = talk(1, 160, words=2)
    assert found(spark, rows, shard=shard, queue=3) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "hello there"), (1, 0, "user", "hello there"), (1, 0, "tool", "tie"), (1, None, None, None),
        (1, None, "user", "null turn is first"), (2, 5, None, "text"), (2, 5, "", "text"), (-3, 1, "user", "negative"),
        (-21, 1, "a", "b"), (-20, -1, "a", "c"), (None, 0, "user", "no conversation"), (20, 0, "ab", "c"),
        (24, 0, "a", "bc"), (40, 0, "x", ""), (41, 1, "x", None), (60, 0, "user", "long " * 20_000),
        (61, 0, "user", "long " * 20_000), (80, 0, "日本", "\x00\n"), (9, 0, "u", "only opening"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, shard=2, block=1, queue=1) == brute(rows)


def test_no_conversations(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


def test_other_columns_are_not_read(spark):
    rows = talk(2, 12)
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = frame.withColumns({c: F.lit("own") for c in ("id", "pos", "slice", "digest", "words", "level", "h", "n")})
    assert sorted(map(tuple, trie.conversation_trie(clashing).collect()), key=str) == brute(rows)


def test_a_long_conversation_is_many_blocks(spark):
    own = random.Random(3)
    rows = [(7, k, "user", own.choice("abc")) for k in range(300)]
    rows += [(27, k, "user", t) for _, k, _, t in rows[:200]] + [(47, k, "user", "z") for k in range(40)]
    rows += talk(4, 0, convs=[0, 20, 40])
    assert found(spark, rows, block=16, shard=30, queue=8) == brute(rows)


def test_a_hot_conversation_is_found_in_full(spark):
    rows = [(c, k, "user", f"turn {k}") for c in range(300) for k in range(3)] + talk(5, 0, convs=range(300, 400))
    assert found(spark, rows, shard=20) == brute(rows)


def test_numbering_across_slices(spark):
    rows = [(5, k // 2, "user", f"t{k}") for k in range(400)] + [(c, 0, "user", "x") for c in range(6, 60)]
    turns = trie.numbered(spark.createDataFrame(rows, SCHEMA).repartition(7), Workspace(spark))
    places = [r.pos for r in turns.filter("conv_id = 5").orderBy("pos").collect()]
    assert places == list(range(1, 401))


def test_members_of_a_node_are_joined_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "JOINED", 1)  # in the driver; the workers get the default
    rows = [(c, 0, "user", "same") for c in range(0, 2000, 20)]
    assert found(spark, rows) == brute(rows)


def test_the_queue_spills_and_stays_in_order():
    own = random.Random(6)
    queue, plain = trie.SpillingQueue(5), []
    for k in range(2000):
        item = (own.randint(-50, 50), own.randint(0, 9), k, 1)
        queue.push(item)
        plain.append(item)
        if own.random() < 0.4:
            plain.sort()
            assert queue.top() == plain[0]
            assert queue.pop() == plain.pop(0)
    assert len(queue.runs) > 10 and len(queue.heap) <= 5
    out = []
    while queue.top():
        out.append(queue.pop())
    assert out == sorted(plain)
    assert queue.top() is None


def test_blocks_of_members_are_hashed_as_one_list():
    import pyarrow as pa

    rows = [(1, 0, c) for c in (3, 5, 10)] + [(1, 2, 4)] + [(8, 1, c) for c in range(90, 110)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("id", "level", "conv_id"), r, strict=True)) for r in part])
               for part in (rows[:2], rows[2:9], rows[9:])]
    joined = list(trie._joined(iter(batches)))
    cut = [b.slice(0).to_pylist()[0] for b in joined]
    split = []
    for row in cut:  # each block cut in two
        ids = row["ids"].split(",")
        half = len(ids) // 2
        parts = [ids[:half], ids[half:]] if half else [ids]
        split += [row | {"first": int(p[0]), "ids": ",".join(p)} for p in parts]
    out = list(trie._digests(iter([pa.RecordBatch.from_pylist(split[:3], trie._IDS), pa.RecordBatch.from_pylist(split[3:], trie._IDS)])))
    got = {(r["id"], r["level"]): r["ends_sha256"] for b in out for r in b.to_pylist()}
    want = defaultdict(list)
    for i, level, c in rows:
        want[i, level].append(str(c))
    assert got == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}


def test_the_sql_is_the_brute_force_too():
    rows = talk(8, 90) + [(None, 1, "a", "b"), (300, None, None, None), (-5, 0, "user", "x"), (-25, 2, "user", "x")]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    duck.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(duck.sql(oracles.PREFIX_TRIE).fetchall(), key=str) == brute(rows)
