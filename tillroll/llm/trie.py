"""Conversation prefix trie: every distinct sequence of first turns is a node, with figures of the
conversations that share it and of the subtree below it.

* Turns are numbered over slices of a global sort, and the identity of a prefix is a running sum of
  128 hashed bits of each turn and its place, over blocks of a conversation; the counts and sums of
  earlier slices and blocks are added, so a conversation with a third of all turns is many tasks.
* A node is named by its smallest member and its depth. The nodes with one smallest member are
  a path, and its parent path has a smaller one; ranges of that name are the shards.
* Subtree totals go up by time-forward processing. Within a shard the nodes come sorted by reverse
  level; each takes the messages addressed to it off a priority queue, which spills to sorted
  runs, and sends its total to its parent. What a shard's own roots gather goes on across shards:
  the roots that hear from others form a smaller tree, whose totals are found in the same way, and
  a second pass within the shards then has every message from outside.
* Members that end at a node are joined in order, in blocks of a range sort, and a node's blocks
  are hashed one after the other.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.workspace import Workspace

#: Turns of one conversation whose running sum one task builds.
BLOCK = 1 << 16
#: Nodes of a shard, about.
SHARD = 1 << 15
#: Messages that a queue holds in memory.
QUEUE = 1 << 16
#: Bytes of joined conv_ids in a row.
JOINED = 1 << 20
#: Conversations c - c % FAMILY .. share openings of fewer than OPENINGS turns.
FAMILY, OPENINGS = 20, 4

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def numbered(conversations: DataFrame, workspace: Workspace) -> DataFrame:
    """conv_id, pos (from 1), digest (of role and text), words (of the text): each turn once.

    Turns are ordered by turn, null first; ties are ordered by the digest, so that the result does
    not depend on how rows are stored, and equal rows are turns of their own. Null role or text
    counts as empty. Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    own = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = ["conv_id", "turn", "digest"]
    sliced = workspace.store(
        own.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "tie")
        .drop("tie")
        .withColumn("slice", F.spark_partition_id()),
        "slices",
    )
    # A slice shares its first and its last conversation with others, so at most two rows a slice
    # of `before` differ from nought.
    sizes = sliced.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.sum("size").over(earlier)).filter("before IS NOT NULL").drop("size")
    before = workspace.store(before, "before")
    place = F.row_number().over(Window.partitionBy("conv_id", "slice").orderBy("turn", "digest"))
    return workspace.store(
        sliced.withColumn("place", place)
        .join(F.broadcast(before), ["conv_id", "slice"], "left")
        .select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "words"),
        "numbered",
    )


def opening(conv_id: Column) -> Column:
    """How many first turns a conversation has from the first one of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % OPENINGS


def with_shared_openings(turns: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """Numbered turns with each conversation's first ones taken from conversation c - c % FAMILY,
    and all conversations (conv_id, n_turns), those left without a turn too.

    Fewer turns there, or none, give fewer; c % FAMILY has the sign of c.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    firsts = sizes.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.col("n").alias("n_first")
    )
    convs = (
        sizes.withColumns({"family": family, "h": opening(F.col("conv_id"))})
        .join(firsts, "family", "left")
        .withColumn("given", F.least("h", F.coalesce("n_first", F.lit(0))))
        .withColumn("n_turns", F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    convs = workspace.store(convs.select("conv_id", "family", "h", "given", "n_turns"), "conversations")
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < OPENINGS)).withColumnRenamed(
        "conv_id", "family"
    )
    given = heads.join(convs, "family").filter("pos <= given")
    own = turns.join(convs, "conv_id").filter("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("given"))
    columns = ["conv_id", "n_turns", "pos", "digest", "words"]
    rebuilt = workspace.store(given.select(columns).unionByName(own.select(columns)), "rebuilt")
    return rebuilt, convs.select("conv_id", "n_turns")


_LANES = ("s0", "s1", "s2", "s3")


def _prefixes(turns: DataFrame, workspace: Workspace, block: int) -> DataFrame:
    """A row for each turn: conv_id, depth, words, end, and the names k1, k2 of the prefix that it
    ends and p1, p2 of the one before it.

    A name is made of four running sums of 32 bits of each turn's hash with its place.
    """
    hashes = [F.xxhash64(F.lit(k), "pos", "digest") for k in (1, 2)]
    lanes = [x for h in hashes for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1)))]
    own = turns.select(
        "conv_id",
        F.col("pos").alias("depth"),
        "words",
        (F.col("pos") == F.col("n_turns")).alias("end"),
        F.expr(f"(pos - 1) div {block}").alias("block"),
        *[x.alias(f"x{k}") for k, x in enumerate(lanes)],
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = own.withColumns({s: F.sum(f"x{k}").over(so_far) for k, s in enumerate(_LANES)})
    sums = workspace.store(summed, "sums")
    # Only conversations longer than a block have blocks before another one.
    long_ = sums.filter("block > 0").select("conv_id").distinct()
    totals = sums.join(long_, "conv_id", "left_semi").groupBy("conv_id", "block")
    totals = totals.agg(*[F.max(s).alias(f"t{s}") for s in _LANES])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("conv_id", "block", *[F.sum(f"t{s}").over(earlier).alias(f"b{s}") for s in _LANES])
    later = sums.filter("block > 0").join(before, ["conv_id", "block"])
    later = later.withColumns({s: F.col(s) + F.col(f"b{s}") for s in _LANES}).select(sums.columns)
    rows = sums.filter("block = 0").unionByName(later)

    def name(parts: list[Column]) -> list[Column]:
        return [F.shiftleft(parts[k], 32).bitwiseXOR(parts[k + 1]) for k in (0, 2)]

    here = name([F.col(s) for s in _LANES])
    above = name([F.col(s) - F.col(f"x{k}") for k, s in enumerate(_LANES)])
    return rows.select(
        "conv_id", "depth", "words", "end",
        here[0].alias("k1"), here[1].alias("k2"), above[0].alias("p1"), above[1].alias("p2"),
    )


class SpillingQueue:
    """A priority queue of tuples that holds at most `most` of them in memory.

    The rest lies in sorted runs, each in an unnamed file of the task's own that goes with it; a
    task that runs again writes its runs again.
    """

    def __init__(self, most: int = QUEUE):
        self.most = most
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        self.heap.sort()
        size = max(1, self.most // 16)
        for start in range(0, len(self.heap), size):
            pickle.dump(self.heap[start : start + size], file)
        file.seek(0)
        self.heap = []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        following = next(self.runs[run], None)
        if following is not None:
            heapq.heappush(self.heads, (following, run))

    def top(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, run = heapq.heappop(self.heads)
            self._advance(run)
            return item
        return heapq.heappop(self.heap)


_TOTALS = (
    "id long, level long, root_id long, root_level long, parent_id long, parent_level long, leaves long, saved long"
)
_TOTALS_SCHEMA = pa.schema([(part.split()[0], pa.int64()) for part in _TOTALS.split(", ")])


def _shard_totals(queue: int):
    """Rows sorted by shard, reverse level and id to totals within the shard.

    root_id, root_level: the topmost node of the shard that a node is below of (or is).
    """

    def send(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        roots: dict[tuple, tuple] = {}
        for level, id_, parent_level, parent, _, _ in reversed(rows):
            roots[level, id_] = roots.get((parent_level, parent), (level, id_))
        for start in range(0, len(rows), 1 << 14):
            out = []
            for level, id_, parent_level, parent, leaves, saved in rows[start : start + (1 << 14)]:
                root_level, root = roots[level, id_]
                out.append((id_, level, root, root_level, parent, parent_level, leaves, saved))
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=_TOTALS_SCHEMA)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, messages = None, [], SpillingQueue(queue)
        for batch in batches:
            for own, id_, level, parent, parent_level, leaves, saved in zip(
                *[batch.column(c).to_pylist() for c in _NODE], strict=True
            ):
                if own != shard:
                    yield from send(rows)
                    shard, rows, messages = own, [], SpillingQueue(queue)
                here = (-level, id_)
                # What was sent to a node of another shard is passed over.
                while (message := messages.top()) and message[:2] <= here:
                    messages.pop()
                    if message[:2] == here:
                        leaves += message[2]
                        saved += message[3]
                rows.append((level, id_, parent_level, parent, leaves, saved))
                if parent is not None:
                    messages.push((-parent_level, parent, leaves, saved))
        yield from send(rows)

    return totals


_NODE = ("shard", "id", "level", "parent_id", "parent_level", "leaves", "saved")


def subtree_totals(
    tree: DataFrame,
    workspace: Workspace,
    name: str = "tree",
    shard: int = SHARD,
    block: int = BLOCK,
    queue: int = QUEUE,
) -> DataFrame:
    """id, level, leaves, saved: the sums over each node's subtree, its own figures included.

    tree: id, level (together a node), parent_id, parent_level (a smaller level; null at a root),
    leaves, saved. Each round over shard roots leaves out those that no other shard sends to, so
    there are at most as many rounds as levels, and few when families lie in one shard.
    """
    n = tree.count()
    if n <= shard:
        dealt = tree.withColumn("shard", F.lit(0))
    else:
        by = F.expr(f"level div {block}")
        dealt = tree.repartitionByRange(-(-n // shard), F.col("id"), by).withColumn("shard", F.spark_partition_id())
    dealt = workspace.store(dealt.select(*_NODE), f"{name}_shards")

    def within(rows: DataFrame) -> DataFrame:
        order = ["shard", F.col("level").desc(), "id"]
        return (
            rows.select(*_NODE)
            .repartition("shard")
            .sortWithinPartitions(*order)
            .mapInArrow(_shard_totals(queue), _TOTALS)
        )

    found = workspace.store(within(dealt), f"{name}_within")
    result = ["id", "level", "leaves", "saved"]
    if n <= shard:
        return found.select(result)
    root = ["root_id", "root_level"]
    roots = found.filter("id = root_id AND level = root_level")
    above = found.select(
        F.col("id").alias("parent_id"), F.col("level").alias("parent_level"),
        F.col("root_id").alias("to_id"), F.col("root_level").alias("to_level"),
    )
    links = workspace.store(roots.select(*root, "parent_id", "parent_level", "leaves", "saved")
                            .join(above, ["parent_id", "parent_level"]), f"{name}_links")
    heard = links.select(F.col("to_id").alias("root_id"), F.col("to_level").alias("root_level")).distinct()
    heard = workspace.store(heard, f"{name}_heard")
    silent = links.join(heard, root, "left_anti")
    sent = silent.groupBy(F.col("to_id").alias("root_id"), F.col("to_level").alias("root_level"))
    sent = sent.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    inner = (
        roots.select(*root, "leaves", "saved")
        .join(heard, root, "left_semi")
        .join(sent, root, "left")
        .join(links.select(*root, "to_id", "to_level"), root, "left")
        .select(
            F.col("root_id").alias("id"),
            F.col("root_level").alias("level"),
            F.col("to_id").alias("parent_id"),
            F.col("to_level").alias("parent_level"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
    )
    whole = subtree_totals(workspace.store(inner, f"{name}_inner"), workspace, f"{name}_up", shard, block, queue)
    whole = whole.select(
        F.col("id").alias("root_id"), F.col("level").alias("root_level"),
        F.col("leaves").alias("whole_leaves"), F.col("saved").alias("whole_saved"),
    )
    messages = (
        links.join(whole, root, "left")
        .groupBy(F.col("parent_id").alias("id"), F.col("parent_level").alias("level"))
        .agg(
            F.sum(F.coalesce("whole_leaves", "leaves")).alias("more_leaves"),
            F.sum(F.coalesce("whole_saved", "saved")).alias("more_saved"),
        )
    )
    told = dealt.join(workspace.store(messages, f"{name}_messages"), ["id", "level"], "left")
    told = told.withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")})
    return workspace.store(within(told), f"{name}_whole").select(result)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and member to rows of many members each: id, level, first, ids."""
    node, first, ids, size = None, 0, [], 0

    def block() -> pa.RecordBatch:
        values = [[node[0]], [node[1]], [first], [",".join(ids)]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _IDS.types, strict=True)], schema=_IDS)

    for batch in batches:
        for id_, level, member in zip(*[batch.column(c).to_pylist() for c in ("id", "level", "conv_id")], strict=True):
            if (id_, level) != node or size >= JOINED:
                if ids:
                    yield block()
                node, first, ids, size = (id_, level), member, [], 0
            ids.append(str(member))
            size += len(ids[-1]) + 1
    if ids:
        yield block()


_IDS = pa.schema([("id", pa.int64()), ("level", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by node and first member to the SHA-256 of a node's blocks, comma-joined."""
    node, digest, out = None, None, []

    def send() -> pa.RecordBatch:
        ids, levels, values = zip(*out, strict=True)
        return pa.RecordBatch.from_pydict({"id": ids, "level": levels, "ends_sha256": values}, _ENDS)

    for batch in batches:
        for id_, level, ids in zip(*[batch.column(c).to_pylist() for c in ("id", "level", "ids")], strict=True):
            if (id_, level) == node:
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (id_, level), hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield send()
            out = []
    if node:
        out.append((*node, digest.hexdigest()))
        yield send()


_ENDS = pa.schema([("id", pa.int64()), ("level", pa.int64()), ("ends_sha256", pa.string())])


def _ends(members: DataFrame) -> DataFrame:
    """id, level, ends_sha256 of the nodes where a conversation (conv_id) ends."""
    joined = (
        members.repartitionByRange("id", "level", "conv_id")
        .sortWithinPartitions("id", "level", "conv_id")
        .mapInArrow(_joined, "id long, level long, first long, ids string")
    )
    return (
        joined.repartition("id", "level")
        .sortWithinPartitions("id", "level", "first")
        .mapInArrow(_digests, "id long, level long, ends_sha256 string")
    )


def prefix_trie(
    turns: DataFrame,
    convs: DataFrame,
    workspace: Workspace,
    shard: int = SHARD,
    block: int = BLOCK,
    queue: int = QUEUE,
) -> DataFrame:
    """One row per node of the trie of conversations.

    turns: conv_id, n_turns, pos (1 to n_turns), digest, words; convs: conv_id (once each),
    n_turns (nought allowed). Result: conv_id (the smallest member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Without conversations there
    is no node. Equal conversations are members of the same nodes; a turn of any length is one
    digest. Runs jobs and writes to the shared folder when called.
    """
    prefixes = workspace.store(_prefixes(turns, workspace, block), "prefixes")
    nodes = prefixes.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("id"),
        F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in ("p1", "p2", "words")],
    )
    nodes = workspace.store(nodes, "nodes")
    top = convs.agg(F.min("conv_id").alias("id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    top = workspace.store(top, "top")
    root = top.select(F.col("id"), F.lit(0).cast("long").alias("level"), F.lit(None).cast("long").alias("parent_id"),
                      "n_convs", F.lit(0).cast("long").alias("words"))
    root_id = top.first()
    columns = ["id", F.col("depth").alias("level"), "parent_id", "n_convs", "words"]
    firsts = nodes.filter("depth = 1").withColumn("parent_id", F.lit(root_id["id"] if root_id else None).cast("long"))
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent_id")
    )
    deeper = nodes.filter("depth > 1").join(above, ["depth", "p1", "p2"])
    tree = root.unionByName(firsts.select(columns)).unionByName(deeper.select(columns))
    tree = workspace.store(tree, "trie")
    below = tree.filter("level > 0").groupBy(F.col("parent_id").alias("id"), (F.col("level") - 1).alias("level"))
    tree = tree.join(below.agg(F.count(F.lit(1)).alias("n_children")), ["id", "level"], "left")
    tree = workspace.store(tree.fillna(0, ["n_children"]), "counted")
    totals = subtree_totals(
        tree.select(
            "id",
            "level",
            "parent_id",
            F.when(F.col("level") > 0, F.col("level") - 1).alias("parent_level"),
            (F.col("n_children") == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ),
        workspace,
        "totals",
        shard,
        block,
        queue,
    )
    ended = prefixes.filter("end").select("conv_id", "depth", "k1", "k2")
    names = nodes.select("depth", "k1", "k2", "id")
    members = ended.join(names, ["depth", "k1", "k2"]).select("id", F.col("depth").alias("level"), "conv_id")
    turnless = convs.filter("n_turns = 0").select(
        F.lit(root_id["id"] if root_id else None).cast("long").alias("id"), F.lit(0).cast("long").alias("level"), "conv_id"
    )
    ends = workspace.store(_ends(members.unionByName(turnless)), "ends")
    return (
        tree.join(totals, ["id", "level"])
        .join(ends, ["id", "level"], "left")
        .select(
            F.col("id").alias("conv_id"),
            F.col("level").alias("depth"),
            F.col("parent_id").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )


def conversation_trie(
    conversations: DataFrame,
    workspace: Workspace | None = None,
    shard: int = SHARD,
    block: int = BLOCK,
    queue: int = QUEUE,
) -> DataFrame:
    """The trie of all conversations with shared openings; see prefix_trie for the columns, and
    numbered for order, ties and nulls. Columns beside conv_id, turn, role and text are not read."""
    workspace = workspace or Workspace(conversations.sparkSession)
    turns, convs = with_shared_openings(numbered(conversations, workspace), workspace)
    return prefix_trie(turns, convs, workspace, shard, block, queue)
