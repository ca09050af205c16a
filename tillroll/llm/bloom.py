"""Bloom filters as DataFrames, built and probed with DataFrame functions.

A hash has one slot in each of two bit tables. The tables are sized from the counted rows, about
ROOM slots for each, and are broadcast in chunks of CHUNK words of 64 bits: slots / 4 bytes for
both, 256 MB at LARGEST, whatever the input. Beyond some 130 million rows the tables stay as
large, and a filter only lets more rows through that its user then looks at in full.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import own_names, quoted
from tillroll.workspace import Workspace

#: Slots for each row, about, and the least and the most of each table (powers of two).
ROOM, LEAST, LARGEST = 8, 1 << 16, 1 << 30
#: Words of a chunk (a power of two).
CHUNK = 1 << 10


def slots_for(rows: int) -> int:
    """A power of two."""
    return min(LARGEST, max(LEAST, 1 << (ROOM * max(rows, 1) - 1).bit_length()))


@dataclass(frozen=True)
class Filter:
    """chunks: table (0 or 1), chunk, bits (CHUNK words, or all of a smaller table)."""

    chunks: DataFrame
    slots: int

    @property
    def words(self) -> int:
        """Of a chunk."""
        return min(CHUNK, self.slots >> 6)


def _slots(hash_: Column, slots: int) -> list[Column]:
    low = hash_.bitwiseAND(F.lit(slots - 1))
    return [low, F.shiftrightunsigned(hash_, 32).bitwiseAND(F.lit(slots - 1))]


def bit_filter(
    hashes: DataFrame,
    workspace: Workspace,
    name: str,
    least_rows: int = 1,
    rows: int | None = None,
    slots: int | None = None,
) -> Filter:
    """The filter of a column `hash`: a bit is set where at least least_rows rows fell. `rows` is
    how many there are, about; they are counted where it is not known."""
    if slots is None:
        slots = slots_for(hashes.count() if rows is None else rows)
    own = Filter(hashes, slots)
    places = [F.struct(F.lit(i).alias("table"), slot.alias("slot")) for i, slot in enumerate(_slots(F.col("hash"), slots))]
    hit = hashes.select(F.inline(F.array(*places)))
    if least_rows > 1:
        hit = hit.groupBy("table", "slot").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") >= least_rows)
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    found = hit.groupBy("table", F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    # Only words with a bit are stored, by chunk; a chunk is an array with a word at each place.
    own_word = F.struct((F.col("word") % own.words).cast("int").alias("place"), "bits")
    chunks = found.groupBy("table", F.expr(f"word div {own.words}").alias("chunk")).agg(
        F.sort_array(F.collect_list(own_word)).alias("found")
    )
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("found") - 1),
        lambda i: F.array_append(
            F.array_repeat(
                F.lit(0).cast("long"),
                F.get("found.place", i) - F.coalesce(F.get("found.place", i - 1), F.lit(-1)) - 1,
            ),
            F.get("found.bits", i),
        ),
    )
    chunks = chunks.select("table", "chunk", F.flatten(gaps).alias("bits"))
    return Filter(workspace.store(chunks, name), slots)


def probed(frame: DataFrame, hash_: Column, own: Filter, out: str) -> DataFrame:
    """frame with a column `out`: whether both bits of a hash are set (not, where it is null).

    Columns made on the way have names of their own, which no column of frame can have.
    """
    names, found = frame.columns, []
    hash_name, *pairs = own_names("hash", "chunk0", "bits0", "chunk1", "bits1")
    frame = frame.withColumn(hash_name, hash_)
    for i, slot in enumerate(_slots(F.col(hash_name), own.slots)):
        chunk_name, bits_name = pairs[2 * i : 2 * i + 2]
        word = F.shiftright(slot, 6)
        chunk = own.chunks.filter(F.col("table") == i).select(
            F.col("chunk").alias(chunk_name), F.col("bits").alias(bits_name)
        )
        at = F.call_function("div", word, F.lit(own.words))
        frame = frame.join(F.broadcast(chunk), at == F.col(chunk_name), "left")
        place = word.bitwiseAND(F.lit(own.words - 1)).cast("int")
        bits = F.coalesce(F.get(F.col(bits_name), place), F.lit(0).cast("long"))
        bit = F.call_function("shiftrightunsigned", bits, slot.bitwiseAND(F.lit(63)).cast("int"))
        found.append(bit.bitwiseAND(F.lit(1)) == 1)
    return frame.select(*quoted(names), (found[0] & found[1]).alias(out))
