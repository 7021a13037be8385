"""Operator 8: shards by minimax contiguous partition.

Rows with equal texts form a group that stays together. Groups have an order (by a hash of their text), and the shards
are runs of this order: the smallest capacity is sought for which cutting greedily needs no more than the given number
of XX
The order is far too long for the driver. It gets the sizes of ranges of the order, 2 ** 16 at first. Greedy cutting
with ranges kept whole gives a capacity that surely suffices, cutting as if ranges could be divided anywhere gives one
that surely is needed; only ranges in which a cut can fall between the two are fetched again in 2 ** 8 parts each,
until these are single groups. What the driver holds depends on the number of shards, not on the rows.
"""

from __future__ import annotations

from bisect import bisect_right
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.llm.tables import kept

SHARDS = 24
KEY_BITS = 63  # so that keys are not negative and their order is that of their bits
FIRST_BITS = 16
MORE_BITS = 8
SLOT_PARTS = 1024  # parts of a shard in which rows are numbered


class Piece(NamedTuple):
    """A range of the order: first key, bits that its keys share, total size, largest and number of its groups."""

    key: int
    bits: int
    size: int
    largest: int
    groups: int


def _cuts_whole(sizes: list[int], capacity: int, shards: int) -> list[int] | None:
    """Number of pieces before each cut if pieces stay whole; None if the shards do not suffice."""
    ends = np.cumsum(np.array(sizes, dtype=object)).tolist() if sizes else []
    cuts, at, done = [], 0, 0
    while at < len(ends):
        to = bisect_right(ends, done + capacity, at)
        if to == at or len(cuts) == shards:
            return None
        cuts.append(to)
        at, done = to, ends[to - 1]
    return cuts


def _least(sizes: list[int], low: int, shards: int) -> int:
    """Smallest capacity from ``low`` on that suffices with whole pieces."""
    low, high = max([low, *sizes]), max(low, sum(sizes), 1)
    while low < high:
        middle = (low + high) // 2
        if _cuts_whole(sizes, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _open(pieces: list[Piece], low: int, high: int, shards: int) -> list[int]:
    """Pieces of several groups in which a cut can fall for a capacity from ``low`` to ``high``."""
    ends = np.cumsum([0] + [p.size for p in pieces], dtype=object).tolist()
    found: set[int] = set()
    early, late = 0, 0
    for _ in range(shards):
        first = max(bisect_right(ends, early + low) - 1, 0)
        late = min(late + high, ends[-1])
        last = min(bisect_right(ends, late) - 1, len(pieces) - 1)
        found.update(i for i in range(first, last + 1) if pieces[i].groups > 1)
        early = ends[first]
        if early >= ends[-1]:
            break
    return sorted(found)


def _fetch(groups: DataFrame, bits: int, shared: int = 0, within: list[int] | None = None) -> list[Piece]:
    """Sizes of the ranges whose keys share ``bits`` bits; ``within``: only those in these ranges of ``shared`` bits."""
    rows = groups if within is None else groups.filter(F.shiftright("key", KEY_BITS - shared).isin(within))
    out = rows.groupBy(F.shiftright("key", KEY_BITS - bits).alias("range")).agg(
        F.sum("size").alias("size"), F.max("size").alias("largest"), F.count("*").alias("groups")
    )
    return sorted(Piece(r.range << (KEY_BITS - bits), bits, int(r.size), int(r.largest), r.groups) for r in out.collect())


def _finer(groups: DataFrame, pieces: list[Piece], ranges: list[int]) -> list[Piece]:
    """The pieces with those at ``ranges`` fetched again in parts."""
    made: list[Piece] = []
    for own in sorted({pieces[i].bits for i in ranges}):
        inside = [pieces[i].key >> (KEY_BITS - own) for i in ranges if pieces[i].bits == own]
        made += _fetch(groups, min(own + MORE_BITS, KEY_BITS), own, inside)
    gone = set(ranges)
    return sorted([p for i, p in enumerate(pieces) if i not in gone] + made)


def _large(groups: DataFrame, total: int, shards: int) -> list[int]:
    """Keys, largest groups first, of the groups above an equal share of what these groups leave: fewer than ``shards``."""
    large: list = []
    while len(large) < shards:
        rest = total - sum(r.size for r in large)
        found = groups.filter(F.col("size") * (shards - len(large)) > rest).select("key", "size").collect()
        if len(found) == len(large):
            break
        large = found
    return [r.key for r in sorted(large, key=lambda r: (-r.size, r.key))]


def _beside(pieces: list[Piece], large: set[int], capacity: int, shards: int) -> list[tuple[int, int, int]] | None:
    """(from, to, shards) of the stretches of pieces around those at ``large``, which have a shard each.

    The capacity of the stretches is the smallest that suffices for all of them together; None if it is above
    ``capacity``. Shards left over go to the stretches whose shards hold most.
    """
    stretches, begin = [], 0
    for at in [*sorted(large), len(pieces)]:
        if at > begin:
            stretches.append((begin, at, [p.size for p in pieces[begin:at]]))
        begin = at + 1
    left = shards - len(large)

    def counts(enough: int) -> list[int] | None:
        made = [_cuts_whole(sizes, enough, left) for _, _, sizes in stretches]
        return [len(m) for m in made] if all(m is not None for m in made) and sum(len(m) for m in made) <= left else None

    if counts(capacity) is None:
        return None
    low, high = 1, capacity
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if counts(middle) is not None else (middle + 1, high)
    given = counts(low)
    totals = [sum(sizes) for _, _, sizes in stretches]
    for _ in range(left - sum(given) if given else 0):
        most = max(range(len(given)), key=lambda i: totals[i] / given[i])
        given[most] += 1
    return [(a, b, n) for (a, b, _), n in zip(stretches, given)]


def _boundaries(groups: DataFrame, shards: int) -> list[int]:
    """First key of every shard but the first."""
    if shards == 1:
        return []
    pieces = _fetch(groups, FIRST_BITS)
    while True:
        total = sum(p.size for p in pieces)
        largest = max([p.largest for p in pieces], default=0)
        needed = max(-(-total // shards), largest, 1)
        enough = _least([p.size for p in pieces], needed, shards)
        ranges = _open(pieces, needed, enough, shards)
        if not ranges:
            break
        pieces = _finer(groups, pieces, ranges)
    keys = _large(groups, total, shards) if largest * shards > total else []
    while keys:
        places = {max(i for i, p in enumerate(pieces) if p.key <= key) for key in keys}
        mixed = sorted(i for i in places if pieces[i].groups > 1)
        if mixed:
            pieces = _finer(groups, pieces, mixed)
            continue
        stretches = _beside(pieces, places, enough, shards)
        if stretches is not None:
            firsts = [pieces[i].key for i in places]
            for a, b, own in stretches:
                inside = groups.filter(F.col("key") >= pieces[a].key)
                inside = inside.filter(F.col("key") < pieces[b].key) if b < len(pieces) else inside
                firsts += [pieces[a].key, *_boundaries(inside, own)]
            return sorted(firsts)[1:]
        keys.pop()  # with the smallest of them alone the shards would not suffice
    cuts = _cuts_whole([p.size for p in pieces], enough, shards)
    return [pieces[c].key for c in cuts[:-1]]


def shard_by_size(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Put every row into a shard so that the largest shard is as small as the order of the groups allows.

    Returns (id, size, text_crc32, law, shard, slot, grown_shard) for each row. The size is the UTF-8 length of the
    text plus 8; a group is all rows with equal text. The law is ``bytes``: sizes near equal, so grown_shard is null.
    Slots count from 0 in each shard without gaps, in an order that follows from the rows alone.

    Null texts have size 8 and checksum 0 and form a group, apart from that of empty texts. Repeated rows get a slot
    each. Null ids are put as other ids are. A group larger than an equal share has a shard of its own, and the rest
    is spread over the other shards. Shards stay empty only where there are few groups. Two texts with the same 64-bit hash share a group; neither is lost. Other columns are
    ignored.
    """
    text = F.col(text_col)
    rows = kept(
        docs.select(
            F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit("")), text.isNull()), 64 - KEY_BITS).alias("key"),
        ), "rows",
    )
    groups = kept(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    cuts = _boundaries(groups, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("key") >= cut).cast("int")
    placed = kept(rows.withColumn("shard", shard).withColumn("part", F.pmod(F.xxhash64("id", "key"), F.lit(SLOT_PARTS)).cast("int")), "placed")
    counts = sorted((r.shard, r.part, r.n) for r in placed.groupBy("shard", "part").agg(F.count("*").alias("n")).collect())
    before, spark = [], docs.sparkSession
    seen: dict[int, int] = {}
    for s, p, n in counts:
        before.append((s, p, seen.get(s, 0)))
        seen[s] = seen.get(s, 0) + n
    offsets = F.broadcast(spark.createDataFrame(before, "shard int, part int, before long"))  # at most shards * SLOT_PARTS rows
    return (
        placed.withColumn("nth", F.expr("row_number() OVER (PARTITION BY shard, part ORDER BY id, key, size)"))
        .join(offsets, ["shard", "part"])
        .select(
            F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("before") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
