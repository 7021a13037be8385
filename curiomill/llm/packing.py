"""Operator 1: variable-capacity best-fit packing.

Documents become sequences of a few permitted lengths. Pieces are placed from the longest to the shortest: each goes
into the open bin it fills best, and if it fits into none, a bin of the size with the least expected cost per token is
opened, counting what the shorter pieces still to come can add. When all are placed, each bin is cut down to the
smallest permitted length that holds its contents. A text longer than the largest length is cut into full bins and a
rest, so every token is placed exactly once.

Pieces are dealt by a hash into groups of bounded size, which tasks pack on their own; a group holds many more pieces
than fit into a bin, so bins left open at its end cost next to nothing. Rows go into groups by id and piece, hence no
key or source can make a group large.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.llm import words as W
from curiomill.llm.tables import kept

CAPACITIES = (512, 1024, 2048, 4096)
BIN_COST = 16.0  # of a sequence, in tokens, besides its length
GROUP_PIECES = 20_000


def cost(capacity: int) -> float:
    return capacity + BIN_COST


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each piece, and the capacity of each bin after cutting down. Pieces come longest first."""
    bins: list[int] = []  # room left by number
    size: list[int] = []
    room: list[tuple[int, int]] = []  # (room, bin) of open bins, ordered
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    later = np.append(np.cumsum(lengths[::-1])[::-1], 0)  # tokens of this piece and all after it
    for i, n in enumerate(lengths.tolist()):
        at = bisect_left(room, (n, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            fits = [c for c in capacities if c >= n]
            # what is not taken by this piece is filled by later ones as far as they go
            c = min(fits, key=lambda c: (cost(c) / max(1, n + min(c - n, later[i + 1])), c))
            left, b = c, len(bins)
            bins.append(c)
            size.append(c)
        place[i], offset[i] = b, size[b] - left
        bins[b] = left - n
        if bins[b] > 0:
            insort(room, (bins[b], b))
    steps = sorted(capacities)
    return place, offset, [steps[bisect_left(steps, s - r)] for s, r in zip(size, bins, strict=True)]


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in W.blocks(batch.column("text")):
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(block.first, block.rows), batch.column("version").slice(block.first, block.rows), pa.array(np.diff(block.first_word))], ["id", "version", "n"])


def _groups(batches: Iterator[pa.RecordBatch], capacities: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by group, then longest first."""
    held: list[pa.RecordBatch] = []

    def packed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        place, offset, size = pack(rows.column("tokens").to_numpy(), capacities)
        extra = [pa.array(place), pa.array(offset), pa.array(np.array(size, np.int64)[place])]
        return pa.RecordBatch.from_arrays([*(rows.column(c).combine_chunks() for c in ("id", "version", "start", "tokens", "group")), *extra], ["id", "version", "start", "tokens", "group", "bin", "offset", "capacity"])

    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("group").to_numpy()
        edges = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if not held else held[-1].column("group")[-1].as_py()))
        last = 0
        for e in edges.tolist():
            if e > last:
                held.append(batch.slice(last, e - last))
            if held:
                yield packed()
                held.clear()
            last = e
        held.append(batch.slice(last))
    if held:
        yield packed()


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Place the words of every document, and one end mark each, into sequences of permitted lengths.

    Returns one row per piece: (id, start, tokens, pack_group, bin, offset, capacity): words ``start`` to ``start +
    tokens`` of the document (its end mark counts as the word after the last) stand at ``offset`` of the bin (group,
    bin), whose length is ``capacity``. A word is a run of bytes other than ASCII white space.

    Null and empty texts have only their end mark. Repeated rows, and rows that share an id, are placed each. A null
    id is placed as any other. Ties go to the fullest, then the oldest bin. Other columns are ignored.
    """
    capacities = tuple(sorted(set(capacities)))
    largest = capacities[-1]
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    sized = source.mapInArrow(_lengths, f"id {kind}, version long, n long").withColumn("total", F.col("n") + 1)
    pieces = kept(
        sized.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(largest).cast("long"))))
        .select("id", "version", "start", F.least(F.lit(largest).cast("long"), F.col("total") - F.col("start")).alias("tokens")), "pieces",
    )
    groups = max(1, -(-pieces.count() // group_pieces))
    # copies of a row spread over the groups too
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("id", "version", "start"), F.lit(groups)))
    ordered = dealt.repartition(F.col("group")).sortWithinPartitions("group", F.desc("tokens"), "id", "version", "start")
    out = ordered.select("id", "version", "start", "tokens", "group").mapInArrow(
        partial(_groups, capacities=capacities), f"id {kind}, version long, start long, tokens long, group long, bin long, offset long, capacity long"
    )
    return out.select(F.col("id").alias(id_col), "start", "tokens", F.col("group").alias("pack_group"), "bin", "offset", "capacity")
