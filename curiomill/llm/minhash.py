"""Operator 10: near-duplicates by SuperMinHash signatures.

SuperMinHash gives each element a random permutation of the signature's slots; step ``j`` of the permutation offers
the value ``j + r`` to its ``j``-th slot, and a slot keeps the smallest offer. An offer of a later step never beats one
of an earlier step, so a set is finished with the first step after which all its slots are taken. Here all sets of a
block take a step together: step ``j`` runs over the elements of the sets that still have an empty slot.

Documents with the same shingle set form a class, and its smallest id stands for all. Bands of the signatures give
buckets. In the first round each member is compared with the member of its bucket that meets most others over all
bands (the text from which copies were made rather than one of the copies). In the second, members of a bucket that
are still in different components are compared unless longer signatures, of which two bits a slot are kept, rule the
pair out. Every candidate is confirmed on full sets, and links are grouped by ``components``. A large group of copies
thus costs one comparison per member and bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.llm import words as W
from curiomill.llm.components import components
from curiomill.llm.tables import kept

SLOTS = 126
MISS = 1e-4  # of a pair at the threshold, in a single band search
SKETCH = 1024  # slots of the longer signatures of documents that are compared again, of which PLANES bits are kept
PLANES = 2
SKETCH_COLUMNS = [f"k{i}" for i in range(SKETCH // 64 * PLANES)]
EMPTY = np.iinfo(np.uint64).max
U = np.uint64


def band_rows(threshold: float, slots: int = SLOTS) -> int:
    """Most rows per band with which a pair at the threshold is missed at a rate of at most MISS."""
    rows = 1
    while (1 - threshold ** (rows + 1)) ** (slots // (rows + 1)) <= MISS:
        rows += 1
    return rows


def most_differing(threshold: float) -> int:
    """Differing slots of two sketches above which a pair is ruled out: 4.5 deviations over those of the threshold."""
    p = (1 - threshold) * (1 - 0.5**PLANES)
    return math.ceil(SKETCH * p + 4.5 * math.sqrt(SKETCH * p * (1 - p)))


def superminhash(row: np.ndarray, value: np.ndarray, rows: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (rows, slots) of the sets given as (row, value); rows without elements stay EMPTY."""
    sig = np.full(rows * slots, EMPTY)
    swaps: list[np.ndarray] = []
    for step in range(slots):
        v = W.mix(value + W.salt(step + 1))
        swap = step + (((v & U(0xFFFF)) * U(slots - step)) >> U(16)).astype(np.int64)
        slot = swap
        for earlier in range(step - 1, -1, -1):
            slot = np.where(slot == swaps[earlier], earlier, slot)
        np.minimum.at(sig, row * slots + slot, (v >> U(16)) | U(step << 48))
        open_rows = (sig.reshape(rows, slots) == EMPTY).any(axis=1)
        go_on = open_rows[row]
        if not go_on.any():
            break
        row, value = row[go_on], value[go_on]
        swaps = [s[go_on] for s in (*swaps, swap)]
    return sig.reshape(rows, slots)


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each run of ``rows`` slots; the place of the band is part of it."""
    n = sig.shape[1] // rows
    part = sig[:, : n * rows].reshape(len(sig), n, rows)
    acc = np.broadcast_to(np.arange(1, n + 1, dtype=U) * W.STEP, part.shape[:2]).copy()
    for j in range(rows):
        acc = W.mix(acc * W.BASE + part[:, :, j])
    return acc


def planes(sig: np.ndarray) -> np.ndarray:
    """PLANES bits of each slot, one plane after the other, in 64-bit integers."""
    mixed = W.mix(sig ^ W.STEP)
    parts = [np.packbits(((mixed >> U(i)) & U(1)).astype(np.uint8), axis=1).view(np.int64) for i in range(PLANES)]
    return np.concatenate(parts, axis=1)


def _sign(batches: Iterator[pa.RecordBatch], k: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in W.blocks(batch.column("text"), lower=True):
            row, value = W.distinct(*W.shingles(block, k))
            sig = superminhash(row, value, block.rows)
            band = bands(sig, rows)
            first = np.searchsorted(row, np.arange(block.rows + 1))
            sums = []
            for salt in (1, 2):
                total = np.zeros(len(value) + 1, U)
                np.cumsum(W.mix(value ^ W.salt(100 + salt)), out=total[1:])
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(block.first, block.rows), pa.array(np.diff(first)), pa.array(sums[0]), pa.array(sums[1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, band.size + 1, band.shape[1]), pa.int32()), pa.array(band.ravel().view(np.int64))),
                ],
                ["id", "n", "s1", "s2", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in W.blocks(batch.column("text"), lower=True):
            row, value = W.distinct(*W.shingles(block, k))
            first = np.searchsorted(row, np.arange(block.rows + 1))
            held = pa.Array.from_buffers(
                pa.large_binary(), block.rows, [None, pa.py_buffer(first.astype(np.int64) * 8), pa.py_buffer(np.ascontiguousarray(value))]
            )
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(block.first, block.rows), held.cast(pa.binary())], ["id", "held"])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            sets = [np.frombuffer(x.as_buffer(), U) for x in part.column("held")]
            row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            bits = planes(superminhash(row, np.concatenate(sets), len(sets), SKETCH))
            yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(bits.shape[1]))], ["member", *SKETCH_COLUMNS])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with 100 * intersection >= percent * union."""
    for batch in batches:
        good = []
        for i, (x, y) in enumerate(zip(batch.column("held_a"), batch.column("held_b"), strict=True)):
            p, q = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
            if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                continue
            at = np.searchsorted(p, q)
            at[at == len(p)] = len(p) - 1
            common = int((p[at] == q).sum())
            if 100 * common >= percent * (len(p) + len(q) - common):
                good.append(i)
        if good:
            yield batch.select(["a", "b"]).take(pa.array(good))


def _links(held: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that hold on full sets."""
    both = (
        pairs.join(held.select(F.col("id").alias("a"), F.col("held").alias("held_a")).hint("merge"), "a")
        .join(held.select(F.col("id").alias("b"), F.col("held").alias("held_b")).hint("merge"), "b")
    )
    return both.select("a", "b", "held_a", "held_b").mapInArrow(partial(_confirm, percent=percent), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 85) -> DataFrame:
    """Near-duplicate groups over whole texts.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets of distinct ``shingle``-word
    shingles (A-Z lower-cased; with fewer words the whole sequence is the only shingle). Returns (id, n_shingles,
    component_id, kept) for each row: component_id is the smallest id reachable over links, kept is id = component_id.

    Null or empty texts and texts of white space have an empty set and are linked with nothing. Rows with a null id
    are given back with null component_id and kept = true. Rows that share an id count as one document when their
    sets are equal; with different sets each row is compared, and the id links them. Other columns are ignored.
    """
    percent = int(percent)
    rows = band_rows(percent / 100)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = kept(source.mapInArrow(partial(_sign, k=shingle, rows=rows), "id long, n long, s1 long, s2 long, bands array<long>"), "signatures")
    usable = signed.filter("id IS NOT NULL AND n > 0")
    classes = kept(usable.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep")), "classes")
    # a class is a node; its number is its smallest id, and two classes of one id share the node
    heads = usable.join(classes.hint("merge"), ["n", "s1", "s2"]).filter("id = rep").dropDuplicates(["n", "s1", "s2"])
    heads = kept(heads.select(F.col("rep").alias("member"), "n", "bands"), "heads")
    buckets = heads.select("member", "n", F.posexplode("bands").alias("band", "bucket"))
    texts = source.filter("id IS NOT NULL")

    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    crowded = kept(buckets.join(shared.hint("merge"), "bucket"), "crowded")
    # the text from which many copies were made meets most of them, the copies meet each other less often
    met = crowded.groupBy("member").agg(F.sum("size").alias("met"))
    ranked = kept(crowded.select("bucket", "member").join(met.hint("merge"), "member"), "ranked")
    most = ranked.groupBy("bucket").agg(F.max("met").alias("met"))
    centres = ranked.join(most.hint("merge"), ["bucket", "met"]).groupBy("bucket").agg(F.min("member").alias("centre"))
    first = kept(
        ranked.join(centres.hint("merge"), "bucket").filter("member <> centre")
        .select(F.least("member", "centre").alias("a"), F.greatest("member", "centre").alias("b")).distinct(), "pairs",
    )
    members = crowded.select(F.col("member").alias("id")).distinct()
    held = kept(texts.join(members.hint("merge"), "id", "left_semi").mapInArrow(partial(_sets, k=shingle), "id long, held binary"), "sets")
    links = kept(_links(held, first, percent), "links")
    known = components(links)

    named = kept(
        crowded.select("bucket", "band", "member", "n").join(known.select(F.col("node").alias("member"), "component").hint("merge"), "member", "left")
        .withColumn("component", F.coalesce("component", "member")), "members",
    )
    mixed = named.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least <> most")
    unsettled = kept(named.join(mixed.hint("merge"), "bucket", "left_semi"), "unsettled")
    again = unsettled.select(F.col("member").alias("id")).distinct()
    sketches = held.join(again.hint("merge"), "id", "left_semi").mapInArrow(_sketch, "member long, " + ", ".join(f"{c} long" for c in SKETCH_COLUMNS))
    sketched = kept(unsettled.join(sketches.hint("merge"), "member").join(heads.select("member", "bands").hint("merge"), "member"), "sketched")
    x, y = sketched.alias("x"), sketched.hint("merge").alias("y")
    differing = [F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}")) for c in SKETCH_COLUMNS]
    width = SKETCH // 64
    apart = reduce(add, [F.bit_count(reduce(lambda p, q: p.bitwiseOR(q), differing[i::width])) for i in range(width)])
    before = [F.slice(f"{side}.bands", 1, F.col("x.band")) for side in "xy"]  # a pair is taken in the first bucket it shares
    second = kept(
        x.join(
            y,
            (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.member") < F.col("y.member"))
            & (F.col("x.component") != F.col("y.component"))
            & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
            & (apart <= most_differing(percent / 100)) & ~F.arrays_overlap(*before),
        )
        .select(F.col("x.member").alias("a"), F.col("y.member").alias("b")).distinct()
        .join(first.hint("merge"), ["a", "b"], "left_anti"), "pairs",
    )
    if not second.isEmpty():
        more = kept(_links(held, second, percent), "links")
        if not more.isEmpty():
            known = components(links.union(more))

    # rows of one id with several sets: the id links its classes
    same_id = usable.join(classes.hint("merge"), ["n", "s1", "s2"]).select("id", "rep").filter("id <> rep")
    split = usable.groupBy("id").agg(F.min("n").alias("p"), F.max("n").alias("q"), F.min("s1").alias("r"), F.max("s1").alias("s")).filter("p <> q OR r <> s")
    split = kept(split.select("id"), "split_ids")
    if not split.isEmpty():
        extra = same_id.join(split.hint("merge"), "id", "left_semi").select(F.col("id").alias("a"), F.col("rep").alias("b"))
        known = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(extra))

    grouped = (
        signed.select("id", "n", "s1", "s2")
        .join(classes.hint("merge"), ["n", "s1", "s2"], "left")
        .join(known.select(F.col("node").alias("rep"), "component").hint("merge"), "rep", "left")
    )
    component = F.coalesce("component", "rep", "id")
    component = F.when(F.col("id").isNull(), None).otherwise(component)
    return grouped.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
