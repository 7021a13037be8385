"""Operator 9: all vector pairs above a cosine, by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2 c). Vectors go to the nearest of a bounded
number of pivots, their cell, and the vectors of a cell are dealt into blocks of bounded size. Each block gets a cover
tree, once: nested levels of centres whose radii halve from level to level, each node with the largest distance of what it
covers; levels that hardly group anything are left out. Pairs of trees are traversed level by level: a pair of nodes whose
centres are farther apart than their radii and the threshold is left out, one that lies within the threshold as a whole
is counted without looking inside, all others are opened.

Blocks of different cells meet in loads, runs of blocks. A block sends a load only the vectors that can have a partner in
one of its cells: those within the cell's ring around its pivot, widened by the threshold, and no farther than that from
the plane half way between the pivots. Vectors spread evenly in many dimensions pass these bounds nearly all, and then
all pairs of loads are made.

A dense group therefore costs a few node pairs, not all pairs of its vectors. Links are reported as a count per vector
and as edges between the components found within the blocks, at most one for each pair of them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from curiomill.llm.components import components
from curiomill.llm.tables import bounded_sample, kept

PIVOT_SAMPLE = 4096  # vectors from which pivots are chosen
PIVOTS = (16, 512)  # fewest and most; between them one for each block of the table
BLOCK = 2048  # vectors of a block, about, and fewer where they have many components
BLOCK_VALUES = 1 << 19  # components of all vectors of a block
LOAD = 4  # blocks of a load, about
LOADS = 8  # fewest loads of a table with many blocks' worth of vectors
LEVELS = (1.0, 0.5, 0.25, 0.125)  # covering radii below the root, whose radius is at most 2
SLACK = 1e-7  # of distances, above the rounding of small ones; pairs nearer to the threshold are looked at one by one


class Node(NamedTuple):
    """A level of a tree over n vectors: the vector in the centre of each node, radius, parent, and node of each vector."""

    centre: np.ndarray
    radius: np.ndarray
    parent: np.ndarray
    of: np.ndarray


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def tree(unit: np.ndarray) -> list[Node]:
    """Nested nets: each level divides the nodes of the level above by greedy centres at its radius; leaves last.

    A level with more than half as many nodes as the next one below is left out, the root never.
    """
    n = len(unit)
    leaves = np.arange(n)
    nets = [(np.zeros(min(n, 1), int), np.zeros(n, int))]
    far = [_distance(unit, unit[:1])[:, 0] if n else np.zeros(0)]
    for limit in LEVELS:
        above = nets[-1][1]
        centre: list[int] = []
        own, to = np.full(n, -1), np.zeros(n)
        order = np.argsort(above, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(above[order])) + 1) if n else []:
            while len(members):
                d = _distance(unit[members], unit[members[:1]])[:, 0]
                near = d <= limit
                near[0] = True
                own[members[near]] = len(centre)
                to[members[near]] = d[near]
                centre.append(int(members[0]))
                members = members[~near]
        nets.append((np.array(centre, int), own))
        far.append(to)
    chosen = [(leaves, leaves, np.zeros(n))]
    for k in range(len(nets) - 1, -1, -1):
        centre, own = nets[k]
        if k == 0 or 2 * len(centre) <= len(chosen[0][0]):
            radius = np.zeros(len(centre))
            np.maximum.at(radius, own, far[k])
            chosen.insert(0, (centre, own, radius))
    levels = []
    for centre, own, radius in chosen:
        levels.append(Node(centre, radius, levels[-1].of[centre] if levels else np.zeros(len(centre), int), own))
    return levels


def part(levels: list[Node], wanted: np.ndarray) -> tuple[np.ndarray, list[Node]]:
    """Vectors to keep, those wanted and the centres of their nodes, and the tree over them."""
    keep = wanted.copy()
    for level in levels:
        keep[level.centre[level.of[wanted]]] = True
    at = np.flatnonzero(keep)
    new = np.cumsum(keep) - 1
    out: list[Node] = []
    for level in levels:
        used, own = np.unique(level.of[at], return_inverse=True)
        centre = new[level.centre[used]]
        out.append(Node(centre, level.radius[used], out[-1].of[centre] if out else np.zeros(len(used), int), own))
    return at, out


def _children(level: Node, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a level whose parents are among ``nodes``, and where their parents stand there."""
    at = np.full(int(level.parent.max()) + 1, -1)
    at[nodes] = np.arange(len(nodes))
    found = np.flatnonzero(at[level.parent] >= 0)
    return found, at[level.parent[found]]


def traverse(x: np.ndarray, tx: list[Node], y: np.ndarray, ty: list[Node], cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, Node, Node]]:
    """Node pairs within the threshold as wholes, level by level: arrays of nodes of either tree, and their levels.

    The side whose open nodes are wider goes down next.
    """
    limit = np.sqrt(2 - 2 * cosine)
    if not len(x) or not len(y):
        return
    i, j = 0, 0
    rows, columns, alive = np.array([0]), np.array([0]), np.ones((1, 1), bool)
    while True:
        p, q = tx[i], ty[j]
        product = x[p.centre[rows]] @ y[q.centre[columns]].T
        if i == len(tx) - 1 and j == len(ty) - 1:
            a, b = np.nonzero(product >= cosine)
            hit = alive[a, b]
            if hit.any():
                yield rows[a[hit]], columns[b[hit]], p, q
            return
        d = np.sqrt(np.maximum(2 - 2 * product, 0))
        reach = p.radius[rows][:, None] + q.radius[columns][None, :]
        whole = alive & (d + reach <= limit - SLACK)
        a, b = np.nonzero(whole)
        if len(a):
            yield rows[a], columns[b], p, q
        alive &= (d <= limit + reach + SLACK) & ~whole
        keep_rows, keep_columns = alive.any(axis=1), alive.any(axis=0)
        rows, columns, alive = rows[keep_rows], columns[keep_columns], alive[keep_rows][:, keep_columns]
        if not len(rows):
            return
        if j == len(ty) - 1 or (i < len(tx) - 1 and p.radius[rows].max() >= q.radius[columns].max()):
            i += 1
            rows, up = _children(tx[i], rows)
            alive = alive[up]
        else:
            j += 1
            columns, up = _children(ty[j], columns)
            alive = alive[:, up]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each component of n nodes."""
    to = np.arange(n)
    while True:
        low = np.minimum(to[a], to[b])
        new = to.copy()
        np.minimum.at(new, to[a], low)
        np.minimum.at(new, to[b], low)
        new = new[new]
        if (new == to).all():
            return to
        to = new


def _count(hits, nx: int, ny: int, weight_x: np.ndarray, weight_y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weight linked to each vector of either side, and linked pairs that join all that is linked: one for each node pair
    and one from each vector of a node to the node's centre."""
    cx, cy = np.zeros(nx), np.zeros(ny)
    ea, eb = [], []
    for a, b, p, q in hits:
        wx = np.bincount(p.of, weights=weight_x, minlength=len(p.centre))
        wy = np.bincount(q.of, weights=weight_y, minlength=len(q.centre))
        nx_, ny_ = np.bincount(a, weights=wy[b], minlength=len(p.centre)), np.bincount(b, weights=wx[a], minlength=len(q.centre))
        cx += nx_[p.of]
        cy += ny_[q.of]
        # every vector of a linked node is linked to the other node's centre
        first_b = np.full(len(p.centre), -1)
        first_b[a[::-1]] = b[::-1]
        first_a = np.full(len(q.centre), -1)
        first_a[b[::-1]] = a[::-1]
        in_x, in_y = np.flatnonzero(first_b[p.of] >= 0), np.flatnonzero(first_a[q.of] >= 0)
        ea += [p.centre[a], in_x, p.centre[first_a[q.of[in_y]]]]
        eb += [q.centre[b], q.centre[first_b[p.of[in_x]]], in_y]
    if not ea:
        return cx, cy, np.zeros(0, int), np.zeros(0, int)
    return cx, cy, np.concatenate(ea), np.concatenate(eb)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _stack(held: bytes, dim: int, kind: str) -> np.ndarray:
    return _unit(np.frombuffer(held, kind).reshape(-1, dim))


def _assign(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Nearest pivot of the same dimension, and distance."""
    for batch in batches:
        values = batch.column("v")
        dims = pa.compute.list_value_length(values).to_numpy(zero_copy_only=False)
        pivot, far = np.zeros(len(dims), np.int32), np.zeros(len(dims))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            x = _unit(values.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            d = _distance(x, pivots[int(dim)])
            pivot[at] = d.argmin(axis=1)
            far[at] = d.min(axis=1)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "copies", "v")), pa.array(dims, pa.int32()), pa.array(pivot), pa.array(far)], ["id", "copies", "v", "dim", "pivot", "far"])


class Cells(NamedTuple):
    """Cells of one dimension: pivots, distances of the nearest and farthest vector, and first and last load of each."""

    pivot: np.ndarray
    least: np.ndarray
    most: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def meet(self, one: int, other: int, limit: float) -> bool:
        return one == other or _distance(self.pivot[one : one + 1], self.pivot[other : other + 1])[0, 0] <= self.most[one] + self.most[other] + limit + SLACK

    def reach(self, unit: np.ndarray, own: int, limit: float) -> np.ndarray:
        """Vectors by cells: whether the cell can hold a vector within ``limit`` of this one, a vector of cell ``own``."""
        d = _distance(unit, self.pivot)
        apart = _distance(self.pivot[own : own + 1], self.pivot)[0]
        ring = (d <= self.most + limit + SLACK) & (d >= self.least - limit - SLACK)
        plane = d * d - d[:, own : own + 1] ** 2 <= 2 * apart * limit + SLACK
        out = ring & plane
        out[:, own] = True
        return out & (self.most >= 0)


BLOCK_SCHEMA = "dim int, pivot int, load int, block int, ids binary, copies binary, held binary, tree binary, found binary, component binary"


def _build(frame: pd.DataFrame, kind: str, cosine: float) -> pd.DataFrame:
    """The rows of a block in one row with their tree, and what they have in common: links and components."""
    frame = frame.sort_values("id")
    ids, copies = frame["id"].to_numpy(np.int64), frame["copies"].to_numpy(np.int64)
    raw = np.stack(list(frame["v"])).astype(kind)
    unit = _unit(raw)
    own = tree(unit)
    found, _, a, b = _count(traverse(unit, own, unit, own, cosine), len(ids), len(ids), copies.astype(float), copies.astype(float))
    alone = (unit * unit).sum(axis=1) >= cosine
    found = found - np.where(alone, copies, 0)  # a vector is no link of its own; its copies are counted apart
    component = ids[_roots(len(ids), a, b)]
    first = frame.iloc[0]
    return pd.DataFrame([{
        "dim": first["dim"], "pivot": first["pivot"], "load": first["load"], "block": first["block"], "ids": ids.tobytes(), "copies": copies.tobytes(),
        "held": raw.tobytes(), "tree": pickle.dumps(own), "found": found.astype(np.int64).tobytes(), "component": component.tobytes(),
    }])


SENT_SCHEMA = "dim int, low int, high int, pivot int, load int, block int, ids binary, copies binary, held binary, tree binary, component binary"


def _send(batches: Iterator[pd.DataFrame], cells: dict[int, Cells], kind: str, cosine: float) -> Iterator[pd.DataFrame]:
    """Of each block, for each load that it can have links into: the vectors that can have them, with their tree."""
    limit = float(np.sqrt(2 - 2 * cosine))
    names = [c.split()[0] for c in SENT_SCHEMA.split(", ")]
    for batch in batches:
        for r in batch.to_dict("records"):
            grid, own = cells[r["dim"]], int(r["load"])
            raw = np.frombuffer(r["held"], kind).reshape(-1, r["dim"])
            wide = grid.reach(_unit(raw), int(r["pivot"]), limit)
            levels = pickle.loads(r["tree"])
            ids, copies, component = (np.frombuffer(r[c], np.int64) for c in ("ids", "copies", "component"))
            open_cells = np.flatnonzero(wide.any(axis=0))
            loads = sorted({load for c in open_cells for load in range(int(grid.first[c]), int(grid.last[c]) + 1)})
            for load in loads:
                at, some = part(levels, wide[:, (grid.first <= load) & (load <= grid.last)].any(axis=1))
                yield pd.DataFrame([(
                    r["dim"], min(own, load), max(own, load), r["pivot"], own, r["block"], ids[at].tobytes(), copies[at].tobytes(),
                    raw[at].tobytes(), pickle.dumps(some), component[at].tobytes(),
                )], columns=names)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block rows as rows of vectors: links so far, and component so far."""
    for batch in batches:
        parts = [np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(c)] or [np.zeros(0, np.int64)]) for c in ("ids", "found", "component")]
        yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["id", "found", "component"])


def _cross(key: tuple, frame: pd.DataFrame, cells: dict[int, Cells], kind: str, cosine: float) -> pd.DataFrame:
    """Two loads, or one with itself: links of each vector into other blocks, and edges between components of blocks."""
    dim, low, high = key
    limit = float(np.sqrt(2 - 2 * cosine))
    held = [(
        r["block"], r["load"], r["pivot"], _stack(r["held"], dim, kind), pickle.loads(r["tree"]), np.frombuffer(r["ids"], np.int64),
        np.frombuffer(r["copies"], np.int64).astype(float), np.frombuffer(r["component"], np.int64),
    ) for r in frame.sort_values("block").to_dict("records")]
    found = {r[0]: np.zeros(len(r[5])) for r in held}
    edges = [np.zeros((0, 2), np.int64)]
    for at, r in enumerate(held):
        for s in held[at + 1 :]:
            if (low != high and r[1] == s[1]) or not cells[dim].meet(r[2], s[2], limit):
                continue
            cx, cy, a, b = _count(traverse(r[3], r[4], s[3], s[4], cosine), len(r[5]), len(s[5]), r[6], s[6])
            found[r[0]] += cx
            found[s[0]] += cy
            if len(a):
                edges.append(np.unique(np.stack([r[7][a], s[7][b]], axis=1), axis=0))
    edge = np.unique(np.concatenate(edges), axis=0)
    ids = np.concatenate([r[5] for r in held])
    count = np.concatenate([found[r[0]] for r in held]).astype(np.int64)
    return pd.concat([
        pd.DataFrame({"id": ids[count > 0], "found": count[count > 0], "other": -1, "edge": False}),
        pd.DataFrame({"id": edge[:, 0], "found": 0, "other": edge[:, 1], "edge": True}),
    ])


def _pivots(vectors: DataFrame, pivots: tuple[int, int], block: int) -> dict[int, np.ndarray]:
    """For each dimension, vectors far from each other out of a bounded sample, farthest first."""
    sample = bounded_sample(vectors, ["id"], PIVOT_SAMPLE)
    rows = {r.dim: r["count"] for r in vectors.groupBy(F.size("v").alias("dim")).count().collect()}
    out = {}
    for dim, n in rows.items():
        own = [r.v for r in sample if len(r.v) == dim] or [r.v for r in vectors.filter(F.size("v") == dim).orderBy("id").limit(1).collect()]
        x = _unit(np.array(own, float))
        most = min(pivots[1], max(pivots[0], n // block), len(x))
        chosen, far = [0], _distance(x, x[:1])[:, 0]
        while len(chosen) < most and far.max() > LEVELS[1]:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, _distance(x, x[chosen[-1:]])[:, 0])
        out[dim] = x[chosen]
    return out


def cosine_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9,
                 pivots: tuple[int, int] = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Link all pairs of rows whose cosine is at least ``cosine`` (at least 0.5), in double precision.

    Returns (id, n_links, component_id, kept) for each row: links to other rows, the smallest id reachable over links,
    and whether that is the row's own.

    ``pivots`` are the fewest and most cells, ``block`` the vectors of a block, about; the result is the same for all.

    Vectors that are null, empty or zero, or that hold null, NaN or infinite components, link with nothing; so do
    vectors of different dimensions. Equal vectors are one class and link with each other. Repeated rows with the same
    id and vector are copies of each other and give one output row each. Null ids are given back without links, with
    kept = true. Other columns are ignored.
    """
    spark = vectors.sparkSession
    kind = "<f8" if isinstance(vectors.schema[vector_col].dataType, ArrayType) and isinstance(vectors.schema[vector_col].dataType.elementType, DoubleType) else "<f4"
    element = "double" if kind == "<f8" else "float"
    v = F.col(vector_col)
    plain = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0)
    # zeros of either sign are equal
    source = kept(
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.when(F.coalesce(plain, F.lit(False)) & F.col(id_col).isNotNull(), F.transform(v, lambda e: e + F.lit(0).cast(element))).cast(f"array<{element}>").alias("v"),
        ).withColumn("key", F.sha2(F.to_json(F.struct("v")), 256)), "vectors",
    )
    usable = source.filter("v IS NOT NULL")
    classes = kept(usable.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes")
    heads = kept(usable.join(classes.hint("merge"), ["key", "id"]).dropDuplicates(["key"]).select("id", "copies", "v"), "heads")
    at = _pivots(heads, pivots, block)
    placed = kept(heads.mapInArrow(partial(_assign, pivots=at), f"id long, copies long, v array<{element}>, dim int, pivot int, far double"), "placed")
    sizes = placed.groupBy("dim", "pivot").agg(F.count("*").alias("n"), F.min("far").alias("least"), F.max("far").alias("most")).orderBy("dim", "pivot").collect()
    cells, dealt, number = {}, [], 0
    for dim, x in at.items():
        own = [r for r in sizes if r.dim == dim]
        rows = max(1, min(block, BLOCK_VALUES // dim))
        width = max(rows // 2, min(LOAD * rows, sum(r.n for r in own) // LOADS), 1)
        grid = Cells(x, *(np.full(len(x), z) for z in (0.0, -1.0, 0, -1)))
        start = 0
        for r in own:
            count = -(-r.n // rows)
            grid.least[r.pivot], grid.most[r.pivot] = r.least, r.most
            grid.first[r.pivot], grid.last[r.pivot] = start // width, (start + (count - 1) * r.n // count) // width
            dealt.append((dim, r.pivot, r.n, count, number, start, width))
            number, start = number + count, start + r.n
        cells[dim] = grid
    shares = spark.createDataFrame(dealt or [(0, 0, 0, 1, 0, 0, 1)], "dim int, pivot int, n long, blocks long, number long, start long, width long")
    share = F.pmod(F.xxhash64("id"), F.col("blocks"))
    blocks = kept(
        placed.join(F.broadcast(shares), ["dim", "pivot"])
        .withColumn("block", (F.col("number") + share).cast("int"))
        .withColumn("load", F.expr("(start + (block - number) * n div blocks) div width").cast("int"))
        .groupBy("block").applyInPandas(lambda frame: _build(frame, kind, cosine), BLOCK_SCHEMA), "blocks",
    )
    sent = blocks.drop("found").mapInPandas(partial(_send, cells=cells, kind=kind, cosine=cosine), SENT_SCHEMA)
    crossed = kept(sent.groupBy("dim", "low", "high").applyInPandas(lambda key, frame: _cross(key, frame, cells, kind, cosine), "id long, found long, other long, edge boolean"), "crossed")
    own = kept(blocks.select("ids", "found", "component").mapInArrow(_own, "id long, found long, component long"), "own")
    counts = own.select("id", "found").union(crossed.filter("NOT edge").select("id", "found")).groupBy("id").agg(F.sum("found").alias("found"))
    joined = components(crossed.filter("edge").select(F.col("id").alias("a"), F.col("other").alias("b")))
    by_head = (
        own.select("id", "component").join(counts.hint("merge"), "id")
        .join(joined.select(F.col("node").alias("component"), F.col("component").alias("least")).hint("merge"), "component", "left")
        .select(F.col("id").alias("head"), "found", F.coalesce("least", "component").alias("least"))
    )
    named = classes.select("key", F.col("id").alias("head"), "copies").join(by_head.hint("merge"), "head")
    out = source.join(named.hint("merge"), "key", "left")
    component = F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(
        F.col("id").alias(id_col), F.when(F.col("v").isNull(), 0).otherwise(F.col("found") + F.col("copies") - 1).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
