"""Cheapest repair of a conversation's turns, with the edits written out as an audit.

The rows of a conversation are cut into pieces of neighbouring turns, so that a conversation of any length is worked on
by many tasks. In a piece, a dynamic program over the rows keeps, for each state of the wanted pattern, the cheapest
edits so far. The edits are paths in a tree of linked nodes: what two of them begin with is held once. Each node knows
ancestors 1, 2, 4, ... steps back and a rolling hash of its whole path, so two paths of equal cost are compared by
searching the length of their common beginning; the beginning is then compared itself, as hashes may collide.

A conversation of one piece is ready after that. For others a piece gives its cheapest edits from each state to each,
which are chained over the pieces by the same kind of tree, and the texts are hashed piece after piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curiomill.llm.tables import kept

PIECE_TURNS = 4096  # numbers of turns that one piece spans
PIECE_ROWS = 8192  # rows after which a piece is cut further
RETYPE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5  # costs
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired roles end with
KEEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = (USER, USER, ASSISTANT, USER)  # the state that a new or retyped row leads to
NAME = ("", "", "user", "assistant")
FINAL = (EMPTY, ASSISTANT)
LEGAL = {"su", "ua", "au"}


class Trail:
    """Edit strings as paths of linked nodes. Node 0 is the empty string; a node adds a label to its parent's string."""

    def __init__(self, modulus: int = (1 << 61) - 1, base: int = 911_382_323) -> None:
        self.modulus, self.base = modulus, base
        self.label, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... nodes back
        self.inner: dict[int, list[int]] = {}

    def add(self, parent: int, label: str) -> int:
        node = len(self.label)
        h = self.hash[parent]
        for c in label:
            h = (h * self.base + ord(c)) % self.modulus
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.label.append(label)
        self.depth.append(self.depth[parent] + len(label))
        self.hash.append(h)
        self.up.append(up)
        return node

    def reaching(self, node: int, length: int) -> int:
        """The node on the path whose own label holds the character number ``length``."""
        for k in range(len(self.up[node]) - 1, -1, -1):
            if k < len(self.up[node]) and self.depth[self.up[node][k]] >= length:
                node = self.up[node][k]
        return node

    def prefix_hash(self, node: int, length: int) -> int:
        if not length:
            return 0
        node = self.reaching(node, length)
        if self.depth[node] == length:
            return self.hash[node]
        if node not in self.inner:  # a label of several characters: hashes after each
            h, all_of = self.hash[self.up[node][0]], []
            for c in self.label[node]:
                h = (h * self.base + ord(c)) % self.modulus
                all_of.append(h)
            self.inner[node] = all_of
        return self.inner[node][length - self.depth[self.up[node][0]] - 1]

    def common(self, a: int, b: int) -> int:
        """Length of what both strings begin with, by their hashes."""
        low, high = 0, min(self.depth[a], self.depth[b])
        while low < high:
            middle = (low + high + 1) // 2
            if self.prefix_hash(a, middle) == self.prefix_hash(b, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def back(self, node: int, length: int) -> Iterator[tuple[int, str]]:
        """The first ``length`` characters, label by label from their end: node and its part."""
        node = self.reaching(node, length) if length else 0
        while length:
            start = self.depth[self.up[node][0]]
            yield node, self.label[node][: length - start]
            node, length = self.up[node][0], start

    def equal(self, a: int, b: int, length: int) -> bool:
        """Whether both strings begin with the same ``length`` characters; ends where the paths meet."""
        left, right = self.back(a, length), self.back(b, length)
        x = y = ""
        i = j = -1
        while length:
            if not x:
                i, x = next(left)
            if not y:
                j, y = next(right)
            if i == j and x == y:
                return True
            n = min(len(x), len(y))
            if x[-n:] != y[-n:]:
                return False
            x, y, length = x[:-n], y[:-n], length - n
        return True

    def text(self, node: int) -> str:
        parts = [part for _, part in self.back(node, self.depth[node])]
        return "".join(reversed(parts))

    def least(self, a: int, b: int) -> int:
        """Of two nodes, that of the lesser string in ASCII order."""
        n = self.common(a, b)
        if not self.equal(a, b, n):  # two different beginnings share a hash
            return a if self.text(a) <= self.text(b) else b
        if n == self.depth[a] or n == self.depth[b]:
            return a if self.depth[a] <= self.depth[b] else b
        x, y = self.reaching(a, n + 1), self.reaching(b, n + 1)
        one, two = (self.label[z][n - self.depth[self.up[z][0]]] for z in (x, y))
        return a if one < two else b


class Row(NamedTuple):
    initial: str
    gone: bool  # blank or repeated: must be deleted
    cut: bool  # does not end a sentence


Best = list[tuple[int, int] | None]  # for each state: cost and node


def better(trail: Trail, best: Best, state: int, cost: int, parent: int, label: str) -> None:
    held = best[state]
    if held is None or cost < held[0]:
        best[state] = (cost, trail.add(parent, label))
    elif cost == held[0]:
        node = trail.add(parent, label)
        best[state] = (cost, trail.least(held[1], node))


def inserted(trail: Trail, best: Best) -> Best:
    """Also the states reached by inserting turns here. The user's turn comes first: it may follow all others."""
    made = list(best)
    for state in (EMPTY, SYSTEM, ASSISTANT):
        if best[state] is not None:
            better(trail, made, USER, best[state][0] + INSERT, best[state][1], "I")
    if made[USER] is not None:
        better(trail, made, ASSISTANT, made[USER][0] + INSERT, made[USER][1], "I")
    return made


def edits(rows: Iterable[Row], start: int, trail: Trail) -> Best:
    """Cheapest edits of the rows from one state to each; equal costs: least in ASCII order."""
    best: Best = [None] * 4
    best[start] = (0, 0)
    best = inserted(trail, best)
    for row in rows:
        made: Best = [None] * 4
        for state, held in enumerate(best):
            if held is None:
                continue
            cost, node = held
            better(trail, made, state, cost + DELETE, node, "D")
            if not row.gone:
                cost += CUT_SHORT * row.cut
                if (state, row.initial) in KEEP:
                    better(trail, made, KEEP[state, row.initial], cost, node, "K")
                better(trail, made, NEXT[state], cost + RETYPE, node, "R")
        best = inserted(trail, made)
    return best


def cheapest(trail: Trail, best: Best) -> tuple[int, int]:
    ends = [best[s] for s in FINAL if best[s] is not None]
    if len(ends) == 1 or ends[0][0] != ends[1][0]:
        return min(ends)
    return ends[0][0], trail.least(ends[0][1], ends[1][1])


def repaired(audit: str, initials: Iterable[str], rows: Iterable[tuple[str, str]], state: int) -> Iterator[str]:
    """The lines ``role:text`` that the edits leave."""
    both = zip(initials, rows, strict=True)
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield NAME[state] + ":"
            continue
        initial, (role, text) = next(both)
        if edit == "K":
            state = KEEP[state, initial]
            yield f"{role}:{text}"
        elif edit == "R":
            state = NEXT[state]
            yield f"{NAME[state]}:{text}"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the planned damage; a row that is dropped stays as a mark with ``dropped`` set and no text.

    Nulls are read as one space in role and text and in the string that decides about the damage.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    changed = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"),
        (F.col("kind") == 0).alias("dropped"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def described(rows: DataFrame, piece_turns: int) -> DataFrame:
    """Rows (conv_id, turn, role, text, dropped) with the piece they belong to and what is wrong with them."""
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    return rows.withColumns({
        # null turns come first
        "piece": F.coalesce(F.floor(F.col("turn") / F.lit(piece_turns)), F.lit(-(1 << 62))),
        "blank": shown == "",
        "cut": ~F.right(shown, F.lit(1)).isin(*ENDS),
        "digest": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)),
    })


PIECE = (
    "part int, n long, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, first string, last string, "
    "cost long, audit string, sha string, ways array<struct<cost:long,audit:string>>, initials string, roles array<string>, texts array<string>"
)
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
_WAYS = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_FIELDS = [("part", pa.int32()), *((c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns")),
           ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string()), ("ways", _WAYS),
           ("initials", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]


class Piece:
    """Rows of one piece as they come, with their counts."""

    def __init__(self, part: int) -> None:
        self.rows: list[Row] = []
        self.said: list[tuple[str, str]] = []
        self.count = {"part": part, "n": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "low": None, "high": None, "turns": 0}

    def add(self, turn, new_turn: bool, role: str, text: str, blank: bool, repeated: bool, cut: bool) -> None:
        c, initial = self.count, role[:1]
        c["n"] += 1
        c["blank"] += blank
        c["duplicate"] += repeated and not blank
        cut = cut and not blank and not repeated
        c["truncated"] += cut
        if self.rows:
            c["illegal"] += self.rows[-1].initial + initial not in LEGAL
        if turn is not None:
            c["low"] = turn if c["low"] is None else c["low"]
            c["high"] = turn
            c["turns"] += new_turn
        self.rows.append(Row(initial, blank or repeated, cut))
        self.said.append((role, text))

    def ready(self, whole: bool) -> dict:
        """The result of a whole conversation, or what is needed to chain the piece with others."""
        made: dict = self.count | {"first": self.rows[0].initial if self.rows else None, "last": self.rows[-1].initial if self.rows else None}
        initials = [r.initial for r in self.rows]
        if whole:
            trail = Trail()
            cost, node = cheapest(trail, edits(self.rows, EMPTY, trail))
            audit = trail.text(node)
            lines = "\n".join(repaired(audit, initials, self.said, EMPTY))
            return made | {"cost": cost, "audit": audit, "sha": hashlib.sha256(lines.encode()).hexdigest()}
        ways = []
        for start in range(4):
            trail = Trail()
            ways += [None if w is None else {"cost": w[0], "audit": trail.text(w[1])} for w in edits(self.rows, start, trail)]
        return made | {"ways": ways, "initials": initials, "roles": [r for r, _ in self.said], "texts": [t for _, t in self.said]}


def _pieces(piece_rows: int, kind: pa.DataType):
    """Task over sorted rows: one result for each piece. A mark before a piece's rows says that its conversation has
    others, and names the rows that earlier pieces hold already."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held = 0

        def flush() -> pa.RecordBatch:
            arrays = [pa.array([o["conv_id"] for o in out], kind), pa.array([o["piece"] for o in out], pa.int64())]
            arrays += [pa.array([o.get(name) for o in out], t) for name, t in _FIELDS]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "piece", *(name for name, _ in _FIELDS)])

        key, piece, seen, whole, last = None, None, set(), True, None
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                for r in batch.slice(a, 1024).to_pylist():
                    if key != (r["conv_id"], r["piece"]):
                        if piece is not None:
                            out.append(piece.ready(whole) | {"conv_id": key[0], "piece": key[1]})
                        key, piece, seen, whole, last = (r["conv_id"], r["piece"]), Piece(0), set(), True, None
                    if r["mark"]:
                        whole = False
                        seen.update(r["seen"] or ())
                        continue
                    if r["dropped"]:
                        continue
                    if piece.count["n"] >= piece_rows:
                        whole = False
                        out.append(piece.ready(False) | {"conv_id": key[0], "piece": key[1]})
                        piece = Piece(piece.count["part"] + 1)
                    piece.add(r["turn"], r["turn"] != last, r["role"], r["text"], r["blank"], r["digest"] in seen, r["cut"])
                    seen.add(r["digest"])
                    last = r["turn"]
                    held += len(r["text"])
                    if len(out) >= 5_000 or held > 1 << 23 and out:
                        yield flush()
                        out, held = [], 0
        if piece is not None:
            out.append(piece.ready(whole) | {"conv_id": key[0], "piece": key[1]})
        if out:
            yield flush()

    return work


def _chain(pieces: pd.DataFrame) -> pd.DataFrame:
    """Edits of all pieces of one conversation, chained: for each piece the state it starts in and its edits."""
    pieces = pieces.sort_values(["piece", "part"], kind="stable").reset_index(drop=True)
    trail = Trail()
    best: Best = [(0, 0), None, None, None]
    came: dict[int, tuple[int, int]] = {}  # node -> node before, state there
    for ways in pieces["ways"]:
        made: Best = [None] * 4
        for start, held in enumerate(best):
            if held is None:
                continue
            for end in range(4):
                way = ways[4 * start + end]
                if way is not None:
                    node = len(trail.label)
                    better(trail, made, end, held[0] + way["cost"], held[1], way["audit"])
                    if len(trail.label) > node:
                        came[node] = (held[1], start)
        best = made
    cost, node = cheapest(trail, best)
    starts, audits = [], []
    while node:
        starts.append(came[node][1])
        audits.append(trail.label[node])
        node = came[node][0]
    pieces["start"], pieces["audit"], pieces["cost"] = starts[::-1], pd.Series(audits[::-1], dtype=object), cost
    return pieces[["conv_id", "piece", "part", "start", "audit", "cost"]]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired lines of each piece as one text, null if nothing is left of it."""
    for batch in batches:
        for a in range(batch.num_rows):
            r = batch.slice(a, 1).to_pylist()[0]
            lines = list(repaired(r["audit"], r["initials"], zip(r["roles"], r["texts"], strict=True), r["start"]))
            said = pa.array(["\n".join(lines) if lines else None], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.slice(a, 1).column(k) for k in range(3)), said], names=["conv_id", "piece", "part", "said"])


def _hashes(kind: pa.DataType):
    """Task over sorted pieces: the hash of all lines of a conversation, piece after piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key, state) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], kind), pa.array([state.hexdigest()])], names=["conv_id", "sha"])

        key = state = None
        begun = False
        for batch in batches:
            for a in range(batch.num_rows):
                r = batch.slice(a, 1).to_pylist()[0]
                if key != (r["conv_id"],):
                    if key is not None:
                        yield made(key, state)
                    key, state, begun = (r["conv_id"],), hashlib.sha256(), False
                if r["said"] is not None:
                    state.update(("\n" if begun else "").encode() + r["said"].encode())
                    begun = True
        if key is not None:
            yield made(key, state)

    return work


def repair(rows: DataFrame, piece_turns: int = PIECE_TURNS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Repair of each conversation of rows (conv_id, turn, role, text, dropped).

    Rows of a conversation go by turn, nulls first; rows of one turn by role, then text. Returns conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit and repaired_sha256; a conversation that has no row but dropped ones
    gives zeros, an empty audit and the hash of the empty text. A null conv_id is a conversation of its own. The pieces
    of a long conversation are worked on apart; only its hash, which depends on the order, runs over them in one task.
    """
    given = described(rows.select("conv_id", "turn", "role", "text", "dropped"), piece_turns)
    kind = given.schema["conv_id"].dataType
    name, arrow = kind.simpleString(), {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string()}[kind]

    # conversations of several pieces, and what later pieces repeat of earlier ones
    several = given.groupBy("conv_id").agg(F.collect_set("piece").alias("pieces")).filter(F.size("pieces") > 1)
    marks = several.select("conv_id", F.explode("pieces").alias("piece"), F.lit(None).cast("array<binary>").alias("seen"))
    again = given.filter("NOT dropped").groupBy("conv_id", "digest").agg(F.array_sort(F.collect_set("piece")).alias("pieces")).filter(F.size("pieces") > 1)
    again = again.select("conv_id", F.explode(F.slice("pieces", F.lit(2), F.size("pieces"))).alias("piece"), F.array("digest").alias("seen"))
    marks = marks.unionByName(again).withColumn("mark", F.lit(True))
    stream = given.withColumn("mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    stream = stream.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", F.desc("mark"), F.asc_nulls_first("turn"), "role", "text")
    schema = f"conv_id {name}, piece long, {PIECE.replace('initials string', 'initials array<string>')}"
    pieces = kept(stream.mapInArrow(_pieces(piece_rows, arrow), schema), "conversation-pieces")

    parted = pieces.filter("ways IS NOT NULL")
    chained = kept(parted.select("conv_id", "piece", "part", "ways").groupBy("conv_id").applyInPandas(_chain, f"conv_id {name}, piece long, part int, start int, audit string, cost long"), "conversation-edits")
    same = [parted[c].eqNullSafe(chained[c]) for c in ("conv_id", "piece", "part")]
    lines = parted.join(chained, same).select(parted["conv_id"], parted["piece"], parted["part"], chained["audit"], "initials", "roles", "texts", "start")
    lines = lines.mapInArrow(_lines, f"conv_id {name}, piece long, part int, said string")
    hashes = lines.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "part").mapInArrow(_hashes(arrow), f"conv_id {name}, sha string")

    counts = pieces.select("conv_id", "piece", "part", "n", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "first", "last", "cost", "audit", "sha")
    counts = counts.unionByName(chained.select("conv_id", "piece", "part", "audit", F.when(F.row_number().over(_in_order()) == 1, F.col("cost")).alias("cost")), allowMissingColumns=True)
    counts = counts.unionByName(hashes, allowMissingColumns=True)
    ordered = F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct("piece", "part", "first", "last"))))
    total = counts.groupBy("conv_id").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "cost")),
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("sha").alias("sha"), ordered.alias("edges"),
        F.array_sort(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("piece", "part", "audit")))).alias("audits"),
    )
    joints = F.transform(F.sequence(F.lit(1), F.size("edges") - 1), lambda i: F.concat(F.col("edges")[i - 1]["last"], F.col("edges")[i]["first"]))
    broken = F.when(F.size("edges") > 1, F.size(F.filter(joints, lambda x: ~x.isin(*LEGAL)))).otherwise(0)
    return total.select(
        "conv_id",
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", (F.col("illegal") + broken).alias("illegal"), "cost",
        F.array_join(F.transform("audits", lambda x: x["audit"]), "").alias("audit"), F.col("sha").alias("repaired_sha256"),
    )


def _in_order():
    from pyspark.sql import Window

    return Window.partitionBy("conv_id").orderBy("piece", "part")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The conversations damaged by rule, and their repair: one row for each conv_id."""
    return repair(damaged(conversations))
