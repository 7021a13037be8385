"""Operator 2: removal of word windows that another document holds, by super-k-mer partitioning.

The minimiser of a window is the smallest hash among its runs of ``mer`` words. Consecutive windows of a document with
the same minimiser make a super-k-mer. Equal windows have equal minimisers, so only super-k-mers with the same
minimiser can share a window, and a minimiser seen in one document alone needs no more work. Of equal super-k-mers all
but those of the first document are covered whole. Where a minimiser has several different super-k-mers, one of each
travels as a packed string of words to the bucket of its minimiser, where the windows are sorted and each gets the
smallest document it starts in. A minimiser with very many different strings (a passage in ever new surroundings) is
dealt out again by window instead, with minima combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.llm import words as W
from curiomill.llm.tables import kept

U = np.uint64
KEY = ["minimiser", "h", "n"]
LAST_ID = (1 << 63) - 1
HOT_STRINGS = 2000  # different strings of a minimiser above which its windows are dealt out one by one


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done = 1
    out = x
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def _runs(batches: Iterator[pa.RecordBatch], width: int, mer: int) -> Iterator[pa.RecordBatch]:
    """Super-k-mers: first word, number of windows, minimiser, and hash of all their words."""
    for batch in batches:
        for block in W.blocks(batch.column("text")):
            h = W.word_hashes(block)
            n = len(h)
            if n < width:
                continue
            acc = np.zeros(n - mer + 1, U)
            for j in range(mer):
                acc = acc * W.BASE + h[j : n - mer + 1 + j]
            least = _least(W.mix(acc), width - mer + 1)
            at = np.flatnonzero(block.row[: n - width + 1] == block.row[width - 1 :])
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])
            first = np.flatnonzero(new)
            start, count = at[first], np.diff(np.append(first, len(at)))
            up, down = W.powers(n)
            total = np.zeros(n + 1, U)
            np.cumsum(h * up, out=total[1:])
            whole = W.mix((total[start + count + width - 1] - total[start]) * down[start])
            row = block.row[start]
            take = pa.array(block.first + row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(take), batch.column("version").take(take), pa.array((start - block.first_word[row]).astype(np.int32)),
                    pa.array(count.astype(np.int32)), pa.array(least[start].view(np.int64)), pa.array(whole.view(np.int64)),
                ],
                ["id", "version", "start", "n", "minimiser", "h"],
            )


def _pack(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The words of the wanted super-k-mers of each document, joined by one space."""
    for batch in batches:
        for block in W.blocks(batch.column("text")):
            data, ends, at = W.joined(block)
            after = np.append(at, len(data) + 1)
            # the word that ends a row is followed by the next row at once, any other by a space
            stop = after[1:] - 1
            stop[block.first_word[1:][np.diff(block.first_word) > 0] - 1] = ends[1:][np.diff(block.first_word) > 0]
            out = {c: [] for c in ("id", "packed", "minimiser", "h", "n")}
            for i in range(block.rows):
                for item in batch.column("wanted")[block.first + i].as_py():
                    a = block.first_word[i] + item["start"]
                    out["packed"].append(data[at[a] : stop[a + item["n"] + width - 2]].tobytes())
                    out["id"].append(batch.column("id")[block.first + i].as_py())
                    for c in KEY:
                        out[c].append(item[c])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["id"], pa.int64()), pa.array(out["packed"], pa.binary()), pa.array(out["minimiser"], pa.int64()), pa.array(out["h"], pa.int64()), pa.array(out["n"], pa.int32())],
                ["id", "packed", *KEY],
            )


def _windows(packed: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every window: number of its string, place in it, and two hashes of its words."""
    for block in W.blocks(packed.cast(pa.string())):
        h = W.word_hashes(block)
        n = len(h)
        if n < width:
            continue
        up, down = W.powers(n)
        at = np.flatnonzero(block.row[: n - width + 1] == block.row[width - 1 :])
        sums = []
        for values in (h, W.mix(h ^ W.salt(7))):
            total = np.zeros(n + 1, U)
            np.cumsum(values * up, out=total[1:])
            sums.append((total[at + width] - total[at]) * down[at])
        yield block.first + block.row[at], at - block.first_word[block.row[at]], sums[0], sums[1]


def _sorted_bucket(rows: list[pa.RecordBatch], width: int) -> pa.RecordBatch | None:
    """Sort the windows of all strings; report those that start in a smaller document."""
    table = pa.Table.from_batches(rows).combine_chunks()
    parts = [list(p) for p in zip(*_windows(table.column("packed").combine_chunks(), width), strict=True)]
    if not parts:
        return None
    string, place, h1, h2 = (np.concatenate(p) for p in parts)
    ids = table.column("id").to_numpy()[string]
    order = np.lexsort((ids, h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (h1[order[1:]] != h1[order[:-1]]) | (h2[order[1:]] != h2[order[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    covered = np.sort(order[ids[order] > ids[order][head]])
    if not len(covered):
        return None
    string, place = string[covered], place[covered]
    new = np.ones(len(covered), bool)
    new[1:] = (string[1:] != string[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(covered)) - 1
    keys = table.select(["id", *KEY]).take(pa.array(string[first])).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [*(keys.column(c).combine_chunks() for c in ("id", *KEY)), pa.array(place[first].astype(np.int32)), pa.array(place[last].astype(np.int32))],
        ["id", *KEY, "low", "high"],
    )


def _buckets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive in order of their minimiser; those of a minimiser are sorted together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        m = batch.column("minimiser").to_numpy()
        cut = int(np.searchsorted(m, m[-1]))
        if held and held[-1].column("minimiser")[-1].as_py() != m[0]:
            out = _sorted_bucket(held, width)
            held = []
            if out is not None:
                yield out
        if cut:
            out = _sorted_bucket([*held, batch.slice(0, cut)], width)
            held = []
            if out is not None:
                yield out
        held.append(batch.slice(cut))
    if held and (out := _sorted_bucket(held, width)) is not None:
        yield out


def _single(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """One row for each window of a string."""
    for batch in batches:
        for string, place, h1, h2 in _windows(batch.column("packed"), width):
            keys = batch.select(["id", *KEY]).take(pa.array(string))
            yield pa.RecordBatch.from_arrays(
                [*(keys.column(c) for c in ("id", *KEY)), pa.array(place.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                ["id", *KEY, "place", "w1", "w2"],
            )


def _cut(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Drop the words in the ranges of each document and join the rest."""
    for batch in batches:
        for block in W.blocks(batch.column("text")):
            n = len(block.start)
            edge = np.zeros(n + 1, np.int64)
            ranges = batch.column("ranges").slice(block.first, block.rows)
            flat = ranges.flatten()
            if len(flat):
                lengths = np.diff(ranges.offsets.to_numpy())
                base = np.repeat(block.first_word[:-1], lengths)
                np.add.at(edge, base + flat.field("from").to_numpy(zero_copy_only=False), 1)
                np.add.at(edge, base + flat.field("to").to_numpy(zero_copy_only=False), -1)
            keep = np.cumsum(edge[:-1]) == 0
            data, ends, _ = W.joined(block, keep)
            gone = np.zeros(n + 1, np.int64)
            np.cumsum(~keep, out=gone[1:])
            view = memoryview(data)
            pieces = [view[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            out = [
                batch.column("id").slice(block.first, block.rows), pa.array(np.diff(block.first_word)), pa.array(np.diff(gone[block.first_word])),
                pa.array([hashlib.sha256(p).hexdigest() for p in pieces]),
            ]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                out.append(pa.array([bytes(p).decode() for p in pieces]))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(out, names)


def remove_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, mer: int = 8, texts: bool = True, hot_strings: int = HOT_STRINGS
) -> DataFrame:
    """Remove every word in a window of ``width`` words that also starts in a document with a smaller id.

    Words are runs of bytes other than ASCII white space, unchanged. Returns (id, n_words, n_removed, kept_sha256 and,
    with ``texts``, kept_text) for each row; kept words are joined by one space. Windows are judged on the input.

    Null and empty texts have no words. Documents shorter than ``width`` keep all words. Rows that share an id do not
    remove each other's words, whether their texts are equal or not. A null id counts as larger than all others.
    Other columns are ignored.
    """
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    runs = kept(source.mapInArrow(partial(_runs, width=width, mer=mer), "id long, version long, start int, n int, minimiser long, h long"), "runs")
    shared = runs.groupBy("minimiser").agg(F.min("id").alias("p"), F.max("id").alias("q")).filter("p < q").select("minimiser")
    flagged = kept(runs.join(shared.hint("merge"), "minimiser", "left_semi"), "shared_runs")

    strings = kept(flagged.groupBy(*KEY).agg(F.min(F.struct("id", "version", "start")).alias("first")), "strings")
    several = kept(strings.groupBy("minimiser").agg(F.count("*").alias("strings")).filter("strings > 1"), "several")
    wanted = (
        strings.join(several.hint("merge"), "minimiser", "left_semi")
        .groupBy(F.col("first.id").alias("id"), F.col("first.version").alias("version"))
        .agg(F.collect_list(F.struct(F.col("first.start").alias("start"), *KEY)).alias("wanted"))
    )
    packed = kept(
        source.join(wanted.hint("merge"), ["id", "version"]).dropDuplicates(["id", "version"]).select("id", "text", "wanted")
        .mapInArrow(partial(_pack, width=width), "id long, packed binary, minimiser long, h long, n int"), "packed",
    )
    hot = several.filter(F.col("strings") > hot_strings).select("minimiser")
    usual = packed.join(hot.hint("merge"), "minimiser", "left_anti")
    partial_schema = "id long, minimiser long, h long, n int, low int, high int"
    found = kept(usual.repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(partial(_buckets, width=width), partial_schema), "covered")
    if not hot.isEmpty():
        single = kept(packed.join(hot.hint("merge"), "minimiser", "left_semi").select("id", "packed", *KEY).mapInArrow(partial(_single, width=width), "id long, minimiser long, h long, n int, place int, w1 long, w2 long"), "windows")
        least = single.groupBy("w1", "w2").agg(F.min("id").alias("least"))
        more = single.join(least.hint("merge"), ["w1", "w2"]).filter("id > least").select("id", *KEY, F.col("place").alias("low"), F.col("place").alias("high"))
        found = found.union(more)

    placed = kept(flagged.join(strings.select(*KEY, F.col("first.id").alias("first_id")).hint("merge"), KEY), "placed")
    later = placed.filter("id > first_id").select("id", "version", F.col("start").alias("from"), (F.col("start") + F.col("n") + (width - 1)).alias("to"))
    own = placed.filter("id = first_id").join(found.hint("merge"), ["id", *KEY]).select(
        "id", "version", (F.col("start") + F.col("low")).alias("from"), (F.col("start") + F.col("high") + width).alias("to")
    )
    ranges = later.union(own).groupBy("id", "version").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    done = source.join(ranges.hint("merge"), ["id", "version"], "left").select("id", "text", F.coalesce("ranges", F.array().cast("array<struct<from:int,to:int>>")).alias("ranges"))
    out = done.mapInArrow(partial(_cut, texts=texts), schema)
    return out.select(F.nullif("id", F.lit(LAST_ID)).alias(id_col), *[c for c in out.columns if c != "id"])
