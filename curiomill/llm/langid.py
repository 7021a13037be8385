"""Operator 4: language by interpolated Kneser-Ney character models.

For each language the model holds, for every order, the discounted probability of each seen character sequence and the
weight of the lower order after each seen context, as sorted arrays of hashes with values beside them. The highest
order counts occurrences, lower ones count the different characters seen before a sequence. A text gets the language
with the lowest cross-entropy per character; it counts as rejected if even that is above what the language's own texts
show.

The models are fitted on at most about SAMPLE_ROWS whole texts per language, chosen by a hash of the id (a documented
bound, so the models that tasks read stay small); every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.llm import words as W

ORDER = 5
SAMPLE_ROWS = 400
SMALL = 50  # texts to learn from under which a language sets none apart
FOLDS = 3
HELD_OUT = 1
FULL_EVIDENCE = 40  # characters from which a text's score no longer depends on its length
CACHED = 1_500_000  # sequences whose probabilities a worker keeps
U = np.uint64
PLANES = 0x20000

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Lower-case letter for each character below PLANES, a space for all that are no letters."""
    if not _letters:
        table = np.full(PLANES, 32, np.uint32)
        for i in range(PLANES):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _letters.append(table)
    return _letters[0]


class Letters(NamedTuple):
    """Texts as letters with one space between words: code points, row of each, place of each in its row."""

    code: np.ndarray
    row: np.ndarray
    place: np.ndarray


def letters(data: np.ndarray, offsets: np.ndarray) -> Letters:
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begins = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    at = begins[offsets]
    table = _letter_table()
    code = np.where(code < PLANES, table[np.minimum(code, PLANES - 1)], code)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    before = np.full(len(code), 32, np.uint32)
    before[1:] = code[:-1]
    before[at[:-1][np.diff(at) > 0]] = 32  # a row begins after a space
    keep = (code != 32) | (before != 32)
    code, row = code[keep], row[keep]
    first = np.searchsorted(row, np.arange(len(at) - 1))
    return Letters(code, row, np.arange(len(code)) - first[row])


def _grams(text: Letters) -> np.ndarray:
    """The ORDER characters that end at each place, (places, ORDER); spaces stand before a text."""
    n = len(text.code)
    out = np.empty((n, ORDER), np.uint32)
    for back in range(ORDER):
        column = out[:, ORDER - 1 - back]
        column[:back] = 32
        column[back:] = text.code[: n - back]
        column[text.place < back] = 32
    return out


def _hash(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of code points; the length is part of it."""
    acc = np.full(len(codes), W.salt(codes.shape[1]))
    for j in range(codes.shape[1]):
        acc = (acc ^ codes[:, j].astype(U)) * W.BASE
    return W.mix(acc)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of character sequences by language."""
    for batch in batches:
        lang = np.array(batch.column("lang").to_pylist(), dtype=object)
        data, offsets = W.text_bytes(batch.column("text"))
        for a, b in W.spans(offsets):
            text = letters(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            grams = np.ascontiguousarray(_grams(text))
            frame = pd.DataFrame({"lang": lang[a:b][text.row], "gram": _hash(grams)})
            frame["at"] = np.arange(len(frame))
            found = frame.groupby(["lang", "gram"], sort=False).agg(at=("at", "first"), n=("at", "size")).reset_index()
            own = grams[found["at"].to_numpy()]
            words = ["".join(map(chr, x)) for x in own.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(found["lang"]), pa.array(words), pa.array(found["n"].to_numpy())], ["lang", "gram", "n"])


class Level(NamedTuple):
    """One order of one language: sequences with their discounted probability, contexts with the lower order's weight."""

    keys: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels 1 to ORDER from the counted sequences of one language."""
    levels = []
    for k in range(1, ORDER + 1):
        own = codes[:, ORDER - k :]
        key = _hash(own)
        if k == ORDER:
            c = counts.astype(float)
        else:  # of the different sequences one longer that end so
            _, first = np.unique(_hash(codes[:, ORDER - k - 1 :]), return_index=True)
            _, first2, c = np.unique(key[first], return_index=True, return_counts=True)
            own, c = own[first][first2], c.astype(float)
            key = _hash(own)
        once, twice = (c == 1).sum(), (c == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        context = _hash(own[:, :-1])
        contexts, index = np.unique(context, return_inverse=True)
        total = np.bincount(index, weights=c)
        kinds = np.bincount(index)
        order = np.argsort(key)
        levels.append(Level(key[order], (np.maximum(c - discount, 0) / total[index])[order], contexts, discount * kinds / total))
    return levels


class Model(NamedTuple):
    langs: list[str]
    levels: list[list[Level]]
    highest: np.ndarray  # cross-entropy above which a text is none of the language's


def _probabilities(levels: list[Level], grams: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each sequence's last character after the others."""
    p = np.full(len(grams), 1 / 2000)  # of a letter never seen
    for k, level in enumerate(levels, 1):
        own = grams[:, ORDER - k :]
        weight = _look(level.contexts, level.weights, _hash(own[:, :-1]), 1.0)
        p = _look(level.keys, level.values, _hash(own), 0.0) + weight * p
    return np.log(np.maximum(p, 1e-12))


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _entropies(model: Model, text: Letters, rows: int, number: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy per character (rows, languages), characters and whether there is a letter, for each row.

    ``number`` tells models apart whose probabilities a worker keeps.
    """
    grams = _grams(text)
    codes, unique = pd.factorize(_hash(grams))
    keys, values = _cache.get(number, (np.zeros(0, U), np.zeros((0, len(model.langs)))))
    at = np.minimum(np.searchsorted(keys, unique), max(len(keys) - 1, 0))
    known = keys[at] == unique if len(keys) else np.zeros(len(unique), bool)
    table = np.empty((len(unique), len(model.langs)))
    if known.any():
        table[known] = values[at[known]]
    if not known.all():
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        new = grams[first[~known]]
        table[~known] = np.stack([_probabilities(levels, new) for levels in model.levels], axis=1)
        if len(keys) + len(new) > CACHED:
            keys, values = keys[:0], values[:0]
        merged = np.concatenate([keys, unique[~known]])
        order = np.argsort(merged)
        _cache.clear()
        _cache[number] = (merged[order], np.concatenate([values, table[~known]])[order])
    n = np.bincount(text.row, minlength=rows)
    sums = np.stack([np.bincount(text.row, weights=table[:, i][codes], minlength=rows) for i in range(len(model.langs))], axis=1)
    has_letter = np.bincount(text.row, weights=text.code != 32, minlength=rows) > 0
    return -sums / np.maximum(n, 1)[:, None], n, has_letter


def _predict(batches: Iterator[pa.RecordBatch], shared, number: int) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    names = np.array([*model.langs, "und"], dtype=object)
    for batch in batches:
        data, offsets = W.text_bytes(batch.column("text"))
        for a, b in W.spans(offsets):
            rows = b - a
            if model.langs:
                text = letters(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                h, n, has = _entropies(model, text, rows, number)
                best = h.argmin(axis=1)
                lowest = h[np.arange(rows), best]
                odds = np.exp(-(h - lowest[:, None]) * np.minimum(n, FULL_EVIDENCE)[:, None])
                score = np.where(has, 1 / odds.sum(axis=1), 0.0)
                rejected = ~has | (lowest > model.highest[best])
                best = np.where(has, best, len(model.langs))
            else:
                best, score, lowest, rejected = np.zeros(rows, int), np.zeros(rows), np.zeros(rows), np.ones(rows, bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(a, rows), pa.array(names[best], pa.string()), pa.array(score), pa.array(np.where(best < len(model.langs), lowest, 0.0)), pa.array(rejected)],
                ["id", "lang_pred", "score", "cross_entropy", "rejected"],
            )


def fold(id_col: str) -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Models of all languages named in rows outside the held-out fold.

    A fifth of a language's texts is set apart, to see which cross-entropies its texts have. A language with fewer than
    SMALL texts to learn from is counted whole. Where fewer than 5 texts set apart are long enough, no text of the
    language is rejected: its own counted texts would give too low a bound.
    """
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col) != HELD_OUT))
    sizes = {r.lang: r.n for r in usable.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], [], np.zeros(0))
    span = 1 << 31
    limits = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(span, sample_rows * span // n))])
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(span))
    few = [lang for lang, n in sizes.items() if n < SMALL]
    apart = (drawn % 5 == 0) & ~F.col(lang_col).isin(few)
    sample = usable.filter(drawn < limits[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), apart.alias("apart"))
    counted = sample.filter("NOT apart").select("lang", "text").mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    frame = counted.to_pandas()
    langs, levels = [], []
    for lang in sorted(frame["lang"].unique()):
        own = frame[frame["lang"] == lang].sort_values("gram")
        codes = np.frombuffer("".join(own["gram"]).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
        langs.append(lang)
        levels.append(kneser_ney(codes, own["n"].to_numpy()))
    model = Model(langs, levels, np.full(len(langs), np.inf))
    # what texts of each language that were not counted show
    apart = sample.filter("apart").select("lang", "text").toArrow()
    highest = np.full(len(langs), np.inf)
    if apart.num_rows and langs:
        data, offsets = W.text_bytes(apart.column("text").combine_chunks())
        h, n, _ = _entropies(model, letters(data, offsets), apart.num_rows, -1)
        _cache.clear()
        true = np.array(apart.column("lang").to_pylist(), dtype=object)
        for i, lang in enumerate(langs):
            own = h[(true == lang) & (n >= FULL_EVIDENCE), i]
            if len(own) >= 5:
                highest[i] = own.mean() + 4 * own.std() + 0.5
    return model._replace(highest=highest)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Language of every whole text: (id, held_out, lang_pred, score, cross_entropy, rejected) for each row.

    Learns from rows whose crc32(id as text) mod 3 is not 1, with a language and a text. Texts that are null or have
    no letter get ``und``, score 0 and rejected; so do all rows if there is nothing to learn from. The score is the
    probability of the language against the other learned ones, by at most FULL_EVIDENCE characters' worth of the
    cross-entropy of the whole text. Ties go to the first language by name. Null ids are predicted, not learned from
    and not held out. Other columns are ignored.
    """
    spark = docs.sparkSession
    model = fit(docs, id_col, text_col, lang_col, sample_rows)
    shared = spark.sparkContext.broadcast(model)  # bounded by sample_rows whole texts per language
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(partial(_predict, shared=shared, number=shared._jbroadcast.id()), f"id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")
    held = F.coalesce(fold("id") == HELD_OUT, F.lit(False))
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
