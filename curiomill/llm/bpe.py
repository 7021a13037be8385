"""Encoding and decoding with a public byte-level BPE vocabulary with word ends, as numpy merge rounds over many words.

A word becomes one symbol per byte; the last one carries the word end. The symbols of all new words of a block lie in
one flat array. Every round looks up each pair of neighbours by binary search in the sorted keys of the merges and joins,
in each word, the pair of the lowest rank. Long words go by rank instead: one round for each rank that occurs, over
chained symbols, so their cost grows with their length and not with its square.

Texts are cut into words once per document; words seen before are looked up in a bounded table of each task.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN_WORDS = 200_000  # words a task remembers; beyond, the table starts anew
BLOCK_WORDS = 1 << 16  # words looked up at a time
HELD_TOKENS = 1 << 19  # tokens of a batch of rows; a longer text is a batch of its own
LONG_WORD = 256  # bytes; longer words are merged rank by rank
NONE = np.int64(1) << 40  # rank of a pair that never merges


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if it is printable Latin-1, else the next free
    letter from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = dict(zip(plain, map(chr, plain), strict=True)) | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


OLD = re.compile("[^\\x00-\\u0377]")  # these characters have been settled since the first versions of all tables


def unsettled(text: str) -> bool:
    """Whether a text has characters without a category in Python's tables: the library's own tables may know them."""
    return OLD.search(text) is not None and any(unicodedata.category(c) == "Cn" for c in set(text))


class Vocabulary:
    """A vocabulary file of the ``tokenizers`` library: BPE with a word-end suffix over byte letters.

    Other kinds of files are refused. The pair keys must be such that a merge only joins what earlier merges made, as
    in every trained vocabulary; then all places of the lowest pair of a word can be joined in one round.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.source = file.read()
        given = json.loads(self.source)
        model, steps = given["model"], (given["normalizer"] or {}).get("normalizers", [])
        splits = (given["pre_tokenizer"] or {}).get("pretokenizers", [])
        suffix = model.get("end_of_word_suffix")
        if (
            model["type"] != "BPE" or not suffix or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges")
            or [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"]
            or splits[0]["behavior"] != "Removed" or not splits[0]["invert"] or splits[1]["add_prefix_space"] or splits[1]["use_regex"]
            or given.get("decoder") or steps[1]["pattern"] != {"Regex": r"\s+"} or any(t["normalized"] for t in given["added_tokens"])
        ):
            raise ValueError("not a vocabulary of lower-case words over byte letters with word ends")
        self.pattern = splits[0]["pattern"]["Regex"]
        ids = model["vocab"]
        letters = byte_letters()
        self.inside = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + suffix] for c in letters], np.int32)
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.tokens: list[str | None] = [None] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in chain(ids.items(), self.special.items()):
            self.tokens[i] = token
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([ids[a + b] for a, b in merges], np.int32)
        born = np.full(len(self.tokens), len(merges), np.int64)
        born[np.concatenate([self.inside, self.last])] = -1
        born[made] = np.arange(len(merges))
        if len(set(made.tolist())) < len(made) or (np.maximum(born[left], born[right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge of this vocabulary needs a later one")
        key = left * len(self.tokens) + right
        self.by_key = np.argsort(key)  # rank of each sorted key
        self.keys = key[self.by_key]
        self.made = made

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * len(self.tokens) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], NONE)


def _alternate(follows: np.ndarray) -> np.ndarray:
    """Of each run of places that overlap the one before, the first, third, ... place."""
    n = np.arange(len(follows))
    first = np.maximum.accumulate(np.where(follows, 0, n))
    return (n - first) % 2 == 0


def _rounds(v: Vocabulary, symbol: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge rounds over the symbols of many short words; returns symbols and their words, in order."""
    rank = np.full(len(symbol), NONE)
    inner = word[1:] == word[:-1]
    rank[:-1][inner] = v.ranks(symbol[:-1][inner], symbol[1:][inner])
    done_symbols, done_words = [], []
    while len(symbol):
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best = np.minimum.reduceat(rank, start)
        least = np.repeat(best, np.diff(np.append(start, len(symbol))))
        over = least == NONE
        if over.any():
            done_symbols.append(symbol[over])
            done_words.append(word[over])
            symbol, word, rank, least = symbol[~over], word[~over], rank[~over], least[~over]
            if not len(symbol):
                break
        at = np.flatnonzero(rank == least)
        at = at[_alternate(np.concatenate([[False], np.diff(at) == 1]))]
        symbol[at] = v.made[rank[at]]
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        at = np.cumsum(stay)[at] - 1
        symbol, word, rank = symbol[stay], word[stay], rank[stay]
        changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
        rank[changed] = NONE
        changed = changed[changed + 1 < len(symbol)]
        changed = changed[word[changed] == word[changed + 1]]
        rank[changed] = v.ranks(symbol[changed], symbol[changed + 1])
    if not done_symbols:
        return symbol, word
    symbol, word = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    return symbol[order], word[order]


def _by_rank(v: Vocabulary, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for long words: ranks in rising order over all words, symbols chained to their neighbours."""
    n = len(symbol)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.ones(n, bool)
    rank = np.full(n + 1, NONE)
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def look_up(at: np.ndarray) -> None:
        rank[at] = NONE
        at = at[after[at] < n]
        at = at[word[at] == word[after[at]]]
        rank[at] = v.ranks(symbol[at], symbol[after[at]])
        at = at[rank[at] < NONE]
        at = at[np.argsort(rank[at], kind="stable")]
        for part in np.split(at, np.flatnonzero(np.diff(rank[at])) + 1) if len(at) else ():
            r = int(rank[part[0]])
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(heap, r)
            waiting[r].append(part)

    look_up(np.arange(n))
    while heap:
        r = heapq.heappop(heap)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[alive[at] & (rank[at] == r)]
        if not len(at):
            continue
        at = at[_alternate(np.concatenate([[False], after[at[:-1]] == at[1:]]))]
        gone = after[at]
        symbol[at] = v.made[r]
        alive[gone] = False
        after[at] = after[gone]
        inner = after[at] < n
        before[after[at][inner]] = at[inner]
        look_up(np.unique(np.concatenate([at, before[at][before[at] >= 0]])))
    return symbol[alive], word[alive]


def encode_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, and how many each word has. Words are not empty."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    symbol = v.inside[data]
    end = np.cumsum(size) - 1
    symbol[end] = v.last[data[end]]
    word = np.repeat(np.arange(len(words)), size)
    long = (size > LONG_WORD)[word]
    parts = [_rounds(v, symbol[~long], word[~long], len(words))]
    if long.any():
        parts.append(_by_rank(v, symbol[long], word[long]))
    ids, word = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.argsort(word, kind="stable")
    return ids[order], np.bincount(word, minlength=len(words))


class Encoder:
    """Texts to token ids; remembers the words it has met, up to KNOWN_WORDS."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.word = regex.compile(v.pattern)
        self.mark = regex.compile("|".join(regex.escape(t) for t in sorted(v.special, key=len, reverse=True))) if v.special else None
        self.library: Any = None
        self.forget()

    def forget(self) -> None:
        """Only the special tokens are known; they are keyed by their ids."""
        own = list(self.v.special.values())
        self.known: dict[str | int, int] = {i: k for k, i in enumerate(own)}
        self.ids = np.array(own, np.int32)
        self.size = np.ones(len(own), np.int64)

    def _words(self, text: str) -> Iterable[str]:
        """Words of a text without special tokens."""
        if not text.isascii() and unsettled(text):
            return self._library_words(text)
        text = text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")  # sigma is never final
        text = text.lower()
        if len(text) <= 1 << 22:
            return self.word.findall(text)
        return (m.group() for m in self.word.finditer(text))

    def _library_words(self, text: str) -> list[str]:
        """Text with characters newer than Python's tables: cut by the library, whose tables decide."""
        if self.library is None:
            from tokenizers import Tokenizer

            whole = json.loads(self.v.source)
            whole["pre_tokenizer"] = whole["pre_tokenizer"]["pretokenizers"][0]
            self.library = Tokenizer.from_str(json.dumps(whole))
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def words(self, text: str) -> Iterable[str | int]:
        found = list(self.mark.finditer(text)) if self.mark is not None else []
        if not found:
            return self._words(text)
        parts, at = [], 0
        for m in found:
            parts += [self._words(text[at : m.start()]), [self.v.special[m.group()]]]
            at = m.end()
        return chain.from_iterable([*parts, self._words(text[at:])])

    def _look_up(self, words: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive words, and the number of ids of each."""
        new = list(set(words) - self.known.keys())
        if new:
            if len(self.known) + len(new) > KNOWN_WORDS:
                self.forget()
                new = list(set(words) - self.known.keys())
            ids, size = encode_words(self.v, [w.encode() for w in new])
            self.known.update(zip(new, range(len(self.size), len(self.size) + len(new)), strict=True))
            self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
        first = np.cumsum(self.size) - self.size
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        size = self.size[at]
        total = int(size.sum())
        return self.ids[np.repeat(first[at] - (np.cumsum(size) - size), size) + np.arange(total)], size

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; null counts as empty."""
        waiting: list[list[str | int]] = []
        held = 0
        for text in texts:
            words = self.words(text or "")
            if not isinstance(words, list):  # very long, or with special tokens: part by part
                yield from self._flush(waiting)
                waiting, held = [], 0
                parts = []
                words = iter(words)
                while part := list(islice(words, BLOCK_WORDS)):
                    parts.append(self._look_up(part)[0])
                yield np.concatenate(parts) if parts else np.zeros(0, np.int32)
                continue
            waiting.append(words)
            held += len(words)
            if held >= BLOCK_WORDS:
                yield from self._flush(waiting)
                waiting, held = [], 0
        yield from self._flush(waiting)

    def _flush(self, waiting: list[list[str | int]]) -> Iterator[np.ndarray]:
        if waiting:
            ids, size = self._look_up(list(chain.from_iterable(waiting)))
            ends = np.concatenate([[0], np.cumsum(size)])
            cut = np.cumsum([len(w) for w in waiting])
            yield from np.split(ids, ends[cut[:-1]])


def _rows(batch: pa.RecordBatch, name: str) -> Iterator[str | None]:
    """Values of a column in slices, so that no more than a slice exists as Python strings."""
    column = batch.column(batch.schema.get_field_index(name))
    for a in range(0, len(column), 256):
        yield from column.slice(a, 256).to_pylist()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with a column of token ids (array of int) instead of the text.

    Null text and text without a word give an empty array. Other columns are kept; one that already has the name of the
    new column is replaced. The vocabulary (one file of bounded size, read on the driver) is sent to each executor once.
    """
    v = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    others = [c for c in docs.columns if c not in (text, ids)]
    given = docs.select(*(F.col(f"`{c}`") for c in others), F.col(f"`{text}`").cast("string").alias(text))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(v.value)
        for batch in batches:
            at = 0
            for own in _grouped(encoder.encode(_rows(batch, text))):
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.concatenate(own))
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(own)) for c in batch.columns[:-1]), lists], names=[*others, ids])
                at += len(own)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]), f"`{ids}` array<int>"])
    return given.mapInArrow(work, schema)


def _grouped(found: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Neighbours with HELD_TOKENS values in all, or a little more."""
    own, held = [], 0
    for ids in found:
        own.append(ids)
        held += len(ids)
        if held >= HELD_TOKENS:
            yield own
            own, held = [], 0
    if own:
        yield own


def _spans(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Row ranges with at most HELD_TOKENS values in all, or of one row."""
    a = held = 0
    for i, n in enumerate(sizes):
        if held + n > HELD_TOKENS and i > a:
            yield a, i
            a, held = i, 0
        held += n
    if a < len(sizes):
        yield a, len(sizes)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text of their ids: the tokens joined by one space, special ones included, as a vocabulary
    without decoder asks. Null gives an empty text; ids that the vocabulary lacks are left out."""
    tokens = rows.sparkSession.sparkContext.broadcast(Vocabulary(path).tokens)
    others = [f for f in rows.schema.fields if f.name != text]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = pa.array(tokens.value, pa.string())
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
            for a, b in _spans(sizes):
                own = lists.slice(a, b - a)
                flat = own.flatten()
                good = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(token))), False)
                row = np.repeat(np.arange(b - a), sizes[a:b])[good.to_numpy(zero_copy_only=False)]
                names = token.take(flat.filter(good))
                real = names.is_valid()
                row, names = row[real.to_numpy(zero_copy_only=False)], names.filter(real)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b - a))]).astype(np.int32)
                joined = pc.binary_join(pa.ListArray.from_arrays(offsets, names), " ")
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f.name)).slice(a, b - a) for f in others), joined], names=[*(f.name for f in others), text])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), f"`{text}` string"])
    return rows.mapInArrow(work, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, and hashes of the ids and of the text they decode to."""
    both = decode(encode(docs.select("doc_id", "text"), path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
