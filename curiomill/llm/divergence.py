"""Divergence of the sources of a language from each other, term by term, over run-length columns.

Counting: tasks count terms and their documents for each (lang, source) and the sums are added up. Terms in too few
documents of their language go. Terms with the same counts in all sources are one row with a length: the vocabulary is
reordered so that equal counts lie together. Rows are dealt into blocks of a language by hash; in a block they are
sorted by their counts, each source becomes a run-length encoded column, and for a pair of sources the boundaries of
both columns' runs are intersected and the measure of each common run is multiplied by its length.

All arithmetic is exact: whole numbers of 64 bits where they suffice, decimals or Python integers where not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curiomill.llm.tables import kept

SCALE = 1_000_000_000
MIN_DOCUMENTS = 10  # of the language, for a term to be kept
TOP_TERMS = 10
BLOCK_ROWS = 1 << 13  # expected rows (distinct count vectors) of a block
HELD_TERMS = 400_000  # terms a task counts before it passes the counts on
PAIR_VALUES = 1 << 20  # runs of pairs worked on at a time
WIDE = 1 << 32  # counts from here on are multiplied as Python integers

#: letters stay (A-Z in lower case), bytes of longer characters stay, all else parts terms
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, d): occurrences of a term in a group and documents of the group that hold it.

    Null text, lang and source count as ''. Every group also has one row with a null term, so that groups without
    terms are known.
    """
    given = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))

    def batch_of(counts: dict) -> Iterator[pa.RecordBatch]:
        rows = ((g[0], g[1], t, n, held[t]) for g, (terms, held) in counts.items() for t, n in terms.items())
        while part := list(islice(rows, 50_000)):
            lang, source, term, n, d = zip(*part, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang), pa.array(source), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                names=["lang", "source", "term", "n", "d"],
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        groups, size = set(), 0
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                    data = text.encode()
                    if (lang, source) not in counts:
                        counts[(lang, source)] = (Counter(), Counter())
                    terms, held = counts[(lang, source)]
                    size -= len(terms)
                    for own in _pieces(data):
                        terms.update(own)
                    held.update(set(own) if len(data) <= LONG else _distinct(data))
                    size += len(terms)
                if size > HELD_TERMS:
                    groups.update(counts)
                    yield from batch_of(counts)
                    counts, size = {}, 0
        groups.update(counts)
        yield from batch_of(counts)
        groups = iter(groups)
        while part := list(islice(groups, 50_000)):
            none = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in part]), pa.array([g[1] for g in part]), pa.nulls(none, pa.string()), pa.array([0] * none, pa.int64()), pa.array([0] * none, pa.int64())],
                names=["lang", "source", "term", "n", "d"],
            )

    found = given.mapInArrow(work, "lang string, source string, term string, n long, d long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


LONG = 1 << 22  # bytes; longer texts are counted part by part


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists of bounded size; parts end where a term ends."""
    if len(data) <= LONG:
        yield data.translate(LETTERS).split()
        return
    data = data.translate(LETTERS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + LONG)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _distinct(data: bytes) -> set[bytes]:
    found: set[bytes] = set()
    for own in _pieces(data):
        found.update(own)
    return found


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exactly."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + 2 * terms).cast("decimal(20,0)")
    return F.expr("1L") + F.call_function("div", above, below)


def _measure(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same for an array of counts."""
    below = int(total) + 2 * int(terms)
    if len(count) and int(count.max()) >= WIDE:
        return np.array([1 + SCALE * (int(c) + 2) // below for c in count], np.int64)
    return 1 + SCALE * (count + 2) // below


def run_lengths(value: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal values over rows that stand for ``length`` terms each: values and where each run ends."""
    end = np.cumsum(length)
    last = np.append(value[1:] != value[:-1], True)
    return value[last], end[last]


def pair_sums(columns: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, int]]:
    """Sum of the measure over all terms for each pair of run-length columns (p, ends): (first, second, sum).

    For one column against many at a time: run boundaries of both are merged, and each stretch between them counts
    once for each of its terms.
    """
    span = int(columns[0][1][-1])
    for i, (p, ends) in enumerate(columns):
        a = i + 1
        while a < len(columns):
            b, held = a, 0
            while b < len(columns) and (b == a or held + len(columns[b][1]) + len(ends) <= PAIR_VALUES):
                held += len(columns[b][1]) + len(ends)
                b += 1
            others = columns[a:b]
            offset = np.arange(b - a) * span
            theirs = np.concatenate([e + o for (_, e), o in zip(others, offset, strict=True)])
            q = np.concatenate([x for x, _ in others])
            mine = (ends[None, :] + offset[:, None]).ravel()
            cut = np.unique(np.concatenate([theirs, mine]))
            length = np.diff(cut, prepend=0)
            x, y = np.tile(p, b - a)[np.searchsorted(mine, cut)], q[np.searchsorted(theirs, cut)]
            value = (x - y) ** 2 // (x + y) * length
            sums = np.add.reduceat(value, np.searchsorted(cut, offset, "right"))
            for k in range(b - a):
                yield i, a + k, int(sums[k])
            a = b


def _block(groups: pd.DataFrame, rows: pd.DataFrame) -> Iterator[tuple[str, str, int]]:
    """Pair sums of one block: its sources with totals, and its distinct count vectors with lengths, sorted."""
    sources = groups["source"].to_numpy()
    place = {s: k for k, s in enumerate(sources)}
    if not len(rows):
        yield from ((sources[i], sources[j], 0) for i in range(len(sources)) for j in range(i + 1, len(sources)))
        return
    length = rows["length"].to_numpy(np.int64)
    sizes = np.fromiter(map(len, rows["sources"]), np.int64, len(rows))
    row = np.repeat(np.arange(len(rows)), sizes)
    own = np.array([place[s] for x in rows["sources"] for s in x], np.int64)
    count = np.concatenate([np.asarray(x, np.int64) for x in rows["counts"]])
    by_source = np.argsort(own, kind="stable")
    cut = np.searchsorted(own[by_source], np.arange(len(sources) + 1))
    columns = []
    for k in range(len(sources)):
        at = by_source[cut[k] : cut[k + 1]]
        dense = np.zeros(len(rows), np.int64)
        dense[row[at]] = count[at]
        value, ends = run_lengths(dense, length)
        columns.append((shares(value, groups["total"].iat[k], groups["terms"].iat[k]), ends))
    for i, j, value in pair_sums(columns):
        yield sources[i], sources[j], value


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """Pairs of sources of each language by divergence, and the terms that mark each source: lang, source, part
    (``pair`` or ``term``), item, value, rank.

    A language whose sources have no kept term gives pairs of value 0; a language with one source gives no pair.
    Counts, groups and vectors are only brought together by key; the pairs of a language are as many as are returned.
    """
    counts = kept(term_counts(docs), "term-counts")
    language = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sum("n").alias("lang_n"))
    vocabulary = language.filter(F.col("d") >= min_documents).select("lang", "term", "lang_n")
    per_lang = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    used = kept(counts.filter("n > 0").select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "kept-counts")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = counts.filter("term IS NULL").select("lang", "source")
    groups = kept(
        every.join(totals, ["lang", "source"], "left").join(per_lang, "lang", "left").na.fill(0, ["total", "terms", "lang_total"]),
        "groups",
    )

    vectors = used.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("v"))
    rows = kept(vectors.groupBy("lang", "v").agg(F.count("*").alias("length")), "count-vectors")
    blocks = rows.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).alias("blocks"))
    placed = groups.select("lang", "source", "total", "terms").join(blocks, "lang", "left").na.fill(1, ["blocks"])
    placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = rows.join(blocks, "lang").select(
        "lang", F.pmod(F.xxhash64("v"), F.col("blocks")).alias("block"), F.col("v.source").alias("sources"), F.col("v.n").alias("counts"), "length"
    )

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("source", kind="stable")
        if len(right):
            # equal counts lie together: by the sources that hold a term, then by its counts there
            order = sorted(range(len(right)), key=lambda i: (tuple(right["sources"].iat[i]), tuple(right["counts"].iat[i])))
            right = right.iloc[order]
        made = list(_block(left, right)) if len(left) else []
        lang = left["lang"].iat[0] if len(left) else ""
        names = {"lang": [lang] * len(made), "a": [m[0] for m in made], "b": [m[1] for m in made]}
        columns = {k: pd.Series(v, dtype=object) for k, v in names.items()}
        return pd.DataFrame(columns | {"value": np.array([m[2] for m in made], np.int64)})

    partial = placed.groupBy("lang", "block").cogroup(dealt.groupBy("lang", "block")).applyInPandas(work, "lang string, a string, b string, value long")
    sums = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = sums.select("lang", ways.alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    with_totals = used.join(groups, ["lang", "source"])
    scored = with_totals.select(
        "lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")
    ).filter("p > q")
    terms = scored.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _measure(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)


ORACLE = f"""WITH docs AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
hits AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
vocabulary AS (SELECT lang, term, count(*) AS lang_n FROM hits GROUP BY lang, term HAVING count(DISTINCT k) >= {MIN_DOCUMENTS}),
sizes AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM vocabulary GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM hits JOIN vocabulary USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes s ON g.lang = s.lang LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source, v, s.lang_total),
shares AS (SELECT g.lang, g.source, w.term, coalesce(n, 0) AS n, CAST(1 + ({SCALE}::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS HUGEINT) AS p,
  CAST(1 + ({SCALE}::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS HUGEINT) AS q
  FROM groups g JOIN vocabulary w ON g.lang = w.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term),
pairs AS (SELECT g.lang, g.source, h.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
terms AS (SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) FROM terms)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
