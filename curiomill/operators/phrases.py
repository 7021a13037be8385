"""Terms of a lexicon in texts, all fields in one scan.

A lexicon is an index of phrases (an Aho-Corasick automaton over its lower-cased terms), built once in each task, so
the time for a text depends on its length and its hits, not on the number of terms. Per field, hits are taken from left
to right, the longest first, and do not overlap.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_CHARACTERS = 1 << 26  # of all terms together: what is sent to the executors


def _inside(c: str) -> bool:
    """Does the character belong to a word?"""
    return c == "_" or c.isalnum()


class PhraseIndex:
    """Automaton over the terms; each knows the fields it belongs to."""

    def __init__(self, lexicon: dict[str, list[str]]) -> None:
        self.fields = list(lexicon)
        fields: dict[str, set[int]] = {}
        for k, terms in enumerate(lexicon.values()):
            for term in terms:
                if term:
                    fields.setdefault(term.lower(), set()).add(k)
        self.automaton = ahocorasick.Automaton()
        for term, own in fields.items():
            self.automaton.add_word(term, (term, tuple(own)))
        if fields:
            self.automaton.make_automaton()

    def hits(self, text: str) -> Counter:
        """(field number, term) -> number of whole-word hits."""
        text = text.lower()
        if not len(self.automaton):
            return Counter()
        found: dict[int, list[tuple[int, int, str]]] = {}
        for last, (term, own) in self.automaton.iter(text):
            start, end = last + 1 - len(term), last + 1
            # an edge of a word: exactly one side belongs to a word
            if (start > 0 and _inside(text[start - 1])) == _inside(term[0]) or (end < len(text) and _inside(text[end])) == _inside(term[-1]):
                continue
            for k in own:
                found.setdefault(k, []).append((start, -end, term))
        counts: Counter = Counter()
        for k, places in found.items():
            places.sort()
            free = 0
            for start, end, term in places:
                if start >= free:
                    counts[k, term] += 1
                    free = -end
        return counts


def phrase_hits(texts: DataFrame, key: str, text: str, lexicon: dict[str, list[str]]) -> DataFrame:
    """(key, field, term, hits): terms of each field in each text, as whole words in any case.

    Null and empty texts give no row. The lexicon is sent to the executors; one of more than MOST_CHARACTERS is refused.
    """
    size = sum(len(t) for terms in lexicon.values() for t in terms)
    if size > MOST_CHARACTERS:
        raise ValueError(f"a lexicon of {size} characters is too large to be sent to the executors")
    sent = texts.sparkSession.sparkContext.broadcast(lexicon)
    given = texts.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).filter("text <> ''")
    kind = given.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = PhraseIndex(sent.value)
        for batch in batches:
            rows, fields, terms, hits = [], [], [], []
            for a in range(0, batch.num_rows, 256):
                for i, t in enumerate(batch.column(1).slice(a, 256).to_pylist(), a):
                    for (k, term), n in index.hits(t).items():
                        rows.append(i)
                        fields.append(index.fields[k])
                        terms.append(term)
                        hits.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(fields, pa.string()), pa.array(terms, pa.string()), pa.array(hits, pa.int64())],
                names=["key", "field", "term", "hits"],
            )

    return given.mapInArrow(work, f"key {kind}, field string, term string, hits long").withColumnRenamed("key", key)
