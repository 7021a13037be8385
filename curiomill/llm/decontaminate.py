"""Operator 3: benchmark items inside documents, by size-partitioned MinHash containment search.

The shingles of an item are ordered by their hash, and its sketch is the smallest of them, so that a document holds a
known share of the sketch if it holds the item. Items are partitioned by the size of their shingle sets, and each
partition has a sketch size from its largest set: with n shingles of which at least a share t must be found, no more
than n - ceil(t n) of the sketch can be missing. So a document that has fewer of the sketch is no candidate, and none
is lost. Only shingles of documents below the largest sketch value are looked up. Candidates are verified by the exact
share of the item's shingles in the document. All steps are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiomill.llm.tables import kept

SHINGLE = 5
CONTAINED = 0.8


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; a text without any gives one empty word."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _hashes(words: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` words."""
    run = F.transform(F.sequence(F.lit(0), F.size(words) - length), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(length)]))
    return F.when(F.size(words) >= length, run).otherwise(F.array().cast("array<bigint>"))


def _item_sets(items: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(item, length of its shingles, ordered distinct hashes); an item with fewer words is one shingle of all of them."""
    split = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), F.explode(F.array(words_of(F.col(text_col)))).alias("words"))
    split = split.filter("words IS NOT NULL AND (size(words) > 1 OR words[0] <> '')").withColumn("length", F.least(F.size("words"), F.lit(shingle)))
    whole = F.lit(None)
    for n in range(1, shingle):
        whole = F.when(F.size("words") == n, _hashes(F.col("words"), n)).otherwise(whole)
    return split.select("item", "length", F.array_sort(F.array_distinct(F.coalesce(whole, _hashes(F.col("words"), shingle)))).alias("set"))


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    shingle: int = SHINGLE, share: float = CONTAINED,
) -> DataFrame:
    """Pairs of a document and an item of which it holds at least ``share`` of the distinct word shingles.

    Returns (id, item, item_shingles, found, containment), one row per pair. Words are runs of letters and digits in
    lower case. An item with fewer than ``shingle`` words counts as one shingle. Items without words, null texts and
    null ids give no pairs. Repeated items give their rows once; rows that share a document id, and rows that share an
    item id, are looked at one by one and give the pair with the highest containment. Other columns are ignored.
    """
    sets = kept(
        _item_sets(items, item_id, item_text, shingle).distinct()
        .withColumn("n", F.size("set")).withColumn("version", F.xxhash64("set"))
        .withColumn("need", F.ceil(F.round(F.col("n") * share, 9)).cast("int"))
        .withColumn("partition", F.floor(F.log2("n")).cast("int")), "items",
    )
    parts = sets.groupBy("partition").agg(F.max(F.col("n") - F.col("need")).alias("most_missing"))
    sketch = kept(
        sets.join(F.broadcast(parts), "partition")  # at most 31 rows
        .withColumn("slots", F.least(F.col("most_missing") + 1, "n"))
        .select("item", "version", F.greatest(F.col("slots") - (F.col("n") - F.col("need")), F.lit(1)).alias("hits"), F.explode(F.slice("set", 1, F.col("slots"))).alias("h")), "sketch",
    )
    highest = sketch.agg(F.max("h")).first()[0]
    lengths = sorted(r.length for r in sets.select("length").distinct().collect())  # at most as many as ``shingle``
    if highest is None:
        lengths, highest = [shingle], 0

    def shingles_of(rows: DataFrame) -> DataFrame:
        split = rows.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_version"), F.explode(F.array(words_of(F.col(text_col)))).alias("words"))  # a generator's output is not computed again for each use
        return split.select("doc", "text_version", F.concat(*[_hashes(F.col("words"), n) for n in lengths]).alias("hashes"))

    named = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    low = shingles_of(named).select("doc", "text_version", F.explode("hashes").alias("h")).filter(F.col("h") <= highest)
    found = low.join(sketch, "h").groupBy("doc", "text_version", "item", "version", "hits").agg(F.countDistinct("h").alias("seen")).filter("seen >= hits")
    candidates = kept(found.select("doc", "text_version", "item", "version"), "candidates")
    wanted = kept(candidates.select(F.col("doc").alias(id_col)).distinct(), "candidate_ids")
    held = shingles_of(named.join(wanted, id_col, "left_semi")).dropDuplicates(["doc", "text_version"])
    pairs = (
        candidates.join(held, ["doc", "text_version"]).join(sets.select("item", "version", "n", "need", "set"), ["item", "version"])
        .withColumn("found", F.size(F.array_intersect("set", "hashes"))).filter("found >= need")
        .select("doc", "item", F.struct((F.col("found") / F.col("n")).alias("containment"), "n", "found").alias("x"))
    )
    best = pairs.groupBy("doc", "item").agg(F.max("x").alias("x"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_id), F.col("x.n").alias("item_shingles"), F.col("x.found").alias("found"), F.col("x.containment").alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item.

    Ids play no part: texts and items are told apart by the hash of their text, so rows and items without an id, and
    rows that share one, are searched like all others. A null text holds nothing and stays.
    """
    def version(column: str) -> Column:
        return F.unhex(F.sha2(F.col(column), 256))

    texts = docs.select(version(text_col).alias("version_of_text"), F.col(text_col).alias("text"))
    wanted = items.select(version(item_text).alias("version_of_item"), F.col(item_text).alias("text"))
    found = contained_items(texts, wanted, "version_of_text", "text", "version_of_item", "text", **options)
    leaks = kept(found.select("version_of_text").distinct(), "leaks")
    return docs.join(leaks, F.unhex(F.sha2(docs[text_col], 256)) == leaks["version_of_text"], "left_anti")


ORACLE = """
WITH dw AS (
  SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL
), bw AS (
  SELECT item_id, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark WHERE text IS NOT NULL
), ds AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw WHERE len(w) >= 5)
), bs AS (
  SELECT DISTINCT item_id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM bw WHERE len(w) >= 5)
), bn AS (
  SELECT item_id, count(*) AS n FROM bs GROUP BY item_id
), hit AS (
  SELECT doc_id, item_id, count(*) AS found FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS item_shingles, CAST(found AS INTEGER) AS found, found / CAST(n AS DOUBLE) AS containment
FROM hit JOIN bn USING (item_id) WHERE found >= ceil(round(0.8 * n, 9))
"""
