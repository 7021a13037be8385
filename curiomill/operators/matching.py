"""Match URLs to their source: exact, else prefix in either direction, else equal site; configuration order decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiomill.functions.urls import site


def match_sources(urls: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``match_class`` (1 exact, 2 prefix, 3 site, null none) and ``source_pos`` to rows with a ``url``.

    One pass over the distinct URLs: each gives its keys (itself, its prefixes of the lengths that base URLs have, its
    site), which meet one table of the sources' keys in one equi-join; that table has one row per key. The first source
    by position decides; one without a position comes last. A null URL has no source.
    """
    first = sources.groupBy("base_url").agg(F.min("pos").alias("pos"))
    wanted = urls.select("url").distinct()
    # the distinct lengths of base URLs, a scalar subquery: there are no more than the longest has characters
    lengths = first.agg(F.array_sort(F.collect_set(F.length("base_url")))).scalar()
    keyed = wanted.withColumn("lengths", lengths).select("url", F.explode(_url_keys(F.col("url"), F.col("lengths"))).alias("k")).select("url", "k.*")
    known = _source_keys(first)
    found = F.struct("match_class", F.col("pos").isNull().alias("last"), F.col("pos").alias("source_pos"))
    best = keyed.join(known, ["match_class", "kind", "key"]).groupBy("url").agg(F.min(found).alias("best"))
    return urls.join(best.select("url", "best.match_class", "best.source_pos"), "url", "left")


def _key(match_class: int, kind: str, key: Column) -> Column:
    return F.struct(F.lit(match_class).cast("bigint").alias("match_class"), F.lit(kind).alias("kind"), key.alias("key"))


def _url_keys(url: Column, lengths: Column) -> Column:
    """A URL is looked up as itself, as the beginning of a base URL, by its own beginnings, and by its site."""
    beginnings = F.transform(F.filter(lengths, lambda n: n < F.length(url)), lambda n: _key(2, "starts with it", F.left(url, n)))
    return F.concat(F.array(_key(1, "equal", url), _key(2, "begins it", url), _key(3, "site", site(url))), beginnings)


def _source_keys(first: DataFrame) -> DataFrame:
    base = F.col("base_url")
    cuts = F.when(F.length(base) > 1, F.transform(F.sequence(F.lit(1), F.length(base) - 1), lambda n: _key(2, "begins it", F.left(base, n))))
    own = F.array(_key(1, "equal", base), _key(2, "starts with it", base), _key(3, "site", site(base)))
    none = F.array().cast("array<struct<match_class:bigint,kind:string,key:string>>")
    keys = first.select("pos", F.explode(F.concat(own, F.coalesce(cuts, none))).alias("k")).select("pos", "k.*")
    return keys.groupBy("match_class", "kind", "key").agg(F.min("pos").alias("pos"))
