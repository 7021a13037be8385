"""Edge rows of single operators."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from curiomill.functions import money as M
from curiomill.operators import extraction, matching, reports, responses
from curiomill.plans.batch import process_pages


@pytest.mark.parametrize(
    ("text", "price"),
    [("$1,200.50", 1200.5), ("12,500 - 15,000", 1250015000.0), ("Rs. 3,390", 0.339), ("-5", 5.0), ("1.234.56", None), (".", None), ("", None)],
)
def test_parse_price(spark, text, price):
    assert spark.createDataFrame([(text,)], "t string").select(M.parse_price(F.col("t")).alias("p")).first().p == price


@pytest.mark.parametrize(
    ("json", "raw"),
    [("947.00", "947.0"), ("1.2e7", "12000000.0"), ("5", "5"), ("0", None), ("null", None), ('"N/A"', None), ('"7"', "7"), ("12.50", "12.5"), ("false", None)],
)
def test_price_text_of_numbers(spark, json, raw):
    rows = spark.createDataFrame([("u", "p", f'{{"current_market_price":{json}}}')], "url string, provider string, response_text string")
    assert responses.flat_fields(rows).select(responses.price_raw().alias("r")).first().r == raw


def test_exponents_reach_the_price(spark):
    rows = spark.createDataFrame([("https://x.org/1", "p", '{"current_market_price":1.2e7}')], "url string, provider string, response_text string")
    assert responses.parse_responses(rows).first().record.current_market_price == 12_000_000.0


def test_fallback_takes_one_row_a_url(spark):
    rows = spark.createDataFrame(
        [("a", "primary", "x"), ("a", "fallback", '{"brand":"q"}'), ("a", "fallback", '{"brand":"b"}'), ("c", "primary", '{"brand":"p"}'), ("d", "primary", "x"), ("e", "fallback", "{}")],
        "url string, provider string, response_text string",
    )
    made = {r.url: (r.used, r.record and r.record.brand, r.reject_reason) for r in responses.with_fallback(responses.parse_responses(rows)).collect()}
    assert made == {"a": ("fallback", "b", None), "c": ("primary", "p", None), "d": (None, None, "both_failed")}


def test_match_sources_is_one_path(spark):
    sources = [(7, "https://a.com/x"), (None, "https://a.com/x")] + [(100 + i, f"https://s{i}.org/c/{i}/") for i in range(12_000)]
    urls = [("https://a.com/x/y/z",), ("https://a.com/x",), ("https://a.com/",), ("https://s11999.org/c/11999/4",), ("https://s5.org/zz",), ("https://none.net/",)]
    made = matching.match_sources(spark.createDataFrame(urls, "url string"), spark.createDataFrame(sources, "pos long, base_url string"))
    assert {r.url: (r.match_class, r.source_pos) for r in made.collect()} == {
        "https://a.com/x/y/z": (2, 7), "https://a.com/x": (1, 7), "https://a.com/": (2, 7), "https://s11999.org/c/11999/4": (2, 12_099),
        "https://s5.org/zz": (3, 105), "https://none.net/": (None, None),
    }


def test_price_statistics(spark):
    made = reports.price_statistics(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (0.0,), (None,)], "current_market_price double")).first()
    assert (made["min"], made["max"], made["avg"], made["median"], made["count"]) == (1.0, 4.0, 2.5, 3.0, 4)
    empty = reports.price_statistics(spark.createDataFrame([], "current_market_price double")).first()
    assert (empty["min"], empty["median"], empty["count"]) == (0.0, 0.0, 0)


def _pages(spark, sf):
    from curiomill.catalog.derive import table

    return table(spark, sf, "product_pages").limit(60)


def test_extractor_sees_open_pages_only(spark, sf, tmp_path):
    path = str(tmp_path / "seen")

    def own(frame: pd.DataFrame) -> pd.DataFrame:
        import os
        import uuid

        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{uuid.uuid4().hex}", "w") as out:
            out.write("\n".join(frame["url"]))
        return pd.DataFrame({"current_market_price": [100.0] * len(frame), "work_type": "Unknown"})

    pages = spark.createDataFrame(_pages(spark, sf).collect(), _pages(spark, sf).schema)
    made = process_pages(pages, extractor=own).collect()
    import os

    seen = {line for name in os.listdir(path) for line in open(f"{path}/{name}").read().split("\n") if line}
    opened = {r.url for r in made if r.skip_reason is None and r.failure_type is None}
    assert opened <= seen
    assert not seen & {r.url for r in made if r.skip_reason is not None}
    assert len(made) == pages.count()


def test_extractor_must_keep_rows(spark):
    rows = spark.createDataFrame([("u", "a"), ("v", "b")], "url string, content string").coalesce(1)
    with pytest.raises(Exception, match="returned 1 rows for"):
        extraction.custom_records(rows, lambda f: f.head(1)).collect()
