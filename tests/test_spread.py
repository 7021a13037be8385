"""Compact input dealt out over tasks, and costly columns worked out once."""

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from curiomill.catalog import derive, stateful
from curiomill.operators import elements, evidence, links
from curiomill.plans import runs
from curiomill.session import run_settings
from curiomill.streaming.breaker import as_events, run_breaker, stream_breaker


def _parts(tmp_path, keys):
    pq.write_table(pa.table({
        "p_partkey": pa.array(keys, pa.int64()), "p_name": ["blue vase"] * len(keys), "p_brand": ["Brand#1"] * len(keys),
        "p_type": ["T"] * len(keys), "p_size": pa.array([1] * len(keys), pa.int64()), "p_retailprice": [901.5] * len(keys),
    }), tmp_path / "part.parquet")
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_of_one_file_are_made_by_several_tasks(spark, tmp_path):
    keys = [*range(3 * derive.ROWS_A_TASK), None, 7, 7, 7]
    sf = _parts(tmp_path, keys)
    for name in ("product_pages", "listing_pages"):
        made = derive.table(spark, sf, name)
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == len(keys) and len(sizes) >= 4 and max(sizes) <= 1.2 * derive.ROWS_A_TASK
        assert made.filter("pos = 7").count() == 4


def test_no_rows_and_few_rows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "few").mkdir()
    assert derive.table(spark, _parts(tmp_path / "none", []), "product_pages").count() == 0
    assert derive.table(spark, _parts(tmp_path / "few", [1, 2]), "product_pages").count() == 2


def test_filters_do_not_work_out_pages_again(spark):
    pages = spark.createDataFrame([(1, "https://x.com/p/1", "<p>a</p>", 200)], "pos long, url string, html string, status int")
    read = evidence.readable_pages(pages).filter("skip_reason IS NULL").select("url", "raw_text")
    assert _plan(read).count("script|style") == 1
    assert [tuple(r) for r in read.collect()] == [("https://x.com/p/1", "a")]


def test_anchors_are_worked_out_once(spark):
    html = '<li class="next"><a href="?p=2&amp;q=1" class="x" rel="next" data-tn="t" aria-label="L&lt;">Next &amp; on</a></li><a href="/i" data-page-number>1</a>'
    pages = spark.createDataFrame([("https://x.com/c/", html, "a.x"), ("https://x.com/d/", None, None)], "url string, html string, next_page_selector string")
    assert _plan(links.classify_links(pages)).count("data-tn") == 1
    nexts = links.next_page_links(pages)
    assert _plan(nexts).count("a\\.([\\w-]+)$") <= 4
    assert sorted(map(tuple, nexts.collect())) == [("https://x.com/c/", "https://x.com/c/?p=2&q=1"), ("https://x.com/d/", None)]
    first, second = links.with_anchors(pages).filter("html IS NOT NULL").select(F.explode("anchors").alias("a")).select("a.*").collect()
    assert first.asDict() == {
        "pos": 0, "href": "?p=2&q=1", "text": "Next & on", "class": "x", "rel": "next", "data_tn": "t", "aria_label": "L<", "numbered": False, "item_class": "next",
    }
    assert (second.pos, second.href, second.numbered, second.item_class) == (1, "/i", True, "")


def test_a_long_step_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "PAGES_A_FILE", 100)
    seen = []
    monkeypatch.setattr(runs.Run, "do_step", lambda self, step, pages, *rest: seen.append((step, len(pages.inputFiles()), pages.count())))
    pages = spark.range(400).select(
        F.col("id").alias("pos"), F.concat(F.lit("https://x.com/p/"), "id").alias("url"), F.lit("<p>a</p>").alias("html"), F.lit(200).alias("status"),
    )
    runs.run_in_steps(runs.Run(spark, str(tmp_path / "run")), pages, 300)
    assert [(s, n) for s, _, n in seen] == [(0, 300), (1, 100)]
    assert seen[0][1] >= 2


def test_pages_of_selectors_are_dealt_out_by_number(spark, monkeypatch):
    monkeypatch.setattr(elements, "PAGES_A_TASK", 10)
    pages = spark.range(200).select(F.col("id"), F.concat(F.lit("<ul><li>"), "id", F.lit("</li></ul>")).alias("html"))
    found = elements.select_texts(pages, {"items": "ul > li"})
    assert "RepartitionByExpression" in _plan(found) and ", 20" in _plan(found)
    assert sorted((r["id"], r["items"]) for r in found.collect()) == [(i, [str(i)]) for i in range(200)]


def test_breaker_state_has_as_many_parts_as_cores(spark, tmp_path):
    rows = [(i, f"d{i % 3}", datetime(2026, 1, 1, 0, i), i % 2 == 0) for i in range(30)]
    events = as_events(spark.createDataFrame(rows, "attempt_id long, domain string, ts timestamp, success boolean"))
    with run_settings(spark, {"spark.sql.shuffle.partitions": "50"}):
        stream = stream_breaker(stateful._in_time(spark, events, "few", 8), delay_seconds=60)
        made = run_breaker(stream, str(tmp_path / "out"), str(tmp_path / "marks"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    assert made.count() == 30
    assert len(list((tmp_path / "marks" / "state" / "0").glob("[0-9]*"))) <= spark.sparkContext.defaultParallelism
