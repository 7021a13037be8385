"""Streaming operators: decisions do not depend on triggers, and runs can be stopped and taken up again."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curiomill.operators.breaker import ATTEMPT, OPEN, fold, fold_events
from curiomill.operators.matching import match_sources
from curiomill.streaming import seen as seen_module
from curiomill.streaming.seen import SeenUrls


def _plain(rows, threshold, cooldown):
    """The breaker as its rule is told, one attempt after the other."""
    count, until, out = 0, None, []
    for t, good in rows:
        if until is not None and t < until:
            out.append((False, count, until))
            continue
        if until is not None:
            count, until = 0, None
        count = 0 if good else count + 1
        if count >= threshold:
            until = t + cooldown
        out.append((True, count, until))
    return out


def test_folds_agree_in_parts():
    rng = random.Random(1)
    for _ in range(400):
        n, threshold, cooldown = rng.randint(0, 60), rng.randint(1, 4), rng.randint(0, 12)
        ts = np.sort(np.array([rng.randint(0, 90) for _ in range(n)], np.int64))
        ok = np.array([rng.random() < 0.4 for _ in range(n)], bool)
        want = _plain(list(zip(ts.tolist(), ok.tolist(), strict=True)), threshold, cooldown)
        for one in (fold, lambda t, o, *rest: fold_events(t, np.full(len(t), ATTEMPT), o, *rest)):
            cut, state, got = sorted(rng.randint(0, n) for _ in range(2)), (0, OPEN), []
            for a, b in zip([0, *cut], [*cut, n], strict=True):
                allowed, counts, untils, *state = one(ts[a:b], ok[a:b], *state, threshold, cooldown)
                got += [(x, c, None if u == OPEN else u) for x, c, u in zip(allowed.tolist(), counts.tolist(), untils.tolist(), strict=True)]
            assert got == want


@pytest.mark.parametrize("files", [1, 2, 7])
def test_breaker_in_any_trigger(spark, files):
    """Rows mixed within the delay, one domain with a third of the log, rows without domain and without result."""
    from curiomill.catalog import stateful
    from curiomill.streaming.breaker import as_events

    rng = random.Random(2)
    rows = [(i, rng.choice(["hot", "hot", "hot", "a", "b", "c", "d", None]), 1_700_000_000 + i * 4000 + rng.randint(0, 3000), rng.choice([True, False, False, None])) for i in range(400)]
    log = spark.createDataFrame(rows, "attempt_id long, domain string, s long, success boolean").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    made = stateful._decided(spark, as_events(log), "log", files).collect()
    got = {r.attempt_id: (r.allowed, r.failure_count, r.blocked_until and int(r.blocked_until.timestamp())) for r in made}
    want = {}
    for domain in {r[1] for r in rows}:
        own = sorted((t, i, bool(good)) for i, d, t, good in rows if d == domain)
        want |= {i: x for (_, i, _), x in zip(own, _plain([(t, good) for t, _, good in own], stateful._LIMIT, stateful._WAIT), strict=True)}
    assert len(made) == len(rows) and got == want and sum(not x[0] for x in got.values()) > 20


# -- runs


def test_run_is_taken_up_after_a_crash(spark, sf, tmp_path, monkeypatch):
    """The second step fails after its folders were written, before its record."""
    from curiomill.catalog.derive import table
    from curiomill.plans.runs import Run, run_in_steps
    from curiomill.sources.store import stored_products

    pages = table(spark, sf, "product_pages").limit(60)
    pages = pages.unionByName(pages.withColumn("pos", F.col("pos") + 1_000_000))  # every URL twice

    def result(run):
        rows = stored_products(spark, run.store).select("id", "source_url", "current_market_price").collect()
        ends = run.outcomes().select("url", "skip_reason", "failure_type").collect()
        return sorted(map(tuple, rows)), sorted(map(tuple, ends), key=repr)

    whole = Run(spark, str(tmp_path / "whole"))
    run_in_steps(whole, pages, 25)
    want = result(whole)
    assert whole.committed() == [0, 1, 2] and len(want[1]) == 60 and len(want[0]) > 20

    path = str(tmp_path / "broken")
    kept = Run.commit

    def failing(self, step, n):
        if step == 1:
            raise RuntimeError("lost")
        kept(self, step, n)

    monkeypatch.setattr(Run, "commit", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run_in_steps(Run(spark, path), pages, 25)
    monkeypatch.setattr(Run, "commit", kept)
    again = Run(spark, path)
    assert again.committed() == [0] and again.outcomes().count() == 25
    run_in_steps(again, pages, 25)
    assert result(again) == want
    run_in_steps(again, pages, 25)  # nothing is left to do
    assert result(again) == want and again.committed() == [0, 1, 2]
    with pytest.raises(RuntimeError, match="another run"):
        again.commit(2, 1)

    again.clear()
    fresh = Run(spark, path)
    assert fresh.committed() == [] and fresh.rows() == 0 and fresh.outcomes().count() == 0
    run_in_steps(fresh, pages, 25, target_rows=5)
    assert fresh.rows() == 5


# -- phrases


def test_phrases_are_those_of_a_pattern(spark):
    import re

    from curiomill.operators.phrases import PhraseIndex, phrase_hits

    rng = random.Random(3)
    parts = ["gold", "white gold", "18k", "18k white gold", "gold-plated", "é", "red", "d'or", "or", "$x", "x$"]
    lexicon = {"a": parts[:6], "b": [*parts[4:], "Gold"], "none": []}
    pieces = [*parts, " ", " ", " ", "-", "é", "_", ".", "GOLD", "s", "\n"]
    texts = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))) for i in range(300)] + [(900, None), (901, ""), (902, "gold " * 50_000)]
    want = {}
    for i, text in texts:
        for field, terms in lexicon.items():
            words = sorted({t.lower() for t in terms}, key=lambda t: -len(t))
            for hit in re.findall(r"\b(" + "|".join(map(re.escape, words)) + r")\b", (text or "").lower()) if words else []:
                want[i, field, hit] = want.get((i, field, hit), 0) + 1
    rows = spark.createDataFrame([(i, t, 1) for i, t in texts], "k long, text string, hits int")
    made = phrase_hits(rows, "k", "text", lexicon).collect()
    assert {(r.k, r.field, r.term): r.hits for r in made} == want and len(made) == len(want)

    many = {"f": [f"term {i} of many" for i in range(100_000)]}
    index = PhraseIndex(many)
    assert index.hits("a term 77777 of many, Term 5 of many; term 5 of manys") == {(0, "term 77777 of many"): 1, (0, "term 5 of many"): 1}
    with pytest.raises(ValueError):
        phrase_hits(rows, "k", "text", {"f": ["x" * (1 << 26), "y"]})


def _urls(spark, numbers):
    return spark.createDataFrame([(None if k is None else f"https://s.org/{k}",) for k in numbers], "url string")


def test_seen_urls_across_batches(spark, tmp_path):
    """New URLs of each batch as with a set; a repeated batch gives the same rows, a batch without a record does not count."""
    seen, known = SeenUrls(spark, str(tmp_path / "seen")), set()
    batches = [[1, 2, 2, None], [2, 3], [], list(range(2, 900)), [None, 5, 1000, 1000]]
    for k, numbers in enumerate(batches):
        want = {f"https://s.org/{n}" for n in numbers if n is not None} - known
        for _ in range(2 if k in (1, 4) else 1):
            got = [r.url for r in seen.add(_urls(spark, numbers), f"a-{k}").collect()]
            assert len(got) == len(set(got)) and set(got) == want, k
        known |= want
    # stopped before its record was written: another run does not see its URLs
    seen.add(_urls(spark, [5000]), "b-0")
    for record in (tmp_path / "seen" / "commits").glob("*b-0~*"):
        record.unlink()
    again = SeenUrls(spark, str(tmp_path / "seen"))
    assert [r.url for r in again.add(_urls(spark, [5000, 1]), "c-0").collect()] == ["https://s.org/5000"]
    rows = [r.url for r in again.urls().collect()]
    assert len(rows) == len(set(rows)) and set(rows) == known | {"https://s.org/5000"}


def test_seen_urls_with_more_words(spark, tmp_path, monkeypatch):
    """Filters that fill up are made anew; afterwards all URLs are still known."""
    monkeypatch.setattr(seen_module, "FIRST_LEVEL", 4)
    seen = SeenUrls(spark, str(tmp_path / "seen"))
    for k, (a, b) in enumerate([(0, 3), (3, 400), (0, 5000), (4000, 6000)]):
        seen.add(_urls(spark, range(a, b)), f"a-{k}")
    assert len({level for level, _ in seen._committed().values()}) > 1
    assert seen.add(_urls(spark, range(0, 6100)), "b-0").count() == 100
    assert seen.urls().count() == seen.urls().distinct().count() == 6100


def test_match_sources_edge_rows(spark):
    sources = spark.createDataFrame([(1, "https://www.a.com/x"), (2, "https://www.a.com/x/y"), (None, "https://b.org/"), (3, "https://b.org/q"), (4, None), (0, "https://www.a.com/x")], "pos long, base_url string")
    urls = ["https://www.a.com/x", "https://www.a.com/x/y/z", "https://www.a.com/", "https://a.com/other", "https://b.org/zzz", "https://c.net/", "", None, None]
    made = match_sources(spark.createDataFrame([(u, k) for k, u in enumerate(urls)], "url string, pos int"), sources).collect()
    got = {r.pos: (r.match_class, r.source_pos) for r in made}
    assert len(made) == len(urls)
    assert [got[k] for k in (0, 1, 2, 3, 5, 7, 8)] == [(1, 0), (2, 0), (2, 0), (3, 0), (None, None), (None, None), (None, None)]
    assert got[4] == (2, None)


# -- product flow


def test_listing_flow_in_one_trigger(spark, tmp_path, monkeypatch):
    """Files by number of rows, all in one trigger; rows come twice, without a URL and without mark-up; the state lies on disk."""
    from curiomill.catalog import stateful
    from curiomill.sources.store import stored_products
    from curiomill.streaming import flow

    monkeypatch.setattr(stateful, "FILE_ROWS", 20)
    site = "https://itokri.com"
    page = '<h1 class="product-title">Ring</h1><b class="price">$1,200.00</b><div class="product-description">Handmade 14k yellow gold ring, made in France, circa 1960.</div>'
    listings = [(i, f"{site}/shop/{i}", f'<a href="/products/ring-{i}">a</a><a href="/products/ring-{i}">b</a><a href="/about">c</a>', "a[href*='/products/']", i) for i in range(60)]
    pages = [(i, f"{site}/products/ring-{i}", page, 403 if i % 10 == 0 else 200, i + (500 if i == 7 else 5)) for i in range(0, 60, 2)] + [(7, f"{site}/products/ring-7", page, 200, 500)]
    listings += [listings[2], (100, None, "", None, 3), (101, f"{site}/x", None, "a", 4)]
    pages += [pages[1], (200, None, page, 200, 5), (201, f"{site}/products/ring-3", None, 200, 5), (None, f"{site}/products/none", page, 200, 5)]

    def stream(rows, schema, name):
        made = spark.createDataFrame(rows, schema).withColumn("fetched_at", F.timestamp_seconds(F.lit(1_700_000_000) + 60 * F.col("minute"))).withColumn("rough", F.col("minute"))
        return stateful._all_in_one(spark, made.withColumn("category", F.lit(None).cast("string")).drop("minute"), name, 2)

    folders = []
    monkeypatch.setattr(stateful, "new_folder", lambda _, name: folders.append(str(tmp_path / name)) or folders[-1])
    lists, fetched = stream(listings, "pos long, url string, html string, product_selector string, minute long", "listings"), stream(pages, "pos long, url string, html string, status int, minute long", "pages")
    assert len(list((tmp_path / "listings").glob("part-*"))) == 4 and len(list((tmp_path / "pages").glob("part-*"))) == 2
    stored = flow.run_listing_flow(lists, fetched, str(tmp_path / "store"), str(tmp_path / "marks"))
    got = sorted(r.source_url for r in stored_products(spark, str(tmp_path / "store")).collect())
    assert got == sorted(f"{site}/products/ring-{i}" for i in range(0, 60, 2) if i % 10) and stored == len(got)
    assert [p.name for p in (tmp_path / "store").glob("batch=*")] == ["batch=0"]
    assert "RocksDB" in (tmp_path / "marks" / "offsets" / "0").read_text()


def test_costly_expressions_are_worked_out_once(spark):
    """A pattern stands once in the plan; named twice it is run twice, on every page."""
    from curiomill.functions import lexicon as L
    from curiomill.functions import money as M
    from curiomill.operators import links

    def plan(column):
        rows = spark.createDataFrame([], "t string, anchors array<struct<href string, class string, rel string, data_tn string, numbered boolean>>")
        return rows.select(column.alias("x"))._jdf.queryExecution().analyzed().toString()

    quoted = plan(M.quoted_price(F.col("t")))
    assert [quoted.count(p) for p in ("winning bid", "estimate[", "shipping", "rs|inr|usd")] == [1, 1, 1, 1]
    assert plan(L.origin(F.col("t"))).count("italian|") + plan(L.origin(F.col("t"))).count("|italian") <= 2
    assert plan(links.selected_anchors(F.col("t"))).count("data-tn=") == 1
    texts = [
        (None, 0.0, "INR"), ("", 0.0, "INR"), ("Free shipping over $150.", 0.0, "INR"), ("PRICE: €1,250.50", 1250.5, "EUR"),
        ("Estimate: $800 - $1,200. PRICE: 5", 1200.0, "USD"), ("Estimate £900", 900.0, "GBP"), ("Winning Bid: $950. Estimate: $1 - $2", 950.0, "USD"),
        ("Rs. 3,390 or $7", 3390.0, "INR"), ("Hammer price none", 0.0, "INR"),
    ]
    made = spark.createDataFrame([(i, t[0]) for i, t in enumerate(texts)], "i int, t string").select("i", M.quoted_price(F.col("t")).alias("q")).collect()
    assert {r.i: tuple(r.q) for r in made} == {i: t[1:] for i, t in enumerate(texts)}
