"""The stages of the corpus pipeline on rows without ids, rows that share ids, and empty tables."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as pipeline

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, row_number_0 int"


@pytest.fixture(scope="module")
def words():
    vocabulary = [f"word{i}" for i in range(2000)]

    def drawn(n: int, seed: int) -> list[str]:
        rng = random.Random(seed * 1000 + n)
        return [rng.choice(vocabulary) for _ in range(n)]

    return drawn


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 5) for i, t in rows], DOCUMENT)


def test_one_of_each_group_stays(spark, words):
    a, b, c, d = (" ".join(words(80, k)) for k in range(4))
    near = " ".join([*words(80, 0)[:-1], "other"])
    rows = [(1, a), (1, b), (2, a), (None, c), (None, c), (None, d), (9, near), (5, d), (None, None), (7, ""), (7, ""), (3, None)]
    made = pipeline.near_dedup(spark, _docs(spark, rows), "")
    assert made.columns == _docs(spark, rows).columns
    kept = sorted(((r.doc_id, r.text) for r in made.collect()), key=repr)
    assert kept == sorted([(1, a), (1, b), (None, c), (5, d), (None, None), (7, ""), (7, ""), (3, None)], key=repr)


def test_items_are_found_without_ids(spark, words, tmp_path):
    item, other = " ".join(words(30, 5)), " ".join(words(25, 6))
    spark.createDataFrame([(1, item), (None, other), (2, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain, leak, second = " ".join(words(60, 7)), " ".join(words(40, 8) + item.split() + words(9, 9)), " ".join(other.split() + words(50, 10))
    rows = [(None, leak), (4, leak), (4, plain), (None, plain), (5, second), (None, None), (6, "")]
    made = pipeline.decontaminate(spark, _docs(spark, rows), str(tmp_path))
    assert made.columns == _docs(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in made.collect()), key=repr) == sorted([(4, plain), (None, plain), (None, None), (6, "")], key=repr)


def test_empty_table_through_all_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, docs, str(tmp_path))
        assert made.columns == docs.columns and made.count() == 0
    assert pipeline.packing(spark, docs, str(tmp_path)).count() == 0


def test_null_rows_through_all_stages(spark, sf):
    own = spark.read.parquet(f"{sf}/documents.parquet").limit(30)
    docs = own.unionByName(spark.createDataFrame([(None, None, None, None, None)] * 3, own.schema))
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), own.schema)
    assert pipeline.packing(spark, docs, sf).count() > 0


@pytest.mark.parametrize("name", ["svg", "object", "noscript", "template"])
def test_elements_without_end_drop_nothing_else(name):
    from curiomill.llm.htmltext import leaves

    page = f"<body><p>One &amp; two.</p><{name} id=x><p>Three.</p><p>Four.</p><{name}>five"
    assert [b.text for b in leaves(page)] == ["One & two.", "Three.", "Four.", "five"]
    closed = f"<p>One</p><{name}><p>gone</p></{name}><p>Two</p>"
    assert [b.text for b in leaves(closed)] == ["One", "Two"]


def test_text_only_elements_and_comments_without_end():
    from curiomill.llm.htmltext import leaves

    for rest in ("<script>var x = '<p>no</p>'", "<style>p{}<p>no</p>", "<!-- <p>no</p>", "<!-- no"):
        assert [b.text for b in leaves(f"<p>One</p>{rest}")] == ["One"]
    assert [b.text for b in leaves("a < b <!-- x --> c > d <p")] == ["a < b c > d <p"]


@pytest.mark.parametrize("piece", ['<p x="', "<a ", "<", "<!-- ", "<svg>", "<p>", '<p x="\'>', "</", "&amp;", "<object ", "<b"])
def test_hostile_markup_takes_linear_time(piece):
    import time

    from curiomill.llm.htmltext import leaves

    page = piece * (1_000_000 // len(piece))
    began = time.process_time()
    leaves(page)
    leaves(page + ">")
    assert time.process_time() - began < 20  # two pages of 1 MB; quadratic cost would be many minutes
