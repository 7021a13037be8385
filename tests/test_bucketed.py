"""The bucketed store: plan without a shuffle of the store, two writers, repeated batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curiomill.schemas import PRODUCTS
from curiomill.sources import bucketed


def _batch(spark, urls, brand="b"):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "pos long, source_url string")
    made = [F.lit(None).cast(f.dataType).alias(f.name) for f in PRODUCTS.fields if f.name not in ("source_url", "brand")]
    return rows.select("pos", "source_url", F.lit(brand).alias("brand"), *made)


def _rows(spark, path):
    return sorted((r.id, r.source_url, r.brand) for r in bucketed.products(spark, path, buckets=4).collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def test_inserts_and_repeated_batches(spark, path):
    assert _rows(spark, path) == []
    bucketed.insert(_batch(spark, ["a", "b", "a", None]), path, "one", buckets=4)
    assert _rows(spark, path) == [(1, "a", "b"), (2, "b", "b")]
    bucketed.insert(_batch(spark, ["x", "a"]), path, "one", buckets=4)
    assert len(_rows(spark, path)) == 2
    held = bucketed.insert(_batch(spark, ["c", "b"], "n"), path, "two", buckets=4)
    assert _rows(spark, path) == [(1, "a", "b"), (2, "b", "b"), (3, "c", "n")]
    held = bucketed.insert(_batch(spark, []), path, "three", buckets=4)
    assert (held.version, held.rows) == (3, 3) and len(_rows(spark, path)) == 3


def test_first_writer_wins_and_the_other_tries_again(spark, path):
    bucketed.insert(_batch(spark, ["a"]), path, "zero", buckets=4)
    one = bucketed.stage(_batch(spark, ["a", "b", "c"], "one"), path, "one", buckets=4)
    two = bucketed.stage(_batch(spark, ["c", "d"], "two"), path, "two", buckets=4)
    assert _rows(spark, path) == [(1, "a", "b")]  # staged rows do not count
    assert bucketed.commit(spark, path, one)
    assert not bucketed.commit(spark, path, two)
    assert _rows(spark, path) == [(1, "a", "b"), (2, "b", "one"), (3, "c", "one")]
    bucketed.insert(_batch(spark, ["c", "d"], "two"), path, "two", buckets=4)
    assert _rows(spark, path) == [(1, "a", "b"), (2, "b", "one"), (3, "c", "one"), (4, "d", "two")]


def test_insert_tries_again_after_a_lost_race(spark, path, monkeypatch):
    plain, raced = bucketed.commit, []

    def late(spark, path, write):
        if not raced:
            raced.append(write.name)
            other = bucketed.stage(_batch(spark, ["b", "e"], "other"), path, "other", buckets=4)
            assert plain(spark, path, other)
        return plain(spark, path, write)

    monkeypatch.setattr(bucketed, "commit", late)
    held = bucketed.insert(_batch(spark, ["a", "b"], "mine"), path, "mine", buckets=4)
    assert _rows(spark, path) == [(1, "b", "other"), (2, "e", "other"), (3, "a", "mine")]
    assert raced[0] not in held.writes.values() and held.version == 2


def test_store_is_not_shuffled(spark, path):
    bucketed.insert(_batch(spark, ["a", "b"]), path, "one", buckets=4)
    rows = bucketed.fresh_rows(_batch(spark, ["a", "c"]), bucketed.products(spark, path, buckets=4), "pos", 4)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin") :]
    assert "Bucketed: true" in side and "Exchange" not in side[side.rindex("+- Sort") :]
    assert plan.count("Exchange hashpartitioning") == 2  # both of the batch
    assert [r.source_url for r in rows.collect()] == ["c"]


def test_another_session_reads_the_store(spark, path):
    bucketed.insert(_batch(spark, ["a", "b"]), path, "one", buckets=4)
    spark.sql("DROP TABLE " + bucketed._table(spark, path, 4))  # a new catalog over the same folder
    assert len(_rows(spark, path)) == 2
