"""Records from evidence text: lexicon rules by default, or the caller's own extractor."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curiomill.functions import lexicon as L
from curiomill.functions import money as M
from curiomill.functions.text import blank_to_null
from curiomill.operators.quality import validated
from curiomill.schemas import BLANKABLE_FIELDS, RECORD, RECORD_FIELDS

Extractor = Callable[[pd.DataFrame], pd.DataFrame]

RAW_RECORD = T.StructType([T.StructField("detected_currency", T.StringType())] + RECORD.fields)


def rule_records(evidence: DataFrame) -> DataFrame:
    """Add ``detected_currency`` and the 15 raw fields read by the lexicon rules from ``content``."""
    url, content = F.col("url"), F.col("content")
    base = evidence.withColumn("quoted", M.quoted_price(content)).withColumn("free", L.free_text(content))
    free = F.col("free")
    fields = {
        "material_used": L.material_used(free),
        "valuable_gem": L.valuable_gem(free),
        "expensive_material": L.expensive_material(free),
        "origin": L.origin(free),
        "date_of_manufacture": L.date_of_manufacture(free),
        "defects": L.defects(free),
        "scratches": L.scratches(free),
        "colour": L.colour(free),
        "current_market_price": F.col("quoted.price"),
        "seller_reputation": L.seller_reputation(url, free),
        "dimensions": L.dimensions(free),
        "weight": L.weight(free),
        "work_type": L.work_type(free),
        "brand": L.brand(free),
        "limited_edition": L.limited_edition(free),
    }
    kept = [F.col(c) for c in evidence.columns if c not in fields]
    return base.select(
        *kept,
        F.col("quoted.currency").alias("detected_currency"),
        *[fields[f].alias(f) for f in RECORD_FIELDS],
    )


def custom_records(evidence: DataFrame, extractor: Extractor) -> DataFrame:
    """Run the caller's extractor over Arrow batches.

    It gets (url, content) and returns ``detected_currency`` and the 15 fields for the same rows in the same order;
    columns it leaves out are null. Another number of rows is an error.
    """
    kept = [f for f in evidence.schema.fields if f.name not in RAW_RECORD.names]
    schema = T.StructType(kept + RAW_RECORD.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            plain = batch.astype(object)
            got = extractor(plain[["url", "content"]])
            if len(got) != len(plain):
                raise ValueError(f"the extractor returned {len(got)} rows for {len(plain)}")
            got = got.reindex(columns=RAW_RECORD.names).astype(object)
            got = got.where(got.notna(), None)
            yield pd.DataFrame({f.name: batch[f.name].array for f in kept} | {c: got[c].array for c in RAW_RECORD.names})

    return evidence.mapInPandas(run, schema)


def settle_records(raw: DataFrame) -> DataFrame:
    """Price arithmetic, bounds and blank rules on raw fields."""
    price = F.col("current_market_price")
    inr = F.when(price == 0, price).otherwise(
        M.extraction_to_inr(price, M.settle_currency(F.col("url"), F.col("detected_currency")))
    )
    settled = raw.withColumn("current_market_price", M.bound_price(inr)).withColumn(
        "work_type", F.coalesce("work_type", F.lit("Unknown"))
    )
    return settled.withColumns({f: blank_to_null(F.col(f)) for f in BLANKABLE_FIELDS})


def extract_records(evidence: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """Settled records with validity, error and confidence for rows of (url, content)."""
    raw = rule_records(evidence) if extractor is None else custom_records(evidence, extractor)
    return validated(settle_records(raw))


def envelopes(records: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Result envelope (success, data, confidence, error, stored) per URL of validated records."""
    data = F.struct(*RECORD_FIELDS).alias("data")
    error = F.when(F.col("error").isNotNull(), F.concat(F.lit("Validation failed: "), "error")).alias("error")
    columns = ["url", F.col("is_valid").alias("success"), data, "confidence", error]
    if stored is None:
        return records.select(*columns, F.col("is_valid").alias("stored"))
    marks = stored.select("url").distinct().withColumn("mark", F.lit(True))
    return records.join(marks, "url", "left").select(
        *columns, F.coalesce("mark", F.lit(False)).alias("stored")
    )
