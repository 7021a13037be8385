"""Records from collected model responses: isolate JSON, parse, price arithmetic, strict coercion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions import money as M
from curiomill.functions.text import blank_to_null, strip
from curiomill.schemas import BLANKABLE_FIELDS, BOOL_FIELDS, RECORD_FIELDS, STRING_FIELDS
from curiomill.sources.tables import float_text

# fixed values: texts that count as a truth value
TRUE_WORDS = ["1", "on", "t", "true", "y", "yes"]
FALSE_WORDS = ["0", "off", "f", "false", "n", "no"]
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_FENCE = "```json"


def isolate_json(text: Column, provider: Column | None = None) -> Column:
    """JSON part of a response: inside a json fence, else from the first to the last brace.

    Two providers always answer with bare JSON and one is never fenced, so their text is taken that way.
    """
    braces = F.when(text.contains("{"), F.regexp_extract(text, r"(?s)\{.*\}", 0)).otherwise(text)
    fenced = F.when(
        text.contains(_FENCE), strip(F.regexp_extract(text, r"(?s)```json(.*)```", 1))
    ).otherwise(braces)
    if provider is None:
        return fenced
    return (
        F.when(provider.isin("ollama", "openai"), text).when(provider == "anthropic", braces).otherwise(fenced)
    )


def parse(text: Column) -> Column:
    """Variant of a JSON object; null for bad JSON and for anything but an object."""
    value = F.try_parse_json(text)
    return F.when(F.ltrim(text).startswith("{"), value)


READ_FIELDS = [*RECORD_FIELDS, "raw_price", "detected_currency"]


def fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns as the output of a generator, so that no later use or filter computes them again."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    out = df.withColumn("_fixed", F.explode(F.array(made)))
    return out.select(*[c for c in df.columns if c not in columns], *[F.col(f"_fixed.{n}").alias(n) for n in columns])


def flat_fields(responses: DataFrame, provider: Column | None = None) -> DataFrame:
    """Add ``_is_object`` and, for every field read, its JSON type (``_k_``: null when the key is absent, VOID for a
    JSON null) and its text (``_t_``). Each response is parsed once."""
    parsed = fixed(responses, _v=parse(isolate_json(F.col("response_text"), provider)))
    part = {f: F.try_variant_get("_v", f"$.{f}", "variant") for f in READ_FIELDS}
    found = fixed(parsed, _is_object=F.col("_v").isNotNull(), **{f"_p_{f}": c for f, c in part.items()}).drop("_v")
    flat = {}
    for f in READ_FIELDS:
        value = F.col(f"_p_{f}")
        flat[f"_k_{f}"] = F.schema_of_variant(value)
        flat[f"_t_{f}"] = F.try_variant_get(value, "$", "string")
    out = fixed(found, **flat)
    return out.drop(*[f"_p_{f}" for f in READ_FIELDS])


def _kind(field: str) -> Column:
    return F.col(f"_k_{field}")


def _text(field: str) -> Column:
    return F.col(f"_t_{field}")


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def price_key() -> Column:
    """Key that holds the price: the main key when present, even if null, else the raw one."""
    return F.when(_kind("current_market_price").isNotNull(), "current_market_price").when(_kind("raw_price").isNotNull(), "raw_price")


def price_raw() -> Column:
    """Text of the price worth computing with; null for null, N/A, empty and zero. Numbers have no exponent, and all
    but integers have at least one decimal."""
    main = _kind("current_market_price").isNotNull()
    kind = F.when(main, _kind("current_market_price")).otherwise(_kind("raw_price"))
    text = F.when(main, _text("current_market_price")).otherwise(_text("raw_price"))
    number = text.try_cast("double")
    zero = (_is_number(kind) & (number == 0)) | ((kind == "BOOLEAN") & (text == "false"))
    skip = kind.isNull() | (kind == "VOID") | zero | ((kind == "STRING") & text.isin("N/A", "", "0"))
    plain = F.when(_is_number(kind) & (kind != "BIGINT"), float_text(number)).otherwise(text)
    return F.when(~F.coalesce(skip, F.lit(True)), plain)


def computed_price(raw: Column, url: Column) -> Column:
    """Price in INR from the price text and currency; null where there is nothing to compute."""
    detected = F.when(_kind("detected_currency") == "VOID", "NONE").otherwise(_text("detected_currency"))
    return M.extraction_to_inr(M.parse_price(raw), M.settle_currency(url, detected))


def _string_field(field: str) -> tuple[Column, Column]:
    kind = _kind(field)
    bad = ~F.coalesce(kind.isin("VOID", "STRING"), F.lit(True))
    value = F.when(kind == "STRING", _text(field))
    return bad, (blank_to_null(value) if field in BLANKABLE_FIELDS else value)


def _bool_field(field: str) -> tuple[Column, Column]:
    kind, text = _kind(field), F.lower(_text(field))
    number = text.try_cast("double")
    value = (
        F.when(kind == "BOOLEAN", text == "true")
        .when(_is_number(kind) & number.isin(0.0, 1.0), number == 1.0)
        .when((kind == "STRING") & text.isin(TRUE_WORDS), F.lit(True))
        .when((kind == "STRING") & text.isin(FALSE_WORDS), F.lit(False))
    )
    bad = F.coalesce(kind != "VOID", F.lit(False)) & value.isNull()
    return bad, value


def _price_field(computed: Column) -> tuple[Column, Column]:
    field = "current_market_price"
    kind, text = _kind(field), strip(_text(field))
    given = (
        F.when(_is_number(kind), text.try_cast("double"))
        .when((kind == "STRING") & text.rlike(_NUMBER), text.try_cast("double"))
        .when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
    )
    value = F.coalesce(computed, given)
    bad = F.coalesce(kind != "VOID", F.lit(False)) & value.isNull()
    return bad, M.bound_price(value)


def _work_type_field() -> tuple[Column, Column]:
    kind, text = _kind("work_type"), _text("work_type")
    known = F.coalesce((kind == "STRING") & text.isin(K.WORK_TYPES), F.lit(False))
    return kind.isNotNull() & ~known, F.when(known, text).otherwise("Unknown")


def coerce(computed: Column) -> tuple[Column, Column]:
    """(first offending field or null, record struct) of flat fields. One bad field rejects the record; unknown keys
    do not."""
    checks: dict[str, tuple[Column, Column]] = {}
    for field in RECORD_FIELDS:
        if field in STRING_FIELDS:
            checks[field] = _string_field(field)
        elif field in BOOL_FIELDS:
            checks[field] = _bool_field(field)
        elif field == "work_type":
            checks[field] = _work_type_field()
        else:
            checks[field] = _price_field(computed)
    bad_field = reduce(
        lambda acc, f: F.when(checks[f][0], f).otherwise(acc), reversed(RECORD_FIELDS), F.lit(None).cast("string")
    )
    return bad_field, F.struct(*[checks[f][1].alias(f) for f in RECORD_FIELDS])


def parse_responses(responses: DataFrame, by_provider: bool = False) -> DataFrame:
    """Add ``record`` (null when rejected) and ``reject_reason`` to responses (url, provider, response_text)."""
    provider = F.col("provider") if by_provider else None
    flat = fixed(flat_fields(responses, provider), _raw=price_raw())
    flat = fixed(flat, _computed=computed_price(F.col("_raw"), F.col("url")))
    bad_field, fields = coerce(F.col("_computed"))
    reason = F.when(~F.col("_is_object"), "bad_json").when(F.col("_bad").isNotNull(), F.concat(F.lit("bad_field:"), "_bad"))
    read = fixed(flat, _bad=bad_field, _fields=fields).withColumn("reject_reason", reason)
    out = read.withColumn("record", F.when(F.col("reject_reason").isNull(), F.col("_fields")))
    return out.select(*responses.columns, "reject_reason", "record")


def with_fallback(parsed: DataFrame) -> DataFrame:
    """Primary record, else fallback record, else none: one row per URL with a primary response.

    One scan and one grouping by URL; of several usable responses of a provider the least record counts.
    """
    usable = F.col("record").isNotNull()
    best = parsed.groupBy("url").agg(
        F.max(F.col("provider") == "primary").alias("asked"),
        F.min(F.when(usable & (F.col("provider") == "primary"), F.col("record"))).alias("own"),
        F.min(F.when(usable & (F.col("provider") == "fallback"), F.col("record"))).alias("spare"),
    )
    used = F.when(F.col("own").isNotNull(), "primary").when(F.col("spare").isNotNull(), "fallback")
    return best.filter("asked").select(
        "url", F.coalesce("own", "spare").alias("record"),
        F.when(used.isNull(), "both_failed").alias("reject_reason"), used.alias("used"),
    )
