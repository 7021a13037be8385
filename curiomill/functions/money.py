"""Price text, currencies and conversion to INR."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions.text import found, once
from curiomill.functions.urls import has_rarity_word, site_currency

NUMBER = r"[0-9][0-9,]*(?:\.[0-9]+)?"


def parse_price(text: Column) -> Column:
    """Number left after deleting everything but digits and dots; null when that is no number."""
    return F.regexp_replace(text, r"[^\d.]", "").try_cast("double")


def bound_price(price: Column) -> Column:
    """Price with two decimals, null outside of (0, ceiling]."""
    return F.when((price > 0) & (price <= K.PRICE_CEILING), F.round(price, 2))


def settle_currency(url: Column, detected: Column) -> Column:
    """Currency of the site where it is known, else the detected code, else INR."""
    return F.coalesce(site_currency(url), F.upper(detected), F.lit("INR"))


def extraction_to_inr(price: Column, currency: Column) -> Column:
    """Convert the three currencies known at extraction time; others pass unchanged."""
    return reduce(
        lambda acc, item: F.when(currency == item[0], F.round(price * F.lit(item[1]), 2)).otherwise(acc),
        K.EXTRACTION_RATES.items(),
        price,
    )


def offer_to_inr(url: Column, ld_price: Column, ld_currency: Column) -> Column:
    """INR value of a JSON-LD price: site rule first, then its own currency; null when it is no number."""
    return extraction_to_inr(parse_price(ld_price), F.coalesce(site_currency(url), ld_currency))


def override_price(url: Column, price: Column, ld_price: Column, ld_currency: Column) -> Column:
    """JSON-LD price where it can be read, else the extracted one."""
    return F.coalesce(offer_to_inr(url, ld_price, ld_currency), price)


def override_limited_edition(url: Column, price: Column, limited: Column) -> Column:
    """True for very dear items and for rarity words in the URL, else unchanged."""
    return (
        F.when(price >= K.LIMITED_EDITION_PRICE, F.lit(True))
        .when(has_rarity_word(url), F.lit(True))
        .otherwise(limited)
    )


def quoted_price(text: Column) -> Column:
    """Struct (price, currency) that a listing text quotes.

    A winning bid or hammer price goes first, then the higher end of an estimate, then the PRICE line, then the
    first amount with a money symbol. Shipping thresholds do not count. No price gives 0.
    """
    codes = K.CURRENCY_SYMBOLS + [("usd", "USD"), ("eur", "EUR"), ("gbp", "GBP")]

    def quoted(clean: Column, bid: Column) -> Column:
        estimate = found(clean, rf"(?i)estimate[^0-9\n]*{NUMBER}(?:\s*[-–]\s*[^0-9\n]*{NUMBER})?")
        line = found(clean, rf"(?m)^PRICE: [^0-9\n]*{NUMBER}[^\n]*")
        symbol = found(clean, rf"(?i)(?:[$€£₹]|\brs\b\.?|\binr\b)\s*{NUMBER}")
        ranged = once(estimate, lambda e: F.when(e.isNotNull(), F.struct(F.lit(True).alias("high"), e.alias("segment"))))
        single = F.struct(F.lit(False).alias("high"), F.coalesce(line, symbol).alias("segment"))
        return once(bid, lambda b: F.when(b.isNotNull(), F.struct(F.lit(False).alias("high"), b.alias("segment"))).otherwise(F.coalesce(ranged, single)))

    def read(quote: Column) -> Column:
        amounts = F.transform(
            F.regexp_extract_all(quote["segment"], F.lit(NUMBER), F.lit(0)),
            lambda n: F.replace(n, F.lit(","), F.lit("")).cast("double"),
        )
        price = F.when(quote["high"], F.array_max(F.slice(amounts, 1, 2))).otherwise(F.get(amounts, F.lit(0)))
        mark = F.lower(F.regexp_extract(quote["segment"], r"(?i)([$€£₹]|\b(?:rs|inr|usd|eur|gbp)\b)", 1))
        currency = once(mark, lambda m: reduce(lambda acc, item: F.when(m == item[0], item[1]).otherwise(acc), codes, F.lit("INR")))
        return F.struct(F.coalesce(price, F.lit(0.0)).alias("price"), currency.alias("currency"))

    clean = F.regexp_replace(text, rf"(?i)shipping\s+(?:on\s+orders\s+)?(?:over|above)\s+[^0-9\n]*{NUMBER}", " ")
    bid = rf"(?i)(?:winning bid|hammer price)[^0-9\n]*{NUMBER}"
    return once(once(clean, lambda c: quoted(c, found(c, bid))), read)
