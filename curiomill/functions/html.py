"""Page text expressions: decoding, stripping, anchors and JSON-LD offers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions.text import contains_any, decode_entities, once, strip

# fixed value: JSON-LD block
LD_BLOCK = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""


def body_text(body: Column) -> Column:
    """Bytes to text; bytes that are not UTF-8 are dropped, replacement marks of the source are kept out too."""
    return F.replace(F.make_valid_utf8(body.cast("string")), F.lit("�"), F.lit(""))


def page_html(body: Column, text: Column, visible: Column) -> Column:
    """First non-empty of decoded body, given text and visible text."""
    return F.coalesce(
        F.nullif(body_text(body), F.lit("")), F.nullif(text, F.lit("")), visible, F.lit("")
    )


def raw_text(html: Column) -> Column:
    """Page text: script and style blocks out, tags out, white space collapsed, entities left as they are."""
    no_blocks = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    no_tags = F.regexp_replace(no_blocks, r"<[^>]*>", " ")
    return strip(F.regexp_replace(no_tags, r"(?U)\s+", " "))


def dom(html: Column) -> Column:
    """Mark-up as a parser sees it: no comments, no script or style content."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")


def visible_text(html: Column) -> Column:
    """Decoded text of all elements, parts separated by one blank."""
    return strip(
        decode_entities(F.regexp_replace(F.regexp_replace(dom(html), r"<[^>]*>", " "), r"(?U)\s+", " "))
    )


def text_lines(html: Column) -> Column:
    """Array of stripped text pieces, one per text node and line."""
    pieces = F.regexp_extract_all(dom(html), F.lit(r">([^<]+)"), F.lit(1))
    lines = F.flatten(F.transform(pieces, lambda p: F.split(strip(decode_entities(p)), "\n")))
    return F.filter(lines, lambda t: t != "")


def is_challenge(text: Column) -> Column:
    """Page text of a bot challenge."""
    return (
        text.contains("Cloudflare")
        | text.contains("Just a moment...")
        | F.lower(text).contains("attention required")
    )


def is_forbidden(status: Column) -> Column:
    """Only 403 blocks a page; other and unknown statuses pass."""
    return F.coalesce(status == 403, F.lit(False))


def has_auction_marker(content: Column) -> Column:
    return contains_any(F.lower(content), K.AUCTION_MARKERS)


# -- anchors ------------------------------------------------------------------

# opening anchor tag, its direct text, and the list item it is the first child of
ANCHOR = r"(?i)(?:<li(?:\s[^>]*)?>[^<]*)?<a(?:\s[^>]*)?>[^<]*"


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"""(?i)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
    return F.regexp_replace(quoted, r"""^["']|["']$""", "")


def anchors(html: Column) -> Column:
    """Array of the page's anchors in document order (``pos`` starts at 0).

    In three passes: what a lambda uses several times is worked out each time, unless an element holds it already.
    """

    def cut(token: Column) -> Column:
        return F.struct(
            F.regexp_extract(token, r"(?is)(<a(?:\s[^>]*)?>)[^<]*$", 1).alias("tag"),
            F.regexp_extract(token, r"(?is)^(<li(?:\s[^>]*)?>)", 1).alias("item"),
            F.regexp_extract(token, r"(?s)>([^<>]*)$", 1).alias("text"),
        )

    def raw(a: Column) -> Column:
        named = [_attribute(a["tag"], n).alias(n.replace("-", "_")) for n in ("href", "class", "rel", "data-tn", "aria-label")]
        numbered = a["tag"].rlike(r"(?i)\sdata-page-number[\s=>/]").alias("numbered")
        return F.struct(*named, a["text"].alias("text"), numbered, _attribute(a["item"], "class").alias("item_class"))

    def one(a: Column, index: Column) -> Column:
        return F.struct(
            index.cast("bigint").alias("pos"),
            strip(decode_entities(a["href"])).alias("href"),
            strip(decode_entities(a["text"])).alias("text"),
            *[decode_entities(a[c]).alias(c) for c in ("class", "rel", "data_tn", "aria_label")],
            a["numbered"].alias("numbered"),
            decode_entities(a["item_class"]).alias("item_class"),
        )

    return F.transform(F.transform(F.transform(F.regexp_extract_all(dom(html), F.lit(ANCHOR), F.lit(0)), cut), raw), one)


# -- JSON-LD ------------------------------------------------------------------


def _offers(blocks: Column) -> Column:
    """Offer object of each block as text; null when there is none. One pass for each step."""

    def single(b: Column) -> Column:
        first = F.when(b["offers"].startswith("["), F.get_json_object(b["block"], "$.offers[0]")).otherwise(b["offers"])
        return F.struct(b["usable"].alias("usable"), first.alias("single"))

    found = F.transform(blocks, lambda block: F.struct(
        block.alias("block"), F.get_json_object(block, "$.offers").alias("offers"),
        (F.try_parse_json(block).isNotNull() & F.ltrim(block).startswith("{")).alias("usable"),
    ))
    return F.transform(F.transform(found, single), lambda s: F.when(s["usable"] & s["single"].startswith("{"), s["single"]))


def ld_offer(html: Column) -> Column:
    """Struct (price, currency, line) of the JSON-LD offers of a page.

    The first block with a ``price`` key and a text currency ends the search. A block with a price but a currency
    that is not text sets the price and the search goes on, so the last such price counts when no block ends it.
    """

    def read(offer: Column) -> Column:
        keys = F.json_object_keys(offer)
        has_price = F.coalesce(F.array_contains(keys, "price"), F.lit(False))
        raw = F.coalesce(F.get_json_object(offer, "$.price"), F.lit("None"))
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(offer), "$.price", "variant"))
        price = F.when(kind == "BOOLEAN", F.initcap(raw)).otherwise(raw)
        money = F.try_variant_get(F.try_parse_json(offer), "$.priceCurrency", "variant")
        named = F.array_contains(keys, "priceCurrency")
        currency = (
            F.when(~named, F.lit("USD"))
            .when(F.schema_of_variant(money) == "STRING", F.upper(F.get_json_object(offer, "$.priceCurrency")))
        )
        return F.struct(has_price.alias("has_price"), price.alias("price"), currency.alias("currency"))

    blocks = F.transform(_offers(F.regexp_extract_all(html, F.lit(LD_BLOCK), F.lit(1))), read)

    def ends(priced: Column) -> Column:
        good = F.get(F.filter(priced, lambda b: b["currency"].isNotNull()), F.lit(0))
        return F.struct(good.alias("good"), F.get(F.reverse(priced), F.lit(0)).alias("last"))

    def told(end: Column) -> Column:
        good, last = end["good"], end["last"]
        return F.struct(
            F.coalesce(good["price"], last["price"]).alias("price"),
            F.coalesce(good["currency"], F.lit("USD")).alias("currency"),
            F.concat(F.lit("PRICE: "), good["price"], F.lit(" "), good["currency"]).alias("line"),
        )

    return once(once(F.filter(blocks, lambda b: b["has_price"]), ends), told)
