"""Page evidence: what a product page says about title, price, description and so on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions import html as H
from curiomill.functions import selectors as S
from curiomill.functions import urls as U
from curiomill.functions.lexicon import price_line_mark
from curiomill.session import computed_once

NARROW = K.TITLE_SELECTORS + K.PRICE_SELECTORS + K.DESCRIPTION_SELECTORS + K.SPECS_SELECTORS + K.BRAND_SELECTORS
WIDE = (
    K.WIDE_TITLE_SELECTORS + K.WIDE_PRICE_SELECTORS + K.WIDE_DESCRIPTION_SELECTORS + K.WIDE_SPECS_SELECTORS
    + K.SELLER_SELECTORS + K.ORIGIN_SELECTORS
)


def page_metrics(pages: DataFrame) -> DataFrame:
    """Text and mark-up length per page."""
    return pages.select(
        "url",
        F.length(H.visible_text(F.col("html"))).cast("bigint").alias("text_length"),
        F.length("html").cast("bigint").alias("html_length"),
    )


def readable_pages(pages: DataFrame) -> DataFrame:
    """Add ``raw_text`` and ``skip_reason`` (null for pages to be read on)."""
    text = computed_once(pages.withColumn("raw_text", H.raw_text(F.col("html"))))
    reason = F.when(H.is_forbidden(F.col("status")), "forbidden").when(
        H.is_challenge(F.col("raw_text")), "challenge"
    )
    return text.withColumn("skip_reason", reason)


def with_nodes(pages: DataFrame, selectors: list[str]) -> DataFrame:
    """Add the array of tags that the selectors may want."""
    return pages.withColumn("nodes", S.nodes(H.dom(F.col("html")), selectors))


def title(nodes: Column, selectors: list[str] = K.TITLE_SELECTORS) -> Column:
    return S.first_text(nodes, selectors)


def price_text(nodes: Column, selectors: list[str] = K.PRICE_SELECTORS) -> Column:
    return S.joined_text(nodes, selectors, take=3)


def description(nodes: Column, selectors: list[str] = K.DESCRIPTION_SELECTORS) -> Column:
    return S.first_text(nodes, selectors, size=800, longer_than=30)


def specs(nodes: Column) -> Column:
    return S.joined_text(nodes, K.SPECS_SELECTORS, take=3, size=800, longer_than=20, drop_empty=False)


def wide_specs(nodes: Column) -> Column:
    return F.substring(S.joined_text(nodes, K.WIDE_SPECS_SELECTORS, take=8, separator=" | "), 1, 400)


def brand(nodes: Column) -> Column:
    return S.first_text(nodes, K.BRAND_SELECTORS, size=100, longer_than=2)


def seller(nodes: Column) -> Column:
    return S.first_text(nodes, K.SELLER_SELECTORS)


def origin(nodes: Column) -> Column:
    return S.first_text(nodes, K.ORIGIN_SELECTORS)


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}: "), value)


def assemble(url: Column, parts: list[Column], page_text: Column, size: int) -> Column:
    """Labelled lines, or the start of the page text when fewer than two lines were found."""
    lines = F.array_compact(F.array(*parts))
    body = F.when(F.size(lines) < 2, F.concat(F.lit("PAGE TEXT:\n"), F.substring(page_text, 1, size))).otherwise(
        F.array_join(lines, "\n")
    )
    return F.concat(F.lit("SOURCE URL: "), url, F.lit("\n\n"), body)


def evidence(pages: DataFrame) -> DataFrame:
    """Evidence of pages that ``readable_pages`` let through.

    The JSON-LD price stays a column of its own: it overrides the extracted price later, even where its line is
    not part of the content.
    """
    url, nodes = F.col("url"), F.col("nodes")
    staged = with_nodes(pages, NARROW).withColumn("ld", F.when(~U.is_auction(url), H.ld_offer(F.col("html"))))
    no_ld_price = F.coalesce(F.col("ld.price"), F.lit("")) == ""
    read = staged.select(
        *[c for c in pages.columns],
        F.col("ld.price").alias("ld_price"),
        F.col("ld.currency").alias("ld_currency"),
        F.col("ld.line").alias("ld_line"),
        title(nodes).alias("title"),
        F.when(no_ld_price, price_text(nodes)).alias("price_text"),
        description(nodes).alias("description"),
        specs(nodes).alias("specs"),
        brand(nodes).alias("brand"),
    )
    parts = [
        F.col("ld_line"),
        _line("TITLE", F.col("title")),
        _line("PRICE", F.col("price_text")),
        _line("DESCRIPTION", F.col("description")),
        _line("SPECS/DETAILS", F.col("specs")),
        _line("BRAND", F.col("brand")),
    ]
    return read.withColumn("content", assemble(url, parts, F.col("raw_text"), 5000))


def wide_evidence(pages: DataFrame) -> DataFrame:
    """Evidence of the wide form: more selectors, seller and origin, no JSON-LD."""
    nodes = F.col("nodes")
    read = with_nodes(pages, WIDE).select(
        *[c for c in pages.columns],
        title(nodes, K.WIDE_TITLE_SELECTORS).alias("title"),
        price_text(nodes, K.WIDE_PRICE_SELECTORS).alias("price_text"),
        description(nodes, K.WIDE_DESCRIPTION_SELECTORS).alias("description"),
        wide_specs(nodes).alias("specs"),
        seller(nodes).alias("seller"),
        origin(nodes).alias("origin"),
    )
    parts = [
        _line("TITLE", F.col("title")),
        _line("PRICE", F.col("price_text")),
        _line("DESCRIPTION", F.col("description")),
        _line("SPECS", F.col("specs")),
        _line("SELLER", F.col("seller")),
        _line("ORIGIN", F.col("origin")),
    ]
    return read.withColumn("content", assemble(F.col("url"), parts, H.visible_text(F.col("html")), 3000))


def passes_auction_gate(url: Column, content: Column) -> Column:
    """Auction pages need a price marker, other pages always pass."""
    return ~U.is_auction(url) | H.has_auction_marker(content)


def content_budget(content: Column, provider: Column) -> Column:
    """Start of the content, as much as the provider takes; unknown providers take all."""
    budget = F.lit(None).cast("int")
    for name, size in K.CONTENT_BUDGETS.items():
        budget = F.when(provider == name, F.lit(size)).otherwise(budget)
    return F.substr(content, F.lit(1), F.coalesce(budget, F.length(content)))


def price_lines(pages: DataFrame) -> DataFrame:
    """Numbered text lines that may hold a price."""
    return (
        pages.select("url", F.posexplode(H.text_lines(F.col("html"))).alias("line_no", "line"))
        .filter(price_line_mark(F.col("line")))
        .withColumn("line_no", F.col("line_no").cast("bigint"))
    )


def selector_coverage(pages: DataFrame, selectors: list[str], samples: int = 10) -> DataFrame:
    """Nodes and first sample texts per page and selector; computed inside each page's row."""
    hits = F.array(
        *[
            F.struct(F.lit(s).alias("selector"), S.matches(F.col("nodes"), s).alias("texts"))
            for s in selectors
        ]
    )
    return (
        with_nodes(pages, selectors)
        .select("url", F.explode(hits).alias("h"))
        .select(
            "url",
            "h.selector",
            F.size("h.texts").cast("bigint").alias("nodes"),
            F.slice("h.texts", 1, samples).alias("samples"),
        )
    )
