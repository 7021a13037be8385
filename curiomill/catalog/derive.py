"""Shop-like tables derived from the given tables, row by row and deterministic.

The given tables hold no listings, so product pages, listing pages, responses, stored products, sources and attempt
logs are built from ``part``, ``supplier`` and ``events``. Each definition is one SQL text that Spark and DuckDB both
run; its work grows with the table it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curiomill.session import computed_once

ROWS_A_TASK = 2_000

GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

_ROOT = """CASE {k} % 6 WHEN 0 THEN 'https://www.novica.com' WHEN 1 THEN 'https://www.catawiki.com'
 WHEN 2 THEN 'https://www.bonhams.com' WHEN 3 THEN 'https://www.liveauctioneers.com'
 WHEN 4 THEN 'https://itokri.com' ELSE 'https://www.chairish.com' END"""

_CATEGORY = "CASE {k} % 5 WHEN 0 THEN 'jewelry' WHEN 1 THEN 'art' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE 'rugs' END"

_PRODUCT_SELECTOR = """replace(CASE {k} % 6 WHEN 0 THEN 'a[href*=~/p/~]' WHEN 1 THEN 'a[href*=~/lot/~]'
 WHEN 2 THEN 'a[href*=~/lot/~]' WHEN 3 THEN 'a[href*="/item/"]' WHEN 4 THEN 'a[href*=~/products/~]' ELSE NULL END,
 '~', chr(39))"""

_NEXT_SELECTOR = """replace(CASE {k} % 5 WHEN 0 THEN 'a.next' WHEN 1 THEN 'a[rel=~next~]'
 WHEN 2 THEN 'a[data-tn=~page-forward~]' WHEN 3 THEN 'a[data-page-number]' ELSE NULL END, '~', chr(39))"""

SQL: dict[str, str] = {}

SQL["sources"] = f"""
SELECT s_suppkey AS pos, concat('src_', CAST(s_suppkey AS STRING)) AS name,
 CASE WHEN s_suppkey < 60 THEN concat(root, '/shop/s', CAST(s_suppkey AS STRING), '?page=', CAST(s_suppkey AS STRING))
  WHEN s_suppkey % 10 = 0 THEN concat(root, '/')
  ELSE concat(root, '/c/', CAST(s_suppkey AS STRING), '/') END AS base_url,
 {_CATEGORY.format(k='s_suppkey')} AS category,
 {_PRODUCT_SELECTOR.format(k='s_suppkey')} AS product_selector,
 {_NEXT_SELECTOR.format(k='s_suppkey')} AS next_page_selector,
 CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey % 7 * 15 END AS priority,
 CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS enabled
FROM (SELECT s_suppkey, {_ROOT.format(k='s_suppkey')} AS root FROM supplier) s
"""

SQL["listings"] = f"""
SELECT k, name, brand, type, size, retail, price, slug, root,
 CASE k % 6 WHEN 0 THEN concat('/p/', slug, '/', ks, '/') WHEN 1 THEN concat('/lot/', ks)
  WHEN 2 THEN concat('/auction/', CAST(k % 50 AS STRING), '/lot/', ks, '/') WHEN 3 THEN concat('/item/', ks, '_', slug)
  WHEN 4 THEN concat('/products/', slug, '-', ks) ELSE concat('/product/', ks, '/', slug) END AS path
FROM (SELECT p_partkey AS k, CAST(p_partkey AS STRING) AS ks, p_name AS name, p_brand AS brand, p_type AS type,
  p_size AS size, p_retailprice AS retail, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) AS price,
  concat(CASE WHEN p_partkey % 19 = 0 THEN 'the-rare-' WHEN p_partkey % 29 = 0 THEN 'cartier-' ELSE '' END,
   replace(lower(p_name), ' ', '-')) AS slug,
  {_ROOT.format(k='p_partkey')} AS root
 FROM part) p
"""

SQL["product_pages"] = """
SELECT k AS pos, concat(root, path) AS url,
 CASE WHEN k % 13 = 0 THEN 403 WHEN k % 31 = 0 THEN 404 WHEN k % 37 = 0 THEN NULL ELSE 200 END AS status,
 concat('<html><head><title>', name, ' | Shop</title><style>.price{color:red}</style>',
  '<script type="application/ld+json">', ld, '</script></head><body>',
  CASE WHEN k % 17 = 0 THEN '<p>Just a moment...</p>' ELSE '' END,
  CASE WHEN k % 9 = 8 THEN '' ELSE concat('<h1 class="product-title big"> ', name, ' ', CAST(k AS STRING), ' </h1>') END,
  '<!-- <b class="price">$1</b> -->', tag, body, specs, '<script>var p="<b class=price>9</b>";</script></body></html>'
 ) AS html
FROM (SELECT k, root, path, name,
  CASE WHEN k % 7 = 0 THEN '{"offers":{"price":"12'
   WHEN k % 11 = 0 THEN concat('{"@type":"Product","offers":[{"price":"', price, '","priceCurrency":"EUR"}]}')
   WHEN k % 8 = 1 THEN '{"offers":{"price":null,"priceCurrency":"USD"}}'
   WHEN k % 8 = 2 THEN concat('{"offers":{"price":', price, '1}}')
   WHEN k % 8 = 3 THEN concat('[{"offers":{"price":"', price, '"}}]')
   WHEN k % 8 = 4 THEN concat('{"offers":{"price":"', price, '","priceCurrency":null}}')
   WHEN k % 8 = 5 THEN concat('{"name":"x"}</script><script type="application/ld+json">{"offers":{"price":"Rs ', price,
    '","priceCurrency":"gbp"}}')
   WHEN k % 8 = 6 THEN '{"offers":{"price":"","priceCurrency":"USD"}}'
   ELSE concat('{"offers":{"price":"', price, '","priceCurrency":"USD"}}') END AS ld,
  CASE k % 5 WHEN 0 THEN concat('<span class="price">$', price, '</span><span class="price old">$1,000.00</span>')
   WHEN 1 THEN concat('<div class="big product-price">Rs ', price, '</div>')
   WHEN 2 THEN concat('<b class="price"> </b><i itemprop="price">€', price, '</i>')
   WHEN 3 THEN '' ELSE concat('<b id="price">£', price, '</b>') END AS tag,
  concat(CASE WHEN k % 3 = 2 THEN '<p id="description">' ELSE '<div class="product-description">' END,
   CASE k % 10
    WHEN 0 THEN 'Handmade 14k yellow gold ring with diamond and ruby, made in France, circa 1960. Size 38 EU, 1.5ct diamond.'
    WHEN 1 THEN 'Italian bag, Togo leather, black, 12 x 8 x 4 inches, light wear and scratches. Vintage 1980s.'
    WHEN 2 THEN 'Gucci monogram canvas tote, brown, ready-to-wear, 2019 collection, 1.2 lbs.'
    WHEN 3 THEN 'Hand-knotted wool and silk rug from Rajasthan, red floral, 30cm diameter, 2.5kg.'
    WHEN 4 THEN 'Limited edition sterling silver pendant with turquoise, coral and turquoise inlay, Swiss made, pre-owned, stains.'
    WHEN 5 THEN 'Free shipping over $150. Alligator leather wallet in navy, Hermès, numbered, signs of use, US 8.'
    WHEN 6 THEN 'Plain item.'
    WHEN 7 THEN '18k white gold brooch, rare, India, 50g, 1920s, scuff on the back, excellent condition.'
    WHEN 8 THEN 'Ceramic vase, blue and white, Japanese, 1890, 20 x 10 cm, fading &amp; odor.'
    ELSE 'Artisan-made ebony box, tan, USA, exclusive.' END,
   CASE WHEN k % 6 IN (2, 3) THEN CASE k % 4 WHEN 1 THEN ' Estimate: $800 - $1,200.' WHEN 2 THEN ' Winning Bid: $950.'
     WHEN 3 THEN ' Hammer price £1,050' ELSE '' END ELSE '' END,
   CASE WHEN k % 3 = 2 THEN '</p>' ELSE '</div>' END) AS body,
  concat(CASE WHEN k % 4 = 0 THEN '<div class="product-details"> Size and care: keep dry </div>' ELSE '' END,
   CASE WHEN k % 4 = 1 THEN concat('<span class="brand"> ', brand, ' </span><p class="seller-name">Studio 7</p>') ELSE '' END,
   CASE WHEN k % 5 = 2 THEN '<em class="made-in">Peru</em>' ELSE '' END,
   CASE WHEN k % 2 = 0 THEN '<table><tr><td>Weight</td><td> </td><td>3 kg</td></tr></table>' ELSE '<ul><li>One</li></ul>' END
  ) AS specs
 FROM listings) x
"""

SQL["listing_pages"] = f"""
SELECT k AS pos, concat(root, '/shop/s', CAST(k % 60 AS STRING), '?page=', CAST(k AS STRING)) AS url,
 {_CATEGORY.format(k='k')} AS category, {_PRODUCT_SELECTOR.format(k='k')} AS product_selector,
 {_NEXT_SELECTOR.format(k='k')} AS next_page_selector,
 concat('<html><body><!-- <a href="/item/0">hidden</a> --><nav><a href="/">Home</a><a href="#top">Top</a>',
  '<a href="mailto:x@example.com">Mail</a><a href="/about">About</a></nav>',
  CASE WHEN k % 9 IN (0, 4) THEN '' ELSE concat('<a href="', path, '" class="card">', name, '</a><a class="card" href="',
    path, '"><b>again</b></a><a href="', path, '?ref=1&amp;x=2">ref</a>') END,
  '<a href="more/', CAST(k AS STRING), '">rel</a><a href="../up/', CAST(k AS STRING), '.html">up</a><a href="?sort=1">sort</a>',
  CASE WHEN k % 9 = 4 THEN '' ELSE concat('<a href="//cdn.example.org/item/', CAST(k % 40 AS STRING), '">cdn</a>') END,
  CASE WHEN k % 9 = 4 THEN '' ELSE concat('<a href="https://www.other.com/product/', CAST(k % 70 AS STRING), '">ad</a>') END,
  '<a href="">none</a><a name="x">anchor</a>',
  CASE k % 8 WHEN 0 THEN concat('<a class="btn next" href="', nxt, '">More</a>')
   WHEN 1 THEN concat('<a href="', nxt, '" rel="next">2</a>') WHEN 2 THEN concat('<a data-tn="page-forward" href="', nxt, '">2</a>')
   WHEN 3 THEN concat('<a aria-label="Next" href="', nxt, '"></a>') WHEN 4 THEN concat('<li class="next"><a href="', nxt, '">2</a></li>')
   WHEN 5 THEN concat('<a href="', nxt, '"> Next » </a>') WHEN 6 THEN concat('<a data-page-number="2" href="', nxt, '">2</a>')
   ELSE '' END, '</body></html>') AS html
FROM (SELECT k, name, root, path, concat('/shop/s', CAST(k % 60 AS STRING), '?page=', CAST(k + 60 AS STRING)) AS nxt
 FROM listings) x
"""

SQL["calendar_pages"] = """
SELECT k AS pos, concat('https://www.bonhams.com/auctions/upcoming/?p=', CAST(k AS STRING)) AS url,
 concat('<html><a href="/auction/', CAST(k % 300 AS STRING), '/', replace(lower(name), ' ', '-'), '/">a</a><a href="/auction/',
  CAST(k % 300 AS STRING), '/lot/', CAST(k AS STRING), '/">lot</a><a href="/auctions/">all</a><a href="/auction/">none</a></html>') AS html
FROM listings
"""

SQL["visited"] = """
SELECT concat(root, path) AS url FROM listings WHERE k % 4 = 1
UNION ALL SELECT concat(root, path) FROM listings WHERE k % 8 = 1
"""

SQL["responses"] = """
SELECT k AS pos, url, 'primary' AS provider,
 CASE WHEN k % 23 = 0 THEN substring(json, 1, 40)
  WHEN k % 5 = 0 THEN concat('Sure.', chr(10), '```json', chr(10), json, chr(10), '```', chr(10), 'Done {ok}.')
  WHEN k % 5 = 1 THEN concat('Here it is: ', json, ' Thanks.')
  WHEN k % 41 = 3 THEN concat('[', json, ']') WHEN k % 47 = 2 THEN 'no data'
  ELSE json END AS response_text
FROM (SELECT k, concat(root, path) AS url, concat('{"material_used":"', CASE k % 3 WHEN 0 THEN ' sterling silver ' WHEN 1 THEN '' ELSE 'gold' END,
  '","origin":', CASE WHEN k % 4 = 0 THEN 'null' ELSE '"Peru"' END,
  CASE k % 4 WHEN 0 THEN ',"detected_currency":"USD"' WHEN 1 THEN ',"detected_currency":"gbp"' WHEN 2 THEN '' ELSE ',"detected_currency":null' END,
  CASE k % 10 WHEN 0 THEN ',"current_market_price":"$1,200.50"' WHEN 1 THEN ',"current_market_price":"N/A"'
   WHEN 2 THEN ',"current_market_price":0' WHEN 3 THEN ',"current_market_price":null'
   WHEN 4 THEN ',"current_market_price":"12,500 - 15,000"' WHEN 5 THEN concat(',"current_market_price":', price)
   WHEN 6 THEN ',"current_market_price":"1.234.56"' WHEN 7 THEN ',"current_market_price":""'
   WHEN 8 THEN ',"raw_price":"Rs. 3,390"' ELSE concat(',"current_market_price":', CAST(k AS STRING)) END,
  CASE k % 12 WHEN 0 THEN ',"work_type":"Handwork"' WHEN 1 THEN ',"work_type":null' WHEN 2 THEN ',"work_type":"Craft"'
   WHEN 3 THEN '' ELSE ',"work_type":"Machine work"' END,
  CASE k % 14 WHEN 0 THEN ',"brand":7' WHEN 1 THEN ',"brand":null' WHEN 2 THEN ',"brand":"  "' ELSE concat(',"brand":"', brand, '"') END,
  CASE k % 6 WHEN 0 THEN ',"scratches":true' WHEN 1 THEN ',"scratches":"Yes"' WHEN 2 THEN ',"scratches":0' WHEN 3 THEN ',"scratches":null'
   WHEN 4 THEN CASE WHEN k % 60 = 4 THEN ',"scratches":"maybe"' ELSE ',"scratches":false' END ELSE '' END,
  ',"weight":"  ","extra":{"a":[1,2]}}') AS json
 FROM listings) x
UNION ALL
SELECT k AS pos, concat(root, path) AS url, 'fallback' AS provider,
 CASE WHEN k % 9 = 0 THEN '{' ELSE concat('{"current_market_price":', price, ',"brand":"', brand, '"}') END AS response_text
FROM listings WHERE k % 3 = 0
"""

_PRODUCT_ROW = """{id} AS id,
 CAST(concat('2026-01-', lpad(CAST(k % 28 + 1 AS STRING), 2, '0'), ' 10:00:', lpad(CAST(k % 60 AS STRING), 2, '0')) AS TIMESTAMP)
  AS scrape_timestamp,
 {url} AS source_url,
 CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN CAST(0 AS DOUBLE) ELSE CAST(k % 20 AS DOUBLE) / 20 END AS extraction_confidence,
 CASE k % 4 WHEN 0 THEN 'sterling silver' WHEN 1 THEN 'gold' WHEN 2 THEN NULL ELSE '  ' END AS material_used,
 CASE k % 3 WHEN 0 THEN 'diamond, ruby' WHEN 1 THEN '' ELSE NULL END AS valuable_gem,
 CASE k % 5 WHEN 0 THEN '18k gold' ELSE NULL END AS expensive_material,
 CASE k % 3 WHEN 0 THEN 'Peru' WHEN 1 THEN 'India' ELSE NULL END AS origin,
 CASE WHEN k % 2 = 0 THEN '1960' ELSE NULL END AS date_of_manufacture,
 CASE WHEN k % 7 = 0 THEN 'light wear' ELSE NULL END AS defects,
 CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS scratches,
 CASE WHEN k % 6 = 0 THEN NULL ELSE 'red' END AS colour,
 CASE WHEN k % 17 = 0 THEN NULL WHEN k % 16 = 0 THEN CAST(0 AS DOUBLE) WHEN k % 22 = 10 THEN CAST(10000 AS DOUBLE)
  WHEN k % 23 = 0 THEN CAST(900000000 AS DOUBLE) + k WHEN k % 21 = 0 THEN CAST(9.5 AS DOUBLE)
  WHEN k % 12 = 5 THEN CAST(12000000 AS DOUBLE) + k
  ELSE CAST(CAST(retail * (k % 7 * 40 + 1) AS DECIMAL(18,2)) AS DOUBLE) END AS current_market_price,
 CASE WHEN k % 5 = 1 THEN 'Novica' ELSE NULL END AS seller_reputation,
 CASE WHEN k % 8 = 1 THEN '3 x 4 cm' ELSE NULL END AS dimensions,
 CASE WHEN k % 9 = 2 THEN '  ' ELSE NULL END AS weight,
 CASE k % 3 WHEN 0 THEN 'Handwork' WHEN 1 THEN 'Machine work' ELSE 'Unknown' END AS work_type,
 CASE WHEN k % 10 = 3 THEN NULL WHEN k % 10 = 4 THEN 'N/A' ELSE brand END AS brand,
 CASE k % 4 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS limited_edition"""

SQL["products"] = f"""
SELECT {_PRODUCT_ROW.format(id='k + 1', url='concat(root, path)')} FROM listings
UNION ALL
SELECT {_PRODUCT_ROW.format(id='k + 10000000', url='concat(root, path)')} FROM listings WHERE k % 10 = 0
UNION ALL
SELECT {_PRODUCT_ROW.format(id='k + 20000000', url="concat(root, path, '?src_cat=art')")} FROM listings WHERE k % 6 = 3
"""

SQL["attempts"] = """
SELECT event_id AS attempt_id, ts, concat('d', CAST(user_id % 20 AS STRING)) AS domain,
 concat('https://d', CAST(user_id % 20 AS STRING), '.example/', CASE WHEN event_id % 5 = 0 THEN 'c' ELSE 'p' END, '/',
  CAST(event_id % 3000 AS STRING)) AS url,
 CASE WHEN event_id % 5 = 0 THEN 'listing' ELSE 'product' END AS kind,
 event_type <> 'error' AS success,
 CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'no_price' WHEN 1 THEN 'extraction' WHEN 2 THEN 'validation'
  ELSE 'scrape' END ELSE NULL END AS failure_type,
 value AS scrape_time,
 CASE WHEN event_id % 7 = 0 THEN CAST(0 AS DOUBLE) WHEN event_id % 7 = 1 THEN NULL ELSE value * 2 END AS extraction_time,
 event_id % 4 + 1 AS attempt
FROM events
"""

NEEDS: dict[str, list[str]] = {
    "product_pages": ["listings"], "listing_pages": ["listings"], "calendar_pages": ["listings"], "visited": ["listings"],
    "responses": ["listings"], "products": ["listings"],
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given or derived table as a DataFrame."""
    if name in GIVEN:
        return given(spark, sf_dir, name)
    base = {"sources": "supplier", "attempts": "events"}.get(name)
    if base is not None:
        return _run(spark, SQL[name], base, given(spark, sf_dir, base))
    listings = _run(spark, SQL["listings"], "part", spread(given(spark, sf_dir, "part")))
    return listings if name == "listings" else computed_once(_run(spark, SQL[name], "listings", listings))


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a compact file dealt out over tasks of about ROWS_A_TASK rows.

    A row of a few bytes becomes a page of mark-up; a file of 128 MB, one task to Spark's reader, would be many GB of pages.
    """
    return computed_once(rows.repartition(max(1, -(-rows.count() // ROWS_A_TASK))))


def _run(spark: SparkSession, sql: str, base: str, df: DataFrame) -> DataFrame:
    marked = sql.replace("{", "{{").replace("}", "}}").replace(f"FROM {base}", "FROM {base}")
    return spark.sql(marked, base=df)


def with_tables(*names: str) -> str:
    """``WITH`` list that defines the derived tables for DuckDB."""
    order: list[str] = []
    for name in names:
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in order:
                order.append(needed)
    return ",\n".join(f"{n} AS ({SQL[n].strip()})" for n in order)
