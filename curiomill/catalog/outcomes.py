"""What becomes of each product page, as SQL: skip reason, failure class, and the products that are stored."""

from __future__ import annotations

from curiomill import constants as K
from curiomill.catalog import content as C
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.records import CURRENCY_SITE, QUOTED

_PRICE = Q.to_inr("q_price", f"coalesce({CURRENCY_SITE}, q_currency)")
_CHALLENGE = "(contains(raw_text, 'Cloudflare') OR contains(raw_text, 'Just a moment...') OR contains(lower(raw_text), 'attention required'))"

# prices out of bounds are taken away before the check, so all invalid prices say the same but those that are too low
OUTCOMES = f"""{C.EVIDENCE}{QUOTED},
settled AS (SELECT url, {C.GATE} AS gate_open, CASE WHEN q_price = 0 THEN q_price ELSE {_PRICE} END AS inr FROM quoted),
bounded AS (SELECT url, gate_open, CASE WHEN inr > 0 AND inr <= 830000000 THEN round(inr, 2) END AS price FROM settled),
outcomes AS (SELECT t.pos, t.url, CASE WHEN NOT {Q.any_of('t.url', K.PRODUCT_HINTS)} THEN 'no_product_hint' WHEN {Q.any_of('lower(t.url)', K.JUNK_PATHS)} THEN 'junk_url' END AS url_reason,
  CASE WHEN t.status = 403 THEN 'forbidden' WHEN {_CHALLENGE} THEN 'challenge' END AS page_reason, b.gate_open, b.price FROM texts t LEFT JOIN bounded b ON b.url = t.url),
judged AS (SELECT pos, url, url_reason, page_reason, CASE WHEN NOT gate_open OR price IS NULL OR price < 10 THEN 'no_price' END AS fault FROM outcomes),
ends AS (SELECT pos, url, coalesce(url_reason, page_reason) AS skip_reason, CASE WHEN url_reason IS NULL AND page_reason IS NULL THEN fault END AS failure_type FROM judged)"""
