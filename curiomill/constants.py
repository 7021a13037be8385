"""They must equal the published behaviour for right results."""

from __future__ import annotations

# -- record -------------------------------------------------------------------
# fixed values: allowed work types
WORK_TYPES = ["Handwork", "Machine work", "Unknown"]

# fixed values: price bounds in INR
PRICE_CEILING = 830_000_000
PRICE_FLOOR = 10
LIMITED_EDITION_PRICE = 9_000_000
CONFIDENCE_PRICE_LOW = 8_300
CONFIDENCE_PRICE_HIGH = 83_000_000

# -- currency -----------------------------------------------------------------
# fixed values: rate table used by the stand-alone converter
RATES_TO_INR = {
    "INR": 1.0,
    "USD": 83.0,
    "EUR": 90.0,
    "GBP": 105.0,
    "JPY": 0.56,
    "CHF": 93.0,
    "CAD": 61.0,
    "AUD": 54.0,
    "CNY": 11.5,
    "SGD": 62.0,
    "AED": 22.6,
    "HKD": 10.6,
}

# fixed values: rates applied while extracting (GBP differs from the table above)
EXTRACTION_RATES = {"USD": 83.0, "EUR": 90.0, "GBP": 107.0}

# fixed values: sites whose currency is known, in order of precedence
CURRENCY_SITES = [
    ("USD", ["novica.com", "therealreal.com", "1stdibs.com", "rebag.com", "grailed.com", "saffronart.com"]),
    ("EUR", ["catawiki.com", "pamono.com"]),
    ("GBP", ["bonhams.com"]),
]

# fixed values: money symbols
CURRENCY_SYMBOLS = [("$", "USD"), ("€", "EUR"), ("£", "GBP"), ("₹", "INR"), ("rs", "INR"), ("inr", "INR")]

# -- sites --------------------------------------------------------------------
# fixed values: site classes
AUCTION_SITES = ["liveauctioneers.com", "bonhams.com"]
BLOCKED_SITES = ["1stdibs.com", "therealreal.com", "rebag.com", "grailed.com"]
DIRTY_SITES = [
    "therealreal.com", "1stdibs.com", "rebag.com", "grailed.com",
    "novica.com", "pamono.com", "catawiki.com", "chrono24.com",
]
STUB_PRICE_SITES = ["itokri.com"]
STUB_PRICE = 10000.0

# fixed values: seller shown for a site
SITE_SELLERS = [
    ("therealreal.com", "TheRealReal"),
    ("novica.com", "Novica"),
    ("itokri.com", "iTokri"),
    ("theindiacrafthouse.com", "The India Craft House"),
]
# fixed value: seller of this site only when no seller name is shown
UNNAMED_SELLERS = [("1stdibs.com", "1stDibs Verified Seller")]

# -- URLs ---------------------------------------------------------------------
# fixed values: a product page URL has one of these (case-sensitive)
PRODUCT_HINTS = ["/p/", "/products/", "/item/", "/listing/", "/id-", "/lot/", "/product/"]
# fixed values: junk URLs have one of these (lower-cased)
JUNK_PATHS = [
    "/pages/", "/policy", "/terms", "/contact", "/about", "/privacy", "login",
    "register", "cart", "checkout", "buyer-protection", "partnership", "faq", "/similar/",
]
# fixed values: links without a selector are dropped when they have one of these
LINK_EXCLUDES = [
    "/search", "/category", "/categories", "/filter", "/sort", "/login", "/register",
    "/account", "/cart", "/checkout", "/about", "/contact", "/help", "/faq", "/terms",
    "/privacy", "/sitemap", "#", "javascript:", "mailto:", ".pdf", ".jpg", ".png", ".gif",
]
# fixed values: scarcity words in a URL
RARITY_URL_WORDS = ["limited-edition", "/rare-", "-rare-", "one-of-a-kind", "1-of-1"]

# fixed values: href parts tried when a source's own selector matches nothing
FALLBACK_HREFS = ["/product", "/item", "/listing", "/id", "/p/"]
FALLBACK_HREFS_WIDE = FALLBACK_HREFS + ["/detail"]

# fixed values: texts of a next-page anchor (lower-cased)
NEXT_TEXTS = ["next", "next ›", "next »", ">", "»", "→"]

# -- page evidence --------------------------------------------------------------
# fixed values: selectors, first match wins
TITLE_SELECTORS = ["h1", ".product-title", ".product-name", '[data-testid="product-title"]', "title"]
PRICE_SELECTORS = [
    ".price", ".product-price", '[itemprop="price"]', "[data-price]", "#price", "span.amount", "p.price",
    ".current-price", ".money", ".price-item", ".price__regular", ".selling-price", ".regular-price",
]
DESCRIPTION_SELECTORS = [".product-description", '[itemprop="description"]', ".description", "#description"]
SPECS_SELECTORS = [
    ".specifications", "#specs", ".product-details", "#details", ".attributes",
    "table.woocommerce-product-attributes", "dl.product-info", ".features", "#features",
    '[data-testid="product-details"]',
]
BRAND_SELECTORS = [".brand", '[itemprop="brand"]', ".vendor", ".product-vendor"]

# fixed values: selectors of the wide form
WIDE_TITLE_SELECTORS = ["h1", "h1.product-title", ".product-name", '[data-testid="product-title"]', "title"]
WIDE_PRICE_SELECTORS = [
    ".price", ".product-price", '[itemprop="price"]', "[data-price]", ".Price", "#price", "span.amount",
    ".woocommerce-Price-amount", "p.price", ".offer-price", ".current-price", '[class*="price"]',
    ".item-price", ".productPrice", '[data-test="price"]',
]
WIDE_DESCRIPTION_SELECTORS = [
    ".product-description", '[itemprop="description"]', ".description", "#description", ".product-details",
    ".product-info", "article", ".summary", ".product-summary", '[class*="description"]',
]
WIDE_SPECS_SELECTORS = ['[itemprop="material"]', ".material", ".product-material", "td", "li", ".spec", ".attribute"]
SELLER_SELECTORS = [
    ".artist-name", ".seller-name", ".artist", '[itemprop="author"]', ".artisan", ".creator", ".by-artist",
]
ORIGIN_SELECTORS = ['[itemprop="countryOfOrigin"]', ".origin", ".country", ".made-in"]

# fixed values: an auction page is kept only with one of these (lower-cased)
AUCTION_MARKERS = [
    "estimate", "winning bid", "hammer price", "sold for", "price realized", "bidding closed",
]
# fixed values: marks of a line that may hold a price (case-sensitive)
PRICE_LINE_MARKS = ["Estimate", "Winning", "Rs", "$", "Price"]
# fixed values: characters of evidence handed to each provider
CONTENT_BUDGETS = {"ollama": 5000, "openai": 8000, "anthropic": 8000, "cerebras": 10000, "groq": 10000}

# -- lexicons -------------------------------------------------------------------
# fixed values: materials
MATERIALS = [
    "leather", "gold", "silver", "sterling", "wool", "silk", "cotton", "cashmere", "platinum", "ceramic",
    "crystal", "porcelain", "wood", "canvas", "nylon", "suede", "velvet", "linen", "brass", "bronze",
    "titanium", "stainless steel", "sterling silver", "togo leather", "monogram canvas", "alligator",
]
# fixed values: karats and gold colours
KARATS = ["10k", "14k", "18k", "22k"]
GOLD_COLOURS = ["yellow", "white", "rose"]
# fixed values: gems
GEMS = [
    "diamond", "ruby", "emerald", "sapphire", "pearl", "opal", "amethyst", "citrine", "topaz", "turquoise",
    "jade", "coral", "garnet",
]
# fixed values: precious metals, exotic skins, precious goods
PRECIOUS = [
    "gold", "platinum", "palladium", "rose gold", "white gold", "yellow gold", "silver", "sterling silver",
    "alligator", "crocodile", "ostrich", "python", "alligator leather", "crocodile leather",
    "ostrich leather", "python leather", "rosewood", "ebony", "shagreen",
]
# fixed values: nationality words
NATIONALITIES = [
    ("italian", "Italy"), ("french", "France"), ("indian", "India"), ("japanese", "Japan"), ("swiss", "Switzerland"),
]
# fixed values: country names
COUNTRIES = ["France", "Italy", "India", "Japan", "USA", "Switzerland", "UK"]
# fixed values: house brands, their country; all are made by machine unless said otherwise
HOUSES = [
    ("Hermès", "France"), ("Gucci", "Italy"), ("Louis Vuitton", "France"), ("Chanel", "France"), ("Burberry", "UK"),
]
# fixed values: craft regions
CRAFT_REGIONS = ["Kerala", "Rajasthan"]
# fixed values: colours and patterns
COLOURS = [
    "black", "white", "red", "blue", "green", "gold", "silver", "brown", "tan", "beige", "cream", "navy",
    "burgundy", "multicolor", "nude", "ivory", "monogram", "plaid", "floral", "striped", "checkered",
]
# fixed values: condition words
DEFECT_TERMS = [
    "scratches", "stains", "fraying", "missing parts", "fading", "odor", "light wear", "signs of use",
]
SCRATCH_TERMS = ["scratch", "scratches", "scuff", "scuffs", "surface marks"]
# fixed values: work type words
HANDWORK_TERMS = [
    "handmade", "hand-stitched", "hand-painted", "hand-knotted", "hand-embroidered", "artisan-made",
    "hand-crafted", "hand-blocked", "handloom",
]
MACHINE_TERMS = ["mass-produced", "manufactured", "factory-made", "ready-to-wear"]
# fixed values: rarity words in text
RARITY_TERMS = [
    "limited edition", "rare", "one-of-a-kind", "collectible", "numbered", "special edition", "exclusive",
    "vintage 1-of-1",
]

# -- run settings -----------------------------------------------------------------
# fixed values: defaults
TARGET_ROWS = 10_000
BREAKER_THRESHOLD = 5
BREAKER_COOLDOWN_SECONDS = 300
CHECKPOINT_ROWS = 100
MIN_DELAY_SECONDS = 2
MAX_DELAY_SECONDS = 7
MAX_ATTEMPTS = 3
RETRY_DELAY_SECONDS = 2
RETRY_BACKOFF = 2
DEFAULT_PRIORITY = 50
LINKS_PER_SEED = 15

# fixed values: CSV columns in order
CSV_COLUMNS = [
    "id", "scrape_timestamp", "source_url", "extraction_confidence",
    "material_used", "valuable_gem", "expensive_material", "origin", "date_of_manufacture", "defects",
    "scratches", "colour", "current_market_price_inr", "seller_reputation", "dimensions", "weight",
    "work_type", "brand", "limited_edition",
]
