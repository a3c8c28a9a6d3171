"""Default lists and limits. Every operator takes them as arguments."""

# Substrings that mark a URL as not being an article.
DENIED_URL_PARTS = (
    "/video/",
    "/videos/",
    "/audio/",
    "/live/",
    "/gallery/",
    "/podcast/",
    "/specials/",
    "sport",
    "crimea",
)

# Domains owned by one publisher.
PUBLISHER_GROUPS = (("bbc.co.uk", "bbc.com", "bbci.co.uk"),)

# Hosts that serve feeds on behalf of other publishers.
PROXY_FEED_HOSTS = ("feeds.feedburner.com",)

# Host prefixes of feed servers.
FEED_HOST_PREFIXES = ("rss.", "feeds.", "www.", "api.")

# Public suffixes of more than one label.
MULTI_PART_SUFFIXES = (".co.uk", ".org.uk", ".ac.uk", ".gov.uk", ".com.au", ".co.nz", ".co.za")

# Publishers whose articles are kept.
ALLOWED_DOMAINS = (
    "reuters.com", "bbc.com", "bbc.co.uk", "ft.com", "bloomberg.com", "cnbc.com", "wsj.com",
    "nytimes.com", "economist.com", "theguardian.com", "washingtonpost.com", "apnews.com",
    "businessinsider.com", "marketwatch.com", "yahoo.com", "forbes.com", "cnn.com", "nbcnews.com",
    "abcnews.go.com", "aljazeera.com", "www.channelnewsasia.com", "www.thenationalnews.com",
    "www.straitstimes.com", "vietnamnews.vn", "abcnews.go.com", "www.cbsnews.com", "www.foxnews.com",
    "www.latimes.com", "globalnews.ca", "www.ctvnews.ca", "www.telegraph.co.uk",
    "www.independent.co.uk", "www.the-independent.com", "www.irishtimes.com", "www.scotsman.com",
    "www.yorkshirepost.co.uk", "indianexpress.com", "www.ndtv.com", "gulfnews.com",
    "www.khaleejtimes.com", "allafrica.com", "www.timeslive.co.za", "www.businesslive.co.za",
    "thewest.com.au", "www.nzherald.co.nz", "qz.com", "www.tass.ru", "www.interfax.ru", "www.rbc.ru",
    "www.vedomosti.ru", "www.kommersant.ru", "www.lenta.ru", "www.nur.kz", "www.zakon.kz",
    "france24.com", "dw.com", "euronews.com", "npr.org", "foreignpolicy.com", "thediplomat.com",
    "scmp.com", "arstechnica.com", "techcrunch.com", "wired.com", "theverge.com",
    "themoscowtimes.com", "meduza.io", "tass.com", "newsru.com", "unian.info", "huffpost.com",
    "timesofindia.indiatimes.com", "rt.com", "asia.nikkei.com",
)

# Limits and defaults.
ALLOWED_LANGS = ("en", "ru")
MIN_TEXT_CHARS = 500
FINGERPRINT_CHARS = 500
MAX_PAGE_BYTES = 1_000_000
MAX_ROWS_PER_ARCHIVE = 100_000
MAX_ENTRIES_PER_FEED = 200
ERROR_TEXT_CHARS = 2000
EMBEDDING_DIM = 384
DEFAULT_MODEL = "intfloat/multilingual-e5-small"
MAX_EMBEDDING_SHARDS = 8
RETENTION_DAYS = 30
COVERAGE_CUT_PCT = 80
DEFAULT_DOMAIN = "unknown"
