"""Word lists, tables and limits.

Everything here is a default: the functions that use a list take it as a parameter, and
``sources.catalog.load_word_list`` reads replacements from text files.
"""

# Domain terms that are always kept and scored higher.
ALLOWLIST = (
    "agent", "agents", "agentic", "alignment", "benchmark", "chain-of-thought",
    "context window", "diffusion", "embedding", "embeddings", "evals", "fine-tune",
    "fine-tuning", "foundation model", "gpt", "gpu", "hallucination", "inference",
    "llm", "llms", "mcp", "mixture-of-experts", "moe", "multimodal", "o1", "o3",
    "open-source", "open-weights", "prompt", "prompt injection", "rag", "reasoning",
    "rlhf", "safety", "sft", "superintelligence", "tokenization", "tokens",
    "transformer", "vibe coding", "vision-language",
)

# Words that are no terms by themselves.
STOPWORDS = tuple(
    """
    a about above after again against all am an and any are aren as at be because been before being below
    between both but by can cannot could couldn day did didn do does doesn doing don down during each few for
    from further get got had hadn has hasn have haven having he her here hers herself him himself his how i if
    in into is isn it its itself just like ll may me might more most mustn my myself need no nor not now of
    off on once one only or other our ours ourselves out over own re s same say says shan she should shouldn
    so some such t than that the their theirs them themselves then there these they this those through to too
    under until up use used using ve very want was wasn we well were weren what when where which while who
    whom why will with won would wouldn y you your yours yourself yourselves also however thus therefore
    really even much many new old also going go come came take took make made see seen look looked find found
    think thought know knew time year years month months week weeks today yesterday tomorrow via per read
    reads post posts article articles newsletter tweet tweets ai artificial intelligence obj endobj endstream
    xref trailer startxref rdf pdf
    """.split()
)

# Hosts whose links are never followed, with their subdomains.
BLOCKED_HOSTS = (
    "x.com", "twitter.com", "t.co", "youtube.com", "youtu.be", "tiktok.com",
    "instagram.com", "facebook.com", "fb.com", "linkedin.com", "reddit.com",
    "pinterest.com", "threads.net", "mastodon.social", "bit.ly", "buff.ly", "lnkd.in",
    "ow.ly", "link.mail.beehiiv.com", "substack.com", "open.substack.com",
    "click.convertkit-mail.com", "beehiiv.com", "apps.apple.com", "play.google.com",
)

# File extensions that are never followed.
BLOCKED_EXTENSIONS = (
    ".pdf", ".zip", ".tar", ".gz", ".mp3", ".mp4", ".mov", ".jpg", ".jpeg", ".png",
    ".gif", ".webp", ".svg", ".ico", ".exe", ".dmg", ".pkg",
)

# Query parameters dropped from canonical URLs.
TRACKING_PARAMS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id",
    "utm_name", "fbclid", "gclid", "mc_cid", "mc_eid", "ref", "ref_src", "s", "t",
    "igshid", "spm",
)

# Meta properties that hold a page's publish time, by priority.
PUBLISHED_PROPERTIES = (
    "article:published_time", "og:article:published_time", "article:published",
)

# Sizes and limits.
TOKEN_PATTERN = r"[A-Za-z][A-Za-z0-9'\-]*[A-Za-z0-9]|[A-Za-z]"
MAX_N = 3
MIN_TOKEN_LEN = 2
TOP_TERMS_PER_ARTICLE = 20
MAX_TERMS_PER_DAY = 5000
MAX_ARTICLES_PER_TERM = 50
MAX_AUTHORS_PER_TERM = 10
BASELINE_DAYS = 30
BASELINE_FLOOR = 0.5
ALLOWLIST_BOOST = 1.5
EVER_PRESENT_FACTOR = 0.5
CANDIDATES_KEPT = 10
RERANK_INPUT = 40
EVIDENCE_KEPT = 10
BLURB_EVIDENCE = 8
EXCERPT_CHARS = 800
SNIPPET_CHARS = 280
SNIPPET_WORD_SHARE = 0.6
CHARS_PER_TOKEN = 4
EARLIEST_DATE = "2015-01-01"
MAX_ITEMS_PER_SOURCE = 50
LINKS_PER_ISSUE = 10
ISSUE_PATH_PREFIX = "/p/"
SITEMAP_DEPTH = 3
TWEET_TITLE_CHARS = 80
FEED_DAYS = 50
