"""URL algebra as column expressions. Each normaliser has its own semantics; they are kept apart on purpose."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import parse_qs, unquote, urlencode, urljoin, urlparse, urlunparse

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"
URL_IN_TEXT = r"https?://[^\s<>\"{}|\\^`\[\]]+"
HOST_IN_TEXT = r"https?://(?:[-\w.]|(?:%[\da-fA-F]{2}))+"

# Tracking parameters, by normaliser.
CLEAN_TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "fbclid", "gclid", "_ga", "_gl", "mc_cid", "mc_eid", "ref", "referrer", "source"]
DEDUP_TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "ref", "source", "campaign", "medium"]
CANONICAL_TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "fbclid", "gclid"]

# Domains and substrings of URLs that say little.
GENERIC_DOMAINS = ["google.com", "google.dk", "google.co.uk", "bing.com", "yahoo.com", "duckduckgo.com", "facebook.com", "instagram.com", "twitter.com", "linkedin.com", "youtube.com", "youtu.be", "login.microsoftonline.com", "accounts.google.com", "localhost", "127.0.0.1", "file://"]
GENERIC_PARTS = ["/search?", "/search/", "q=", "query=", "login", "signin", "signup", "auth", "logout", "signout", "redirect", "callback", "oauth"]
SOCIAL_DOMAINS = ["facebook.com", "fb.com", "facebook.dk", "fbcdn.net", "messenger.com", "workplace.com", "instagram.com"]
SHORTENERS = r"(?i)(t\.co|bit\.ly|tinyurl|goo\.gl|fb\.me|l\.facebook\.com)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def netloc(c: Column | str) -> Column:
    """The network location, lower-case, with port, user and ``www.``; '' without scheme or '//', null for null."""
    return F.lower(F.regexp_extract(_col(c), NETLOC, 1))


def domain(c: Column | str) -> Column:
    """netloc without one leading ``www.``."""
    return F.regexp_replace(netloc(c), r"^www[.]", "")


def domain_lenient(c: Column | str) -> Column:
    """domain of the trimmed URL, with https:// put before what has no http scheme; '' for null and empty ones."""
    t = F.trim(_col(c))
    full = F.when(t.startswith("http://") | t.startswith("https://"), t).otherwise(F.concat(F.lit("https://"), t))
    return F.when(F.coalesce(_col(c), F.lit("")) == "", F.lit("")).otherwise(domain(full))


def domain_or_empty(c: Column | str) -> Column:
    return F.coalesce(domain(c), F.lit(""))


def naive_domain(c: Column | str) -> Column:
    """What stands between the second and the third slash."""
    return F.split_part(_col(c), F.lit("/"), F.lit(3))


def query_value(c: Column | str, key: str) -> Column:
    """The decoded value of a query parameter; null where it is missing or can't be decoded."""
    raw = F.regexp_extract(_col(c), rf"[?&]{key}=([^&#]*)", 1)
    return F.try_url_decode(F.when(raw != "", raw))


def redirect_domain(c: Column | str, depth: int = 2) -> Column:
    """domain, or that of the address that a social link shim wraps (its parameter u), up to ``depth`` shims deep."""
    out = _col(c)
    for _ in range(depth):
        shim = out.rlike(r"facebook\.com/(?:l\.php|dyi/l)") & query_value(out, "u").isNotNull()
        out = F.when(shim, query_value(out, "u")).otherwise(out)
    return domain(out)


def first_domain(link: Column | str, shown: Column | str) -> Column:
    """domain of the link, else of the address shown; null where both are missing."""
    return F.coalesce(F.nullif(domain(link), F.lit("")), F.nullif(domain_lenient(shown), F.lit("")))


def urls_in_text(c: Column | str) -> Column:
    """All URLs in a text, with what punctuation follows them."""
    return F.regexp_extract_all(_col(c), F.lit(URL_IN_TEXT), F.lit(0))


def hosts_in_text(c: Column | str) -> Column:
    """All URLs in a text, cut after their host."""
    return F.regexp_extract_all(_col(c), F.lit(HOST_IN_TEXT), F.lit(0))


def first_url(c: Column | str) -> Column:
    """The first URL in a text without closing punctuation; null if there is none."""
    u = F.regexp_replace(F.regexp_extract(_col(c), r"https?://\S+", 0), r"[),.>\]\"\\]+$", "")
    return F.nullif(u, F.lit(""))


def _without_params(url: Column, dropped: list[str]) -> Column:
    """url without the parameters in ``dropped`` and without those that have no '='."""
    cut = F.instr(url, "?")
    base, query = F.when(cut > 0, F.substring(url, F.lit(1), cut - 1)).otherwise(url), F.when(cut > 0, F.substring(url, cut + 1, F.length(url)))
    keep = F.filter(F.split(query, "&"), lambda p: p.contains("=") & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(dropped))
    return F.when((cut > 0) & (F.size(keep) > 0), F.concat(base, F.lit("?"), F.array_join(keep, "&"))).otherwise(base)


@F.arrow_udf(StringType())
def lenient_unquote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Percent-decoding that leaves invalid escapes as they are; only for what strict decoding can't read."""
    for b in batches:
        yield pa.array([None if t is None else unquote(t) for t in b.to_pylist()], pa.string())


def unquoted(c: Column) -> Column:
    """Percent-decoding with '+' kept; texts with invalid escapes are left as they are."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def clean_url(c: Column | str) -> Column:
    """Trimmed, decoded, without fragment, tracking parameters and parameters without '='; '' for null."""
    url = F.split_part(unquoted(F.trim(_col(c))), F.lit("#"), F.lit(1))
    return F.coalesce(_without_params(url, CLEAN_TRACKING), F.lit(""))


def comparison_url(c: Column | str) -> Column:
    """clean_url without the decoding."""
    return F.coalesce(_without_params(F.split_part(F.trim(_col(c)), F.lit("#"), F.lit(1)), CLEAN_TRACKING), F.lit(""))


def dedup_url(c: Column | str) -> Column:
    """Lower-case scheme, location and path, with the parameters that aren't tracking; '' for null."""
    url = F.split_part(F.lower(F.trim(_col(c))), F.lit("#"), F.lit(1))
    kept = _without_params(url, DEDUP_TRACKING)
    return F.coalesce(F.regexp_replace(kept, r"^([^?]*?);[^/?]*(?=\?|$)", "$1"), F.lit(""))


@F.arrow_udf(StringType())
def canonical_url(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Lower-case, parameters parsed and encoded again, blank and tracking ones dropped, no trailing slash, no fragment."""

    def one(t: str | None) -> str:
        if not t:
            return ""
        t = t.strip().lower()
        try:
            p = urlparse(t)
            kept = {k: v for k, v in parse_qs(p.query).items() if k not in CANONICAL_TRACKING}
            return urlunparse((p.scheme, p.netloc, p.path.rstrip("/"), p.params, urlencode(kept, doseq=True), ""))
        except ValueError:
            return t

    for b in batches:
        yield pa.array([one(t) for t in b.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def join_url(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The absolute address of a reference found at a base; null if either is null, the reference as it is if the base is no URL."""

    def one(base: str | None, ref: str | None) -> str | None:
        if base is None or ref is None:
            return None
        try:
            return urljoin(base, ref)
        except ValueError:
            return ref

    for base, ref in batches:
        yield pa.array([one(a, b) for a, b in zip(base.to_pylist(), ref.to_pylist())], pa.string())


def meta_refresh_target(html: Column | str) -> Column:
    """The address in a meta refresh tag; null if there is none."""
    tag = F.regexp_extract(_col(html), r"(?is)<meta[^>]*http-equiv=[\"']?refresh[\"']?[^>]*>", 0)
    return F.nullif(F.trim(F.regexp_replace(F.regexp_extract(tag, r"(?i)url=([^;\"'>]+)", 1), r"^\s+|\s+$", "")), F.lit(""))


def shim_targets(html: Column | str) -> Column:
    """The addresses that a page's link shims wrap, decoded."""
    raw = F.regexp_extract_all(_col(html), F.lit(r"dyi/l/\?(?:[^\"'\s>]*?&)?[lu]=([^\"'&\s>]+)"), F.lit(1))
    return F.transform(raw, lambda x: F.coalesce(F.try_url_decode(x), x))


def permalink(platform: Column | str, user: Column | str, post: Column | str) -> Column:
    """The address of a post from its platform, author and id; null for other platforms."""
    p = F.lower(_col(platform))
    return (
        F.when(p == "telegram", F.concat(F.lit("https://t.me/"), _col(user), F.lit("/"), _col(post)))
        .when(p == "vk", F.concat(F.lit("https://vk.com/wall"), _col(user), F.lit("_"), _col(post)))
        .when(p == "youtube", F.concat(F.lit("https://www.youtube.com/watch?v="), _col(post)))
    )


def is_generic(url: Column | str, dom: Column | str) -> Column:
    """Whether a URL is of a generic domain or holds a generic part; missing ones are generic."""
    u, d = F.coalesce(_col(url), F.lit("")), F.coalesce(_col(dom), F.lit(""))
    parts = "|".join(p.replace("?", r"\?") for p in GENERIC_PARTS)
    return (u == "") | (d == "") | d.isin(GENERIC_DOMAINS) | F.lower(u).rlike(parts)


def is_social_or_search(url: Column | str) -> Column:
    """Whether a URL is of a social network or a search page."""
    u = _col(url)
    return domain_or_empty(u).isin(SOCIAL_DOMAINS) | F.coalesce(u.contains("google.com/search") | u.contains("bing.com/search"), F.lit(False))


def is_usable(url: Column | str) -> Column:
    """Whether a trimmed URL is under 2,048 characters, not blank and no zero address."""
    u = F.trim(_col(url))
    return F.coalesce((u != "") & (F.length(u) < 2048) & ~u.startswith("http://0/0/0"), F.lit(False))


def needs_resolution(original: Column | str, resolved: Column | str) -> Column:
    """Whether a URL is of a shortener, was never resolved or is short."""
    o = _col(original)
    return F.coalesce(o.rlike(SHORTENERS) | (o == _col(resolved)) | (F.length(o) < 30), F.lit(False))
