"""Text measures, hashes and small helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """Whether a text is null or empty."""
    return _col(c).isNull() | (_col(c) == "")


def word_count(c: Column | str) -> Column:
    """The number of words between any white space; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(_col(c), SPACES), lambda w: w != "")), F.lit(0))


def content_hash(c: Column | str) -> Column:
    """MD5 of a text; null counts as empty."""
    return F.md5(F.coalesce(_col(c), F.lit("")))


def folded_hash(c: Column | str) -> Column:
    """MD5 of a text trimmed, lower-case and with single blanks; '' for null and blank ones."""
    t = F.regexp_replace(F.trim(F.regexp_replace(F.lower(_col(c)), r"\s+", " ")), "^$", "")
    return F.when(F.coalesce(t, F.lit("")) == "", "").otherwise(F.md5(t))


def shortened(c: Column | str, n: int, tail: str = "...") -> Column:
    """The first n characters, with ``tail`` where something was left off."""
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(tail))).otherwise(c)


def error_kind(c: Column | str) -> Column:
    """What stands before the first colon."""
    return F.split_part(_col(c), F.lit(":"), F.lit(1))


def slug(c: Column | str) -> Column:
    """A name for files: lower-case letters, digits and underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(c)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def compact_domain(c: Column | str) -> Column:
    """A domain without dots and hyphens."""
    return F.translate(_col(c), ".-", "")


def size_mb(c: Column | str) -> Column:
    return F.round(_col(c) / F.lit(1048576), 2)


def fallback_text(platform: Column | str, *columns: str) -> Column:
    """The first of a post's text columns that isn't blank."""
    return F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in columns))


def titled_text(title: Column | str, body: Column | str) -> Column:
    return F.concat_ws(" \n", _col(title), _col(body))


def is_proxy_error(c: Column | str) -> Column:
    """Whether an error text speaks of a proxy or a broken connection."""
    return F.coalesce(F.lower(_col(c)).rlike(r"proxy|socks|tunnel|connection refused|connection reset|network is unreachable"), F.lit(False))


def actor_from_title(c: Column | str) -> Column:
    """Whom a Danish reaction title says was liked; null if it says none."""
    return F.nullif(F.trim(F.regexp_extract(_col(c), r"synes godt om ([^']+?)(?:s\s|$)", 1)), F.lit(""))
