from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fjordmill.functions import text, times, urls


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("url, want", [("https://WWW.Foo.dk/x", "foo.dk"), ("http://user@foo.dk:8080/", "user@foo.dk:8080"), ("foo.dk/a", ""), ("//cdn.dk/x", "cdn.dk"), ("mailto:a@b.dk", ""), (None, None), ("http://www.www.dk/", "www.dk")])
def test_domain(spark, url, want):
    assert one(spark, urls.domain("x"), url) == want


def test_domain_variants(spark):
    assert one(spark, urls.domain_lenient("x"), "foo.dk/a") == "foo.dk"
    assert one(spark, urls.domain_lenient("x"), None) == ""
    assert one(spark, urls.netloc("x"), "http://www.www.dk/") == "www.www.dk"
    assert one(spark, urls.redirect_domain("x"), "https://l.facebook.com/l.php?u=https%3A%2F%2Fwww.a.dk%2Fb&h=1") == "a.dk"
    assert one(spark, urls.naive_domain("x"), "https://a.dk/b") == "a.dk"


@pytest.mark.parametrize(
    "url, want",
    [("https://a.dk/?utm_source=x&id=1#f", "https://a.dk/?id=1"), ("https://a.dk/?flag", "https://a.dk/"), ("https://a.dk/?UTM_Source=1&q=2", "https://a.dk/?q=2"), ("https://a.dk/p%20q", "https://a.dk/p q"), ("https://a.dk/?u=%23x&z=2", "https://a.dk/?u="), ("https://a.dk/a+b", "https://a.dk/a+b"), (None, ""), ("https://a.dk/%zz", "https://a.dk/%zz")],
)
def test_clean_url(spark, url, want):
    assert one(spark, urls.clean_url("x"), url) == want


def test_other_normalisers(spark):
    assert one(spark, urls.dedup_url("x"), "HTTP://A.dk/P;v=1?b=2&ref=x#f") == "http://a.dk/p?b=2"
    assert one(spark, urls.canonical_url(F.col("x")), "https://A.dk/p/?b=2&a=1&a=3&fbclid=9&e=#f") == "https://a.dk/p?b=2&a=1&a=3"
    assert one(spark, urls.meta_refresh_target("x"), '<meta http-equiv="refresh" content="0; URL=https://b.dk/x">') == "https://b.dk/x"
    assert one(spark, urls.join_url(F.lit("https://a.dk/b/c"), F.col("x")), "../d?e=1") == "https://a.dk/d?e=1"
    assert one(spark, urls.permalink(F.lit("vk"), F.lit("5"), F.col("x")), "7") == "https://vk.com/wall5_7"


@pytest.mark.parametrize("url, generic", [("https://a.dk/author", True), ("https://a.dk/faq=1", True), ("https://a.dk/x", False), (None, True)])
def test_generic(spark, url, generic):
    assert one(spark, urls.is_generic("x", urls.domain("x")), url) == generic


def test_social(spark):
    assert one(spark, urls.is_social_or_search("x"), "https://instagram.com/x")
    assert not one(spark, urls.is_social_or_search("x"), "https://a.dk/x")
    assert not one(spark, urls.is_social_or_search("x"), None)


def test_times(spark):
    assert one(spark, times.apple_seconds("x"), 700000000.5, "double") == datetime(2023, 3, 8, 20, 26, 40, 500000)
    assert one(spark, times.apple_seconds("x", 1), 700000000.5, "double") == datetime(2023, 3, 8, 21, 26, 40, 500000)
    assert one(spark, times.apple_seconds("x"), 0.0, "double") is None
    assert one(spark, times.unix_millis("x"), "1700000000000,5") == datetime(2023, 11, 14, 22, 13, 20, 500)
    assert one(spark, times.social_timestamp("x"), "946684799") is None
    assert one(spark, times.social_timestamp("x"), "1700000000") == datetime(2023, 11, 14, 22, 13, 20)
    assert one(spark, times.social_timestamp("x"), "2024-01-02T03:04:05+00:00") == datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, times.social_timestamp("x"), "2024-01-02T03:04:05Z") is None
    assert one(spark, times.social_timestamp("x"), "1930000000") is None
    assert one(spark, times.extractor_timestamp("x"), 1700000000.0, "double").year == 2054
    assert one(spark, times.extractor_timestamp("x"), 1e18, "double") is None
    assert one(spark, times.localised_date("x"), "maj 06, 2025 1:15:11 pm") == datetime(2025, 5, 6, 13, 15, 11)
    assert one(spark, times.localised_date("x"), "noget i 2019") == datetime(2019, 1, 1)
    assert one(spark, times.timestamp_problem("x"), "12") == "too_small"


def test_text(spark):
    assert one(spark, text.word_count("x"), " a b c\n") == 3
    assert one(spark, text.word_count("x"), None) == 0
    assert one(spark, text.folded_hash("x"), "  A  b ") == one(spark, text.folded_hash("x"), "a b")
    assert one(spark, text.folded_hash("x"), "  ") == ""
    assert one(spark, text.actor_from_title("x"), "Anna synes godt om Hanss opslag") == "Hans"
    assert one(spark, text.slug("x"), "A.b-c!") == "a_b_c"


def test_clean_url_matches_plain_python(spark):
    from urllib.parse import unquote

    def plain(u):
        u = unquote(u.strip(" ")).split("#")[0]
        if "?" in u:
            base, q = u.split("?", 1)
            kept = [p for p in q.split("&") if "=" in p and p.split("=")[0].lower() not in urls.CLEAN_TRACKING]
            u = base + "?" + "&".join(kept) if kept else base
        return u

    found = []

    @settings(max_examples=300, database=None)
    @given(st.text(alphabet="ab?&=#+/.%20 refUTM_source", min_size=1, max_size=30))
    def collect(t):
        if not __import__("re").search(r"%(?![0-9a-fA-F]{2})", t) and "%" not in unquote(t):
            found.append("https://x.dk/" + t)

    collect()
    got = [r[0] for r in spark.createDataFrame([(u,) for u in found], "x string").select(urls.clean_url("x")).collect()]
    bad = [(u, g, plain(u)) for u, g in zip(found, got) if g != plain(u) and "�" not in plain(u)]
    assert bad == []
