"""URL algebra, text and time functions over the whole visits, pages and documents tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordmill.functions import text, times, urls
from fjordmill.session import table

NETLOC_SQL = "lower(regexp_extract({u}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1))"
DOMAIN_SQL = f"regexp_replace({NETLOC_SQL}, '^www[.]', '')"


def domain_sql(u: str) -> str:
    return DOMAIN_SQL.format(u=u)


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def params_sql(url: str, dropped: list[str]) -> str:
    """url without tracking parameters and parameters without '='."""
    keep = f"list_filter(string_split(substr({url}, instr({url}, '?') + 1), '&'), lambda x: contains(x, '=') AND lower(split_part(x, '=', 1)) NOT IN ({quoted(dropped)}))"
    base = f"substr({url}, 1, instr({url}, '?') - 1)"
    return f"CASE WHEN instr({url}, '?') = 0 THEN {url} WHEN len({keep}) = 0 THEN {base} ELSE {base} || '?' || array_to_string({keep}, '&') END"


def d_domains(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "sample_old_facebook")
    u = F.col("url")
    return p.select("row_id", urls.domain(u).alias("core"), urls.domain_lenient(u).alias("lenient"), urls.domain_or_empty(u).alias("or_empty"), urls.netloc(u).alias("with_www"), urls.naive_domain(u).alias("naive"))


def d_redirect_domain(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").select("source_file", "visit_id", urls.redirect_domain("url").alias("domain"))


def d_first_domain(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").select("row_id", urls.first_domain("resolved_url", "domain").alias("domain"))


def k1_clean_url(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").select("source_file", "visit_id", urls.clean_url("url").alias("clean_url"))


def k2_dedup_url(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").select("source_file", "visit_id", urls.dedup_url("url").alias("dedup_url"))


def k3_canonical_url(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").select("source_file", "visit_id", urls.canonical_url(F.col("url")).alias("canonical_url"))


def k4_comparison_url(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").select("row_id", urls.comparison_url("url").alias("comparison_url"))


def k5_join_url(s: SparkSession, d: str) -> DataFrame:
    path = F.regexp_replace("resolved_url", r"^https?://[^/]+", "")
    return table(s, d, "url_cache").select("original_url", urls.join_url(F.col("original_url"), path).alias("joined"))


def e1_urls_in_text(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents")
    return docs.select("doc_id", F.posexplode(urls.urls_in_text("text")).alias("pos", "url"))


def e2_hosts_in_text(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "scraped_cache")
    return docs.select("row_id", F.posexplode(urls.hosts_in_text("content")).alias("pos", "url"))


def e3_first_url(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", urls.first_url("text").alias("url"))


def p7_generic_filter(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "visits")
    return v.filter(~urls.is_generic("url", "domain")).select("source_file", "visit_id", "url")


def p8_skip_filter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").filter(~urls.is_social_or_search("url")).select("source_file", "visit_id", "url")


def p9_usable_urls(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").filter(urls.is_usable("url")).select(F.trim("url").alias("url")).distinct()


def p13_needs_resolution(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").select("row_id", urls.needs_resolution("url", "resolved_url").alias("needed"))


def t1_t3_visit_time(s: SparkSession, d: str) -> DataFrame:
    """The wall time of each visit by the epoch of its source."""
    t = F.col("visit_time")
    wall = F.when(F.col("source_type") == "safari_db", times.apple_seconds(t, 1)).when(F.col("source_type") == "chrome_json", times.unix_millis(t)).otherwise(times.unix_micros(t))
    return table(s, d, "visits").select("source_file", "visit_id", F.date_trunc("second", wall).cast("timestamp_ntz").alias("wall"))


def t5_extractor_time(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "visits").filter("source_type <> 'safari_json'")
    return v.select("source_file", "visit_id", F.date_trunc("second", times.extractor_timestamp("visit_time")).cast("timestamp_ntz").alias("wall"))


def t5_all_sources(s: SparkSession, d: str) -> DataFrame:
    """The extractor's reading of every visit; microseconds are out of its range and give null."""
    return table(s, d, "visits").select("source_file", "visit_id", "source_type", F.date_trunc("second", times.extractor_timestamp("visit_time")).cast("timestamp_ntz").alias("wall"))


def t6_seconds_or_millis(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").select("source_file", "visit_id", F.date_trunc("second", times.seconds_or_millis("visit_time")).cast("timestamp_ntz").alias("wall"))


def t7_zone_conversion(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", times.to_zone("ts", "Europe/Copenhagen").alias("local"))


def t11_iso_text(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").select("row_id", times.iso_text("date").alias("date"))


def t28_timestamp_problems(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").groupBy(times.timestamp_problem("date").alias("problem")).agg(F.count("*").alias("n"))


def x1_word_count(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", text.word_count("text").alias("words"))


def x2_content_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scraped_cache").select("row_id", text.content_hash("content").alias("hash"))


def x3_folded_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").select("row_id", text.folded_hash("content").alias("hash"))


def x4_url_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scraped_cache").select("row_id", F.md5("original_url").alias("hash"))


def x7_shortened(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", text.shortened("text", 200).alias("short"))


def x8_error_kind(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scraped_cache").filter("error IS NOT NULL").groupBy(text.error_kind("error").alias("kind")).agg(F.count("*").alias("n"))


def x9_slug(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "domain_classes").select("domain", text.slug("domain").alias("slug"), text.compact_domain("domain").alias("compact"))


def x19_fallback_text(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scraped_cache").select("row_id", text.fallback_text("source", "description", "title").alias("text"))


def x20_titled_text(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scraped_cache").select("row_id", text.titled_text("title", "description").alias("text"))


def c14_proxy_errors(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scraped_cache").groupBy(text.is_proxy_error("error").alias("proxy_error")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in [
        d_domains, d_redirect_domain, d_first_domain, k1_clean_url, k2_dedup_url, k3_canonical_url, k4_comparison_url, k5_join_url, e1_urls_in_text, e2_hosts_in_text, e3_first_url,
        p7_generic_filter, p8_skip_filter, p9_usable_urls, p13_needs_resolution, t1_t3_visit_time, t5_extractor_time, t5_all_sources, t6_seconds_or_millis, t7_zone_conversion, t11_iso_text, t28_timestamp_problems,
        x1_word_count, x2_content_hash, x3_folded_hash, x4_url_hash, x7_shortened, x8_error_kind, x9_slug, x19_fallback_text, x20_titled_text, c14_proxy_errors,
    ]
}
for old in ("p7_generic_filter", "p8_skip_filter", "p9_usable_urls", "p13_needs_resolution"):  # the prefix p<n>_ is kept for the problems
    QUERIES["filter_" + old] = QUERIES.pop(old)

APPLE = "epoch_ms(CAST(round((nullif(visit_time, 0) + 978307200 + {h}) * 1000000) AS BIGINT) // 1000)"
CLEANED = params_sql("u", urls.CLEAN_TRACKING)
WALL = "date_trunc('second', make_timestamp(CAST({us} AS BIGINT)))"
ORACLE = {
    "d_domains": f"""SELECT row_id, {domain_sql('url')} AS core,
        CASE WHEN coalesce(url, '') = '' THEN '' ELSE {domain_sql("CASE WHEN starts_with(trim(url), 'http://') OR starts_with(trim(url), 'https://') THEN trim(url) ELSE 'https://' || trim(url) END")} END AS lenient,
        coalesce({domain_sql('url')}, '') AS or_empty, {NETLOC_SQL.format(u='url')} AS with_www, split_part(url, '/', 3) AS naive FROM sample_old_facebook""",
    "d_first_domain": f"""SELECT row_id, coalesce(nullif({domain_sql('resolved_url')}, ''), nullif(CASE WHEN coalesce(domain, '') = '' THEN '' ELSE
        {domain_sql("CASE WHEN starts_with(trim(domain), 'http://') OR starts_with(trim(domain), 'https://') THEN trim(domain) ELSE 'https://' || trim(domain) END")} END, '')) AS domain FROM sample_old_facebook""",
    "d_redirect_domain": f"SELECT source_file, visit_id, {domain_sql('url')} AS domain FROM visits",
    "k1_clean_url": f"SELECT source_file, visit_id, coalesce({CLEANED}, '') AS clean_url FROM (SELECT *, split_part(url_decode(trim(url)), '#', 1) AS u FROM visits)",
    "k2_dedup_url": f"SELECT source_file, visit_id, coalesce({params_sql('u', urls.DEDUP_TRACKING)}, '') AS dedup_url FROM (SELECT *, split_part(lower(trim(url)), '#', 1) AS u FROM visits)",
    "k4_comparison_url": f"SELECT row_id, coalesce({CLEANED}, '') AS comparison_url FROM (SELECT row_id, split_part(trim(url), '#', 1) AS u FROM sample_old_facebook)",
    "k5_join_url": "SELECT original_url, regexp_extract(original_url, '^https?://[^/]+') || regexp_replace(resolved_url, '^https?://[^/]+', '') AS joined FROM url_cache",
    "e1_urls_in_text": r"""WITH f AS (SELECT doc_id, regexp_extract_all(text, 'https?://[^\s<>"{}|\\^`\[\]]+') AS u FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, CAST(unnest(range(len(u))) AS INT) AS pos, unnest(u) AS url FROM f""",
    "e2_hosts_in_text": r"""WITH f AS (SELECT row_id, regexp_extract_all(content, 'https?://(?:[-\w.]|(?:%[\da-fA-F]{2}))+') AS u FROM scraped_cache WHERE content IS NOT NULL)
        SELECT row_id, CAST(unnest(range(len(u))) AS INT) AS pos, unnest(u) AS url FROM f""",
    "e3_first_url": r"""SELECT doc_id, nullif(regexp_replace(regexp_extract(text, 'https?://\S+'), '[),.>\]"\\]+$', ''), '') AS url FROM documents""",
    "filter_p7_generic_filter": f"""SELECT source_file, visit_id, url FROM visits WHERE coalesce(url, '') <> '' AND coalesce(domain, '') <> '' AND domain NOT IN ({quoted(urls.GENERIC_DOMAINS)})
        AND NOT regexp_matches(lower(url), '{'|'.join(p.replace('?', chr(92) + '?') for p in urls.GENERIC_PARTS)}')""",
    "filter_p8_skip_filter": f"SELECT source_file, visit_id, url FROM visits WHERE coalesce({domain_sql('url')}, '') NOT IN ({quoted(urls.SOCIAL_DOMAINS)}) AND NOT coalesce(contains(url, 'google.com/search') OR contains(url, 'bing.com/search'), false)",
    "filter_p9_usable_urls": "SELECT DISTINCT trim(url) AS url FROM sample_old_facebook WHERE trim(url) <> '' AND length(trim(url)) < 2048 AND NOT starts_with(trim(url), 'http://0/0/0')",
    "filter_p13_needs_resolution": r"SELECT row_id, coalesce(regexp_matches(lower(url), '(t\.co|bit\.ly|tinyurl|goo\.gl|fb\.me|l\.facebook\.com)') OR url = resolved_url OR length(url) < 30, false) AS needed FROM sample_old_facebook",
    "t1_t3_visit_time": f"""SELECT source_file, visit_id, CASE WHEN source_type = 'safari_db' THEN {WALL.format(us='round((nullif(visit_time, 0) + 978307200 + 3600) * 1000000)')}
        WHEN source_type = 'chrome_json' THEN {WALL.format(us='round(nullif(visit_time, 0) * 1000)')} ELSE {WALL.format(us='trunc(nullif(visit_time, 0))')} END AS wall FROM visits""",
    "t5_extractor_time": f"""SELECT source_file, visit_id, CASE WHEN visit_time > 1e12 THEN {WALL.format(us='round(visit_time * 1000)')} WHEN abs(visit_time) < 2.5e11 THEN
        {WALL.format(us='round((nullif(visit_time, 0) + 978307200) * 1000000)')} END AS wall FROM visits WHERE source_type <> 'safari_json'""",
    "t5_all_sources": f"""SELECT source_file, visit_id, source_type, CASE WHEN visit_time >= 2.534e14 THEN NULL WHEN visit_time > 1e12 THEN {WALL.format(us='round(visit_time * 1000)')} WHEN abs(visit_time) < 2.5e11 THEN
        {WALL.format(us='round((nullif(visit_time, 0) + 978307200) * 1000000)')} END AS wall FROM visits""",
    "t6_seconds_or_millis": f"""SELECT source_file, visit_id, CASE WHEN visit_time BETWEEN 1e9 AND 1e10 THEN {WALL.format(us='round(visit_time * 1000000)')} WHEN visit_time > 1e12 AND visit_time < 2.534e14 THEN
        {WALL.format(us='round(visit_time * 1000)')} END AS wall FROM visits""",
    "t7_zone_conversion": "SELECT event_id, timezone('Europe/Copenhagen', ts AT TIME ZONE 'UTC') AS local FROM events",
    "t11_iso_text": "SELECT row_id, replace(replace(date, 'T', ' '), 'Z', '') AS date FROM sample_old_facebook",
    "t28_timestamp_problems": """SELECT CASE WHEN coalesce(date, '') = '' THEN 'missing' WHEN try_cast(date AS DOUBLE) IS NULL THEN 'parse_error' WHEN try_cast(date AS DOUBLE) < 1e8 THEN 'too_small'
        WHEN try_cast(date AS DOUBLE) < 946684800 THEN 'pre_2000' ELSE 'ok' END AS problem, count(*) AS n FROM sample_old_facebook GROUP BY 1""",
    "x1_word_count": r"SELECT doc_id, CAST(coalesce(len(list_filter(regexp_split_to_array(text, '[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: x <> '')), 0) AS INT) AS words FROM documents",
    "x2_content_hash": "SELECT row_id, md5(coalesce(content, '')) AS hash FROM scraped_cache",
    "x3_folded_hash": r"SELECT row_id, CASE WHEN trim(regexp_replace(lower(coalesce(content, '')), '\s+', ' ', 'g')) = '' THEN '' ELSE md5(trim(regexp_replace(lower(content), '\s+', ' ', 'g'))) END AS hash FROM sample_old_facebook",
    "x4_url_hash": "SELECT row_id, md5(original_url) AS hash FROM scraped_cache",
    "x7_shortened": "SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS short FROM documents",
    "x8_error_kind": "SELECT split_part(error, ':', 1) AS kind, count(*) AS n FROM scraped_cache WHERE error IS NOT NULL GROUP BY 1",
    "x9_slug": "SELECT domain, regexp_replace(regexp_replace(lower(domain), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, replace(replace(domain, '.', ''), '-', '') AS compact FROM domain_classes",
    "x19_fallback_text": "SELECT row_id, coalesce(nullif(description, ''), nullif(title, '')) AS text FROM scraped_cache",
    "x20_titled_text": "SELECT row_id, concat_ws(' ' || chr(10), title, description) AS text FROM scraped_cache",
    "c14_proxy_errors": "SELECT coalesce(regexp_matches(lower(error), 'proxy|socks|tunnel|connection refused|connection reset|network is unreachable'), false) AS proxy_error, count(*) AS n FROM scraped_cache GROUP BY 1",
}
