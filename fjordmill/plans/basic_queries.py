"""Projections, filters, plain joins, sorts and set operations over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordmill.functions import text, urls
from fjordmill.operators import relational as R
from fjordmill.operators.classify import classify
from fjordmill.plans.url_queries import domain_sql
from fjordmill.session import table


def filter_p1_projection(s: SparkSession, d: str) -> DataFrame:
    """Columns renamed and put in order, a missing one added as null."""
    v = table(s, d, "visits").withColumnsRenamed({"visit_datetime": "visited_at", "absent": "x"})
    return v.select("source_file", "visit_id", "url", "visited_at", F.lit(None).cast("string").alias("tags"))


def filter_p2_derived(s: SparkSession, d: str) -> DataFrame:
    v = classify(table(s, d, "visits").withColumn("host", urls.domain("url")), table(s, d, "domain_classes"), "host")
    return v.select("source_file", "visit_id", "host", "news_classification")


def filter_p3_nonblank(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").filter("content IS NOT NULL AND content <> ''").select("row_id")


def filter_p4_dropna(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").na.drop(subset=["url", "domain", "visit_datetime"]).select("source_file", "visit_id")


def filter_p5_split(s: SparkSession, d: str) -> DataFrame:
    """Rows of one kind against all others, where a missing kind is another."""
    kind = F.col("extraction_method").eqNullSafe("trafilatura")
    return table(s, d, "scraped_cache").groupBy(kind.alias("main_method")).agg(F.count("*").alias("n"))


def filter_p6_in_list(s: SparkSession, d: str) -> DataFrame:
    v = classify(table(s, d, "visits").withColumn("host", urls.domain("url")), table(s, d, "domain_classes"), "host")
    return v.filter(F.col("news_classification").isin("mainstream", "alternative")).select("source_file", "visit_id")


def filter_p10_resolved(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "url_cache").filter("success").select("original_url", F.coalesce("resolved_url", "original_url").alias("url"), (F.col("resolved_url") != F.col("original_url")).alias("moved"))


def filter_p17_language_by_platform(s: SparkSession, d: str) -> DataFrame:
    """Documents whose language code, by platform, is a wanted one; region and case don't matter."""
    code = F.lower(F.split_part("lang", F.lit("-"), F.lit(1)))
    wanted = F.when(F.col("platform") == "web", code.isin("da", "en")).otherwise(code.isin("da", "de", "sv"))
    return table(s, d, "documents").filter(wanted).select("doc_id", code.alias("code"))


def filter_p19_operators(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scraped_cache").filter("(status_code <> 200 OR error IS NOT NULL) AND word_count >= 10 OR source IN ('rescrape')").select("row_id")


def filter_p20_regex(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").filter(F.col("lang").rlike("(?i)^(da|de|sv)")).select("doc_id")


def filter_p21_tld(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").filter(urls.domain("url").rlike(r"posten\.example$")).select("row_id")


def filter_p22_blocked(s: SparkSession, d: str) -> DataFrame:
    blocked = table(s, d, "domain_classes").filter("classification = 'alternative'")
    return R.not_seen(table(s, d, "visits"), blocked, "domain").select("source_file", "visit_id")


def filter_p23_status_bucket(s: SparkSession, d: str) -> DataFrame:
    c = F.col("status_code")
    bucket = F.when(c == 200, "ok").when(c == 404, "missing").when(c.isin(403, 429, 455), "blocked").otherwise("other")
    return table(s, d, "sample_old_facebook").groupBy(bucket.alias("bucket"), (F.length("content") > 100).alias("with_text")).agg(F.count("*").alias("n"))


def j3_inner(s: SparkSession, d: str) -> DataFrame:
    p, li = table(s, d, "part"), table(s, d, "lineitem")
    return li.join(p, li["l_partkey"] == p["p_partkey"]).groupBy("p_brand").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def j5_chained_left(s: SparkSession, d: str) -> DataFrame:
    c, n, r = table(s, d, "customer"), table(s, d, "nation"), table(s, d, "region")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").join(r, n["n_regionkey"] == r["r_regionkey"], "left")
    return j.select("c_custkey", "n_name", "r_name")


def j7_lookup(s: SparkSession, d: str) -> DataFrame:
    """Each visit's address replaced by what the cache resolved it to, where it did."""
    v, c = table(s, d, "visits"), table(s, d, "url_cache").filter("success AND resolved_url IS NOT NULL").select("original_url", "resolved_url")
    return v.join(c, v["url"] == c["original_url"], "left").select("source_file", "visit_id", F.coalesce("resolved_url", "url").alias("url"), F.col("resolved_url").isNotNull().alias("replaced"))


def j14_enrich(s: SparkSession, d: str) -> DataFrame:
    """Documents with the most frequent language of their author."""
    docs = table(s, d, "documents")
    n = docs.filter("actor_username IS NOT NULL AND lang IS NOT NULL").groupBy("actor_username", "lang").agg(F.count("*").alias("n"))
    best = n.groupBy("actor_username").agg(F.min_by("lang", F.struct(-F.col("n"), "lang")).alias("actor_lang"))
    return docs.join(best, "actor_username", "left").select("doc_id", F.coalesce("actor_lang", "lang").alias("lang"))


def j15_resolve_then_scrape(s: SparkSession, d: str) -> DataFrame:
    """Resolved addresses with their newest page; the pages are made unique first."""
    pages = R.keep_first(table(s, d, "scraped_cache"), ["resolved_url"], [F.desc("scraped_at"), F.asc("row_id")]).select("resolved_url", "row_id", "title")
    return table(s, d, "url_cache").join(pages, "resolved_url", "left").select("original_url", "row_id", "title")


def n2_best_by_resolved(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "sample_old_facebook").filter("resolved_url IS NOT NULL")
    return R.keep_first(p, ["resolved_url"], [F.desc_nulls_last("word_count"), F.asc("row_id")]).select("resolved_url", "row_id")


def n5_positions(s: SparkSession, d: str) -> DataFrame:
    """Lines of each page with their position."""
    return table(s, d, "scraped_cache").select("row_id", F.posexplode(F.split("content", "\n")).alias("pos", "line"))


def n7_top_urls_per_account(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "visits").groupBy("account_name", "url").agg(F.count("*").alias("n"))
    return R.top_per_group(g, ["account_name"], [F.desc("n"), F.asc("url")], 3)


def o2_sorted(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").select("domain", "url", "row_id").orderBy(F.asc_nulls_first("domain"), "url", "row_id")


def o3_mixed_sort(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_custkey", F.desc("o_totalprice"), "o_orderkey")


def o9_page(s: SparkSession, d: str) -> DataFrame:
    """The second page of ten of a sorted table."""
    return table(s, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(10).limit(10)


def u3_mapped_union(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "sample_old_facebook").select("url", F.col("word_count").cast("long").alias("words"), F.lit("page").alias("origin"))
    b = table(s, d, "scraped_cache").select(F.col("original_url").alias("url"), F.col("word_count").cast("long").alias("words"), F.lit("cache").alias("origin"))
    return a.unionByName(b)


def u6_new_items(s: SparkSession, d: str) -> DataFrame:
    seen = table(s, d, "sample_old_facebook").select(urls.dedup_url("url").alias("k"))
    return R.not_seen(table(s, d, "scraped_cache").withColumn("k", urls.dedup_url("original_url")), seen, "k").select("row_id", "k")


def u7_distinct(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").select("url").distinct()


def u8_known_urls(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "url_cache")
    return c.select(F.col("original_url").alias("url")).union(c.select("resolved_url")).filter("url IS NOT NULL").distinct()


def u10_unprocessed(s: SparkSession, d: str) -> DataFrame:
    """Accounts without a visit to a classified domain, with the reason."""
    v = classify(table(s, d, "visits").withColumn("host", urls.domain("url")), table(s, d, "domain_classes"), "host")
    done = v.filter(F.col("news_classification").isin("mainstream", "alternative")).select("account_name").distinct()
    left = R.not_seen(v, done, "account_name")
    reason = F.when(F.count("visit_datetime") == 0, "no times").otherwise("no classified domain")
    return left.groupBy("account_name").agg(reason.alias("reason"))


def c3_substring_class(s: SparkSession, d: str) -> DataFrame:
    from fjordmill.operators.classify import first_match

    k = table(s, d, "domain_classes").select(F.col("domain").alias("pattern"), F.when(F.col("classification") == "alternative", 0).otherwise(1).alias("rank"))
    hosts = table(s, d, "sample_old_facebook").select(urls.netloc("url").alias("host"))
    return first_match(hosts, k, F.col("host"), ["host"], contains=True)


def c15_success(s: SparkSession, d: str) -> DataFrame:
    ok = F.coalesce((F.col("status_code") == 200) & ~text.is_blank("content"), F.lit(False))
    return table(s, d, "scraped_cache").select("row_id", ok.alias("success"))


def c16_resolved(s: SparkSession, d: str) -> DataFrame:
    moved = F.coalesce(F.col("success") & (F.col("original_url") != F.col("resolved_url")), F.lit(False))
    return table(s, d, "url_cache").select("original_url", moved.alias("actually_resolved"))


QUERIES = {f.__name__: f for name, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__}
CLS = "(SELECT domain AS cd, CASE WHEN bool_or(classification = 'alternative') THEN 'alternative' ELSE min(classification) END AS cls FROM domain_classes GROUP BY 1)"
CV = f"(SELECT v.*, CASE WHEN host IS NULL THEN 'invalid_url' ELSE coalesce(cls, 'other') END AS c FROM (SELECT *, {domain_sql('url')} AS host FROM visits) v LEFT JOIN {CLS} ON host = cd)"


def _dedup(c: str) -> str:
    from fjordmill.plans.url_queries import params_sql

    return f"coalesce({params_sql(f'split_part(lower(trim({c})), {chr(39)}#{chr(39)}, 1)', urls.DEDUP_TRACKING)}, '')"


ORACLE = {
    "filter_p1_projection": "SELECT source_file, visit_id, url, visit_datetime AS visited_at, CAST(NULL AS VARCHAR) AS tags FROM visits",
    "filter_p2_derived": f"SELECT source_file, visit_id, host, c AS news_classification FROM {CV}",
    "filter_p3_nonblank": "SELECT row_id FROM sample_old_facebook WHERE content <> ''",
    "filter_p4_dropna": "SELECT source_file, visit_id FROM visits WHERE url IS NOT NULL AND domain IS NOT NULL AND visit_datetime IS NOT NULL",
    "filter_p5_split": "SELECT extraction_method IS NOT DISTINCT FROM 'trafilatura' AS main_method, count(*) AS n FROM scraped_cache GROUP BY 1",
    "filter_p6_in_list": f"SELECT source_file, visit_id FROM {CV} WHERE c IN ('mainstream', 'alternative')",
    "filter_p10_resolved": "SELECT original_url, coalesce(resolved_url, original_url) AS url, resolved_url <> original_url AS moved FROM url_cache WHERE success",
    "filter_p17_language_by_platform": """SELECT doc_id, lower(split_part(lang, '-', 1)) AS code FROM documents
        WHERE CASE WHEN platform = 'web' THEN lower(split_part(lang, '-', 1)) IN ('da', 'en') ELSE lower(split_part(lang, '-', 1)) IN ('da', 'de', 'sv') END""",
    "filter_p19_operators": "SELECT row_id FROM scraped_cache WHERE (status_code <> 200 OR error IS NOT NULL) AND word_count >= 10 OR source IN ('rescrape')",
    "filter_p20_regex": "SELECT doc_id FROM documents WHERE regexp_matches(lang, '^(da|de|sv)', 'i')",
    "filter_p21_tld": f"SELECT row_id FROM sample_old_facebook WHERE regexp_matches({domain_sql('url')}, 'posten\\.example$')",
    "filter_p22_blocked": "SELECT source_file, visit_id FROM visits v WHERE NOT EXISTS (SELECT 1 FROM domain_classes k WHERE classification = 'alternative' AND k.domain = v.domain)",
    "filter_p23_status_bucket": "SELECT CASE WHEN status_code = 200 THEN 'ok' WHEN status_code = 404 THEN 'missing' WHEN status_code IN (403, 429, 455) THEN 'blocked' ELSE 'other' END AS bucket, length(content) > 100 AS with_text, count(*) AS n FROM sample_old_facebook GROUP BY 1, 2",
    "j3_inner": "SELECT p_brand, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
    "j5_chained_left": "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
    "j7_lookup": "SELECT source_file, visit_id, coalesce(c.resolved_url, v.url) AS url, c.resolved_url IS NOT NULL AS replaced FROM visits v LEFT JOIN (SELECT * FROM url_cache WHERE success AND resolved_url IS NOT NULL) c ON v.url = c.original_url",
    "j14_enrich": """WITH n AS (SELECT actor_username, lang, count(*) AS n FROM documents WHERE actor_username IS NOT NULL AND lang IS NOT NULL GROUP BY 1, 2),
        b AS (SELECT actor_username, lang AS actor_lang FROM n QUALIFY row_number() OVER (PARTITION BY actor_username ORDER BY n DESC, lang) = 1)
        SELECT doc_id, coalesce(actor_lang, lang) AS lang FROM documents LEFT JOIN b USING (actor_username)""",
    "j15_resolve_then_scrape": """SELECT original_url, row_id, title FROM url_cache LEFT JOIN (SELECT resolved_url, row_id, title FROM scraped_cache
        QUALIFY row_number() OVER (PARTITION BY resolved_url ORDER BY scraped_at DESC, row_id) = 1) USING (resolved_url)""",
    "n2_best_by_resolved": "SELECT resolved_url, row_id FROM sample_old_facebook WHERE resolved_url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY resolved_url ORDER BY word_count DESC NULLS LAST, row_id) = 1",
    "n5_positions": "SELECT row_id, CAST(unnest(range(len(l))) AS INT) AS pos, unnest(l) AS line FROM (SELECT row_id, string_split(content, chr(10)) AS l FROM scraped_cache WHERE content IS NOT NULL)",
    "n7_top_urls_per_account": "SELECT account_name, url, count(*) AS n, CAST(row_number() OVER (PARTITION BY account_name ORDER BY count(*) DESC, url) AS INT) AS rank FROM visits GROUP BY 1, 2 QUALIFY rank <= 3",
    "o2_sorted": "SELECT domain, url, row_id FROM sample_old_facebook ORDER BY domain NULLS FIRST, url, row_id",
    "o3_mixed_sort": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey",
    "o9_page": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 10",
    "u3_mapped_union": "SELECT url, CAST(word_count AS BIGINT) AS words, 'page' AS origin FROM sample_old_facebook UNION ALL SELECT original_url, CAST(word_count AS BIGINT), 'cache' FROM scraped_cache",
    "u6_new_items": f"SELECT row_id, {_dedup('original_url')} AS k FROM scraped_cache WHERE {_dedup('original_url')} NOT IN (SELECT {_dedup('url')} FROM sample_old_facebook)",
    "u7_distinct": "SELECT DISTINCT url FROM visits",
    "u8_known_urls": "SELECT url FROM (SELECT original_url AS url FROM url_cache UNION SELECT resolved_url FROM url_cache) WHERE url IS NOT NULL",
    "u10_unprocessed": f"""WITH v AS (SELECT * FROM {CV}) SELECT account_name, CASE WHEN count(visit_datetime) = 0 THEN 'no times' ELSE 'no classified domain' END AS reason FROM v
        WHERE account_name NOT IN (SELECT account_name FROM v WHERE c IN ('mainstream', 'alternative')) GROUP BY 1""",
    "c3_substring_class": f"""SELECT host, arg_min(domain, (rank, domain)) AS pattern FROM (SELECT DISTINCT lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)) AS host FROM sample_old_facebook)
        JOIN (SELECT domain, CASE WHEN classification = 'alternative' THEN 0 ELSE 1 END AS rank FROM domain_classes) ON contains(host, domain) GROUP BY 1""",
    "c15_success": "SELECT row_id, coalesce(status_code = 200 AND coalesce(content, '') <> '', false) AS success FROM scraped_cache",
    "c16_resolved": "SELECT original_url, coalesce(success AND original_url <> resolved_url, false) AS actually_resolved FROM url_cache",
}
