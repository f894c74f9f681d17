"""Aggregations, windows, joins, sets and dedup over visits, pages, the URL cache and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fjordmill.functions import text, urls
from fjordmill.operators import relational as R
from fjordmill.operators.classify import classify, first_match
from fjordmill.plans.url_queries import CLEANED, domain_sql, params_sql
from fjordmill.session import table

NEWS = ["mainstream", "alternative"]


def classified_visits(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "visits").withColumn("d", urls.domain("url"))
    return classify(v, table(s, d, "domain_classes"), "d")


def c1_classify(s: SparkSession, d: str) -> DataFrame:
    return classified_visits(s, d).select("source_file", "visit_id", F.col("d").alias("domain"), "news_classification")


def a1_metrics(s: SparkSession, d: str) -> DataFrame:
    """Per source file: totals, distinct URLs and domains, counts by class, and the span of the visits."""
    c = F.col("news_classification")
    return classified_visits(s, d).groupBy("source_file").agg(
        F.count("*").alias("visits"), F.count_distinct("url").alias("urls"), F.count_distinct("d").alias("domains"),
        F.count_if(c == "mainstream").alias("mainstream"), F.count_if(c == "alternative").alias("alternative"), F.count_if(c == "other").alias("other"),
        F.min("visit_datetime").alias("first_visit"), F.max("visit_datetime").alias("last_visit"),
    )


def a2_optional_metrics(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").groupBy("source_type").agg(
        F.count("title").alias("titled"), F.round(100 * F.count("title") / F.count("*"), 6).alias("titled_percent"), F.round(F.avg(F.length("title")), 6).alias("mean_title")
    )


def a3_activity_span(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").groupBy("account_name").agg(F.expr("timestampdiff(DAY, min(visit_datetime), max(visit_datetime))").cast("long").alias("days"))


def a4_by_source_type(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").groupBy("source_type").agg(F.count("visit_datetime").alias("timed"), F.count_distinct("url").alias("urls"), F.count_distinct("account_name").alias("accounts"))


def a5_top_domains(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").filter("domain IS NOT NULL").groupBy("domain").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "domain").limit(10)


def a6_classification_summary(s: SparkSession, d: str) -> DataFrame:
    return classified_visits(s, d).groupBy("news_classification", F.col("d").alias("domain")).agg(F.count("*").alias("n"))


def a7_titles_per_url(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "visits").filter("title IS NOT NULL")
    return v.groupBy("url").agg(F.array_join(F.sort_array(F.collect_set("title")), ", ").alias("titles"), F.count("visit_id").alias("n"))


def a8_url_rollup(s: SparkSession, d: str) -> DataFrame:
    """Per clean URL: the first title that isn't blank, first and last time, visits and source files."""
    v = table(s, d, "visits").withColumn("clean_url", urls.clean_url("url")).filter("clean_url <> ''")
    order = F.struct("visit_datetime", "source_file", "visit_id", "title")
    titled = F.when(~text.is_blank("title") & F.col("visit_datetime").isNotNull(), order)
    return v.groupBy("clean_url").agg(
        F.min(titled)["title"].alias("title"), F.min("visit_datetime").alias("first_seen"), F.max("visit_datetime").alias("last_seen"), F.count("*").alias("visit_count"),
        F.array_join(F.sort_array(F.collect_set("source_file")), "; ").alias("source_files"),
    )


def a9_account_summary(s: SparkSession, d: str) -> DataFrame:
    c = F.col("news_classification")
    return classified_visits(s, d).groupBy("account_name").agg(
        F.min("visit_datetime").alias("earliest_activity"), F.max("visit_datetime").alias("latest_activity"),
        F.expr("timestampdiff(DAY, min(visit_datetime), max(visit_datetime))").cast("long").alias("activity_days"), F.count("visit_datetime").alias("valid_timestamps"),
        F.count("*").alias("total"), F.count_if(c == "mainstream").alias("mainstream"), F.count_if(c == "alternative").alias("alternative"), F.count_if(~c.isin(NEWS)).alias("other"),
        F.count_distinct("d").alias("unique_domains"), F.count_distinct("url").alias("unique_urls"), F.count_distinct("source_type").alias("source_types"),
    )


def a10_account_domains(s: SparkSession, d: str) -> DataFrame:
    return classified_visits(s, d).groupBy("account_name", F.col("d").alias("domain")).agg(F.count("*").alias("n"), F.min("news_classification").alias("classification"))


def a11_account_titles(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").filter("title IS NOT NULL AND title <> ''").groupBy("account_name", "title").agg(F.count("*").alias("n"))


def a12_totals(s: SparkSession, d: str) -> DataFrame:
    return a9_account_summary(s, d).agg(F.round(F.avg("activity_days"), 6).alias("mean_days"), F.sum("total").alias("total"), F.sum("mainstream").alias("mainstream"), F.max("unique_domains").alias("most_domains"))


def a13_timestamp_validity(s: SparkSession, d: str) -> DataFrame:
    t = F.col("visit_datetime")
    return table(s, d, "visits").groupBy("source_type").agg(F.count_if(t.isNotNull()).alias("valid"), F.count_if(t.isNull()).alias("invalid"), F.min(t).alias("first"), F.max(t).alias("last"))


def a14_resolution_report(s: SparkSession, d: str) -> DataFrame:
    ok = F.col("success")
    return table(s, d, "url_cache").agg(
        F.count("*").alias("total"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.count_if(F.col("redirect_count") > 0).alias("redirected"),
        F.round(100 * F.count_if(ok) / F.count("*"), 6).alias("success_rate"), F.round(F.avg("response_time"), 6).alias("mean_response"),
    )


def a15_scraping_report(s: SparkSession, d: str) -> DataFrame:
    good = text.is_blank("error") & (F.coalesce("word_count", F.lit(0)) > 0)
    return table(s, d, "scraped_cache").groupBy("extraction_method").agg(
        F.count("*").alias("n"), F.count_if(good).alias("succeeded"), F.count_if("paywall_detected").alias("paywalled"), F.round(F.avg("word_count"), 6).alias("mean_words"), F.round(F.avg("scraping_time"), 6).alias("mean_time")
    )


def a16_unique_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").agg(F.count_distinct("domain").alias("domains"), F.count_distinct("source").alias("sources"), F.count_distinct("url").alias("urls"))


def a17_combine_summary(s: SparkSession, d: str) -> DataFrame:
    ok = (F.col("status_code") == 200) & ~text.is_blank("content")
    return table(s, d, "sample_old_facebook").groupBy("source").agg(F.count("*").alias("n"), F.count_if(ok).alias("succeeded"), F.count_if(~text.is_blank("content")).alias("with_content"))


def a18_length_stats(s: SparkSession, d: str) -> DataFrame:
    """Lengths of the URLs per source; the median is the upper one."""
    # one row per source and length, however many visits a source has
    v = table(s, d, "visits").withColumn("n", F.length("url"))
    lengths = v.groupBy("source_type", "n").agg(F.count("*").alias("c"))
    source = W.partitionBy("source_type")
    ranked = lengths.withColumn("upto", F.sum("c").over(source.orderBy(F.asc_nulls_last("n")))).withColumn("size", F.sum("c").over(source))
    stats = ranked.groupBy("source_type").agg(
        F.min("n").alias("shortest"), F.max("n").alias("longest"), F.round(F.sum(F.col("n") * F.col("c")) / F.sum(F.when(F.col("n").isNotNull(), F.col("c"))), 6).alias("mean"),
        F.min(F.when(F.col("upto") >= F.floor(F.col("size") / 2) + 1, F.col("n"))).alias("median"),
    )
    return stats.join(v.groupBy("source_type").agg(F.count_distinct("url").alias("distinct_urls")), "source_type")


def a19_completeness(s: SparkSession, d: str) -> DataFrame:
    """Per domain: pages scraped against addresses resolved to it."""
    raw = table(s, d, "url_cache").withColumn("domain", urls.domain("resolved_url")).groupBy("domain").agg(F.count("*").alias("resolved"))
    got = table(s, d, "sample_old_facebook").withColumn("domain", urls.domain("url")).groupBy("domain").agg(F.count("*").alias("scraped"))
    return raw.join(got, "domain", "left").filter("domain IS NOT NULL").select("domain", "resolved", F.coalesce("scraped", F.lit(0)).alias("scraped"))


def a20_busy_accounts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").groupBy("account_name").agg(F.count("*").alias("n")).filter("n >= 20")


def a21_distinct_accounts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").select("account_name", "source_type").distinct()


def a22_language_shares(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 6))


def a23_error_counts(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "url_cache")
    return c.groupBy("success", "error").agg(F.count("*").alias("n"), F.max("cached_at").alias("latest"))


def a24_user_inventory(s: SparkSession, d: str) -> DataFrame:
    day = F.date_format("visit_datetime", "yyyy-MM-dd")
    return table(s, d, "visits").groupBy("account_name").agg(F.array_join(F.sort_array(F.collect_set(day)), ",").alias("days"), F.array_join(F.sort_array(F.collect_set("source_type")), ",").alias("sources"))


def a25_source_pivot(s: SparkSession, d: str) -> DataFrame:
    kinds = ["safari_db", "chrome_json", "safari_json"]
    p = table(s, d, "visits").groupBy("account_name").pivot("source_type", kinds).agg(F.count(F.lit(1)))
    return p.select("account_name", *(F.coalesce(k, F.lit(0)).alias(k) for k in kinds))


def a26_top_per_class(s: SparkSession, d: str) -> DataFrame:
    g = classified_visits(s, d).filter("d IS NOT NULL").groupBy("news_classification", F.col("d").alias("domain")).agg(F.count("*").alias("n"))
    return R.top_per_group(g, ["news_classification"], [F.desc("n"), F.asc("domain")], 5)


def a27_words_of_top_domains(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sample_old_facebook").filter("domain IS NOT NULL").groupBy("domain").agg(F.count("*").alias("n"), F.round(F.avg("word_count"), 6).alias("mean_words")).orderBy(F.desc("n"), "domain").limit(15)


def a_rollup_sources(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").rollup("account_name", "source_type").agg(F.count("*").alias("n"))


def n1_keep_best(s: SparkSession, d: str) -> DataFrame:
    """One page per URL: the one with most words, then the first row."""
    p = table(s, d, "sample_old_facebook")
    return R.keep_first(p, ["url"], [F.desc_nulls_last("word_count"), F.asc("row_id")]).select("url", "row_id", "word_count")


def n3_unique_content(s: SparkSession, d: str) -> DataFrame:
    return R.drop_duplicate_content(table(s, d, "sample_old_facebook"), "content_hash", [F.asc("row_id")]).select("row_id", "content_hash")


def n3_unique_content_collapsed(s: SparkSession, d: str) -> DataFrame:
    return R.drop_duplicate_content(table(s, d, "sample_old_facebook"), "content_hash", [F.asc("row_id")], "collapse").select("row_id", "content_hash")


def n4_first_seen(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "visits").withColumn("clean_url", urls.clean_url("url"))
    return R.keep_first(v, ["clean_url"], [F.asc("source_file"), F.asc("visit_id"), F.asc_nulls_first("visit_datetime")]).select("clean_url", "source_file", "visit_id")


def n6_batches(s: SparkSession, d: str) -> DataFrame:
    b = R.number_batches(table(s, d, "orders").select("o_orderkey"), ["o_orderkey"], 1000)
    return b.groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


def n9_sampled_visits(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents")
    return R.sample_per_key(docs, "source", "doc_id", 10, 50).groupBy("source").agg(F.count("*").alias("n"))


def n11_recent_rate(s: SparkSession, d: str) -> DataFrame:
    """How many events of its type each event has in the five minutes up to it. A type's events are spread over slots of five
    minutes; each slot also sees the events of the one before it."""
    us = 300_000_000
    e = table(s, d, "events").select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    slots = e.withColumn("own", F.explode(F.array(F.lit(1), F.lit(0)))).withColumn("slot", F.floor(F.col("at") / us) + 1 - F.col("own"))
    w = W.partitionBy("event_type", "slot").orderBy("at").rangeBetween(-us, 0)
    return slots.withColumn("last_5_minutes", F.count("*").over(w)).filter("own = 1").select("event_id", "last_5_minutes")


def n12_error_runs(s: SparkSession, d: str) -> DataFrame:
    r = R.islands(table(s, d, "events"), ["user_id"], "ts", "event_id", F.col("event_type") == "error")
    return r.groupBy("user_id").agg(F.max("run_length").cast("long").alias("longest_run"))


def n_sessions(s: SparkSession, d: str) -> DataFrame:
    v = R.sessions(table(s, d, "events"), ["user_id"], "ts", "event_id", 30)
    return v.groupBy("user_id", "session_no").agg(F.count("*").alias("n"), F.min("ts").alias("started"), F.max("ts").alias("ended"))


def n_revisit_gap(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", F.expr("timestampdiff(SECOND, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id), ts)").cast("long").alias("gap"))


def j1_items_visits(s: SparkSession, d: str) -> DataFrame:
    o, li = table(s, d, "orders"), table(s, d, "lineitem")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).groupBy("o_orderstatus", "l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


def j2_left_aggregate(s: SparkSession, d: str) -> DataFrame:
    c, o = table(s, d, "customer"), table(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"))


def j4_suffix_join(s: SparkSession, d: str) -> DataFrame:
    n, r = table(s, d, "nation"), table(s, d, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", F.col("n_name").alias("name"), F.col("r_name").alias("name_right"))


def j6_resolved_pages(s: SparkSession, d: str) -> DataFrame:
    """Each page with what the URL cache says of its address."""
    p, c = table(s, d, "sample_old_facebook"), table(s, d, "url_cache")
    new = c.select(F.col("original_url").alias("u"), F.col("resolved_url").alias("resolved_url_new"), "success")
    return p.join(new, p["url"] == new["u"], "left").select("row_id", "resolved_url", "resolved_url_new", F.coalesce("success", F.lit(False)).alias("resolved"))


def j8_pattern_match(s: SparkSession, d: str) -> DataFrame:
    """The first class pattern, alternatives first, that a page's domain matches."""
    k = table(s, d, "domain_classes")
    name = F.regexp_extract("domain", r"^([^.]+)", 1)
    rank = F.when(F.col("classification") == "alternative", 0).otherwise(1)
    return first_match(table(s, d, "sample_old_facebook"), k.select(name.alias("pattern"), rank.alias("rank")), F.col("url"), ["url"])


def j9_containment(s: SparkSession, d: str) -> DataFrame:
    k = table(s, d, "domain_classes")
    slug = text.compact_domain(F.regexp_extract("domain", r"^([^.]+)", 1))
    rank = F.when(F.col("classification") == "alternative", 0).otherwise(1)
    pages = table(s, d, "scraped_cache")
    return first_match(pages, k.select(slug.alias("pattern"), rank.alias("rank")), text.compact_domain(F.lower("resolved_url")), ["resolved_url"], contains=True)


def j11_unprocessed(s: SparkSession, d: str) -> DataFrame:
    return R.not_seen(table(s, d, "visits"), table(s, d, "sample_old_facebook"), "url").select("url").distinct()


def j12_unprocessed_any(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "url_cache")
    seen = table(s, d, "sample_old_facebook").select(urls.dedup_url("url").alias("k"))
    return R.not_seen_any(c, seen, ["original_url"], [urls.dedup_url("original_url"), urls.dedup_url("resolved_url")], "k").select("original_url")


def j13_semi(s: SparkSession, d: str) -> DataFrame:
    busy = a20_busy_accounts(s, d).select("account_name")
    return table(s, d, "visits").join(busy, "account_name", "left_semi").groupBy("source_type").agg(F.count("*").alias("n"))


def j16_cache_probe(s: SparkSession, d: str) -> DataFrame:
    p, c = table(s, d, "sample_old_facebook").select("url").distinct(), table(s, d, "url_cache")
    return p.join(c, p["url"] == c["original_url"], "left").groupBy(F.col("original_url").isNotNull().alias("cached")).agg(F.count("*").alias("n"))


def u1_union(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "sample_old_facebook").select("url", "title", F.lit("pages").alias("origin"))
    b = table(s, d, "visits").select("url", "account_name", F.lit("visits").alias("origin"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("origin").agg(F.count("*").alias("n"), F.count("title").alias("titled"), F.count("account_name").alias("accounts"))


def u4_compare(s: SparkSession, d: str) -> DataFrame:
    return R.compare_sets(table(s, d, "visits"), table(s, d, "sample_old_facebook"), "url")


def u5_comparison_report(s: SparkSession, d: str) -> DataFrame:
    return u4_compare(s, d).groupBy("side").agg(F.count("*").alias("n"))


def u9_merge(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "sample_old_facebook").select("url", "title", F.col("row_id").alias("id"))
    b = table(s, d, "scraped_cache").select(F.col("original_url").alias("url"), "title", F.col("row_id").alias("id"))
    return R.merge_sources({"old_facebook": a, "cache": b}, ["url"], [F.asc("source"), F.asc("id")]).select("url", "source", "id")


def i3_cache_upsert(s: SparkSession, d: str) -> DataFrame:
    """The URL cache with what the scraped pages say later of the same addresses."""
    base = table(s, d, "url_cache").select("original_url", "resolved_url", "cached_at")
    new = table(s, d, "scraped_cache").select("original_url", "resolved_url", F.col("scraped_at").alias("cached_at"))
    return R.upsert(base, new, ["original_url"], [F.desc("cached_at"), F.asc_nulls_first("resolved_url")])


def resolve_chains(s: SparkSession, d: str) -> DataFrame:
    """Addresses followed through the cache's redirects, at most five steps."""
    c = table(s, d, "url_cache").filter("resolved_url IS NOT NULL")
    starts = table(s, d, "sample_old_facebook").select("url")
    return R.resolve_redirects(starts, c.select(F.col("original_url").alias("src"), F.col("resolved_url").alias("dst"))).drop("ended")


def resolve_outcomes(s: SparkSession, d: str) -> DataFrame:
    """How chains of redirects over the shared links end: customers' nations as links that run in circles, with a budget of 3."""
    n = table(s, d, "nation")
    step = n.select(F.concat(F.lit("n"), "n_nationkey").alias("src"), F.concat(F.lit("n"), F.pmod(F.col("n_nationkey") * 2 + 1, F.lit(30))).alias("dst"))
    starts = table(s, d, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("url"))
    return R.resolve_redirects(starts, step, 3)


def o1_recent_visits(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "visits").orderBy(F.desc_nulls_last("visit_datetime"), "source_file", "visit_id").select("source_file", "visit_id", "visit_datetime")


def o4_top_accounts(s: SparkSession, d: str) -> DataFrame:
    return a9_account_summary(s, d).filter("mainstream > 0").orderBy(F.desc("mainstream"), "account_name").select("account_name", "mainstream").limit(5)


def w2_file_sizes(s: SparkSession, d: str) -> DataFrame:
    return R.number_batches(table(s, d, "visits").select("source_file", "visit_id"), ["source_file", "visit_id"], 500).groupBy("batch").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in [
        c1_classify, a1_metrics, a2_optional_metrics, a3_activity_span, a4_by_source_type, a5_top_domains, a6_classification_summary, a7_titles_per_url, a8_url_rollup, a9_account_summary, a10_account_domains,
        a11_account_titles, a12_totals, a13_timestamp_validity, a14_resolution_report, a15_scraping_report, a16_unique_counts, a17_combine_summary, a18_length_stats, a19_completeness, a20_busy_accounts,
        a21_distinct_accounts, a22_language_shares, a23_error_counts, a24_user_inventory, a25_source_pivot, a26_top_per_class, a27_words_of_top_domains, a_rollup_sources, n1_keep_best, n3_unique_content,
        n3_unique_content_collapsed, n4_first_seen, n6_batches, n9_sampled_visits, n11_recent_rate, n12_error_runs, n_sessions, n_revisit_gap, j1_items_visits, j2_left_aggregate, j4_suffix_join,
        j6_resolved_pages, j8_pattern_match, j9_containment, j11_unprocessed, j12_unprocessed_any, j13_semi, j16_cache_probe, u1_union, u4_compare, u5_comparison_report, u9_merge, i3_cache_upsert,
        resolve_chains, resolve_outcomes, o1_recent_visits, o4_top_accounts, w2_file_sizes,
    ]
}

CLASSES = "(SELECT domain AS cd, CASE WHEN bool_or(classification = 'alternative') THEN 'alternative' ELSE min(classification) END AS cls FROM domain_classes GROUP BY 1)"
CV = f"(SELECT v.*, CASE WHEN d IS NULL THEN 'invalid_url' ELSE coalesce(cls, 'other') END AS c FROM (SELECT *, {domain_sql('url')} AS d FROM visits) v LEFT JOIN {CLASSES} ON d = cd)"
DAYS = "CAST(date_sub('day', min(visit_datetime), max(visit_datetime)) AS BIGINT)"
SUMMARY = f"""SELECT account_name, min(visit_datetime) AS earliest_activity, max(visit_datetime) AS latest_activity, {DAYS} AS activity_days, count(visit_datetime) AS valid_timestamps, count(*) AS total,
    count(*) FILTER (c = 'mainstream') AS mainstream, count(*) FILTER (c = 'alternative') AS alternative, count(*) FILTER (c NOT IN ('mainstream', 'alternative')) AS other,
    count(DISTINCT d) AS unique_domains, count(DISTINCT url) AS unique_urls, count(DISTINCT source_type) AS source_types FROM {CV} GROUP BY 1"""
CLEAN_VISITS = f"(SELECT *, coalesce({CLEANED}, '') AS clean_url FROM (SELECT *, split_part(url_decode(trim(url)), '#', 1) AS u FROM visits))"
DEDUP = lambda c: f"coalesce({params_sql(f'split_part(lower(trim({c})), {chr(39)}#{chr(39)}, 1)', urls.DEDUP_TRACKING)}, '')"
SIDES = """SELECT coalesce(a.url, b.url) AS url, CASE WHEN a.url IS NULL THEN 'only_b' WHEN b.url IS NULL THEN 'only_a' ELSE 'both' END AS side
    FROM (SELECT DISTINCT url FROM visits WHERE url IS NOT NULL) a FULL JOIN (SELECT DISTINCT url FROM sample_old_facebook WHERE url IS NOT NULL) b ON a.url = b.url"""
ORACLE = {
    "c1_classify": f"SELECT source_file, visit_id, d AS domain, c AS news_classification FROM {CV}",
    "a1_metrics": f"""SELECT source_file, count(*) AS visits, count(DISTINCT url) AS urls, count(DISTINCT d) AS domains, count(*) FILTER (c = 'mainstream') AS mainstream, count(*) FILTER (c = 'alternative') AS alternative,
        count(*) FILTER (c = 'other') AS other, min(visit_datetime) AS first_visit, max(visit_datetime) AS last_visit FROM {CV} GROUP BY 1""",
    "a2_optional_metrics": "SELECT source_type, count(title) AS titled, round(100.0 * count(title) / count(*), 6) AS titled_percent, round(avg(length(title)), 6) AS mean_title FROM visits GROUP BY 1",
    "a3_activity_span": f"SELECT account_name, {DAYS} AS days FROM visits GROUP BY 1",
    "a4_by_source_type": "SELECT source_type, count(visit_datetime) AS timed, count(DISTINCT url) AS urls, count(DISTINCT account_name) AS accounts FROM visits GROUP BY 1",
    "a5_top_domains": "SELECT domain, count(*) AS n FROM visits WHERE domain IS NOT NULL GROUP BY 1 ORDER BY n DESC, domain LIMIT 10",
    "a6_classification_summary": f"SELECT c AS news_classification, d AS domain, count(*) AS n FROM {CV} GROUP BY 1, 2",
    "a7_titles_per_url": "SELECT url, array_to_string(list_sort(list(DISTINCT title)), ', ') AS titles, count(visit_id) AS n FROM visits WHERE title IS NOT NULL GROUP BY 1",
    "a8_url_rollup": f"""SELECT clean_url, arg_min(title, (visit_datetime, source_file, visit_id, title)) FILTER (coalesce(title, '') <> '' AND visit_datetime IS NOT NULL) AS title,
        min(visit_datetime) AS first_seen, max(visit_datetime) AS last_seen, count(*) AS visit_count, array_to_string(list_sort(list(DISTINCT source_file)), '; ') AS source_files FROM {CLEAN_VISITS} WHERE clean_url <> '' GROUP BY 1""",
    "a9_account_summary": SUMMARY,
    "a10_account_domains": f"SELECT account_name, d AS domain, count(*) AS n, min(c) AS classification FROM {CV} GROUP BY 1, 2",
    "a11_account_titles": "SELECT account_name, title, count(*) AS n FROM visits WHERE title <> '' GROUP BY 1, 2",
    "a12_totals": f"SELECT round(avg(activity_days), 6) AS mean_days, CAST(sum(total) AS BIGINT) AS total, CAST(sum(mainstream) AS BIGINT) AS mainstream, max(unique_domains) AS most_domains FROM ({SUMMARY})",
    "a13_timestamp_validity": "SELECT source_type, count(visit_datetime) AS valid, count(*) - count(visit_datetime) AS invalid, min(visit_datetime) AS first, max(visit_datetime) AS last FROM visits GROUP BY 1",
    "a14_resolution_report": """SELECT count(*) AS total, count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed, count(*) FILTER (redirect_count > 0) AS redirected,
        round(100.0 * count(*) FILTER (success) / count(*), 6) AS success_rate, round(avg(response_time), 6) AS mean_response FROM url_cache""",
    "a15_scraping_report": """SELECT extraction_method, count(*) AS n, count(*) FILTER (coalesce(error, '') = '' AND coalesce(word_count, 0) > 0) AS succeeded, count(*) FILTER (paywall_detected) AS paywalled,
        round(avg(word_count), 6) AS mean_words, round(avg(scraping_time), 6) AS mean_time FROM scraped_cache GROUP BY 1""",
    "a16_unique_counts": "SELECT count(DISTINCT domain) AS domains, count(DISTINCT source) AS sources, count(DISTINCT url) AS urls FROM sample_old_facebook",
    "a17_combine_summary": "SELECT source, count(*) AS n, count(*) FILTER (status_code = 200 AND coalesce(content, '') <> '') AS succeeded, count(*) FILTER (coalesce(content, '') <> '') AS with_content FROM sample_old_facebook GROUP BY 1",
    "a18_length_stats": """SELECT source_type, CAST(min(n) AS INT) AS shortest, CAST(max(n) AS INT) AS longest, round(avg(n), 6) AS mean, CAST(max(n) FILTER (k = size // 2 + 1) AS INT) AS median, count(DISTINCT url) AS distinct_urls FROM
        (SELECT *, length(url) AS n, row_number() OVER (PARTITION BY source_type ORDER BY length(url), source_file, visit_id) AS k, count(*) OVER (PARTITION BY source_type) AS size FROM visits) GROUP BY 1""",
    "a19_completeness": f"""SELECT r.domain, resolved, coalesce(scraped, 0) AS scraped FROM (SELECT {domain_sql('resolved_url')} AS domain, count(*) AS resolved FROM url_cache GROUP BY 1) r
        LEFT JOIN (SELECT {domain_sql('url')} AS domain, count(*) AS scraped FROM sample_old_facebook GROUP BY 1) g USING (domain) WHERE domain IS NOT NULL""",
    "a20_busy_accounts": "SELECT account_name, count(*) AS n FROM visits GROUP BY 1 HAVING count(*) >= 20",
    "a21_distinct_accounts": "SELECT DISTINCT account_name, source_type FROM visits",
    "a22_language_shares": "SELECT lang, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM documents GROUP BY 1",
    "a23_error_counts": "SELECT success, error, count(*) AS n, max(cached_at) AS latest FROM url_cache GROUP BY 1, 2",
    "a24_user_inventory": "SELECT account_name, coalesce(array_to_string(list_sort(list(DISTINCT strftime(visit_datetime, '%Y-%m-%d')) FILTER (visit_datetime IS NOT NULL)), ','), '') AS days, array_to_string(list_sort(list(DISTINCT source_type)), ',') AS sources FROM visits GROUP BY 1",
    "a25_source_pivot": "SELECT account_name, count(*) FILTER (source_type = 'safari_db') AS safari_db, count(*) FILTER (source_type = 'chrome_json') AS chrome_json, count(*) FILTER (source_type = 'safari_json') AS safari_json FROM visits GROUP BY 1",
    "a26_top_per_class": f"SELECT * FROM (SELECT c AS news_classification, d AS domain, count(*) AS n, CAST(row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, d) AS INT) AS rank FROM {CV} WHERE d IS NOT NULL GROUP BY 1, 2) WHERE rank <= 5",
    "a27_words_of_top_domains": "SELECT domain, count(*) AS n, round(avg(word_count), 6) AS mean_words FROM sample_old_facebook WHERE domain IS NOT NULL GROUP BY 1 ORDER BY n DESC, domain LIMIT 15",
    "a_rollup_sources": "SELECT account_name, source_type, count(*) AS n FROM visits GROUP BY ROLLUP (account_name, source_type)",
    "n1_keep_best": "SELECT url, row_id, word_count FROM sample_old_facebook QUALIFY row_number() OVER (PARTITION BY url ORDER BY word_count DESC NULLS LAST, row_id) = 1",
    "n3_unique_content": "SELECT row_id, content_hash FROM sample_old_facebook QUALIFY content_hash IS NULL OR row_number() OVER (PARTITION BY content_hash ORDER BY row_id) = 1",
    "n3_unique_content_collapsed": "SELECT row_id, content_hash FROM sample_old_facebook QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY row_id) = 1",
    "n4_first_seen": f"SELECT clean_url, source_file, visit_id FROM {CLEAN_VISITS} QUALIFY row_number() OVER (PARTITION BY clean_url ORDER BY source_file, visit_id, visit_datetime) = 1",
    "n6_batches": "SELECT k // 1000 AS batch, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS k FROM orders) GROUP BY 1",
    "n9_sampled_visits": "SELECT source, least(greatest(1, CAST(floor(count(*) * 10.0 / 100) AS BIGINT)), 50) AS n FROM documents GROUP BY 1",
    "n11_recent_rate": "SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS last_5_minutes FROM events",
    "n12_error_runs": """WITH m AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
        r AS (SELECT user_id, island, count(*) FILTER (event_type = 'error') AS run FROM m GROUP BY 1, 2) SELECT user_id, max(run) AS longest_run FROM r GROUP BY 1""",
    "n_sessions": """WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 30 MINUTES THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        n AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no FROM g) SELECT user_id, session_no, count(*) AS n, min(ts) AS started, max(ts) AS ended FROM n GROUP BY 1, 2""",
    "n_revisit_gap": "SELECT event_id, date_sub('second', lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id), ts) AS gap FROM events",
    "j1_items_visits": "SELECT o_orderstatus, l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2",
    "j2_left_aggregate": "SELECT c_custkey, coalesce(n, 0) AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey",
    "j4_suffix_join": "SELECT n_nationkey, n_name AS name, r_name AS name_right FROM nation JOIN region ON n_regionkey = r_regionkey",
    "j6_resolved_pages": "SELECT row_id, p.resolved_url, c.resolved_url AS resolved_url_new, coalesce(success, false) AS resolved FROM sample_old_facebook p LEFT JOIN url_cache c ON p.url = c.original_url",
    "j8_pattern_match": """SELECT url, arg_min(pattern, (rank, pattern)) AS pattern FROM (SELECT DISTINCT url FROM sample_old_facebook)
        JOIN (SELECT regexp_extract(domain, '^([^.]+)', 1) AS pattern, CASE WHEN classification = 'alternative' THEN 0 ELSE 1 END AS rank FROM domain_classes) ON regexp_matches(url, pattern) GROUP BY 1""",
    "j9_containment": """SELECT resolved_url, arg_min(pattern, (rank, pattern)) AS pattern FROM (SELECT DISTINCT resolved_url FROM scraped_cache)
        JOIN (SELECT replace(regexp_extract(domain, '^([^.]+)', 1), '-', '') AS pattern, CASE WHEN classification = 'alternative' THEN 0 ELSE 1 END AS rank FROM domain_classes)
        ON contains(replace(replace(lower(resolved_url), '.', ''), '-', ''), pattern) GROUP BY 1""",
    "j11_unprocessed": "SELECT DISTINCT url FROM visits v WHERE NOT EXISTS (SELECT 1 FROM sample_old_facebook p WHERE p.url = v.url)",
    "j12_unprocessed_any": f"""WITH seen AS (SELECT DISTINCT {DEDUP('url')} AS k FROM sample_old_facebook)
        SELECT original_url FROM url_cache WHERE {DEDUP('original_url')} NOT IN (SELECT k FROM seen) AND {DEDUP('resolved_url')} NOT IN (SELECT k FROM seen)""",
    "j13_semi": "SELECT source_type, count(*) AS n FROM visits WHERE account_name IN (SELECT account_name FROM visits GROUP BY 1 HAVING count(*) >= 20) GROUP BY 1",
    "j16_cache_probe": "SELECT c.original_url IS NOT NULL AS cached, count(*) AS n FROM (SELECT DISTINCT url FROM sample_old_facebook) LEFT JOIN url_cache c ON url = c.original_url GROUP BY 1",
    "u1_union": "SELECT 'pages' AS origin, count(*) AS n, count(title) AS titled, CAST(0 AS BIGINT) AS accounts FROM sample_old_facebook UNION ALL SELECT 'visits', count(*), 0, count(account_name) FROM visits",
    "u4_compare": SIDES,
    "u5_comparison_report": f"SELECT side, count(*) AS n FROM ({SIDES}) GROUP BY 1",
    "u9_merge": """SELECT url, source, id FROM (SELECT url, 'old_facebook' AS source, row_id AS id FROM sample_old_facebook UNION ALL SELECT original_url, 'cache', row_id FROM scraped_cache)
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY source, id) = 1""",
    "i3_cache_upsert": """SELECT original_url, resolved_url, cached_at FROM (SELECT original_url, resolved_url, cached_at FROM url_cache UNION ALL SELECT original_url, resolved_url, scraped_at FROM scraped_cache)
        QUALIFY row_number() OVER (PARTITION BY original_url ORDER BY cached_at DESC, resolved_url NULLS FIRST) = 1""",
    "resolve_chains": """WITH RECURSIVE e AS (SELECT original_url AS src, resolved_url AS dst FROM url_cache WHERE resolved_url IS NOT NULL AND original_url <> resolved_url),
        w AS (SELECT DISTINCT url, url AS cur, 0 AS n FROM sample_old_facebook UNION ALL SELECT url, dst, n + 1 FROM w JOIN e ON cur = src WHERE n < 5)
        SELECT url, arg_max(cur, n) AS resolved_url, CAST(max(n) AS INT) AS redirect_count FROM w GROUP BY 1""",
    "resolve_outcomes": """WITH RECURSIVE e AS (SELECT 'n' || n_nationkey AS src, 'n' || ((n_nationkey * 2 + 1) % 30) AS dst FROM nation WHERE n_nationkey <> (n_nationkey * 2 + 1) % 30),
        w AS (SELECT DISTINCT 'n' || c_nationkey AS url, 'n' || c_nationkey AS cur, 0 AS n, ['n' || c_nationkey] AS path, false AS looped FROM customer
            UNION ALL SELECT url, dst, n + 1, list_append(path, dst), looped OR list_contains(path, dst) FROM w JOIN e ON cur = src WHERE n < 3),
        l AS (SELECT url, arg_max(cur, n) AS resolved_url, CAST(max(n) AS INT) AS redirect_count, bool_or(looped) AS looped FROM w GROUP BY 1)
        SELECT url, resolved_url, redirect_count, CASE WHEN redirect_count = 0 THEN 'direct' WHEN looped THEN 'loop' WHEN redirect_count = 3 AND resolved_url IN (SELECT src FROM e) THEN 'budget' ELSE 'resolved' END AS ended FROM l""",
    "o1_recent_visits": "SELECT source_file, visit_id, visit_datetime FROM visits ORDER BY visit_datetime DESC NULLS LAST, source_file, visit_id",
    "o4_top_accounts": f"SELECT account_name, mainstream FROM ({SUMMARY}) WHERE mainstream > 0 ORDER BY mainstream DESC, account_name LIMIT 5",
    "w2_file_sizes": "SELECT k // 500 AS batch, count(*) AS n FROM (SELECT row_number() OVER () - 1 AS k FROM visits) GROUP BY 1",
}
