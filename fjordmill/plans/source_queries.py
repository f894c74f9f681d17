"""Sources and sinks end to end: files are written from the tables, read back by the engine and compared with the tables.

Documents hold at most ``DOCUMENT`` records each, so no task builds one of unbounded size. All folders lie below the shared
checkpoint folder and are removed when the application ends.
"""

from __future__ import annotations

import sqlite3
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fjordmill.functions import text, times, urls
from fjordmill.operators import relational as R
from fjordmill.plans.report_queries import DEDUP
from fjordmill.plans.url_queries import domain_sql
from fjordmill.session import delete_on_exit, ensure_checkpoint_dir, ship_package, table
from fjordmill.sinks import files as sinks
from fjordmill.sources import browser_json, catalog, html, social, sqlite, tabular

DOCUMENT = 5000


def folder(s: SparkSession, name: str) -> str:
    path = f"{ensure_checkpoint_dir(s)}/{name}-{uuid.uuid4().hex}"
    delete_on_exit(s, path)
    return path


def documents(df: DataFrame, order: list[str], item: Column) -> DataFrame:
    """doc, items: the items of at most ``DOCUMENT`` rows each, in order."""
    return R.number_batches(df, order, DOCUMENT, out="doc").groupBy("doc").agg(F.collect_list(item).alias("items"))


def written(s: SparkSession, docs: DataFrame, content: Column, name: str) -> str:
    """A folder with one text file per document."""
    path = folder(s, name)
    docs.select("doc", content.alias("value")).repartition("doc").write.partitionBy("doc").text(path)
    return path


def json_docs(s: SparkSession, docs: DataFrame, content: Column, name: str) -> DataFrame:
    return browser_json.json_files(s, written(s, docs, F.to_json(content), name), "*.txt")


def visits_of(s: SparkSession, d: str, kind: str) -> DataFrame:
    return table(s, d, "visits").filter(F.col("source_type") == kind)


VISIT_ORDER = ["source_file", "visit_id", "url"]


def _databases(s: SparkSession, d: str) -> DataFrame:
    """path, content: SQLite histories of the safari_db visits; every second one in the smaller schema."""
    ship_package(s)
    item = F.struct("visit_id", "url", "title", "visit_time")
    docs = documents(visits_of(s, d, "safari_db"), VISIT_ORDER, item)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, items in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                con = sqlite3.connect(":memory:")
                con.executescript("CREATE TABLE history_items (id, url, title); CREATE TABLE history_visits (id, history_item, visit_time" + (", title, from_visit);" if doc % 2 else ");"))
                con.executemany("INSERT INTO history_items VALUES (?, ?, ?)", [(k, x["url"], None if doc % 2 else x["title"]) for k, x in enumerate(items)])
                if doc % 2:
                    con.executemany("INSERT INTO history_visits VALUES (?, ?, ?, ?, NULL)", [(x["visit_id"], k, x["visit_time"], x["title"]) for k, x in enumerate(items)])
                else:
                    con.executemany("INSERT INTO history_visits VALUES (?, ?, ?)", [(x["visit_id"], k, x["visit_time"]) for k, x in enumerate(items)])
                con.commit()
                out.append(con.serialize())
                con.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{x}.db" for x in b.column(0).to_pylist()]), pa.array(out, pa.binary())], ["path", "content"])

    return docs.select("doc", "items").mapInArrow(build, "path string, content binary")


def s8_sqlite_visits(s: SparkSession, d: str) -> DataFrame:
    return sqlite.parse_histories(_databases(s, d)).select("visit_id", "url", "title", "visit_time", "error")


def s11_sqlite_tables(s: SparkSession, d: str) -> DataFrame:
    return sqlite.parse_histories(_databases(s, d), "tables").groupBy("table_name").agg(F.sum("row_count").alias("n"))


def s11_broken_files(s: SparkSession, d: str) -> DataFrame:
    """Texts instead of databases: one row with an error per file."""
    texts = table(s, d, "documents").select(F.concat("doc_id", F.lit(".db")).alias("path"), F.to_binary("text", F.lit("utf-8")).alias("content"))
    return sqlite.parse_histories(texts).groupBy("visit_id").agg(F.count("error").alias("n"))


def _safari(s: SparkSession, d: str) -> DataFrame:
    docs = documents(visits_of(s, d, "safari_json"), VISIT_ORDER, F.struct("url", "title", F.col("visit_time").alias("time_usec")))
    return json_docs(s, docs, F.struct(F.struct(F.lit("Safari").alias("browser_name"), F.lit("history").alias("data_type")).alias("metadata"), F.col("items").alias("history")), "safari")


def s12_safari_json(s: SparkSession, d: str) -> DataFrame:
    return browser_json.safari_visits(_safari(s, d)).select("url", "title", "visit_time")


def _chrome(s: SparkSession, d: str) -> DataFrame:
    """Chrome exports in three shapes: a list, a known key, any other key."""
    docs = documents(visits_of(s, d, "chrome_json"), VISIT_ORDER, F.struct(F.col("visit_id").alias("id"), "url", "title", F.col("visit_time").alias("visitTime")))
    shapes = [F.to_json("items"), F.to_json(F.struct(F.col("items").alias("Browser History"))), F.to_json(F.struct(F.lit(1).alias("x"), F.col("items").alias("visits")))]
    content = F.when(F.col("doc") % 3 == 0, shapes[0]).when(F.col("doc") % 3 == 1, shapes[1]).otherwise(shapes[2])
    return browser_json.json_files(s, written(s, docs, content, "chrome"), "*.txt")


def s13_chrome_json(s: SparkSession, d: str) -> DataFrame:
    v = browser_json.chrome_visits(_chrome(s, d))
    return v.select("visit_id", "url", "title", F.col("visit_time").cast("double").alias("visit_time"))


def s14_unified(s: SparkSession, d: str) -> DataFrame:
    """The three kinds of files in one schema."""
    cols = ["source_type", "url", "visit_time"]
    db = sqlite.parse_histories(_databases(s, d)).withColumn("source_type", F.lit("safari_db")).select(*cols)
    safari = browser_json.safari_visits(_safari(s, d)).withColumn("source_type", F.lit("safari_json")).select(*cols)
    chrome = browser_json.chrome_visits(_chrome(s, d)).select(F.lit("chrome_json").alias("source_type"), "url", F.col("visit_time").cast("double").alias("visit_time"))
    return db.unionByName(safari).unionByName(chrome)


def s15_activity_items(s: SparkSession, d: str) -> DataFrame:
    """Posts of an export under three keys, with their text and time."""
    item = F.struct(F.col("doc_id").alias("timestamp"), F.array(F.struct(F.col("text").alias("post"))).alias("data"), F.col("url").alias("title"))
    docs = documents(table(s, d, "documents"), ["doc_id"], item)
    keyed = [F.to_json(F.struct(F.col("items").alias(k))) for k in ("comments_v2", "group_posts_v2")]
    content = F.when(F.col("doc") % 3 == 0, keyed[0]).when(F.col("doc") % 3 == 1, keyed[1]).otherwise(F.to_json("items"))
    items = social.activity_items(browser_json.json_files(s, written(s, docs, content, "activity"), "*.txt"))
    return items.select(F.try_variant_get("item", "$.timestamp", "long").alias("doc_id"), social.item_text().alias("text"))


def s17_recently_viewed(s: SparkSession, d: str) -> DataFrame:
    entry = F.struct(F.col("visit_id").cast("string").alias("timestamp"), F.struct(F.col("url").alias("uri"), F.col("title").alias("name"), F.lit("12").alias("watch_time")).alias("data"))
    docs = documents(table(s, d, "visits"), VISIT_ORDER, entry)
    nested = F.struct(F.array(F.struct(F.array(F.struct(F.col("items").alias("entries"))).alias("children"))).alias("recently_viewed"))
    seen = social.recently_viewed(json_docs(s, docs, nested, "viewed"), table(s, d, "domain_classes"))
    return seen.select("url", "name", "watch_time", "news_classification")


def s18_liked_pages(s: SparkSession, d: str) -> DataFrame:
    """Pages named after authors and domains; patterns are the first parts of classified domains."""
    names = table(s, d, "visits").select(F.concat_ws(" ", "account_name", "domain").alias("name")).distinct()
    docs = documents(names, ["name"], F.struct("name", F.lit(5).alias("timestamp")))
    patterns = table(s, d, "domain_classes").select(F.regexp_replace("domain", r"\.example$", "").alias("pattern")).distinct().withColumn("rank", F.length("pattern"))
    liked = social.liked_pages(json_docs(s, docs, F.struct(F.col("items").alias("page_likes_v2")), "likes"), patterns)
    return liked.select("name", "pattern")


def s19_reactions(s: SparkSession, d: str) -> DataFrame:
    title = F.concat("account_name", F.lit(" synes godt om "), F.upper("domain"), F.lit("s opslag"))
    docs = documents(table(s, d, "visits"), VISIT_ORDER, F.struct(F.col("visit_id").alias("timestamp"), title.alias("title")))
    return social.reactions(json_docs(s, docs, F.col("items"), "reactions")).select("timestamp", "actor")


def _names(s: SparkSession, d: str, name: Column) -> DataFrame:
    """A catalog of files named after visits, one per source file and tenth visit."""
    v = table(s, d, "visits").select(F.col("account_name").alias("directory"), name.alias("filename"), (F.col("visit_id") * 1000).alias("size_bytes"))
    ext = F.lower(F.regexp_extract("filename", r".(\.[^.]+)$", 1))
    return v.groupBy("directory", "filename").agg(F.max("size_bytes").alias("size_bytes")).withColumn("extension", ext).withColumn("full_path", F.concat_ws("/", "directory", "filename"))


def s20_numbered_files(s: SparkSession, d: str) -> DataFrame:
    names = _names(s, d, F.concat(F.lit("posts_"), F.pmod(F.col("visit_id") * 7, F.lit(40)) + 1, F.lit(".json")))
    return social.numbered_until_gap(names, "posts_").select("directory", "file_no")


def s21_html_activities(s: SparkSession, d: str) -> DataFrame:
    escaped = F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    part = F.concat(F.lit("<time datetime='"), F.col("visit_id").cast("string"), F.lit("'></time><div class='x _3-95'>opslag om "), escaped, F.lit("</div><img src='"), F.col("visit_id").cast("string"), F.lit(".jpg'>"))
    docs = documents(table(s, d, "visits"), VISIT_ORDER, part).select(F.col("doc").cast("string").alias("file"), F.array_join("items", "\n").alias("html"))
    return html.activities(docs, "file", "html").select("kind", "time", "value")


def s22_viewed_links(s: SparkSession, d: str) -> DataFrame:
    part = F.concat(F.lit("<div>maj 06, 2025 1:15:11 pm <a href='https://www.facebook.com/dyi/l/?l="), F.url_encode("url"), F.lit("'>se</a></div>"))
    docs = documents(table(s, d, "visits").select("url").distinct(), ["url"], part).select(F.col("doc").cast("string").alias("file"), F.array_join("items", "\n").alias("html"))
    return html.viewed_links(docs, "file", "html").select("day", "url")


def s23_html_urls(s: SparkSession, d: str) -> DataFrame:
    part = F.concat(F.lit("<p><a href=\""), F.col("url"), F.lit("\">læs</a></p>"))
    docs = documents(table(s, d, "visits").select("url").distinct(), ["url"], part).select(F.col("doc").cast("string").alias("file"), F.array_join("items", "\n").alias("html"))
    return html.urls_in_html(docs, "file", "html").select("url")


def s24_csv_batches(s: SparkSession, d: str) -> DataFrame:
    """Scraped pages written as numbered CSV batches with multi-line fields, read back with their batch number."""
    path = folder(s, "csv")
    pages = table(s, d, "scraped_cache").select("row_id", F.replace("content", F.lit("\r"), F.lit(" ")).alias("content"), "status_code")
    sinks.write_batches(pages, path, ["row_id"], 500)
    back = tabular.csv_batches(s, f"{path}/*/*.csv", "row_id long, content string, status_code int")
    number = F.regexp_extract(F.col("_metadata.file_path"), r"batch=(\d+)", 1).cast("long")
    return back.select("row_id", F.nullif("content", F.lit("")).alias("content"), "status_code", number.alias("batch_no"))


def s1_catalog(s: SparkSession, d: str) -> DataFrame:
    """The files of a folder per account, by the directory they lie in."""
    path = folder(s, "catalog")
    table(s, d, "visits").select("account_name", "url").repartition("account_name").write.partitionBy("account_name").json(path)
    files = catalog.file_catalog(s, path, "*.json").filter("size_bytes > 0")
    account = F.regexp_extract("directory", r"account_name=(.*)$", 1)
    return files.groupBy(account.alias("account_name"), "extension").agg(F.count_distinct("directory").alias("n"))


def s7_account_names(s: SparkSession, d: str) -> DataFrame:
    """Accounts and source folders in the paths of export files."""
    path = F.concat(F.lit("/data/facebook-"), F.replace("account_name", F.lit("_"), F.lit("")), F.lit("-2024"))
    v = table(s, d, "visits").select("account_name").distinct()
    return v.select("account_name", catalog.account_name(path).alias("account"), catalog.source_folder(F.concat(path, F.lit("/posts/a.json"))).alias("source"))


def s32_filename_facts(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "visits").select("source_file").distinct()
    name = F.concat(F.lit("2025-01-02T03_"), F.replace("source_file", F.lit("/"), F.lit("-")), F.lit(".json"))
    return v.select("source_file", catalog.filename_facts(name).alias("f")).select("source_file", "f.stamp", "f.user", "f.source_type", "f.file_type")


def _mixed_names(s: SparkSession, d: str) -> DataFrame:
    kinds = F.array(*map(F.lit, ["history.db", "safari.json", "Historik.sqlite", "old_chrome.json", "notes.txt", "bookmarks.plist", "browser_history.json", "firefox.csv", "x.db", "posts.json", "page.html"]))
    return _names(s, d, F.concat(F.col("visit_id").cast("string"), F.lit("_"), F.get(kinds, F.pmod("visit_id", F.lit(11)).cast("int"))))


def filter_p24_unprocessed_files(s: SparkSession, d: str) -> DataFrame:
    files = _mixed_names(s, d)
    left = catalog.unprocessed(files, files.filter("size_bytes % 2000 = 0"))
    return left.select("full_path", "reason_not_processed", "potentially_relevant", "size_mb")


def filter_p11_file_predicates(s: SparkSession, d: str) -> DataFrame:
    files = _mixed_names(s, d)
    return files.select("full_path", catalog.any_part("filename", catalog.BROWSER_PARTS).alias("browser"), catalog.any_part("filename", catalog.POST_FILES).alias("posts"))


def s3_history_files(s: SparkSession, d: str) -> DataFrame:
    return catalog.history_files(_mixed_names(s, d)).select("full_path")


def s2_export_files(s: SparkSession, d: str) -> DataFrame:
    return catalog.export_files(_mixed_names(s, d)).select("full_path")


def s4_social_folders(s: SparkSession, d: str) -> DataFrame:
    return catalog.social_folders(_mixed_names(s, d), ["page"], 20)


def s27_url_list(s: SparkSession, d: str) -> DataFrame:
    """S25: a CSV of addresses with another column first."""
    path = folder(s, "urls")
    sinks.write_csv(table(s, d, "url_cache").select("status_code", "original_url"), path)
    return tabular.url_list(s, path)


def w1_flat_csv(s: SparkSession, d: str) -> DataFrame:
    """Lists joined, structs as JSON, times as text."""
    path = folder(s, "flat")
    rich = table(s, d, "events").select("event_id", "ts", F.array("event_type", "props").alias("list"), F.struct("user_id").alias("inner"))
    sinks.write_csv(rich, path, max_rows=700)
    return s.read.schema("event_id long, ts string, list string, inner string").option("header", True).option("escape", '"').csv(path)


def w2_parts(s: SparkSession, d: str) -> DataFrame:
    """No part of a size-limited CSV has more rows than allowed."""
    path = folder(s, "parts")
    sinks.write_csv(table(s, d, "orders").select("o_orderkey", "o_custkey"), path, max_rows=1000)
    per_file = s.read.option("header", True).csv(path).groupBy(F.col("_metadata.file_name")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 1000).alias("all_small"))


def w3_both(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "both")
    sinks.write_both(table(s, d, "customer"), path)
    a = s.read.parquet(f"{path}/parquet").select("c_custkey", "c_name", "c_acctbal")
    b = s.read.schema("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").option("header", True).csv(f"{path}/csv").select("c_custkey", "c_name", "c_acctbal")
    return a.withColumn("sink", F.lit("parquet")).unionByName(b.withColumn("sink", F.lit("csv")))


def w4_sheets(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "sheets")
    v = table(s, d, "visits")
    sinks.write_sheets({"accounts": v.groupBy("account_name").agg(F.count("*").alias("n")), "types": v.groupBy("source_type").agg(F.count("*").alias("n"))}, path)
    read = lambda name, col: s.read.schema(f"{col} string, n long").option("header", True).csv(f"{path}/{name}").select(F.lit(name).alias("sheet"), F.col(col).alias("label"), "n")
    return read("accounts", "account_name").unionByName(read("types", "source_type"))


def w6_batches(s: SparkSession, d: str) -> DataFrame:
    """Numbered batches, of which the later ones are written twice."""
    path = folder(s, "batches")
    orders = table(s, d, "orders").select("o_orderkey")
    sinks.write_batches(orders, path, ["o_orderkey"], 1000)
    sinks.write_batches(orders, path, ["o_orderkey"], 1000)
    return s.read.option("header", True).csv(path).groupBy(F.col("batch").cast("long").alias("batch")).agg(F.count("*").alias("n"), F.min(F.col("o_orderkey").cast("long")).alias("first"))


def w7_append_new(s: SparkSession, d: str) -> DataFrame:
    """Two batches of addresses, the second written twice; each address once."""
    path = folder(s, "append")
    a, b = table(s, d, "url_cache").select(F.col("original_url").alias("url")), table(s, d, "sample_old_facebook").select("url").filter("url IS NOT NULL")
    sinks.append_new(a, path, "url", None, "0")
    for _ in range(2):
        sinks.append_new(b, path, "url", s.read.parquet(f"{path}/batch=0"), "1")
    return s.read.parquet(path).select("url", F.col("batch").cast("int").alias("batch"))


def w12_by_domain(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "domains")
    v = table(s, d, "visits").filter("domain IS NOT NULL AND domain <> ''").select("domain", "visit_id", "url")
    sinks.write_by_domain(v, path)
    return s.read.schema("visit_id long, url string, domain string").json(path).select("domain", "visit_id", "url")


def x10_pages(s: SparkSession, d: str) -> DataFrame:
    """Pages built around each content, with menus and scripts about it, taken apart again."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    paragraphs = F.array_join(F.transform(F.split(esc(F.col("content")), "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    page = F.concat(
        F.lit('<html lang="da"><head><title>'), esc(F.col("title")), F.lit('</title><meta name="author" content="'), esc(F.col("author")), F.lit('"></head><body><nav>Menu</nav><script>var x = 1;</script><article>'),
        paragraphs, F.lit("</article><footer>Bund</footer></body></html>"),
    )
    got = html.extract_pages(table(s, d, "scraped_cache").select("row_id", page.alias("html")), "row_id", "html")
    return got.select(F.col("id").alias("row_id"), F.nullif("author", F.lit("")).alias("author"), "language", F.size(F.filter(F.split("content", "\n"), lambda x: x != "")).alias("n_lines"), F.contains("content", F.lit("Bund")).alias("footer"))


def x14_keys(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", F.concat(F.lit('{"a":[{"b":'), "props", F.lit('}],"k":"x"}')).alias("doc"))
    return browser_json.keys_at_any_path(e, "event_id", "doc", ["k"]).withColumnRenamed("id", "event_id")


def k6_meta_refresh(s: SparkSession, d: str) -> DataFrame:
    u = table(s, d, "url_cache")
    page = F.concat(F.lit("<head><META HTTP-EQUIV='refresh' content=\"0; URL="), F.coalesce("resolved_url", F.lit("")), F.lit("\"></head>"))
    return u.select("original_url", urls.meta_refresh_target(page).alias("target"))


def k7_shims(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "visits").select("url").distinct()
    link = F.concat(F.lit("<a href='https://www.facebook.com/dyi/l/?h=1&u="), F.url_encode("url"), F.lit("&x=2'>"))
    return v.select("url", F.get(urls.shim_targets(link), F.lit(0)).alias("target"))


def k8_external_links(s: SparkSession, d: str) -> DataFrame:
    """Posts with a link, an entity, an own address or none."""
    doc = F.col("doc_id")
    link = F.when(doc % 4 == 0, F.col("url"))
    entities = F.when(doc % 4 == 1, F.struct(F.array(F.struct(F.lit("https://t.example/1").alias("url"), F.col("url").alias("expanded_url"))).alias("urls")))
    own = F.when(doc % 4 == 2, F.concat(F.lit("https://reddit.com/"), doc)).when(doc % 4 == 3, F.col("url"))
    posts = table(s, d, "documents").select("doc_id", F.parse_json(F.to_json(F.struct(link.alias("link"), entities.alias("entities"), own.alias("url")))).alias("post"))
    return posts.select("doc_id", social.external_link().alias("link"))


def k9_permalinks(s: SparkSession, d: str) -> DataFrame:
    platform = F.get(F.array(*map(F.lit, ["Telegram", "vk", "youtube", "web"])), F.pmod("doc_id", F.lit(4)).cast("int"))
    return table(s, d, "documents").select("doc_id", urls.permalink(platform, F.col("actor_username"), F.col("doc_id").cast("string")).alias("link"))


def t4_social_times(s: SparkSession, d: str) -> DataFrame:
    """Unix seconds and ISO texts with an offset."""
    e = table(s, d, "events")
    value = F.when(F.col("event_id") % 2 == 0, F.unix_seconds(F.date_trunc("second", "ts").cast("timestamp")).cast("string")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    return e.select("event_id", times.social_timestamp(value).alias("at"))


def t9_localised_dates(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    value = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "MMM d, yyyy h:mm:ss a")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.concat(F.lit("engang i "), F.year("ts").cast("string")))
    return e.select("event_id", times.localised_date(value).alias("at"))


def x15_compact(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "visits").select("domain").distinct()
    return v.select("domain", text.compact_domain("domain").alias("compact"), text.size_mb(F.length("domain") * 100_000).alias("mb"))


def x17_rates(s: SparkSession, d: str) -> DataFrame:
    """Success rates in percent, a percentage of the rows rounded down, and the size of each of seven shares rounded up."""
    u = table(s, d, "url_cache").groupBy("redirect_count").agg(F.count("*").alias("n"), F.count_if("success").alias("good"))
    return u.select("redirect_count", F.round(100 * F.col("good") / F.col("n"), 6).alias("percent"), F.floor(F.col("n") * 15 / 100).alias("fifteen"), F.ceil(F.col("n") / 7).alias("share"))


def x18_beginnings(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.substring("text", 1, 80).alias("beginning"))


def filter_p18_language_code(s: SparkSession, d: str) -> DataFrame:
    """Documents in a wanted language; the most common language of an actor's documents goes before a document's own label."""
    docs = table(s, d, "documents")
    code = F.lower(F.split_part("lang", F.lit("-"), F.lit(1)))
    known = docs.filter("actor_username IS NOT NULL AND lang IS NOT NULL").groupBy("actor_username", code.alias("code")).agg(F.count("*").alias("n"))
    actor = known.groupBy("actor_username").agg(F.min_by("code", F.struct(-F.col("n"), "code")).alias("actor_code"))
    wanted = F.coalesce("actor_code", code)
    return docs.join(actor, "actor_username", "left").filter(wanted.isin("da", "sv", "de")).select("doc_id", wanted.alias("code"))


def o6_by_time(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", "ts").orderBy(F.asc_nulls_last("ts"), "event_id")


def o10_first_items(s: SparkSession, d: str) -> DataFrame:
    """The first 20 addresses that only one of two data sets has; the limit is the feature."""
    sides = R.compare_sets(table(s, d, "url_cache").select(F.col("original_url").alias("url")), table(s, d, "sample_old_facebook").select("url"), "url")
    return sides.filter("side = 'only_b'").orderBy("url").limit(20).select("url")


def c2_second_dictionary(s: SparkSession, d: str) -> DataFrame:
    """Another, smaller dictionary, its entries trimmed, lower-cased and without www."""
    words = table(s, d, "domain_classes").filter("classification = 'alternative'").select(F.concat(F.lit(" WWW."), F.upper("domain")).alias("domain"), "classification")
    clean = words.select(F.regexp_replace(F.lower(F.trim("domain")), r"^www\.", "").alias("domain"), "classification")
    from fjordmill.operators.classify import classify

    v = table(s, d, "visits").withColumn("d", urls.domain("url"))
    return classify(v, clean, "d", "cls").groupBy("cls").agg(F.count("*").alias("n"))


def n5_row_index(s: SparkSession, d: str) -> DataFrame:
    """An exact index over all rows in a global order."""
    pages = table(s, d, "sample_old_facebook").select("row_id")
    return R.number_batches(pages, ["row_id"], 1, out="row_index")


def n8_slice_sample(s: SparkSession, d: str) -> DataFrame:
    """A contiguous slice of 40 of each account's visits from a seeded start, and 5 of it by least seeded hash.

    The start is a number from 0 to the account's number of visits less 40, by the MD5 of seed and account."""
    v = table(s, d, "visits").filter("account_name IS NOT NULL").select("account_name", "visit_id").distinct()
    counts = v.groupBy("account_name").agg(F.count("*").alias("n"))
    digits = F.conv(F.substring(F.md5(F.concat(F.lit("42-"), F.col("account_name"))), 1, 8), 16, 10).cast("long")
    start = F.pmod(digits, F.greatest(F.col("n") - 40, F.lit(0)) + 1)
    numbered = v.withColumn("pos", F.row_number().over(W.partitionBy("account_name").orderBy("visit_id")) - 1)
    inside = numbered.join(counts.select("account_name", start.alias("start")), "account_name").filter((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + 40))
    key = F.md5(F.concat(F.lit("42-"), F.col("visit_id").cast("string")))
    return R.top_per_group(inside.withColumn("key", key), ["account_name"], [F.asc("key")], 5).select("account_name", "visit_id", F.col("pos").cast("long").alias("pos"))


def u5_examples(s: SparkSession, d: str) -> DataFrame:
    """The counts of both sides and the first 20 of each; the limit is the feature."""
    sides = R.compare_sets(table(s, d, "visits").select("url"), table(s, d, "sample_old_facebook").select("url"), "url")
    counts = sides.groupBy("side").agg(F.count("*").alias("n"))
    first = R.top_per_group(sides, ["side"], [F.asc("url")], 20)
    return first.join(counts, "side").select("side", "n", F.col("rank").cast("int").alias("rank"), "url")


def n10_better_pages(s: SparkSession, d: str) -> DataFrame:
    """Domains whose latest page has clearly more words than their first one."""
    c = table(s, d, "sample_old_facebook").filter("word_count IS NOT NULL AND domain IS NOT NULL")
    g = c.groupBy("domain").agg(F.min_by("word_count", "row_id").alias("old_words"), F.max_by("word_count", "row_id").alias("new_words"))
    return g.filter(F.col("new_words") > F.greatest(F.col("old_words") * 1.2, F.col("old_words") + 100))


def j12_new_by_any(s: SparkSession, d: str) -> DataFrame:
    """Cached pages neither of whose addresses was visited."""
    c = table(s, d, "scraped_cache").select("row_id", "original_url", "resolved_url")
    seen = table(s, d, "visits").select(urls.dedup_url("url").alias("k"))
    return R.not_seen_any(c, seen, ["row_id"], [urls.dedup_url("original_url"), urls.dedup_url("resolved_url")], "k").select("row_id")


QUERIES = {
    f.__name__: f
    for f in [
        s8_sqlite_visits, s11_sqlite_tables, s11_broken_files, s12_safari_json, s13_chrome_json, s14_unified, s15_activity_items, s17_recently_viewed, s18_liked_pages, s19_reactions, s20_numbered_files,
        s21_html_activities, s22_viewed_links, s23_html_urls, s24_csv_batches, s1_catalog, s7_account_names, s32_filename_facts, filter_p24_unprocessed_files, filter_p11_file_predicates, s3_history_files, s2_export_files,
        s4_social_folders, s27_url_list, w1_flat_csv, w2_parts, w3_both, w4_sheets, w6_batches, w7_append_new, w12_by_domain, x10_pages, x14_keys, k6_meta_refresh, k7_shims, k8_external_links, k9_permalinks,
        t4_social_times, t9_localised_dates, x15_compact, x17_rates, x18_beginnings, filter_p18_language_code, o6_by_time, o10_first_items, c2_second_dictionary, n5_row_index, n8_slice_sample, u5_examples,
        n10_better_pages, j12_new_by_any,
    ]
}

CLS = "(SELECT domain AS cd, CASE WHEN bool_or(classification = 'alternative') THEN 'alternative' ELSE min(classification) END AS cls FROM domain_classes GROUP BY 1)"
NAMES = "(SELECT account_name AS directory, {name} AS filename, max(visit_id * 1000) AS size_bytes FROM visits GROUP BY 1, 2)"
KINDS = "['history.db', 'safari.json', 'Historik.sqlite', 'old_chrome.json', 'notes.txt', 'bookmarks.plist', 'browser_history.json', 'firefox.csv', 'x.db', 'posts.json', 'page.html']"
MIXED = (
    "(SELECT *, coalesce(directory || '/', '') || filename AS full_path, lower(regexp_extract(filename, '.(\\.[^.]+)$', 1)) AS ext, lower(filename) AS low FROM "
    + NAMES.format(name=f"CAST(visit_id AS VARCHAR) || '_' || {KINDS}[CAST(visit_id % 11 AS INT) + 1]")
    + ")"
)
SIDES = "(SELECT coalesce(a.url, b.url) AS url, CASE WHEN a.url IS NULL THEN 'only_b' WHEN b.url IS NULL THEN 'only_a' ELSE 'both' END AS side FROM (SELECT DISTINCT {a} AS url FROM {t} WHERE {a} IS NOT NULL) a FULL JOIN (SELECT DISTINCT url FROM sample_old_facebook WHERE url IS NOT NULL) b ON a.url = b.url)"
ORACLE = {
    "s8_sqlite_visits": "SELECT visit_id, url, title, visit_time, CAST(NULL AS VARCHAR) AS error FROM visits WHERE source_type = 'safari_db'",
    "s11_sqlite_tables": "SELECT unnest(['history_items', 'history_visits']) AS table_name, count(*) AS n FROM visits WHERE source_type = 'safari_db'",
    "s11_broken_files": "SELECT CAST(NULL AS BIGINT) AS visit_id, count(*) AS n FROM documents WHERE text <> ''",
    "s12_safari_json": "SELECT url, title, visit_time FROM visits WHERE source_type = 'safari_json' AND url <> ''",
    "s13_chrome_json": "SELECT visit_id, url, title, visit_time FROM visits WHERE source_type = 'chrome_json' AND url <> ''",
    "s14_unified": "SELECT source_type, url, visit_time FROM visits WHERE source_type = 'safari_db' OR (source_type IN ('safari_json', 'chrome_json') AND url <> '')",
    "s15_activity_items": "SELECT doc_id, coalesce(nullif(text, ''), nullif(url, '')) AS text FROM documents",
    "s17_recently_viewed": f"SELECT url, title AS name, CAST(12 AS BIGINT) AS watch_time, cls AS news_classification FROM (SELECT *, {domain_sql('url')} AS d FROM visits) JOIN {CLS} ON d = cd WHERE cls IN ('mainstream', 'alternative')",
    "s18_liked_pages": """SELECT name, arg_min(p, (length(p), p)) AS pattern FROM (SELECT DISTINCT concat_ws(' ', account_name, domain) AS name FROM visits)
        LEFT JOIN (SELECT DISTINCT regexp_replace(domain, '\\.example$', '') AS p FROM domain_classes) ON regexp_matches(lower(name), p) GROUP BY 1""",
    "s19_reactions": "SELECT visit_id AS timestamp, upper(domain) AS actor FROM visits",
    "s20_numbered_files": "SELECT directory, CAST(k AS INT) AS file_no FROM (SELECT *, row_number() OVER (PARTITION BY directory ORDER BY k) AS n FROM (SELECT DISTINCT account_name AS directory, visit_id * 7 % 40 + 1 AS k FROM visits)) WHERE n = k",
    "s21_html_activities": """SELECT 'activity' AS kind, CAST(visit_id AS VARCHAR) AS time, CAST(NULL AS VARCHAR) AS value FROM visits UNION ALL SELECT 'photo', CAST(visit_id AS VARCHAR), visit_id || '.jpg' FROM visits
        UNION ALL SELECT 'post', CAST(visit_id AS VARCHAR), 'opslag om ' || url FROM visits""",
    "s22_viewed_links": "SELECT DISTINCT 'maj 06, 2025 1:15:11 pm' AS day, url FROM visits",
    "s23_html_urls": "SELECT DISTINCT url FROM visits",
    "s24_csv_batches": "SELECT row_id, nullif(replace(content, chr(13), ' '), '') AS content, status_code, (row_number() OVER (ORDER BY row_id) - 1) // 500 AS batch_no FROM scraped_cache",
    "s1_catalog": "SELECT coalesce(account_name, '__HIVE_DEFAULT_PARTITION__') AS account_name, '.json' AS extension, CAST(1 AS BIGINT) AS n FROM visits GROUP BY 1",
    "s7_account_names": "SELECT DISTINCT account_name, replace(account_name, '_', '') AS account, 'facebook-' || replace(account_name, '_', '') || '-2024' AS source FROM visits",
    "s32_filename_facts": """SELECT DISTINCT source_file, '2025-01-02T03' AS stamp, nullif(regexp_extract('2025-01-02T03_' || replace(source_file, '/', '-') || '.json', '_([^_.]+)\\.[^.]+$', 1), '') AS user,
        CASE WHEN contains(source_file, 'safari') THEN 'safari' WHEN contains(source_file, 'chrome') THEN 'chrome' ELSE 'unknown' END AS source_type, 'json' AS file_type FROM visits""",
    "filter_p24_unprocessed_files": f"""SELECT full_path, CASE WHEN ext IN ('.db', '.sqlite', '.sqlite3') THEN CASE WHEN regexp_matches(low, 'history|historik') THEN 'database with history in its name that failed' ELSE 'database without history in its name' END
        WHEN ext = '.json' THEN CASE WHEN regexp_matches(low, 'history|historik|browser') THEN 'JSON with a browser word that failed' ELSE 'JSON without a browser word' END ELSE 'unsupported type ' || ext END AS reason_not_processed,
        regexp_matches(low, 'history|historik|safari|chrome') AS potentially_relevant, round(size_bytes / 1048576, 2) AS size_mb FROM {MIXED}
        WHERE size_bytes % 2000 <> 0 AND (ext IN ('.db', '.sqlite', '.sqlite3', '.json', '.plist') OR regexp_matches(low, 'history|historik|safari|chrome|firefox|browser'))""",
    "filter_p11_file_predicates": f"SELECT full_path, regexp_matches(low, 'history|historik|safari|chrome|firefox|edge|browser|webkit|bookmarks|cookies|cache') AS browser, regexp_matches(low, 'posts_and_comments\\.json|posts\\.json|comments\\.json') AS posts FROM {MIXED}",
    "s3_history_files": f"SELECT full_path FROM {MIXED} WHERE ext IN ('.db', '.json') AND size_bytes > 0",
    "s2_export_files": f"SELECT full_path FROM {MIXED} WHERE ext IN ('.json', '.html', '.htm')",
    "s4_social_folders": f"""SELECT directory, bool_or(regexp_matches(low, 'posts_and_comments\\.json|posts\\.json|comments\\.json')) OR count(*) FILTER (ext = '.html') >= 20 AS valid FROM {MIXED} WHERE directory IS NOT NULL GROUP BY 1""",
    "s27_url_list": "SELECT trim(original_url) AS url FROM url_cache WHERE trim(original_url) <> ''",
    "w1_flat_csv": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type || '; ' || props AS list, '{\"user_id\":' || user_id || '}' AS inner FROM events",
    "w2_parts": "SELECT count(*) AS n_rows, true AS all_small FROM orders",
    "w3_both": "SELECT c_custkey, c_name, c_acctbal, unnest(['parquet', 'csv']) AS sink FROM customer",
    "w4_sheets": "SELECT 'accounts' AS sheet, account_name AS label, count(*) AS n FROM visits GROUP BY 2 UNION ALL SELECT 'types', source_type, count(*) FROM visits GROUP BY 2",
    "w6_batches": "SELECT (k - 1) // 1000 AS batch, count(*) AS n, min(o_orderkey) AS first FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS k FROM orders) GROUP BY 1",
    "w7_append_new": "SELECT DISTINCT original_url AS url, 0 AS batch FROM url_cache UNION ALL SELECT DISTINCT url, 1 FROM sample_old_facebook WHERE url IS NOT NULL AND url NOT IN (SELECT original_url FROM url_cache WHERE original_url IS NOT NULL)",
    "w12_by_domain": "SELECT domain, visit_id, url FROM visits WHERE domain <> ''",
    "x10_pages": """SELECT row_id, nullif(trim(author), '') AS author, 'da' AS language, CAST(len(list_filter(string_split(coalesce(content, ''), chr(10)), lambda x: regexp_matches(x, '[^\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]'))) AS INT) AS n_lines,
        contains(coalesce(content, ''), 'Bund') AS footer FROM scraped_cache""",
    "x14_keys": "SELECT event_id, '$.a[0].b.k' AS path, regexp_extract(props, '\\d+') AS value FROM events UNION ALL SELECT event_id, '$.k', 'x' FROM events",
    "k6_meta_refresh": "SELECT original_url, nullif(trim(resolved_url), '') AS target FROM url_cache",
    "k7_shims": "SELECT DISTINCT url, url AS target FROM visits",
    "k8_external_links": "SELECT doc_id, CASE WHEN doc_id % 4 <> 2 THEN nullif(url, '') END AS link FROM documents",
    "k9_permalinks": "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'https://t.me/' || actor_username || '/' || doc_id WHEN 1 THEN 'https://vk.com/wall' || actor_username || '_' || doc_id WHEN 2 THEN 'https://www.youtube.com/watch?v=' || doc_id END AS link FROM documents",
    "t4_social_times": "SELECT event_id, date_trunc('second', ts) AS at FROM events",
    "t9_localised_dates": "SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('day', ts) ELSE date_trunc('year', ts) END AS at FROM events",
    "x15_compact": "SELECT DISTINCT domain, replace(replace(domain, '.', ''), '-', '') AS compact, round(length(domain) * 100000 / 1048576, 2) AS mb FROM visits",
    "x17_rates": "SELECT redirect_count, round(100 * count(*) FILTER (success) / count(*), 6) AS percent, CAST(floor(count(*) * 15 / 100) AS BIGINT) AS fifteen, CAST(ceil(count(*) / 7) AS BIGINT) AS share FROM url_cache GROUP BY 1",
    "x18_beginnings": "SELECT doc_id, substr(text, 1, 80) AS beginning FROM documents",
    "filter_p18_language_code": """WITH k AS (SELECT actor_username, lower(split_part(lang, '-', 1)) AS code, count(*) AS n FROM documents WHERE actor_username IS NOT NULL AND lang IS NOT NULL GROUP BY 1, 2),
        a AS (SELECT actor_username, arg_min(code, (-n, code)) AS actor_code FROM k GROUP BY 1)
        SELECT doc_id, coalesce(actor_code, lower(split_part(lang, '-', 1))) AS code FROM documents LEFT JOIN a USING (actor_username) WHERE coalesce(actor_code, lower(split_part(lang, '-', 1))) IN ('da', 'sv', 'de')""",
    "o6_by_time": "SELECT event_id, ts FROM events ORDER BY ts NULLS LAST, event_id",
    "o10_first_items": f"SELECT url FROM {SIDES.format(a='original_url', t='url_cache')} WHERE side = 'only_b' ORDER BY url LIMIT 20",
    "c2_second_dictionary": f"SELECT CASE WHEN d IS NULL THEN 'invalid_url' WHEN d IN (SELECT lower(domain) FROM domain_classes WHERE classification = 'alternative') THEN 'alternative' ELSE 'other' END AS cls, count(*) AS n FROM (SELECT {domain_sql('url')} AS d FROM visits) GROUP BY 1",
    "n5_row_index": "SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS row_index FROM sample_old_facebook",
    "n8_slice_sample": """WITH v AS (SELECT DISTINCT account_name, visit_id FROM visits WHERE account_name IS NOT NULL),
        c AS (SELECT account_name, CAST('0x' || substr(md5('42-' || account_name), 1, 8) AS BIGINT) % (greatest(count(*) - 40, 0) + 1) AS start FROM v GROUP BY 1),
        p AS (SELECT *, row_number() OVER (PARTITION BY account_name ORDER BY visit_id) - 1 AS pos FROM v),
        i AS (SELECT account_name, visit_id, pos FROM p JOIN c USING (account_name) WHERE pos >= start AND pos < start + 40)
        SELECT account_name, visit_id, pos FROM i QUALIFY row_number() OVER (PARTITION BY account_name ORDER BY md5('42-' || visit_id)) <= 5""",
    "u5_examples": f"SELECT side, count(*) OVER (PARTITION BY side) AS n, CAST(row_number() OVER (PARTITION BY side ORDER BY url) AS INT) AS rank, url FROM {SIDES.format(a='url', t='visits')} QUALIFY rank <= 20",
    "n10_better_pages": """SELECT domain, arg_min(word_count, row_id) AS old_words, arg_max(word_count, row_id) AS new_words FROM sample_old_facebook WHERE word_count IS NOT NULL AND domain IS NOT NULL GROUP BY 1
        HAVING arg_max(word_count, row_id) > greatest(1.2 * arg_min(word_count, row_id), arg_min(word_count, row_id) + 100)""",
    "j12_new_by_any": f"""WITH seen AS (SELECT DISTINCT {DEDUP('url')} AS k FROM visits)
        SELECT row_id FROM scraped_cache WHERE {DEDUP('original_url')} NOT IN (SELECT k FROM seen) AND {DEDUP('resolved_url')} NOT IN (SELECT k FROM seen)""",
}
