"""Social-network exports in JSON: activity items, recently viewed links, liked pages and reactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordmill.functions import text, urls
from fjordmill.operators.classify import classify, first_match
from fjordmill.sources.browser_json import exploded

# Keys of an export that hold activity items, in the order in which they are looked for.
ITEM_KEYS = ["comments_v2", "group_posts_v2", "group_comments_v2", "posts", "recently_viewed", "pages", "groups", "events", "comments_and_reactions"]


def activity_items(files: DataFrame) -> DataFrame:
    """source_file, pos, item: the items of the first known key, of a list, or the document itself as the only one."""
    d = F.col("doc")
    keyed = F.coalesce(*(F.try_variant_get(d, f"$.{k}", "variant") for k in ITEM_KEYS))
    found = F.when(F.schema_of_variant(d).startswith("ARRAY"), d).otherwise(keyed)
    single = files.filter(d.isNotNull() & found.isNull()).select("source_file", F.lit(0).alias("pos"), F.col("doc").alias("item"))
    one = F.when(F.schema_of_variant(found).startswith("ARRAY"), found)
    scalar = files.filter(found.isNotNull() & one.isNull()).select("source_file", F.lit(0).alias("pos"), found.alias("item"))
    return exploded(files, one, ["source_file"]).unionByName(single).unionByName(scalar)


def item_text(item: str = "item") -> Column:
    """The text of an item: media description or title, else the last attachment text, else the first data post, comment or text, else its title."""
    v = F.col(item)
    get = lambda x, k: F.nullif(F.try_variant_get(x, f"$.{k}", "string"), F.lit(""))
    arrays = lambda k: F.coalesce(F.try_variant_get(v, f"$.{k}", "array<variant>"), F.array().cast("array<variant>"))
    first = lambda a: F.get(F.filter(a, lambda t: t.isNotNull()), F.lit(0))
    data = first(F.transform(arrays("data"), lambda x: F.coalesce(get(x, "post"), get(x, "comment.comment"), get(x, "comment"), get(x, "text"))))
    inner = F.transform(arrays("attachments"), lambda x: F.coalesce(get(x, "data.text"), get(x, "data[0].text")))
    attached = F.get(F.reverse(F.filter(inner, lambda t: t.isNotNull())), F.lit(0))
    media = first(F.transform(arrays("media"), lambda x: F.coalesce(get(x, "description"), get(x, "title"))))
    return F.coalesce(media, attached, data, get(v, "title"))


def shared_urls(files: DataFrame) -> DataFrame:
    """source_file, pos, url, domain, content, timestamp: the URLs in the items, without social and search ones, first seen first kept."""
    items = activity_items(files)
    raw = items.select("source_file", "pos", item_text().alias("content"), F.try_variant_get("item", "$.timestamp", "string").alias("timestamp"), F.to_json("item").alias("_json"))
    found = F.array_distinct(F.concat(F.coalesce(urls.urls_in_text("content"), F.array().cast("array<string>")), F.transform(urls.urls_in_text("_json"), lambda u: F.replace(u, F.lit("\\/"), F.lit("/")))))
    each = raw.select("source_file", "pos", "content", "timestamp", F.explode(found).alias("url")).filter(~urls.is_social_or_search("url"))
    best = each.groupBy("url").agg(F.min(F.struct("source_file", "pos", "content", "timestamp")).alias("m"))
    return best.select("m.source_file", "m.pos", "url", urls.domain_or_empty("url").alias("domain"), "m.content", "m.timestamp")


def recently_viewed(files: DataFrame, classes: DataFrame) -> DataFrame:
    """source_file, url, name, timestamp, watch_time, news_classification: viewed links of classified domains; a watch time that is no number is 0."""
    top = exploded(files, F.try_variant_get("doc", "$.recently_viewed", "variant"), ["source_file"]).withColumnRenamed("pos", "p1")
    mid = exploded(top, F.coalesce(F.try_variant_get("item", "$.children", "variant"), F.parse_json(F.lit("[]"))), ["source_file", "p1"]).withColumnRenamed("pos", "p2")
    low = exploded(mid, F.try_variant_get("item", "$.entries", "variant"), ["source_file", "p1", "p2"])
    get = lambda k: F.try_variant_get("item", f"$.{k}", "string")
    watch = get("data.watch_time")
    rows = low.select(
        "source_file", get("data.uri").alias("url"), get("data.name").alias("name"), get("timestamp").alias("timestamp"), F.when(watch.rlike(r"^\d+$"), watch.cast("long")).otherwise(0).alias("watch_time")
    ).withColumn("domain", urls.domain("url"))
    return classify(rows, classes, "domain").filter(F.col("news_classification").isin("mainstream", "alternative"))


def liked_pages(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """source_file, name, timestamp, pattern: liked pages and the first pattern that their names match, if any."""
    rows = exploded(files, F.try_variant_get("doc", "$.page_likes_v2", "variant"), ["source_file"])
    likes = rows.select("source_file", F.try_variant_get("item", "$.name", "string").alias("name"), F.try_variant_get("item", "$.timestamp", "long").alias("timestamp"))
    return likes.join(first_match(likes, patterns, F.lower("name"), ["name"]), "name", "left").select("source_file", "name", "timestamp", "pattern")


def reactions(files: DataFrame) -> DataFrame:
    """source_file, timestamp, actor: whom the titles of a list of reactions name."""
    rows = activity_items(files)
    return rows.select("source_file", F.try_variant_get("item", "$.timestamp", "long").alias("timestamp"), text.actor_from_title(F.try_variant_get("item", "$.title", "string")).alias("actor"))


def numbered_until_gap(catalog: DataFrame, stem: str) -> DataFrame:
    """The files stem1.json, stem2.json, ... of each folder up to the first number that is missing."""
    from pyspark.sql import Window as W

    no = F.regexp_extract("filename", rf"^{stem}(\d+)\.json$", 1).try_cast("int")
    numbered = catalog.withColumn("file_no", no).filter("file_no IS NOT NULL")
    return numbered.withColumn("_n", F.row_number().over(W.partitionBy("directory").orderBy("file_no"))).filter("_n = file_no").drop("_n")


def external_link(post: str = "post") -> Column:
    """The outside address of a post variant: link, web page, first entity, url, link attachment, else the first URL in its text."""
    get = lambda path: F.nullif(F.try_variant_get(F.col(post), path, "string"), F.lit(""))
    own = get("$.url")
    entity = F.coalesce(*(get(f"$.entities.urls[0].{k}") for k in ("expanded_url", "unwound_url", "url")))
    attached = F.coalesce(get("$.attachments[0].link.url"), get("$.attachments[0].url"))
    return F.coalesce(get("$.link"), get("$.media.webpage.url"), entity, F.when(~own.contains("reddit.com"), own), attached, urls.first_url(get("$.text")))
