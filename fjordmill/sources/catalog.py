"""Files of donation folders as a table, and what their names and places say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Parts of names that mark browser and social-network files.
BROWSER_PARTS = ["history", "historik", "safari", "chrome", "firefox", "edge", "browser", "webkit", "bookmarks", "cookies", "cache"]
SOCIAL_PARTS = ["your_facebook_activity", "logged_information"]
POST_FILES = ["posts_and_comments.json", "posts.json", "comments.json"]
DATABASE_EXTENSIONS = [".db", ".sqlite", ".sqlite3"]


def file_catalog(spark: SparkSession, base: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """full_path, filename, directory, extension, size_bytes of the files below base; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(base)
    path = F.regexp_replace(F.coalesce(F.try_url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), F.col("path")), "^file:/+", "/")
    named = files.select(path.alias("full_path"), F.col("length").alias("size_bytes"))
    name = F.substring_index("full_path", "/", -1)
    return named.select(
        "full_path", name.alias("filename"), F.regexp_replace("full_path", "/[^/]*$", "").alias("directory"), F.lower(F.regexp_extract(name, r".(\.[^.]+)$", 1)).alias("extension"), "size_bytes"
    )


def any_part(c: Column | str, parts: list[str]) -> Column:
    """Whether a lower-cased text holds any of the parts."""
    return F.lower(F.col(c) if isinstance(c, str) else c).rlike("|".join(p.replace(".", r"\.") for p in parts))


def history_files(catalog: DataFrame) -> DataFrame:
    """The databases and JSON files with content; hidden twins and write-ahead files are left out."""
    kept = ~F.col("filename").startswith("._") & (F.col("size_bytes") > 0) & F.col("extension").isin(".db", ".json")
    return catalog.filter(kept & ~F.col("filename").rlike(r"-(?:shm|wal)$"))


def export_files(catalog: DataFrame) -> DataFrame:
    """JSON and HTML files that aren't below a hidden folder."""
    return catalog.filter(F.col("extension").isin(".json", ".html", ".htm") & ~F.col("directory").rlike(r"/\."))


def social_folders(catalog: DataFrame, keywords: list[str], least_html: int = 50) -> DataFrame:
    """directory, valid: whether a folder holds an export: a post file, or many HTML files of which an early one has a keyword."""
    early = W.partitionBy("directory").orderBy("full_path")
    html = catalog.filter(F.col("extension").isin(".html", ".htm")).withColumn("_n", F.row_number().over(early))
    by_html = html.groupBy("directory").agg((F.count("*") >= least_html).alias("_many"), F.bool_or((F.col("_n") <= 50) & any_part("full_path", keywords)).alias("_named"))
    by_json = catalog.groupBy("directory").agg(F.bool_or(any_part("filename", POST_FILES)).alias("_posts"))
    valid = ~F.col("directory").contains("your_facebook_activity") & (F.col("_posts") | F.coalesce(F.col("_many") & F.col("_named"), F.lit(False)))
    return by_json.join(by_html, "directory", "left").select("directory", valid.alias("valid"))


def account_name(path: Column | str) -> Column:
    """The account in a folder's path by three patterns, longer than two characters and no number; else the folder's name."""
    p = F.col(path) if isinstance(path, str) else path
    found = [F.regexp_extract(p, r, 1) for r in (r"facebook-([^-]+)-\d", r"facebook([^/]+)\d", r"facebook_(.+?)_\d")]
    good = [F.when((F.length(x) > 2) & ~x.rlike(r"^\d+$"), x) for x in found]
    folder = F.substring_index(p, "/", -1)
    return F.coalesce(*good, F.when(~folder.rlike(r"^\d*$"), folder))


def source_folder(path: Column | str) -> Column:
    """The nearest folder above a file whose name speaks of an export; else the folder it lies in."""
    parts = F.split(F.col(path) if isinstance(path, str) else path, "/")
    above = F.reverse(F.slice(parts, F.lit(1), F.size(parts) - 1))
    named = F.filter(above, lambda x: F.lower(x).rlike(r"facebook|^\d{8,}$|^[a-z]+_\d{6,}$"))
    return F.coalesce(F.get(named, F.lit(0)), F.get(above, F.lit(0)))


def filename_facts(name: Column | str) -> Column:
    """What a donation file's name says: its day, user, source and kind."""
    n = F.col(name) if isinstance(name, str) else name
    low = F.lower(n)
    part = lambda r: F.nullif(F.regexp_extract(n, r, 1), F.lit(""))
    source = F.when(low.contains("safari"), "safari").when(low.contains("chrome"), "chrome").when(low.contains("firefox"), "firefox").when(low.contains("facebook"), "facebook").otherwise("unknown")
    return F.struct(part(r"(\d{4}-\d\d-\d\dT\d\d)").alias("stamp"), part(r"_([^_.]+)\.[^.]+$").alias("user"), source.alias("source_type"), part(r"\.([^.]+)$").alias("file_type"))


# Why a browser-like file may be left over: (extensions or None for all others, name has one of these words, reason); the first that fits counts.
LEFT_OVER = [
    (DATABASE_EXTENSIONS, ["history", "historik"], "database with history in its name that failed"),
    (DATABASE_EXTENSIONS, [], "database without history in its name"),
    ([".json"], ["history", "historik", "browser"], "JSON with a browser word that failed"),
    ([".json"], [], "JSON without a browser word"),
    (None, [], "unsupported type "),
]
RELEVANT_WORDS = ["history", "historik", "safari", "chrome"]
CANDIDATE_WORDS = [*RELEVANT_WORDS, "firefox", "browser"]
CANDIDATE_EXTENSIONS = [*DATABASE_EXTENSIONS, ".json", ".plist"]


def unprocessed(catalog: DataFrame, processed: DataFrame) -> DataFrame:
    """Browser-like files that weren't processed, with the reason and whether their names look relevant."""
    ext = F.col("extension")
    fits = [(F.lit(True) if kinds is None else ext.isin(kinds)) & (any_part("filename", words) if words else F.lit(True)) for kinds, words, _ in LEFT_OVER]
    texts = [F.concat(F.lit(text), ext) if kinds is None else F.lit(text) for kinds, _, text in LEFT_OVER]
    reason = F.coalesce(*(F.when(f, t) for f, t in zip(fits, texts)))
    candidates = catalog.filter(ext.isin(CANDIDATE_EXTENSIONS) | any_part("filename", CANDIDATE_WORDS))
    left = candidates.join(processed.select(F.col("full_path").alias("_done")).distinct(), F.col("full_path") == F.col("_done"), "left_anti")
    return left.select("*", reason.alias("reason_not_processed"), any_part("filename", RELEVANT_WORDS).alias("potentially_relevant"), F.round(F.col("size_bytes") / 1048576, 2).alias("size_mb"))
