"""Browser histories exported as JSON in several shapes, read as variants."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TIME_KEYS = ["visitTime", "time", "visit_time", "timestamp", "lastVisitTime", "last_visit_time", "time_usec"]
REFERRER_KEYS = ["referringVisitId", "referring_visit_id", "referrer", "from_visit"]


def json_files(spark: SparkSession, base: str, glob: str = "*.json") -> DataFrame:
    """source_file, doc: each file as one variant; a file that isn't JSON has a null doc."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(base)
    return files.select(F.col("_metadata.file_path").alias("source_file"), F.try_parse_json("value").alias("doc"))


def first_of(v: str, keys: list[str], kind: str) -> Column:
    """The first of the keys that an object has, as ``kind``."""
    return F.coalesce(*(F.try_variant_get(F.col(v), f"$.{k}", kind) for k in keys))


def exploded(df: DataFrame, array: Column, keep: list[str]) -> DataFrame:
    """keep, pos, item for each element of a variant array; no rows where it is none."""
    staged = df.select(*keep, array.alias("_items")).filter("_items IS NOT NULL")
    return df.sparkSession.sql(f"SELECT {', '.join(keep)}, e.pos, e.value AS item FROM {{staged}} s, LATERAL variant_explode(s._items) e", staged=staged)


def safari_visits(files: DataFrame) -> DataFrame:
    """source_file, visit_id, url, title, visit_time (µs), visit_count, destination_url of Safari exports; blank URLs are left out."""
    safari = (F.try_variant_get("doc", "$.metadata.browser_name", "string") == "Safari") & (F.try_variant_get("doc", "$.metadata.data_type", "string") == "history")
    rows = exploded(files.filter(safari), F.try_variant_get("doc", "$.history", "variant"), ["source_file"])
    get = lambda k, t: F.try_variant_get("item", f"$.{k}", t)
    return rows.select(
        "source_file", F.col("pos").cast("long").alias("visit_id"), get("url", "string").alias("url"), get("title", "string").alias("title"), get("time_usec", "double").alias("visit_time"),
        get("visit_count", "long").alias("visit_count"), get("destination_url", "string").alias("destination_url"), get("destination_time_usec", "double").alias("destination_time"),
    ).filter("url IS NOT NULL AND url <> ''")


def record_array(doc: str = "doc") -> Column:
    """The records of a browser export: the document if it is a list, else its 'Browser History', 'history' or first list of objects with a url, else the object itself as the only one."""
    d = F.col(doc)
    is_list = F.schema_of_variant(d).startswith("ARRAY")
    keyed = [F.try_variant_get(d, f"$['{k}']", "variant") for k in ("Browser History", "history")]
    lists = F.map_values(F.try_variant_get(d, "$", "map<string,variant>"))
    other = F.get(F.filter(lists, lambda v: F.try_variant_get(v, "$[0].url", "string").isNotNull()), F.lit(0))
    return F.when(is_list, d).otherwise(F.coalesce(*keyed, other))


def chrome_visits(files: DataFrame) -> DataFrame:
    """source_file, visit_id, url, title, visit_time (text), referring_visit_id of Chrome and takeout exports; the Safari shape and studio files are left out."""
    kept = ~F.lower("source_file").contains("creator_studio_history") & F.try_variant_get("doc", "$.metadata.browser_name", "string").isNull()
    rows = exploded(files.filter(kept), record_array(), ["source_file"])
    get = lambda k, t: F.try_variant_get("item", f"$.{k}", t)
    return rows.select(
        "source_file", F.coalesce(get("id", "long"), F.col("pos").cast("long")).alias("visit_id"), get("url", "string").alias("url"), get("title", "string").alias("title"),
        first_of("item", TIME_KEYS, "string").alias("visit_time"), first_of("item", REFERRER_KEYS, "string").alias("referring_visit_id"),
    ).filter("url IS NOT NULL AND url <> ''")


def keys_at_any_path(df: DataFrame, id_col: str, json_col: str, keys: list[str]) -> DataFrame:
    """id, path, value: every value of one of the keys, at any place and depth in a JSON text; texts that aren't JSON have none."""
    wanted = set(keys)

    def walk(node) -> Iterator[tuple[str, str]]:
        todo = [(node, "$")]
        while todo:
            node, path = todo.pop()
            if isinstance(node, dict):
                below = [(v, f"{path}.{k}") for k, v in node.items()]
                yield from ((here, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)) for (v, here), k in zip(below, node) if k in wanted)
            elif isinstance(node, list):
                below = [(v, f"{path}[{n}]") for n, v in enumerate(node)]
            else:
                continue
            todo += reversed(below)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    rows += [(key, *x) for x in walk(json.loads(text or "null"))]
                except ValueError:
                    pass
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (b.column(0).type, pa.string(), pa.string()))], ["id", "path", "value"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(json_col).cast("string")).mapInArrow(run, f"id {kind}, path string, value string")


def unified_visits(spark: SparkSession, base: str) -> DataFrame:
    """Visits of the SQLite, Safari JSON and Chrome JSON files below base in one schema, with their source type and account (the folder's name)."""
    from fjordmill.sources import sqlite

    files = json_files(spark, base)
    db = sqlite.read_histories(spark, base).filter("error IS NULL")
    cols = ["source_file", "visit_id", "url", "title"]
    parts = [
        db.select(*cols, F.col("visit_time").cast("string").alias("visit_time"), F.lit("safari_db").alias("source_type")),
        safari_visits(files).select(*cols, F.col("visit_time").cast("decimal(38,0)").cast("string").alias("visit_time"), F.lit("safari_json").alias("source_type")),
        chrome_visits(files).select(*cols, "visit_time", F.lit("chrome_json").alias("source_type")),
    ]
    account = F.element_at(F.split("source_file", "/"), -2)  # the folder that a file lies in
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("account_name", account)
