"""Structured Streaming over event tables: windows, sessions, first-seen filters, keyed upserts and resumable batches."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fjordmill.operators.relational import not_seen, upsert


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 8, glob: str = "*.parquet") -> DataFrame:
    """A stream of a folder's parquet files; wall times become instants, which watermarks need."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"})


def windowed_counts(events: DataFrame, window: str = "1 day", slide: str | None = None, late: str = "1 hour", time: str = "ts", kind: str = "event_type", value: str = "value") -> DataFrame:
    """started, kind, n, total: tumbling or sliding windows; rows later than the watermark are dropped on streams."""
    w = F.window(time, window, slide) if slide else F.window(time, window)
    timed = events.withWatermark(time, late) if events.isStreaming else events
    g = timed.groupBy(w.alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return g.select(F.col("w.start").alias("started"), kind, "n", "total")


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour", time: str = "ts", key: str = "user_id") -> DataFrame:
    """key, started, n: browsing sessions that end after a gap."""
    timed = events.withWatermark(time, late) if events.isStreaming else events
    g = timed.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return g.select(key, F.col("w.start").alias("started"), "n")


def first_seen(events: DataFrame, keys: list[str], late: str = "1 day", time: str = "ts") -> DataFrame:
    """The first row of each key; on streams within the watermark, so state is bounded."""
    if not events.isStreaming:
        return events.dropDuplicates(keys)
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def run_available(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Processes what is there in micro-batches and stops; a later run with the same checkpoint goes on behind it."""
    q = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


BUCKETS = 64


def _bucket(keys: list[str]):
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """The newest version of a table and, for each of its buckets, the version that wrote it; (0, {}) if there is none."""
    fs, root = _fs(spark, f"{path}/manifests")
    found = [int(f.getPath().getName()) for f in fs.listStatus(root) if f.getPath().getName().isdigit()] if fs.exists(root) else []
    if not found:
        return 0, {}
    line = spark.read.text(f"{path}/manifests/{max(found)}").first()[0]
    return max(found), {int(k): v for k, v in json.loads(line).items()}


def upsert_into(path: str, keys: list[str], order: list) -> Callable[[DataFrame, int], None]:
    """A batch writer that keeps the first row per key by ``order`` in a table of ``BUCKETS`` buckets by key below path.

    A batch merges and writes only the buckets that its keys fall in, then a manifest of the table's new version, which counts up in the
    table itself, whatever checkpoint the batches come from. Readers see whole versions; a batch that is repeated gives the same
    table. Older buckets stay until ``forget_versions``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version, buckets = _manifest(spark, path)
        placed = batch.withColumn("bucket", _bucket(keys)).persist()  # the batch is read twice
        touched = [r[0] for r in placed.select("bucket").distinct().collect()]  # at most BUCKETS
        if not touched:
            placed.unpersist()
            return
        old = [f"{path}/data/{buckets[k]}/bucket={k}" for k in touched if k in buckets]
        before = spark.read.parquet(*old).withColumn("bucket", _bucket(keys)) if old else placed.limit(0)
        new = version + 1
        upsert(before, placed, keys, order).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/{new}")
        placed.unpersist()
        line = json.dumps(buckets | {k: new for k in touched})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifests/{new}")

    return write


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version that upsert_into wrote."""
    _, buckets = _manifest(spark, path)
    return spark.read.parquet(*(f"{path}/data/{v}/bucket={k}" for k, v in buckets.items()))


def forget_versions(spark: SparkSession, path: str) -> None:
    """Delete the buckets and manifests that the newest version doesn't need."""
    version, buckets = _manifest(spark, path)
    fs, root = _fs(spark, f"{path}/data")
    for v in fs.listStatus(root):
        for b in fs.listStatus(v.getPath()):
            name = b.getPath().getName()
            if name.startswith("bucket=") and buckets.get(int(name[7:])) != int(v.getPath().getName()):
                fs.delete(b.getPath(), True)
    for m in fs.listStatus(_path(spark, f"{path}/manifests")):
        if m.getPath().getName() != str(version):
            fs.delete(m.getPath(), True)


def append_unseen(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that appends the rows whose key no earlier batch had, each batch in a folder of its own, by buckets of the
    key; only the buckets that a batch touches are read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, root = _fs(spark, path)
        fresh = distinct = batch.dropDuplicates([key]).withColumn("bucket", _bucket([key])).persist()
        if fs.exists(root) and any(f.getPath().getName().startswith("batch=") for f in fs.listStatus(root)):
            touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS
            earlier = spark.read.parquet(path).filter((F.col("batch") < batch_id) & F.col("bucket").isin(touched))
            fresh = not_seen(fresh, earlier, key)
        fresh.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={batch_id}")
        distinct.unpersist()

    return write


def progress(query: StreamingQuery) -> list[dict]:
    """Rows and seconds of each micro-batch that a query remembers."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"], "seconds": p["durationMs"].get("triggerExecution", 0) / 1000} for p in query.recentProgress]


def checkpoint_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """batch, committed: the micro-batches that a query's checkpoint knows, and whether they were finished."""
    number = F.col("_metadata.file_name").try_cast("long")
    read = lambda part: spark.read.option("pathGlobFilter", "[0-9]*").text(f"{checkpoint}/{part}").select(number.alias("batch")).distinct()
    return read("offsets").join(read("commits").withColumn("committed", F.lit(True)), "batch", "left").select("batch", F.coalesce("committed", F.lit(False)).alias("committed"))


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p
