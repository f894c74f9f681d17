"""Event-time queries: batch twins with oracles, and the same windows run as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordmill.session import delete_on_exit, ensure_checkpoint_dir, table
from fjordmill.streaming import events as E


def _events(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumns({"started": F.col("started").cast("timestamp_ntz"), "total": F.round("total", 4)}) if "total" in df.columns else df.withColumn("started", F.col("started").cast("timestamp_ntz"))


def s_tumbling(s: SparkSession, d: str) -> DataFrame:
    return _plain(E.windowed_counts(_events(s, d), "1 day"))


def s_sliding(s: SparkSession, d: str) -> DataFrame:
    return _plain(E.windowed_counts(_events(s, d), "6 hours", "1 hour"))


def s_sessions(s: SparkSession, d: str) -> DataFrame:
    return _plain(E.session_counts(_events(s, d)))


def s_stream_tumbling(s: SparkSession, d: str) -> DataFrame:
    """The daily windows as a stream over the table's files; the last state is the result."""
    base = f"{ensure_checkpoint_dir(s)}/stream-{uuid.uuid4().hex}"
    delete_on_exit(s, base)
    schema = table(s, d, "events").schema
    stream = s.readStream.schema(schema).parquet(f"{d}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out = f"{base}/out"
    E.run_available(E.windowed_counts(stream), lambda df, i: df.write.mode("overwrite").parquet(out), f"{base}/state", "complete")
    return _plain(s.read.parquet(out))


def _stream(s: SparkSession, d: str, base: str, files: int = 3) -> DataFrame:
    """The events as a stream of several files, one a micro-batch."""
    table(s, d, "events").repartition(files, "event_id").write.parquet(f"{base}/in")
    return E.read_events(s, f"{base}/in", 1)


def _base(s: SparkSession) -> str:
    base = f"{ensure_checkpoint_dir(s)}/stream-{uuid.uuid4().hex}"
    delete_on_exit(s, base)
    return base


def s_stream_upsert(s: SparkSession, d: str) -> DataFrame:
    """The latest event of each user, kept up by micro-batches; the stream runs twice, from a new checkpoint the second time."""
    base = _base(s)
    events = _stream(s, d, base)
    for run in range(2):
        E.run_available(events, E.upsert_into(f"{base}/table", ["user_id"], [F.desc("ts"), F.asc("event_id")]), f"{base}/state{run}", "append")
    return E.latest_version(s, f"{base}/table").select("user_id", "event_id", "event_type")


def s_stream_unseen(s: SparkSession, d: str) -> DataFrame:
    """Users that no earlier micro-batch had."""
    base = _base(s)
    E.run_available(_stream(s, d, base), E.append_unseen(f"{base}/out", "user_id"), f"{base}/state", "append")
    return s.read.parquet(f"{base}/out").select("user_id")


def s_stream_first_seen(s: SparkSession, d: str) -> DataFrame:
    """Events delivered twice pass once."""
    base = _base(s)
    e = _stream(s, d, base, 2)
    twice = e.unionByName(e)
    E.run_available(E.first_seen(twice, ["event_id"], "60 days"), lambda df, i: df.write.mode("overwrite").parquet(f"{base}/out/batch={i}"), f"{base}/state", "append")
    return s.read.parquet(f"{base}/out").select("event_id")


def i10_checkpoint_batches(s: SparkSession, d: str) -> DataFrame:
    """The micro-batches of a finished run, from its checkpoint."""
    base = _base(s)
    E.run_available(_stream(s, d, base, 4), lambda df, i: df.write.mode("overwrite").parquet(f"{base}/out/batch={i}"), f"{base}/state", "append")
    return E.checkpoint_batches(s, f"{base}/state")


QUERIES = {f.__name__: f for f in [s_tumbling, s_sliding, s_sessions, s_stream_tumbling, s_stream_upsert, s_stream_unseen, s_stream_first_seen, i10_checkpoint_batches]}
DAILY = "SELECT date_trunc('day', ts) AS started, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"
ORACLE = {
    "s_tumbling": DAILY,
    "s_stream_tumbling": DAILY,
    "s_stream_upsert": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1",
    "s_stream_unseen": "SELECT DISTINCT user_id FROM events",
    "s_stream_first_seen": "SELECT event_id FROM events",
    "i10_checkpoint_batches": "SELECT unnest(range(4)) AS batch, true AS committed",
    "s_sliding": """SELECT date_trunc('hour', ts) - to_hours(CAST(k AS BIGINT)) AS started, event_type, count(*) AS n, round(sum(value), 4) AS total
        FROM events, (SELECT unnest(range(6)) AS k) GROUP BY 1, 2""",
    "s_sessions": """WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 30 MINUTES THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g) SELECT user_id, min(ts) AS started, count(*) AS n FROM n GROUP BY user_id, k""",
}
