"""SQLite browser histories: one fixed schema whatever columns a file has.

``read_histories`` lists and reads files of any file system by Spark's binary source and opens them in memory, so a file may
have up to 2 GB. A file that can't be read to its end gives one row with an error and none of its visits. The data source
``sqlite_history`` reads local files of any size, one partition per file.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

VISITS = "source_file string, visit_id long, url string, title string, visit_time double, visit_count long, domain_expansion string, load_successful int, http_non_get int, synthesized int, referring_visit_id long, tags string, tag_count long"
TABLES = "source_file string, table_name string, row_count long, columns string"


class FilePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _columns(con: sqlite3.Connection, table: str) -> list[str]:
    return [r[1] for r in con.execute(f'PRAGMA table_info("{table}")')]


def _visits(con: sqlite3.Connection) -> Iterator[tuple]:
    tables = {r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}
    if not {"history_items", "history_visits"} <= tables:
        return
    items, visits = _columns(con, "history_items"), _columns(con, "history_visits")
    has = lambda cols, name, alias: f"{alias}.{name}" if name in cols else "NULL"
    referrer = next((f"v.{c}" for c in ("from_visit", "referring_visit", "source") if c in visits), "NULL")
    title = f"COALESCE({has(visits, 'title', 'v')}, {has(items, 'title', 'i')})"
    tags = "NULL, 0"
    if {"history_tags", "history_items_to_tags"} <= tables:
        tags = "(SELECT GROUP_CONCAT(t, ', ') FROM (SELECT DISTINCT t.title AS t FROM history_items_to_tags m JOIN history_tags t ON t.id = m.tag_id WHERE m.history_item = i.id ORDER BY 1)), (SELECT COUNT(*) FROM history_items_to_tags m WHERE m.history_item = i.id)"
        if "history_item" not in _columns(con, "history_items_to_tags"):
            tags = "NULL, 0"
    yield from con.execute(
        f"SELECT v.id, i.url, {title}, v.visit_time, {has(items, 'visit_count', 'i')}, {has(items, 'domain_expansion', 'i')}, {has(visits, 'load_successful', 'v')}, {has(visits, 'http_non_get', 'v')}, "
        f"{has(visits, 'synthesized', 'v')}, {referrer}, {tags} FROM history_items i JOIN history_visits v ON i.id = v.history_item"
    )


def _profile(con: sqlite3.Connection) -> Iterator[tuple]:
    for (name,) in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name").fetchall():
        n = con.execute(f'SELECT COUNT(*) FROM "{name}"').fetchone()[0]
        yield name, n, ",".join(_columns(con, name))


class HistoryReader(DataSourceReader):
    def __init__(self, options: dict, kind: str):
        self.options, self.kind = options, kind

    def partitions(self) -> list[FilePartition]:
        base = Path(self.options["path"])
        files = [base] if base.is_file() else sorted(p for p in base.rglob(self.options.get("glob", "*.db")) if not p.name.startswith("._"))
        return [FilePartition(str(p)) for p in files if p.stat().st_size]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        try:
            con = sqlite3.connect(f"file:{partition.path}?mode=ro&immutable=1", uri=True)
            try:
                rows = list(_profile(con) if self.kind == "tables" else _visits(con))  # all of a file or nothing
            finally:
                con.close()
            yield from ((partition.path, *row) for row in rows)
        except sqlite3.DatabaseError:
            if self.options.get("mode", "PERMISSIVE").upper() == "FAILFAST":
                raise


class HistorySource(DataSource):
    """Options: path (a file or folder), glob, kind (visits or tables), mode (PERMISSIVE skips what isn't SQLite, FAILFAST raises)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_history"

    def schema(self) -> str:
        return TABLES if self.options.get("kind") == "tables" else VISITS

    def reader(self, schema) -> HistoryReader:
        return HistoryReader(self.options, self.options.get("kind", "visits"))


def register(spark: SparkSession) -> None:
    from fjordmill.session import ship_package

    ship_package(spark)
    spark.dataSource.register(HistorySource)


def parse_histories(files: DataFrame, kind: str = "visits") -> DataFrame:
    """The visits (or tables) of SQLite contents and ``error``; files has path and content. Empty contents give no row."""
    schema = TABLES if kind == "tables" else VISITS
    fields = [f.split() for f in schema.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not content:
                    continue
                con = sqlite3.connect(":memory:")
                try:
                    con.deserialize(content)
                    rows = [(path, *row, None) for row in (_profile(con) if kind == "tables" else _visits(con))]
                except sqlite3.Error as e:
                    rows = [(path, *[None] * (len(fields) - 1), str(e))]
                finally:
                    con.close()
                columns = list(zip(*rows)) or [()] * (len(fields) + 1)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)), pa.array(columns[-1], pa.string())], [*(n for n, _ in fields), "error"])

    return files.select("path", "content").mapInArrow(run, f"{schema}, error string")


def read_histories(spark: SparkSession, base: str, glob: str = "*.db", kind: str = "visits") -> DataFrame:
    """parse_histories of the files below base, hidden twins left out."""
    from fjordmill.session import ship_package

    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(base)
    return parse_histories(files.filter(~F.substring_index("path", "/", -1).startswith("._")).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "content"), kind)
