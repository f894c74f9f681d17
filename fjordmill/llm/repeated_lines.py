"""Lines that a site repeats over its documents.

Copies are collapsed first: rows with the same domain and the same lines are one cluster with its number of rows, so every
line is counted once per cluster, over clusters, rows and publication days. Two rules decide:

- ``rows``: a line is repeated if it occurs in at least ``min_rows`` rows and in ``min_share`` of all rows of its domain.
- ``clusters``: the same over clusters instead of rows, and on at least ``MIN_DAYS`` publication days, so an article that is
  published again is no boilerplate however often it is.

Scale: texts are folded once, to one slim table of 64-bit line hashes in the shared folder, which everything else reads; counts are
combined on the map side; a domain keeps at most lines-per-row / min_share repeated lines, so they go back to the rows as one small row
per domain: broadcast after a check of their number, else joined on the domain, where adaptive execution splits hot domains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordmill.operators.moments import moment_micros
from fjordmill.session import broadcast_if_small, staged

MIN_ROWS, MIN_SHARE, MIN_DAYS = 8, 0.1, 2
BROADCAST_LINES = 1_000_000
DAY_MICROS = 86_400_000_000
# White space beside the line feed, as str.split() knows it.
BLANKS = "\\t\\u000b\\u000c\\r\\u001c-\\u001f\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def site(c: str) -> Column:
    """The domain, trimmed, lower-case, without one leading ``www.``; null if blank."""
    d = F.regexp_replace(F.lower(F.regexp_replace(F.col(c), rf"^[ \n{BLANKS}]+|[ \n{BLANKS}]+$", "")), r"^www\.", "")
    return F.when(d != "", d)


def folded_lines(c: str) -> Column:
    """The lines of a text, folded: lower-case, one blank for white space, one sign for digits, trimmed."""
    t = F.regexp_replace(F.lower(F.col(c)), rf"[{BLANKS}]+ *| {{2,}}[ {BLANKS}]*", " ")
    t = F.regexp_replace(F.regexp_replace(t, "[0-9]+", "0"), " {2,}", " ")
    return F.transform(F.split(t, "\n"), lambda x: F.trim(x))


def line_keys(df: DataFrame, id_col: str, domain: str, content: str, *extra: str) -> DataFrame:
    """id, site, keys: the hash of each line of the content, null for lines without text."""
    keys = F.transform(folded_lines(content), lambda x: F.when(x != "", F.xxhash64(x)))
    return df.select(F.col(id_col).alias("row_id"), site(domain).alias("site"), keys.alias("keys"), *extra)


def repeated(rows: DataFrame, min_rows: int = MIN_ROWS, min_share: float = MIN_SHARE, rule: str = "rows") -> DataFrame:
    """site, key, n_rows, n_clusters of the repeated lines. rows has site, keys and, for ``rule='clusters'``, day."""
    known = rows.filter("site IS NOT NULL")
    clusters = known.filter("keys IS NOT NULL").select("site", F.array_compact("keys").alias("keys")).withColumn("cluster", F.xxhash64("keys"))
    collapsed = clusters.groupBy("site", "cluster").agg(F.count("*").alias("n"), F.first("keys").alias("keys"))
    lines = collapsed.select("site", "n", F.explode(F.array_distinct("keys")).alias("key"))
    counted = lines.groupBy("site", "key").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_clusters"))
    if rule == "rows":
        totals = known.groupBy("site").agg(F.count("*").alias("total"))
        n = F.col("n_rows")
    else:
        totals = collapsed.groupBy("site").agg(F.count("*").alias("total"))
        n = F.col("n_clusters")
    found = counted.filter(n >= min_rows).join(totals, "site").filter(n >= F.col("total") * min_share).select("site", "key", "n_rows", "n_clusters")
    return found if rule == "rows" else found.join(publication_days(rows, found), ["site", "key"]).filter(F.col("n_days") >= MIN_DAYS).drop("n_days")


def publication_days(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """site, key, n_days: on how many distinct days the lines occur; rows has site, keys and day."""
    days = rows.select("site", "day", F.explode(F.array_distinct("keys")).alias("key")).join(lines.select("site", "key"), ["site", "key"], "left_semi")
    return days.groupBy("site", "key").agg(F.count_distinct("day").alias("n_days"))


def _per_site(rows: DataFrame, rule: str) -> DataFrame:
    return broadcast_if_small(repeated(rows, rule=rule).groupBy("site").agg(F.collect_set("key").alias("hot")), BROADCAST_LINES, F.size("hot"))


def _dated(df: DataFrame, id_col: str, domain: str, content: str, date: str, zone: str) -> DataFrame:
    """The line keys of df with day, the publication day as days since 1970 in UTC; dates without zone are in ``zone``, those that are no moment have none."""
    dated = moment_micros(df.select(id_col, domain, content, date, F.lit(zone).alias("_zone")), date, "_zone", "_micros")
    return staged(line_keys(dated, id_col, domain, content, F.floor(F.col("_micros") / DAY_MICROS).alias("day")))


def repeated_places(df: DataFrame, id_col: str = "row_id", domain: str = "domain", content: str = "content") -> DataFrame:
    """row_id, line_no (from 1) of every repeated line. Null contents and null or blank domains have none."""
    rows = staged(line_keys(df, id_col, domain, content))
    # a row's own repeated lines first, by hash; so the lookup of each line is in a list no longer than the row
    here = rows.filter("site IS NOT NULL AND keys IS NOT NULL").join(_per_site(rows, "rows"), "site").withColumn("here", F.array_intersect("keys", "hot")).filter(F.size("here") > 0)
    return here.select("row_id", "here", F.posexplode("keys").alias("at", "key")).filter(F.array_contains("here", F.col("key"))).select("row_id", (F.col("at") + 1).alias("line_no"))


def without_repeated(
    df: DataFrame, id_col: str = "row_id", domain: str = "domain", content: str = "content", rule: str = "rows", date: str = "date", zone: str = "Europe/Copenhagen"
) -> DataFrame:
    """row_id, clean: each content without its repeated lines; null stays null, a content of repeated lines only becomes empty."""
    rows = staged(line_keys(df, id_col, domain, content)) if rule == "rows" else _dated(df, id_col, domain, content, date, zone)
    own = line_keys(df, id_col, domain, content, F.col(content).alias("content"))
    here = own.join(_per_site(rows, rule), "site", "left").withColumn("here", F.array_intersect("keys", "hot"))
    pairs = F.arrays_zip(F.split("content", "\n").alias("line"), F.col("keys").alias("key"))
    kept = F.filter(pairs, lambda p: F.coalesce(~F.array_contains(F.col("here"), p["key"]), F.lit(True)))
    return here.select("row_id", F.array_join(F.transform(kept, lambda p: p["line"]), "\n").alias("clean"))


def site_report(df: DataFrame, id_col: str = "row_id", domain: str = "domain", content: str = "content", date: str = "date", zone: str = "Europe/Copenhagen") -> DataFrame:
    """site, line_key, n_rows, n_clusters, n_days: the repeated lines with the distinct publication days they occur on.

    A day is that of the date's moment in UTC; dates without zone are in ``zone``. Dates that are no moment count for no day.
    """
    rows = _dated(df, id_col, domain, content, date, zone)
    hot = repeated(rows)
    return hot.join(publication_days(rows, hot), ["site", "key"]).select("site", F.col("key").alias("line_key"), "n_rows", "n_clusters", "n_days")
