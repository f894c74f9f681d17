"""Queries and oracle SQL of the operators in this subpackage; ``__spark_entry__`` adds them if it can import this module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fjordmill.llm import encode, language, mainbody, packing, repeated_lines, residue, spans, truncation
from fjordmill.session import spread
from fjordmill.session import table as scan

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spread(scan(spark, root, name))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return truncation.cut_at_limits(table(spark, root, "scraped_cache")).select("row_id", "field")


def p1_rates(spark: SparkSession, root: str) -> DataFrame:
    return truncation.truncation_rates(table(spark, root, "scraped_cache"))


def p1_spikes(spark: SparkSession, root: str) -> DataFrame:
    return truncation.length_spikes(truncation.text_fields(table(spark, root, "scraped_cache")))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return repeated_lines.repeated_places(table(spark, root, "sample_old_facebook"))


def p2_clean(spark: SparkSession, root: str) -> DataFrame:
    return repeated_lines.without_repeated(table(spark, root, "sample_old_facebook"))


def p2_clean_clusters(spark: SparkSession, root: str) -> DataFrame:
    return repeated_lines.without_repeated(table(spark, root, "sample_old_facebook"), rule="clusters")


def p2_sites(spark: SparkSession, root: str) -> DataFrame:
    return repeated_lines.site_report(table(spark, root, "sample_old_facebook"))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return language.mislabelled_segments(table(spark, root, "scraped_cache"))


def p3_segments(spark: SparkSession, root: str) -> DataFrame:
    return language.language_segments(table(spark, root, "scraped_cache"))


def p3_documents(spark: SparkSession, root: str) -> DataFrame:
    return language.document_languages(table(spark, root, "scraped_cache"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return residue.residue_found(table(spark, root, "scraped_cache"))


def p4_clean(spark: SparkSession, root: str) -> DataFrame:
    return residue.without_residue(table(spark, root, "scraped_cache"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return mainbody.furniture_lines(table(spark, root, "scraped_cache"))


def p6_bodies(spark: SparkSession, root: str) -> DataFrame:
    return mainbody.main_bodies(table(spark, root, "scraped_cache"))


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    return encode.encode_texts(table(spark, root, "documents"))


def p8_decoded(spark: SparkSession, root: str) -> DataFrame:
    """The texts from their ids."""
    return encode.decode_texts(encode.encode_texts(table(spark, root, "documents")))


def p9_online(spark: SparkSession, root: str) -> DataFrame:
    """p9_containers in plain online order."""
    docs = table(spark, root, "documents")
    return packing.fill_containers(encode.count_tokens(docs), scan(spark, root, "documents").count(), late=0.0)


def p9_containers(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    return packing.fill_containers(encode.count_tokens(docs), scan(spark, root, "documents").count())


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return spans.SharedSpans(table(spark, root, "documents")).pairs()


def p10_shared(spark: SparkSession, root: str) -> DataFrame:
    return spans.SharedSpans(table(spark, root, "documents")).shared_chars()


def queries() -> dict[str, Query]:
    found = [p1_found, p1_rates, p1_spikes, p2_found, p2_clean, p2_clean_clusters, p2_sites, p3_found, p3_segments, p3_documents, p4_found, p4_clean, p6_found, p6_bodies, p8_ids, p8_decoded, p9_containers, p9_online, p10_found, p10_shared]
    return {f.__name__: f for f in found}


FOLDED = """
  SELECT row_id, nullif(regexp_replace(lower(trim(domain, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))), '^www\\.', ''), '') AS site,
         string_split(content, chr(10)) AS lines
  FROM sample_old_facebook"""

PLACES = f"""
  WITH rows AS ({FOLDED}),
  numbered AS (SELECT row_id, site, unnest(range(1, len(lines) + 1)) AS line_no, unnest(lines) AS line FROM rows WHERE lines IS NOT NULL),
  keyed AS (SELECT row_id, site, line_no, line,
              trim(regexp_replace(regexp_replace(lower(line), '[\\s\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g'), '[0-9]+', '0', 'g')) AS key FROM numbered),
  totals AS (SELECT site, count(*) AS site_rows FROM rows WHERE site IS NOT NULL GROUP BY site),
  counted AS (SELECT site, key, count(DISTINCT row_id) AS n_rows FROM keyed WHERE site IS NOT NULL AND key <> '' GROUP BY site, key),
  hot AS (SELECT site, key FROM counted JOIN totals USING (site) WHERE n_rows >= 8 AND n_rows >= 0.1 * site_rows)"""


STRETCHES = """
  WITH stretches AS (SELECT DISTINCT doc_id, md5(substr(text, CAST(p AS BIGINT), 160)) AS stretch FROM (SELECT doc_id, text, unnest(range(1, length(text) - 158)) AS p FROM documents WHERE length(text) >= 160)),
  shared AS (SELECT * FROM stretches WHERE stretch IN (SELECT stretch FROM stretches GROUP BY 1 HAVING count(*) > 1))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": PLACES + " SELECT row_id, CAST(line_no AS INT) AS line_no FROM keyed JOIN hot USING (site, key)",
        "p2_clean": PLACES
        + """, kept AS (SELECT row_id, string_agg(line, chr(10) ORDER BY line_no) AS clean FROM keyed LEFT JOIN hot USING (site, key) WHERE hot.key IS NULL GROUP BY row_id)
        SELECT r.row_id, CASE WHEN r.lines IS NOT NULL THEN coalesce(k.clean, '') END AS clean FROM rows r LEFT JOIN kept k USING (row_id)""",
        "p8_decoded": "SELECT doc_id, text FROM documents",
        "p10_shared": """WITH s AS (SELECT doc_id, p, md5(substr(text, CAST(p AS BIGINT), 160)) AS stretch FROM (SELECT doc_id, text, unnest(range(1, length(text) - 158)) AS p FROM documents WHERE length(text) >= 160)),
          k AS (SELECT stretch FROM s GROUP BY stretch HAVING count(DISTINCT doc_id) > 1),
          h AS (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS next_p FROM s WHERE stretch IN (SELECT stretch FROM k)),
          n AS (SELECT doc_id, sum(least(160, coalesce(next_p - p, 160))) AS n_shared FROM h GROUP BY doc_id)
          SELECT doc_id, CAST(coalesce(n_shared, 0) AS BIGINT) AS n_shared FROM documents LEFT JOIN n USING (doc_id)""",
        "p10_found": STRETCHES + " SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM shared a JOIN shared b ON a.stretch = b.stretch AND a.doc_id < b.doc_id",
    }
