"""Template residue, filler and error-page text.

Placeholders that no engine filled and filler (pseudo-Latin runs, stand-in lines, a last line that repeats itself) are
found in single texts. Notices are whole responses, found by combined host evidence, with wordings as what is known beforehand:

1. A low-information response is compared with its title and address slug; one that shares ``FIT_WORDS`` long words with them,
   the site's name aside, fits and is left out.
2. The other ones are split into fragments, numbers, references and the site's name masked. A fragment that at least
   ``EVIDENCE_HOSTS`` hosts answer with is duplicated; a response of nothing but duplicated fragments is bare.
3. A fragment is evidence if bare responses of at least ``EVIDENCE_HOSTS`` hosts hold it, and at least ``BARE_SHARE`` of all short
   responses that do are bare. (Menus and share prompts recur as much, but beside a text.)
4. A response is a notice if each of its fragments is evidence, is a notice by wording or says nothing by itself (references, the
   site's name), and one of at least three words is evidence or a notice.

Parameters: ``LOW_INFORMATION_WORDS`` and ``LOW_INFORMATION_CHARS`` bound the responses that evidence is taken from and holds for: longer notices are found by
wordings only. A fragment over ``NOTICE_CHARS`` characters is a notice only if it begins as failure messages do, so a longer sentence
that mentions a failure in passing isn't one; longer notices of other beginnings are found by evidence only.

Scale: texts are tested by JVM expressions, one row at a time. Evidence is counted over the 64-bit hashes of the fragments of short
responses, distinct per host, with partial sums; its result, the hashes of the responses found, is joined by hash; it is broadcast only
after a check of its size.

Nulls and blanks are never found. Missing titles and addresses share no words with anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordmill.llm.pagetext import FILLER, FURNITURE, LATIN, NEUTRAL, NOTICE_STEMS, NOTICES, PLACEHOLDERS, SEPARATED_MENU, by_first, joined
from fjordmill.session import broadcast_if_small, staged

LOW_INFORMATION_WORDS, LOW_INFORMATION_CHARS = 60, 1000
EVIDENCE_HOSTS, BARE_SHARE, EVIDENCE_WORDS, FIT_WORDS = 3, 0.2, 3, 2
BROADCAST_KEYS = 1_000_000
NOTICE_CHARS = 300  # a longer fragment is a notice only if it begins as a failure message does
LATIN_WORD = by_first(LATIN) + r"\b"
# wherever it stands; the look-behind keeps a run from starting inside a word
LATIN_RUN = rf"(?i)(?<![\p{{L}}\p{{N}}_]){LATIN_WORD}(?:[ ,.]+{LATIN_WORD}){{4}}"
# what every run holds after its first word; a cheaper test before the run itself
LATIN_REST = rf"(?i)[ ,.]{LATIN_WORD}(?:[ ,.]+{LATIN_WORD}){{3}}"
PLACEHOLDER = r"(?=[{$#<%\[@*_])" + joined(PLACEHOLDERS)
FILLER_LINE = rf"(?imU)^\W*{joined(FILLER)}\W*$"
# (?U): letters beyond ASCII are letters to the JVM too
NOTICE = "(?U)" + joined(NOTICES)
LONG_NOTICE = r"^(?:\{\s*.?(?:error|status|message|code).?\s*:|traceback \(|(?:fatal error|parse error|traceback)\b.{0,3}[:(]|[a-z_.]*(?:error|exception): .|<error>)"
NOTICE_HINT = by_first(NOTICE_STEMS)
NEUTRAL_LINE = "(?U)" + joined(NEUTRAL)
FURNITURE_LINE = rf"(?U)^\W*(?:{joined(FURNITURE)}|{SEPARATED_MENU}$)"
SPLIT = r"\n+| [–—] | - |(?<=[.!?])\s+"


def host(*urls: str) -> Column:
    """The host of the first address that has one, lower-case, without ``www.``."""
    part = lambda u: F.regexp_replace(F.lower(F.regexp_extract(F.col(u), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#:]+)", 1)), r"^www\.", "")
    return F.coalesce(*(F.when(part(u) != "", part(u)) for u in urls))


def holds_placeholder(c: Column) -> Column:
    return F.coalesce(c.rlike(PLACEHOLDER), F.lit(False))


def holds_filler(c: Column) -> Column:
    """Pseudo-Latin of five words in a row, a stand-in line, or two equal last lines that aren't furniture."""
    text = F.rtrim(c)
    last = F.substring_index(text, "\n", -1)
    twice = (F.substring_index(text, "\n", -2) == F.concat_ws("\n", last, last)) & last.rlike(r"^[\p{L}].* ") & ~F.lower(last).rlike(FURNITURE_LINE)
    return F.coalesce((c.rlike(LATIN_REST) & c.rlike(LATIN_RUN)) | c.rlike(FILLER_LINE) | twice, F.lit(False))


def _stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|[\s.]+$", "")


def _worded(x: Column) -> Column:
    return F.when(F.length(x) <= NOTICE_CHARS, x.rlike(NOTICE_HINT) & x.rlike(NOTICE)).otherwise(x.rlike(LONG_NOTICE))


def _says_nothing(x: Column, name: Column) -> Column:
    return (x == "") | (x == name) | x.rlike(NEUTRAL_LINE)


def site_name(site: Column) -> Column:
    return F.regexp_extract(F.coalesce(site, F.lit("")), r"^([^.]+)", 1)


def is_notice(c: Column, site: Column) -> Column:
    """Whether all of a text is a notice by wording; site is the page's host. The first fragment is looked at before all others."""
    name = site_name(site)
    fits = lambda x: _worded(x) | _says_nothing(x, name)
    first = _stripped(F.split(F.lower(F.substring_index(F.trim(c), "\n", 1)), SPLIT, 2)[0])
    bare = F.transform(F.split(F.lower(F.trim(c)), SPLIT), _stripped)
    return F.coalesce(F.when(fits(first), F.forall(bare, fits) & F.exists(bare, _worded)), F.lit(False))


def folded(c: Column, site: Column) -> Column:
    """A text for comparison between hosts: lower-case, numbers, references and the site's name masked."""
    name = F.regexp_extract(F.coalesce(site, F.lit("")), r"^([^.]+)", 1)
    t = F.regexp_replace(F.lower(F.trim(c)), r"\b[0-9a-f]*[0-9][0-9a-f]*\b", "0")
    return F.regexp_replace(F.when(name != "", F.replace(t, name, F.lit("@"))).otherwise(t), r"[\s.]+$", "")


def long_words(c: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}]+"), lambda w: F.length(w) >= 6)


def low_information(c: Column) -> Column:
    """Whether a text has at most 60 words in at most 1,000 characters."""
    return (F.length(c) <= LOW_INFORMATION_CHARS) & (F.size(F.split(F.trim(c), r"\s+")) <= LOW_INFORMATION_WORDS)


def fragments(c: Column, site: Column) -> Column:
    """The fragments of a short response that say something: (key, words, worded)."""
    name = site_name(site)
    bare = F.filter(F.transform(F.split(F.lower(F.trim(c)), SPLIT), _stripped), lambda x: ~_says_nothing(x, name) & x.rlike(r"\p{L}{2}"))
    own = lambda x: F.when(F.length(name) >= 3, F.replace(x, name, F.lit("@"))).otherwise(x)
    masked = lambda x: F.regexp_replace(F.regexp_replace(own(x), r"\b[0-9a-f]*[0-9][0-9a-f]*\b", "0"), r"^[^\p{L}@]+|[^\p{L}0@]+$", "")
    listed = lambda x: x.rlike(r"^(?:[•*·‣▪–-]|\d{1,2}[.)])\s")
    words = lambda x: F.when(listed(x), 0).otherwise(F.size(F.filter(F.split(x, r"[^\p{L}]+"), lambda w: w != "")))
    return F.transform(bare, lambda x: F.struct(F.xxhash64(masked(x)).alias("key"), words(x).alias("words"), _worded(x).alias("worded")))


def host_evidence(df: DataFrame, hosts: int = EVIDENCE_HOSTS, share: float = BARE_SHARE) -> DataFrame:
    """key: hashes of the short responses that are notices by the evidence of several hosts."""
    site = F.col("site")
    slug = F.regexp_extract("original_url", r"^(?:[a-zA-Z][\w+.-]*:)?//[^/?#]*([^?#]*)", 1)
    about = F.array_union(long_words(F.col("title")), long_words(slug))
    fits = F.size(F.array_except(F.array_intersect(about, long_words(F.col("content"))), F.array(site_name(site)))) >= FIT_WORDS
    furniture = F.forall(F.split(F.lower(F.trim("content")), r"\n+"), lambda x: x.rlike(FURNITURE_LINE) | ~x.rlike(r"\p{L}{2}"))
    odd = df.filter(low_information(F.col("content")) & (F.trim("content") != "") & site.isNotNull() & ~fits & ~furniture)
    short = odd.select(F.xxhash64(folded(F.col("content"), site)).alias("response"), "site", fragments(F.col("content"), site).alias("parts")).filter(F.size("parts") > 0)
    short = staged(short.groupBy("response", "site").agg(F.first("parts").alias("parts")))
    parts = short.select("response", "site", F.size(F.array_distinct("parts.key")).alias("n"), F.explode(F.array_distinct("parts")).alias("p")).select("response", "site", "n", "p.key", "p.words", "p.worded")
    per_host = lambda rows, name: rows.select("key", "site").distinct().groupBy("key").agg(F.count("*").alias(name))
    duplicated = per_host(parts, "hosts").filter(F.col("hosts") >= hosts).select("key")
    met = parts.join(duplicated.withColumn("known", F.lit(1)), "key", "left").withColumn("known", F.col("known").isNotNull() | F.col("worded"))
    bare = met.groupBy("response", "site").agg(F.bool_and("known").alias("all")).filter("all").select("response", "site")
    in_bare = parts.join(bare, ["response", "site"], "left_semi")
    shares = parts.groupBy("key").agg(F.count("*").alias("n_short")).join(in_bare.groupBy("key").agg(F.count("*").alias("n_bare")), "key").join(per_host(in_bare, "hosts"), "key")
    evidence = shares.filter((F.col("hosts") >= hosts) & (F.col("n_bare") >= F.col("n_short") * share)).select("key")
    judged = in_bare.join(evidence.withColumn("evident", F.lit(1)), "key", "left").withColumn("says", F.col("evident").isNotNull() | F.col("worded"))
    told = judged.groupBy("response", "site").agg(F.bool_and("says").alias("all"), F.max(F.when(F.col("words") >= EVIDENCE_WORDS, 1).when(F.col("worded"), 1).otherwise(0)).alias("long"))
    return told.filter("all AND long = 1").select(F.col("response").alias("key")).distinct()


def with_residue_flag(df: DataFrame) -> DataFrame:
    """df with site, the page's host, and bad_content, whether its content is residue.

    df has original_url, resolved_url, title and content; columns of these two names are replaced.
    """
    rows = df.withColumn("site", host("resolved_url", "original_url"))
    c, site = F.col("content"), F.col("site")
    short = low_information(c)
    by_text = holds_placeholder(c) | holds_filler(c) | is_notice(c, site)
    evidence = broadcast_if_small(host_evidence(rows).withColumnRenamed("key", "_evidence"), BROADCAST_KEYS)
    # long contents have a key of their own that spreads them, should the evidence be too large to broadcast
    keyed = rows.withColumn("_key", F.when(short, F.xxhash64(folded(c, site))).otherwise(F.xxhash64(F.lit("long"), c))).withColumn("_text", by_text)
    joined_rows = keyed.join(evidence, F.col("_key") == F.col("_evidence"), "left")
    return joined_rows.withColumn("bad_content", F.col("_text") | F.col("_evidence").isNotNull()).drop("_key", "_text", "_evidence")


def flag_residue(df: DataFrame) -> DataFrame:
    """df with bad_content, bad_snippet and bad_error; one row per row of df."""
    c, e = F.col("paywall_snippet"), F.col("error")
    snippet = holds_placeholder(c) | holds_filler(c) | is_notice(c, F.col("site"))
    return with_residue_flag(df).withColumns({"bad_snippet": snippet, "bad_error": holds_placeholder(e)})


def residue_found(df: DataFrame) -> DataFrame:
    """row_id, field: the fields of df to leave out of the clean data."""
    flags = flag_residue(df)
    named = (("bad_content", "content"), ("bad_snippet", "paywall_snippet"), ("bad_error", "error"))
    fields = F.array_compact(F.array(*(F.when(F.col(a), F.lit(b)) for a, b in named)))
    return flags.select("row_id", F.explode(fields).alias("field"))


def without_residue(df: DataFrame) -> DataFrame:
    """df with null in the fields found."""
    cols = df.columns
    flags = flag_residue(df.withColumns({f"_own_{c}": F.col(c) for c in cols if c in ("site", "bad_content", "bad_snippet", "bad_error")}))
    flag = {"content": "bad_content", "paywall_snippet": "bad_snippet", "error": "bad_error"}
    own = lambda c: F.col(f"_own_{c}" if f"_own_{c}" in flags.columns else c).alias(c)
    return flags.select(*(F.when(~F.col(flag[c]), F.col(c)).alias(c) if c in flag else own(c) for c in cols))
