import re
from collections import Counter

from pyspark.sql import functions as F

from fjordmill.llm import repeated_lines as R


def brute(rows):
    site = lambda d: re.sub(r"^www\.", "", (d or "").strip().lower()) or None
    fold = lambda x: re.sub("[0-9]+", "0", " ".join(x.lower().split()))
    total, n = Counter(site(d) for _, d, _ in rows), Counter()
    for _, d, t in rows:
        for x in {fold(x) for x in (t or "").split("\n")}:
            if site(d) and x and t is not None:
                n[site(d), x] += 1
    return {(i, k) for i, d, t in rows if site(d) and t is not None for k, x in enumerate(t.split("\n"), 1) if fold(x) and n[site(d), fold(x)] >= 8 and n[site(d), fold(x)] >= 0.1 * total[site(d)]}


def make():
    rows = []
    for i in range(130):
        lines = [f"egen linje {chr(97 + i % 26)}{chr(97 + i // 26)}", "Del  på Facebook" if i % 3 else " del på facebook\r", f"© {2000 + i % 20} A", "", "  "]
        rows.append((i, ["a.dk", "WWW.a.dk ", " a.dk"][i % 3], "\n".join(lines + (["sjælden"] if i < 12 else []))))
    rows += [(200 + i, "b.dk", "samme\nsamme") for i in range(8)] + [(300 + i, "c.dk", "samme") for i in range(7)]
    rows += [(400 + i, None, "samme") for i in range(9)] + [(500 + i, "  ", "samme") for i in range(9)] + [(600, "a.dk", None), (601, "a.dk", ""), (602, "b.dk", "x" * 100_000)]
    return rows


def test_places_and_clean(spark):
    rows = make()
    df = spark.createDataFrame(rows, "row_id long, domain string, content string").withColumn("keys", F.lit(1)).withColumn("site", F.lit("z"))
    want = brute(rows)
    got = [tuple(r) for r in R.repeated_places(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    clean = {r["row_id"]: r["clean"] for r in R.without_repeated(df).collect()}
    for i, _, t in rows:
        assert clean[i] == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n"), 1) if (i, k) not in want))


def test_copies_count_as_one_cluster(spark):
    df = spark.createDataFrame([(i, "a.dk", "samme\nx", "2020-01-01") for i in range(10)], "row_id long, domain string, content string, date string")
    r = R.site_report(df).collect()
    assert {(x["n_rows"], x["n_clusters"], x["n_days"]) for x in r} == {(10, 1, 1)} and len(r) == 2


def test_empty(spark):
    df = spark.createDataFrame([], "row_id long, domain string, content string, date string")
    assert R.repeated_places(df).count() == 0 and R.without_repeated(df).count() == 0 and R.site_report(df).count() == 0


def test_days_are_moments(spark):
    """One day in many forms counts once; what is no moment counts for none."""
    same = ["2009-01-14", "2009/01/14", "Jan 14, 2009 3:21 AM", "14. januar 2009", "Wed, 14 Jan 2009 10:00:00 +0000", "1231934400", "1231934401", "1231934400000", "1231934400000000", "2009-01-14T12:00:00Z"]
    other = ["14. januar 2010", "2009-01-16 00:30"]
    none = ["None", "N/A", "Invalid Date", "", None, "2009-02-30"]
    # 2009-01-14 in Copenhagen begins on the 13th in UTC, and so do the other dates without a time
    df = spark.createDataFrame([(k, "a.dk", f"samme\negen {chr(97 + k)}", d) for k, d in enumerate(same + other + none)], "row_id long, domain string, content string, date string")
    assert [r["n_days"] for r in R.site_report(df).collect()] == [4]


def test_clusters_decide(spark):
    """An article published again ten times is kept by the rule over clusters and days; a notice on many articles goes."""
    rows = [(k, "a.dk", "samme artikel\nmed to linjer", "2020-01-01") for k in range(30)]
    rows += [(100 + k, "a.dk", f"egen {chr(97 + k)}\nDel på Facebook", f"2020-02-{k % 9 + 10}") for k in range(12)]
    rows += [(200 + k, "a.dk", f"anden {chr(97 + k)}\nEn dags tilbud", "2020-03-01") for k in range(12)]
    df = spark.createDataFrame(rows, "row_id long, domain string, content string, date string")
    clean = {r["row_id"]: r["clean"] for r in R.without_repeated(df, rule="clusters").collect()}
    assert clean[0] == "samme artikel\nmed to linjer" and clean[103] == "egen d" and clean[203] == "anden d\nEn dags tilbud"
    by_rows = {r["row_id"]: r["clean"] for r in R.without_repeated(df).collect()}
    assert by_rows[0] == "" and by_rows[103] == "egen d"
