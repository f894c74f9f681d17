import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from fjordmill.sinks import files as sinks
from fjordmill.sources import browser_json, catalog, html, social, sqlite, tabular


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("donor") / "facebook-anna-1"
    d.mkdir()
    con = sqlite3.connect(d / "History.db")
    con.executescript(
        "CREATE TABLE history_items (id, url, visit_count, domain_expansion); CREATE TABLE history_visits (id, history_item, visit_time, title, load_successful, from_visit);"
        "CREATE TABLE history_tags (id, title); CREATE TABLE history_items_to_tags (history_item, tag_id);"
        "INSERT INTO history_items VALUES (1, 'https://a.dk/x', 2, 'a'); INSERT INTO history_visits VALUES (10, 1, 700000000.5, 'A', 1, NULL), (11, 1, 700000009, NULL, 1, 10);"
        "INSERT INTO history_tags VALUES (1, 't2'), (2, 't1'); INSERT INTO history_items_to_tags VALUES (1, 1), (1, 2);"
    )
    con.commit()
    con.close()
    con = sqlite3.connect(d / "Minimal.db")
    con.executescript("CREATE TABLE history_items (id, url); CREATE TABLE history_visits (id, history_item, visit_time, source); INSERT INTO history_items VALUES (1, 'https://b.dk/'); INSERT INTO history_visits VALUES (5, 1, 1, 4);")
    con.commit()
    con.close()
    (d / "bad.db").write_bytes(b"no database at all, but long enough to be read as one" * 20)
    (d / "empty.db").write_bytes(b"")
    (d / "._x.json").write_text("{}")
    safari = {"metadata": {"browser_name": "Safari", "data_type": "history"}, "history": [{"url": "https://s.dk/", "time_usec": 1700000000000000, "visit_count": 3}, {"url": ""}]}
    (d / "safari.json").write_text(json.dumps(safari))
    (d / "chrome_list.json").write_text(json.dumps([{"id": 7, "url": "https://c.dk/1", "visitTime": 1.7e12}]))
    (d / "chrome_keyed.json").write_text(json.dumps({"Browser History": [{"url": "https://c.dk/2", "time_usec": 5}]}))
    (d / "chrome_other.json").write_text(json.dumps({"x": 1, "visits": [{"url": "https://c.dk/3", "referrer": "r"}]}))
    (d / "creator_studio_history.json").write_text(json.dumps([{"url": "https://c.dk/no"}]))
    (d / "broken.json").write_text("{")
    return d.parent


def test_sqlite(spark, folder):
    sqlite.register(spark)
    rows = {r["visit_id"]: r for r in spark.read.format("sqlite_history").option("path", str(folder)).load().collect()}
    assert set(rows) == {10, 11, 5}
    assert rows[10]["tags"] == "t1, t2" and rows[10]["tag_count"] == 2 and rows[11]["referring_visit_id"] == 10 and rows[5]["title"] is None and rows[5]["referring_visit_id"] == 4
    tables = spark.read.format("sqlite_history").option("path", str(folder)).option("kind", "tables").load()
    assert tables.filter("table_name = 'history_visits'").count() == 2


def test_json_shapes(spark, folder):
    files = browser_json.json_files(spark, str(folder))
    safari = browser_json.safari_visits(files).collect()
    assert [(r["visit_id"], r["url"], r["visit_count"]) for r in safari] == [(0, "https://s.dk/", 3)]
    got = {(r["url"], r["visit_id"]): r for r in browser_json.chrome_visits(files).collect()}
    assert {u for u, _ in got} == {"https://c.dk/1", "https://c.dk/2", "https://c.dk/3"}
    assert ("https://c.dk/1", 7) in got and got["https://c.dk/3", 0]["referring_visit_id"] == "r"
    unified = browser_json.unified_visits(spark, str(folder))
    assert unified.count() == 7 and {r[0] for r in unified.select("account_name").distinct().collect()} == {"facebook-anna-1"}


def test_catalog(spark, folder):
    c = catalog.file_catalog(spark, str(folder))
    assert {r["filename"] for r in catalog.history_files(c).collect()} >= {"History.db", "safari.json"}
    assert catalog.history_files(c).filter("filename = 'empty.db' OR filename LIKE '._%'").count() == 0
    left = catalog.unprocessed(c, c.filter("filename = 'History.db'"))
    assert left.filter("filename = 'bad.db'").first()["reason_not_processed"].startswith("database without")
    df = spark.createDataFrame([("/x/facebook-anna-1",), ("/x/facebook_bo_99_1",), ("/x/12",)], "p string")
    assert [r[0] for r in df.select(catalog.account_name("p")).collect()] == ["anna", "_bo_99_", None]
    assert catalog.social_folders(c, ["posts"]).filter("valid").count() == 0


def test_social(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        json.dumps({"comments_v2": [{"timestamp": 1700000000, "title": "T", "data": [{"comment": {"comment": "se https://a.dk/x her"}}]}, {"title": "kun https://www.facebook.com/x"}, {"attachments": [{"data": [{"text": "ATT https://b.dk/"}]}], "data": [{"post": "P"}]}]})
    )
    (tmp_path / "b.json").write_text(json.dumps([{"title": "Anna synes godt om Hanss opslag", "timestamp": 5}]))
    (tmp_path / "c.json").write_text(json.dumps({"page_likes_v2": [{"name": "DR Nyheder", "timestamp": 1}]}))
    (tmp_path / "d.json").write_text(json.dumps({"recently_viewed": [{"children": [{"entries": [{"timestamp": 3, "data": {"uri": "https://a.dk/v", "name": "n", "watch_time": "12"}}, {"data": {"uri": "https://z.dk/"}}]}]}]}))
    files = browser_json.json_files(spark, str(tmp_path))
    shared = {r["url"]: r for r in social.shared_urls(files).collect()}
    assert {"https://a.dk/x", "https://b.dk/"} <= set(shared) and not any("facebook" in u for u in shared)
    assert shared["https://a.dk/x"]["content"] == "se https://a.dk/x her" and shared["https://b.dk/"]["content"].startswith("ATT")
    assert social.reactions(files).filter("actor = 'Hans'").count() == 1
    patterns = spark.createDataFrame([("nyheder", 1)], "pattern string, rank int")
    assert social.liked_pages(files, patterns).first()["pattern"] == "nyheder"
    classes = spark.createDataFrame([("a.dk", "mainstream")], "domain string, classification string")
    assert [(r["url"], r["watch_time"]) for r in social.recently_viewed(files, classes).collect()] == [("https://a.dk/v", 12)]


def test_html(spark):
    page = "<html lang='da'><head><title>T x</title><meta name='author' content='A'><meta property='article:published_time' content='2020'></head><body><nav>M</nav><article><h1>H</h1><p>Hej <b>du</b></p><script>x</script></article><p>no</p></body></html>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "<p>løst")], "id int, h string")
    got = {r["id"]: r for r in html.extract_pages(df, "id", "h").collect()}
    assert got[1]["content"] == "H\nHej du" and got[1]["title"] == "T x" and got[1]["author"] == "A" and got[1]["date"] == "2020" and got[1]["language"] == "da"
    assert got[2]["content"] == "" and got[3]["id"] == 3
    act = "<div><time datetime='2020-01-01'></time><img src='a.jpg'><div class='x _3-95'>et langt opslag her</div></div>"
    rows = html.activities(spark.createDataFrame([("f", act)], "f string, h string"), "f", "h").collect()
    assert [(r["kind"], r["time"]) for r in rows] == [("activity", "2020-01-01"), ("photo", "2020-01-01"), ("post", "2020-01-01")]
    seen = "x maj 06, 2025 1:15:11 pm <a href='https://www.facebook.com/dyi/l/?l=https%3A%2F%2Fa.dk%2Fb'>l</a>"
    rows = html.viewed_links(spark.createDataFrame([("f", seen)], "f string, h string"), "f", "h").collect()
    assert [(r["day"], r["url"]) for r in rows] == [("maj 06, 2025 1:15:11 pm", "https://a.dk/b")]


def test_csv_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "scraped_batch_2.csv").write_text('url,content\nhttps://a.dk,"to\nlinjer"\nhttps://b.dk,x\n')
    df = tabular.csv_batches(spark, str(tmp_path / "in" / "scraped_batch_*.csv"))
    assert {(r["url"], r["batch"]) for r in df.collect()} == {("https://a.dk", 2), ("https://b.dk", 2)}
    assert tabular.url_list(spark, str(tmp_path / "in")).count() >= 1
    rich = spark.range(25).select("id", F.array(F.lit("a"), F.lit("b")).alias("l"), F.struct(F.lit(1).alias("z")).alias("s"))
    sinks.write_csv(rich, str(tmp_path / "csv"), max_rows=10)
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 25 and back.first()["l"] == "a; b"
    sinks.write_both(rich, str(tmp_path / "both"))
    assert spark.read.parquet(str(tmp_path / "both/parquet")).count() == 25
    sinks.write_batches(rich, str(tmp_path / "b"), ["id"], 10)
    assert spark.read.option("header", True).csv(str(tmp_path / "b")).groupBy("batch").count().count() == 3
    sinks.write_report(rich.limit(2), str(tmp_path / "r.txt"), "Titel")
    sinks.write_json_report(rich.limit(2), str(tmp_path / "r.json"))
    assert len(json.loads((tmp_path / "r.json").read_text())) == 2
    known = spark.range(3).select("id")
    sinks.append_new(rich.select("id"), str(tmp_path / "new"), "id", known)
    assert spark.read.parquet(str(tmp_path / "new")).count() == 22


def test_keys_and_links(spark):
    df = spark.createDataFrame([(1, '{"a":[{"lang":"da"},{"x":{"lang":["en"]}}]}'), (2, "no json"), (3, None)], "id int, j string")
    got = {tuple(r) for r in browser_json.keys_at_any_path(df, "id", "j", ["lang"]).collect()}
    assert got == {(1, "$.a[0].lang", "da"), (1, "$.a[1].x.lang", '["en"]')}
    posts = ['{"link":"https://a.dk"}', '{"url":"https://reddit.com/x","text":"se https://b.dk/c."}', '{"entities":{"urls":[{"url":"https://t.co/1","expanded_url":"https://c.dk"}]}}', "{}"]
    df = spark.createDataFrame([(p,) for p in posts], "j string").withColumn("post", F.parse_json("j"))
    assert [r[0] for r in df.select(social.external_link()).collect()] == ["https://a.dk", "https://b.dk/c", "https://c.dk", None]


def test_broken_history_gives_an_error_row(spark, folder):
    rows = sqlite.read_histories(spark, str(folder)).collect()
    assert {r["visit_id"] for r in rows if r["error"] is None} == {10, 11, 5}
    assert [r["source_file"].rsplit("/", 1)[-1] for r in rows if r["error"]] == ["bad.db"]


def test_relevant_leftovers(spark):
    names = ["a_safari.db", "chrome.json", "x.db", "historik.plist", "firefox.csv"]
    c = spark.createDataFrame([(f"/d/{n}", n, "." + n.rsplit(".")[-1], 10) for n in names], "full_path string, filename string, extension string, size_bytes long")
    got = {r["filename"]: r["potentially_relevant"] for r in catalog.unprocessed(c, c.limit(0)).collect()}
    assert got == {"a_safari.db": True, "chrome.json": True, "x.db": False, "historik.plist": True, "firefox.csv": False}


def test_deep_keys_and_long_reports(spark, tmp_path):
    deep = '{"x":' * 60 + '{"k":1}' + "}" * 60
    got = browser_json.keys_at_any_path(spark.createDataFrame([(1, deep)], "id int, j string"), "id", "j", ["k"]).collect()
    assert len(got) == 1 and got[0]["path"].count(".x") == 60
    for write in (lambda: sinks.write_report(spark.range(12), str(tmp_path / "r"), "T", limit=10), lambda: sinks.write_json_report(spark.range(12), str(tmp_path / "j"), limit=10)):
        with pytest.raises(ValueError):
            write()
    sinks.write_batches(spark.range(30), str(tmp_path / "b"), ["id"], 10)
    sinks.write_batches(spark.range(30), str(tmp_path / "b"), ["id"], 10)
    assert spark.read.option("header", True).csv(str(tmp_path / "b")).count() == 30
