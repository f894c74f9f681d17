from pyspark.sql import functions as F

from fjordmill.streaming import events as E


def test_windows_match_batch(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    out = []
    stream = E.windowed_counts(E.read_events(spark, str(tmp_path / "in"), 1))
    E.run_available(stream, lambda df, i: out.extend(df.collect()), str(tmp_path / "ck"), "complete")
    last = {(r["started"], r["event_type"]): r["n"] for r in out}
    want = {(r["started"], r["event_type"]): r["n"] for r in E.windowed_counts(batch).collect()}
    assert last == want
    assert E.session_counts(batch).agg(F.sum("n")).first()[0] == batch.count()


def test_resume_and_upsert(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    write = lambda rows: spark.createDataFrame(rows, "k string, t int").coalesce(1).write.mode("append").parquet(src)
    write([("a", 1), ("b", 1)])
    run = lambda: E.run_available(E.read_events(spark, src), E.upsert_into(out, ["k"], [F.desc("t")]), str(tmp_path / "ck"), "append")
    run()
    write([("a", 2), ("c", 1)])
    q = run()
    assert {tuple(r) for r in E.latest_version(spark, out).collect()} == {("a", 2), ("b", 1), ("c", 1)}
    assert sum(p["rows"] for p in E.progress(q)) == 2


def test_append_unseen(spark, tmp_path):
    w = E.append_unseen(str(tmp_path / "o"), "k")
    w(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), 0)
    w(spark.createDataFrame([("b",), ("c",)], "k string"), 1)
    w(spark.createDataFrame([("b",), ("c",)], "k string"), 1)
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["a", "b", "c"]


def test_versions_outlive_checkpoints(spark, tmp_path):
    """Batches of another checkpoint, which count from 0 again, go on with the table's versions; only touched buckets are written."""
    out = str(tmp_path / "t")
    write = E.upsert_into(out, ["k"], [F.desc("t")])
    frame = lambda rows: spark.createDataFrame(rows, "k string, t int")
    write(frame([(f"k{i}", 1) for i in range(200)]), 7)
    write(frame([("k3", 2)]), 0)
    write(frame([("k3", 2)]), 0)
    write(frame([]), 1)
    rows = {r["k"]: r["t"] for r in E.latest_version(spark, out).collect()}
    assert len(rows) == 200 and rows["k3"] == 2
    assert len(list((tmp_path / "t/data/2").glob("bucket=*"))) == 1
    E.forget_versions(spark, out)
    assert {r["k"]: r["t"] for r in E.latest_version(spark, out).collect()} == rows
