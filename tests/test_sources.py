import json

from pyspark.sql import functions as F

from gavelframe.operators import ledger, relational as R
from gavelframe.sources import anchors, files


def test_packet_texts(spark, tmp_path):
    for name, text in (("P 1/P 1.txt", "own"), ("P2/P2.txt", "two\nlines"), ("P2/notes.txt", "no"), ("P2/P2.json", "no")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    assert sorted((r.code, r.text) for r in files.packet_texts(spark, str(tmp_path)).collect()) == [("P 1", "own"), ("P2", "two\nlines")]


def test_listing(spark, tmp_path):
    (tmp_path / "y").mkdir()
    for name in ("A.7.20240105.20240201.pdf", "y/A.6.20240105.20240131.pdf", "A.8.20231399.20240101.pdf", "other.pdf"):
        (tmp_path / name).write_text("x")
    got = [(r.document, str(r.created), str(r.pulled), r.n_bytes) for r in files.listing(spark, str(tmp_path), r"A\.(\d+)\.(\d{8})\.(\d{8})\.pdf$").collect()]
    assert got == [("8", "None", "2024-01-01", 1), ("6", "2024-01-05", "2024-01-31", 1), ("7", "2024-01-05", "2024-02-01", 1)]


def test_package(spark, tmp_path):
    pages = spark.createDataFrame([(1, "agenda"), (2, "minutes")], "page_id int, page_type string")
    words = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "page_id int, reading_order int, text string")
    lines = spark.createDataFrame([(2, 1, "l")], "page_id int, reading_order int, text string")
    for _ in range(2):  # a second run leaves the same package
        files.write_package(pages, words, lines, spark.createDataFrame([("R", 2)], "run_id string, page_count int"), str(tmp_path / "out"))
    nested = {r.page_id: r for r in spark.read.json(str(tmp_path / "out/pages_nested")).collect()}
    assert [w.text for w in nested[1].words] == ["a", "b"] and nested[1]["lines"] is None and nested[2]["lines"][0].text == "l"
    assert (tmp_path / "out/run/_SUCCESS").exists() and spark.read.json(str(tmp_path / "out/words")).count() == 2


def test_log(spark, tmp_path):
    rows = spark.createDataFrame([("INFO", "start")], "level string, event string")
    for _ in range(2):
        files.append_log(rows, str(tmp_path / "log"), {"cpu": 1, "rss_mb": 20})
    got = spark.read.json(str(tmp_path / "log")).collect()
    assert len(got) == 2 and got[0].host.rss_mb == 20.0 and got[0].logged_at


def test_anchors():
    html = '<a>no address</a><a href="/x">a <b>b</b>\n c<a href="y">open &amp; shut'
    assert anchors.anchors(html) == [("/x", "a b c"), ("y", "open & shut")] and anchors.anchors(None) == []


def test_upsert_takes_one_row_a_key_and_null_keys_once(spark):
    target = spark.createDataFrame([(1, "a", "old"), (None, "n", "old")], "k int, v string, updated_at string")
    source = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (None, "N", 3), (4, "d", 4)], "k int, v string, rank int")
    once = R.upsert(target, source, ["k"], order=[F.desc("v")], stamp=F.lit("now"))
    rows = lambda df: sorted((r.k is None, r.k or 0, r.v, r.updated_at) for r in df.collect())
    assert rows(once) == [(False, 1, "c", "now"), (False, 4, "d", "now"), (True, 0, "N", "now")]
    assert rows(R.upsert(once, source, ["k"], order=[F.desc("v")], stamp=F.lit("now"))) == rows(once)
    have = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n"), (None, "n")], "k int, v string")
    first = R.insert_missing(have, new, ["k"])
    again = R.insert_missing(first, new, ["k"])
    assert sorted((r.k or 0, r.v) for r in first.collect()) == sorted((r.k or 0, r.v) for r in again.collect()) == [(0, "n"), (1, "a"), (2, "z")]


def test_versions(spark):
    history = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, v string, version int")
    rows = spark.createDataFrame([("a", "y"), ("b", "z")], "k string, v string")
    after = ledger.append_version(history, rows, "k")
    assert sorted(map(tuple, after.collect())) == [("a", "x", 1), ("a", "y", 2), ("b", "z", 1)]
    assert sorted(map(tuple, ledger.versions(after, "k").collect())) == [("a", "y", 2), ("b", "z", 1)]
    assert json.dumps(ledger.allowed_dispositions(None)) == '["OK95"]'
