"""Every query against its SQL on the smallest tables, and the operators on small cases."""

import os

import duckdb
import pandas as pd
import pytest

from gavelframe.functions import text as X
from gavelframe.operators import relational as R
from gavelframe.plans import cases, lanes, ledger, pages, scalars, transcript  # noqa: F401
from gavelframe.plans.catalog import QUERIES, SQL
from gavelframe.sources import captions
from tests.conftest import SF


def rows(df):
    def plain(v):
        if pd.isna(v):
            return None
        return round(float(v), 6) if not isinstance(v, (str, bool)) and hasattr(v, "__float__") else str(v)

    return sorted(str([plain(v) for v in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in SQL:
        assert len(got)
        return
    want = db.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_captions(spark):
    vtt = "WEBVTT\n\n00:00:01.500 --> 00:00:03.000\n<c>hello</c> there\nand you\n01:02.250 --> 01:03.000\nbye &amp; bye"
    files = spark.createDataFrame([("a", vtt), ("b", "WEBVTT"), ("c", None)], "code string, content string")
    got = captions.cues(files).orderBy("cue_idx").collect()
    assert [(r.ts, r.text) for r in got] == [(1.5, "hello there"), (1.5, "and you"), (62.25, "bye & bye")]
    assert {r.code: r.has_payload for r in captions.valid(files).collect()} == {"a": True, "b": False, "c": False}
    assert [r.text for r in captions.sentence_parts(captions.cues(files)).orderBy("cue_idx").collect()] == ["hello there", "and you.", "bye & bye"]


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    source = spark.createDataFrame([(2, "B"), (3, None)], "k int, v string")
    once = R.upsert(target, source, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 1), (2, "B", 2), (3, None, None)]
    assert sorted(map(tuple, R.upsert(once, source, ["k"]).collect())) == sorted(map(tuple, once.collect()))


def test_contained(spark):
    words = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0), (1, 8.0, 8.0, 12.0, 12.0), (2, 0.0, 0.0, 2.0, 2.0)], "page_id int, x0 double, y0 double, x1 double, y1 double")
    boxes = spark.createDataFrame([(1, "r", 0.0, 0.0, 1.0, 1.0)], "page_id int, region_id string, x0 double, y0 double, x1 double, y1 double")
    assert [(r.page_id, r.x0) for r in R.contained(words, boxes).collect()] == [(1, 0.0)]


def test_scalars(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("Jane A. Doe", "3/4/24", 2024, "$1,200.50", " n/a ")], "name string, day string, hint int, money string, gap string")
    r = df.select(X.person_key(F.col("name")).alias("key"), X.month_day_year(F.col("day"), F.col("hint")).cast("string").alias("day"), X.tolerant_double(F.col("money")).alias("money"), X.missing_value(F.col("gap")).alias("gap"), X.full_year(F.lit(99), F.lit(2024)).alias("y"), X.split_people(F.lit("Ann, Bob and Unknown & Cy")).alias("people"), X.trim_marks(F.lit(" -x.,")).alias("t")).first()
    assert (r.key, r.day, r.money, r.gap, r.y, r.people, r.t) == ("JANE DOE", "2024-03-04", 1200.5, True, 1999, ["Ann", "Bob", "Cy"], "x")


def test_flatten_leaves_no_line_out(spark):
    got = QUERIES["snk11_flatten"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count() and got.where("l_orderkey % 10 <> 0").count()


def test_numbered(spark):
    from pyspark.sql import functions as F

    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("s"), F.col("id") % 7)).alias("s"), (F.col("id") * 7919 % 5000).alias("v"))
    want = sorted((r.s or "", r.v) for r in df.collect())
    got = R.numbered(df, [F.col("s"), F.col("v")])
    assert [(r.s or "", r.v) for r in sorted(got.collect(), key=lambda r: r.number)] == want and got.columns == ["s", "v", "number"]
    assert sorted(r.number for r in got.collect()) == list(range(1, 5001)) and R.numbered(df.limit(0), [F.col("v")]).count() == 0


def test_renumber_all_parts(spark):
    got = QUERIES["srt08_renumber"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/part.parquet").count()
    assert "SinglePartition" not in got._jdf.queryExecution().toString()


def test_readme_lists_the_open_survey_ids():
    import re

    import __spark_entry__

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    survey, readme = (open(f"{top}/{f}.md", encoding="utf-8").read() for f in ("SURVEY", "README"))
    named = {n.split("_")[0].upper() for n in __spark_entry__.queries()}
    listed = set()
    for group, numbers in re.findall(r"([A-Z]{3}) (\d\d[-, \d]*)", re.search(r"no query that bears their name: (.*?)\. ", readme)[1]):
        for a, b in re.findall(r"(\d\d)(?:-(\d\d))?", numbers):
            listed |= {f"{group}{i:02d}" for i in range(int(a), int(b or a) + 1)}
    assert listed == set(re.findall(r"^\| ([A-Z]{3}\d\d) \|", survey, re.M)) - named


def _against_sql(spark, folder, name, table, frame):
    frame.to_parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    got, want = QUERIES[name](spark, str(folder)).toPandas(), con.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
    return got


def test_stable_choice_of_large_and_missing_keys(spark, tmp_path):
    """Keys above 100,000 outweigh points of score and words."""
    few = [(1, 101), (1, 250000), (2, 36), (2, 200020), (2, 200015), (3, None), (3, 7), (4, None), (None, 5), (None, 300001)]
    keys = few + [(10 + i % 300, i * 7919 % 9_000_000) for i in range(6000)]
    got = _against_sql(spark, tmp_path, "cls18_stable_choice", "orders", pd.DataFrame(keys, columns=["o_custkey", "o_orderkey"]).astype("Int64"))
    assert got[got.o_custkey == 1].chosen.tolist() == [250000]


def test_gap_clusters_of_missing_quantities(spark, tmp_path):
    """Missing quantities come last, as in SQL, and join the last group."""
    lines = [(1, 1, None), (1, 2, 3.0), (1, 3, 20.0), (1, 4, None), (2, 1, None), (3, 1, 1.0), (3, None, 9.0), (3, 2, 9.0), (3, 3, 15.0), (None, 1, 1.0), (None, 2, 7.0), (4, 1, float("inf")), (4, 2, 5.0), (4, 3, -4.0)]
    frame = pd.DataFrame(lines, columns=["l_orderkey", "l_linenumber", "l_quantity"]).astype({"l_orderkey": "Int64", "l_linenumber": "Int32", "l_quantity": "Float64"})
    got = _against_sql(spark, tmp_path, "win21_gap_clusters", "lineitem", frame)
    assert sorted(got[got.l_orderkey == 1].grp) == [1, 2, 2, 2]


def test_gap_clusters_do_not_hang_on_ties(spark, tmp_path):
    """Rows equal in order, quantity and line stand in one group, however they are dealt and sorted; one sort serves both windows."""
    from pyspark.sql import functions as F

    lines = spark.range(2000).selectExpr("id % 40 AS l_orderkey", "CAST(id % 3 AS int) AS l_linenumber", "CAST(id * 7919 % 50 AS double) AS l_quantity").unionAll(spark.range(1000).selectExpr("100L", "1", "CAST(CASE WHEN id < 500 THEN 1 ELSE 40 END AS double)"))
    for n, seed in ((1, 1), (7, 2), (13, 3)):
        lines.orderBy(F.rand(seed)).repartition(n).write.parquet(f"{tmp_path}/{n}/lineitem.parquet")
        df = QUERIES["win21_gap_clusters"](spark, f"{tmp_path}/{n}")
        got = df.toPandas()
        assert sorted(got[got.l_orderkey == 100].grp) == [1] * 500 + [2] * 500
        assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Sort [") == 1
        if n > 1:
            assert rows(got) == first
        first = rows(got)
