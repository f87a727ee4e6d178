"""Queries of sources, sinks, joins, sets, sorts and gates over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.functions import records as Rec
from gavelframe.functions import text as X
from gavelframe.operators import ledger
from gavelframe.operators import relational as R
from gavelframe.plans import civic
from gavelframe.plans.catalog import Tables, query

L = f"({civic.LINES})"


# sources
@query("SELECT s_suppkey AS id, title, day FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Town Council ' || s_suppkey WHEN 1 THEN 'Public Hearing' WHEN 2 THEN 'Concert in the park' ELSE 'WORK SESSION' END AS title, '2024' || lpad(CAST(1 + s_suppkey % 12 AS VARCHAR), 2, '0') || '05' AS day FROM supplier) WHERE title NOT LIKE 'Concert%' AND s_suppkey % 5 <> 0")
def src04_listing(t: Tables) -> DataFrame:
    """A tab-separated listing: ids of eleven characters and titles of meetings stay."""
    k = F.col("s_suppkey")
    title = F.when(k % 4 == 0, F.concat(F.lit("Town Council "), k.cast("string"))).when(k % 4 == 1, "Public Hearing").when(k % 4 == 2, "Concert in the park").otherwise("WORK SESSION")
    vid = F.when(k % 5 == 0, "short").otherwise(F.format_string("vid%08d", k))
    raw = t.supplier.select(k, F.concat_ws("\t", vid, title, F.format_string("2024%02d05", (1 + k % 12).cast("int"))).alias("line"))
    parts = F.split("line", "\t")
    rows = raw.select(F.col("s_suppkey").alias("id"), parts[0].alias("vid"), parts[1].alias("title"), parts[2].alias("day"))
    return rows.where(F.col("vid").rlike("^[A-Za-z0-9_-]{11}$") & Rec.is_meeting(F.col("title"))).select("id", "title", "day")


@query("SELECT c_custkey, c_custkey % 3 = 0 AS meeting FROM customer")
def src05_meeting_titles(t: Tables) -> DataFrame:
    title = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Regular MEETING of "), "c_mktsegment")).otherwise(F.concat(F.lit("Film on "), "c_mktsegment"))
    return t.customer.select("c_custkey", Rec.is_meeting(title).alias("meeting"))


@query("SELECT page_id, n, url, title, day FROM (SELECT page_id, n, 'https://town.example/files/' || y || '/doc' || (page_id + n) || '.pdf' AS url, CASE WHEN n = 2 THEN 'March 5, 2023 Special Meeting' ELSE 'Agenda of page ' || page_id END AS title, CASE WHEN n = 2 THEN '2023-03-05' END AS day FROM (SELECT page_id, 2022 + page_id % 3 AS y, unnest([1, 2]) AS n FROM pages))")
def src06_agenda_links(t: Tables) -> DataFrame:
    """Anchors to PDF files below a year's folder: absolute address, joined text, and the date that the text begins with."""
    from gavelframe.sources import anchors

    y = (2022 + F.col("page_id") % 3).cast("string")
    doc = lambda n: F.concat(F.lit("/files/"), y, F.lit("/doc"), (F.col("page_id") + n).cast("string"), F.lit(".pdf"))
    made = F.concat(F.lit('<p><a class="x" href="'), doc(1), F.lit('">Agenda <b>of  page</b>\n '), F.col("page_id").cast("string"), F.lit('</a><a href="https://town.example'), doc(2), F.lit('">March 5, 2023 Special Meeting</a><a href="/other.pdf">no year</a>'))
    found = anchors.links(t.pages.select("page_id", F.concat("html", made).alias("html")), "https://town.example/index", r"/files/(\d{4})/[^/]+\.pdf$")
    return found.select("page_id", "n", "url", "title", Rec.long_date(F.col("title")).cast("string").alias("day"))


@query("SELECT page_id, year, url FROM (SELECT page_id, 2020 + page_id % 4 AS year, 'https://town.example/min/' || (2020 + page_id % 4) || '/minutes-' || page_id || '.pdf' AS url FROM pages)")
def src08_crawl(t: Tables) -> DataFrame:
    """Two levels: an index page links to year pages, these link to minutes; each file once."""
    from gavelframe.sources import anchors

    year = (2020 + F.col("page_id") % 4).cast("string")
    index = t.pages.select("page_id", F.concat(F.lit('<a href="/min/'), year, F.lit('">'), year, F.lit("</a>")).alias("html"))
    years = anchors.links(index, "https://town.example/", r"/min/(\d{4})$").select("page_id", F.col("url").alias("page"), F.regexp_extract("url", r"/(\d{4})$", 1).cast("int").alias("year"))
    link = F.concat(F.lit('<a href="'), F.col("page"), F.lit("/minutes-"), F.col("page_id").cast("string"), F.lit('.pdf">Minutes</a>'))
    body = years.withColumn("html", F.concat(link, link, F.lit('<a href="/min/agenda.pdf">Agenda</a>')))
    files = anchors.links(body.select("page_id", "year", "html"), "https://town.example/", r"/minutes[^/]*\.pdf$")
    return files.select("page_id", "year", "url").distinct()


@query("SELECT page_id, 'a b/' || (page_id % 7) || '.pdf' AS source_id FROM pages")
def src09_source_id(t: Tables) -> DataFrame:
    """The unquoted tail of an address's path behind a marker."""
    url = F.concat(F.lit("https://x.example/docs/files/a%20b/"), (F.col("page_id") % 7).cast("string"), F.lit(".pdf?v=1#p"))
    return t.pages.select("page_id", Rec.source_id(url, "/files/").alias("source_id"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '2023-03-' || lpad(CAST(1 + o_custkey % 28 AS VARCHAR), 2, '0') WHEN 1 THEN '2024-05-' || lpad(CAST(1 + o_custkey % 28 AS VARCHAR), 2, '0') WHEN 2 THEN '2022-01-01' ELSE '2022-06-09' END AS day FROM orders")
def src10_created_date(t: Tables) -> DataFrame:
    """A file's date: month name, else M-D-Y, else M-D-x-Y, else January 1 of the hint's year."""
    k, d = F.col("o_orderkey") % 4, (1 + F.col("o_custkey") % 28).cast("string")
    name = F.when(k == 0, F.concat(F.lit("Minutes March "), d, F.lit(", 2023 final"))).when(k == 1, F.concat(F.lit("min 5-"), d, F.lit("-24"))).when(k == 2, "no date here").otherwise("min 6-9-x-22")
    return t.orders.select("o_orderkey", Rec.created_date(name, F.when(k.isin(0, 1), 2024).otherwise(2022)).cast("string").alias("day"))


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN d.n_chars < 100 THEN 'too_small' WHEN l.doc_id IS NULL THEN 'no_factsheet' WHEN l.toxic = 1 THEN 'quarantined' WHEN l.quality IS NULL OR l.quality < 1 THEN 'too_few_pages' ELSE 'accepted' END AS reason FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY reason UNION ALL SELECT 'accepted ids', count(*) FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.n_chars >= 100 AND l.toxic = 0 AND l.quality >= 1")
def src13_gated_scan(t: Tables) -> DataFrame:
    """Files that pass size, factsheet, quarantine and page count, and the reasons of the others; also the accept list."""
    d = t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id", "quality", "toxic").withColumn("has", F.lit(True)), "doc_id", "left")
    reason = F.when(F.col("n_chars") < 100, "too_small").when(F.col("has").isNull(), "no_factsheet").when(F.col("toxic") == 1, "quarantined").when(F.col("quality").isNull() | (F.col("quality") < 1), "too_few_pages").otherwise("accepted")
    judged = d.withColumn("reason", reason)
    accepted = judged.where("reason = 'accepted'").agg(F.count("doc_id").alias("n")).select(F.lit("accepted ids").alias("reason"), "n")
    return judged.groupBy("reason").agg(F.count("*").alias("n")).union(accepted)


RUNS = "'RUN_2024_0' || (1 + o_custkey % 5)"


@query("SELECT o_orderkey FROM orders WHERE o_custkey % 5 = (SELECT max(o_custkey % 5) FROM orders)")
def src15_latest_run(t: Tables) -> DataFrame:
    """Rows of the latest run."""
    return ledger.of_run(t.orders.select("o_orderkey", F.expr(f"'' || {RUNS}").alias("run_id"))).select("o_orderkey")


@query("SELECT 'latest' AS scope, count(*) AS n FROM orders WHERE o_custkey % 5 = (SELECT max(o_custkey % 5) FROM orders) UNION ALL SELECT 'explicit', count(*) FROM orders WHERE o_custkey % 5 = 1 UNION ALL SELECT 'all', count(*) FROM orders")
def src16_run_scope(t: Tables) -> DataFrame:
    """The three scopes of a stage: named run, latest run, all."""
    rows = t.orders.select("o_orderkey", F.expr(f"'' || {RUNS}").alias("run_id"))
    count = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("scope"), "n")
    return count("latest", ledger.of_run(rows)).union(count("explicit", ledger.of_run(rows, "RUN_2024_02"))).union(count("all", ledger.of_run(rows, every=True)))


@query("SELECT o_custkey, min_by(o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 WHEN o_orderkey % 3 = 1 THEN 1 ELSE 2 END * 1000000000 + o_orderkey) AS factsheet FROM orders GROUP BY o_custkey")
def src17_factsheet(t: Tables) -> DataFrame:
    """The factsheet of a record: the named path, else that of its code, else the first by name."""
    rank = F.when(F.col("o_orderkey") % 3 == 0, 0).when(F.col("o_orderkey") % 3 == 1, 1).otherwise(2)
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct(rank, F.col("o_orderkey"))).alias("factsheet"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def src18_jsonl(t: Tables) -> DataFrame:
    """Lines of JSON."""
    return t.events.select("event_id", F.from_json("props", "k long").getField("k").alias("k"))


@query("SELECT doc_id, n, page FROM (SELECT doc_id, unnest(range(1, 4)) AS n, unnest([text, '', '']) AS page FROM documents WHERE doc_id % 2 = 0) UNION ALL SELECT doc_id, n, CASE n WHEN 1 THEN 'a' WHEN 2 THEN '' ELSE text END FROM (SELECT doc_id, text, unnest(range(1, 4)) AS n FROM documents WHERE doc_id % 2 <> 0)")
def src21_page_split(t: Tables) -> DataFrame:
    """Form feeds split pages; blank pages at the end go, then the list is padded or cut to the page count, here 3."""
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("\f\f \f"))).otherwise(F.concat(F.lit("a\f\f"), "text", F.lit("\fpage 4")))
    return t.documents.select("doc_id", F.posexplode(Rec.form_feed_pages(raw, F.lit(3))).alias("n", "page")).select("doc_id", (F.col("n") + 1).cast("long").alias("n"), "page")


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def src24_full_text(t: Tables) -> DataFrame:
    """A record's pages in file order as one text."""
    pages = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("p"))
    return pages.select("conv_id", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))


@query("SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'bad_run_id' END, CASE WHEN o_orderkey % 7 = 0 THEN 'bad_name' END, CASE WHEN o_custkey % 90 > 50 THEN 'too_large' END, CASE WHEN o_orderkey % 11 = 0 THEN 'no_pages' END, CASE WHEN o_orderkey % 11 = 1 THEN 'too_many_pages' END], lambda x: x IS NOT NULL), ',') AS errors FROM orders")
def src25_input_errors(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    run = F.when(k % 5 == 0, "RUN_24").otherwise("RUN_2024_01_02_AB0F")
    name = F.when(k % 7 == 0, "../x.pdf").otherwise("Packet_1-a.PDF")
    pages = F.when(k % 11 == 0, 0).when(k % 11 == 1, 2001).otherwise(12)
    return t.orders.select("o_orderkey", F.array_join(Rec.input_errors(name, F.col("o_custkey") % 90 * 10 * 1024 * 1024, pages, run), ",").alias("errors"))


@query("SELECT o_custkey, 'rec' || o_custkey || '/' || min(o_orderkey) || CASE WHEN bool_or(o_orderkey % 2 = 0) THEN '.parse.json' ELSE '.preparse.json' END AS path FROM (SELECT *, min(o_orderkey % 2) OVER (PARTITION BY o_custkey) AS best FROM orders) WHERE o_orderkey % 2 = best GROUP BY o_custkey")
def src26_prefer_format(t: Tables) -> DataFrame:
    """Of a record's files the first .parse.json, else the first .preparse.json."""
    path = F.concat(F.lit("rec"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".parse.json").otherwise(".preparse.json"))
    files = t.orders.select("o_custkey", "o_orderkey", path.alias("path"))
    return files.groupBy("o_custkey").agg(F.min_by("path", F.struct(F.when(F.col("path").endswith(".preparse.json"), 1).otherwise(0), F.col("o_orderkey"))).alias("path"))


@query("SELECT CASE WHEN o_custkey % 5 = (SELECT max(o_custkey % 5) FROM orders) THEN 'in_scope' ELSE 'skipped_source_scope' END AS scope, count(*) AS n FROM orders GROUP BY 1")
def src27_push_scope(t: Tables) -> DataFrame:
    """Records of the latest run are in scope, the others are counted as skipped."""
    rows = t.orders.select("o_orderkey", F.expr(f"'' || {RUNS}").alias("run_id"))
    inside = ledger.of_run(rows).select("o_orderkey").withColumn("in", F.lit(True))
    return rows.join(inside, "o_orderkey", "left").groupBy(F.when(F.col("in"), "in_scope").otherwise("skipped_source_scope").alias("scope")).agg(F.count("*").alias("n"))


@query("SELECT 'nation' AS \"table\", CAST(i AS INTEGER) AS ordinal, c AS \"column\" FROM (SELECT unnest([1, 2, 3]) AS i, unnest(['n_nationkey', 'n_name', 'n_regionkey']) AS c)")
def src28_schema(t: Tables) -> DataFrame:
    """Columns of a table in their order."""
    return ledger.schema_rows(t.nation, "nation", t.spark).select("table", "ordinal", "column")


@query("SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'download_failed' WHEN doc_id % 9 = 1 THEN 'empty' WHEN doc_id % 9 = 2 THEN 'too_small' WHEN doc_id % 9 = 3 THEN 'non_pdf' END AS reject FROM documents")
def src29_typed_rejects(t: Tables) -> DataFrame:
    """Why a download is no PDF: failed, empty, too small, or without %PDF- in its first 32 bytes."""
    k = F.col("doc_id") % 9
    pad = F.repeat(F.lit("x"), 100)
    body = F.when(k == 1, "").when(k == 2, "%PDF-1").when(k == 3, F.concat(F.repeat(F.lit(" "), 30), F.lit("%PDF-1.4"), pad)).when(k != 0, F.concat(F.lit("﻿ \n%PDF-1.7"), pad))
    return t.documents.select("doc_id", Rec.pdf_reject(F.encode(body, "utf-8"), 100).alias("reject"))


# filters
@query("SELECT doc_id AS code FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM documents) WHERE r <= 150 AND NOT (doc_id % 3 = 0 AND doc_id % 2 = 0)")
def flt02_two_digests(t: Tables) -> DataFrame:
    """Latest capture per code, then the limit of 150 codes, then without what both digests and outputs say is done."""
    d = t.documents.select(F.col("doc_id").alias("code"), F.sha2("text", 256).alias("text_sha"), F.md5("text").alias("facts_sha"))
    stage = d.withColumn("captured_at", F.lit(2)).withColumn("path", F.lit("b")).unionByName(d.withColumn("text_sha", F.lit("old")).withColumn("captured_at", F.lit(1)).withColumn("path", F.lit("a")))
    state = d.where("code % 3 = 0").withColumn("outputs_exist", F.col("code") % 2 == 0)
    return ledger.incremental(stage, state, 150).select("code")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0")
def flt03_manifest(t: Tables) -> DataFrame:
    """Records that the manifest does not list yet."""
    listed = t.customer.where("c_custkey % 4 = 0").select("c_custkey")
    return t.customer.select("c_custkey").join(listed, "c_custkey", "left_anti")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')")
def flt04_dispositions(t: Tables) -> DataFrame:
    """A list as a user types it."""
    return t.orders.where(F.col("o_orderstatus").isin(*ledger.allowed_dispositions(" f, p ,,"))).select("o_orderkey")


@query("SELECT c_custkey // 100 AS pulse, count(*) AS n, count(*) = 100 AS matches FROM customer WHERE starts_with(c_name, 'Customer#0000') GROUP BY 1")
def flt05_prefix_counts(t: Tables) -> DataFrame:
    """Rows of a prefix, and whether their number is the expected one."""
    n = t.customer.where(F.col("c_name").startswith("Customer#0000")).groupBy(F.floor(F.col("c_custkey") / 100).alias("pulse")).agg(F.count("*").alias("n"))
    return n.select("pulse", "n", (F.col("n") == 100).alias("matches"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0 OR (o_orderkey % 5 = 1 AND o_orderkey % 2 = 0) OR (o_orderkey % 5 = 2 AND o_orderkey % 3 = 0)")
def flt06_agenda_pages(t: Tables) -> DataFrame:
    """Pages by their tags; without tags by one of two type columns."""
    k = F.col("o_orderkey")
    tags = F.when(k % 5 == 0, F.array(F.lit("x"), F.lit("agenda"))).when(k % 5 > 2, F.array(F.lit("minutes")))
    page = t.orders.select(k, tags.alias("tags"), F.when((k % 5 == 1) & (k % 2 == 0), "agenda").alias("page_type"), F.when((k % 5 == 2) & (k % 3 == 0), "agenda").alias("function_type"))
    return page.where(Rec.has_kind(F.col("tags"), [F.col("page_type"), F.col("function_type")], "agenda")).select("o_orderkey")


@query("SELECT o_custkey % 10 AS prefix, CASE WHEN o_orderkey % 4 < 2 THEN 'untitled' ELSE 'titled' END AS kind, count(*) AS n, bool_or(o_orderstatus = 'F') AS has_required FROM orders GROUP BY 1, 2")
def flt08_untitled(t: Tables) -> DataFrame:
    """Items without a title, null or empty, by the prefix of their ids, and whether the required section is among them."""
    k = F.col("o_orderkey") % 4
    items = t.orders.select(F.concat((F.col("o_custkey") % 10).cast("string"), F.lit(".SCF")).alias("id"), F.when(k == 0, None).when(k == 1, "").otherwise("t").alias("title"), "o_orderstatus")
    kind = F.when(F.coalesce("title", F.lit("")) == "", "untitled").otherwise("titled")
    return items.groupBy(F.substring_index("id", ".", 1).cast("long").alias("prefix"), kind.alias("kind")).agg(F.count("*").alias("n"), F.bool_or(F.col("o_orderstatus") == "F").alias("has_required"))


# joins, sets, sorts
@query("SELECT o_orderkey AS fact_id, c_name AS canonical_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'")
def joi01_existing_entities(t: Tables) -> DataFrame:
    """Observations of a source with their registry entry."""
    facts = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("fact_id"), F.col("o_custkey").alias("c_custkey"))
    return facts.join(t.customer.select("c_custkey", "c_name"), "c_custkey").orderBy("fact_id").select("fact_id", F.col("c_name").alias("canonical_name"))


@query("SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ' ' ORDER BY l_quantity, l_linenumber, l_partkey) AS words FROM lineitem GROUP BY l_orderkey")
def joi05_line_words(t: Tables) -> DataFrame:
    """A line's words from left to right."""
    w = F.concat(F.col("l_linenumber").cast("string"), F.lit(":"), F.col("l_partkey").cast("string"))
    words = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_quantity", "l_linenumber", "l_partkey", w.alias("w")))).alias("ws"))
    return words.select("l_orderkey", F.array_join(F.transform("ws", lambda x: x["w"]), " ").alias("words"))


@query("SELECT r_name, n_name AS first_nation FROM region JOIN (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS r FROM nation) ON r_regionkey = n_regionkey WHERE r = 1")
def joi08_first_match(t: Tables) -> DataFrame:
    """For each key the first match in the candidates' order."""
    first = t.nation.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.min_by("n_name", "n_nationkey").alias("first_nation"))
    return t.region.join(first, "r_regionkey").select("r_name", "first_nation")


@query(f"SELECT doc, name, CAST(sum(n) AS BIGINT) AS n FROM (SELECT doc, unnest(['MOTION', 'COUNCIL', 'BUDGET', 'MINUTES', 'OAK HILL STREET']) AS name, unnest([len(regexp_extract_all(upper(line), '\\bMOTION\\b')), len(regexp_extract_all(upper(line), '\\bCOUNCIL\\b')), len(regexp_extract_all(upper(line), '\\bBUDGET\\b')), len(regexp_extract_all(upper(line), '\\bMINUTES\\b')), len(regexp_extract_all(upper(line), '\\bOAK HILL STREET\\b'))]) AS n FROM {L}) GROUP BY doc, name HAVING sum(n) > 0")
def joi10_known_names(t: Tables) -> DataFrame:
    """Every known name in every line, bounded by word edges: one pass with one expression of all names."""
    from gavelframe.operators import entities

    names = ("Motion", "Council", "Budget", "Minutes", "Oak Hill Street")
    found = entities.known_names(civic.lines(t), names)
    return found.groupBy("doc", "name").agg(F.sum("n").cast("long").alias("n"))


@query("SELECT c_nationkey, array_to_string(list_sort(list_filter(src, lambda x: NOT list_contains(db, x))), ',') AS missing, CASE WHEN len(src) > 0 THEN round(len(list_intersect(src, db)) / len(src), 4) ELSE 1.0 END AS coverage FROM (SELECT c_nationkey, list(DISTINCT c_mktsegment) AS src, coalesce(list(DISTINCT c_mktsegment) FILTER (c_acctbal > 5000), []) AS db FROM customer GROUP BY 1)")
def set01_coverage(t: Tables) -> DataFrame:
    """What the source has and the store lacks, and the share that it has."""
    sets = t.customer.groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("src"), F.collect_set(F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment"))).alias("db"))
    return sets.select("c_nationkey", F.array_join(F.array_sort(F.array_except("src", "db")), ",").alias("missing"), F.when(F.size("src") > 0, F.round(F.size(F.array_intersect("src", "db")) / F.size("src"), 4)).otherwise(F.lit(1.0)).alias("coverage"))


@query("SELECT conv_id, string_agg(w, ' ' ORDER BY p) AS words FROM (SELECT conv_id, w, min(p) AS p FROM (SELECT conv_id, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM (SELECT conv_id, regexp_extract_all(string_agg(text, ' ' ORDER BY turn), '[A-Za-z]+') AS t FROM conversations GROUP BY conv_id)) GROUP BY 1, 2) GROUP BY conv_id")
def set04_ordered_distinct(t: Tables) -> DataFrame:
    """Distinct values in the order of their first occurrence."""
    talks = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("ts"))
    text = talks.select("conv_id", F.array_join(F.transform("ts", lambda x: x["text"]), " ").alias("text"))
    words = F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)))
    return text.select("conv_id", words.alias("w")).where(F.size("w") > 0).select("conv_id", F.array_join("w", " ").alias("words"))


@query("SELECT o_custkey, 'new' AS change FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') a WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderstatus = 'P') UNION ALL SELECT o_custkey, 'gone' FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') a WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderstatus = 'F')")
def set05_queue_changes(t: Tables) -> DataFrame:
    """What a queue gained and lost between two listings."""
    after, before = (t.orders.where(F.col("o_orderstatus") == s).select("o_custkey") for s in ("F", "P"))
    status = R.reconcile(before, after, ["o_custkey"])
    return status.where("status <> 'kept'").select("o_custkey", F.when(F.col("status") == "added", "new").otherwise("gone").alias("change"))


@query("SELECT o_orderkey FROM orders ORDER BY CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR) LIMIT 3")
def srt01_first_items(t: Tables) -> DataFrame:
    """The first three items by ordinals that are text, so that they sort as text."""
    return t.orders.orderBy(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).limit(3).select("o_orderkey")


@query("SELECT o_custkey, o_orderpriority AS best FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY length(o_orderpriority) DESC, o_orderpriority) AS r FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)) WHERE r = 1")
def srt05_best_candidate(t: Tables) -> DataFrame:
    """The best of a set by score, then by the text itself."""
    d = t.orders.select("o_custkey", "o_orderpriority").distinct()
    return d.groupBy("o_custkey").agg(F.min(F.struct(-F.length("o_orderpriority"), F.col("o_orderpriority").alias("p"))).alias("x")).select("o_custkey", F.col("x.p").alias("best"))


@query("SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def srt06_newest(t: Tables) -> DataFrame:
    return t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(25).select("event_id")


@query("SELECT doc, array_to_string(list_transform(list_sort(list({'s': line_no, 'e': line_no + n, 'k': k})), lambda x: x.s || '-' || x.e || x.k), ' ') AS spans FROM (SELECT doc, line_no, length(line) % 4 AS n, CASE WHEN line LIKE '%otion%' THEN 'm' ELSE 'v' END AS k FROM " + L + " WHERE regexp_matches(line, '[Mm]otion|[Vv]ote')) GROUP BY doc")
def srt10_span_order(t: Tables) -> DataFrame:
    """Spans by start, end and kind."""
    d = civic.lines(t).where(F.col("line").rlike("[Mm]otion|[Vv]ote"))
    span = F.struct("line_no", (F.col("line_no") + F.length("line") % 4).alias("e"), F.when(F.col("line").contains("otion"), "m").otherwise("v").alias("k"))
    spans = d.groupBy("doc").agg(F.array_sort(F.collect_list(span)).alias("s"))
    return spans.select("doc", F.array_join(F.transform("s", lambda x: F.concat(x["line_no"].cast("string"), F.lit("-"), x["e"].cast("string"), x["k"])), " ").alias("spans"))


# sinks
@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'moved ' || c_name ELSE c_name END AS c_name, c_acctbal FROM customer UNION ALL SELECT -1 - s_suppkey, s_name, NULL FROM supplier")
def snk03_migrate(t: Tables) -> DataFrame:
    """An upsert of those columns only that the target has; new keys come, no child goes."""
    target = t.customer.select("c_custkey", "c_name", "c_acctbal")
    moved = t.customer.where("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("moved "), "c_name").alias("c_name"))
    new = t.supplier.select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"))
    return ledger.migrate(target, moved.union(new).withColumn("unknown_column", F.lit("x")), ["c_custkey"])


ENTITIES = "SELECT 'PEOPLE' AS category, c_name AS name, o_orderstatus AS source_id, o_orderpriority AS fact_key, 'seen ' || (o_orderkey % 2) AS evidence FROM orders JOIN customer ON o_custkey = c_custkey"
_RID = "'PEOPLE_' || regexp_replace(regexp_replace(upper({0}), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(f"""WITH e AS ({ENTITIES}) SELECT 'registry' AS kind, count(*) AS n FROM (SELECT DISTINCT {_RID.format('name')} AS id FROM e UNION SELECT 'PEOPLE_OLD') UNION ALL SELECT 'aliases', count(*) FROM (SELECT DISTINCT {_RID.format('name')}, name FROM e) UNION ALL SELECT 'observations', count(*) FROM (SELECT DISTINCT {_RID.format('name')}, source_id, fact_key, evidence FROM e) UNION ALL SELECT 'observations by fact', count(*) FROM (SELECT DISTINCT {_RID.format('name')}, source_id, fact_key FROM e)""")
def snk05_load_entities(t: Tables) -> DataFrame:
    """Registry, aliases and observations after two loads of the same entities."""
    spark = t.spark
    e = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.lit("PEOPLE").alias("category"), F.col("c_name").alias("name"), F.col("o_orderstatus").alias("source_id"), F.col("o_orderpriority").alias("fact_key"), F.concat(F.lit("seen "), (F.col("o_orderkey") % 2).cast("string")).alias("evidence"))
    none = (spark.createDataFrame([("PEOPLE_OLD", "PEOPLE", "old")], "registry_id string, category string, canonical_name string"), spark.createDataFrame([], "registry_id string, alias_name string, source_id string"), spark.createDataFrame([], "registry_id string, source_id string, fact_key string, evidence string"))
    twice = ledger.load_entities(*ledger.load_entities(*none, e), e)
    by_fact = ledger.load_entities(*none, e, with_evidence=False)[2]
    count = lambda kind, df: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count("registry", twice[0]).union(count("aliases", twice[1])).union(count("observations", twice[2])).union(count("observations by fact", by_fact))


@query("SELECT o_custkey AS source_id, o_orderkey AS fact FROM orders WHERE o_custkey % 4 <> 0 UNION ALL SELECT o_custkey, -1 - o_orderkey FROM orders WHERE o_custkey % 4 = 0 AND o_orderstatus = 'F'")
def snk06_replace_source(t: Tables) -> DataFrame:
    """A source's observations are replaced as a whole; sources without new ones keep theirs."""
    have = t.orders.select(F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("fact"))
    new = t.orders.where("o_custkey % 4 = 0 AND o_orderstatus = 'F'").select(F.col("o_custkey").alias("source_id"), (-1 - F.col("o_orderkey")).alias("fact"))
    gone = t.orders.where("o_custkey % 4 = 0 AND o_orderstatus = 'F'").select("o_custkey").distinct()
    kept = have.join(t.orders.where("o_custkey % 4 = 0").select(F.col("o_custkey").alias("source_id")).join(gone, F.col("source_id") == F.col("o_custkey"), "left_anti").distinct(), "source_id", "left_anti")
    return ledger.replace_source(kept, new)


@query("SELECT 'orders' AS kind, count(*) AS n FROM orders WHERE NOT starts_with(CAST(o_orderkey AS VARCHAR), '1') UNION ALL SELECT 'customers', count(*) FROM (SELECT DISTINCT o_custkey FROM orders WHERE NOT starts_with(CAST(o_orderkey AS VARCHAR), '1')) JOIN customer ON o_custkey = c_custkey")
def snk08_prefix_delete(t: Tables) -> DataFrame:
    """Rows of a prefix go, then the parents that nothing refers to."""
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").alias("c_custkey"))
    left, kept = ledger.without_prefix(rows, t.customer.select("c_custkey"), "id", "1", "c_custkey")
    count = lambda kind, df: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count("orders", left).union(count("customers", kept))


@query("SELECT 0 AS n, 'o_orderkey' AS first_column")
def snk09_wipe(t: Tables) -> DataFrame:
    """All rows go, the schema stays."""
    (left,) = ledger.wiped(t.orders)
    return left.agg(F.count("*").cast("int").alias("n")).withColumn("first_column", F.lit(left.columns[0]))


@query("SELECT o_custkey, o_orderkey AS page, 'page_' || lpad(CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR), 4, '0') || '.json' AS file FROM orders WHERE o_orderstatus IN ('F', 'O')")
def snk12_page_files(t: Tables) -> DataFrame:
    """Agenda pages in order, one file name each."""
    rows = t.orders.where(F.col("o_orderstatus").isin("F", "O"))
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return rows.select("o_custkey", F.col("o_orderkey").alias("page"), F.format_string("page_%04d.json", n).alias("file"))


@query("SELECT user_id, CAST(1 + max(CASE WHEN changed THEN n ELSE 0 END) AS INTEGER) AS version FROM (SELECT user_id, user_id % 2 = 0 AS changed, 1 AS n FROM events) GROUP BY user_id")
def snk13_versions(t: Tables) -> DataFrame:
    """A history that keeps all versions; a write that changes nothing adds none."""
    first = t.events.select("user_id").distinct().withColumn("state", F.lit("new")).withColumn("version", F.lit(1))
    again = t.events.select("user_id").distinct().withColumn("state", F.when(F.col("user_id") % 2 == 0, "done").otherwise("new"))
    return ledger.versions(ledger.append_version(first, again, "user_id"), "user_id").select("user_id", "version")


@query("SELECT user_id, count(*) AS logged, max_by(event_type, event_id) AS latest FROM events GROUP BY user_id")
def snk15_log_and_snapshot(t: Tables) -> DataFrame:
    """An appended log and the latest state that follows from it."""
    old, new = t.events.where("event_id % 2 = 0"), t.events.where("event_id % 2 = 1")
    log = old.select("user_id", "event_id", "event_type").unionByName(new.select("user_id", "event_id", "event_type"))
    return log.groupBy("user_id").agg(F.count("*").alias("logged"), F.max_by("event_type", "event_id").alias("latest"))


@query("SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN doc_id % 5 = 0 THEN 'skipped_unchanged' WHEN lang IS NULL OR lang NOT IN ('en', 'fr') THEN 'skipped_disposition' WHEN n_chars < 100 THEN 'failed' ELSE 'pushed' END AS outcome FROM documents) GROUP BY outcome UNION ALL SELECT 'rows in target', count(*) FROM documents WHERE doc_id % 5 = 0 OR (lang IN ('en', 'fr') AND n_chars >= 100)")
def snk16_push(t: Tables) -> DataFrame:
    """A push with incremental skip, disposition filter and failed rows: its summary, and the target after it."""
    d = t.documents.select(F.col("doc_id").alias("code"), F.sha2("text", 256).alias("sha256"), F.col("lang").alias("disposition"), F.when(F.col("n_chars") < 100, "too short").alias("error"))
    before = d.where("code % 5 = 0").select("code", "sha256")
    state = before.withColumn("last_status", F.lit("pushed"))
    kids = before.select("code").withColumn("row", F.lit(1))
    target, _, _, summary = ledger.pushed(before, kids, d, d.select("code").withColumn("row", F.lit(1)), state, ("EN", "FR"))
    return summary.union(target.agg(F.count("*").alias("n")).select(F.lit("rows in target"), "n"))


@query("SELECT o_custkey, o_orderkey AS entity, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders")
def snk17_entity_snapshot(t: Tables) -> DataFrame:
    """Nested entities as one row each."""
    records = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("es"))
    return records.select("o_custkey", F.posexplode("es").alias("p", "entity")).select("o_custkey", "entity", (F.col("p") + 1).cast("long").alias("n"))


@query("SELECT conv_id, string_agg(format('{:02d}:{:02d}', CAST((turn * 300 + 7) // 60 AS INTEGER), CAST((turn * 300 + 7) % 60 AS INTEGER)) || ' ' || length(text), chr(10) ORDER BY turn) AS vtt FROM conversations GROUP BY conv_id")
def snk18_reassemble(t: Tables) -> DataFrame:
    """Chunks of 300 seconds put together with times from the start of the whole."""
    start = F.col("turn") * 300 + 7
    cue = F.concat(F.format_string("%02d:%02d ", F.floor(start / 60).cast("int"), (start % 60).cast("int")), F.length("text").cast("string"))
    cues = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", cue.alias("cue")))).alias("c"))
    return cues.select("conv_id", F.array_join(F.transform("c", lambda x: x["cue"]), "\n").alias("vtt"))


@query("SELECT o_custkey, '## ' || o_custkey || chr(10) || string_agg('- ' || n || '. ' || o_orderpriority, chr(10) ORDER BY n) AS scaffold FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) GROUP BY o_custkey")
def snk19_scaffold(t: Tables) -> DataFrame:
    """Sections with numbered items as text."""
    items = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("i"))
    lines = F.transform("i", lambda x, n: F.concat(F.lit("- "), (n + 1).cast("string"), F.lit(". "), x["o_orderpriority"]))
    return items.select("o_custkey", F.concat(F.lit("## "), F.col("o_custkey").cast("string"), F.lit("\n"), F.array_join(lines, "\n")).alias("scaffold"))


@query("SELECT CAST(row_number() OVER (ORDER BY n DESC, p_brand) AS INTEGER) AS n, p_brand || ': ' || n AS line FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) ORDER BY 1 LIMIT 30")
def snk20_report(t: Tables) -> DataFrame:
    """The thirty most frequent as lines of a report."""
    g = t.part.groupBy("p_brand").agg(F.count("*").alias("c"))
    return ledger.top_report(g, [F.desc("c"), F.asc("p_brand")], F.concat("p_brand", F.lit(": "), F.col("c").cast("string")), 30)


@query("SELECT o_custkey, least(count(*), 3) AS kept, greatest(count(*) - 3, 0) AS removed FROM orders GROUP BY 1")
def snk21_retention(t: Tables) -> DataFrame:
    """The newest three of each group stay; how many went."""
    return ledger.retention(t.orders, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], 3)[1]


@query("SELECT sha, CASE WHEN min(doc_id) FILTER (canonical) IS NOT NULL THEN min(doc_id) FILTER (canonical) ELSE min(doc_id) END AS kept, count(*) AS copies FROM (SELECT sha256(text) AS sha, doc_id, doc_id % 3 = 0 AS canonical FROM documents) GROUP BY sha")
def snk22_content_dedupe(t: Tables) -> DataFrame:
    """One file of each content; one with a canonical name if there is any, else the first."""
    d = t.documents.select(F.sha2("text", 256).alias("sha"), "doc_id")
    return d.groupBy("sha").agg(F.min_by("doc_id", F.struct(F.when(F.col("doc_id") % 3 == 0, 0).otherwise(1), F.col("doc_id"))).alias("kept"), F.count("*").alias("copies"))


@query("SELECT o_custkey, string_agg(o_orderpriority, chr(10) ORDER BY f) AS bundle FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS f FROM orders GROUP BY 1, 2) GROUP BY 1")
def snk24_bundle(t: Tables) -> DataFrame:
    """A source's distinct blocks in their first order as one text."""
    blocks = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("b"))
    return blocks.select("o_custkey", F.array_join(F.array_distinct(F.transform("b", lambda x: x["o_orderpriority"])), "\n").alias("bundle"))


# aggregates and gates
@query("SELECT source, pages, passed, warned, failed, unverifiable, CASE WHEN comparable > 0 THEN round(passed / comparable, 4) ELSE 0.0 END AS pass_ratio, CASE WHEN comparable > 0 THEN round((passed + warned) / comparable, 4) ELSE 0.0 END AS accepted_ratio, CASE WHEN comparable > 0 THEN round(failed / comparable, 4) ELSE 0.0 END AS fail_ratio, missing FROM (SELECT source, count(*) AS pages, count(*) FILTER (s = 'pass') AS passed, count(*) FILTER (s = 'warn') AS warned, count(*) FILTER (s = 'fail') AS failed, count(*) FILTER (s = 'unverifiable') AS unverifiable, count(*) FILTER (s <> 'unverifiable') AS comparable, CAST(10 - count(DISTINCT doc_id % 10) AS BIGINT) AS missing FROM (SELECT source, doc_id, CASE WHEN n_chars < 200 THEN 'unverifiable' WHEN n_chars % 10 >= 4 THEN 'pass' WHEN n_chars % 10 >= 2 THEN 'warn' ELSE 'fail' END AS s FROM documents) GROUP BY source)")
def agg03_run_rollup(t: Tables) -> DataFrame:
    """Counts by status and ratios over the comparable pages, and how many of ten expected pages are missing."""
    d = t.documents.select("source", (F.col("doc_id") % 10).alias("page"), X.page_status((F.col("n_chars") % 10 + 45) / 61.0 + F.when(F.col("n_chars") % 10 >= 4, 0.2).when(F.col("n_chars") % 10 >= 2, 0.0).otherwise(-0.5), F.col("n_chars") >= 200).alias("status"))
    return X.status_rollup(d, "source", 10)


@query(f"SELECT sha256(n) AS text_hash, count(*) AS page_count, array_to_string(list_sort(list(doc_id)), ',') AS members FROM (SELECT doc_id, trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS n FROM documents) WHERE length(n) >= 40 GROUP BY n HAVING count(*) > 1")
def agg02_duplicate_groups(t: Tables) -> DataFrame:
    """Pages of equal normalised text, with their members in order, the largest group first.

    A list of members is as long as the group; X.duplicate_groups(members=False) gives counts alone for groups without a bound.
    """
    return X.duplicate_groups(t.documents, "doc_id", "text").select("text_hash", "page_count", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("members"))


@query("SELECT kind, label, n FROM (SELECT 'category' AS kind, event_type AS label, count(DISTINCT user_id) AS n FROM events GROUP BY 2) UNION ALL SELECT 'top', label, n FROM (SELECT CAST(user_id AS VARCHAR) AS label, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, label LIMIT 25)")
def agg06_counters(t: Tables) -> DataFrame:
    """Distinct sources of each category, and the most frequent labels."""
    a = t.events.groupBy(F.col("event_type").alias("label")).agg(F.count_distinct("user_id").alias("n")).select(F.lit("category").alias("kind"), "label", "n")
    b = t.events.groupBy(F.col("user_id").cast("string").alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(25).select(F.lit("top").alias("kind"), "label", "n")
    return a.union(b)


@query("SELECT l_suppkey, round(0.75::DOUBLE * ok / n + 0.15::DOUBLE * o / n + 0.1::DOUBLE * CASE WHEN o = 0 THEN 1.0::DOUBLE ELSE clean / o END, 9) AS reports, round(0.7::DOUBLE * ok / n + 0.2::DOUBLE * CASE WHEN o = 0 THEN 1.0::DOUBLE ELSE clean / o END + 0.1::DOUBLE * o / n, 9) AS sessions FROM (SELECT l_suppkey, count(*)::DOUBLE AS n, count(*) FILTER (l_returnflag = 'N')::DOUBLE AS ok, count(*) FILTER (l_linestatus = 'O')::DOUBLE AS o, count(*) FILTER (l_linestatus = 'O' AND l_discount < 0.05)::DOUBLE AS clean FROM lineitem GROUP BY 1)")
def agg07_integrity(t: Tables) -> DataFrame:
    """Both weighted integrities: reports by anchors, excerpts and clean ones; sessions by anchors, reasons and coverage."""
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "N").alias("ok"), F.count_if(F.col("l_linestatus") == "O").alias("o"), F.count_if((F.col("l_linestatus") == "O") & (F.col("l_discount") < 0.05)).alias("clean"))
    n, ok, o, clean = (F.col(c) for c in ("n", "ok", "o", "clean"))
    return counts.select("l_suppkey", F.round(X.report_integrity(ok, n, o, n, clean, o), 9).alias("reports"), F.round(X.session_integrity(ok, n, clean, o, o, n), 9).alias("sessions"))


CHECKS = ("too_many", "too_cheap", "no_tax", "late", "odd_part", "flagged", "big_price", "seventh")
_FAIL = ("l_quantity > 45", "l_discount > 0.09", "l_tax = 0", "l_linestatus = 'O' AND l_returnflag = 'R'", "l_partkey % 97 = 0", "l_returnflag = 'A' AND l_discount = 0", "l_extendedprice > 90000", "l_linenumber = 7 AND l_quantity < 3")


@query(f"SELECT failures, count(*) AS documents, count(*) FILTER (failures = '') > 0 AS some_pass FROM (SELECT l_orderkey, array_to_string(list_filter([{', '.join(f'CASE WHEN bool_or({c}) THEN {chr(39)}{n}{chr(39)} END' for n, c in zip(CHECKS, _FAIL))}], lambda x: x IS NOT NULL), ',') AS failures FROM lineitem GROUP BY l_orderkey) GROUP BY failures UNION ALL SELECT 'pass rate', count(*), avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) >= 0.95 FROM (SELECT l_orderkey, NOT bool_or({' OR '.join(_FAIL)}) AS ok FROM lineitem GROUP BY 1)")
def agg08_failure_sets(t: Tables) -> DataFrame:
    """Eight checks of each document, the sets of failures, and whether the pass rate reaches 0.95."""
    failed = [F.when(F.bool_or(F.expr(c)), F.lit(n)) for n, c in zip(CHECKS, _FAIL)]
    docs = t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.array_compact(F.array(*failed)), ",").alias("failures"))
    sets = docs.groupBy("failures").agg(F.count("*").alias("documents"), (F.count_if(F.col("failures") == "") > 0).alias("some_pass"))
    rate = docs.agg(F.count("*").alias("documents"), (F.avg((F.col("failures") == "").cast("int")) >= 0.95).alias("some_pass"))
    return sets.union(rate.select(F.lit("pass rate"), "documents", "some_pass"))


@query("SELECT user_id, max(value) AS peak, round(avg(value), 6) AS mean, min(value) AS least, count(*) AS samples, round(count(*) / greatest(date_diff('second', min(ts), max(ts)), 1) * 60, 6) AS per_minute FROM events GROUP BY user_id")
def agg12_samples(t: Tables) -> DataFrame:
    """Peak, mean and least of a run's samples, and samples a minute."""
    seconds = F.greatest(F.unix_timestamp(F.max(F.date_trunc("second", "ts"))) - F.unix_timestamp(F.min(F.date_trunc("second", "ts"))), F.lit(1))
    return t.events.groupBy("user_id").agg(F.max("value").alias("peak"), F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("least"), F.count("*").alias("samples"), F.round(F.count("*") / seconds * 60, 6).alias("per_minute"))


@query("SELECT o_custkey, count(*) AS orders, bool_or(o_orderstatus = 'F') AS any_final, max(o_totalprice) AS top, array_to_string(list_sort(list(DISTINCT strftime(o_orderdate, '%Y-%m-%d'))), ',') AS dates, count(*) FILTER (o_totalprice > 300000) AS strong, count(*) FILTER (o_totalprice <= 300000) AS weak FROM orders GROUP BY 1")
def agg13_document_rollup(t: Tables) -> DataFrame:
    dates = F.array_join(F.array_sort(F.collect_set(F.date_format("o_orderdate", "yyyy-MM-dd"))), ",")
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.bool_or(F.col("o_orderstatus") == "F").alias("any_final"), F.max("o_totalprice").alias("top"), dates.alias("dates"), F.count_if(F.col("o_totalprice") > 300000).alias("strong"), F.count_if(F.col("o_totalprice") <= 300000).alias("weak"))


@query("SELECT conv_id, round(sum(length(text)) / count(*), 6) AS per_page, sum(length(text)) / count(*) < 500 OR sum(length(text)) < 1000 AS low, sum(length(trim(text))) = 0 AS likely_empty FROM conversations GROUP BY conv_id")
def agg14_low_text(t: Tables) -> DataFrame:
    """Characters a page; records below 500 a page or 1000 in all are low."""
    return X.low_text(t.conversations.select("conv_id", "text"), "conv_id").select("conv_id", F.round("per_page", 6).alias("per_page"), "low", "likely_empty")


@query("SELECT conv_id FROM (SELECT conv_id, sum(length(text)) AS n, count(*) AS p FROM conversations GROUP BY 1) WHERE n / p < 500 OR n < 1000 ORDER BY n, conv_id LIMIT 20")
def gat10_rerun(t: Tables) -> DataFrame:
    """The twenty records with the least text, to be recognised again."""
    low = X.low_text(t.conversations.select("conv_id", "text"), "conv_id").where("low")
    return low.orderBy("total", "conv_id").limit(20).select("conv_id")


@query("SELECT c_nationkey, count(*) AS total, count(*) FILTER (c_acctbal > 0) AS passed, count(*) FILTER (c_acctbal <= 0) AS failed FROM customer GROUP BY 1")
def agg15_batch_totals(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_nationkey").agg(F.count("*").alias("total"), F.count_if(F.col("c_acctbal") > 0).alias("passed"), F.count_if(F.col("c_acctbal") <= 0).alias("failed"))


_AUDIT = {
    "factsheets": "CASE WHEN c_custkey % 50 = 0 THEN 2 ELSE 1 END", "texts": "CASE WHEN c_custkey % 50 = 1 THEN 0 ELSE 1 END", "source_name": "CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_name END", "hash_ok": "c_custkey % 17 <> 0", "pages_match": "c_custkey % 19 <> 0",
    "meetings": "1 - CAST(c_custkey % 23 = 0 AS INTEGER)", "items": "c_custkey % 4", "expected": "CASE WHEN c_custkey % 7 = 0 THEN 9 ELSE c_custkey % 4 END", "tokens": "c_custkey % 40", "lexical_coverage": "CAST((80 + c_custkey % 21) / 100.0 AS DOUBLE)", "ledger": "CASE WHEN c_custkey % 29 = 0 THEN 'FAILED' ELSE 'DONE' END",
}
_ERRORS = [("factsheet_missing_or_multiple", "factsheets <> 1"), ("text_missing_or_multiple", "texts <> 1"), ("factsheet_source_name_missing", "source_name = ''"), ("source_hash_mismatch", "NOT hash_ok"), ("page_json_count_mismatch", "NOT pages_match"), ("db_meeting_missing", "meetings <= 0"), ("zero_items", "items = 0"), ("db_items_mismatch", "items <> expected"),
    ("metadata_completeness_low", "c_custkey % 5 = 0"), ("signal_terms_missing", "c_custkey % 31 = 0"), ("ord_res_refs_missing", "c_custkey % 37 = 0"), ("lexical_coverage_low", "tokens >= 20 AND lexical_coverage < 0.95"), ("ledger_not_done", "ledger <> 'DONE'")]


@query(f"SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'missing_location,' ELSE '' END || array_to_string(list_filter([{', '.join(f'CASE WHEN {c} THEN {chr(39)}{n}{chr(39)} END' for n, c in _ERRORS)}], lambda x: x IS NOT NULL), ',') AS errors FROM (SELECT c_custkey, {', '.join(f'{x} AS {n}' for n, x in _AUDIT.items())} FROM customer)")
def gat04_packet_audit(t: Tables) -> DataFrame:
    """All that an audit of a packet finds: files, digests, counts, metadata, terms, references, vocabulary, ledger."""
    k = F.col("c_custkey")
    given = t.customer.select("c_custkey", *[F.expr(x).alias(n) for n, x in _AUDIT.items()])
    none = F.array().cast("array<string>")
    c = {n: F.col(n) for n in _AUDIT} | {"required": F.array(*map(F.lit, ("meeting_type", "meeting_date", "location"))), "missing": F.when(k % 5 == 0, F.array(F.lit("location"))).otherwise(none), "missing_terms": F.when(k % 31 == 0, F.array(F.lit("budget"))).otherwise(none), "missing_refs": F.when(k % 37 == 0, F.array(F.lit("ordinance 1"))).otherwise(none)}
    return given.select("c_custkey", F.array_join(ledger.packet_errors(c), ",").alias("errors"))


@query("SELECT c_custkey, c_custkey % 3 = 0 OR (c_custkey % 2 = 1 AND c_custkey % 5 = 0) AS retry FROM customer")
def gat05_rescue(t: Tables) -> DataFrame:
    """Packets that are tried again: unknown metadata, or a failure that a new attempt may mend."""
    k = F.col("c_custkey")
    none = F.array().cast("array<string>")
    errors = F.when(k % 5 == 0, F.array(F.lit("x"), F.lit("zero_items"))).otherwise(F.array(F.lit("other")))
    return t.customer.select("c_custkey", ledger.rescue_wanted(errors, F.when(k % 3 == 0, F.array(F.lit("location"))).otherwise(none), k % 2 == 0).alias("retry"))


@query("SELECT doc_id, CASE WHEN n_chars >= 400 AND q >= 0.35 THEN 'native' WHEN ocr_q >= 0.35 AND align >= 0.08 THEN 'ocr' ELSE 'none' END AS reference FROM (SELECT doc_id, n_chars, (doc_id % 100) / 100.0::DOUBLE AS q, (doc_id % 90) / 100.0::DOUBLE AS ocr_q, (doc_id % 20) / 100.0::DOUBLE AS align FROM documents)")
def gat08_reference_text(t: Tables) -> DataFrame:
    """Native text if there is enough of fair quality, else recognised text that is reliable, else none."""
    share = lambda n: (F.col("doc_id") % n) / F.lit(100.0)
    return t.documents.select("doc_id", X.reference_choice(F.col("n_chars"), share(100), share(90), share(20)).alias("reference"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'quarantined' WHEN event_id % 3 = 0 THEN 'retry' ELSE 'done' END AS outcome FROM events")
def gat09_stage_outcomes(t: Tables) -> DataFrame:
    """A stage's rows after their attempts: done, to be tried again (at most twice), or quarantined."""
    tries = F.when(F.col("event_id") % 7 == 0, 3).otherwise(F.col("event_id") % 3 + 0)
    failed = (F.col("event_id") % 7 == 0) | (F.col("event_id") % 3 == 0)
    return t.events.select("event_id", X.stage_outcome(failed, tries).alias("outcome"))


@query("SELECT c_name, created, CAST(100 + row_number() OVER (ORDER BY created, c_name) AS BIGINT) AS number, revision FROM (SELECT c_name, o_orderdate AS created, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS revision FROM orders JOIN customer ON o_custkey = c_custkey) WHERE revision = 1")
def win26_sequence(t: Tables) -> DataFrame:
    """New numbers behind the highest given one, groups by their first date and key; revisions count within a group."""
    o = t.orders.join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    first = o.withColumn("revision", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).cast("long")).where("revision = 1")
    return R.numbered(first.select("c_name", F.col("o_orderdate").alias("created"), "revision"), [F.col("created"), F.col("c_name")]).select("c_name", "created", (100 + F.col("number")).cast("long").alias("number"), "revision")


_PRIORITY = "CASE WHEN o_orderpriority = '1-URGENT' THEN 0 WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 2 END"


@query(f"SELECT o_custkey, o_orderkey AS fact FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {_PRIORITY}, o_orderkey) AS r FROM orders) WHERE r = 1")
def win25_priority_merge(t: Tables) -> DataFrame:
    """Of each position the fact of the strongest kind, the first of equal ones."""
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct(F.expr(_PRIORITY), F.col("o_orderkey"))).alias("fact"))


@query("SELECT a.conv_id, round(CASE WHEN len(p) > 0 THEN len(list_intersect(p, s))::DOUBLE / len(p) ELSE 0.0 END, 9) AS token_precision, round(CASE WHEN len(s) > 0 THEN len(list_intersect(p, s))::DOUBLE / len(s) ELSE 0.0 END, 9) AS token_recall, round(CASE WHEN len(num) = 0 THEN CASE WHEN len(s) > 0 THEN len(list_intersect(p, s))::DOUBLE / len(s) ELSE 0.0 END ELSE len(list_intersect(p, num))::DOUBLE / len(num) END, 9) AS numeric_recall FROM (SELECT conv_id, list_distinct(regexp_extract_all(lower(string_agg(text, ' ' ORDER BY turn) FILTER (turn % 2 = 0)), '[a-z0-9]+')) AS p FROM conversations GROUP BY 1) a JOIN (SELECT conv_id, s, list_filter(s, lambda x: regexp_matches(x, '[0-9]')) AS num FROM (SELECT conv_id, list_distinct(regexp_extract_all(lower(string_agg(text, ' ' ORDER BY turn)), '[a-z0-9]+')) AS s FROM conversations GROUP BY 1)) b ON a.conv_id = b.conv_id")
def mth06_page_score(t: Tables) -> DataFrame:
    """Tokens and numbers of a text held against a reference."""
    both = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("ts"))
    joined = lambda rows: F.array_join(F.transform(rows, lambda x: x["text"]), " ")
    d = both.select("conv_id", joined(F.filter("ts", lambda x: x["turn"] % 2 == 0)).alias("a"), joined(F.col("ts")).alias("b"))
    p, r, _ = X.token_scores(F.col("a"), F.col("b"))
    return d.select("conv_id", F.round(p, 9).alias("token_precision"), F.round(r, 9).alias("token_recall"), F.round(X.numeric_recall(F.col("a"), F.col("b")), 9).alias("numeric_recall"))


@query("SELECT a.c_custkey, 'added' AS change FROM customer a WHERE a.c_custkey % 3 = 0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = a.c_custkey AND o_orderstatus = 'F') UNION ALL SELECT DISTINCT o_custkey, 'stale' FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 3 <> 0")
def set03_key_differences(t: Tables) -> DataFrame:
    """Keys that only one of two sets has."""
    new = t.customer.where("c_custkey % 3 = 0").select("c_custkey")
    old = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    status = R.reconcile(old, new, ["c_custkey"]).where("status <> 'kept'")
    return status.select("c_custkey", F.col("status").alias("change"))


@query("SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'skip_unchanged' WHEN n_chars >= 400 THEN 'native' WHEN doc_id % 5 = 0 THEN 'sparse' ELSE 'ocr' END AS decision FROM documents")
def lan14_read_decision(t: Tables) -> DataFrame:
    """How a page of minutes is read, before anything is recognised: not again, its native text, a sparse attempt or a full one."""
    d = F.col("doc_id")
    return t.documents.select("doc_id", X.read_decision(d % 6 == 0, F.col("n_chars"), d % 5 == 0).alias("decision"))
