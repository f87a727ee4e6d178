"""Further named queries: sinks, scalars, gates and sources, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.functions import text as X
from gavelframe.operators import relational as R
from gavelframe.plans.catalog import Tables, query


@query("SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS BIGINT) AS ascii_tokens, CAST(len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS BIGINT) AS word_tokens FROM documents")
def str03_tokens(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.size(X.tokens(F.col("text"))).cast("long").alias("ascii_tokens"), F.size(X.words(F.col("text"))).cast("long").alias("word_tokens"))


@query("SELECT conv_id, turn, trim(regexp_replace(text, '[\\s\\p{Z}]+', ' ', 'g')) AS text FROM conversations")
def str01_normalize_ws(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", X.normalize_ws(F.col("text")).alias("text"))


@query("SELECT doc_id, CAST(length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) AS BIGINT) AS n FROM documents")
def str19_alnum_count(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.alnum_count(F.col("text")).cast("long").alias("n"))


@query("SELECT doc_id, round((length(regexp_replace(text, '[^\\p{L}]', '', 'g'))::DOUBLE / greatest(length(text), 1)) * 100.0::DOUBLE - (length(regexp_replace(text, '[\\x00-\\x7E\\s]', '', 'g'))::DOUBLE / greatest(length(text), 1)) * 250.0::DOUBLE + least(length(text), 6000) / 120.0::DOUBLE - CASE WHEN length(regexp_replace(text, '[^\\s]', '', 'g'))::DOUBLE / greatest(length(text), 1) < 0.05 THEN 8.0::DOUBLE ELSE 0.0::DOUBLE END, 6) AS score FROM documents")
def mth02_rescue_score(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.round(X.rescue_score(F.col("text")), 6).alias("score"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def snk11_flatten(t: Tables) -> DataFrame:
    """Nested children to flat rows that carry their parent's attributes."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("lines"))
    pages = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return R.flatten_children(pages, "lines", ["l_orderkey", "o_orderstatus", "o_orderdate"])


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END, 'seg-' || c_nationkey) AS segment FROM customer")
def snk23_backfill(t: Tables) -> DataFrame:
    old = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", F.coalesce(old, F.concat(F.lit("seg-"), F.col("c_nationkey").cast("string"))).alias("segment"))


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def snk25_enrich(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")


@query("SELECT doc_id FROM documents WHERE regexp_matches(substr(text, 1, 100000), '[0-9]{3}')")
def flt10_guarded_search(t: Tables) -> DataFrame:
    return t.documents.where(F.substring("text", 1, 100000).rlike("[0-9]{3}")).select("doc_id")


@query("SELECT event_type, n FROM (SELECT event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1) ORDER BY n DESC, first LIMIT 3")
def srt07_most_common(t: Tables) -> DataFrame:
    g = t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    return g.orderBy(F.desc("n"), "first").limit(3).select("event_type", "n")


@query("SELECT n_regionkey, n_name FROM nation")
def srt02_listing(t: Tables) -> DataFrame:
    return t.nation.select("n_regionkey", "n_name").orderBy("n_regionkey", "n_name")


@query("SELECT source, count(*) FILTER (n_chars >= 500) * 100 >= 95 * count(*) AS passes FROM documents GROUP BY source")
def gat06_share_gate(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg((F.count_if(F.col("n_chars") >= 500) * 100 >= F.count("*") * 95).alias("passes"))


@query("SELECT o.o_orderkey, coalesce(n, 0) = 4 AS matches FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o.o_orderkey")
def gat07_reconcile_counts(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return t.orders.select("o_orderkey").join(n, "o_orderkey", "left").select("o_orderkey", (F.coalesce("n", F.lit(0)) == 4).alias("matches"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'JANE DOE' || c_custkey WHEN 1 THEN 'BOB' WHEN 2 THEN '' ELSE 'ANN ' || upper(c_mktsegment) END AS key FROM customer")
def str13_person_key(t: Tables) -> DataFrame:
    """First and last word of a name in upper case."""
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.concat(F.lit(" Jane A.  doe"), F.col("c_custkey").cast("string"))).when(k == 1, "bob ").when(k == 2, "  ").otherwise(F.concat(F.lit("Ann "), "c_mktsegment"))
    return t.customer.select("c_custkey", X.person_key(name).alias("key"))


@query("SELECT c_custkey, 'Ann ' || c_custkey || '|Bob|' || c_mktsegment AS people FROM customer")
def str23_split_people(t: Tables) -> DataFrame:
    """Lists of people without placeholders."""
    said = F.concat(F.lit("Ann "), F.col("c_custkey").cast("string"), F.lit(", N/A and Bob & "), "c_mktsegment", F.lit(", unknown"))
    return t.customer.select("c_custkey", F.array_join(X.split_people(said), "|").alias("people"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 1000 + o_custkey + 0.5 WHEN 1 THEN o_custkey % 100 WHEN 2 THEN -3.25 END AS value FROM orders")
def mth01_tolerant_cast(t: Tables) -> DataFrame:
    """Amounts and shares as numbers; null for what is none."""
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey")
    said = F.when(k == 0, F.concat(F.lit("$"), F.format_number(c + 1000.5, 2))).when(k == 1, F.concat((c % 100).cast("string"), F.lit(" %"))).when(k == 2, "-3.25").otherwise("n/a")
    return t.orders.select("o_orderkey", X.tolerant_double(said).alias("value"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def dat01_code_date(t: Tables) -> DataFrame:
    """The date at the end of a code or in a file's name; null for one that is none."""
    k, ymd = F.col("o_orderkey") % 3, F.date_format("o_orderdate", "yyyyMMdd")
    code = F.when(k == 0, F.concat(F.lit("A.000123."), ymd)).when(k == 1, F.concat(F.lit("A.000123."), ymd, F.lit(".20240101.pdf"))).otherwise("A.000123.20231399")
    return t.orders.select("o_orderkey", X.code_date(code).cast("string").alias("day"))


@query("SELECT o_orderkey, CAST(CASE WHEN y >= 100 THEN y WHEN abs(h // 100 * 100 + y - h) <= 5 THEN h // 100 * 100 + y WHEN y <= 69 THEN y + 2000 ELSE y + 1900 END AS INTEGER) AS year FROM (SELECT o_orderkey, o_orderkey % 110 AS y, 1960 + o_custkey % 90 AS h FROM orders)")
def src11_full_year(t: Tables) -> DataFrame:
    """Two-digit years by a hint within five years, else by a pivot at 69."""
    return t.orders.select("o_orderkey", X.full_year(F.col("o_orderkey") % 110, 1960 + F.col("o_custkey") % 90).cast("int").alias("year"))


@query("SELECT user_id, count(DISTINCT event_type) AS keys, string_agg(k, ',' ORDER BY k) AS state FROM (SELECT user_id, event_type, event_type || '=' || max(event_id) AS k FROM events GROUP BY 1, 2) GROUP BY user_id")
def snk07_map_merge(t: Tables) -> DataFrame:
    """A state map merged with a later one, whose keys win."""
    half = lambda rest, name: t.events.where(f"event_id % 2 = {rest}").groupBy("user_id", "event_type").agg(F.max("event_id").alias("v")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias(name))
    whole = t.events.groupBy("user_id", "event_type").agg(F.max("event_id").alias("v")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("all"))
    none = F.create_map().cast("map<string,bigint>")
    merged = half(0, "old").join(whole, "user_id", "full").select("user_id", R.merged_maps(F.coalesce("old", none), F.coalesce("all", none)).alias("m"))
    return merged.select("user_id", F.size("m").cast("long").alias("keys"), F.array_join(F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ",").alias("state"))


@query("SELECT doc_id, lang IS NULL OR doc_id % 4 = 0 AS missing FROM documents")
def flt09_missing(t: Tables) -> DataFrame:
    """Values that say nothing."""
    said = F.when(F.col("doc_id") % 8 == 0, " N/A ").when(F.col("doc_id") % 8 == 4, "Unknown").otherwise(F.col("lang"))
    return t.documents.select("doc_id", X.missing_value(said).alias("missing"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_orderkey AS region FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity + 1 BETWEEN 10 AND 30 AND l_linenumber * 2 + 0.5 BETWEEN 2 AND 10")
def joi06_contained(t: Tables) -> DataFrame:
    """Words whose centre lies in a region of their page."""
    x, y = F.col("l_quantity"), (F.col("l_linenumber") * 2).cast("double")
    words = t.lineitem.select(F.col("l_orderkey").alias("page_id"), "l_linenumber", "l_partkey", x.alias("x0"), (x + 2).alias("x1"), y.alias("y0"), (y + 1).alias("y1"))
    boxes = t.orders.select(F.col("o_orderkey").alias("page_id"), F.col("o_orderkey").alias("region_id"), F.lit(10.0).alias("x0"), F.lit(30.0).alias("x1"), F.lit(2.0).alias("y0"), F.lit(10.0).alias("y1"))
    return R.contained(words, boxes).select(F.col("page_id").alias("l_orderkey"), "l_linenumber", "l_partkey", F.col("region_id").alias("region"))


_GATES = {"src": "c_custkey % 20 <> 0", "hash": "c_custkey % 20 <> 1", "missing": "CASE WHEN c_custkey % 20 = 2 THEN 3 ELSE 0 END", "pages": "55 + c_custkey % 20", "acc": "CAST((86 + c_custkey % 14) / 100.0 AS DOUBLE)", "failed": "CAST((c_custkey % 9) / 100.0 AS DOUBLE)", "passed": "CAST((90 + c_custkey % 10) / 100.0 AS DOUBLE)", "warned": "CAST((80 + c_custkey % 17) / 100.0 AS DOUBLE)", "art": "c_custkey % 2"}


@query(f"SELECT c_custkey, CASE WHEN NOT src OR NOT hash OR missing > 0 THEN 'fail' WHEN pages < 60 THEN 'warn' WHEN acc >= 0.95 AND failed <= 0.05 THEN 'pass' WHEN passed >= 0.95 AND art = 0 THEN 'pass' WHEN warned >= 0.9 THEN 'warn' ELSE 'fail' END AS status, CASE WHEN NOT src THEN 'source_unavailable' WHEN NOT hash THEN 'source_hash_mismatch' WHEN missing > 0 THEN 'page_coverage_gap' WHEN pages < 60 THEN 'insufficient_comparable_pages' WHEN acc >= 0.95 AND failed <= 0.05 THEN 'accepted_ratio_met' WHEN passed >= 0.95 AND art = 0 THEN 'pass_ratio_met' WHEN warned >= 0.9 THEN 'warn_ratio_met' ELSE 'ratio_below_threshold' END AS reason FROM (SELECT c_custkey, {', '.join(f'{x} AS {n}' for n, x in _GATES.items())} FROM customer)")
def gat03_run_status(t: Tables) -> DataFrame:
    """The ladder of a run's status, from its source to its ratios."""
    g = t.customer.select("c_custkey", *[F.expr(x).alias(n) for n, x in _GATES.items()])
    status, reason = X.run_status(*[F.col(c) for c in ("src", "hash", "missing", "pages", "acc", "failed", "passed", "warned", "art")])
    return g.select("c_custkey", status.alias("status"), reason.alias("reason"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'ocr_handwriting_page' WHEN o_orderkey % 3 > 0 AND o_custkey % 100 >= 85 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'native_text_plus_layout' ELSE 'native_text_only' END WHEN o_orderkey % 2 = 0 THEN 'ocr_mixed_layout_page' ELSE 'ocr_text_page' END AS route FROM orders")
def cls16_route(t: Tables) -> DataFrame:
    """How a page is read: by handwriting, native text of quality, and tables."""
    regions = F.array(F.when(F.col("o_orderkey") % 2 == 0, "P_TAB_1").otherwise("P_TXT_1"), F.lit("P_TXT_2"))
    return t.orders.select("o_orderkey", X.extraction_route(F.col("o_orderkey") % 3 > 0, (F.col("o_custkey") % 100) / F.lit(100.0), regions, F.col("o_orderkey") % 11 == 0).alias("route"))


_RESULT = ("[SUCCESS] done", "[SKIP] old", "error: No text found in VTT", "insufficient_turns", "low_squeezed_coverage 0.9", "unknown_saturation", "Source x not found", "boom")
_CODES = ("OK95", "SKIP", "EMPTYVTT", "LOWSIG", "LOWCOV95", "UNKSAT", "NOSRC", "FAILED")


@query("SELECT event_id, CASE event_id % 8 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CODES)) + " END AS code FROM events")
def gat01_disposition(t: Tables) -> DataFrame:
    """Outcome lines as codes."""
    line = F.concat(F.get(F.array(*map(F.lit, _RESULT)), (F.col("event_id") % 8).cast("int")), F.lit(" of "), "event_type")
    return t.events.select("event_id", X.disposition(line).alias("code"))
