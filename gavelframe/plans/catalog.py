"""Named queries over the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gavelframe.functions import text as X
from gavelframe.operators import relational as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, read when they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# normalised text, tokens and page metrics as SQL
NORM = "trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'))"
TOK = f"regexp_extract_all({NORM}, '[a-z0-9]+')"
PAGES = f"""WITH a AS (SELECT doc_id, source, text, {NORM} AS norm, {TOK} AS tok FROM documents),
b AS (SELECT *, len(tok) AS n, len(list_filter(tok, lambda x: regexp_matches(x, '[a-z]'))) AS alpha, len(list_filter(tok, lambda x: regexp_matches(x, '[aeiou]'))) AS vowel,
 len(list_filter(tok, lambda x: regexp_matches(x, '[0-9]'))) AS num, len(list_filter(tok, lambda x: length(x) <= 1)) AS short,
 length(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS alnum, length(regexp_replace(text, '[\\p{{L}}\\p{{N}}\\s]', '', 'g')) AS symbols FROM a),
c AS (SELECT *, CASE WHEN n > 0 THEN alpha / n ELSE 0.0 END AS lexical_ratio, CASE WHEN alpha > 0 THEN vowel / alpha ELSE 0.0 END AS vowel_ratio, CASE WHEN n > 0 THEN num / n ELSE 0.0 END AS numeric_ratio,
 CASE WHEN length(text) > 0 THEN symbols / length(text) ELSE 0.0 END AS symbol_ratio, CASE WHEN n > 0 THEN short / n ELSE 1.0 END AS short_ratio FROM b),
d AS (SELECT *, 0.0::DOUBLE + least(1.0::DOUBLE, alnum / 320.0::DOUBLE) * 0.26::DOUBLE + least(1.0::DOUBLE, n / 120.0::DOUBLE) * 0.20::DOUBLE + lexical_ratio::DOUBLE * 0.16::DOUBLE + vowel_ratio::DOUBLE * 0.14::DOUBLE + (1.0::DOUBLE - least(1.0::DOUBLE, symbol_ratio::DOUBLE * 3.0::DOUBLE)) * 0.10::DOUBLE
 + (1.0::DOUBLE - short_ratio::DOUBLE) * 0.08::DOUBLE + least(1.0::DOUBLE, numeric_ratio::DOUBLE * 1.5::DOUBLE) * 0.06::DOUBLE AS quality FROM c)"""


@query(f"""{PAGES}, e AS (SELECT source, round(quality, 6) AS q, length(norm) >= 80 AND quality >= 0.35 AS comparable FROM d),
f AS (SELECT *, CASE WHEN NOT comparable THEN 'unverifiable' WHEN q >= 0.80 THEN 'pass' WHEN q >= 0.65 THEN 'warn' ELSE 'fail' END AS status FROM e)
SELECT source, count(*) AS pages, count(*) FILTER (comparable) AS comparable_pages, count(*) FILTER (status = 'pass') AS passed, count(*) FILTER (status = 'warn') AS warned, count(*) FILTER (status = 'fail') AS failed,
 min(q) AS min_quality, max(q) AS max_quality FROM f GROUP BY source""")
def run_qa_summary(t: Tables) -> DataFrame:
    """Pages of each source by status (normalise, tokenise, score, gate, roll up)."""
    used = ["normalized_char_count", "alnum_count", "token_count", "lexical_ratio", "vowel_ratio", "numeric_ratio", "symbol_ratio", "short_token_ratio"]
    page = X.with_page_metrics(t.documents.select("source", "text"), "text", used)
    scored = page.select("source", "normalized_char_count", X.reference_quality({n: F.col(n) for n in used}).alias("quality"))
    s = scored.select("source", F.round("quality", 6).alias("q"), ((F.col("normalized_char_count") >= 80) & (F.col("quality") >= 0.35)).alias("comparable"))
    s = s.withColumn("status", X.page_status(F.col("q"), F.col("comparable")))
    return s.groupBy("source").agg(F.count("*").alias("pages"), F.count_if("comparable").alias("comparable_pages"), *[F.count_if(F.col("status") == k).alias(n) for k, n in (("pass", "passed"), ("warn", "warned"), ("fail", "failed"))], F.min("q").alias("min_quality"), F.max("q").alias("max_quality"))


@query(f"{PAGES} SELECT doc_id, CAST(length(text) AS BIGINT) AS char_count, CAST(length(norm) AS BIGINT) AS normalized_char_count, CAST(alnum AS BIGINT) AS alnum_count, CAST(n AS BIGINT) AS token_count, CAST(len(list_distinct(tok)) AS BIGINT) AS unique_token_count, round(lexical_ratio::DOUBLE, 9) AS lexical_ratio, round(vowel_ratio::DOUBLE, 9) AS vowel_ratio, round(symbol_ratio::DOUBLE, 9) AS symbol_ratio FROM d")
def mth05_page_metrics(t: Tables) -> DataFrame:
    counts, ratios = ("char_count", "normalized_char_count", "alnum_count", "token_count", "unique_token_count"), ("lexical_ratio", "vowel_ratio", "symbol_ratio")
    m = X.with_page_metrics(t.documents.select("doc_id", "text"), "text", [*counts, *ratios])
    return m.select("doc_id", *[F.col(k).cast("long").alias(k) for k in counts], *[F.round(k, 9).alias(k) for k in ratios])


@query("SELECT p_type, count(*) AS n FROM part GROUP BY p_type HAVING count(*) > 1")
def agg01_having(t: Tables) -> DataFrame:
    return t.part.groupBy("p_type").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 20")
def agg05_top_labels(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users")).orderBy(F.desc("n"), "event_type").limit(20)


@query("SELECT l_linenumber, median(l_quantity) AS median_quantity, count(*) AS n FROM lineitem WHERE l_linenumber <= 8 GROUP BY l_linenumber")
def agg11_column_medians(t: Tables) -> DataFrame:
    return t.lineitem.where("l_linenumber <= 8").groupBy("l_linenumber").agg(F.percentile("l_quantity", 0.5).alias("median_quantity"), F.count("*").alias("n"))


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS transcript FROM conversations WHERE trim(text) <> '' GROUP BY conv_id")
def agg16_transcript(t: Tables) -> DataFrame:
    turns = t.conversations.where("trim(text) <> ''").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("ts"))
    return turns.select("conv_id", F.array_join(F.transform("ts", lambda x: x["text"]), "\n\n").alias("transcript"))


@query("SELECT max(try_cast(regexp_extract(c_name, '[0-9]+') AS INTEGER)) AS top_number, count(DISTINCT c_name) AS seen FROM customer")
def agg18_inventory(t: Tables) -> DataFrame:
    return t.customer.agg(F.max(F.nullif(F.regexp_extract("c_name", "[0-9]+", 0), F.lit("")).try_cast("int")).alias("top_number"), F.count_distinct("c_name").alias("seen"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def win17_latest_per_key(t: Tables) -> DataFrame:
    return R.latest_per_key(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice - coalesce(nxt, 0) AS margin FROM (SELECT *, lead(l_extendedprice) OVER w AS nxt, row_number() OVER w AS r FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity DESC, l_linenumber)) WHERE r = 1")
def win16_best_and_margin(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), F.desc("l_quantity"), "l_linenumber")
    d = t.lineitem.withColumn("nxt", F.lead("l_extendedprice").over(w)).withColumn("r", F.row_number().over(w)).where("r = 1")
    return d.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") - F.coalesce("nxt", F.lit(0.0))).alias("margin"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_quantity DESC, l_discount, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def win18_best_per_key(t: Tables) -> DataFrame:
    return R.latest_per_key(t.lineitem, ["l_suppkey"], [F.desc("l_shipdate"), F.desc("l_quantity"), F.asc("l_discount"), F.asc("l_orderkey"), F.asc("l_linenumber")]).select("l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber, CAST(1 + sum(f) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber ROWS UNBOUNDED PRECEDING) AS BIGINT) AS grp FROM (SELECT *, CASE WHEN l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) > 5 THEN 1 ELSE 0 END AS f FROM lineitem)")
def win21_gap_clusters(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.asc_nulls_last("l_quantity"), F.asc_nulls_last("l_linenumber"))
    far = F.coalesce((F.col("l_quantity") - F.lag("l_quantity").over(w) > 5).cast("int"), F.lit(0))
    d = t.lineitem.withColumn("f", far)
    return d.select("l_orderkey", "l_linenumber", (F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1).alias("grp"))


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal FROM conversations")
def win23_ordinals(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long").alias("ordinal"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'new ' || c_name, c_acctbal FROM customer WHERE c_custkey % 3 = 0")
def snk01_upsert(t: Tables) -> DataFrame:
    target = t.customer.select("c_custkey", "c_name", "c_acctbal")
    source = t.customer.where("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("new "), "c_name").alias("c_name"))
    return R.upsert(target, source, ["c_custkey"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 5 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, 0 FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber <= 2")
def snk02_replace_children(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    new = lines.where("l_orderkey % 5 = 0 AND l_linenumber <= 2").withColumn("l_quantity", F.lit(0.0))
    return R.replace_children(lines, t.orders.where("o_orderkey % 5 = 0").withColumnRenamed("o_orderkey", "l_orderkey"), new, "l_orderkey")


@query("SELECT s_suppkey, s_name, NULL::VARCHAR AS c_mktsegment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def snk04_schema_evolution(t: Tables) -> DataFrame:
    return R.evolve(t.supplier.select("s_suppkey", "s_name"), t.customer.select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"), "c_mktsegment"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def joi03_delete_orphans(t: Tables) -> DataFrame:
    return R.delete_orphans(t.customer.select("c_custkey"), t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("SELECT o.o_orderkey, c.c_name, n.n_name FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey WHERE c_mktsegment LIKE 'B%'")
def joi02_registry_join(t: Tables) -> DataFrame:
    c = t.customer.where(F.col("c_mktsegment").startswith("B")).select("c_custkey", "c_name", "c_nationkey")
    o = t.orders.select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return o.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")


@query("SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def joi04_left_default(t: Tables) -> DataFrame:
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'stale' ELSE 'kept' END AS status FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 4 <> 0) b ON a.k = b.k")
def joi07_reconcile(t: Tables) -> DataFrame:
    return R.reconcile(t.orders.select(F.col("o_custkey").alias("k")), t.customer.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("k")), ["k"])


@query("SELECT doc_id FROM documents WHERE doc_id % 4 <> 0 OR doc_id % 8 = 0")
def flt01_incremental(t: Tables) -> DataFrame:
    """What was pushed with the same digest is left out; a changed digest or another status is not."""
    d = t.documents.select("doc_id", F.sha2("text", 256).alias("sha256"))
    state = d.where("doc_id % 4 = 0").select("doc_id", "sha256", F.when(F.col("doc_id") % 8 == 0, "failed").otherwise("pushed").alias("last_status"))
    return R.unchanged(d, state, "doc_id", "sha256").select("doc_id")


@query("SELECT doc_id, CAST(regexp_matches(text, '[0-9]') AS INTEGER) + CAST(regexp_matches(text, '@') AS INTEGER) + CAST(regexp_matches(text, '[$%]') AS INTEGER) AS hits FROM documents")
def flt11_keyword_hits(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.keyword_hits(F.col("text"), ["[0-9]", "@", "[$%]"]).alias("hits"))


@query("SELECT user_id, event_id FROM (SELECT *, max(event_id) OVER (PARTITION BY user_id) AS m FROM events) WHERE event_id = m AND event_type <> 'view'")
def src14_latest_then_filter(t: Tables) -> DataFrame:
    last = t.events.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), "event_id").alias("x"))
    return last.where("x.event_type <> 'view'").select("user_id", "x.event_id")


@query("SELECT doc_id, i - 1 AS line_no, l AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE trim(l) <> ''")
def str18_lines(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).where("trim(line) <> ''").select("doc_id", F.col("p").cast("long").alias("line_no"), "line")


@query(f"SELECT doc_id, {NORM} AS norm, sha256(text) AS sha FROM documents")
def str02_normalise_and_hash(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.normalize_text(F.col("text")).alias("norm"), F.sha2("text", 256).alias("sha"))


@query("SELECT doc_id, CASE WHEN length(text) > 60 THEN rtrim(substr(text, 1, 59)) || '…' ELSE text END AS clipped FROM documents")
def str05_clip(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.clip(F.col("text"), 60).alias("clipped"))


@query("SELECT doc_id, CASE WHEN contains(text, '>>') OR contains(text, '&gt;&gt;') THEN 3 WHEN contains(text, '.') AND (length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) / length(text) > 0.05 OR length(text) < 50) THEN 2 ELSE 1 END AS generation FROM documents")
def str08_generation(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.caption_generation(F.col("text")).alias("generation"))


@query("SELECT s_suppkey, 'ORG_' || regexp_replace(regexp_replace(upper(s_name), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS id FROM supplier")
def str14_registry_id(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", X.registry_id(F.lit("org"), F.col("s_name")).alias("id"))


@query("SELECT doc_id, CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^a-zA-Z0-9\\s.,!?;:()''\"-]', '', 'g'))::DOUBLE / length(text) ELSE 0.0 END AS ratio FROM documents")
def str20_allowed_ratio(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.allowed_ratio(F.col("text")).alias("ratio"))


@query("SELECT n, array_to_string(list_filter(range(1, 11), lambda x: NOT list_contains(seen, x)), ',') AS missing FROM (SELECT c_nationkey AS n, list_distinct(list(c_custkey % 11)) AS seen FROM customer GROUP BY 1)")
def set02_missing_pages(t: Tables) -> DataFrame:
    seen = t.customer.groupBy(F.col("c_nationkey").alias("n")).agg(F.collect_set(F.col("c_custkey") % 11).alias("seen"))
    return seen.select("n", F.array_join(F.array_except(F.sequence(F.lit(1), F.lit(10)).cast("array<bigint>"), "seen"), ",").alias("missing"))


@query("SELECT format('GE{:03d}', row_number() OVER (ORDER BY p_brand, lower(p_name), p_partkey)) AS id, p_partkey FROM part")
def srt08_renumber(t: Tables) -> DataFrame:
    """Sorted by category and name, then numbered; ranges of rows are sorted apart."""
    return R.numbered(t.part, [F.col("p_brand"), F.lower("p_name"), F.col("p_partkey")]).select(F.format_string("GE%03d", "number").alias("id"), "p_partkey")
