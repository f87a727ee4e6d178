"""Queries of the scalar, array, map, JSON, date and OCR-metric functions, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelframe.functions import records as Rec
from gavelframe.functions import text as X
from gavelframe.operators.relational import merged_maps
from gavelframe.plans import civic
from gavelframe.plans.catalog import Tables, query

L = f"({civic.LINES})"
STOP = "[" + ", ".join(f"'{w}'" for w in Rec.STOP_WORDS) + "]"
CLEAN_WS = "trim(regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


def ws(x: str) -> str:
    return CLEAN_WS.format(x=x)


@query(f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n, sha256(array_to_string(list_sort(t), ' ')) AS tokens FROM (SELECT doc_id, list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z]{{5,}}')), lambda x: NOT list_contains({STOP}, x)) AS t FROM documents)")
def arr01_lexical_tokens(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", F.array_sort(Rec.lexical_tokens(F.col("text"))).alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n"), F.sha2(F.array_join("t", " "), 256).alias("tokens"))


@query(f"SELECT doc, line_no, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(lower(line), '\\b(?:ordinance|resolution)\\s*(?:no\\.?|number|#)?\\s*[a-z0-9][a-z0-9\\-./]{{1,40}}'), lambda m: regexp_extract(m, '^(ordinance|resolution)', 1) || ' ' || regexp_replace(regexp_extract(m, '^(?:ordinance|resolution)\\s*(?:no\\.?|number|#)?\\s*([a-z0-9][a-z0-9\\-./]{{1,40}})', 1), '[^a-z0-9]', '', 'g')))), '|') AS refs FROM {L} WHERE regexp_matches(line, '[0-9]') AND regexp_matches(line, '^(ORDINANCE|RESOLUTION) NO')")
def arr02_law_references(t: Tables) -> DataFrame:
    d = civic.lines(t).select("doc", "line_no", F.array_join(Rec.law_references(F.col("line")), "|").alias("refs"))
    return d.where("refs <> ''")


@query(f"SELECT doc, line_no, trim(substr(line, 1, p - 1)) AS key, trim(substr(line, p + 1)) AS value, 'colon_line' AS source FROM (SELECT *, strpos(line, ':') AS p FROM {L}) WHERE p BETWEEN 2 AND 41 AND trim(substr(line, 1, p - 1)) <> '' UNION ALL SELECT o_custkey, o_orderkey, 'Item', o_orderstatus || ' | ' || o_orderpriority, 'aligned_cells' FROM orders")
def arr03_key_value_pairs(t: Tables) -> DataFrame:
    """Lines with a colon, and rows of aligned cells."""
    a = civic.lines(t).select("doc", "line_no", Rec.key_value(F.col("line")).alias("p")).where("p IS NOT NULL").select("doc", "line_no", "p.*")
    cells = F.array(F.lit("Item:"), F.col("o_orderstatus"), F.lit(" "), F.col("o_orderpriority"))
    b = t.orders.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("line_no"), Rec.key_value(F.lit("no colon here"), cells).alias("p")).select("doc", "line_no", "p.*")
    return a.union(b)


@query("SELECT o_orderkey, 'a=1,b=' || o_orderstatus || ',c=3' AS one, 'x:{k=new,l=2}|y:{m=' || o_custkey || '}|z:{n=1}' AS two FROM orders")
def map01_deep_merge(t: Tables) -> DataFrame:
    """A state's nested maps with an update: inner maps merge, scalars are replaced."""
    show = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    lit = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    one = merged_maps(lit("a", "1", "b", "2"), lit("b", F.col("o_orderstatus"), "c", "3"))
    base = F.create_map(F.lit("x"), lit("k", "old", "l", "2"), F.lit("y"), lit("m", F.col("o_custkey").cast("string")))
    two = Rec.deep_merge(base, F.create_map(F.lit("x"), lit("k", "new"), F.lit("z"), lit("n", "1")))
    shown = F.array_join(F.transform(F.array_sort(F.map_keys(two)), lambda k: F.concat(k, F.lit(":{"), show(F.element_at(two, k)), F.lit("}"))), "|")
    return t.orders.select("o_orderkey", show(one).alias("one"), shown.alias("two"))


@query("SELECT event_id, array_to_string(['e', event_type, CAST(user_id AS VARCHAR), 'true', json_extract_string(props, '$.k')], '|') AS leaves FROM events")
def jsn01_leaves(t: Tables) -> DataFrame:
    """All scalar leaves of a nested object in their order."""
    from gavelframe.functions.nested import scalar_leaves

    made = F.concat(F.lit('{"a": "e", "b": {"c": ["'), "event_type", F.lit('", '), F.col("user_id").cast("string"), F.lit('], "d": true, "n": null}, "p": '), "props", F.lit("}"))
    return t.events.select("event_id", F.array_join(scalar_leaves(made), "|").alias("leaves"))


@query("SELECT doc_id, CASE WHEN length(source) > 5 THEN rtrim(substr(source, 1, 4)) || '…' ELSE source END AS value, length(text) > 280 AS cut FROM documents WHERE source IS NOT NULL")
def jsn02_compact_fact(t: Tables) -> DataFrame:
    """Facts as JSON with clipped texts, read back."""
    d = t.documents.where("source IS NOT NULL").select("doc_id", F.from_json(Rec.compact_fact(F.col("text"), F.col("source"), 5), "context string, value string").alias("f"))
    return d.select("doc_id", "f.value", (F.col("f.context").endswith("…") & (F.length("f.context") >= 200)).alias("cut"))


@query("SELECT o_orderkey, 'meeting_type=' || o_orderpriority || ',time=7:' || (10 + o_orderkey % 50) || ' PM' AS meta FROM orders")
def jsn03_tagged_block(t: Tables) -> DataFrame:
    body = F.concat(F.lit("# head\n[SCHEMA_SUGGESTION_BOX]\nmeeting_type: first\n- note: no\nplain\ntime : 7:"), (10 + F.col("o_orderkey") % 50).cast("string"), F.lit(" PM\nmeeting_type:  "), "o_orderpriority", F.lit("\n[/SCHEMA_SUGGESTION_BOX]\ntail: x"))
    m = F.array_sort(F.map_entries(Rec.tagged_block(body)))
    return t.orders.select("o_orderkey", F.array_join(F.transform(m, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("meta"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def jsn04_json_or_empty(t: Tables) -> DataFrame:
    """Objects, and text cut off in the middle, which reads as an empty object."""
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("broken "), "props")).otherwise(F.col("props"))
    return t.events.select("event_id", Rec.json_or_empty(raw, "k long").alias("o")).select("event_id", "o.k")


_MENTION = "lpad(CAST(1 + o_custkey % 12 AS VARCHAR), 2, '0') || '-' || lpad(CAST(1 + o_orderkey % 31 AS VARCHAR), 2, '0')"


@query(f"SELECT doc, strftime(min_by(day, line_no) FILTER (day IS NOT NULL), '%Y-%m-%d') AS day FROM (SELECT doc, line_no + CASE WHEN line LIKE 'held on%' THEN 1000000 ELSE 0 END AS line_no, CASE WHEN line LIKE 'Meeting date%' THEN try_strptime(regexp_extract(line, 'March ([0-9]+)', 1) || ' 3 2024', '%d %m %Y') WHEN line LIKE 'held on%' THEN try_strptime(regexp_extract(line, 'held on ([0-9/]+)', 1), '%m/%d/%y') END::DATE AS day FROM {L}) GROUP BY doc")
def dat02_meeting_date(t: Tables) -> DataFrame:
    """The first long date of a document's lines, else the first numeric one."""
    line = civic.lines(t).select("doc", "line_no", Rec.long_date(F.col("line")).alias("a"), Rec.numeric_date(F.col("line")).alias("b"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("line_no")))
    return line.groupBy("doc").agg(F.coalesce(first("a"), first("b")).cast("string").alias("day"))


@query(f"SELECT doc, min_by(tm, line_no) FILTER (tm IS NOT NULL) AS time FROM (SELECT doc, line_no, CASE WHEN line LIKE 'at %' AND CAST(regexp_extract(line, 'at ([0-9]+):', 1) AS INTEGER) <= 12 THEN regexp_extract(line, 'at ([0-9]+:[0-9]+)', 1) || ' PM' WHEN line LIKE 'at %' AND CAST(regexp_extract(line, ':([0-9]+)', 1) AS INTEGER) <= 12 THEN regexp_extract(line, ':([0-9]+)', 1) || ':00 PM' WHEN line LIKE 'doors%' THEN regexp_extract(line, 'at ([0-9]+)', 1) || ':00 AM' END AS tm FROM {L}) GROUP BY doc")
def dat03_meeting_time(t: Tables) -> DataFrame:
    """The first valid time of a document's lines."""
    line = civic.lines(t).select("doc", "line_no", Rec.clock_time(F.col("line")).alias("time"))
    return line.groupBy("doc").agg(F.min_by("time", F.when(F.col("time").isNotNull(), F.col("line_no"))).alias("time"))


@query("SELECT o_orderkey, array_to_string(list_sort(list_filter([strftime(try_strptime('2024-' || lpad(CAST(1 + o_custkey % 12 AS VARCHAR), 2, '0') || '-' || lpad(CAST(1 + o_orderkey % 31 AS VARCHAR), 2, '0'), '%Y-%m-%d'), '%Y-%m-%d') || '=' || (1 + o_custkey % 12) || '/' || (1 + o_orderkey % 31) || '/24', strftime(try_strptime('2023-09-' || lpad(CAST(1 + o_orderkey % 33 AS VARCHAR), 2, '0'), '%Y-%m-%d'), '%Y-%m-%d') || '=sept. ' || (1 + o_orderkey % 33) || ', 2023', '2024-05-04=may 4th'], lambda x: x IS NOT NULL)), '|') AS dates FROM orders")
def dat04_date_mentions(t: Tables) -> DataFrame:
    """Month-name and numeric dates, with invalid ones and one without a year."""
    o = t.orders
    part = F.concat((1 + F.col("o_custkey") % 12).cast("string"), F.lit("/"), (1 + F.col("o_orderkey") % 31).cast("string"), F.lit("/24"))
    said = F.concat(F.lit("On "), part, F.lit(" and Sept. "), (1 + F.col("o_orderkey") % 33).cast("string"), F.lit(", 2023, again "), part, F.lit("; May 4th"))
    found = Rec.date_mentions(said, F.lit(2024))
    return o.select("o_orderkey", F.array_join(F.transform(found, lambda s: F.concat(s["iso_date"], F.lit("="), s["raw"])), "|").alias("dates"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day FROM lineitem")
def dat05_safe_date(t: Tables) -> DataFrame:
    ymd = F.when(F.col("l_orderkey") % 7 == 0, F.concat(F.lit("2024133"), (F.col("l_orderkey") % 10).cast("string"))).otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    return t.lineitem.select("l_orderkey", "l_linenumber", Rec.safe_date(ymd).cast("string").alias("day"))


_TOK = "regexp_extract_all(text, '[A-Za-z0-9][A-Za-z0-9''&/.-]*')"
OCR = f"""WITH a AS (SELECT doc_id, text, {_TOK} AS tok, length(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS alnum, length(regexp_replace(text, '[\\s\\p{{C}}\\p{{Z}}]', '', 'g')) AS shown,
 length(regexp_replace(text, '[\\s\\p{{C}}\\p{{Z}}\\p{{L}}\\p{{N}}.,;:!?()\\[\\]{{}}''"\\-_/\\\\&%$#@+=*]', '', 'g')) AS noise, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS lines FROM documents),
b AS (SELECT *, len(tok) AS n, len(list_filter(tok, lambda x: length(x) >= 4 AND regexp_matches(x, '[A-Za-z]') AND regexp_matches(x, '[AEIOUYaeiouy]'))) AS lexical, len(list_filter(tok, lambda x: length(x) <= 2)) AS short, len(list_filter(tok, lambda x: regexp_matches(x, '[0-9]'))) AS num, coalesce(list_sum(list_transform(tok, lambda x: length(x))), 0) AS chars FROM a),
c AS (SELECT *, CASE WHEN shown > 0 THEN noise::DOUBLE / shown ELSE 0.0::DOUBLE END AS nr, CASE WHEN n > 0 THEN lexical::DOUBLE / n ELSE 0.0::DOUBLE END AS lr, CASE WHEN n > 0 THEN short::DOUBLE / n ELSE 0.0::DOUBLE END AS sr, CASE WHEN n > 0 THEN chars::DOUBLE / n ELSE 0.0::DOUBLE END AS avg_len FROM b),
d AS (SELECT *, round(least(0.99::DOUBLE, least(0.35::DOUBLE, alnum / 320.0::DOUBLE) + least(0.2::DOUBLE, n / 40.0::DOUBLE) + least(0.2::DOUBLE, lexical / 20.0::DOUBLE) + greatest(0.0::DOUBLE, (1.0::DOUBLE - least(1.0::DOUBLE, nr)) * 0.15::DOUBLE) + least(0.1::DOUBLE, lines / 20.0::DOUBLE)), 4) AS quality FROM c)"""


@query(f"{OCR} SELECT doc_id, CAST(n AS BIGINT) AS word_count, CAST(lexical AS BIGINT) AS lexical_word_count, CAST(num AS BIGINT) AS numeric_token_count, CAST(lines AS BIGINT) AS line_count, CAST(noise AS BIGINT) AS noise_char_count, round(avg_len, 2) AS avg_word_length, round(sr, 4) AS short_word_ratio, quality AS quality_score FROM d")
def mth03_ocr_metrics(t: Tables) -> DataFrame:
    m = Rec.ocr_metrics(F.col("text"))
    return t.documents.select("doc_id", *[m[k].cast("long").alias(k) for k in ("word_count", "lexical_word_count", "numeric_token_count", "line_count", "noise_char_count")], *[m[k].alias(k) for k in ("avg_word_length", "short_word_ratio", "quality_score")])


@query(f"{OCR} SELECT doc_id, round(round(alnum + n * 4.0::DOUBLE + lexical * 18.0::DOUBLE + num * 0.75::DOUBLE + lines * 1.5::DOUBLE + round(avg_len, 2) * 6.0::DOUBLE + round(lr, 4) * 120.0::DOUBLE - round(sr, 4) * 80.0::DOUBLE - noise * 4.0::DOUBLE + greatest(0.0::DOUBLE, 1.0::DOUBLE - round(nr, 4)) * 20.0::DOUBLE, 2), 1) AS score FROM d")
def mth04_selection_score(t: Tables) -> DataFrame:
    m = Rec.ocr_metrics(F.col("text"))
    cols = t.documents.select("doc_id", *[c.alias(n) for n, c in m.items()])
    return cols.select("doc_id", F.round(Rec.selection_score({n: F.col(n) for n in m}), 1).alias("score"))


@query(f"SELECT conv_id, turn, {ws('text')} AS text FROM conversations")
def str09_clean_artifacts(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", X.normalize_ws(F.col("text")).alias("text"))


@query("SELECT o_orderkey, 'Virginia Code and Virginia, Section ' || o_custkey || '; motion PSA psalm I can' AS text, CAST(6 AS BIGINT) AS n FROM orders")
def str10_misheard(t: Tables) -> DataFrame:
    """Ordered replacements: the longer of two goes first, words that only begin alike stay, and each is counted."""
    said = F.concat(F.lit("gini COEFFICIENT and Gini, kaneko "), F.col("o_custkey").cast("string"), F.lit("; moticn psa psalm akane"))
    fixed, n = Rec.misheard(said)
    return t.orders.select("o_orderkey", fixed.alias("text"), n.cast("long").alias("n"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Planning Commission' WHEN 1 THEN 'Water Authority' ELSE 'Town Council' END AS name FROM supplier")
def str12_misread_names(t: Tables) -> DataFrame:
    raw = F.when(F.col("s_suppkey") % 3 == 0, "Smith- Planning  Comnission").when(F.col("s_suppkey") % 3 == 1, "Water AUTHORTY").otherwise("Town Counciy")
    return t.supplier.select("s_suppkey", Rec.misread_name(raw).alias("name"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'PEOPLE' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'LEGAL_REFERENCE' ELSE c_mktsegment END AS category FROM customer")
def str15_category(t: Tables) -> DataFrame:
    raw = F.when(F.col("c_custkey") % 4 == 0, " person ").when(F.col("c_custkey") % 4 == 1, "").when(F.col("c_custkey") % 4 == 2, "legal_reference").otherwise(F.lower("c_mktsegment"))
    return t.customer.select("c_custkey", Rec.category(raw).alias("category"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'O-2024-' || o_custkey WHEN 1 THEN 'O-2023-' || o_custkey WHEN 2 THEN '9-2023-' || o_custkey END AS number FROM orders")
def str16_document_number(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey").cast("string")
    raw = F.when(k == 0, F.concat(F.lit("(q-2024- "), c, F.lit("):"))).when(k == 1, F.concat(F.lit("0-2023-"), c)).when(k == 2, F.concat(F.lit("9-2023-"), c)).otherwise(" [] ")
    return t.orders.select("o_orderkey", Rec.document_number(raw, F.when(k == 0, "ORDINANCE").otherwise("RESOLUTION")).alias("number"))


@query("SELECT o_orderkey, '2.2-37' || (10 + o_orderkey % 90) || '(A)(' || (o_custkey % 9) || ')' AS statute FROM orders")
def str17_statute(t: Tables) -> DataFrame:
    n, c = (10 + F.col("o_orderkey") % 90).cast("string"), (F.col("o_custkey") % 9).cast("string")
    raw = F.concat(F.lit("Va Code  Section 2.2 - 37"), n, F.lit(" (a) ("), c, F.lit(") ;"))
    return t.orders.select("o_orderkey", Rec.statute_reference(raw).alias("statute"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE 'source.pdf' END AS name FROM customer")
def str22_first_name_field(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 3
    return t.customer.select("c_custkey", Rec.first_name_field(F.when(k == 0, F.col("c_name")).otherwise(""), F.when(k == 1, F.col("c_mktsegment")), F.lit("")).alias("name"))


@query(f"SELECT doc, i, nullif(regexp_extract(text, 'this is ([A-Z][a-z]+)', 1), '') AS name FROM ({civic.TURNS}) WHERE text LIKE '%this is%'")
def str27_self_named(t: Tables) -> DataFrame:
    return civic.turns(t).select("doc", "i", Rec.self_named(F.col("text")).alias("name")).where("name IS NOT NULL")


@query(f"SELECT doc, line_no, string_agg(near, ' ' ORDER BY other) AS around FROM (SELECT a.doc, a.line_no, b.line_no AS other, b.line AS near FROM {L} a JOIN {L} b ON a.doc = b.doc AND b.line_no BETWEEN a.line_no AND a.line_no + 5 WHERE a.line LIKE 'ORDINANCE NO%' AND trim(b.line) <> '') GROUP BY doc, line_no")
def str25_header_context(t: Tables) -> DataFrame:
    """A header line with the next five lines, where its number and title may stand."""
    from gavelframe.operators import lanes

    near = lanes.context(civic.lines(t), ahead=5, back=0)
    return near.where(F.col("line").startswith("ORDINANCE NO")).select("doc", "line_no", F.array_join(F.filter("near", lambda x: F.trim(x) != ""), " ").alias("around"))


@query("SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS n, substr(text, 1, 40) AS around FROM documents WHERE length(text) > 60 AND NOT regexp_matches(substr(text, 1, 60), '\\s\\s|[^\\x20-\\x7E]|^\\s') AND substr(text, 40, 1) <> ' '")
def str24_context_slice(t: Tables) -> DataFrame:
    """The text around a place: here from the start on, 40 characters."""
    d = t.documents.where(r"length(text) > 60 AND NOT text RLIKE '^.{0,59}[^\\x20-\\x7E]' AND NOT substring(text, 1, 60) RLIKE '  |^ |[^\\x20-\\x7E]' AND substring(text, 40, 1) <> ' '")
    return d.select("doc_id", F.size(F.split("text", " ")).cast("long").alias("n"), X.context_slice(F.col("text"), F.lit(1), F.lit(10), 30).alias("around"))


@query("SELECT conv_id, turn, array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')[1:5], ' ') AS first_words FROM conversations")
def str04_unicode_tokens(t: Tables) -> DataFrame:
    """Words of any script, lower-cased: the first five."""
    return t.conversations.select("conv_id", "turn", F.array_join(F.slice(X.words(F.col("text")), 1, 5), " ").alias("first_words"))


@query("SELECT page_id, sha256(html) AS sha FROM pages")
def str21_sha256(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.sha2("html", 256).alias("sha"))
