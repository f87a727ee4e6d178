"""Queries of the page engine: over civic pages made of the orders' lines, and over signal tables of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.functions import pages as P
from gavelframe.functions import text as X
from gavelframe.operators import page_folds
from gavelframe.plans import civic
from gavelframe.plans.catalog import Tables, query

PG = f"({civic.PAGES})"
TRUST = "CASE WHEN engine = 'native' THEN TRUE WHEN engine = 'blank_skip' THEN page_type = 'blank_separator' ELSE witness <> 'weak' AND NOT (quality < 0.28 OR (CASE WHEN layout_type IN ('table', 'mixed', 'form') THEN word_count < 4 AND numeric_tokens < 2 AND NOT strong_table ELSE word_count < 4 END) OR (retried AND margin < 12)) END"
LANE = f"CASE WHEN page_type = 'blank_separator' THEN 'default' WHEN NOT ({TRUST}) THEN 'weak_fallback' WHEN page_type = 'table_or_mixed_layout' OR layout_type IN ('table', 'mixed') OR strong_table THEN 'table_specialist' ELSE 'default' END"


def case_map(x: str, table: dict[str, str], other: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {other} END"


FAMILY = case_map("page_type", P.FAMILY_OF, "'structural'")
FUNCTION = case_map("family", P.FUNCTION_OF, "'unknown'")


def _near(x: str, none: tuple[str, ...], back: bool) -> str:
    skip = ", ".join(f"'{n}'" for n in none)
    kept = f"CASE WHEN {x} NOT IN ({skip}) THEN {x} END"
    return f"last_value({kept} IGNORE NULLS) OVER (PARTITION BY run ORDER BY page ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)" if back else f"first_value({kept} IGNORE NULLS) OVER (PARTITION BY run ORDER BY page ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING)"


_NEAR_TYPE = [f"{'last' if b else 'first'}_value(CASE WHEN family NOT IN ('blank', 'generic', 'presentation', 'structural') THEN page_type END IGNORE NULLS) OVER (PARTITION BY run ORDER BY page ROWS BETWEEN {'2 PRECEDING AND 1 PRECEDING' if b else '1 FOLLOWING AND 2 FOLLOWING'})" for b in (True, False)]
AXES = f"""SELECT *, {_near('family', P.NO_FAMILY, True)} AS prev_family, {_near('family', P.NO_FAMILY, False)} AS next_family, {_near('function', P.NO_FUNCTION, True)} AS prev_function, {_near('function', P.NO_FUNCTION, False)} AS next_function, {_NEAR_TYPE[0]} AS prev_type, {_NEAR_TYPE[1]} AS next_type
FROM (SELECT *, {FUNCTION} AS function FROM (SELECT *, {FAMILY} AS family, {TRUST} AS trusted, {LANE} AS lane FROM {PG}))"""
SUSPICION = f"""SELECT *, round(least(0.99::DOUBLE, 0.0::DOUBLE + CASE WHEN round(confidence - runner_up, 2) <= 0.08 THEN 0.22::DOUBLE ELSE 0 END + CASE WHEN source = 'context' THEN 0.18::DOUBLE ELSE 0 END + CASE WHEN confidence < 0.7 THEN 0.18::DOUBLE ELSE 0 END + CASE WHEN confidence < 0.55 THEN 0.12::DOUBLE ELSE 0 END + CASE WHEN NOT trusted THEN 0.26::DOUBLE ELSE 0 END
 + CASE WHEN page_type = 'blank_separator' AND table_regions + text_regions >= 20 THEN 0.45::DOUBLE ELSE 0 END + CASE WHEN form_hits > 0 AND contract_hits > 0 THEN 0.18::DOUBLE ELSE 0 END
 + CASE WHEN prev_family = next_family AND family NOT IN ('blank', 'generic', 'presentation', 'structural') AND family <> prev_family THEN 0.22::DOUBLE ELSE 0 END + CASE WHEN prev_function = next_function AND function NOT IN ('separator', 'unknown') AND function <> prev_function THEN 0.18::DOUBLE ELSE 0 END
 + CASE WHEN prev_type = next_type AND page_type <> prev_type AND source <> 'semantic' THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN route = 'ocr_handwriting_page' AND contains(variant, 'rescue') AND page_type <> 'blank_separator' THEN 0.08::DOUBLE ELSE 0 END), 2) AS suspicion FROM ({AXES})"""
REVIEW = f"""SELECT *, CASE WHEN page_type = 'blank_separator' AND engine IN ('native', 'blank_skip') AND suspicion < 0.18 THEN 'auto_pass' WHEN suspicion >= 0.62 AND (witness = 'weak' OR lane = 'weak_fallback') THEN 'quarantined' WHEN route = 'ocr_handwriting_page' AND suspicion < 0.35 AND witness <> 'weak' THEN 'provisional_auto_pass'
 WHEN witness = 'weak' OR lane = 'weak_fallback' OR suspicion >= 0.35 OR route = 'manual_review_required' THEN 'review_required' WHEN lane = 'table_specialist' OR suspicion >= 0.18 OR source = 'context' OR layout_type IN ('table', 'mixed', 'form') THEN 'provisional' ELSE 'auto_pass' END AS state FROM ({SUSPICION})"""


def columns(*names: str) -> dict:
    return {n: F.col(n) for n in (*civic.SIGNALS, *names)}


def axes(t: Tables) -> DataFrame:
    """Pages with family, function, lane and the nearest substantive neighbours within two pages."""
    c = columns()
    p = civic.pages(t).withColumn("family", P.mapped(c["page_type"], P.FAMILY_OF, "structural"))
    p = p.withColumn("function", P.mapped(F.col("family"), P.FUNCTION_OF, "unknown")).withColumn("lane", P.sort_lane(c))
    near = {}
    for axis, value, none in (("family", "family", P.NO_FAMILY), ("function", "function", P.NO_FUNCTION), ("type", "page_type", P.NO_FAMILY)):
        on = F.col("function" if axis == "function" else "family")
        for side, back in (("prev", True), ("next", False)):
            near[f"{side}_{axis}"] = P.nearest(F.col(value), ~on.isin(*none), "run", "page", 2, back)
    return p.withColumns(near)


def reviewed(t: Tables) -> DataFrame:
    p = axes(t).withColumn("suspicion", P.suspicion(columns("family", "function", "prev_family", "next_family", "prev_function", "next_function", "prev_type", "next_type")))
    return p.withColumn("state", P.review_state(columns(), F.col("suspicion"), F.col("lane")))


@query(f"SELECT page_id, {TRUST} AS trusted FROM {PG}")
def cls09_trusted(t: Tables) -> DataFrame:
    return civic.pages(t).select("page_id", P.trusted(columns()).alias("trusted"))


@query(f"SELECT page_id, suspicion FROM ({SUSPICION})")
def cls10_suspicion(t: Tables) -> DataFrame:
    return reviewed(t).select("page_id", "suspicion")


@query(f"SELECT page_id, lane, state FROM ({REVIEW})")
def cls11_lane_and_review(t: Tables) -> DataFrame:
    return reviewed(t).select("page_id", "lane", "state")


@query(f"""SELECT page_id, CASE WHEN function = 'separator' OR layout_type = 'blank' THEN 'extract_blank_separator' WHEN lane = 'weak_fallback' THEN 'extract_weak_page_evidence' WHEN lane = 'table_specialist' THEN s WHEN page_type = 'invoice' THEN 'extract_invoice' WHEN function IN ('agenda', 'minutes') THEN 'extract_' || function
 WHEN function = 'reference' THEN CASE layout_type WHEN 'slide' THEN 'extract_powerpoint' ELSE 'extract_reference_or_procedure' END WHEN function = 'legislative' THEN 'extract_legislative_prose' WHEN function = 'contract' THEN 'extract_contract_or_agreement' WHEN function = 'finance' THEN CASE WHEN layout_type IN ('table', 'mixed') THEN s ELSE 'extract_financial_report' END
 WHEN function = 'admin' THEN CASE WHEN layout_type = 'form' THEN 'extract_structured_form' WHEN layout_type IN ('table', 'mixed') THEN s ELSE 'extract_government_form' END WHEN layout_type = 'slide' THEN 'extract_powerpoint' WHEN layout_type = 'form' THEN 'extract_structured_form' WHEN layout_type IN ('table', 'mixed') THEN s ELSE 'extract_' || page_type END AS extractor
 FROM (SELECT *, CASE WHEN layout_type IN ('form', 'mixed', 'table') THEN 'extract_structured_' || layout_type WHEN function IN ('finance', 'admin') THEN 'extract_structured_mixed' ELSE 'extract_structured_table' END AS s FROM ({AXES}))""")
def cls12_extractors(t: Tables) -> DataFrame:
    return axes(t).select("page_id", P.extractor(F.col("page_type"), F.col("function"), F.col("layout_type"), F.col("lane")).alias("extractor"))


@query(f"SELECT page_id FROM ({REVIEW}) WHERE state IN ('review_required', 'quarantined') AND (lane IN ('weak_fallback', 'table_specialist') OR layout_type IN ('table', 'mixed', 'form') OR route = 'ocr_handwriting_page' OR table_regions >= 4 OR rotation IN (90, 270))")
def flt07_dispatch(t: Tables) -> DataFrame:
    """Pages that go to review."""
    return reviewed(t).where(P.dispatched(F.col("state"), columns("lane"))).select("page_id")


@query(f"SELECT run, page, rank FROM (SELECT run, page, rank, row_number() OVER (PARTITION BY run ORDER BY rank, page) AS r FROM (SELECT *, CASE state WHEN 'quarantined' THEN 0 WHEN 'review_required' THEN 1 WHEN 'provisional' THEN 2 WHEN 'auto_pass' THEN 3 ELSE 9 END AS rank FROM ({REVIEW}))) WHERE r <= 12")
def srt09_review_order(t: Tables) -> DataFrame:
    """The twelve pages of each run that are reviewed first."""
    p = reviewed(t).select("run", "page", P.review_priority(F.col("state")).alias("rank"))
    return p.withColumn("r", F.row_number().over(Window.partitionBy("run").orderBy("rank", "page"))).where("r <= 12").drop("r")


@query(f"SELECT run, page FROM (SELECT run, page, row_number() OVER (PARTITION BY run ORDER BY CASE state WHEN 'quarantined' THEN 0 ELSE 1 END, page) AS r FROM ({REVIEW}) WHERE state IN ('review_required', 'quarantined') AND (lane IN ('weak_fallback', 'table_specialist') OR layout_type IN ('table', 'mixed', 'form') OR route = 'ocr_handwriting_page' OR table_regions >= 4 OR rotation IN (90, 270))) WHERE r <= 12")
def srt11_review_job(t: Tables) -> DataFrame:
    """Of the pages that go to review the first twelve by state and number."""
    p = reviewed(t).where(P.dispatched(F.col("state"), columns("lane"))).select("run", "page", P.review_priority(F.col("state")).alias("rank"))
    return p.withColumn("r", F.row_number().over(Window.partitionBy("run").orderBy("rank", "page"))).where("r <= 12").select("run", "page")


DIMS = ("page_type", "layout_type", "family", "function", "lane", "state", "route", "source")


@query(f"WITH p AS ({REVIEW}) " + " UNION ALL ".join(f"SELECT '{d}' AS dim, {d} AS label, count(*) AS n FROM p GROUP BY 2" for d in DIMS) + " UNION ALL SELECT 'suspicious', 'pages', count(*) FROM p WHERE suspicion >= 0.35")
def agg04_histograms(t: Tables) -> DataFrame:
    """Eight histograms and the number of suspicious pages, in one pass over the pages."""
    pairs = [F.struct(F.lit(d).alias("dim"), F.col(d).alias("label")) for d in DIMS]
    odd = F.when(F.col("suspicion") >= 0.35, F.struct(F.lit("suspicious").alias("dim"), F.lit("pages").alias("label")))
    return reviewed(t).select(F.explode(F.array_compact(F.array(*pairs, odd))).alias("x")).groupBy("x.dim", "x.label").agg(F.count("*").alias("n"))


@query(f"SELECT page_id, CASE WHEN NOT (abs(skew) >= 8) AND quality >= 0.82 AND alnum <= 320 THEN FALSE WHEN abs(skew) >= 8 AND alnum <= 320 THEN TRUE ELSE (alnum <= 24 OR quality < 0.24 OR word_count <= 4) AND (table_regions >= 3 OR table_regions + text_regions >= 12 OR abs(skew) >= 8) END AS retry FROM {PG}")
def cls17_retry_rotation(t: Tables) -> DataFrame:
    return civic.pages(t).select("page_id", P.retry_rotation(columns()).alias("retry"))


@query(f"SELECT page_id, CASE WHEN family NOT IN ('structural', 'generic') OR NOT trusted THEN family WHEN prev_family IS NOT NULL AND prev_family = next_family THEN prev_family WHEN prev_family IS NOT NULL AND layout_type = 'table' THEN prev_family ELSE family END AS family, CASE WHEN function <> 'unknown' OR NOT trusted THEN function WHEN prev_function IS NOT NULL AND prev_function = next_function THEN prev_function WHEN prev_function IS NOT NULL AND layout_type = 'table' THEN prev_function ELSE function END AS function FROM ({AXES})")
def win15_neighbour_consensus(t: Tables) -> DataFrame:
    """Pages without a family or function of their own take that of agreeing neighbours; tables that of the page before.

    All pages look at the families as typed: a page that took one over is no neighbour for the next, so that the windows do not chain.
    """
    fit = lambda axis, own: F.when(~own | ~P.trusted(columns()), F.col(axis)).when(F.col(f"prev_{axis}") == F.col(f"next_{axis}"), F.col(f"prev_{axis}")).when(F.col(f"prev_{axis}").isNotNull() & (F.col("layout_type") == "table"), F.col(f"prev_{axis}")).otherwise(F.col(axis))
    return axes(t).select("page_id", fit("family", F.col("family").isin("structural", "generic")).alias("family"), fit("function", F.col("function") == "unknown").alias("function"))


@query(f"SELECT run, page, last_value(CASE WHEN {TRUST} THEN page END IGNORE NULLS) OVER (PARTITION BY run ORDER BY page ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS back, first_value(CASE WHEN {TRUST} THEN page END IGNORE NULLS) OVER (PARTITION BY run ORDER BY page ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING) AS ahead FROM {PG}")
def win14_nearest_neighbour(t: Tables) -> DataFrame:
    """The nearest trusted page on either side, at most six pages off."""
    near = lambda back: P.nearest(F.col("page"), P.trusted(columns()), "run", "page", 6, back)
    return civic.pages(t).select("run", "page", near(True).alias("back"), near(False).alias("ahead"))


# carrying: an anchor is a semantic page of high confidence; weak pages take its type within six pages, blanks stop it
SEMANTIC = "page_type IN ('agenda', 'minutes', 'reference_or_procedure', 'legislative_prose', 'government_form', 'invoice', 'contract_or_agreement', 'financial_report')"
CARRY_ROWS = f"SELECT run AS doc, page AS i, page_type, {SEMANTIC} AND source = 'semantic' AND confidence >= 0.72 AS anchor, (page_type IN ('generic_prose', 'powerpoint') OR (page_type = 'table_or_mixed_layout' AND NOT strong_table)) AND ({TRUST}) AS weak, form_hits > 0 AS evidence FROM {PG}"
_SANDWICH = f"""SELECT *, CASE WHEN weak AND before_type = after_type AND evidence THEN before_type ELSE page_type END AS typed FROM (SELECT *, last_value(CASE WHEN anchor THEN page_type END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS before_type, first_value(CASE WHEN anchor THEN page_type END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS after_type FROM ({CARRY_ROWS}))"""
_GROUPED = f"SELECT *, sum(CASE WHEN page_type = 'blank_separator' THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY i) AS part FROM ({_SANDWICH})"


def _carried(x: str, rows: str, back: bool) -> str:
    pos = f"{'max' if back else 'min'}(CASE WHEN anchor THEN i END) OVER (PARTITION BY doc, part ORDER BY i{'' if back else ' DESC'})"
    kind = f"last_value(CASE WHEN anchor THEN page_type END IGNORE NULLS) OVER (PARTITION BY doc, part ORDER BY i{'' if back else ' DESC'} ROWS UNBOUNDED PRECEDING)"
    return f"SELECT * EXCLUDE ({x}, pos, kind), CASE WHEN still AND pos IS NOT NULL AND abs(i - pos) <= 6 AND evidence THEN kind ELSE {x} END AS {x} FROM (SELECT *, weak AND ({x} = page_type) AND NOT anchor AND page_type <> 'blank_separator' AS still, {pos} AS pos, {kind} AS kind FROM ({rows}))"


@query(f"SELECT doc AS run, i AS page, typed AS page_type FROM ({_carried('typed', 'SELECT * EXCLUDE (still) FROM (' + _carried('typed', _GROUPED, True) + ')', False)})")
def win12_carry(t: Tables) -> DataFrame:
    """Weak pages between, behind and before anchors take their type."""
    c = columns()
    rows = civic.pages(t).select("run", "page", "page_type", page_folds.is_anchor(c).alias("anchor"), (page_folds.is_weak(c) & P.trusted(c)).alias("weak"), (F.col("form_hits") > 0).alias("evidence"))
    return page_folds.carry(rows).select("run", "page", F.col("typed").alias("page_type"))


PT = f"({civic.PAGE_TEXTS})"
_LINES = "list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def _counter(name: str) -> str:
    p, most, no = P.LINE_COUNTERS[name]
    quote = lambda x: x.replace("'", "''")
    return f"len(list_filter(ls, lambda x: regexp_matches(x, '(?i){quote(p)}')" + (f" AND length(x) <= {most}" if most else "") + (f" AND NOT regexp_matches(x, '{quote(no)}')" if no else "") + f")) AS {name}"


_DIGITS = "len(regexp_extract_all(x, '[0-9]'))"
METRICS = f"""SELECT *, {', '.join(_counter(n) for n in P.LINE_COUNTERS)}, len(list_filter(ls, lambda x: length(x) > 72 AND regexp_matches(x, '^[^:]{{1,40}}:'))) AS inline_clause_heading_lines, len(list_filter(ls, lambda x: length(x) >= 90)) AS paragraph_lines,
 len(list_filter(ls, lambda x: regexp_matches(x, '{P.ACCOUNT}') OR regexp_matches(x, '{P.MONEY}') OR ({_DIGITS} >= 8 AND length(x) <= 90) OR (length(x) <= 24 AND {_DIGITS} >= 2 AND regexp_matches(x, '[$()''.,]')))) AS numeric_table_lines,
 len(regexp_extract_all(text, '{P.ACCOUNT}')) AS account_code_count, len(regexp_extract_all(text, '{P.MONEY}')) AS currency_count, len(ls) AS line_count, CASE WHEN len(ls) > 0 THEN round(len(list_filter(ls, lambda x: length(x) <= 96)) / len(ls), 2) ELSE 0.0 END AS short_ratio FROM (SELECT *, {_LINES} AS ls, lower(trim(regexp_replace(text, '[\\s\\p{{Z}}]+', ' ', 'g'))) AS low, length(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS alnum FROM {PT})"""
COUNTS = (*P.LINE_COUNTERS, "inline_clause_heading_lines", "paragraph_lines", "numeric_table_lines", "account_code_count", "currency_count", "line_count")


@query(f"SELECT doc, {', '.join(f'CAST({n} AS BIGINT) AS {n}' for n in COUNTS)}, CAST(short_ratio AS DOUBLE) AS short_ratio FROM ({METRICS})")
def cls01_line_counters(t: Tables) -> DataFrame:
    m = P.line_metrics(F.col("text"))
    return civic.page_texts(t).select("doc", *[m[n].cast("long").alias(n) for n in COUNTS], m["short_ratio"].alias("short_ratio"))


_STRUCTURE = "(compact_field_label_lines >= 4 OR (compact_field_label_lines >= 3 AND signature_form_lines >= 2))"
_STRONG = "(account_code_count >= 4 OR numeric_table_lines >= 6 OR (currency_count >= 4 AND short_ratio >= 0.55))"
_SUPPORTED = "(table_regions >= 2 AND numeric_table_lines >= 2 AND paragraph_lines <= 2)"


def _hits(x: str, patterns: tuple[str, ...]) -> str:
    return "(" + " + ".join("CAST(regexp_matches({}, '{}') AS INTEGER)".format(x, p.replace("'", "''")) for p in patterns) + ")"


_COVER = f"(compact_field_label_lines >= 4 AND {_hits('low', P.COVER_SECTIONS)} >= 1 AND ({_hits('low', P.COVER_FIELDS)} >= 2 OR {_hits('low', P.COVER_MEETINGS)} >= 1))"


@query(f"SELECT doc, {_STRUCTURE} AS form_structure, {_COVER} AS packet_cover FROM ({METRICS})")
def cls03_structures(t: Tables) -> DataFrame:
    m = P.line_metrics(F.col("text"))
    d = civic.page_texts(t).select("doc", F.lower(X.normalize_ws(F.col("text"))).alias("low"), *[c.alias(n) for n, c in m.items()])
    m = {n: F.col(n) for n in m}
    return d.select("doc", P.form_structure(m).alias("form_structure"), P.packet_cover(F.col("low"), m).alias("packet_cover"))


@query(f"SELECT doc, {_STRONG} AS strong_table, {_SUPPORTED} AS supported, line_count > 0 AND line_count <= 18 AND paragraph_lines <= 1 AND account_code_count = 0 AND currency_count <= 2 AND bullet_lines >= 4 AND short_ratio >= 0.85 AND numeric_table_lines <= 2 AND motion_lines = 0 AS slide, route = 'ocr_handwriting_page' AND alnum = 0 AND table_regions + text_regions >= 40 AND text_regions >= 20 AS false_blank FROM ({METRICS})")
def cls04_table_slide_blank(t: Tables) -> DataFrame:
    m = P.line_metrics(F.col("text"))
    d = civic.page_texts(t).select("*", X.alnum_count(F.col("text")).alias("alnum"), *[c.alias(n) for n, c in m.items()])
    m = {n: F.col(n) for n in m}
    return d.select("doc", P.strong_table(m).alias("strong_table"), P.table_supported(m, F.col("table_regions")).alias("supported"), P.slide(m).alias("slide"), P.false_blank(F.col("alnum"), F.col("table_regions"), F.col("text_regions"), F.col("route")).alias("false_blank"))


_B = lambda test, b: f"CASE WHEN {test} THEN {b}::DOUBLE ELSE 0.0::DOUBLE END"
_HEADER = "lower(array_to_string(ls[1:8], chr(10)))"
_SCORED = f"""SELECT *, h_head + h_support + CASE WHEN h_head > 0 OR h_support > 0 OR {_STRUCTURE} THEN h_body ELSE 0 END AS h_government_form FROM (SELECT *, {', '.join(f'{_hits("low", p)} AS h_{n}' for n, p in P.FAMILIES.items())}, {_hits(_HEADER, P.FORM_HEADER)} AS h_head, {_hits('low', P.FORM_SUPPORT)} AS h_support, {_hits('low', P.FORM_BODY)} AS h_body,
 regexp_matches(low, '{P.PROCEDURE.replace("'", "''")}') AS procedure, {_COVER} AS cover, regexp_matches(low, '{P.STAFF_SUMMARY}') AS staff FROM ({METRICS}))"""
_FIN = "(finance_lines > 0 OR h_financial_report > 0)"
_SCORES = {
    "agenda": (f"NOT (agenda_list_lines = 0 AND NOT regexp_matches(low, 'call meeting to order|scheduled public comments|adjourn meeting|next regular meeting') AND h_agenda <= 2) AND NOT cover AND h_agenda > 0", f"0.0::DOUBLE + {_B('staff', -0.14)} + {_B('agenda_list_lines >= 4', 0.18)} + {_B("contains(low, 'adjourn meeting') AND contains(low, 'next regular meeting')", 0.08)} + least(0.16::DOUBLE, agenda_list_lines * 0.03::DOUBLE)"),
    "minutes": ("NOT (procedure AND h_minutes = 0) AND (h_minutes > 0 OR motion_lines + vote_lines > 0)", "least(0.28::DOUBLE, motion_lines * 0.08::DOUBLE + vote_lines * 0.06::DOUBLE)"),
    "reference_or_procedure": ("h_reference_or_procedure > 0", f"least(0.2::DOUBLE, section_lines * 0.04::DOUBLE + paragraph_lines * 0.02::DOUBLE) + {_B('procedure', 0.12)}"),
    "legislative_prose": ("h_legislative_prose > 0 AND regexp_matches(low, '\\bresolution\\b|\\bwhereas\\b|be it resolved|now[, ]+therefore')", "least(0.2::DOUBLE, vote_lines * 0.04::DOUBLE)"),
    "government_form": (f"NOT cover AND NOT staff AND h_government_form > 0 AND NOT (h_head > 0 AND h_support = 0 AND h_body = 0 AND NOT {_STRUCTURE}) AND NOT (h_head > 0 AND h_support = 0 AND h_body = 0 AND contract_lines > 0 AND compact_field_label_lines < 2)", "least(0.18::DOUBLE, heading_lines * 0.02::DOUBLE) + least(0.22::DOUBLE, compact_field_label_lines * 0.03::DOUBLE + signature_form_lines * 0.05::DOUBLE)"),
    "invoice": ("h_invoice > 0", "0.0::DOUBLE"),
    "contract_or_agreement": ("h_contract_or_agreement > 0", f"least(0.24::DOUBLE, section_lines * 0.04::DOUBLE + contract_lines * 0.03::DOUBLE) + least(0.18::DOUBLE, inline_clause_heading_lines * 0.05::DOUBLE) + {_B('section_lines >= 4 AND contract_lines >= 1 AND finance_lines = 0', 0.12)} + {_B('compact_field_label_lines = 0 AND inline_clause_heading_lines >= 2', 0.08)}"),
    "financial_report": (f"{_FIN} OR currency_count > 0", f"least(0.2::DOUBLE, finance_lines * 0.03::DOUBLE + currency_count * 0.01::DOUBLE) + {_B('cover AND ' + _FIN, 0.12)} + {_B('NOT cover AND staff AND ' + _FIN, 0.18)} + {_B('h_financial_report >= 2 AND numeric_table_lines <= 1 AND currency_count = 0 AND account_code_count = 0', 0.08)} + {_B('finance_lines >= 3 AND numeric_table_lines <= 3 AND currency_count <= 2 AND account_code_count = 0', 0.1)} + {_B('paragraph_lines = 0 AND short_ratio >= 0.95 AND line_count <= 18 AND currency_count >= 6', -0.14)}"),
}
_TABLE = f"0.5::DOUBLE + least(0.18::DOUBLE, numeric_table_lines * 0.02::DOUBLE) + least(0.16::DOUBLE, account_code_count * 0.03::DOUBLE) + least(0.12::DOUBLE, currency_count * 0.01::DOUBLE) + {_B(_SUPPORTED, 0.06)} + {_B('numeric_table_lines >= 20', 0.06)} + {_B('account_code_count >= 8', 0.06)} + {_B('currency_count >= 20', 0.06)} + {_B('paragraph_lines > 2', -0.12)}"
_RAW = f"""SELECT *, {', '.join(f'CASE WHEN ({ok}) AND (h_{n} > 0 OR ({b}) >= 0.16) THEN round(least(0.99::DOUBLE, 0.3::DOUBLE + h_{n} * 0.12::DOUBLE + ({b})), 2) END AS s_{n}' for n, (ok, b) in _SCORES.items())},
 greatest(CASE WHEN {_STRONG} OR {_SUPPORTED} THEN round(least(0.99::DOUBLE, {_TABLE}), 2) END, CASE WHEN table_regions >= 20 AND line_count <= 18 AND short_ratio >= 0.95 AND paragraph_lines = 0 THEN 0.72::DOUBLE END, CASE WHEN abs(skew) >= 12 AND table_regions >= 4 AND short_ratio >= 0.95 AND paragraph_lines = 0 THEN 0.7::DOUBLE END, CASE WHEN regexp_matches(low, '{P.REPORT_SUMMARY}') THEN 0.6::DOUBLE END) AS s_table_or_mixed_layout,
 CASE WHEN line_count BETWEEN 1 AND 18 AND paragraph_lines <= 1 AND account_code_count = 0 AND currency_count <= 2 AND bullet_lines >= 4 AND short_ratio >= 0.85 AND numeric_table_lines <= 2 AND motion_lines = 0 THEN round(0.62::DOUBLE + least(0.12::DOUBLE, bullet_lines * 0.03::DOUBLE), 2) END AS s_powerpoint FROM ({_SCORED})"""
_TIED = f"SELECT * REPLACE (CASE WHEN s_contract_or_agreement >= s_government_form - 0.02::DOUBLE AND contract_lines >= 8 AND field_label_lines < 4 AND h_head = 0 AND h_support = 0 THEN round(least(0.99::DOUBLE, greatest(s_contract_or_agreement, s_government_form + 0.01::DOUBLE)), 2) ELSE s_contract_or_agreement END AS s_contract_or_agreement, CASE WHEN (h_head > 0 OR h_support > 0) AND h_government_form >= 2 AND contract_lines < 8 AND s_contract_or_agreement IS NOT NULL AND s_government_form IS NOT NULL THEN round(least(0.99::DOUBLE, greatest(s_government_form, s_contract_or_agreement + 0.01::DOUBLE)), 2) ELSE s_government_form END AS s_government_form) FROM ({_RAW})"
_BLANK = "(low = '' OR alnum = 0 OR (alnum <= 24 AND text_regions <= 12)) AND NOT (route = 'ocr_handwriting_page' AND alnum = 0 AND table_regions + text_regions >= 40 AND text_regions >= 20)"
_ALL = [*_SCORES, "table_or_mixed_layout", "powerpoint"]
_RANKED = "list_sort(list_filter([" + ", ".join(f"CASE WHEN s_{n} IS NOT NULL THEN {{'s': -s_{n}, 'p': {P.PRIORITY.index(n)}, 'n': '{n}'}} END" for n in _ALL) + "], lambda x: x IS NOT NULL))"
TYPED = f"SELECT *, CASE WHEN {_BLANK} THEN 'blank_separator' ELSE coalesce(ranked[1].n, 'generic_prose') END AS page_type, CASE WHEN {_BLANK} THEN 1.0::DOUBLE ELSE coalesce(-ranked[1].s, CASE WHEN paragraph_lines > 0 THEN 0.42::DOUBLE ELSE 0.28::DOUBLE END) END AS confidence FROM (SELECT *, {_RANKED} AS ranked FROM ({_TIED}))"


@query(f"SELECT doc, page_type, confidence FROM ({TYPED})")
def cls02_page_types(t: Tables) -> DataFrame:
    """The scorer over twelve types of pages."""
    return P.with_candidates(civic.page_texts(t)).select("doc", "best.page_type", "best.confidence")


@query(f"SELECT doc, n AS page_type, -s AS score FROM (SELECT doc, unnest(ranked, recursive := true) FROM ({TYPED}) WHERE NOT ({_BLANK}))")
def srt03_candidates(t: Tables) -> DataFrame:
    """All candidate types of a page with their scores."""
    p = P.with_candidates(civic.page_texts(t))
    some = F.col("best.page_type") != "blank_separator"
    rows = F.array_compact(F.array(*[F.when(some & F.col(f"s_{n}").isNotNull(), F.struct(F.lit(n).alias("page_type"), F.col(f"s_{n}").alias("score"))) for n in _ALL]))
    # no filter on the array goes below the projections that make it
    return p.select("doc", F.inline_outer(rows)).where("page_type IS NOT NULL")


@query(f"SELECT doc, CASE WHEN page_type = 'blank_separator' THEN 'blank' WHEN page_type = 'powerpoint' THEN 'slide' WHEN page_type IN ('government_form', 'invoice') THEN 'form' WHEN h_support > 0 AND contract_lines < 8 AND finance_lines = 0 AND vote_lines = 0 THEN 'form' WHEN page_type = 'contract_or_agreement' AND account_code_count = 0 AND currency_count <= 1 THEN 'prose' WHEN {_STRONG} THEN 'table' WHEN page_type = 'table_or_mixed_layout' THEN CASE WHEN table_regions >= 20 AND (numeric_table_lines > 0 OR currency_count > 0 OR account_code_count > 0) THEN 'table' ELSE 'mixed' END WHEN page_type = 'agenda' THEN 'outline' ELSE 'prose' END AS layout FROM ({TYPED})")
def cls05_layouts(t: Tables) -> DataFrame:
    p = P.with_candidates(civic.page_texts(t)).withColumn("page_type", F.col("best.page_type")).withColumn("support_hits", F.col("form_support"))
    c = {n: F.col(n) for n in ("page_type", "support_hits", "contract_lines", "finance_lines", "vote_lines", "account_code_count", "currency_count", "numeric_table_lines", "table_regions")}
    m = {n: F.col(n) for n in (*COUNTS, "short_ratio")}
    return p.select("doc", P.layout(c | {"strong_table": P.strong_table(m)}).alias("layout"))


_EVIDENCE = {"financial": "h_financial_report > 0 OR finance_lines > 0 OR currency_count > 0 OR account_code_count > 0", "contract": "h_contract_or_agreement > 0 OR contract_lines > 0", "form": f"h_government_form > 0 OR {_STRUCTURE} OR h_support > 0", "minutes": "h_minutes > 0 OR motion_lines > 0 OR vote_lines > 0", "agenda": "h_agenda > 0 OR agenda_list_lines >= 4", "procedure": "h_reference_or_procedure > 0 OR procedure", "legislative": "h_legislative_prose > 0", "invoice": "h_invoice > 0"}
_CANDIDATE = "list_filter(ranked, lambda x: x.n NOT IN ('table_or_mixed_layout', 'powerpoint'))[1].n"


@query(f"SELECT doc, family, {FUNCTION} AS function FROM (SELECT doc, CASE WHEN direct NOT IN ('structural', 'generic') THEN direct WHEN candidate IS NOT NULL THEN {case_map('candidate', P.FAMILY_OF, chr(39) + 'structural' + chr(39))} {' '.join(f'WHEN {test} THEN {chr(39)}{n}{chr(39)}' for n, test in _EVIDENCE.items())} ELSE direct END AS family FROM (SELECT *, {FAMILY} AS direct, CASE WHEN {_BLANK} THEN NULL ELSE {_CANDIDATE} END AS candidate FROM ({TYPED})))")
def cls06_family_and_function(t: Tables) -> DataFrame:
    """Both axes of a page: its label, else its best semantic candidate, else evidence in its lines."""
    p = P.with_candidates(civic.page_texts(t))
    semantic = [n for n in _ALL if n not in ("table_or_mixed_layout", "powerpoint")]
    top = P.best_type({n: F.col(f"s_{n}") for n in semantic}, F.lit(None).cast("double"))
    candidate = F.when(top["source"] == "semantic", top["page_type"])
    evidence = {n: F.expr(test.replace("h_support", "form_support")) for n, test in _EVIDENCE.items()}
    f = P.family(F.col("best.page_type"), candidate, F.lit(None).cast("string"), evidence)
    return p.select("doc", f.alias("family")).withColumn("function", P.mapped(F.col("family"), P.FUNCTION_OF, "unknown"))


# supporting pages: two phrases of a subtype, in the header or below
SUPPORT = civic.cases("o_orderkey", civic.text("Certificate of Coverage", "the certificate holder is named", "amendatory endorsement", "additional insured and covered person", "Explanation of Content", "included in this document package", "we are requesting a copy", "thank you for your assistance", "a line", "another line", "one more line"))
SUPPORT_TEXTS = f"SELECT o_custkey AS doc, string_agg(line, chr(10) ORDER BY o_orderkey) AS text FROM (SELECT o_custkey, o_orderkey, {SUPPORT} AS line FROM orders) GROUP BY o_custkey"


def _subtype(name: str, p: int) -> str:
    patterns, bonuses = P.SUBTYPES[name]
    score = f"0.58::DOUBLE + {_hits('header', patterns)} * 0.12::DOUBLE + {_hits('low', patterns)} * 0.06::DOUBLE + (0.0::DOUBLE + " + " + ".join(_B(f"regexp_matches({'header' if top else 'low'}, '{b}')", x) for b, x, top in bonuses) + ")"
    return f"CASE WHEN {_hits('header', patterns)} > 0 OR {_hits('low', patterns)} >= 2 THEN {{'s': -round(least(0.99::DOUBLE, {score}), 2), 'p': {p}, 'n': '{name}'}} END"


@query(f"SELECT doc, best.n AS subtype, -best.s AS score FROM (SELECT doc, list_sort(list_filter([{', '.join(_subtype(n, i) for i, n in enumerate(P.SUBTYPES))}], lambda x: x IS NOT NULL))[1] AS best FROM (SELECT doc, lower(text) AS low, lower(array_to_string({_LINES}[1:8], chr(10))) AS header FROM ({SUPPORT_TEXTS}))) WHERE best IS NOT NULL")
def cls07_support_subtypes(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr("o_custkey AS doc", "o_orderkey", f"{SUPPORT} AS line").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "line"))).alias("ls"))
    text = rows.select("doc", F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("text"))
    return text.select("doc", P.support_subtype(F.col("text")).alias("x")).where("x IS NOT NULL").select("doc", "x.subtype", "x.score")


@query("SELECT doc, subtype FROM (SELECT doc, subtype, row_number() OVER (PARTITION BY doc ORDER BY score DESC, p) AS r FROM (SELECT o_custkey AS doc, o_orderkey % 4 AS p, CASE o_orderkey % 4 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(P.SUBTYPES)) + " END AS subtype, max(o_custkey % 3 + o_orderkey % 7) AS score FROM orders GROUP BY 1, 2, 3)) WHERE r = 1")
def srt04_subtype_priority(t: Tables) -> DataFrame:
    """The best of each document's candidate subtypes, ties by the table's order."""
    rows = t.orders.groupBy(F.col("o_custkey").alias("doc"), (F.col("o_orderkey") % 4).alias("p")).agg(F.max(F.col("o_custkey") % 3 + F.col("o_orderkey") % 7).alias("score"))
    best = rows.groupBy("doc").agg(F.min(F.struct(-F.col("score"), "p")).alias("b"))
    return best.select("doc", F.get(F.array(*map(F.lit, P.SUBTYPES)), F.col("b.p").cast("int")).alias("subtype"))


@query("SELECT o_custkey, CAST(count(*) FILTER (contains(region, '_TAB_')) AS BIGINT) AS tables, CAST(count(*) FILTER (NOT contains(region, '_TAB_')) AS BIGINT) AS texts FROM (SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'P_TAB_' ELSE 'P_TXT_' END || o_orderkey AS region FROM orders) GROUP BY o_custkey")
def agg17_regions(t: Tables) -> DataFrame:
    """Table and text regions of a page, by the marker in their ids."""
    ids = t.orders.groupBy("o_custkey").agg(F.collect_list(F.concat(F.when(F.col("o_orderkey") % 3 == 0, "P_TAB_").otherwise("P_TXT_"), F.col("o_orderkey").cast("string"))).alias("ids"))
    tables = F.size(F.filter("ids", lambda r: r.contains("_TAB_")))
    return ids.select("o_custkey", tables.cast("long").alias("tables"), (F.size("ids") - tables).cast("long").alias("texts"))
