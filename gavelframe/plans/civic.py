"""Civic material over the driver tables: expressions that both engines evaluate alike, so that rules for lines, turns, pages and
registries meet text on which they fire, at the size of the tables. An order is a line, a turn or a page; its customer the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelframe.plans.catalog import Tables

KEY = "(o_orderkey * 31 + o_custkey)"


def cases(key: str, values: list[str]) -> str:
    """One of the values (SQL expressions) by the key's remainder."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1])) + f" ELSE {values[-1]} END"


def text(*lines: str) -> list[str]:
    return [f"'{x}'" for x in lines]


LINE = cases(KEY, [
    *text("I. CALL TO ORDER", "II. REPORTS", "III. ADJOURNMENT", "a. Town Manager Report", "Department Head Reports", "the monthly financial report was mailed", "Council Member Reports", "Attorney Report"),
    "'ORDINANCE NO. 0-2024-' || (10 + o_orderkey % 80)", "'RESOLUTION NO. R-2023-' || (10 + o_orderkey % 80)", *text("A RESOLUTION to honor the fire department", "AN ORDINANCE to amend the zoning map", "RESOLUTION"),
    *text("Executive Session", "closed session on personnel matters, code 2.2-3711 (A)(1)", "EXECUTIVE SESSION ON LEGAL COUNSEL", "is there a motion to go into executive session"), "'contract negotiation for land, section 2.2-3711(A)(' || (1 + o_orderkey % 8) || ')'",
    "'Meeting date: March ' || (1 + o_orderkey % 31) || ', 2024'", "'held on ' || (1 + o_orderkey % 13) || '/' || (1 + o_orderkey % 31) || '/24 as posted'", "'at ' || (1 + o_orderkey % 14) || ':' || (10 + o_orderkey % 50) || ' P.M. in the hall'", "'doors open at ' || (1 + o_orderkey % 12) || ' am'",
    *text("", "  ", "motion by Smith, seconded by Jones", "Votes: unanimous", "roll call vote of members present", "- a bullet of few words", "* another bullet"), "'101-4000-' || (10000 + o_orderkey % 9000) || ' office supplies'", "'Total $' || (1 + o_orderkey % 900) || ',500.25 paid'", "'Staff contact: Person ' || (o_orderkey % 50)",
    "'Phone: 555-01' || (10 + o_orderkey % 80)", *text("Signature: ________", "Section IV General terms", "this agreement is made between the lessor and the lessee", "budget and fund balance by department", "WHEREAS the council finds it so; be it resolved"),
    "(100 + o_orderkey % 9000) || ' Oak Hill Street'", *text("Planning Commission and Town Council", "a sentence of prose that goes on for rather more than ninety characters so that it counts as one paragraph line"), "'12 ' || (o_orderkey % 100) || ' 34 ' || (o_custkey % 100) || ' 5678'", *text("1. approve the minutes", "b) receive the audit", "PAGE 3", "call meeting to order", "next regular meeting"),
])
#: the lines of a document; line_no counts from 1
LINES = f"SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS line_no, {LINE} AS line FROM orders"

TURN = cases(KEY, text(
    "the meeting will come to order", "let us pray", "I pledge allegiance to the flag", "any additions or deletions tonight", "we approve the agenda", "please call the roll", "roll call vote Smith Yes Jones No", "call the roll Smith", "call the roll Please Yes Al No", "thank you Alice",
    "my name is Ann Lee and I live here", "Jones makes the motion", "I second that", "so moved", "is there a motion", "public comments please come forward", "aye", "Yes.", "any comments from Baker?", "we are adjourned", "one two three four five six seven eight nine ten eleven", "a quiet remark", "next item",
    "call the roll Brown. Aye", "Brown", "this is Carol speaking", "the motion carries"))
TURNS = f"SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, {TURN} AS text FROM orders"

TYPES = ("blank_separator", "agenda", "minutes", "reference_or_procedure", "legislative_prose", "government_form", "invoice", "contract_or_agreement", "financial_report", "powerpoint", "table_or_mixed_layout", "generic_prose")
#: signals of a page as the image and typing stages leave them
SIGNALS = {
    "page_type": cases(KEY, text(*TYPES)),
    "layout_type": cases(f"({KEY} + o_orderkey)", text("blank", "slide", "form", "prose", "table", "mixed", "outline")),
    "engine": cases("o_orderkey", text("native", "blank_skip", "ocr", "ocr", "ocr")),
    "witness": cases("(o_orderkey + o_custkey)", text("weak", "ok", "ok", "ok", "ok", "ok", "ok", "ok", "ok")),
    "quality": f"({KEY} % 100) / 100.0",
    "confidence": f"(50 + {KEY} % 50) / 100.0",
    "word_count": "o_orderkey % 13",
    "numeric_tokens": "o_custkey % 5",
    "margin": "(o_orderkey % 30) * 1.0",
    "retried": "o_orderkey % 6 = 0",
    "strong_table": f"{KEY} % 10 = 0",
    "source": cases("o_orderkey", text("context", "semantic", "semantic", "layout")),
    "route": cases("(o_orderkey + 2 * o_custkey)", text("ocr_handwriting_page", "native_text_only", "ocr_text_page", "manual_review_required", "ocr_mixed_layout_page")),
    "variant": cases("o_custkey", text("plain", "rescue_a", "plain")),
    "table_regions": "o_orderkey % 9",
    "text_regions": "o_custkey % 45",
    "skew": "((o_orderkey % 40) - 20) * 1.0",
    "alnum": f"{KEY} % 700",
    "rotation": "(o_orderkey % 4) * 90",
    "runner_up": f"({KEY} % 40) / 100.0",
    "form_hits": "o_orderkey % 3",
    "contract_hits": "o_custkey % 3",
}
_NUMBERS = {"quality", "confidence", "margin", "skew", "runner_up"}
PAGES = "SELECT o_custkey AS run, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page, o_orderkey AS page_id, " + ", ".join(f"CAST({x} AS DOUBLE) AS {n}" if n in _NUMBERS else f"{x} AS {n}" for n, x in SIGNALS.items()) + " FROM orders"


#: a document's lines as one page with signals of its image
PAGE = {"route": "CASE WHEN doc % 6 = 0 THEN 'ocr_handwriting_page' ELSE 'ocr_text_page' END", "table_regions": "doc % 25", "text_regions": "doc % 30", "skew": "CAST(doc % 40 - 20 AS DOUBLE)"}
PAGE_TEXTS = f"SELECT doc, string_agg(line, chr(10) ORDER BY line_no) AS text, {', '.join(f'{x} AS {n}' for n, x in PAGE.items())} FROM ({LINES}) GROUP BY doc"


def page_texts(t: Tables) -> DataFrame:
    of = lines(t).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    return of.select("doc", F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("text"), *[F.expr(x).alias(n) for n, x in PAGE.items()])


def orders_as(t: Tables, sql: str) -> DataFrame:
    """One of the relations above in Spark."""
    return t.spark.sql(sql.replace(" FROM orders", " FROM {orders}"), orders=t.orders)


def lines(t: Tables) -> DataFrame:
    return orders_as(t, LINES)


def turns(t: Tables) -> DataFrame:
    return orders_as(t, TURNS)


def pages(t: Tables) -> DataFrame:
    return orders_as(t, PAGES)


def fold_sql(rows: str, state: dict[str, str], layers: list[dict[str, str]], step: dict[str, str], out: str, where: str = "TRUE") -> str:
    """SQL of a fold over each document's rows (doc, i from 1, ...): the state starts as given; each row adds the layers' columns to its
    own and the state's, and step gives the next state. out: columns of the result, of row r and the state s after it."""
    inner = "SELECT s.doc, s.i + 1 AS n, r.* EXCLUDE (doc, i), " + ", ".join(f"s.{c}" for c in state) + " FROM s JOIN r ON r.doc = s.doc AND r.i = s.i + 1"
    for layer in layers:
        inner = "SELECT *, " + ", ".join(f"{x} AS {c}" for c, x in layer.items()) + f" FROM ({inner})"
    return f"""WITH RECURSIVE r AS ({rows}), s AS (SELECT DISTINCT doc, CAST(0 AS BIGINT) AS i, {', '.join(f'{x} AS {c}' for c, x in state.items())} FROM r
UNION ALL SELECT doc, n, {', '.join(f'{step[c]} AS {c}' for c in state)} FROM ({inner}))
SELECT {out} FROM s JOIN r ON r.doc = s.doc AND r.i = s.i WHERE {where}"""
