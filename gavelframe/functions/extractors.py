"""Typed extractors of pages, supporting roles, legacy scores and small shapes of tables, as expressions over lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.functions import text as X
from gavelframe.functions.records import headings

DATE = r"(?i)\b(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\s+[0-9]{1,2},\s+[0-9]{4}\b"
MONEY = r"\$\s?[0-9][0-9,]*(?:\.[0-9]{2})?"


def _lines(x: Column, p: str, most: int) -> Column:
    return F.slice(F.filter(X.nonempty_lines(x), lambda s: s.rlike(p)), 1, most)


def _all(x: Column, p: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(x, F.lit(p), F.lit(0)))


def agenda(x: Column) -> dict[str, Column]:
    return {"title_lines": headings(x, 4), "agenda_items": _lines(x, r"^(?:[IVXLC]+\.|[A-Z]\.|[a-z]\.|[0-9]+\.)", 2**30), "dates": _all(x, DATE)}


def minutes(x: Column) -> dict[str, Column]:
    shouted = F.slice(F.filter(X.nonempty_lines(x), lambda s: s.endswith(":") | ((F.upper(s) == s) & s.rlike("[A-Za-z]"))), 1, 20)
    return {"title_lines": headings(x, 4), "section_headings": shouted, "motion_lines": _lines(x, r"(?i)\bmotion\b|\bsecond(?:ed)?\b|\bvote(?:d|s)?\b", 30), "dates": _all(x, DATE)}


def legislative(x: Column) -> dict[str, Column]:
    return {"title_lines": headings(x, 5), "whereas_clauses": _lines(x, r"(?i)^whereas\b", 20), "operative_lines": _lines(x, r"(?i)be it resolved|now[, ]+therefore", 10), "dates": _all(x, DATE), "currency_values": _all(x, MONEY)}


def weak(x: Column) -> dict[str, Column]:
    """What can be said of a page that nothing else reads: bullets, its first lines, or nothing."""
    return {"bullets": _lines(x, r"^[-*•o]\s+", 40), "abstains": F.size(X.nonempty_lines(x)) == 0, "evidence": F.slice(X.nonempty_lines(x), 1, 12)}


def artifacts(pages: DataFrame, text: str) -> DataFrame:
    """The pages with artifact: struct(type, lines, n) by their extractor; one that is unknown gives its first lines."""
    x = F.col(text)
    made = {"extract_agenda": ("agenda", agenda(x)["agenda_items"]), "extract_minutes": ("minutes", minutes(x)["motion_lines"]), "extract_legislative_prose": ("legislative_prose", legislative(x)["operative_lines"])}
    kind, lines = F.lit("weak_page_evidence"), weak(x)["evidence"]
    for name, (k, found) in made.items():
        kind, lines = F.when(F.col("extractor") == name, k).otherwise(kind), F.when(F.col("extractor") == name, found).otherwise(lines)
    return pages.withColumn("artifact", F.struct(kind.alias("type"), lines.alias("lines"), F.size(lines).alias("n")))


def stage_error(raw: Column) -> Column:
    """Why a staged record is none: not_json, missing_code or no_excerpts; null if it is one."""
    o = F.from_json(raw, "code string, excerpts array<struct<text:string>>")
    ok = F.try_parse_json(raw).isNotNull()
    return F.when(~ok, "not_json").when(F.coalesce(o["code"], F.lit("")) == "", "missing_code").when(F.coalesce(F.size(o["excerpts"]), F.lit(0)) < 1, "no_excerpts")


def document_row(raw: Column, file_code: Column) -> Column:
    """struct(code, excerpts): the code at the top, else in the lineage, else the file's; how many excerpts."""
    o = F.from_json(raw, "source_code string, lineage struct<source_code:string>, excerpts array<struct<text:string>>")
    return F.struct(F.coalesce(o["source_code"], o["lineage"]["source_code"], file_code).alias("code"), F.greatest(F.size(o["excerpts"]), F.lit(0)).alias("excerpts"))


def noise_organisation(name: Column) -> Column:
    """A bare kind of organisation, or a phrase with a verb or an article."""
    return F.lower(name).isin("council", "board", "committee", "commission", "department") | F.lower(name).rlike(r"^the |\b(shall|will|is|are)\b")


def single_token(name: Column) -> Column:
    return ~F.trim(name).contains(" ")


def cells(words: DataFrame, keys: list[str], order: list[str], median: Column, page_width: float, x: str = "x", w: str = "w") -> DataFrame:
    """The words of rows with cell, counted from 1: a gap of 24, 2.5 median widths or 3.5 % of the page starts a new one."""
    by = Window.partitionBy(*keys).orderBy(*order)
    gap = F.greatest(F.lit(24.0), median * 2.5, F.lit(page_width * 0.035))
    new = F.coalesce((F.col(x) - F.lag(F.col(x) + F.col(w)).over(by) >= gap).cast("int"), F.lit(0))
    return words.withColumn("__new", new).withColumn("cell", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, 0)) + 1).drop("__new")


def nearest_column(x: Column, columns: Column) -> Column:
    """The number of the nearest column's place, from 1; the left of equally near ones."""
    far = F.transform(columns, lambda c, i: F.struct(F.abs(c - x).alias("d"), i.alias("i")))
    return (F.array_min(far)["i"] + 1).cast("int")


def is_header(row: Column, numbers: Column) -> Column:
    """The first row without numbers."""
    return (row == 1) & (numbers == 0)


def anchor_order(lines: DataFrame, header: Column, body: Column) -> DataFrame:
    """(doc, header, body, ordered): the first lines of both anchors and whether the header comes first."""
    first = lines.groupBy("doc").agg(F.min(F.when(header, F.col("line_no"))).alias("header"), F.min(F.when(body, F.col("line_no"))).alias("body"))
    return first.withColumn("ordered", F.coalesce(F.col("header") < F.col("body"), F.lit(False)))


def review_reasons(quality: Column, alnum: Column, tables: Column, structured: Column, handwriting: Column) -> Column:
    """Why a page was sent to review before there were states."""
    tests = [("low_quality", quality < 0.5), ("no_text", alnum == 0), ("tables_without_structure", (tables >= 4) & (structured == 0)), ("handwriting", handwriting)]
    return F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests]))


def stable_choice(candidates: DataFrame, page: str, least: int, readable: int, rank: Column | None = None, upright_rank: Column | None = None) -> DataFrame:
    """Of each page's candidates (id, score, rotation, lexical) the best by score; one that is turned and has fewer than `least` lexical
    words gives way to the upright one with the most, if that has at least `readable`. Ties go to the greater id, unless rank or
    upright_rank say otherwise: the greatest of these is taken in place of (score, id) or (lexical, id)."""
    whole = F.struct("id", "rotation", "lexical")
    rank = F.struct("score", "id") if rank is None else rank
    upright_rank = F.struct("lexical", "id") if upright_rank is None else upright_rank
    best = candidates.groupBy(page).agg(F.max_by(whole, rank).alias("b"), F.max_by(whole, F.when((F.col("rotation") == 0) & (F.col("lexical") >= readable), upright_rank)).alias("u"))
    turn = (F.col("b.rotation") != 0) & (F.col("b.lexical") < least) & F.col("u").isNotNull()
    return best.select(page, F.when(turn, F.col("u.id")).otherwise(F.col("b.id")).alias("id"))


def evidence_floor(anchor: Column, page_type: Column, rules: dict[str, Column], other: Column) -> Column:
    """Whether a page has what the anchor's type asks for; blanks never do."""
    out = F.when(page_type == "blank_separator", False)
    for name, test in rules.items():
        out = out.when(anchor == name, test)
    return out.otherwise(other)


def support_role(low: Column, signatures: Column, blank: Column, civic: Column, subtype: Column, continues: Column, trusted: Column) -> Column:
    """cover, appendix, exhibit, signature, attachment, continuation or standalone, the first that fits."""
    from gavelframe.functions.pages import STAFF_SUMMARY

    is_ = lambda *names: F.coalesce(subtype.isin(*names), F.lit(False))
    return (
        F.when(blank, "standalone")
        .when(low.rlike(STAFF_SUMMARY), "cover")
        .when(low.rlike(r"\bappendix\b|\bappendices\b"), "appendix")
        .when(low.rlike(r"\bexhibit\b|\battachment\s+[a-z0-9]+\b|\bschedule\s+[a-z0-9]+\b") | is_("certificate_support", "endorsement_support"), "exhibit")
        .when((signatures >= 2) | (civic & (signatures >= 1) & low.rlike(r"\bclerk\b|\bmayor\b|\battest\b")), "signature")
        .when(low.rlike(r"\battachments?\b|\battached\b|\benclosures?\b|\bsupporting documents?\b") | is_("explanation_sheet", "request_correspondence"), "attachment")
        .when(continues & trusted, "continuation")
        .otherwise("standalone")
    )


# Signs of meeting pages and of budget pages in their first 100,000 characters.
AGENDA_START = (r"\bagenda\b", "call to order", "regular meeting", "special meeting", "called meeting", "public hearing", "town council meeting", "council meeting")
AGENDA_ANCHOR = (r"\bagenda\b", "call to order", "regular meeting", "special meeting", "called meeting", "approval of minutes", "public comments", "adjourn", r"\bresolution\b", r"\bordinance\b", "council report", "robert's rules", "parliamentary", "procedure")
AGENDA_MORE = ("agenda item", "minutes", "approval language", "motion", "seconded", "unanimous", "voted", "ayes?", "nays?", "old business", "new business", "council member", "member names", "mayor", "town manager", "staff summary", "action item", "agenda title", "staff contact", "reviewed by", "budget amendments?", "council report", "manager report", "attorney report", "town clerk", r"\bresolution\b", r"\bordinance\b", "whereas", "be it resolved", "now[, ]+therefore", "attest", "votes?:", "total calls?( for service)?")
BUDGET_ANCHOR = ("annual budget", "proposed budget", "adopted budget", "budget worksheet", "revenues? and expenditures?", "fund balance")
BUDGET_MORE = ("general fund", "account", "appropriation", "department", "line item", "total", "transfer")
MEETING_CONTEXT = ("council meeting", "motion", "minutes", "call to order", "staff summary")


def _clamped(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def agenda_scores(x: Column) -> dict[str, Column]:
    """start, anchor and more: 0.35, 0.45 and 0.20 a sign; budget words cost 0.1 of the last two; each 0 to 1."""
    low = F.lower(F.substring(x, 1, 100_000))
    n = lambda ps: X.keyword_hits(low, list(ps))
    penalty = F.when(low.contains("budget") | low.contains("appropriation"), 0.1).otherwise(F.lit(0.0))
    return {"start": _clamped(n(AGENDA_START) * 0.35), "anchor": _clamped(n(AGENDA_ANCHOR) * 0.45 - penalty), "more": _clamped(n(AGENDA_MORE) * 0.20 - penalty)}


def budget_scores(x: Column) -> dict[str, Column]:
    """anchor and more: 0.40 and 0.15 a sign, 0.3 for more than ten dollar signs, less what a meeting's words cost: 0.20 a sign, at most 0.85."""
    low = F.lower(F.substring(x, 1, 100_000))
    n = lambda ps: X.keyword_hits(low, list(ps))
    meeting = n(MEETING_CONTEXT) * 0.20
    dollars = F.when(F.regexp_count(x, F.lit(r"\$")) > 10, 0.3).otherwise(F.lit(0.0))
    return {"anchor": F.greatest(F.lit(0.0), n(BUDGET_ANCHOR) * 0.40 - F.least(F.lit(0.85), meeting)), "more": F.greatest(F.lit(0.0), n(BUDGET_MORE) * 0.15 + dollars - F.least(F.lit(0.45), meeting * 0.5))}
