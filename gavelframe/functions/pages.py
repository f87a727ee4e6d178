"""Page classification: line counters, structural signals, the scorer over twelve types, layouts, families, lanes and review states.

All are expressions over a page's text and its signals. Thresholds are fixed values unless they are parameters; rules are tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.functions import text as X

ACCOUNT, MONEY = r"\b[0-9]{2,3}-[0-9]{4}-[0-9]{5,6}\b", r"\$ ?[0-9][0-9,]*(?:\.[0-9]{2})?"
#: counters of lines: name -> (pattern in any case, greatest length or none, pattern that must not match or none)
LINE_COUNTERS: dict[str, tuple[str, int | None, str | None]] = {
    "agenda_list_lines": (r"^(?-i:[IVXLC]+[.)]|[A-Z][.)]|[a-z][.)]|[0-9]+[.)])\s*", None, None),
    "bullet_lines": (r"^[-*•o]\s+", None, None),
    "heading_lines": (r"[a-z]", 70, r"[.!?]|" + ACCOUNT),
    "motion_lines": (r"\bmotion\b|\bsecond(?:ed)?\b|\bmove(?:d)?\b|\bcouncil voted\b", None, None),
    "vote_lines": (r"\bvotes?:\b|\broll call\b|\bunanimous\b|\bmembers present\b", None, None),
    "section_lines": (r"^(?:article|section)\s+[ivx0-9]+|^[0-9]+(?:\.[0-9]+){1,3}$", None, None),
    "finance_lines": (r"\bbudget\b|\brevenues?\b|\bexpenditures?\b|\bfund balance\b|\bdepartment\b|\bactual\b|\bmonthly financial\b|\bstaff summary\b|\bpaid checks\b", None, None),
    "contract_lines": (r"\bagreement\b|\bcontract\b|\btask order\b|\blessee\b|\blessor\b|\bcontract number\b|\bpurchase agreement\b|\bcertificate of coverage\b|\bendorsement\b", None, None),
    "field_label_lines": (r":", 90, None),
    "compact_field_label_lines": (r"^[^:]{1,32}:", 72, None),
    "signature_form_lines": (r"\bsignature\b|\btitle\b|\bphone\b|\baddress\b|\bcustomer name\b|\baccount number\b|\brouting number\b", None, None),
}
#: a line of a table of numbers: an account, an amount, eight digits in at most 90 characters, or two in a short line with a sign
NUMERIC_LINE = (ACCOUNT, MONEY, r"^(?=.{0,90}$)(?:[^0-9]*[0-9]){8}", r"^(?=.{0,24}$)(?=.*[$()'.,])(?:[^0-9]*[0-9]){2}")


def line_metrics(x: Column) -> dict[str, Column]:
    """Counts of a page's non-empty lines by kind, share of short lines, accounts and amounts."""
    lines = X.nonempty_lines(x)
    size = lambda test: F.size(F.filter(lines, test))

    def kind(p: str, most: int | None, no: str | None) -> Column:
        def test(s: Column) -> Column:
            ok = s.rlike(f"(?i){p}")
            ok = ok & (F.length(s) <= most) if most else ok
            return ok & ~s.rlike(no) if no else ok

        return size(test)

    n = F.size(lines)
    out = {name: kind(*rule) for name, rule in LINE_COUNTERS.items()}
    out["inline_clause_heading_lines"] = size(lambda s: s.rlike("^[^:]{1,40}:") & (F.length(s) > 72))
    out["paragraph_lines"] = size(lambda s: F.length(s) >= 90)
    out["numeric_table_lines"] = size(lambda s: s.rlike("|".join(NUMERIC_LINE)))
    out["account_code_count"], out["currency_count"], out["line_count"] = F.regexp_count(x, F.lit(ACCOUNT)), F.regexp_count(x, F.lit(MONEY)), n
    out["short_ratio"] = F.when(n > 0, F.round(size(lambda s: F.length(s) <= 96) / n, 2)).otherwise(F.lit(0.0))
    return out


def hits(low: Column, patterns: tuple[str, ...]) -> Column:
    """How many of the patterns occur in the lower-cased text."""
    return X.keyword_hits(low, list(patterns))


# The patterns of each family of pages, and of forms, covers and subtypes of supporting pages.
FAMILIES: dict[str, tuple[str, ...]] = {
    "agenda": (r"\bagenda\b", r"call meeting to order", r"scheduled public comments", r"unscheduled public comments", r"town council meeting", r"adjourn meeting", r"next regular meeting"),
    "minutes": (r"\bminutes\b", r"regular monthly meeting", r"upon a motion by", r"seconded by", r"roll call vote", r"council voted", r"members present"),
    "reference_or_procedure": (r"robert'?s rules", r"parliamentary procedure", r"question of privilege", r"point of order", r"previous question", r"parliamentary procedure at a glance", r"introduce a motion", r"amendments? illustrated", r"amendments?\s*[\[\(]?\s*illustrated", r"\bmain motion\b", r"\bprimary amendment\b", r"\bsecondary amendment\b", r"the chair repeats the motion"),
    "legislative_prose": (r"\bresolution\b", r"\bordinance\b", r"\bwhereas\b", r"be it resolved", r"now[, ]+therefore", r"town charter"),
    "invoice": (r"\binvoice\b", r"amount due", r"bill to", r"invoice number", r"remit"),
    "contract_or_agreement": (r"\bagreement\b", r"\bcontract\b", r"\btask order\b", r"\bcontract number\b", r"general terms and conditions", r"insurance requirements", r"\bindemnification\b", r"\bconfidentiality\b", r"\bnon-discrimination\b", r"purchase agreement", r"payment schedule", r"certificate of coverage", r"additional terms and conditions", r"duties and obligations", r"commercial general liability", r"workers'? compensation insurance", r"warrants and represents", r"lessor", r"lessee", r"opinion of counsel", r"endorsement changes the coverage document", r"general liability"),
    "financial_report": (r"monthly financial report", r"financial policies", r"financial investment policies", r"draft financial and investment policies", r"\bbudget\b", r"budget amendment", r"budget ordinance amendments?", r"\bappropriation\b", r"statement of revenues", r"statement of expenditures", r"balance sheet", r"\bgeneral fund\b", r"\bfund balance\b", r"\bgrants?\b", r"lease-purchase financing", r"capital assets?", r"depreciation", r"revenue bonds?", r"inter-?departmental transfers?", r"\bpaid checks report\b", r"\bstaff summary\b", r"\btotal revenues\b", r"\btotal expenditures\b"),
}
FORM_HEADER = (r"commonwealth of virginia", r"internal revenue service", r"department of the treasury", r"sales and use tax certificate of exemption", r"application for", r"selection form", r"customer information verification", r"customer signature", r"auto pay information", r"meeting minutes request", r"request for minutes", r"documentation department", r"document checklist", r"(?m)^\s*(?:irs\s+)?form\s+[a-z0-9-]+")
FORM_SUPPORT = (r"meeting minutes request", r"request for minutes", r"documentation department", r"document checklist", r"customer information verification", r"customer signature", r"selection form", r"auto pay information", r"additional insured", r"coverage form", r"covered person", r"named member\s*or\s*entity")
FORM_BODY = (r"check box", r"employer identification number", r"routing number", r"account number", r"tax exempt", r"customer name", r"physical address", r"mailing address", r"equipment location", r"business phone")
PROCEDURE = r"robert'?s rules|parliamentary procedure|amendments?\s*[\[\(]?\s*illustrated|\bmain motion\b|\bprimary amendment\b|\bsecondary amendment\b|\bpoint of order\b|\bquestion of privilege\b|\bprevious question\b"
STAFF_SUMMARY = r"\bstaff summary\b|\baction item\b|\bagenda title\b|\bstaff contact(?:\(s\))?\b|\breviewed by\b|\bfunding source\b"
COVER_FIELDS = (r"\bagenda title\b", r"\bstaff contact(?:\(s\))?\b", r"\battachments?\b", r"\breviewed by\b", r"\bagenda date\b")
COVER_SECTIONS = (r"\bsummary\b", r"\brecommendation\b", r"\bfunding source\b", r"\bfinancial impact\b")
COVER_MEETINGS = (r"\bcouncil meeting\b", r"\bboard meeting\b", r"\bcommittee meeting\b", r"\baction item\b", r"\bstaff summary\b")
REPORT_SUMMARY = r"monthly traffic summary|council report|calls for service|reckless driving|operators license"
SUBTYPES: dict[str, tuple[tuple[str, ...], tuple[tuple[str, float, bool], ...]]] = {  # patterns; bonuses (pattern, score, in the header)
    "certificate_support": ((r"certificate of coverage", r"certificate holder", r"issued as a matter of information only", r"confers no rights upon the certificate holder", r"companies affording coverage", r"membership agreement afforded by the policies below"), (("certificate of coverage", 0.08, False),)),
    "endorsement_support": ((r"this endorsement changes the coverage document", r"amendatory endorsement", r"additional insured", r"this endorsement modifies coverage", r"loss payable provisions", r"covered person", r"named member\s*or\s*entity"), (("amendatory endorsement|this endorsement changes the coverage document", 0.08, False),)),
    "explanation_sheet": ((r"explanation of content", r"included in this document package", r"brief explanation of the purpose of each form", r"if you wish to discuss any of the forms"), (("explanation of content", 0.12, True), ("document package", 0.06, False))),
    "request_correspondence": ((r"we are requesting a copy", r"requesting a copy of the minutes", r"request for minutes", r"meeting minutes request", r"thank you for your assistance", r"documentation department", r"complete the documentation package"), (("we are requesting a copy", 0.08, False), ("thank you for your assistance", 0.06, False))),
}
PRIORITY = ("blank_separator", "agenda", "minutes", "reference_or_procedure", "legislative_prose", "government_form", "invoice", "contract_or_agreement", "financial_report", "powerpoint", "table_or_mixed_layout", "generic_prose")
FAMILY_OF = {"agenda": "agenda", "minutes": "minutes", "reference_or_procedure": "procedure", "legislative_prose": "legislative", "government_form": "form", "invoice": "invoice", "contract_or_agreement": "contract", "financial_report": "financial", "blank_separator": "blank", "generic_prose": "generic", "powerpoint": "presentation", "table_or_mixed_layout": "structural"}
FUNCTION_OF = {"agenda": "agenda", "minutes": "minutes", "procedure": "reference", "legislative": "legislative", "contract": "contract", "financial": "finance", "form": "admin", "invoice": "admin", "blank": "separator", "generic": "unknown", "presentation": "unknown", "structural": "unknown"}
NO_FAMILY, NO_FUNCTION = ("blank", "generic", "presentation", "structural"), ("separator", "unknown")


def mapped(x: Column, table: dict[str, str], other: str | None = None) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), x), F.lit(other))


def form_structure(m: dict[str, Column]) -> Column:
    """Four short field labels, or three with two lines for signatures."""
    return (m["compact_field_label_lines"] >= 4) | ((m["compact_field_label_lines"] >= 3) & (m["signature_form_lines"] >= 2))


def packet_cover(low: Column, m: dict[str, Column]) -> Column:
    """The cover of an item in a meeting's packet: field labels, a section, and two fields or a meeting."""
    return (m["compact_field_label_lines"] >= 4) & (hits(low, COVER_SECTIONS) >= 1) & ((hits(low, COVER_FIELDS) >= 2) | (hits(low, COVER_MEETINGS) >= 1))


def strong_table(m: dict[str, Column]) -> Column:
    return (m["account_code_count"] >= 4) | (m["numeric_table_lines"] >= 6) | ((m["currency_count"] >= 4) & (m["short_ratio"] >= 0.55))


def table_supported(m: dict[str, Column], regions: Column) -> Column:
    return (regions >= 2) & (m["numeric_table_lines"] >= 2) & (m["paragraph_lines"] <= 2)


def slide(m: dict[str, Column]) -> Column:
    few = (m["line_count"] > 0) & (m["line_count"] <= 18) & (m["paragraph_lines"] <= 1) & (m["account_code_count"] == 0) & (m["currency_count"] <= 2)
    return few & (m["bullet_lines"] >= 4) & (m["short_ratio"] >= 0.85) & (m["numeric_table_lines"] <= 2) & (m["motion_lines"] == 0)


def false_blank(alnum: Column, tables: Column, texts: Column, route: Column) -> Column:
    """A page without recognised text that has very many regions, as handwriting has."""
    return (route == "ocr_handwriting_page") & (alnum == 0) & (tables + texts >= 40) & (texts >= 20)


def _capped(most: float, x: Column) -> Column:
    return F.least(F.lit(most), x)


def _bonus(*parts: tuple[Column, float]) -> Column:
    return sum((F.when(test, F.lit(b)).otherwise(F.lit(0.0)) for test, b in parts), F.lit(0.0))


def with_candidates(pages: DataFrame, text: str = "text") -> DataFrame:
    """The pages (text, route, table_regions, text_regions, skew) with counts, h_<type> (patterns hit), s_<type> (score or null) and best.

    A type's score is 0.30 + 0.12 a pattern + what its lines add, at most 0.99, rounded to two places, if its conditions hold.
    """
    m = line_metrics(F.col(text))
    low = F.lower(X.normalize_ws(F.col(text)))
    header = F.lower(F.array_join(F.slice(X.nonempty_lines(F.col(text)), 1, 8), "\n"))
    first = pages.select("*", *[c.alias(n) for n, c in m.items()], low.alias("low"), header.alias("header"), X.alnum_count(F.col(text)).alias("alnum"))
    m = {n: F.col(n) for n in m}
    low = F.col("low")
    head, support, body = (hits(F.col(c), p) for c, p in (("header", FORM_HEADER), ("low", FORM_SUPPORT), ("low", FORM_BODY)))
    counted = first.select("*", *[hits(low, p).alias(f"h_{n}") for n, p in FAMILIES.items()], head.alias("form_head"), support.alias("form_support"), body.alias("form_body"), low.rlike(PROCEDURE).alias("procedure"), packet_cover(low, m).alias("cover"), low.rlike(STAFF_SUMMARY).alias("staff"), low.rlike(REPORT_SUMMARY).alias("report"),
        low.rlike("call meeting to order|scheduled public comments|adjourn meeting|next regular meeting").alias("strong_agenda"), low.rlike(r"\bresolution\b|\bwhereas\b|be it resolved|now[, ]+therefore").alias("anchor"), (low.contains("adjourn meeting") & low.contains("next regular meeting")).alias("closing"))
    structure = form_structure(m)
    anchored = (F.col("form_head") > 0) | (F.col("form_support") > 0)
    counted = counted.withColumn("h_government_form", F.col("form_head") + F.col("form_support") + F.when(anchored | structure, F.col("form_body")).otherwise(0))
    h = {n: F.col(f"h_{n}") for n in (*FAMILIES, "government_form")}
    weak_head = (F.col("form_head") > 0) & (F.col("form_support") == 0) & (F.col("form_body") == 0)
    cover, staff, finance = F.col("cover"), F.col("staff"), (m["finance_lines"] > 0) | (h["financial_report"] > 0)
    bonus = {
        "agenda": _bonus((staff, -0.14), (m["agenda_list_lines"] >= 4, 0.18), (F.col("closing"), 0.08)) + _capped(0.16, m["agenda_list_lines"] * 0.03),
        "minutes": _capped(0.28, m["motion_lines"] * 0.08 + m["vote_lines"] * 0.06),
        "reference_or_procedure": _capped(0.20, m["section_lines"] * 0.04 + m["paragraph_lines"] * 0.02) + _bonus((F.col("procedure"), 0.12)),
        "legislative_prose": _capped(0.20, m["vote_lines"] * 0.04),
        "government_form": _capped(0.18, m["heading_lines"] * 0.02) + _capped(0.22, m["compact_field_label_lines"] * 0.03 + m["signature_form_lines"] * 0.05),
        "invoice": F.lit(0.0),
        "contract_or_agreement": _capped(0.24, m["section_lines"] * 0.04 + m["contract_lines"] * 0.03) + _capped(0.18, m["inline_clause_heading_lines"] * 0.05) + _bonus(((m["section_lines"] >= 4) & (m["contract_lines"] >= 1) & (m["finance_lines"] == 0), 0.12), ((m["compact_field_label_lines"] == 0) & (m["inline_clause_heading_lines"] >= 2), 0.08)),
        "financial_report": _capped(0.20, m["finance_lines"] * 0.03 + m["currency_count"] * 0.01) + _bonus((cover & finance, 0.12), (~cover & staff & finance, 0.18), ((h["financial_report"] >= 2) & (m["numeric_table_lines"] <= 1) & (m["currency_count"] == 0) & (m["account_code_count"] == 0), 0.08),
            ((m["finance_lines"] >= 3) & (m["numeric_table_lines"] <= 3) & (m["currency_count"] <= 2) & (m["account_code_count"] == 0), 0.10), ((m["paragraph_lines"] == 0) & (m["short_ratio"] >= 0.95) & (m["line_count"] <= 18) & (m["currency_count"] >= 6), -0.14)),
    }
    allowed = {
        "agenda": ~((m["agenda_list_lines"] == 0) & ~F.col("strong_agenda") & (h["agenda"] <= 2)) & ~cover & (h["agenda"] > 0),
        "minutes": ~(F.col("procedure") & (h["minutes"] == 0)) & ((h["minutes"] > 0) | (m["motion_lines"] + m["vote_lines"] > 0)),
        "reference_or_procedure": h["reference_or_procedure"] > 0,
        "legislative_prose": (h["legislative_prose"] > 0) & F.col("anchor"),
        "government_form": ~cover & ~staff & (h["government_form"] > 0) & ~(weak_head & ~structure) & ~(weak_head & (m["contract_lines"] > 0) & (m["compact_field_label_lines"] < 2)),
        "invoice": h["invoice"] > 0,
        "contract_or_agreement": h["contract_or_agreement"] > 0,
        "financial_report": finance | (m["currency_count"] > 0),
    }
    score = {n: F.when(allowed[n] & ((h[n] > 0) | (bonus[n] >= 0.16)), F.round(_capped(0.99, 0.30 + h[n] * 0.12 + bonus[n]), 2)) for n in bonus}
    table = 0.50 + _capped(0.18, m["numeric_table_lines"] * 0.02) + _capped(0.16, m["account_code_count"] * 0.03) + _capped(0.12, m["currency_count"] * 0.01)
    supported = table_supported(m, F.col("table_regions"))
    table = table + _bonus((supported, 0.06), (m["numeric_table_lines"] >= 20, 0.06), (m["account_code_count"] >= 8, 0.06), (m["currency_count"] >= 20, 0.06), (m["paragraph_lines"] > 2, -0.12))
    sparse = (m["short_ratio"] >= 0.95) & (m["paragraph_lines"] == 0)
    layouts = [F.when(strong_table(m) | supported, F.round(_capped(0.99, table), 2)), F.when((F.col("table_regions") >= 20) & (m["line_count"] <= 18) & sparse, 0.72), F.when((F.abs("skew") >= 12) & (F.col("table_regions") >= 4) & sparse, 0.70), F.when(F.col("report"), 0.60)]
    score["table_or_mixed_layout"] = F.greatest(*layouts)
    score["powerpoint"] = F.when(slide(m), F.round(0.62 + _capped(0.12, m["bullet_lines"] * 0.03), 2))
    scored = counted.select("*", *[c.alias(f"s_{n}") for n, c in score.items()], anchored.alias("form_anchor"))
    form, contract = F.col("s_government_form"), F.col("s_contract_or_agreement")
    over_form = (contract >= form - 0.02) & (m["contract_lines"] >= 8) & (m["field_label_lines"] < 4) & ~F.col("form_anchor")
    over_contract = F.col("form_anchor") & (F.col("h_government_form") >= 2) & (m["contract_lines"] < 8) & contract.isNotNull()
    tied = scored.withColumn("s_contract_or_agreement", F.when(over_form, F.round(_capped(0.99, F.greatest(contract, form + 0.01)), 2)).otherwise(contract))
    tied = tied.withColumn("s_government_form", F.when(over_contract & form.isNotNull(), F.round(_capped(0.99, F.greatest(form, contract + 0.01)), 2)).otherwise(form))
    blank = ((F.col("low") == "") | (F.col("alnum") == 0) | ((F.col("alnum") <= 24) & (F.col("text_regions") <= 12))) & ~false_blank(F.col("alnum"), F.col("table_regions"), F.col("text_regions"), F.col("route"))
    return tied.withColumn("best", best_type({n: F.when(~blank, F.col(f"s_{n}")) for n in score} | {"blank_separator": F.when(blank, F.lit(1.0))}, F.when(m["paragraph_lines"] > 0, 0.42).otherwise(F.lit(0.28))))


def best_type(scores: dict[str, Column], generic: Column) -> Column:
    """struct(page_type, confidence, source): the highest score, ties by PRIORITY; generic prose where there is none."""
    kind = {"table_or_mixed_layout": "layout", "powerpoint": "layout"}
    ranked = F.array_compact(F.array(*[F.when(s.isNotNull(), F.struct((-s).alias("s"), F.lit(PRIORITY.index(n)).alias("p"), F.lit(n).alias("n"), F.lit(kind.get(n, "semantic")).alias("k"))) for n, s in scores.items()]))
    top = F.array_min(ranked)
    return F.struct(F.coalesce(top["n"], F.lit("generic_prose")).alias("page_type"), F.coalesce(-top["s"], generic).alias("confidence"), F.coalesce(top["k"], F.lit("fallback")).alias("source"))


def support_subtype(x: Column) -> Column:
    """struct(subtype, score) of a contract's or form's page: 0.58 + 0.12 a pattern in the first eight lines + 0.06 one anywhere + bonuses;
    at least one in the header or two in the text. Ties go in the table's order; null if none."""
    low, header = F.lower(x), F.lower(F.array_join(F.slice(X.nonempty_lines(x), 1, 8), "\n"))
    found = []
    for i, (name, (patterns, bonuses)) in enumerate(SUBTYPES.items()):
        head, body = hits(header, patterns), hits(low, patterns)
        score = 0.58 + head * 0.12 + body * 0.06 + _bonus(*[((header if top else low).rlike(p), b) for p, b, top in bonuses])
        found.append(F.when((head > 0) | (body >= 2), F.struct((-F.round(_capped(0.99, score), 2)).alias("s"), F.lit(i).alias("p"), F.lit(name).alias("n"))))
    top = F.array_min(F.array_compact(F.array(*found)))
    return F.when(top.isNotNull(), F.struct(top["n"].alias("subtype"), (-top["s"]).alias("score")))


def trusted(c: dict[str, Column]) -> Column:
    """Whether a page's recognised text may serve as evidence: native text, or enough words of enough quality, and a clear choice if
    there were several attempts. c: engine, page_type, layout_type, witness, quality, word_count, numeric_tokens, margin, retried, strong_table."""
    few = c["word_count"] < 4
    tabular = c["layout_type"].isin("table", "mixed", "form")
    poor = (c["quality"] < 0.28) | F.when(tabular, few & (c["numeric_tokens"] < 2) & ~c["strong_table"]).otherwise(few) | (c["retried"] & (c["margin"] < 12))
    return F.when(c["engine"] == "native", True).when(c["engine"] == "blank_skip", c["page_type"] == "blank_separator").otherwise((c["witness"] != "weak") & ~poor)


def sort_lane(c: dict[str, Column]) -> Column:
    table = (c["page_type"] == "table_or_mixed_layout") | c["layout_type"].isin("table", "mixed") | c["strong_table"]
    return F.when(c["page_type"] == "blank_separator", "default").when(~trusted(c), "weak_fallback").when(table, "table_specialist").otherwise("default")


def review_state(c: dict[str, Column], suspicion: Column, lane: Column) -> Column:
    weak = (c["witness"] == "weak") | (lane == "weak_fallback")
    return (
        F.when((c["page_type"] == "blank_separator") & c["engine"].isin("native", "blank_skip") & (suspicion < 0.18), "auto_pass")
        .when((suspicion >= 0.62) & weak, "quarantined")
        .when((c["route"] == "ocr_handwriting_page") & (suspicion < 0.35) & (c["witness"] != "weak"), "provisional_auto_pass")
        .when(weak | (suspicion >= 0.35) | (c["route"] == "manual_review_required"), "review_required")
        .when((lane == "table_specialist") | (suspicion >= 0.18) | (c["source"] == "context") | c["layout_type"].isin("table", "mixed", "form"), "provisional")
        .otherwise("auto_pass")
    )


def review_priority(state: Column) -> Column:
    """0 for what is looked at first; 9 for what is no state."""
    return F.when(state == "quarantined", 0).when(state == "review_required", 1).when(state == "provisional", 2).when(state == "auto_pass", 3).otherwise(9)


def dispatched(state: Column, c: dict[str, Column], states: tuple[str, ...] = ("review_required", "quarantined")) -> Column:
    """Whether a page goes to review: its state, and a lane, layout, route, four tables or a turned page that call for it."""
    reason = (c["lane"].isin("weak_fallback", "table_specialist")) | c["layout_type"].isin("table", "mixed", "form") | (c["route"] == "ocr_handwriting_page") | (c["table_regions"] >= 4) | c["rotation"].isin(90, 270)
    return state.isin(*states) & reason


def layout(c: dict[str, Column]) -> Column:
    """Layout of a typed page. c: page_type, support_hits, contract_lines, finance_lines, vote_lines, account_code_count,
    currency_count, numeric_table_lines, table_regions, strong_table."""
    t = c["page_type"]
    numbers = (c["numeric_table_lines"] > 0) | (c["currency_count"] > 0) | (c["account_code_count"] > 0)
    return (
        F.when(t == "blank_separator", "blank")
        .when(t == "powerpoint", "slide")
        .when(t.isin("government_form", "invoice"), "form")
        .when((c["support_hits"] > 0) & (c["contract_lines"] < 8) & (c["finance_lines"] == 0) & (c["vote_lines"] == 0), "form")
        .when((t == "contract_or_agreement") & (c["account_code_count"] == 0) & (c["currency_count"] <= 1), "prose")
        .when(c["strong_table"], "table")
        .when((t == "table_or_mixed_layout") & (c["table_regions"] >= 20) & numbers, "table")
        .when(t == "table_or_mixed_layout", "mixed")
        .when(t == "agenda", "outline")
        .otherwise("prose")
    )


def family(page_type: Column, candidate: Column, anchor: Column, evidence: dict[str, Column]) -> Column:
    """A page's family: of its type, else of its best semantic candidate, else of the page that it was carried from, else of the first
    evidence; structural or generic if there is nothing. evidence: family -> condition, in order."""
    direct = mapped(page_type, FAMILY_OF, "structural")
    out = F.when(~direct.isin("structural", "generic"), direct).when(candidate.isNotNull(), mapped(candidate, FAMILY_OF, "structural")).when(anchor.isNotNull(), mapped(anchor, FAMILY_OF, "structural"))
    for name, test in evidence.items():
        out = out.when(test, name)
    return out.otherwise(direct)


def suspicion(c: dict[str, Column]) -> Column:
    """Doubt about a page's label, 0 to 0.99. c has the signals of trusted(), source, confidence, route, variant, table_regions,
    text_regions, runner_up (score behind the best of another type, or null), form_hits, contract_hits, the two axes family and
    function with those of the nearest substantive pages (prev_/next_), and prev_type, next_type."""
    conflict = lambda axis, empty: (c[f"prev_{axis}"] == c[f"next_{axis}"]) & ~c[axis].isin(*empty) & (c[axis] != c[f"prev_{axis}"])
    doubts = [
        (F.round(c["confidence"] - c["runner_up"], 2) <= 0.08, 0.22),
        (c["source"] == "context", 0.18),
        (c["confidence"] < 0.70, 0.18),
        (c["confidence"] < 0.55, 0.12),
        (~trusted(c), 0.26),
        ((c["page_type"] == "blank_separator") & (c["table_regions"] + c["text_regions"] >= 20), 0.45),
        ((c["form_hits"] > 0) & (c["contract_hits"] > 0), 0.18),
        (conflict("family", NO_FAMILY), 0.22),
        (conflict("function", NO_FUNCTION), 0.18),
        ((c["prev_type"] == c["next_type"]) & (c["page_type"] != c["prev_type"]) & (c["source"] != "semantic"), 0.10),
        ((c["route"] == "ocr_handwriting_page") & c["variant"].contains("rescue") & (c["page_type"] != "blank_separator"), 0.08),
    ]
    return F.round(F.least(F.lit(0.99), _bonus(*[(F.coalesce(t, F.lit(False)), b) for t, b in doubts])), 2)


def nearest(value: Column, ok: Column, run: str, page: str, distance: int, back: bool) -> Column:
    """The value of the nearest page on one side, at most `distance` pages off, that is ok; null if there is none."""
    w = Window.partitionBy(run).orderBy(page)
    kept = F.when(ok, value)
    return F.last(kept, ignorenulls=True).over(w.rowsBetween(-distance, -1)) if back else F.first(kept, ignorenulls=True).over(w.rowsBetween(1, distance))


def extractor(page_type: Column, function: Column, layout_type: Column, lane: Column) -> Column:
    """Which extractor takes a page: by separator, lane, type, function and layout, in this order."""
    structured = F.when(layout_type == "form", "extract_structured_form").when(layout_type == "mixed", "extract_structured_mixed").when(layout_type == "table", "extract_structured_table").when(function.isin("finance", "admin"), "extract_structured_mixed").otherwise("extract_structured_table")
    tabular = layout_type.isin("table", "mixed")
    by_type = {"agenda": "extract_agenda", "minutes": "extract_minutes", "reference_or_procedure": "extract_reference_or_procedure", "legislative_prose": "extract_legislative_prose", "contract_or_agreement": "extract_contract_or_agreement", "financial_report": "extract_financial_report", "government_form": "extract_government_form", "invoice": "extract_invoice", "blank_separator": "extract_blank_separator", "powerpoint": "extract_powerpoint", "table_or_mixed_layout": "extract_table_or_mixed_layout"}
    return (
        F.when((function == "separator") | (layout_type == "blank"), "extract_blank_separator")
        .when(lane == "weak_fallback", "extract_weak_page_evidence")
        .when(lane == "table_specialist", structured)
        .when(page_type == "invoice", "extract_invoice")
        .when(function == "agenda", "extract_agenda")
        .when(function == "minutes", "extract_minutes")
        .when((function == "reference") & (layout_type == "slide"), "extract_powerpoint")
        .when(function == "reference", "extract_reference_or_procedure")
        .when(function == "legislative", "extract_legislative_prose")
        .when(function == "contract", "extract_contract_or_agreement")
        .when((function == "finance") & tabular, structured)
        .when(function == "finance", "extract_financial_report")
        .when((function == "admin") & (layout_type == "form"), "extract_structured_form")
        .when((function == "admin") & tabular, structured)
        .when(function == "admin", "extract_government_form")
        .when(layout_type == "slide", "extract_powerpoint")
        .when(layout_type == "form", "extract_structured_form")
        .when(tabular, structured)
        .otherwise(mapped(page_type, by_type, "extract_generic_prose"))
    )


def retry_rotation(c: dict[str, Column]) -> Column:
    """Whether a page is worth recognising again when turned. c: alnum, quality, word_count, table_regions, text_regions, skew."""
    skewed = F.abs(c["skew"]) >= 8
    clean = ~skewed & (c["quality"] >= 0.82) & (c["alnum"] <= 320)
    weak = (c["alnum"] <= 24) | (c["quality"] < 0.24) | (c["word_count"] <= 4)
    regions = (c["table_regions"] >= 3) | (c["table_regions"] + c["text_regions"] >= 12) | skewed
    return F.when(clean, False).when(skewed & (c["alnum"] <= 320), True).otherwise(weak & regions)
