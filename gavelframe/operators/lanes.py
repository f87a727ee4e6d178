"""Span extraction over the lines of documents (doc, line_no from 1, line): rules, context, blocks and headings.

Windows are per document; a document has some thousand lines, never a source or a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def context(lines: DataFrame, ahead: int, back: int) -> DataFrame:
    """The rows with near: the lines from `back` before to `ahead` behind, in order."""
    w = Window.partitionBy("doc").orderBy("line_no").rowsBetween(-back, ahead)
    return lines.withColumn("near", F.collect_list(F.coalesce("line", F.lit(""))).over(w))


def rule_hits(lines: DataFrame, rules: tuple[tuple[str, str, float], ...]) -> DataFrame:
    """The rows with labels: array<struct<label, score>> of the rules (label, pattern, score) that match."""
    found = F.array(*[F.when(F.col("line").rlike(p), F.struct(F.lit(n).alias("label"), F.lit(float(s)).alias("score"))) for n, p, s in rules])
    return lines.withColumn("labels", F.array_compact(found))


def blocks(lines: DataFrame, anchor: Column, boundary: Column, most: int = 80) -> DataFrame:
    """(doc, start, end, text): from each anchor line to the line before the next boundary, at most `most` lines further, ended by two
    blank lines in a row; blank lines at the end go. One shuffle by document, and no line is joined with another."""
    w = Window.partitionBy("doc").orderBy("line_no")
    ahead = w.rowsBetween(1, most)
    blank = F.trim("line") == ""
    marked = lines.withColumn("_anchor", anchor).withColumn("_edge", F.when(boundary, F.col("line_no"))).withColumn("_blank", blank)
    marked = marked.withColumn("_pair", F.when(F.col("_blank") & F.lag("_blank").over(w), F.col("line_no")))
    # two blank lines end a block only beyond its third line
    stop = marked.withColumn("_stop", F.least(F.min("_edge").over(ahead) - 1, F.min("_pair").over(w.rowsBetween(3, most)), F.max("line_no").over(w.rowsBetween(0, most))))
    all_ = stop.withColumn("_lines", F.when(F.col("_anchor"), F.collect_list("line").over(w.rowsBetween(0, most)))).where("_anchor")
    body = F.slice("_lines", F.lit(1), (F.col("_stop") - F.col("line_no") + 1).cast("int"))
    last = F.aggregate(F.transform(body, lambda x, i: F.when(F.trim(x) != "", i + 1).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
    kept = all_.select("doc", F.col("line_no").alias("start"), last.alias("_n"), body.alias("_body")).where("_n > 0")
    return kept.select("doc", "start", (F.col("start") + F.col("_n") - 1).alias("end"), F.trim(F.array_join(F.transform(F.slice("_body", F.lit(1), F.col("_n")), F.rtrim), "\n")).alias("text"))


#: Rules for report headings (label, pattern, score), by what they make of a file.
REPORTS = (("TOWN_MANAGER_REPORT", r"(?i)\btown\s+manager\s+reports?\b", 1.00), ("DEPARTMENT_HEAD_REPORTS", r"(?i)\bdepartment\s+head\s+reports?\b", 0.97), ("MANAGER_REPORTS_NOTES", r"(?i)manager.?s\s+reports?\s+and\s+notes", 0.94), ("DEPARTMENT_REPORTS", r"(?i)\bdepartment\s+reports?\b", 0.92), ("FINANCE_MANAGER_REPORT", r"(?i)\bfinance\s+manager\s+report\b", 0.85))
ADJACENT = (("MONTHLY_FINANCIAL_REPORT", r"(?i)\bmonthly\s+financial\s+reports?\b", 0.75),)
NOT_REPORTS = (("COUNCIL_MEMBER_REPORTS", r"(?i)\bcouncil\s+member\s+reports?\b", 0.0), ("ATTORNEY_REPORT", r"(?i)\battorney(?:'s)?\s+(?:comments|report)\b", 0.0), ("MAYOR_REPORT", r"(?i)\bmayor(?:'s)?\s+comments\b", 0.0))


def report_files(lines: DataFrame) -> DataFrame:
    """(doc, status, primary_label, positives, negatives) of files with a line on reports: candidate with a department's report, else
    adjacent with another one, else excluded; the primary label is that of the highest score, ties in the rules' order."""
    found = rule_hits(lines.where(F.lower("line").contains("report")), REPORTS + ADJACENT + NOT_REPORTS)
    names = lambda rules: F.array(*[F.lit(n) for n, _, _ in rules])
    order = {n: i for i, (n, _, _) in enumerate(REPORTS + ADJACENT + NOT_REPORTS)}
    rank = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    rows = found.select("doc", F.explode_outer("labels").alias("x")).select("doc", "x.label", "x.score")
    good = F.col("label").isin(*[n for n, _, _ in REPORTS + ADJACENT])
    sums = rows.groupBy("doc").agg(F.collect_set(F.when(good, F.col("label"))).alias("pos"), F.collect_set(F.when(~good, F.col("label"))).alias("neg"), F.min(F.when(good, F.struct(-F.col("score"), F.try_element_at(rank, "label"), F.col("label").alias("l")))).alias("top"))
    status = F.when(F.arrays_overlap("pos", names(REPORTS)), "candidate").when(F.size("pos") > 0, "adjacent").otherwise("excluded")
    return sums.select("doc", status.alias("status"), F.col("top.l").alias("primary_label"), F.array_sort("pos").alias("positives"), F.array_sort("neg").alias("negatives"))


#: A closed session's heading, phrases of talk about one, its reasons and its code.
SESSION = r"(?i)\b(executive(?:/closed)?\s+session|closed\s+session)\b"
SESSION_TALK = ("motion to go into", "on the agenda it says", "conversation was precisely", "is there a motion", "would be going into executive session", "provided a second for the motion", "all members voted")
REASONS = (("personnel", r"\b(personnel|hiring|appointment|discipline|evaluation|compensation)\b"), ("legal_litigation", r"\b(legal\s+counsel|litigation|attorney)\b"), ("contract_negotiation", r"\b(contract|negotiation)\b"), ("property_real_estate", r"\b(property|real\s+estate|land|building)\b"), ("prospective_business", r"\b(prospective\s+business|industry|industrial|economic\s+development)\b"), ("security_emergency", r"\b(security|emergency)\b"))
STATUTE = r"2[. ]*2[- ]*37[1l\]]{2}"


def session_heading(line: Column) -> Column:
    """A line that heads a closed session: it names one at its start, as an item or in capitals, asks nothing and tells of no motion."""
    low = F.lower(line)
    item = line.rlike(r"(?i)^\s*(?:[ivxlcdm]{1,6}|[a-z0-9]{1,3})\s*[.)\-:]\s+")
    shape = item | line.rlike(r"(?i)^\s*(executive(?:/closed)?\s+session|closed\s+session)\b") | ((F.upper(line) == line) & line.rlike("[A-Z]{3}"))
    talk = low.rlike("|".join(SESSION_TALK)) | line.contains("?") | line.rlike(r"^\s*[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,2}\s*[-–—:]\s+\S+")
    return line.rlike(SESSION) & shape & ~talk & (F.length(line) <= 220) & ((F.size(F.split(F.trim(line), r"\s+")) <= 20) | item)


def reason_labels(line: Column) -> Column:
    """The reasons that a line names, in the table's order; its statute alone, or `other`."""
    found = F.array_compact(F.array(*[F.when(line.rlike(f"(?i){p}"), F.lit(n)) for n, p in REASONS]))
    return F.when(F.size(found) > 0, found).when(line.rlike(f"(?i){STATUTE}"), F.array(F.lit("statutory_reference"))).otherwise(F.array(F.lit("other")))


def sessions(lines: DataFrame, boundary: str, ahead: int = 24) -> DataFrame:
    """(doc, line_no, status, reasons): headings of closed sessions with the reason lines among the next ones up to a boundary."""
    w = Window.partitionBy("doc").orderBy("line_no").rowsBetween(0, ahead)
    near = lines.withColumn("_near", F.collect_list(F.coalesce("line", F.lit(""))).over(w)).where(session_heading(F.col("line")))
    edge = F.array_min(F.filter(F.transform("_near", lambda x, i: F.when((i > 0) & x.rlike(boundary), i)), lambda i: i.isNotNull()))
    block = F.slice("_near", F.lit(1), F.coalesce(edge, F.size("_near")))
    signal = f"(?i){STATUTE}|" + "|".join(p.replace(r"\b(", "(").replace(r")\b", ")") for _, p in REASONS)
    reasons = F.filter(block, lambda x: x.rlike(signal))
    labels = F.array_distinct(F.flatten(F.transform(reasons, reason_labels_of)))
    return near.select("doc", "line_no", F.when(F.size(reasons) > 0, "candidate").otherwise("adjacent").alias("status"), labels.alias("reasons"), F.size(reasons).alias("n"))


def reason_labels_of(x: Column) -> Column:
    return reason_labels(x)


def anchored_spans(lines: DataFrame, anchor: Column, back: int = 2, ahead: int = 6) -> DataFrame:
    """(doc, start, end, text): from `back` lines before a document's first anchor to `ahead` behind its last."""
    size = Window.partitionBy("doc")
    spans = lines.withColumn("_a", F.when(anchor, F.col("line_no"))).withColumn("_n", F.max("line_no").over(size)).withColumn("_lo", F.min("_a").over(size) - back).withColumn("_hi", F.max("_a").over(size) + ahead)
    inside = spans.where((F.col("line_no") >= F.col("_lo")) & (F.col("line_no") <= F.col("_hi")))
    rows = inside.groupBy("doc").agg(F.min("line_no").alias("start"), F.max("line_no").alias("end"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    return rows.select("doc", "start", "end", F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("text"))


#: header patterns of ordinances and resolutions, in this order: (name, type, pattern)
HEADERS = (("header_ordinance_no", "ORDINANCE", r"(?i)^\W*ORDINANCE\s+NO\b"), ("header_resolution_no", "RESOLUTION", r"(?i)^\W*RESOLUTION\s+NO\b"), ("header_resolution_standalone", "RESOLUTION", r"(?i)^\W*RESOLUTION\s*$"), ("header_a_resolution", "RESOLUTION", r"(?i)^\W*A\s+RESOLUTION\b"), ("header_an_ordinance", "ORDINANCE", r"(?i)^\W*AN?\s+ORDINANCE\b"))
NUMBER = r"\b([OR0Q9]-[0-9]{4}-[0-9Xx]{2}(?:\.[0-9Xx]+)?(?:-[0-9Xx]{2})?)\b"


def law_documents(lines: DataFrame) -> DataFrame:
    """(doc, line_no, kind, pattern, number, title, confidence): header lines of ordinances and resolutions with the number in them or
    in the next five lines, and a title in the next eight; 0.97 with both, 0.94 with a number, 0.90 with a title, else 0.86."""
    from gavelframe.functions.records import document_number

    w = Window.partitionBy("doc").orderBy("line_no")
    clean = F.trim(F.regexp_replace(F.coalesce("line", F.lit("")), r"\s+", " "))
    near = lines.withColumn("_c", clean).withColumn("_six", F.collect_list("_c").over(w.rowsBetween(0, 5))).withColumn("_eight", F.collect_list("_c").over(w.rowsBetween(0, 7)))
    pattern, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, k, p in reversed(HEADERS):
        pattern, kind = F.when(F.col("_c").rlike(p), n).otherwise(pattern), F.when(F.col("_c").rlike(p), k).otherwise(kind)
    rows = near.withColumn("pattern", pattern).withColumn("kind", kind).where("pattern IS NOT NULL")
    raw = F.get(F.filter(F.transform("_six", lambda x: F.regexp_extract(x, NUMBER, 1)), lambda x: x != ""), F.lit(0))
    titled = lambda x: (F.col("kind") == "RESOLUTION") & F.upper(x).startswith("A RESOLUTION") | (F.col("kind") == "ORDINANCE") & F.upper(x).rlike("^AN? ORDINANCE") | ~x.rlike(r"(?i)^\W*(ORDINANCE|RESOLUTION)\s+NO\b|^\s*---\s*PAGE\b") & (F.upper(x).rlike("AMENDMENT|TITLE ") | ((F.length(x) >= 16) & (F.length(F.regexp_replace(x, r"[^\p{L}]", "")) >= 8)))
    title = F.substring(F.get(F.filter("_eight", titled), F.lit(0)), 1, 220)
    out = rows.select("doc", "line_no", "kind", "pattern", document_number(raw, F.col("kind")).alias("number"), title.alias("title"))
    n, t = F.col("number").isNotNull(), F.col("title").isNotNull()
    return out.withColumn("confidence", F.when(n & t, 0.97).when(n, 0.94).when(t, 0.90).otherwise(0.86))


def best_documents(found: DataFrame) -> DataFrame:
    """One of each document: by its number, else its title, else its place; the most confident, then the first."""
    key = F.coalesce(F.concat(F.lit("n:"), "number"), F.concat(F.lit("t:"), F.upper("title")), F.concat(F.lit("p:"), F.col("line_no").cast("string")))
    w = Window.partitionBy("doc", "kind", key).orderBy(F.desc("confidence"), "line_no")
    return found.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def notice(block: Column) -> Column:
    """struct(type, confidence) of a block that announces something: it must say so, when, and where; null else."""
    has = lambda p: block.rlike(f"(?is){p}")
    says = has(r"\b(notice\s+is\s+hereby\s+given|please\s+take\s+notice|notice\s+of\s+public\s+hearing|public\s+hearing\s+notice|public\s+notice)\b")
    when = has(r"\b(january|february|march|april|may|june|july|august|september|october|november|december)\s+[0-9]{1,2}\b") | has(r"\b[0-9]{1,2}[:.][0-9]{2}\s*[ap]\.?m\b")
    where = has(r"\b(town\s+hall|council\s+chamber|municipal\s+building|street|avenue|road)\b")
    hearing = has(r"\bpublic\s+hearing\b")
    made = lambda n, c: F.struct(F.lit(n).alias("type"), F.lit(c).alias("confidence"))
    return F.when(says & when & where, F.when(hearing & has(r"\bnotice\s+of\s+public\s+hearing\b"), made("public_hearing_notice", 0.97)).when(hearing, made("public_hearing_notice", 0.92)).when(has(r"\bspecial\s+called\b"), made("special_called_meeting_notice", 0.94)).otherwise(made("public_notice_general", 0.88)))


def context_lines(lines: DataFrame, cue: str, first: int = 220, scanned: int = 1800, window: int = 2) -> DataFrame:
    """A document's first lines, and those near a cue within its scanned part."""
    w = Window.partitionBy("doc").orderBy("line_no").rowsBetween(-window, window)
    near = F.max(F.when((F.col("line_no") <= scanned) & F.col("line").rlike(cue), 1)).over(w)
    return lines.withColumn("_near", near).where((F.col("line_no") <= first) | F.col("_near").isNotNull()).drop("_near")


def tail_anchor(source: Column, tail: Column, words: int = 30) -> Column:
    """Whether two neighbouring words of the last 30 of a text stand in its transcript's tail."""
    last = F.regexp_extract_all(F.lower(source), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    last = F.filter(F.slice(last, F.greatest(F.size(last) - words + 1, F.lit(1)), F.lit(words)), lambda w: F.length(w) > 1)
    pairs = F.when(F.size(last) > 1, F.zip_with(F.slice(last, F.lit(1), F.size(last) - 1), F.slice(last, F.lit(2), F.size(last) - 1), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))
    return F.exists(pairs, lambda p: F.contains(F.lower(tail), p))


def minutes_excerpts(rows: list[dict], section, action, heading, most: int = 24) -> list[dict]:
    """Excerpts of one document's lines: sections first, each up to the next heading, two blank lines or `most` lines; then action lines
    that no section covers, with one line before and three behind. section, action and heading are tests of a line."""
    lines = [r["line"] or "" for r in rows]
    out, covered = [], set()

    def keep(kind: str, a: int, b: int) -> None:
        text = "\n".join(x.rstrip() for x in lines[a : b + 1]).strip()
        if text and (kind, a, b) not in {(o["kind"], o["start"] - 1, o["end"] - 1) for o in out}:
            out.append({"doc": rows[0]["doc"], "kind": kind, "start": a + 1, "end": b + 1, "text": text})

    for i, line in enumerate(lines):
        if i in covered or not section(line):
            continue
        end = i
        for j in range(i, min(len(lines), i + most + 1)):
            if j > i and heading(lines[j]):
                break
            end = j
            if j > i + 1 and not lines[j].strip() and not lines[j - 1].strip():
                break
        while end >= i and not lines[end].strip():
            end -= 1
        keep("minutes_section", i, end)
        covered |= set(range(i, end + 1))
    for i, line in enumerate(lines):
        if i not in covered and action(line):
            keep("minutes_action", max(0, i - 1), min(len(lines) - 1, i + 3))
    return sorted(out, key=lambda o: (o["start"], o["end"], o["kind"]))


ROMAN = r"^\s*\(?([IVXLCDM]+)[.)]\s*(.*)$"


def outline(rows: list[dict], ahead: int = 30) -> list[dict]:
    """Sections with Roman numerals and their items. A numeral that was seen, and a new I behind more than five sections, start none; a
    numeral alone takes its title from the next lines before another numeral; an item in a title's tail becomes the first item."""
    import re

    lines = [(r["line"] or "").strip() for r in rows]
    item = re.compile(r"^\s*([0-9]{1,2}|[A-Za-z])[.)]\s+(\S.*)$")
    out, seen = [], set()
    for i, line in enumerate(lines):
        head = re.match(ROMAN, line)
        if head and head[1] not in seen and not (head[1] == "I" and len(seen) > 5):
            following = [head[2], *lines[i + 1 : i + 1 + ahead]]
            stop = next((n for n, x in enumerate(following[1:], 1) if re.match(ROMAN, x)), len(following))
            title = next((x for x in following[:stop] if x), None)
            if title:
                seen.add(head[1])
                tail = re.match(r"^(.*?)(?:\s+|:)([0-9][).\-].*)$", title)
                out.append({"doc": rows[0]["doc"], "section": head[1], "title": (tail[1].strip().rstrip(":") if tail else title), "label": None, "item": None})
                if tail:
                    nested = item.match(tail[2])
                    out.append({"doc": rows[0]["doc"], "section": head[1], "title": None, "label": nested[1] if nested else "1", "item": nested[2] if nested else tail[2]})
                continue
        nested = item.match(line)
        if nested and out and not re.fullmatch("[IVX]+", nested[1].upper()):
            out.append({"doc": rows[0]["doc"], "section": out[-1]["section"], "title": None, "label": nested[1], "item": nested[2]})
    return [{**o, "n": n} for n, o in enumerate(out, 1)]


def fallback_sections(lines: DataFrame, action: str, marker: str, first: int = 220, longest: int = 18) -> DataFrame:
    """(doc, n, line_no, title): of a document's first lines those with a marker (its title alone) or an action, each title once."""
    title = F.when(F.col("line").rlike(marker), F.regexp_extract("line", marker, 1)).when(F.col("line").rlike(action), F.col("line"))
    rows = lines.where(F.col("line_no") <= first).select("doc", "line_no", F.trim(F.regexp_replace(title, r"\s+", " ")).alias("title"))
    letters = F.length(F.regexp_replace("title", r"[^\p{L}]", "")) / F.greatest(F.length(F.regexp_replace("title", r"\s", "")), F.lit(1))
    good = rows.where((F.col("title") != "") & (F.size(F.split("title", " ")) <= longest) & (letters >= 0.55) & (F.regexp_count("title", F.lit("[A-Za-z]{2,}")) >= 2))
    once = good.groupBy("doc", F.lower("title").alias("k")).agg(F.min_by("title", "line_no").alias("title"), F.min("line_no").alias("line_no"))
    return once.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("line_no")).alias("n"), "line_no", "title")
