"""Column expressions for names, numbers, references, dates, times, nested values and OCR metrics; all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelframe.functions import text as X
from gavelframe.operators.relational import merged_maps

#: Words that tell nothing about a packet's content.
STOP_WORDS = ("about", "after", "again", "agenda", "being", "between", "could", "first", "from", "meeting", "minutes", "other", "shall", "should", "there", "their", "these", "those", "through", "under", "where", "which", "while", "would")
#: Replacements of misheard words, in this order, each at word bounds and in any case; places and people are parameters.
MISHEARD = (("Gini coefficient", "Virginia Code"), ("Gini", "Virginia"), ("Kaneko", "Section"), ("Akane", "I can"), ("moticn", "motion"), ("moti n", "motion"), ("vceda", "VCEDA"), ("psa", "PSA"), ("avwap", "AVWAP"), ("pca", "PCA"), ("ordinanc", "ordinance"), ("councilmember", "Council Member"))
#: Misread suffixes of organisations.
MISREAD = (("Counciy", "Council"), ("Counci", "Council"), ("Comnission", "Commission"), ("Comnittee", "Committee"), ("Departnent", "Department"), ("Authorty", "Authority"), ("Authorlty", "Authority"))
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")

#: The accepted titles of meetings.
MEETING_TITLES = ("council meeting", "town council", "regular meeting", "special called", "public hearing", "work session")


def lexical_tokens(x: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Distinct words of five and more ASCII letters, lower case, that are no stop words."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit("[a-z]{5,}"), F.lit(0))), F.array(*map(F.lit, stop)))


def law_references(x: Column) -> Column:
    """`ordinance 202401`, `resolution r7`: sorted distinct references whose code holds a digit."""
    found = F.regexp_extract_all(F.lower(x), F.lit(r"\b(?:ordinance|resolution)\s*(?:no\.?|number|#)?\s*[a-z0-9][a-z0-9\-./]{1,40}"), F.lit(0))
    kind = lambda m: F.regexp_extract(m, "^(ordinance|resolution)", 1)
    code = lambda m: F.regexp_replace(F.regexp_extract(m, r"^(?:ordinance|resolution)\s*(?:no\.?|number|#)?\s*([a-z0-9][a-z0-9\-./]{1,40})", 1), "[^a-z0-9]", "")
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda m: F.concat(kind(m), F.lit(" "), code(m))), lambda r: F.split(r, " ")[1].rlike("[0-9]"))))


def key_value(line: Column, cells: Column | None = None) -> Column:
    """struct(key, value, source) of a `key: value` line whose colon stands within 41 characters, or of aligned cells; null else."""
    at = F.instr(line, ":")
    key = F.trim(F.substring(line, F.lit(1), at - 1))
    colon = F.when((at >= 2) & (at <= 41) & (key != ""), F.struct(key.alias("key"), F.trim(F.substring(line, at + 1, F.length(line))).alias("value"), F.lit("colon_line").alias("source")))
    if cells is None:
        return colon
    first = F.btrim(F.get(cells, F.lit(0)), F.lit(" :"))
    rest = F.array_join(F.filter(F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), lambda c: F.trim(c)), lambda c: c != ""), " | ")
    return F.when((at >= 2) & (at <= 41), colon).when((F.size(cells) >= 2) & (first != "") & (rest != "") & (F.length(first) <= 48), F.struct(first.alias("key"), rest.alias("value"), F.lit("aligned_cells").alias("source")))


def deep_merge(base: Column, updates: Column) -> Column:
    """Maps of maps: inner maps that both have are merged, all else is replaced."""
    return F.map_zip_with(base, updates, lambda _, a, b: F.when(a.isNotNull() & b.isNotNull(), merged_maps(a, b)).otherwise(F.coalesce(b, a)))


def safe_date(ymd: Column) -> Column:
    """yyyyMMdd to a date; null for what is none."""
    return F.when(ymd.rlike("^[0-9]{8}$"), F.try_to_date(ymd, "yyyyMMdd"))


def month_number(name: Column) -> Column:
    """1 to 12 of a month's name or its first three letters, in any case; null else."""
    short = F.lower(F.substring(name, 1, 3))
    return F.nullif(F.ceil(F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), short) / 3).cast("int"), F.lit(0))


def _int(x: Column) -> Column:
    return F.nullif(x, F.lit("")).try_cast("int")


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0.0)).cast("date")


LONG_DATE = r"(?i)\b(january|february|march|april|may|june|july|august|september|october|november|december)\s+([0-9]{1,2})(?:st|nd|rd|th)?\s*[,.;:\-]{0,3}\s*([12][0-9. ]{3,7})\b"
NUMERIC_DATE = r"\b([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4}|[0-9]{2})\b"


def long_date(line: Column) -> Column:
    """The first `March 5, 2024` of a line; dots and spaces that a scan put into the year go."""
    part = lambda i: F.regexp_extract(line, LONG_DATE, i)
    year = _int(F.substring(F.regexp_replace(part(3), "[. ]", ""), 1, 4))
    return _date(year, month_number(part(1)), _int(part(2)))


def numeric_date(line: Column) -> Column:
    """The first M/D/Y or M-D-Y of a line; two-digit years are of this century."""
    part = lambda i: _int(F.regexp_extract(line, NUMERIC_DATE, i))
    year = part(3)
    return _date(F.when(year < 100, year + 2000).otherwise(year), part(1), part(2))


#: hour, minute and half of the day, tried in this order: strict minutes, one-digit minutes, a blank for the colon, hours alone
TIMES = (r"(?i)\b([0-9]{1,2})\s*[:.]\s*([0-9]{2})\s*([ap])\.?\s*m\b", r"(?i)\b([0-9]{1,2})\s*[:.]\s*([0-9]{1,2})\s*([ap])\.?\s*m\b", r"(?i)\b([0-9]{1,2})\s+([0-9]{2})\s*([ap])\.?\s*m\b", r"(?i)\b([0-9]{1,2})()\s*([ap])\.?\s*m\b")


def clock_time(line: Column) -> Column:
    """`7:05 PM`: the first pattern whose hour is 1 to 12 and minute below 60; null else."""
    found = []
    for p in TIMES:
        hour, minute, half = (F.regexp_extract(line, p, i) for i in (1, 2, 3))
        h, m = _int(hour), F.coalesce(_int(minute), F.lit(0))
        found.append(F.when((half != "") & h.between(1, 12) & (m <= 59), F.format_string("%d:%02d %sM", h, m, F.upper(half))))
    return F.coalesce(*found)


def date_mentions(x: Column, hint: Column) -> Column:
    """array<struct<iso_date, raw>> of month-name and numeric dates, distinct and sorted. Years follow full_year(); month names without
    a year take the hint's. Mentions that are no dates are dropped."""
    low = F.lower(x)
    month = r"\b(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\b[\s._,-]*([0-9]{1,2})(?:st|nd|rd|th)?(?:[\s._,-]+([0-9]{2,4})\b)?"
    number = r"\b([0-9]{1,2})[.\-_/ ]+([0-9]{1,2})[.\-_/ ]+([0-9]{2,4})\b"
    year = lambda y: F.when(y != "", X.full_year(_int(y), hint)).otherwise(hint)
    of = lambda raw, y, m, d: F.struct(F.date_format(_date(year(y).cast("int"), m, _int(d)), "yyyy-MM-dd").alias("iso_date"), F.trim(raw).alias("raw"))
    names = F.transform(F.regexp_extract_all(low, F.lit(month), F.lit(0)), lambda r: of(r, F.regexp_extract(r, month, 3), month_number(F.regexp_extract(r, month, 1)), F.regexp_extract(r, month, 2)))
    numbers = F.transform(F.regexp_extract_all(low, F.lit(number), F.lit(0)), lambda r: of(r, F.regexp_extract(r, number, 3), _int(F.regexp_extract(r, number, 1)), F.regexp_extract(r, number, 2)))
    return F.array_sort(F.array_distinct(F.filter(F.concat(names, numbers), lambda s: s["iso_date"].isNotNull())))


def document_number(raw: Column, kind: Column) -> Column:
    """Upper case without brackets, end marks and blanks; a leading 0, Q or 9 of an ordinance and 0 of a resolution reads O. Null if empty."""
    clean = F.upper(F.regexp_replace(F.regexp_replace(X.normalize_ws(raw), r"^[()\[\]{}:;,.]+|[()\[\]{}:;,.]+$", ""), " ", ""))
    lead = F.substring(clean, 1, 1)
    misread = ((kind == "ORDINANCE") & lead.isin("0", "Q", "9")) | ((kind == "RESOLUTION") & (lead == "0"))
    return F.nullif(F.when(misread, F.concat(F.lit("O"), F.substring(clean, 2, 1000))).otherwise(clean), F.lit(""))


def statute_reference(raw: Column) -> Column:
    """`Va Code section 2.2 3711 (A)(1)` becomes `2.2-3711(A)(1)`."""
    x = F.replace(F.upper(X.normalize_ws(raw)), F.lit("\\"), F.lit(""))
    for words in (r"\bVA\s*CODE(?:\s*SECTION)?\b", r"\bCODE\s*SECTION\b", r"\bSECTION\b"):
        x = F.regexp_replace(x, words, "")
    return F.regexp_replace(F.regexp_replace(F.btrim(x, F.lit(" :;-")), r"\s+", ""), "([0-9]{1,2}\\.[0-9]{1,2})[- ]?([0-9]{3,4})", "$1-$2")


def misheard(x: Column, pairs: tuple[tuple[str, str], ...] = MISHEARD) -> tuple[Column, Column]:
    """(text, number of replacements): ordered replacements, each counted on the text that the ones before left."""
    count = F.lit(0)
    for wrong, right in pairs:
        p = rf"(?i)\b{wrong}\b"
        count = count + F.regexp_count(x, F.lit(p))
        x = F.regexp_replace(x, p, right)
    return x, count


def misread_name(x: Column, pairs: tuple[tuple[str, str], ...] = MISREAD) -> Column:
    """OCR typos in the suffixes of organisations set right; a person's name and a dash before an organisation go."""
    for wrong, right in pairs:
        x = F.regexp_replace(x, rf"(?i)\b{wrong}\b", right)
    return X.normalize_ws(F.regexp_replace(X.normalize_ws(x), r"^[A-Z][a-z]+ ?- ?(?=[A-Z][a-z]+ (?:Council|Commission|Committee|Department|Authority))", ""))


def category(x: Column) -> Column:
    """PERSON is PEOPLE, an empty category UNKNOWN; others stay in upper case."""
    up = F.upper(F.trim(F.coalesce(x, F.lit(""))))
    return F.when(up == "PERSON", "PEOPLE").when(up == "", "UNKNOWN").otherwise(up)


def first_name_field(*names: Column) -> Column:
    """The first of the fields that is not empty, else source.pdf."""
    return F.coalesce(*[F.nullif(n, F.lit("")) for n in names], F.lit("source.pdf"))


def is_meeting(title: Column, phrases: tuple[str, ...] = MEETING_TITLES) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    return F.coalesce(low.rlike("|".join(phrases)), F.lit(False))


def self_named(x: Column) -> Column:
    """Who says `this is Name`."""
    return F.nullif(F.regexp_extract(x, "this is ([A-Z][a-z]+)", 1), F.lit(""))


def headings(x: Column, k: int = 6, longest: int = 140) -> Column:
    """The first k lines of at most 140 characters within the first 2k non-empty lines."""
    return F.slice(F.filter(F.slice(X.nonempty_lines(x), 1, 2 * k), lambda t: F.length(t) <= longest), 1, k)


def tagged_block(x: Column, tag: str = "SCHEMA_SUGGESTION_BOX") -> Column:
    """map of the `key: value` lines between [TAG] and [/TAG]; lines that begin with a dash are left out."""
    body = F.regexp_extract(x, rf"(?s)\[{tag}\](.*?)\[/{tag}\]", 1)
    lines = F.filter(F.split(F.trim(body), "\n"), lambda s: s.contains(":") & ~F.trim(s).startswith("-"))
    pair = F.transform(lines, lambda s: F.struct(F.trim(F.substring_index(s, ":", 1)).alias("k"), F.trim(F.substring(s, F.instr(s, ":") + 1, F.length(s))).alias("v")))
    last = F.filter(pair, lambda p, i: ~F.exists(F.slice(pair, i + 2, F.greatest(F.size(pair) - i - 1, F.lit(0))), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def compact_fact(context: Column, value: Column, limit: int = 140, context_limit: int = 280) -> Column:
    """A JSON fact of clipped texts."""
    return F.to_json(F.struct(X.clip(context, context_limit).alias("context"), X.clip(value, limit).alias("value")))


def json_or_empty(x: Column, schema: str) -> Column:
    """The parsed object; one without values for text that is no JSON."""
    return F.coalesce(F.from_json(x, schema), F.from_json(F.lit("{}"), schema))


def ocr_metrics(x: Column) -> dict[str, Column]:
    """Counts and ratios of recognised text, and its quality score."""
    token = r"[A-Za-z0-9][A-Za-z0-9'&/.-]*"
    toks = F.regexp_extract_all(x, F.lit(token), F.lit(0))
    n = F.size(toks)
    count = lambda test: F.size(F.filter(toks, test))
    lexical = count(lambda t: (F.length(t) >= 4) & t.rlike("[A-Za-z]") & t.rlike("[AEIOUYaeiouy]"))
    shown = F.length(F.regexp_replace(x, r"[\s\p{C}\p{Z}]", ""))
    noise = F.length(F.regexp_replace(x, r"""[\s\p{C}\p{Z}\p{L}\p{N}.,;:!?()\[\]{}'"\-_/\\&%$#@+=*]""", ""))
    lines = F.size(X.nonempty_lines(x))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    alnum = X.alnum_count(x)
    noise_ratio, one = share(noise, shown), F.lit(1.0)
    quality = F.least(F.lit(0.35), alnum / 320.0) + F.least(F.lit(0.2), n / 40.0) + F.least(F.lit(0.2), lexical / 20.0) + F.greatest(F.lit(0.0), (one - F.least(one, noise_ratio)) * 0.15) + F.least(F.lit(0.1), lines / 20.0)
    return {
        "alnum_count": alnum,
        "word_count": n,
        "lexical_word_count": lexical,
        "numeric_token_count": count(lambda t: t.rlike("[0-9]")),
        "line_count": lines,
        "avg_word_length": F.round(share(F.aggregate(toks, F.lit(0), lambda a, t: a + F.length(t)), n), 2),
        "short_word_ratio": F.round(share(count(lambda t: F.length(t) <= 2), n), 4),
        "noise_char_count": noise,
        "noise_ratio": F.round(noise_ratio, 4),
        "lexical_ratio": F.round(share(lexical, n), 4),
        "quality_score": F.round(F.least(F.lit(0.99), quality), 4),
    }


#: Fixed weights of the choice between recognised texts.
SELECTION = {"alnum_count": 1.0, "word_count": 4.0, "lexical_word_count": 18.0, "line_count": 1.5, "avg_word_length": 6.0, "lexical_ratio": 120.0, "short_word_ratio": -80.0, "noise_char_count": -4.0}


def selection_score(m: dict[str, Column], favor_numeric: bool = False) -> Column:
    total = sum((m[k] * w for k, w in SELECTION.items()), m["numeric_token_count"] * (2.0 if favor_numeric else 0.75))
    return F.round(total + F.greatest(F.lit(0.0), F.lit(1.0) - m["noise_ratio"]) * 20.0, 2)


def run_id_ok(x: Column) -> Column:
    return x.rlike("^RUN_[0-9]{4}_[0-9]{2}_[0-9]{2}_[A-F0-9]{4}$")


def input_errors(name: Column, size_bytes: Column, n_pages: Column, run_id: Column, max_mb: int = 500, max_pages: int = 2000) -> Column:
    """What is wrong with a submitted file, in this order; empty if nothing is."""
    tests = [("bad_run_id", ~run_id_ok(run_id)), ("bad_name", ~name.rlike(r"(?i)^[a-z0-9._-]+\.pdf$")), ("too_large", size_bytes > max_mb * 1024 * 1024), ("no_pages", n_pages < 1), ("too_many_pages", n_pages > max_pages)]
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(True)), F.lit(n)) for n, t in tests]))


def source_id(url: Column, marker: str) -> Column:
    """The unquoted path of an address behind the marker; the whole path without one."""
    path = F.url_decode(F.parse_url(url, F.lit("PATH")))
    return F.when(F.instr(path, marker) > 0, F.substring(path, F.instr(path, marker) + len(marker), F.length(path))).otherwise(path)


def created_date(name: Column, hint: Column) -> Column:
    """A file's date: a month's name, else M-D-Y, else M-D-x-Y; January 1 of the hint's year if there is none."""
    month = long_date(name)
    apart = r"([0-9]{1,2})[.\-_/ ]+([0-9]{1,2})[.\-_/ ]+[^0-9.\-_/ ]+[.\-_/ ]+([0-9]{2,4})"
    part = lambda i: _int(F.regexp_extract(name, apart, i))
    whole = r"(?:^|[^0-9])([0-9]{1,2})[.\-_/ ]+([0-9]{1,2})[.\-_/ ]+([0-9]{2,4})(?:[^0-9]|$)"
    plain = F.when(name.rlike(whole), X.month_day_year(name, hint))
    return F.coalesce(month, plain, _date(X.full_year(part(3), hint), part(1), part(2)), F.make_date(hint, F.lit(1), F.lit(1)))


def form_feed_pages(x: Column, count: Column) -> Column:
    """Pages between form feeds: blank ones at the end go, then the list is padded with empty pages or cut to the count."""
    pages = F.split(x, "\f")
    last = F.aggregate(F.transform(pages, lambda p, i: F.when(F.trim(F.regexp_replace(p, r"\s", "")) != "", i + 1).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
    kept = F.slice(pages, F.lit(1), last)
    return F.slice(F.concat(kept, F.array_repeat(F.lit(""), count)), F.lit(1), count)


def pdf_reject(content: Column, least: int = 1024) -> Column:
    """Why a download is no PDF; null if it is one. Null content is a failed download."""
    head = F.decode(F.substring(content, 1, 32), "ISO-8859-1")
    return F.when(content.isNull(), "download_failed").when(F.length(content) == 0, "empty").when(F.length(content) < least, "too_small").when(~head.contains("%PDF-"), "non_pdf")


def has_kind(tags: Column, types: list[Column], kind: str) -> Column:
    """Whether a page's tags hold the kind; without tags whether one of the type columns does."""
    by_type = sum((F.coalesce(t == kind, F.lit(False)).cast("int") for t in types), F.lit(0)) > 0
    return F.when(tags.isNull() | (F.size(tags) == 0), by_type).otherwise(F.array_contains(tags, kind))
