"""Column expressions for text, numbers, dates and pages. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_ws(x: Column) -> Column:
    """Runs of white space (Unicode) become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def normalize_text(x: Column) -> Column:
    """Lower case, everything but letters and digits becomes one space."""
    return F.trim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " "))


def tokens(x: Column) -> Column:
    """ASCII [a-z0-9]+ of the lower-cased text."""
    return F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9]+"), F.lit(0))


def words(x: Column) -> Column:
    """Unicode word tokens, lower-cased."""
    return F.regexp_extract_all(F.lower(x), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def clip(x: Column, limit: int) -> Column:
    """At most `limit` characters, the last an ellipsis if something was cut."""
    return F.when(F.length(x) > limit, F.concat(F.rtrim(F.substring(x, 1, limit - 1)), F.lit("…"))).otherwise(x)


def trim_marks(x: Column, marks: str = " ,;:.|-") -> Column:
    return F.regexp_replace(x, f"^[{_class(marks)}]+|[{_class(marks)}]+$", "")


def _class(marks: str) -> str:
    return "".join("\\" + c if c in "\\]^-[" else c for c in marks)


def registry_id(category: Column, name: Column) -> Column:
    """CATEGORY_SAFE_NAME."""
    return F.concat(F.upper(category), F.lit("_"), F.regexp_replace(F.regexp_replace(F.upper(name), "[^A-Z0-9]+", "_"), "^_+|_+$", ""))


def alnum_count(x: Column) -> Column:
    return F.length(F.regexp_replace(x, r"[^\p{L}\p{N}]", ""))


def allowed_ratio(x: Column) -> Column:
    """Share of plain characters; 0 for empty text."""
    return F.when(F.length(x) > 0, F.length(F.regexp_replace(x, r"""[^a-zA-Z0-9\s.,!?;:()'"-]""", "")) / F.length(x)).otherwise(F.lit(0.0))


def caption_generation(x: Column) -> Column:
    """3 with speaker marks, 2 with punctuation and capitals (or short), else 1."""
    upper = F.length(F.regexp_replace(x, r"[^\p{Lu}]", ""))
    return F.when(x.contains(">>") | x.contains("&gt;&gt;"), 3).when(x.contains(".") & ((upper / F.length(x) > 0.05) | (F.length(x) < 50)), 2).otherwise(1)


def title_tokens(x: Column) -> Column:
    """Upper-case tokens in title case, others as they are."""
    return F.array_join(F.transform(F.split(x, " +"), lambda t: F.when(t.rlike(r"^\p{Lu}{2,}$"), F.initcap(t)).otherwise(t)), " ")


def person_key(x: Column) -> Column:
    """First and last token, upper case."""
    parts = F.filter(F.split(F.upper(x), " +"), lambda t: t != "")
    return F.when(F.size(parts) == 0, "").when(F.size(parts) == 1, F.get(parts, F.lit(0))).otherwise(F.concat(F.get(parts, F.lit(0)), F.lit(" "), F.element_at(parts, -1)))


def split_people(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, r"\s*(?:,|&|\band\b)\s*"), lambda t: F.trim(t)), lambda t: (t != "") & ~F.lower(t).isin("unknown", "n/a", "none"))


def nonempty_lines(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, "\n"), lambda t: F.trim(t)), lambda t: t != "")


def context_slice(x: Column, at: Column, size: Column, window: int) -> Column:
    """The text around a match that starts at the 1-based place `at`."""
    start = F.greatest(at - window, F.lit(1))
    return normalize_ws(F.substring(x, start, at + size + window - start))


def missing_value(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x)).isin("", "unknown", "n/a", "none", "null"), F.lit(True))


def keyword_hits(x: Column, patterns: list[str]) -> Column:
    """How many of the patterns match at all."""
    return sum((F.coalesce(x.rlike(p), F.lit(False)).cast("int") for p in patterns), F.lit(0))


def full_year(raw: Column, hint: Column) -> Column:
    """Two-digit years take the hint's century if that is within five years of it, else 1970 to 2069."""
    near = F.floor(hint / 100) * 100 + raw
    return F.when(raw >= 100, raw).when(hint.isNotNull() & (F.abs(near - hint) <= 5), near).when(raw <= 69, raw + 2000).otherwise(raw + 1900).cast("int")


def month_day_year(x: Column, hint: Column) -> Column:
    """First M-D-Y date with . - _ / or space between, else January 1 of the hint's year."""
    p = r"(?:^|[^0-9])([0-9]{1,2})[.\-_/ ]+([0-9]{1,2})[.\-_/ ]+([0-9]{2,4})(?:[^0-9]|$)"
    m, d, y = (F.try_to_number(F.nullif(F.regexp_extract(x, p, i), F.lit("")), F.lit("9999")).cast("int") for i in (1, 2, 3))
    return F.coalesce(F.try_make_timestamp(full_year(y, hint), m, d, F.lit(0), F.lit(0), F.lit(0.0)).cast("date"), F.make_date(hint, F.lit(1), F.lit(1)))


def tolerant_double(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"[$%,]", "")).try_cast("double")


#: tokens of the normalised text that hold a letter, a vowel or a digit, and those of one character
TOKEN_KINDS = {"alpha": "[0-9]*+[a-z][a-z0-9]*+", "vowel": "[b-df-hj-np-tv-z0-9]*+[aeiou][a-z0-9]*+", "numeric": "[a-z]*+[0-9][a-z0-9]*+", "short": "(?<![a-z0-9])[a-z0-9](?![a-z0-9])"}


def page_metrics(x: Column, norm: Column | None = None) -> dict[str, Column]:
    """The ten metrics of a page's text; ratios over nothing are 0, that of short tokens 1. norm: its normalised text, if it stands in
    a column already. with_page_metrics() puts it there, so that it is made once and not in each metric."""
    norm = normalize_text(x) if norm is None else norm
    count = lambda p: F.regexp_count(norm, F.lit(p))
    n, alpha = count("[a-z0-9]+"), count(TOKEN_KINDS["alpha"])
    share = lambda a, b, none=0.0: F.when(b > 0, a / b).otherwise(F.lit(none))
    return {
        "char_count": F.length(x),
        "normalized_char_count": F.length(norm),
        "alnum_count": alnum_count(x),
        "token_count": n,
        "unique_token_count": F.size(F.array_distinct(tokens(norm))),
        "lexical_ratio": share(alpha, n),
        "vowel_ratio": share(count(TOKEN_KINDS["vowel"]), alpha),
        "numeric_ratio": share(count(TOKEN_KINDS["numeric"]), n),
        "symbol_ratio": share(F.length(F.regexp_replace(x, r"[\p{L}\p{N}\s]", "")), F.length(x)),
        "short_token_ratio": share(count(TOKEN_KINDS["short"]), n, 1.0),
    }


def with_page_metrics(df: DataFrame, text: str = "text", names: list[str] | None = None) -> DataFrame:
    """The rows with the metrics named (all ten by default), each text normalised once. Columns of those names are replaced."""
    metrics = page_metrics(F.col(text), F.col("__norm"))
    names = names or list(metrics)
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, normalize_text(F.col(text)).alias("__norm")).select(*kept, *[metrics[n].alias(n) for n in names])


#: Fixed weights of the reference-quality score: term -> weight.
QUALITY_WEIGHTS = {"alnum": 0.26, "token": 0.20, "lexical": 0.16, "vowel": 0.14, "symbol": 0.10, "short": 0.08, "numeric": 0.06}


def reference_quality(m: dict[str, Column]) -> Column:
    one = F.lit(1.0)
    terms = {
        "alnum": F.least(one, m["alnum_count"] / 320.0),
        "token": F.least(one, m["token_count"] / 120.0),
        "lexical": m["lexical_ratio"],
        "vowel": m["vowel_ratio"],
        "symbol": one - F.least(one, m["symbol_ratio"] * 3.0),
        "short": one - m["short_token_ratio"],
        "numeric": F.least(one, m["numeric_ratio"] * 1.5),
    }
    return sum((terms[k] * w for k, w in QUALITY_WEIGHTS.items()), F.lit(0.0))


def rescue_score(x: Column) -> Column:
    """Letters count, odd characters cost, length counts up to 6000 characters, text without white space loses 8."""
    n = F.greatest(F.length(x), F.lit(1))
    letters = F.length(F.regexp_replace(x, r"[^\p{L}]", "")) / n
    odd = F.length(F.regexp_replace(x, r"[\x00-\x7E\s]", "")) / n
    space = F.length(F.regexp_replace(x, r"[^\s]", "")) / n
    return letters * 100.0 - odd * 250.0 + F.least(F.length(x), F.lit(6000)) / 120.0 - F.when(space < 0.05, 8.0).otherwise(0.0)


def token_scores(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """(precision, recall, F1) of the distinct tokens of a against those of b."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    both = F.size(F.array_intersect(x, y))
    p = F.when(F.size(x) > 0, both / F.size(x)).otherwise(F.lit(0.0))
    r = F.when(F.size(y) > 0, both / F.size(y)).otherwise(F.lit(0.0))
    return p, r, F.when(p + r > 0, 2.0 * p * r / (p + r)).otherwise(F.lit(0.0))


def page_status(quality: Column, comparable: Column) -> Column:
    return F.when(~comparable, "unverifiable").when(quality >= 0.80, "pass").when(quality >= 0.65, "warn").otherwise("fail")


def disposition(result: Column) -> Column:
    """Outcome line -> code; the tests are tried in this order."""
    return (
        F.when(result.startswith("[SUCCESS]"), "OK95")
        .when(result.startswith("[SKIP]"), "SKIP")
        .when(result.contains("No text found in VTT"), "EMPTYVTT")
        .when(result.contains("insufficient_turns"), "LOWSIG")
        .when(result.contains("low_squeezed_coverage"), "LOWCOV95")
        .when(result.contains("unknown_saturation"), "UNKSAT")
        .when(result.contains("Source") & result.contains("not found"), "NOSRC")
        .otherwise("FAILED")
    )


def run_status(source: Column, hash_match: Column, missing: Column, comparable: Column, accepted: Column, failed: Column, passed: Column, warned: Column, artifacts_missing: Column, min_pages: int = 60) -> tuple[Column, Column]:
    """(status, reason) of a run: the first rung of the ladder that holds."""
    ladder = [
        (~source, "fail", "source_unavailable"),
        (F.coalesce(~hash_match, F.lit(False)), "fail", "source_hash_mismatch"),
        (missing > 0, "fail", "page_coverage_gap"),
        (comparable < min_pages, "warn", "insufficient_comparable_pages"),
        (comparable == 0, "warn", "no_comparable_source_text"),
        ((accepted >= 0.95) & (failed <= 0.05), "pass", "accepted_ratio_met"),
        ((passed >= 0.95) & (artifacts_missing == 0), "pass", "pass_ratio_met"),
        (warned >= 0.90, "warn", "warn_ratio_met"),
    ]
    status, reason = F.lit("fail"), F.lit("ratio_below_threshold")
    for test, s, r in reversed(ladder):
        status, reason = F.when(test, s).otherwise(status), F.when(test, r).otherwise(reason)
    return status, reason


def extraction_route(native: Column, quality: Column, region_ids: Column, handwriting: Column) -> Column:
    tables = F.exists(region_ids, lambda r: r.contains("_TAB_"))
    return F.when(handwriting, "ocr_handwriting_page").when(native & (quality >= 0.85), F.when(tables, "native_text_plus_layout").otherwise("native_text_only")).otherwise(F.when(tables, "ocr_mixed_layout_page").otherwise("ocr_text_page"))


def turn_metrics(turns: DataFrame) -> DataFrame:
    """(doc, turns, unknown_ratio, source_words, output_words, coverage) of turns with role, name, text and the source's words."""
    unknown = F.count_if((F.upper("role") == "UNKNOWN") | (F.upper("name") == "UNKNOWN"))
    sums = turns.groupBy("doc").agg(F.count("*").alias("turns"), unknown.alias("unknown"), F.max("source_words").alias("source_words"), F.sum(F.size(words(F.col("text")))).alias("output_words"))
    exact = F.when(F.col("source_words") > 0, F.col("output_words") / F.col("source_words"))
    return sums.select("doc", "turns", F.round(F.col("unknown") / F.col("turns"), 3).alias("unknown_ratio"), "source_words", "output_words", exact.alias("exact"), F.round(exact, 3).alias("coverage"))


def transcript_issues(least_turns: int = 5, most_unknown: float = 0.98, least_coverage: float = 0.95) -> Column:
    """What keeps a transcript with these metrics from passing its gate; empty if nothing does."""
    tests = [("empty_or_unparseable_source_vtt", F.col("source_words") == 0), ("insufficient_turns", F.col("turns") < least_turns), ("unknown_saturation", F.col("unknown_ratio") > most_unknown), ("low_squeezed_coverage", F.col("exact") < least_coverage)]
    return F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests]))


def first_disposition(*codes: Column) -> Column:
    """The first code that is there and no SKIP, in upper case; SKIP if there is none."""
    return F.coalesce(*[F.nullif(F.nullif(F.upper(F.trim(c)), F.lit("SKIP")), F.lit("")) for c in codes], F.lit("SKIP"))


def status_rollup(pages: DataFrame, run: str, expected: int) -> DataFrame:
    """Runs of pages (page, status): counts by status, ratios over the comparable pages, and how many of the expected pages are missing."""
    n = lambda s: F.count_if(F.col("status") == s)
    sums = pages.groupBy(run).agg(F.count("*").alias("pages"), n("pass").alias("passed"), n("warn").alias("warned"), n("fail").alias("failed"), n("unverifiable").alias("unverifiable"), (F.lit(expected) - F.count_distinct("page")).cast("long").alias("missing"))
    comparable = F.col("pages") - F.col("unverifiable")
    ratio = lambda x: F.when(comparable > 0, F.round(x / comparable, 4)).otherwise(F.lit(0.0))
    return sums.select(run, "pages", "passed", "warned", "failed", "unverifiable", ratio(F.col("passed")).alias("pass_ratio"), ratio(F.col("passed") + F.col("warned")).alias("accepted_ratio"), ratio(F.col("failed")).alias("fail_ratio"), "missing")


def duplicate_groups(docs: DataFrame, key: str, text: str, least: int = 40, members: bool = True) -> DataFrame:
    """(text_hash, page_count, members in order) of pages of equal normalised text, the largest group first, then by the first member."""
    d = docs.select(key, normalize_text(F.col(text)).alias("n")).where(F.length("n") >= least).select(key, F.sha2("n", 256).alias("text_hash"))
    counts = [F.count("*").alias("page_count"), F.min(key).alias("__first")]
    groups = d.groupBy("text_hash").agg(*counts, *[F.array_sort(F.collect_list(key)).alias("members")] * members).where("page_count > 1")
    return groups.orderBy(F.desc("page_count"), "__first").drop("__first")


def report_integrity(anchors: Column, all_anchors: Column, excerpts: Column, all_excerpts: Column, clean: Column, of: Column) -> Column:
    """0.75 of matched anchors, 0.15 of excerpts, 0.10 of clean ones; the last share is 1 over nothing, the others 0."""
    share = lambda a, b, none: F.when(b > 0, a / b).otherwise(F.lit(none))
    return share(anchors, all_anchors, 0.0) * 0.75 + share(excerpts, all_excerpts, 0.0) * 0.15 + share(clean, of, 1.0) * 0.10


def session_integrity(anchors: Column, all_anchors: Column, reasons: Column, all_reasons: Column, covered: Column, of: Column) -> Column:
    """0.70 of matched anchors, 0.20 of reasons, 0.10 of coverage; the share of reasons is 1 over nothing, the others 0."""
    share = lambda a, b, none: F.when(b > 0, a / b).otherwise(F.lit(none))
    return share(anchors, all_anchors, 0.0) * 0.70 + share(reasons, all_reasons, 1.0) * 0.20 + share(covered, of, 0.0) * 0.10


def low_text(pages: DataFrame, record: str, per_page: int = 500, in_all: int = 1000) -> DataFrame:
    """(record, total, per_page, low, likely_empty) of records with a text a page."""
    sums = pages.groupBy(record).agg(F.sum(F.length("text")).alias("total"), F.count("*").alias("pages"), (F.sum(F.length(F.trim("text"))) == 0).alias("likely_empty"))
    each = F.col("total") / F.col("pages")
    return sums.select(record, "total", each.alias("per_page"), ((each < per_page) | (F.col("total") < in_all)).alias("low"), "likely_empty")


def reference_choice(native_chars: Column, native_quality: Column, ocr_quality: Column, alignment: Column, least: int = 400) -> Column:
    """native, ocr or none: what a page's text is held against."""
    return F.when((native_chars >= least) & (native_quality >= 0.35), "native").when((ocr_quality >= 0.35) & (alignment >= 0.08), "ocr").otherwise("none")


def stage_outcome(failed: Column, tries: Column, retries: int = 2) -> Column:
    """done, retry while there are attempts left, else quarantined."""
    return F.when(~failed, "done").when(tries <= retries, "retry").otherwise("quarantined")


def numeric_recall(a: Column, b: Column) -> Column:
    """Share of the reference's number tokens that the text has; of all its tokens if it has no numbers."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    numbers = F.filter(y, lambda t: t.rlike("[0-9]"))
    share = lambda part: F.when(F.size(part) > 0, F.size(F.array_intersect(x, part)) / F.size(part)).otherwise(F.lit(0.0))
    return F.when(F.size(numbers) > 0, share(numbers)).otherwise(share(y))


def page_score(layout: Column, similarity: Column, f1: Column, numeric: Column) -> Column:
    """The composite score of a page: numbers weigh more in tables, mixed pages and forms."""
    return F.when(layout.isin("table", "mixed", "form"), similarity * 0.20 + f1 * 0.55 + numeric * 0.25).otherwise(similarity * 0.45 + f1 * 0.45 + numeric * 0.10)


def code_date(code: Column) -> Column:
    """The date at the end of a code, else the first of eight digits between dots; null if that is no date."""
    ymd = F.coalesce(F.nullif(F.regexp_extract(code, r"\.([0-9]{8})$", 1), F.lit("")), F.nullif(F.regexp_extract(code, r"\.([0-9]{8})\.", 1), F.lit("")))
    return F.try_to_date(ymd, "yyyyMMdd")


def without_brackets(x: Column) -> Column:
    """Text without what stands in square brackets."""
    return F.trim(F.regexp_replace(x, r"\[[^\]]*\]", " "))


def read_decision(unchanged: Column, native_chars: Column, sparse: Column, least: int = 400) -> Column:
    """skip_unchanged, native, sparse or ocr: the first that a page's state allows."""
    return F.when(unchanged, "skip_unchanged").when(native_chars >= least, "native").when(sparse, "sparse").otherwise("ocr")
