"""Entities: candidates by generators, reasons against them, one of each kept, and their numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.functions import text as X


def known_names(lines: DataFrame, names: tuple[str, ...], most: int = 25) -> DataFrame:
    """(doc, line_no, name, n): the known names that a line holds between word edges, in upper case, each counted up to `most` times a line.

    One expression of all names, the longest first, so that a line is read once however many names there are.
    """
    every = "|".join(re.escape(n.upper()) for n in sorted(names, key=lambda n: (-len(n), n)))
    found = F.regexp_extract_all(F.upper("line"), F.lit(rf"\b(?:{every})\b"), F.lit(0))
    rows = lines.select("doc", "line_no", F.explode(found).alias("name"))
    return rows.groupBy("doc", "line_no", "name").agg(F.least(F.count("*"), F.lit(most)).alias("n"))


def scanned(lines: DataFrame, patterns: tuple[tuple[str, str, float], ...]) -> DataFrame:
    """(doc, line_no, category, name, confidence) of all matches of the patterns (category, expression, confidence)."""

    def hits(category: str, pattern: str, confidence: float) -> Column:
        return F.transform(F.regexp_extract_all("line", F.lit(pattern), F.lit(0)), lambda m: F.struct(F.lit(category).alias("category"), m.alias("name"), F.lit(float(confidence)).alias("confidence")))

    return lines.select("doc", "line_no", F.inline(F.concat(*[hits(*p) for p in patterns])))


def best_per_name(candidates: DataFrame, order: list[Column]) -> DataFrame:
    """One candidate of each document, category and name in any case: the first in the order."""
    w = Window.partitionBy("doc", F.upper("category"), F.lower("name")).orderBy(*order)
    return candidates.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def numbered(entities: DataFrame) -> DataFrame:
    """The entities with entity_id GE001... by category and name within a document."""
    w = Window.partitionBy("doc").orderBy("category", F.lower("name"), "name")
    return entities.withColumn("entity_id", F.format_string("GE%03d", F.row_number().over(w)))


def street_addresses(x: Column, suffixes: tuple[str, ...] = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Drive", "Dr", "Lane", "Ln")) -> Column:
    """Distinct addresses of a text in upper case, in their order: a number, one to seven capitalised words and a suffix."""
    p = rf"\b[0-9]{{1,5}}\s+[A-Z][A-Za-z'\-]+(?:\s+[A-Z][A-Za-z'\-]+){{0,6}}\s+(?:{'|'.join(suffixes)})\b"
    return F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(p), F.lit(0)), lambda m: F.upper(X.normalize_ws(m))))


def organisation_kind(name: Column) -> Column:
    low = F.lower(X.normalize_ws(name))
    return F.when(low.rlike(r"\b(department|agency|authority|administration|district|division|office)\b"), "AGENCY").when(low.rlike(r"\b(board|commission|committee|council)\b"), "BOARD").otherwise("ORGANIZATION")


#: Names that stand for no one.
PLACEHOLDERS = ("UNKNOWN", "CHAIR_INCUMBENT", "CLERK_INCUMBENT", "SECONDER_UNKNOWN", "MOVER_UNKNOWN", "VOTER_UNKNOWN", "UNKNOWN_CITIZEN", "SPEAKER_UNKNOWN", "PUBLIC_COMMENTER", "PLEDGE_GROUP", "INVOCATION_SPEAKER", "MEMBER_PROCEDURAL")


def name_reasons(name: Column, category: Column, stop: tuple[str, ...], in_source: Column) -> Column:
    """Why a candidate is rejected, by category; empty if it is taken."""
    words = F.filter(F.split(X.normalize_ws(name), " "), lambda w: w != "")
    person = category.isin("PEOPLE", "PERSON")
    tests = [
        ("empty_name", F.coalesce(F.trim(name), F.lit("")) == ""),
        ("too_short", F.length(name) < 3),
        ("too_long", F.length(name) > 80),
        ("placeholder", F.upper(name).isin(*PLACEHOLDERS)),
        ("stop_word", F.lower(name).isin(*stop)),
        ("has_digit", person & name.rlike("[0-9]")),
        ("odd_characters", person & ~name.rlike(r"^[A-Za-z][A-Za-z'. \-]*$")),
        ("single_token", person & (F.size(words) < 2)),
        ("too_many_tokens", person & (F.size(words) > 4)),
        ("not_capitalised", person & F.exists(words, lambda w: ~w.rlike("^[A-Z]"))),
        ("generic_organisation", category.isin("ORGANIZATION", "BOARD", "AGENCY") & F.lower(name).isin("council", "board", "committee", "commission", "department", "office")),
        ("not_in_source", ~in_source),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(True)), F.lit(n)) for n, t in tests]))


def one_of_each(entities: DataFrame) -> DataFrame:
    """Of each document, category, fact and person (by first and last name) or other name one entity: for people the longest name, else the first."""
    people = F.col("category") == "PEOPLE"
    key = F.when(people, X.person_key(F.col("name"))).otherwise(F.upper("name"))
    w = Window.partitionBy("doc", "category", key, "fact_key").orderBy(F.desc(F.when(people, F.length("name")).otherwise(F.lit(0))), "pos")
    return entities.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
