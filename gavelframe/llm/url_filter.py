"""URL filter: host and path rules, then a weighted vocabulary found with Aho-Corasick.

Each distinct term that occurs counts its weight once, and an address is rejected from a sum of REJECT on: one strict term (of that
weight) or several soft ones. A term counts only between boundaries: no letter or digit may stand directly before or after it. The
vocabulary is a table of terms and weights, by default TERMS; read_vocabulary() takes one from a file.

Null urls and urls without `://` have an empty host and path and are allowed by the rules. Empty tables give empty results. Extra
columns pass through untouched, those with the names put out are replaced; repeated rows are judged alike. Urls of any length are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECT, SOFT_WEIGHT = 2.0, 1.0
STRICT = ("porn", "porno", "pornos", "pornography", "xxx", "hentai", "camgirl", "camgirls", "sexcam", "sexcams", "livesex", "sexchat", "sextube", "escort", "escorts", "callgirl", "callgirls", "milf", "milfs", "blowjob", "gangbang", "bdsm", "upskirt", "malware", "ransomware", "spyware", "trojan", "botnet", "warez", "crackz", "nulled", "keylogger", "phishing", "carding", "spam", "spammer", "viagra", "cialis")
SOFT = ("adult", "affiliate", "bet", "bets", "betting", "bingo", "blackjack", "bonus", "casino", "casinos", "cheap", "click", "clicks", "coupon", "coupons", "crack", "cracked", "cracks", "date", "dates", "dating", "diet", "discount", "erotic", "erotica", "fetish", "free", "freebies", "gamble", "gambling", "giveaway", "hookup", "hot", "jackpot", "keygen", "lingerie", "loan", "loans", "lottery", "lotto", "mortgage", "naked", "nude", "nudes", "payday", "pharmacy", "pill", "pills", "poker", "prize", "prizes", "promo", "replica", "replicas", "roulette", "serial", "serials", "sex", "sexy", "singles", "slot", "slots", "steroids", "torrent", "torrents", "unlocker", "webcam", "win", "winner", "winners")
#: the default vocabulary: term -> weight
TERMS: dict[str, float] = {t: REJECT for t in STRICT} | {t: SOFT_WEIGHT for t in SOFT}


def read_vocabulary(path: str) -> dict[str, float]:
    """{term: weight} of a file of `term,weight` lines; terms are lower-cased, empty lines and those with # are left out."""
    with open(path, encoding="utf-8") as f:
        rows = [line.strip().rsplit(",", 1) for line in f if line.strip() and not line.startswith("#")]
    return {term.strip().lower(): float(weight) for term, weight in rows}


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


RULES = (Rule("com", "/en/", "block"), Rule("example.com", "/en/7", "allow"), Rule("net", "/de/", "allow"), Rule("example.net", "/de/8", "block"), Rule("org", "/es/", "block"))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    at = F.locate("://", url)
    rest = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path_of(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits the host or one it is a subdomain of; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.host, r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.host + r.path).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def automaton(terms: list[str]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for t in terms:
        a.add_word(t, t)
    a.make_automaton()
    return a


def hits(machine, url: str) -> set[str]:
    """Distinct terms that stand between boundaries."""
    s = url.lower()
    found = set()
    for end, term in machine.iter(s):
        start = end - len(term) + 1
        if not (start and s[start - 1].isalnum()) and not (end + 1 < len(s) and s[end + 1].isalnum()):
            found.add(term)
    return found


def vocabulary_hits(terms: dict[str, float], reject: float):
    """n_strict: distinct terms that reject alone; n_soft: the others; weight: the sum of all."""

    @F.pandas_udf(T.StructType([T.StructField("n_strict", T.IntegerType()), T.StructField("n_soft", T.IntegerType()), T.StructField("weight", T.DoubleType())]))
    def count(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = automaton(sorted(terms))
        for s in urls:
            found = [[terms[t] for t in sorted(hits(machine, u))] if u else [] for u in s]
            strict = [sum(w >= reject for w in ws) for ws in found]
            yield pd.DataFrame({"n_strict": strict, "n_soft": [len(ws) - n for ws, n in zip(found, strict)], "weight": [float(sum(ws)) for ws in found]})

    return count


def url_filter(pages: DataFrame, url: str = "url", terms: dict[str, float] = TERMS, reject: float = REJECT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with host, path, rule, n_strict, n_soft, weight and verdict (allow or block). Columns of those names are replaced."""
    new = ("host", "path", "rule", "n_strict", "n_soft", "weight", "verdict")
    kept = [c for c in pages.columns if c not in new]
    of = F.col(url)
    # the input's columns go in one, so that none of their names meets one of ours
    found = pages.select(F.struct(*kept, F.lit(0).alias("")).alias("row"), host_of(of).alias("host"), path_of(of).alias("path"), vocabulary_hits(terms, reject)(of).alias("hits"))
    rule, by_rule = rule_columns(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("hits.weight") >= reject, "block").otherwise("allow")
    return found.select(*[F.col("row")[c].alias(c) for c in kept], "host", "path", rule.alias("rule"), "hits.n_strict", "hits.n_soft", "hits.weight", F.coalesce(by_rule, method).alias("verdict"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter(pages).select("page_id", "host", "path", "rule", "n_strict", "n_soft", "verdict")


def _sql() -> str:
    def count(terms) -> str:
        return " + ".join(f"CAST(regexp_matches(lower(coalesce(url, '')), '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])') AS INTEGER)" for t in terms)

    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    order = sorted(RULES, key=lambda r: (-len(r.host) - len(r.path), r.host, r.path))
    return f"""
WITH a AS (SELECT page_id, url, strpos(coalesce(url, ''), '://') AS pos FROM pages),
b AS (SELECT *, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM a),
c AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
d AS (SELECT *, CASE {' '.join(f"WHEN {fits(r)} THEN '{r.host}{r.path}'" for r in order)} END AS rule,
  CASE {' '.join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in order)} END AS by_rule,
  CAST({count(STRICT)} AS INTEGER) AS n_strict, CAST({count(SOFT)} AS INTEGER) AS n_soft FROM c)
SELECT page_id, host, path, rule, n_strict, n_soft,
  coalesce(by_rule, CASE WHEN n_strict >= 1 OR n_soft >= 2 THEN 'block' ELSE 'allow' END) AS verdict FROM d"""


QUERIES = {"op7_url_filter": op7_url_filter}
SQL = {"op7_url_filter": _sql()}
