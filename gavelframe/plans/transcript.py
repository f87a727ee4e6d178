"""Queries of the transcript lane: phases, rosters, speakers, captions, gates. A customer's orders are a meeting's turns or cues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelframe.functions import text as X
from gavelframe.operators import folds
from gavelframe.plans import civic
from gavelframe.plans.catalog import Tables, query

PHASES = "[" + ", ".join(f"'{p}'" for p in folds.PHASES) + "]"
MAIN = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{'|'.join(ps)}') THEN {folds.RANK[n]} END" for n, ps in folds.MAIN_TRIGGERS.items()) + "], lambda x: x IS NOT NULL)"
SUB = "CASE " + " ".join("WHEN regexp_matches(lower(text), '" + "|".join(p.replace("'", "''") for p in ps) + f"') THEN '{n}'" for n, ps in folds.SUB_TRIGGERS.items()) + " END"


def phase_rows(rows: str) -> str:
    return f"SELECT *, {MAIN} AS steps, {SUB} AS sub, len(regexp_extract_all(text, '\\S+')) AS n_words FROM ({rows})"


PHASE_STATE = {"main": "0", "phase": "''"}
PHASE_LAYERS = [
    {"step": "list_min(list_filter(steps, lambda x: x > main))"},
    {"main2": "CASE WHEN step IS NOT NULL THEN step WHEN main = 0 AND n_words > 10 THEN 1 ELSE main END", "stays": "step IS NULL AND NOT (main = 0 AND n_words > 10)"},
    {"phase2": f"CASE WHEN stays AND sub IS NOT NULL THEN sub ELSE {PHASES}[main2 + 1] END"},
]
PHASE_STEP = {"main": "main2", "phase": "phase2"}
NO_NAMES = "[" + ", ".join(f"'{w}'" for w in folds.NO_NAMES) + "]"
CALLED = "\\b([A-Z][a-z]+)\\b\\.?\\s+(?:Yes|No|Aye|Abstain)\\b"
ROSTER_LAYERS = [
    {"called": f"CASE WHEN phase2 = 'ROLL_CALL' THEN list_filter(regexp_extract_all(text, '{CALLED}', 1), lambda x: length(x) >= 3 AND NOT list_contains({NO_NAMES}, lower(x)) AND NOT list_contains(members, x)) ELSE CAST([] AS VARCHAR[]) END", "moved": "nullif(regexp_extract(text, '([A-Z][a-z]+)\\s+makes the motion', 1), '')", "said": "nullif(regexp_extract(text, 'my name is ([A-Z][a-z]+(?:\\s+[A-Z][a-z]+)?)', 1), '')"},
    {"members1": "list_concat(members, called)"},
    {"others2": "CASE WHEN said IS NOT NULL AND NOT list_contains(members1, said) AND NOT list_contains(others, said) THEN list_append(others, said) ELSE others END", "members2": "CASE WHEN moved IS NOT NULL AND NOT list_contains(members1, moved) THEN list_append(members1, moved) ELSE members1 END"},
]
_CHAIR = "regexp_matches(lower(text), '" + "|".join(folds.CHAIR_SIGNS) + "')"
_VOTE = "regexp_matches(lower(trim(text)), '^(yes|no|aye|abstain)\\.?$')"


def _speaker(i: int) -> str:
    """role, name or confidence of a turn."""
    pick = lambda role, name, c: (f"'{role}'", name if name.startswith("m") else f"'{name}'", f"{c}::DOUBLE")[i]
    default = " ".join(f"WHEN phase2 = '{p}' THEN {pick(*v)}" for p, v in folds.PHASE_SPEAKER.items())
    return f"""CASE WHEN phase2 = 'CALL_TO_ORDER' THEN {pick('CHAIR', 'CHAIR_INCUMBENT', 0.95)} WHEN {_CHAIR} THEN {pick('CHAIR', 'CHAIR_INCUMBENT', 0.85)} WHEN regexp_matches(lower(text), 'thank you\\s+[a-z]+') THEN {pick('CHAIR', 'CHAIR_INCUMBENT', 0.8)}
 WHEN phase2 = 'ROLL_CALL' AND named IS NOT NULL THEN {("'MEMBER'", 'named', '0.9::DOUBLE')[i]} WHEN phase2 = 'ROLL_CALL' AND {_VOTE} THEN {pick('MEMBER', 'VOTER_UNKNOWN', 0.8)} WHEN phase2 = 'ROLL_CALL' THEN {pick('CLERK', 'CLERK_INCUMBENT', 0.7)}
 WHEN phase2 = 'MOTION_SEQUENCE' AND regexp_matches(lower(text), '\\b(second|so moved|motion|amend)\\b') THEN {pick('MEMBER', 'MEMBER_PROCEDURAL', 0.7)} WHEN phase2 = 'MOTION_SEQUENCE' THEN {pick('CHAIR', 'CHAIR_INCUMBENT', 0.65)} {default} ELSE {pick('UNKNOWN', 'UNKNOWN', 0.1)} END"""


SPEAKER_LAYERS = [*PHASE_LAYERS, *ROSTER_LAYERS, {"named": "CASE WHEN n_words < 5 THEN list_filter(members2, lambda x: contains(text, x))[1] END"}, {"role2": _speaker(0), "name2": _speaker(1), "confidence2": _speaker(2)}]
SPEAKER_STATE = {**PHASE_STATE, "members": "CAST([] AS VARCHAR[])", "others": "CAST([] AS VARCHAR[])", "role": "''", "name": "''", "confidence": "0.0::DOUBLE"}
SPEAKER_STEP = {**PHASE_STEP, "members": "members2", "others": "others2", "role": "role2", "name": "name2", "confidence": "confidence2"}
SPEAKERS = civic.fold_sql(phase_rows(civic.TURNS), SPEAKER_STATE, SPEAKER_LAYERS, SPEAKER_STEP, "r.doc, r.i, r.text, s.phase, s.role, s.name, s.confidence, s.members, s.others")
SPEAKER_SCHEMA = "doc long, i long, text string, phase string, role string, name string, confidence double, members array<string>, others array<string>"


def spoken(t: Tables) -> DataFrame:
    return folds.ordered_fold(civic.turns(t), ["doc"], ["i"], folds.speakers, SPEAKER_SCHEMA)


@query(civic.fold_sql(phase_rows(civic.TURNS), PHASE_STATE, PHASE_LAYERS, PHASE_STEP, "r.doc, r.i, s.phase") + " UNION ALL " + civic.fold_sql(phase_rows("SELECT conv_id AS doc, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, text FROM conversations"), PHASE_STATE, PHASE_LAYERS, PHASE_STEP, "-1 - r.doc, r.i, s.phase").replace("WITH RECURSIVE r AS", "SELECT * FROM (WITH RECURSIVE r AS", 1) + ")")
def win01_conversation_phases(t: Tables) -> DataFrame:
    """Phases of the civic turns and of all conversations."""
    civil = folds.ordered_fold(civic.turns(t), ["doc"], ["i"], folds.phases, "doc long, i long, text string, phase string").drop("text")
    talks = t.conversations.select("conv_id", "turn", "text")
    numbered = folds.ordered_fold(talks, ["conv_id"], ["turn"], lambda rows: folds.phases([{**r, "i": n} for n, r in enumerate(rows, 1)]), "conv_id long, i long, phase string")
    return civil.union(numbered.select((-1 - F.col("conv_id")).alias("doc"), "i", "phase"))


@query(f"SELECT doc, i, array_to_string(members, ',') AS members, array_to_string(others, ',') AS others FROM ({SPEAKERS})")
def win02_roster(t: Tables) -> DataFrame:
    """Who is known after each turn, in the order in which they became known."""
    return spoken(t).select("doc", "i", F.array_join("members", ",").alias("members"), F.array_join("others", ",").alias("others"))


@query(f"SELECT doc, i, phase, role, name, confidence FROM ({SPEAKERS})")
def win03_speakers(t: Tables) -> DataFrame:
    return spoken(t).select("doc", "i", "phase", "role", "name", "confidence")


def _quoted(i: int) -> str:
    """role, name, confidence or reason of a turn after its neighbours were asked."""
    pick = lambda role, name, c, why: (f"'{role}'", name if name[0] == "@" else f"'{name}'", f"{c}::DOUBLE", f"'{why}'")[i].replace("@", "")
    default = " ".join(f"WHEN phase = '{p}' THEN {pick(*v[:2], 0.7, 'phase_default')}" for p, v in {**folds.PHASE_SPEAKER, "MOTION_SEQUENCE": ("MEMBER", "MEMBER_PROCEDURAL", 0.7)}.items())
    return f"""CASE WHEN confidence >= 0.7 AND role <> 'UNKNOWN' THEN {('role', 'name', 'confidence', 'NULL')[i]}
 WHEN next_role IN ('CHAIR', 'MAYOR') AND regexp_matches(next_text, '(?i)thank you\\s+([a-z]+)') THEN {pick('MEMBER/CITIZEN', '@thanked', 0.85, 'chair_acknowledgment')}
 WHEN last_role IN ('CHAIR', 'MAYOR') AND regexp_matches(last_text, '([A-Z][a-z]+)\\?') THEN {pick('MEMBER/STAFF', '@called', 0.75, 'chair_call_on')}
 WHEN last_role IN ('CHAIR', 'MAYOR') AND contains(lower(text), 'second') THEN {pick('MEMBER', 'SECONDER_UNKNOWN', 0.6, 'procedural_second')}
 WHEN regexp_matches(lower(text), '^\\s*(i''ll\\s+)?seconds?\\b') THEN {pick('MEMBER', 'SECONDER_UNKNOWN', 0.85, 'procedural_keyword')} WHEN contains(lower(text), 'so moved') OR contains(lower(text), 'make a motion') THEN {pick('MEMBER', 'MOVER_UNKNOWN', 0.85, 'procedural_keyword')}
 WHEN phase = 'PUBLIC_COMMENTS' AND n_words > 20 THEN {pick('CITIZEN', 'UNKNOWN_CITIZEN', 0.7, 'phase_length_heuristic')} WHEN phase = 'ROLL_CALL' AND {_VOTE} THEN {pick('MEMBER', 'VOTER_UNKNOWN', 0.75, 'roll_call_vote')}
 WHEN phase = 'ROLL_CALL' AND n_words <= 3 AND NOT regexp_matches(lower(text), 'yes|no|aye|abstain') THEN {pick('CLERK', 'CLERK_INCUMBENT', 0.65, 'roll_call_call')} {default} ELSE {('role', 'name', 'confidence', 'NULL')[i]} END"""


@query(civic.fold_sql(f"SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text, regexp_extract(lead(text) OVER w, '(?i)thank you\\s+([a-z]+)', 1) AS thanked, len(regexp_extract_all(text, '\\S+')) AS n_words FROM ({SPEAKERS}) WINDOW w AS (PARTITION BY doc ORDER BY i)",
    {"last_role": "CAST(NULL AS VARCHAR)", "last_text": "CAST(NULL AS VARCHAR)", "name3": "''", "confidence3": "0.0::DOUBLE", "reason3": "CAST(NULL AS VARCHAR)"},
    [{"called": "regexp_extract(last_text, '([A-Z][a-z]+)\\?', 1)"}, {"role4": _quoted(0), "name4": _quoted(1), "confidence4": _quoted(2), "reason4": _quoted(3)}],
    {"last_role": "role4", "last_text": "text", "name3": "name4", "confidence3": "confidence4", "reason3": "reason4"}, "r.doc, r.i, s.last_role AS role, s.name3 AS name, s.confidence3 AS confidence, s.reason3 AS reason"))
def win04_quoted(t: Tables) -> DataFrame:
    """Speakers resolved from their neighbours."""
    return folds.ordered_fold(spoken(t).drop("members", "others"), ["doc"], ["i"], folds.quoted, "doc long, i long, role string, name string, confidence double, reason string")


# rolling captions: each cue repeats the last two words of the one before; every seventh cue is contained in what was said
WORD = "'w' || o_orderkey"
CUES = f"SELECT doc, i, k % 50 + i * 2.0 + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS ts, word, coalesce(lag(word, 2) OVER w || ' ', '') || coalesce(lag(word) OVER w || ' ', '') || word AS text FROM (SELECT o_custkey AS doc, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, {WORD} AS word FROM orders) WINDOW w AS (PARTITION BY doc ORDER BY i)"


def _per_document(df: DataFrame, f, schema: str) -> DataFrame:
    return folds.ordered_fold(df, ["doc"], ["i"], f, schema)


@query(f"SELECT doc, 1 AS part, string_agg(word, ' ' ORDER BY i) AS text FROM ({CUES}) GROUP BY doc")
def win05_squeeze(t: Tables) -> DataFrame:
    """Cues that each repeat two words of the ones before say every word once."""
    cues = civic.orders_as(t, CUES)
    return _per_document(cues, lambda rows: [{"doc": rows[0]["doc"], "part": n, "text": x} for n, x in enumerate(folds.squeeze([r["text"] for r in rows]), 1)], "doc long, part int, text string")


CHUNKS = "SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, 1 + o_orderkey % 24 AS size, o_orderkey % 3 = 0 AS ends FROM orders"


@query("SELECT doc, part, CAST(sum(size) AS BIGINT) AS words FROM (" + civic.fold_sql(CHUNKS, {"held": "CAST(0 AS BIGINT)", "part": "CAST(0 AS BIGINT)", "mine": "CAST(0 AS BIGINT)"},
    [{"alone": "held = 0", "over": "held > 0 AND held + size > 60"}, {"now": "CASE WHEN over THEN size ELSE held + size END", "mine2": "part + CASE WHEN over THEN 1 ELSE 0 END"}, {"flush": "now >= 16 AND (alone OR ends)"}],
    {"held": "CASE WHEN flush THEN 0 ELSE now END", "part": "mine2 + CASE WHEN flush THEN 1 ELSE 0 END", "mine": "mine2"}, "r.doc, s.mine AS part, r.size") + ") GROUP BY doc, part")
def win06_pack(t: Tables) -> DataFrame:
    """Chunks joined up to 60 words, ended by 16 words and an end of a sentence."""
    chunk = F.concat(F.repeat(F.lit("w "), (F.col("size") - 1).cast("int")), F.when(F.col("ends"), "w.").otherwise("w"))
    rows = civic.orders_as(t, CHUNKS).withColumn("text", chunk)
    return _per_document(rows, lambda rs: [{"doc": rs[0]["doc"], "part": n, "words": len(x.split())} for n, x in enumerate(folds.pack([r["text"] for r in rs]))], "doc long, part long, words long")


@query(civic.fold_sql("SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, 'line ' || (o_orderkey % 8) AS text FROM orders", {"kept": "CAST([] AS VARCHAR[])", "takes": "FALSE"},
    [{"takes2": "NOT list_contains(kept[-5:], text)"}], {"kept": "CASE WHEN takes2 THEN list_append(kept, text) ELSE kept END", "takes": "takes2"}, "r.doc, CAST(len(s.kept) AS BIGINT) AS n, r.text", "s.takes"))
def win07_distinct_recent(t: Tables) -> DataFrame:
    """Lines that are not among the last five kept ones."""
    rows = t.orders.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("i"), F.concat(F.lit("line "), F.col("o_orderkey") % 8).alias("text"))
    return _per_document(rows, lambda rs: [{"doc": rs[0]["doc"], "n": n, "text": x} for n, x in enumerate(folds.distinct_recent([r["text"] for r in rs]), 1)], "doc long, n long, text string")


@query(f"SELECT doc, i, CASE WHEN coalesce(lead(ts) OVER w - ts > 1.5, false) AND NOT regexp_matches(text, '[.!?]$') THEN text || '.' ELSE text END AS text FROM ({CUES}) WINDOW w AS (PARTITION BY doc ORDER BY i)")
def win08_gap_stops(t: Tables) -> DataFrame:
    """A full stop behind cues that a silence follows."""
    from gavelframe.sources import captions

    cues = civic.orders_as(t, CUES).select(F.col("doc").alias("code"), F.col("i").alias("cue_idx"), F.col("ts").cast("double").alias("ts"), "text")
    return captions.sentence_parts(cues).select(F.col("code").alias("doc"), F.col("cue_idx").alias("i"), "text")


@query(civic.fold_sql("SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 9 END AS own FROM orders", {"seen": "CAST([] AS BIGINT[])", "turn_id": "CAST(0 AS BIGINT)"},
    [{"id": "CASE WHEN own IS NULL OR list_contains(seen, own) THEN n ELSE own END"}], {"seen": "list_append(seen, id)", "turn_id": "id"}, "r.doc, r.i AS ordinal, s.turn_id"))
def win19_repair_ids(t: Tables) -> DataFrame:
    """Missing and repeated ids give way to ordinals; an id that is taken by a repaired one counts as repeated."""
    rows = t.orders.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("i"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey") % 9).alias("turn_id"))
    return _per_document(rows, folds.repair_ids, "doc long, ordinal long, turn_id long")


@query(civic.fold_sql("SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_partkey, l_suppkey) AS i, l_quantity AS v FROM lineitem", {"total": "0.0::DOUBLE", "members": "CAST(0 AS BIGINT)", "part": "CAST(0 AS BIGINT)"},
    [{"joins": "members > 0 AND abs(v - total / greatest(members, 1)) <= 6"}], {"total": "CASE WHEN joins THEN total + v ELSE v END", "members": "CASE WHEN joins THEN members + 1 ELSE 1 END", "part": "CASE WHEN joins THEN part ELSE part + 1 END"}, "r.doc, r.i, s.part, r.v"))
def win21_running_means(t: Tables) -> DataFrame:
    """Sorted values that stay near the running mean of their group."""

    def groups(rows: list[dict]):
        n = 0
        for part, values in enumerate(folds.running_mean_groups([r["v"] for r in rows], 6.0), 1):
            for v in values:
                n += 1
                yield {"doc": rows[0]["doc"], "i": n, "part": part, "v": v}

    rows = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_quantity").alias("v"))
    return folds.ordered_fold(rows, ["doc"], ["v"], groups, "doc long, i long, part long, v double")


@query("SELECT o_orderkey, 'Okay we met Mr lee. Thank you for order ' || o_orderkey || ' carries. The. Council is amended. I agree Smith yes. Jones no. Next item' AS text FROM orders")
def str07_sentences(t: Tables) -> DataFrame:
    """Captions without punctuation as sentences."""
    from pyspark.sql import types as T

    @F.pandas_udf(T.StringType())
    def rebuilt(x):
        return x.map(folds.sentences)

    said = F.concat(F.lit("okay we met mr lee thank you for order "), F.col("o_orderkey").cast("string"), F.lit(" carries the council is amended i agree Smith yes Jones no next item"))
    return t.orders.select("o_orderkey", rebuilt(F.replace(said, F.lit("the council"), F.lit("the COUNCIL"))).alias("text"))


@query(f"SELECT doc, string_agg(word, ' ' ORDER BY i) AS text FROM (SELECT doc, i, CASE WHEN coalesce(lead(ts) OVER w - ts > 1.5, false) THEN word || '.' ELSE word END AS word FROM ({CUES}) WINDOW w AS (PARTITION BY doc ORDER BY i)) GROUP BY doc")
def str26_baseline(t: Tables) -> DataFrame:
    """What rolling captions with speaker marks say once."""
    rows = civic.orders_as(t, CUES).withColumn("text", F.when(F.col("i") == 1, F.concat(F.lit("&gt;&gt; "), "text")).otherwise(F.col("text"))).withColumn("ts", F.col("ts").cast("double"))
    return _per_document(rows.select("doc", "i", "ts", "text"), lambda rs: [{"doc": rs[0]["doc"], "text": folds.baseline(rs)}], "doc long, text string")


METRICS = f"SELECT doc, count(*) AS turns, count(*) FILTER (role = 'UNKNOWN' OR name = 'UNKNOWN') AS unknown, sum(len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'))) AS out_words FROM ({SPEAKERS}) GROUP BY doc"


@query(f"SELECT doc, turns, round(unknown / turns, 3) AS unknown_ratio, CASE WHEN src > 0 THEN round(out_words / src, 3) END AS coverage FROM (SELECT *, CASE WHEN doc % 11 = 0 THEN 0 ELSE out_words + doc % 7 END AS src FROM ({METRICS}))")
def agg09_transcript_metrics(t: Tables) -> DataFrame:
    """Share of unknown speakers and of the source's words that the turns keep."""
    return transcript_metrics(t).select("doc", "turns", "unknown_ratio", "coverage")


def transcript_metrics(t: Tables) -> DataFrame:
    """The turns, and a source of a few words more; one document in eleven has none."""
    turns_ = spoken(t).select("doc", "role", "name", "text")
    words = X.words(F.col("text"))
    source = turns_.groupBy("doc").agg(F.sum(F.size(words)).alias("w")).select("doc", F.when(F.col("doc") % 11 == 0, 0).otherwise(F.col("w") + F.col("doc") % 7).alias("source_words"))
    return X.turn_metrics(turns_.join(source, "doc"))


@query(f"SELECT doc, array_to_string(list_filter([CASE WHEN src = 0 THEN 'empty_or_unparseable_source_vtt' END, CASE WHEN turns < 5 THEN 'insufficient_turns' END, CASE WHEN round(unknown / turns, 3) > 0.98 THEN 'unknown_saturation' END, CASE WHEN src > 0 AND out_words / src < 0.95 THEN 'low_squeezed_coverage' END], lambda x: x IS NOT NULL), ',') AS issues FROM (SELECT *, CASE WHEN doc % 11 = 0 THEN 0 ELSE out_words + doc % 7 END AS src FROM ({METRICS}))")
def gat02_transcript_gate(t: Tables) -> DataFrame:
    return transcript_metrics(t).select("doc", F.array_join(X.transcript_issues(), ",").alias("issues"))


@query("SELECT u AS user_id, coalesce(CASE WHEN u % 4 = 0 THEN 'OK95' END, CASE WHEN u % 4 = 1 THEN 'LOWSIG' END, log, 'SKIP') AS code FROM (SELECT user_id AS u, max_by(upper(event_type), event_id) FILTER (event_type <> 'view') AS log FROM events GROUP BY user_id)")
def win24_disposition(t: Tables) -> DataFrame:
    """The first that is no SKIP of the gate's code, the state's and the latest in the log."""
    u = F.col("user_id") % 4
    latest = F.max_by(F.upper("event_type"), F.when(F.col("event_type") != "view", F.col("event_id")))
    log = t.events.groupBy("user_id").agg(latest.alias("log"))
    return log.select("user_id", X.first_disposition(F.when(u == 0, "OK95").when(u == 2, "SKIP"), F.when(u == 1, "lowsig"), F.col("log")).alias("code"))


@query("SELECT o_orderkey, 'CURRENCY:$' || (1 + o_orderkey % 900) || ',500.25|PERCENT:' || (o_custkey % 100) || '%|NUMBER:10,004|NUMBER:-' || (o_custkey % 9) AS figures FROM orders")
def joi09_figures(t: Tables) -> DataFrame:
    """Amounts, shares and numbers of a text, none overlapping one of an earlier kind."""
    from pyspark.sql import types as T

    @F.pandas_udf(T.StringType())
    def found(x):
        return x.map(lambda s: "|".join(f"{k}:{raw}" for k, raw, *_ in folds.figures(s)))

    said = F.concat(F.lit("paid $"), (1 + F.col("o_orderkey") % 900).cast("string"), F.lit(",500.25, "), (F.col("o_custkey") % 100).cast("string"), F.lit("% of 10,004 in A7 and 2b; -"), (F.col("o_custkey") % 9).cast("string"), F.lit(" left"))
    return t.orders.select("o_orderkey", found(said).alias("figures"))


VTT = "WEBVTT\nKind: captions\nLanguage: en\n\n"


@query(f"SELECT doc, CAST(i - 1 AS BIGINT) AS cue_idx, CAST((i - 1) // 2 * 61 + 0.25 AS DOUBLE) AS ts, 'cue & ' || i AS text FROM ({CUES})")
def src01_vtt_cues(t: Tables) -> DataFrame:
    """Caption files written from the orders, two lines a cue, with tags and entities, read back."""
    from gavelframe.sources import captions

    at = F.floor((F.col("i") - 1) / 2).cast("int") * 61
    clock = F.format_string("%02d:%02d:%02d.250 --> 23:59:59.000", (at / 3600).cast("int"), (at / 60 % 60).cast("int"), at % 60)
    line = F.concat(F.when(F.col("i") % 2 == 1, F.concat(F.lit("\n"), clock, F.lit("\n"))).otherwise(""), F.lit("<c>cue</c> &amp; "), F.col("i").cast("string"))
    files = civic.orders_as(t, CUES).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("i", line.alias("line")))).alias("ls"))
    content = F.concat(F.lit(VTT), F.array_join(F.transform("ls", lambda x: x["line"]), "\n"))
    return captions.cues(files.select(F.col("doc").alias("code"), content.alias("content"))).select(F.col("code").alias("doc"), F.col("cue_idx").cast("long").alias("cue_idx"), "ts", "text")


@query("SELECT o_custkey AS code, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS n, 'line ' || o_orderkey AS line FROM orders")
def src02_strip_headers(t: Tables) -> DataFrame:
    """Payload lines without headers, times, blanks and tags."""
    from gavelframe.sources import captions

    line = F.concat(F.lit("00:01.000 --> 00:02.000\n<00:00:01.500><c>line "), F.col("o_orderkey").cast("string"), F.lit("</c>\n  "))
    files = t.orders.groupBy(F.col("o_custkey").alias("code")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))).alias("ls"))
    content = F.concat(F.lit(VTT), F.array_join(F.transform("ls", lambda x: x["line"]), "\n"))
    return captions.payload(files.select("code", content.alias("content"))).select("code", "n", "line")


@query("SELECT o_orderkey AS code, o_orderkey % 3 = 0 AS has_payload FROM orders")
def src03_valid_sources(t: Tables) -> DataFrame:
    from gavelframe.sources import captions

    k = F.col("o_orderkey") % 3
    content = F.when(k == 0, f"{VTT}00:01.000 --> 00:02.000\nhello").when(k == 1, f"{VTT}00:01.000 --> 00:02.000\n\n").otherwise("WEBVTT\n\nonly text")
    return captions.valid(t.orders.select(F.col("o_orderkey").alias("code"), content.alias("content")))


@query("SELECT o_orderkey, 'a & b <ok>' AS text FROM orders")
def str11_strip_tags(t: Tables) -> DataFrame:
    from gavelframe.sources import captions

    raw = F.concat(F.lit("<00:00:0"), (F.col("o_orderkey") % 10).cast("string"), F.lit(".000><c> a &amp; b</c> &lt;ok&gt; "))
    return t.orders.select("o_orderkey", captions.plain(raw).alias("text"))


@query("SELECT part_type AS idx, array_to_string(list_sort(list(DISTINCT b)), ',') AS brands FROM (SELECT p_size AS part_type, p_brand AS b FROM part) GROUP BY 1")
def agg10_categories(t: Tables) -> DataFrame:
    """Members of each category."""
    return t.part.groupBy(F.col("p_size").alias("idx")).agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("brands"))
