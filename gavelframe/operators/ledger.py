"""State, sinks and gates of record pipelines as functions from DataFrames to DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gavelframe.functions import text as X
from gavelframe.operators import relational as R


def load_entities(registry: DataFrame, aliases: DataFrame, observations: DataFrame, entities: DataFrame, with_evidence: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(registry, aliases, observations) after a load of entities (category, name, source_id, fact_key, evidence): the registry is upserted
    by its id, aliases and observations come if they are not there yet. An observation is one by source and fact, with_evidence also by
    its evidence. A second run changes nothing."""
    e = entities.withColumn("registry_id", registry_id(F.col("category"), F.col("name")))
    reg = R.upsert(registry, e.select("registry_id", "category", F.col("name").alias("canonical_name")), ["registry_id"])
    al = R.insert_missing(aliases, e.select("registry_id", F.col("name").alias("alias_name"), "source_id"), ["registry_id", "alias_name"], [F.asc("source_id")])
    key = ["registry_id", "source_id", "fact_key"] + ["evidence"] * with_evidence
    obs = R.insert_missing(observations, e.select("registry_id", "source_id", "fact_key", "evidence"), key, None if with_evidence else [F.asc("evidence")])
    return reg, al, obs


def registry_id(category: Column, name: Column) -> Column:
    return X.registry_id(category, name)


def migrate(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """An upsert of the columns that the target has; all others of the source are left out, and no child goes."""
    return R.upsert(target, source.select(*[c for c in source.columns if c in target.columns]), keys)


def replace_source(target: DataFrame, rows: DataFrame, source: str = "source_id") -> DataFrame:
    """All rows of the sources that the new rows name go, the new ones come."""
    return R.replace_children(target, rows, rows, source)


def without_prefix(children: DataFrame, registry: DataFrame, column: str, prefix: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(children, registry) after the rows whose column begins with the prefix went, and the registry's rows that nothing refers to."""
    left = children.where(~F.coalesce(F.col(column).startswith(prefix), F.lit(False)))
    return left, registry.join(left.select(key).distinct(), key, "left_semi")


def wiped(*tables: DataFrame) -> list[DataFrame]:
    """The tables without rows, with their schemas."""
    return [t.limit(0) for t in tables]


def classified_push(records: DataFrame, state: DataFrame, allowed: tuple[str, ...] = ("OK95",), force: bool = False) -> DataFrame:
    """The records (code, sha256, disposition, error) with outcome: skipped_unchanged (pushed with this digest before, unless force),
    skipped_disposition, failed (an error) or pushed, in this order."""
    seen = state.where("last_status = 'pushed'").select(F.col("code").alias("__c"), F.col("sha256").alias("__s")).distinct().withColumn("__seen", F.lit(True))
    joined = records.join(seen, (F.col("code") == F.col("__c")) & (F.col("sha256") == F.col("__s")), "left")
    unchanged = F.col("__seen").isNotNull() & F.lit(not force)
    outcome = F.when(unchanged, "skipped_unchanged").when(~F.coalesce(F.upper("disposition").isin(*allowed), F.lit(False)), "skipped_disposition").when(F.col("error").isNotNull(), "failed").otherwise("pushed")
    return joined.select(*records.columns, outcome.alias("outcome"))


def pushed(target: DataFrame, children: DataFrame, records: DataFrame, rows: DataFrame, state: DataFrame, allowed: tuple[str, ...] = ("OK95",)) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(target, children, state, summary) after a push: only records classified as pushed write their parent and replace their children."""
    judged = classified_push(records, state, allowed)
    goes = judged.where("outcome = 'pushed'")
    parents = R.upsert(target, goes.select(*[c for c in target.columns if c in goes.columns]), ["code"])
    kids = R.replace_children(children, goes, rows.join(goes.select("code"), "code", "left_semi"), "code")
    now = judged.where("outcome IN ('pushed', 'failed')").select("code", "sha256", F.col("outcome").alias("last_status"))
    return parents, kids, R.upsert(state, now, ["code"]), judged.groupBy("outcome").agg(F.count("*").alias("n"))


def allowed_dispositions(raw: str | None) -> tuple[str, ...]:
    """The codes of a comma list in upper case, sorted; OK95 alone for an empty one."""
    return tuple(sorted({x.strip().upper() for x in (raw or "").split(",") if x.strip()})) or ("OK95",)


def incremental(stage: DataFrame, state: DataFrame, limit: int | None, force: bool = False) -> DataFrame:
    """What still has to be prepared: of each code the latest capture, then the limit, then without those whose two digests and
    outputs are in the state. The order of these steps matters: the limit counts skipped ones."""
    latest = R.latest_per_key(stage, ["code"], [F.desc("captured_at"), F.desc("path")])
    some = latest.orderBy("code").limit(limit) if limit else latest
    if force:
        return some
    done = state.where("outputs_exist").select("code", "text_sha", "facts_sha")
    return some.join(done, ["code", "text_sha", "facts_sha"], "left_anti").select(*stage.columns)


def latest_run(rows: DataFrame, run: str = "run_id") -> Column:
    """The greatest RUN_ id of the rows."""
    return F.max(F.when(F.col(run).startswith("RUN_"), F.col(run)))


def of_run(rows: DataFrame, explicit: str | None = None, every: bool = False, run: str = "run_id") -> DataFrame:
    """Rows of the named run, else of the latest RUN_*, or all of them; a run that is no partition filter is one aggregate and a join."""
    if every:
        return rows
    if explicit:
        return rows.where(F.col(run) == explicit)
    return rows.join(rows.agg(latest_run(rows, run).alias(run)), run, "left_semi").select(*rows.columns)


def rescue_wanted(errors: Column, unknown: Column, passed: Column, triggers: tuple[str, ...] = ("location", "zero_items"), all_unknowns: bool = True) -> Column:
    """Whether a failed packet is tried again: unknown metadata, or an error that a new attempt may mend."""
    by_error = ~passed & F.arrays_overlap(errors, F.array(*map(F.lit, triggers)))
    return ((F.size(unknown) > 0) | by_error) if all_unknowns else by_error


def versions(history: DataFrame, key: str, version: str = "version") -> DataFrame:
    """The latest version of each key in an append-only history."""
    return history.groupBy(key).agg(F.max_by(F.struct(*[c for c in history.columns if c != key]), version).alias("x")).select(key, "x.*")


def append_version(history: DataFrame, rows: DataFrame, key: str, version: str = "version") -> DataFrame:
    """The history with new versions, numbered on from each key's last; rows that change nothing add none."""
    last = versions(history, key, version)
    values = [c for c in rows.columns if c != key]
    old = last.select(F.col(key).alias("__k"), F.col(version).alias("__v"), F.struct(*values).alias("__old"))
    new = rows.join(old, F.col(key) == F.col("__k"), "left").where(F.col("__old").isNull() | ~F.struct(*values).eqNullSafe(F.col("__old")))
    return history.unionByName(new.select(key, *values, (F.coalesce("__v", F.lit(0)) + 1).cast(history.schema[version].dataType).alias(version)))


def top_report(rows: DataFrame, order: list[Column], line: Column, k: int) -> DataFrame:
    """The first k rows as lines of a report, numbered."""
    w = Window.orderBy(*order)
    few = rows.orderBy(*order).limit(k)
    return few.select(F.row_number().over(w).alias("n"), line.alias("line"))


def retention(items: DataFrame, group: str, order: list[Column], keep: int) -> tuple[DataFrame, DataFrame]:
    """(items to purge, number of kept and purged ones by group)."""
    ranked = items.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    counts = ranked.groupBy(group).agg(F.count_if(F.col("__r") <= keep).alias("kept"), F.count_if(F.col("__r") > keep).alias("removed"))
    return ranked.where(F.col("__r") > keep).drop("__r"), counts


def packet_errors(c: dict[str, Column], quality: float = 0.95, metadata: float = 0.95) -> Column:
    """What an audit of a packet finds, in order. c: factsheets, texts, source_name, hash_ok, pages_match, meetings, items, expected,
    required (fields), missing (fields), missing_terms, missing_refs, tokens, lexical_coverage, ledger."""
    missing = F.size(c["missing"])
    completeness = F.when(F.size(c["required"]) > 0, (F.size(c["required"]) - missing) / F.size(c["required"])).otherwise(F.lit(1.0))
    tests = [
        ("factsheet_missing_or_multiple", c["factsheets"] != 1),
        ("text_missing_or_multiple", c["texts"] != 1),
        ("factsheet_source_name_missing", F.coalesce(c["source_name"], F.lit("")) == ""),
        ("source_hash_mismatch", ~c["hash_ok"]),
        ("page_json_count_mismatch", ~c["pages_match"]),
        ("db_meeting_missing", c["meetings"] <= 0),
        ("zero_items", c["items"] == 0),
        ("db_items_mismatch", c["items"] != c["expected"]),
        ("metadata_completeness_low", completeness < metadata),
        ("signal_terms_missing", F.size(c["missing_terms"]) > 0),
        ("ord_res_refs_missing", F.size(c["missing_refs"]) > 0),
        ("lexical_coverage_low", (c["tokens"] >= 20) & (c["lexical_coverage"] < quality)),
        ("ledger_not_done", c["ledger"] != "DONE"),
    ]
    named = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(True)), F.lit(n)) for n, t in tests]))
    return F.concat(F.transform(c["missing"], lambda f: F.concat(F.lit("missing_"), f)), named)


def schema_rows(df: DataFrame, table: str, spark: SparkSession) -> DataFrame:
    """(table, ordinal, column, type) of a table, as a catalog lists it."""
    return spark.createDataFrame([(table, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)], "table string, ordinal int, column string, type string")
