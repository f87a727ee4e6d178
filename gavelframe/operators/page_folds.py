"""What pages of a run tell each other: types carried from anchors, segments, legacy modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEMANTIC = ("agenda", "minutes", "reference_or_procedure", "legislative_prose", "government_form", "invoice", "contract_or_agreement", "financial_report")


def is_anchor(c: dict[str, Column], least: float = 0.72) -> Column:
    return c["page_type"].isin(*SEMANTIC) & (c["source"] == "semantic") & (c["confidence"] >= least)


def is_weak(c: dict[str, Column]) -> Column:
    """A page that may take the type of another: generic, a slide, or a table without strong numbers."""
    return c["page_type"].isin("generic_prose", "powerpoint") | ((c["page_type"] == "table_or_mixed_layout") & ~c["strong_table"])


def carry(rows: DataFrame, sandwich: int = 2, most: int = 6) -> DataFrame:
    """The rows (run, page, page_type, anchor, weak, evidence) with typed, in three passes of windows over a run: a weak page with
    evidence between two anchors of one type within `sandwich` pages takes it; then one behind an anchor, then one before an anchor, at
    most `most` pages off. A blank separator ends an anchor's reach."""
    w = Window.partitionBy("run").orderBy("page")
    kept = F.when(F.col("anchor"), F.col("page_type"))
    before, after = F.last(kept, ignorenulls=True).over(w.rowsBetween(-sandwich, -1)), F.first(kept, ignorenulls=True).over(w.rowsBetween(1, sandwich))
    out = rows.withColumn("_b", before).withColumn("_a", after).withColumn("typed", F.when(F.col("weak") & F.col("evidence") & (F.col("_b") == F.col("_a")), F.col("_b")).otherwise(F.col("page_type")))
    out = out.withColumn("_part", F.sum((F.col("page_type") == "blank_separator").cast("int")).over(w)).drop("_a", "_b")
    for back in (True, False):
        side = Window.partitionBy("run", "_part").orderBy("page" if back else F.desc("page")).rowsBetween(Window.unboundedPreceding, 0)
        at = F.last(F.when(F.col("anchor"), F.struct("page", "page_type")), ignorenulls=True).over(side)
        still = F.col("weak") & F.col("evidence") & ~F.col("anchor") & (F.col("typed") == F.col("page_type")) & (F.col("page_type") != "blank_separator")
        out = out.withColumn("_at", at).withColumn("typed", F.when(still & (F.abs(F.col("page") - F.col("_at.page")) <= most), F.col("_at.page_type")).otherwise(F.col("typed"))).drop("_at")
    return out.drop("_part")


def resolve_modes(rows: list[dict], least: float = 0.90, carry: float = 0.20, margin: float = 0.25, here: float = 0.45, ahead: float = 0.85, review: float = 0.70) -> list[dict]:
    """Modes of pages in order (m1, m2: scores; a1, a2: anchors; c1, c2: continuation; att: attachment): an anchor decides; else the mode
    of the page before goes on if this page continues it and the other is not stronger by the margin; else attachments and meeting-like
    pages are mode 1; else a fair score that the next page confirms; else the best score above the review threshold; else unknown."""
    out, before = [], None
    for r, nxt in zip(rows, [*rows[1:], None]):
        score = {"mode_1": r["m1"], "mode_2": r["m2"]}
        go = {"mode_1": r["c1"], "mode_2": r["c2"]}
        found = None
        if r["a1"] >= least:
            found = "mode_1", r["a1"], "DIRECT_ANCHOR_M1"
        elif r["a2"] >= least:
            found = "mode_2", r["a2"], "DIRECT_ANCHOR_M2"
        elif before in score and go[before] >= carry:
            other = "mode_2" if before == "mode_1" else "mode_1"
            found = (other, score[other], "COMPETITIVE_SWITCH") if score[other] > go[before] + margin else (before, go[before], "CARRY_FORWARD")
        elif before == "mode_1" and r["att"] >= 0.30 and r["m2"] <= 0.55 and r["a2"] < 0.40:
            found = "mode_1", max(r["m1"], r["att"]), "ATTACHMENT_CONTINUITY"
        elif r["m1"] >= 0.55 and r["m2"] <= 0.25 and (r["a1"] >= 0.35 or r["c1"] >= 0.40):
            found = "mode_1", r["m1"], "SEMANTIC_FALLBACK"
        elif nxt and r["m1"] >= here and nxt["m1"] >= ahead:
            found = "mode_1", r["m1"], "LOOK_AHEAD"
        elif nxt and r["m2"] >= here and nxt["m2"] >= ahead:
            found = "mode_2", r["m2"], "LOOK_AHEAD"
        elif max(score.values()) >= review:
            best = "mode_1" if r["m1"] >= r["m2"] else "mode_2"
            found = best, score[best], "DIRECT_SCORE"
        before, confidence, reason = found or ("unknown", 0.0, "INSUFFICIENT_SIGNALS")
        out.append({**r, "mode": before, "confidence": confidence, "reason": reason})
    return out


def recover_modes(rows: list[dict], short: int = 2) -> list[dict]:
    """Unknown pages (mode, m1, m2, c1, c2, att, a2, blank) in order: a fair mode-1 score; between two pages of one mode; behind two of one
    mode that they weakly continue. Then runs of unknown pages between mode-1 pages without strong mode-2 signs: with an attachment, or
    of at most `short` pages with text. Blank pages stay unknown. Earlier decisions count for later ones."""
    out = [dict(r, recovered=None) for r in rows]

    def set_mode(r: dict, mode: str, reason: str) -> None:
        r["mode"], r["recovered"] = mode, reason

    for i, r in enumerate(out):
        if r["mode"] != "unknown" or r["blank"]:
            continue
        prev, nxt = out[i - 1] if i else None, out[i + 1] if i + 1 < len(out) else None
        if r["m1"] >= 0.35 and r["m2"] <= 0.15 and (r["a1"] >= 0.35 or r["c1"] >= 0.35):
            set_mode(r, "mode_1", "LOW_CONFIDENCE")
        elif prev and nxt and prev["mode"] == nxt["mode"] != "unknown":
            set_mode(r, prev["mode"], "SANDWICH")
        elif i > 1 and prev["mode"] == out[i - 2]["mode"] != "unknown" and r["c1" if prev["mode"] == "mode_1" else "c2"] > 0.05:
            set_mode(r, prev["mode"], "CLUSTER_TAIL")
    i = 0
    while i < len(out):
        if out[i]["mode"] != "unknown":
            i += 1
            continue
        end = i
        while end + 1 < len(out) and out[end + 1]["mode"] == "unknown":
            end += 1
        run = out[i : end + 1]
        inside = i > 0 and end + 1 < len(out) and out[i - 1]["mode"] == out[end + 1]["mode"] == "mode_1"
        if inside and not any(r["m2"] > 0.55 or r["a2"] >= 0.40 for r in run):
            reason = "ATTACHMENT_CHAIN" if any(r["att"] >= 0.30 for r in run) else "SHORT_GAP" if len(run) <= short and any(not r["blank"] for r in run) else None
            for r in run:
                if reason and not r["blank"]:
                    set_mode(r, "mode_1", reason)
        i = end + 1
    return out


def absorbed(pages: DataFrame) -> DataFrame:
    """The pages (run, page, label, blank, fresh) with effective and segment: a blank unknown page takes the label of the page before it
    within one page, else of the one behind it; a segment starts at the first page, at a change, and at a fresh document's start."""
    w = Window.partitionBy("run").orderBy("page")
    prev, nxt = F.lag("label").over(w), F.lead("label").over(w)
    hollow = F.col("blank") & (F.col("label") == "unknown")
    near = F.coalesce(F.when(prev != "unknown", prev), F.when(nxt != "unknown", nxt), F.col("label"))
    eff = pages.withColumn("effective", F.when(hollow, near).otherwise(F.col("label")))
    start = F.lag("effective").over(w).isNull() | (F.lag("effective").over(w) != F.col("effective")) | (F.col("fresh") & ~F.col("blank"))
    return eff.withColumn("_s", start.cast("int")).withColumn("segment", F.sum("_s").over(w)).drop("_s")
