"""Choosing between our url and the sheet's, and saying how the answer changed."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import names, similarity, urls
from lodestone.functions.names import text_of
from lodestone.operators.matching import FLOOR, SHARE_CAP
from lodestone.operators.sharing import Ledger

WEAK, DEAD, TRUSTED, CARRIED = ("ambiguous",), "url_dead", ("matched",), "carried_over"


def gate_scores(df: DataFrame, name: str, url: str, institution: str, out: str) -> DataFrame:
    """``df`` with how well a url's own slug names the course, 0.0 without a url."""
    slug = urls.slug_to_name(F.col(url))
    keep = [c for c in df.columns if c != out]
    scored = similarity.score_pairs(df.withColumn("_slug", slug), name, "_slug", institution)
    return scored.select(*keep, F.when(text_of(F.col(url)) == "", F.lit(0.0)).otherwise(F.col("score")).alias(out))


def decide(ours: Column, prior: Column, status: Column, prior_status: Column, gate_prior: Column, gate_ours: Column, floor: float = FLOOR) -> Column:
    """blank, dead or weak where the prior url should be taken, ``rejected_by_gate``, or ``keep``."""
    better = status.isin(*WEAK) & prior_status.isin(*TRUSTED) & ~urls.same_page(prior, ours) & (gate_prior > gate_ours)
    passed = gate_prior >= floor
    return (
        F.when(text_of(prior) == "", "keep")
        .when(passed & (text_of(ours) == ""), "blank")
        .when(passed & (status == DEAD), "dead")
        .when(passed & better, "weak")
        .when(~passed & ((text_of(ours) == "") | (status == DEAD)), "rejected_by_gate")
        .otherwise("keep")
    )


FOLDED = "id string, ord long, course_url string, adopted string"


def _fold(cap: int):
    """Rows of one site in file order: adoption must not break the sharing rule."""

    def run(site: pd.DataFrame) -> pd.DataFrame:
        site = site.sort_values(["ord", "id"], kind="stable")
        ledger = Ledger(zip(site["id"], site["stem"], site["classes"], strict=True), cap)
        for who, url in zip(site["id"], site["ours"], strict=True):
            if url:
                ledger.move(who, url)
        wants = site["decision"].isin(["blank", "dead", "weak"])
        outcome = []
        for who, own, prior, decision in site.loc[wants, ["id", "ours", "prior_clean", "decision"]].itertuples(index=False):
            free = ledger.objection(prior, who) is None
            if free:
                ledger.move(who, prior, own)
            outcome.append((prior, decision) if free else (own, "denied"))
        made = site[["id", "ord"]].assign(course_url=site["ours"], adopted="")
        made.loc[wants, ["course_url", "adopted"]] = outcome if outcome else None
        return made

    return run


def triage(results: DataFrame, source: DataFrame, floor: float = FLOOR, cap: int = SHARE_CAP) -> DataFrame:
    """Results with the prior url taken where it is better, and provenance.

    ``results``: ord, id, name, institution_name, website, course_url,
    matched_status, matched_score, match_margin, match_evidence, row_flags.
    ``source``: id, course_url, matched_status. Gate scores and the decision are
    plain columns; only the order-dependent sharing test is a grouped map, over
    ids, urls and stems of one site. Holders are keyed by cleaned urls.
    """
    src = source.select("id", F.trim(text_of(F.col("course_url"))).alias("prior_course_url"), F.trim(text_of(F.col("matched_status"))).alias("prior_matched_status"))
    base = results.join(src, "id", "left").fillna("", ["prior_course_url", "prior_matched_status"])
    base = base.withColumn("course_url", urls.clean_url(F.col("course_url"))).withColumn("_prior_clean", urls.clean_url(F.col("prior_course_url")))
    base = gate_scores(gate_scores(base, "name", "prior_course_url", "institution_name", "_gp"), "name", "course_url", "institution_name", "_go")
    base = base.withColumn("_decision", decide(F.col("course_url"), F.col("prior_course_url"), F.trim("matched_status"), F.col("prior_matched_status"), F.col("_gp"), F.col("_go"), floor))
    sent = base.select(
        urls.host_of(F.col("website")).alias("site"), "id", "ord", F.col("course_url").alias("ours"), F.col("_prior_clean").alias("prior_clean"), F.col("_decision").alias("decision"),
        names.variant_stem(F.col("name")).alias("stem"), names.award_classes(F.col("name")).alias("classes"),
    )
    folded = sent.groupBy("site").applyInPandas(_fold(cap), FOLDED).withColumnRenamed("course_url", "_final")
    out = base.join(folded, ["id", "ord"])
    took = F.col("adopted").isin("blank", "dead", "weak")
    flag = F.when(took, "url_from_source_sheet").when(F.col("adopted") == "denied", "adoption_denied_sharing")
    said = F.concat(F.lit("carried from source sheet (prior status: "), F.coalesce(F.nullif("prior_matched_status", F.lit("")), F.lit("unknown")), F.lit(")"))
    out = out.withColumns(
        {
            "course_url": F.col("_final"),
            "matched_status": F.when(took, CARRIED).otherwise(F.col("matched_status")),
            "matched_score": F.when(took, F.format_string("%.4f", "_gp")).otherwise(F.col("matched_score")),
            "match_margin": F.when(took, "").otherwise(F.col("match_margin")),
            "match_evidence": F.when(took, said).otherwise(F.col("match_evidence")),
            "row_flags": F.concat_ws(";", F.nullif("row_flags", F.lit("")), flag),
            "triage": F.when(F.col("adopted") == "denied", "rejected_by_sharing").otherwise(F.col("_decision")),
        }
    )
    return out.withColumn("url_change", urls.classify_change(F.col("prior_course_url"), F.col("course_url"))).drop("_final", "_gp", "_go", "_prior_clean", "_decision", "adopted")


def triage_stats(triaged: DataFrame) -> DataFrame:
    """One row of counters."""
    n = lambda *v: F.count_if(F.col("triage").isin(*v))
    return triaged.agg(
        n("blank").alias("adopted_blank"), n("dead").alias("adopted_dead"), n("weak").alias("adopted_weak"), n("rejected_by_gate").alias("rejected_by_gate"),
        n("rejected_by_sharing").alias("rejected_by_sharing"), F.count_if(~F.col("triage").isin("blank", "dead", "weak")).alias("kept_ours"),
    )


def url_changes(triaged: DataFrame) -> DataFrame:
    return triaged.groupBy("url_change").agg(F.count("*").alias("rows"))
