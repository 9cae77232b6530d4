"""Risk score, label and signal breakdown (M1-M11, K12) and the attention flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.scoring import (
    gate_triggered,
    half_even,
    hours_stale,
    label_with_missing_override,
    needs_attention,
    norm_state,
    risk_label,
    risk_raw,
)
from workpulse.params import Params


def score_risk(df: DataFrame, p: Params) -> DataFrame:
    """Expects task columns plus ``days_remaining``, ``dates_configured`` and analysis columns
    ``quality_score``, ``copy_paste_detected``, ``blocker_detected``, ``has_comment_today``.
    Adds ``hours_stale``, ``risk_score``, ``risk_label`` and the ``signals`` struct."""
    stale = hours_stale(F.col("remaining_hours"), F.col("original_estimate"), F.col("days_since_last_update"))
    raw = risk_raw(F.col("days_since_state_change"), F.col("days_since_last_update"), F.col("hours_stale"),
                   F.col("quality_score"), F.col("copy_paste_detected"), F.col("blocker_detected"),
                   F.col("days_remaining"), F.col("dates_configured"), p)
    out = df.withColumn("hours_stale", stale).withColumn("risk_score", half_even(raw))
    out = out.withColumn("risk_label", label_with_missing_override(risk_label(F.col("risk_score"), p),
                                                                   F.col("has_comment_today"), p))
    return out.withColumn("signals", F.struct(
        F.col("days_since_state_change"), F.col("days_since_last_update"), F.col("hours_stale"),
        F.col("quality_score").alias("comment_quality_score"), F.col("copy_paste_detected"),
        F.col("blocker_detected"), F.col("days_remaining").alias("days_remaining_in_sprint")))


def flag_attention(df: DataFrame, p: Params) -> DataFrame:
    """Adds ``quality_gate_triggered`` (M13) and ``needs_attention``."""
    state = F.col("state_norm") if "state_norm" in df.columns else norm_state(F.col("state"))
    g = gate_triggered(state, F.col("has_comment_today"), F.col("quality_score"), F.col("copy_paste_detected"), p)
    out = df.withColumn("quality_gate_triggered", g)
    return out.withColumn("needs_attention", needs_attention(
        F.col("risk_score"), F.col("blocker_detected"), F.col("has_comment_today"), F.col("quality_score"),
        F.col("copy_paste_detected"), F.col("quality_gate_triggered"), p))
