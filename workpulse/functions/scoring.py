"""Risk scoring and flag expressions (M1-M14). Pure column arithmetic, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from workpulse.params import (
    ATTENTION_QUALITY_FLOOR,
    MAX_COMMENT_QUALITY_DEFICIT,
    MAX_DAYS_NO_STATE_CHANGE,
    MAX_HOURS_UNCHANGED_DAYS,
    RISK_LABEL_LAST,
    SPRINT_URGENCY_STEPS,
    STALE_UPDATE_DAYS,
    Params,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(value, max_value: float) -> Column:
    """clamp(value / max, 0, 1) in double precision (M1)."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), _c(value).cast("double") / F.lit(float(max_value))))


def hours_stale(remaining, original, days_update) -> Column:
    """(remaining >= original, both set) OR days since update >= 3 (M3)."""
    return F.coalesce(_c(remaining) >= _c(original), F.lit(False)) | (_c(days_update) >= F.lit(STALE_UPDATE_DAYS))


def sprint_urgency(days_remaining, dates_configured) -> Column:
    """M7: 0 when dates are not configured, else a step function of days remaining."""
    (d0, u0), (d1, u1), (d2, u2) = SPRINT_URGENCY_STEPS
    d = _c(days_remaining)
    steps = (F.when(d == F.lit(d0), F.lit(u0)).when(d <= F.lit(d1), F.lit(u1))
             .when(d <= F.lit(d2), F.lit(u2)).otherwise(F.lit(0.0)))
    return F.when(_c(dates_configured), steps).otherwise(F.lit(0.0))


def risk_raw(days_state, days_update, stale, quality, copied, blocker, days_remaining, dates_configured,
             p: Params) -> Column:
    """Weighted sum x 100 with the operand order of the reference (M2, M4-M8)."""
    s1 = normalise(days_state, MAX_DAYS_NO_STATE_CHANGE)
    s2 = normalise(F.when(_c(stale), _c(days_update)).otherwise(F.lit(0)), MAX_HOURS_UNCHANGED_DAYS)
    s3 = normalise(F.greatest(F.lit(0), F.lit(10) - _c(quality)), MAX_COMMENT_QUALITY_DEFICIT)
    s4 = F.when(_c(copied), F.lit(1.0)).otherwise(F.lit(0.0))
    s5 = F.when(_c(blocker), F.lit(1.0)).otherwise(F.lit(0.0))
    s6 = sprint_urgency(days_remaining, dates_configured)
    w = p.weights
    raw = (s1 * F.lit(w[0]) + s2 * F.lit(w[1]) + s3 * F.lit(w[2]) + s4 * F.lit(w[3])
           + s5 * F.lit(w[4]) + s6 * F.lit(w[5]))
    return raw * F.lit(100.0)


def half_even(x) -> Column:
    """Python ``round()``: ties to even (M9)."""
    return F.rint(_c(x)).cast("int")


def risk_label(score, p: Params) -> Column:
    """Score -> label by cut points."""
    expr = None
    for cut, label in p.label_cuts:
        cond = _c(score) <= F.lit(cut)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(RISK_LABEL_LAST))


def label_with_missing_override(label, has_comment_today, p: Params) -> Column:
    """No comment today and the lowest label -> the second label; score unchanged."""
    lowest, second = p.label_cuts[0][1], p.label_cuts[1][1]
    return F.when(~_c(has_comment_today) & (_c(label) == F.lit(lowest)), F.lit(second)).otherwise(_c(label))


def history_is_good(compliant, copied, score, p: Params) -> Column:
    """Compliant and not copied and score >= good threshold."""
    return _c(compliant) & ~_c(copied) & (_c(score) >= F.lit(p.good_threshold))


def gate_triggered(state_norm, has_comment, quality, copied, p: Params) -> Column:
    """Task in the gate state with no comment, a weak one, or a copy."""
    return (_c(state_norm) == F.lit(p.gate)) & (
        ~_c(has_comment) | (_c(quality) < F.lit(p.good_threshold)) | _c(copied))


def needs_attention(score, blocker, has_comment, quality, copied, gate, p: Params) -> Column:
    """Any of six reasons."""
    return ((_c(score) >= F.lit(p.flag_threshold)) | _c(blocker) | ~_c(has_comment)
            | (_c(quality) < F.lit(ATTENTION_QUALITY_FLOOR)) | _c(copied) | _c(gate))


def norm_state(state) -> Column:
    """Trim (Python whitespace) and lower-case a state name."""
    from workpulse.functions.text import py_strip
    return F.lower(py_strip(F.coalesce(_c(state), F.lit(""))))
