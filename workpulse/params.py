"""Run parameters (one frozen object per job) and fixed values.

Fixed values below must equal the behaviour being reproduced; they are kept
together, in natural order, as plain text.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written).
# ---------------------------------------------------------------------------
HIERARCHY_FORWARD = "System.LinkTypes.Hierarchy-Forward"
CLOSED_PARENT_STATES = ("Closed", "Removed")
UNASSIGNED = "Unassigned"
NUDGE_DEFAULT_FIRST_NAME = "Developer"
REMINDER_DEFAULT_FIRST_NAME = "there"
RISK_LABEL_LAST = "Critical"
ESCALATED_LABELS = ("At Risk", "Critical")
QUALITY_LABELS = ("excellent", "good", "vague", "copy-pasted", "missing")
SKIPPED_LABEL = "skipped"
DEFAULT_TONE = "gentle"
DEFAULT_SENTIMENT = "neutral"
# Signal normalisation maxima: days without state change, days with the same
# hours, quality deficit points.
MAX_DAYS_NO_STATE_CHANGE = 10
MAX_HOURS_UNCHANGED_DAYS = 7
MAX_COMMENT_QUALITY_DEFICIT = 10
# Sprint urgency steps: 0 days -> 1.0, <=2 -> 0.75, <=5 -> 0.4, else 0.
SPRINT_URGENCY_STEPS = ((0, 1.0), (2, 0.75), (5, 0.4))
# A task counts as "hours stale" once nothing changed for this many days.
STALE_UPDATE_DAYS = 3
# needs_attention fires below this comment quality score.
ATTENTION_QUALITY_FLOOR = 5


@dataclass(frozen=True)
class Params:
    """All knobs of one run. Defaults are the documented defaults."""

    lookback_days: int = 3
    copy_paste_threshold: float = 0.92
    flag_threshold: int = 60
    # Six weights, in the operand order of the weighted sum.
    w_state: float = 0.25
    w_hours: float = 0.20
    w_quality: float = 0.20
    w_copy: float = 0.15
    w_blocker: float = 0.10
    w_sprint: float = 0.10
    # Label cut points: score <= cut -> label; above the last -> Critical.
    label_cuts: tuple = ((30, "Healthy"), (60, "Watch"), (80, "At Risk"), (100, "Critical"))
    parent_types: tuple = ("User Story",)
    allowed_types: tuple = ("Task",)
    notify_states: tuple = ("active", "resolved")
    gate_state: str = "active"
    good_threshold: int = 7
    recipients: tuple = ()
    # Addresses of one report row.
    report_batch: int = 100
    # "latest": latest compliant snapshot row of any date (reference code);
    # "yesterday": only a compliant row dated the day before as_of counts.
    gate_policy: str = "latest"
    # True: ignore history rows dated on/after as_of's date (idempotent reruns).
    history_before_as_of: bool = False
    # Dimension-side broadcast is allowed only below this many rows.
    broadcast_row_limit: int = 100_000

    @property
    def active_states(self) -> tuple:
        notify = {s.strip().lower() for s in self.notify_states}
        return tuple(sorted(notify | {self.gate_state.strip().lower()}))

    @property
    def gate(self) -> str:
        return self.gate_state.strip().lower()

    @property
    def weights(self) -> tuple:
        return (self.w_state, self.w_hours, self.w_quality, self.w_copy, self.w_blocker, self.w_sprint)


DEFAULT_AS_OF = "2024-01-30 18:00:00"
